"""fareline: monthly taxi-trip analytics expressed as Spark DataFrame plans.

Layers (all pure ``DataFrame -> DataFrame`` functions unless noted):

* ``sources``    raw trip / zone scans, month selection, calendar spine
* ``functions``  Column expressions (duration, speed, labels, keys)
* ``operators``  cleansing, dedup, star-schema models, reports, data quality
* ``sinks``      month-partitioned Parquet and catalogue tables
* ``plans``      the month job (scan -> cleanse -> load -> model -> test)
* ``streaming``  file-arrival trigger that re-runs the month job per landed month
"""

__version__ = "0.1.0"

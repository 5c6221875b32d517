"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written directly against the driver's views (``events``, ``nation``,
``region``), re-deriving the trip mapping, cleansing, models, reports and data
tests in plain SQL. Nothing here calls the DataFrame code.
"""

from fareline.oracle.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]

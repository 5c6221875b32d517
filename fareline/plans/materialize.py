"""Store a shuffle-heavy layer once and read it back (lineage cut, pruning kept).

Several consumers of one model would otherwise each run its dedup shuffles again: column pruning
makes every branch's plan different, so Spark cannot reuse the exchanges. A write is an ordinary job
commit, so a lost executor only costs task retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def put(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

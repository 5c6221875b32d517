"""Row and NULL counts of stored tables from Parquet footers (O-70, O-80).

Parquet keeps the number of rows and of NULLs of every column chunk. With aggregate pushdown, Spark
answers ``count(*)`` and ``count(column)`` from the footers and reads no column at all. Pushdown is a
feature of the version-2 Parquet source, so the counts run in a session of their own with that source
switched on; the caller's settings stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareline.functions.sql import quote, sql_literal

FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster that answers counts from footers."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
        session.conf.set(name, spark.conf.get(name))
    for name, value in FOOTER_CONF.items():
        session.conf.set(name, value)
    return session


def counts(session: SparkSession, folders: Sequence[str], schema: StructType, columns: Sequence[str]) -> DataFrame:
    """One row: ``rows``, and for each column how many of its values are not NULL.

    ``schema`` must have all columns of the files in their order: a pushed count takes its column by place.
    """
    df = session.read.schema(schema).parquet(*folders)
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.expr(f"count({quote(c)}) AS {quote(c)}") for c in columns))


def null_counts(session: SparkSession, folders: Sequence[str], schema: StructType, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) of stored columns; a table of no rows has none."""
    columns = list(dict.fromkeys(columns))
    # files of no row groups push no counts, and their sums are NULL though a count never is: no plain coalesce
    pairs = ", ".join(f"{sql_literal(c)}, if(rows > {quote(c)}, rows - {quote(c)}, 0L)" for c in columns)
    return counts(session, folders, schema, columns).selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, nulls)")

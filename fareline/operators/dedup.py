"""Key dedup with a deterministic survivor (O-20, O-60).

Both dedups of the reference keep an *arbitrary* row per key. Here the survivor
is fixed: the first row by every non-key column ascending, NULLs last, in the
frame's column order. Identical rows tie on everything, so which copy survives
does not matter; rows that differ outside the key always resolve the same way,
independent of input partitioning.

Plan shape: ``row_number() == 1`` lets Catalyst insert a *partial*
``WindowGroupLimit`` before the hash exchange, so each map task forwards at most
one row per key. A key holding a third of all rows therefore shuffles one row
per map task, not a third of the table. NULL keys group together, like
``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions.sql import quote

_RN = "__dedup_rn"


def survivor_order(df: DataFrame, keys: Sequence[str]) -> list[str]:
    key_set = set(keys)
    return [c for c in df.columns if c not in key_set]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` (default: all other columns) asc, NULLs last.

    The window is written as one SQL expression: the same logical plan as
    ``Window.partitionBy(...).orderBy(...)``, built with one JVM call instead of
    several per column.
    """
    order = list(order_by) if order_by is not None else survivor_order(df, keys)
    spec = "PARTITION BY {} ORDER BY {}".format(
        ", ".join(quote(k) for k in keys), ", ".join(f"{quote(c)} ASC NULLS LAST" for c in order)
    )
    return df.withColumn(_RN, F.expr(f"row_number() OVER ({spec})")).where(F.col(_RN) == 1).drop(_RN)

"""Dimension lookups with a *checked* broadcast (O-62, O-63, O-64, O-66).

A dimension is broadcast only after one bounded job proves both its row count
and its byte size below limits: over ``dim.limit(max_rows + 1)`` it counts the
rows and sums each row's text length plus a fixed overhead per column (an
upper estimate of the in-memory size), so the check itself never reads more
than ``max_rows + 1`` rows. Above either limit the join is left to the planner:
AQE can still turn it into a broadcast from runtime sizes, or run a sort-merge
join with skew-partition splitting (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.functions.sql import quote

# Largest dimension we hint as broadcast. Zone lookups have ~265 rows and calendars
# ~366 per year; both limits are far above that and far below executor memory.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_COLUMN_OVERHEAD_BYTES = 16


def fits_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows and about ``max_bytes`` bytes."""
    width = " + ".join(
        f"coalesce(octet_length(CAST({quote(c)} AS STRING)), 0) + {_COLUMN_OVERHEAD_BYTES}" for c in dim.columns
    ) or "0"
    stats = dim.limit(max_rows + 1).agg(
        F.expr("count(1) AS n"), F.expr(f"sum(CAST({width} AS BIGINT)) AS b")
    ).first()
    return stats["n"] <= max_rows and (stats["b"] or 0) <= max_bytes


def maybe_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(dim)`` when it passes :func:`fits_broadcast`, else ``dim`` unchanged."""
    return F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join ``fact.fact_key = dim.dim_key``; dim columns other than the key are appended."""
    d = maybe_broadcast(dim, max_rows)
    joined = fact.join(d, fact[fact_key] == d[dim_key], how)
    keep = [fact[c] for c in fact.columns] + [d[c] for c in dim.columns if c != dim_key]
    return joined.select(*keep)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    p = maybe_broadcast(parent.select(F.col(parent_key).alias("__pk")), max_rows)
    c = child.where(F.col(key).isNotNull())
    return c.join(p, c[key] == p["__pk"], "left_anti")

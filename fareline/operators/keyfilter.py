"""Uniqueness of a key over many stored months without shuffling them (O-81).

Each month keeps two small tables beside its rows: a blocked Bloom filter of its keys, and the keys it
holds more than once. A key can only occur in two months if the filter of one lets through a key of the
other, so only such keys (true repeats and a few in ten thousand others) are looked up and counted.

A filter is a table of blocks: ``blocks`` (how many there are), ``block`` and ``words`` (1,024 longs).
A key sets ``PROBES`` bits of one block, so a look-up is one join by block. All parts are built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.operators.lookups import MAX_BROADCAST_ROWS, maybe_broadcast
from fareline.session import shared_dir, together
from fareline.sinks.snapshots import Run, Warehouse

WORDS = 1024  # longs in a block
BITS = WORDS * 64
PROBES = 7
BITS_PER_KEY = 16
BROADCAST_BYTES = 64 << 20


def _block(c: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(c), blocks).cast("int")


def _probes(c: Column) -> list[Column]:
    """Bit numbers in the block, by double hashing."""
    second = F.xxhash64(F.lit(1), c)
    start, step = second.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(second, 32).bitwiseOR(F.lit(1))
    return [F.pmod(start + step * k, F.lit(BITS)).cast("int") for k in range(PROBES)]


def blocks_for(rows: int) -> int:
    """Number of blocks for so many keys: a power of two, so months of like size share look-ups."""
    need, n = rows * BITS_PER_KEY, 1
    while n * BITS < need:
        n *= 2
    return n


def build_filter(df: DataFrame, column: str, rows: int) -> DataFrame:
    """The filter of the non-NULL values of a column; a table of no rows gives one empty block."""
    spark, n = df.sparkSession, blocks_for(rows)
    c = F.col(column)
    bits = df.where(c.isNotNull()).select(_block(c, F.lit(n)).alias("block"), F.explode(F.array(*_probes(c))).alias("bit"))
    set_ = bits.select("block", (F.col("bit") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, bit % 64)").alias("mask"))
    blank = spark.range(n * WORDS).select((F.col("id") / WORDS).cast("int").alias("block"), (F.col("id") % WORDS).cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = set_.unionByName(blank).groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
    each = words.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("w"))  # 1,024 a block
    return each.select(F.lit(n).alias("blocks"), "block", F.col("w.mask").alias("words"))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """(column, n_records): non-NULL values that occur more than once."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def may_hold(keys: DataFrame, column: str, filters: DataFrame) -> DataFrame:
    """Rows of ``keys`` with each row of ``filters`` (blocks, block, words and any columns) that may hold them.

    The filters go to the tasks that read the keys while all of them together are at most
    ``BROADCAST_BYTES``; beyond that the keys' hashes are joined by block.
    """
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # a handful: powers of two
    small = filters.limit(BROADCAST_BYTES // (WORDS * 8) + 1).count() * WORDS * 8 <= BROADCAST_BYTES
    c = F.col(column)
    probes = {f"__p{k}": p for k, p in enumerate(_probes(c))}
    ready = keys.where(c.isNotNull()).withColumns(probes).withColumn("blocks", F.explode(F.array(*(F.lit(n) for n in sorted(sizes or [1])))))
    ready = ready.withColumn("block", _block(c, F.col("blocks")))
    joined = ready.join(F.broadcast(filters) if small else filters, ["blocks", "block"])
    hit = " AND ".join(f"shiftrightunsigned(words[CAST(floor(__p{k} / 64) AS INT)], __p{k} % 64) & 1 = 1" for k in range(PROBES))
    return joined.where(hit).drop("blocks", "block", "words", *probes)


def violations(rows: DataFrame, column: str, candidates: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(unique_field, n_records) of repeated values, counting only rows whose value is a candidate."""
    some = rows.join(maybe_broadcast(candidates.select(column).distinct(), max_rows), column, "left_semi")
    return some.groupBy(F.col(column).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


# --- stored months -----------------------------------------------------------------------------


def key_tables(name: str) -> tuple[str, str]:
    """Names of the two tables beside a month table: filter and repeated keys."""
    return f"{name}_keys", f"{name}_repeats"


def put_keys(run: Run, df: DataFrame, column: str, layer: str, name: str, year: int, month: int, rows: int | None = None) -> None:
    """Store a month's filter and repeated keys with the run that stores the month."""
    filters, repeats = key_tables(name)
    n = df.count() if rows is None else rows
    together(
        lambda: run.put(build_filter(df, column, n), layer, filters, year, month),
        lambda: run.put(repeated_keys(df, column), layer, repeats, year, month),
    )


def unique_over_months(warehouse: Warehouse, layer: str, name: str, column: str, version: int | None = None) -> DataFrame:
    """(unique_field, n_records): every value that occurs more than once in a stored month table.

    Keys of each month that another month's filter lets through, and the keys repeated inside a month,
    are the candidates; nothing else is shuffled.
    """
    version = warehouse.version() if version is None else version
    filters, repeats = key_tables(name)
    rows = warehouse.read(layer, name, version).select(column, "year", "month")
    other = warehouse.read(layer, filters, version).withColumnsRenamed({"year": "__y", "month": "__m"})
    across = may_hold(rows, column, other).where("year <> __y OR month <> __m").select(column)
    shared_dir(rows.sparkSession)
    candidates = across.union(warehouse.read(layer, repeats, version).select(column)).distinct().checkpoint()
    return violations(rows.select(column), column, candidates)


def rows_to_test(run: Run, df: DataFrame, column: str, layer: str, name: str, year: int, month: int, alone: bool = False) -> DataFrame:
    """Rows (of one column) that decide unique(column) for a month stored by an unpublished run: the keys that
    repeat inside it or occur in any other published month, with their rows in all months. ``alone``: no other month counts.

    Only months whose filter lets a key through are read, one column of them.
    """
    warehouse, mine = run.warehouse, df.select(column)
    filters, repeats = key_tables(name)
    within = run.read(layer, repeats, year, month).select(column)
    others = [] if alone else [m for m in warehouse.months(layer, filters, run.base) if m != (year, month)]
    if not others:
        return mine.join(maybe_broadcast(within), column, "left_semi")
    shared_dir(df.sparkSession)
    hits = may_hold(mine, column, warehouse.read(layer, filters, run.base, others)).distinct().checkpoint()
    hit_months = sorted((r["year"], r["month"]) for r in hits.select("year", "month").distinct().collect())  # months only
    some = maybe_broadcast(hits.select(column).union(within).distinct())
    out = mine.join(some, column, "left_semi")
    if hit_months:
        older = warehouse.read(layer, name, run.base, hit_months).select(column)
        out = out.unionByName(older.join(some, column, "left_semi"))
    return out

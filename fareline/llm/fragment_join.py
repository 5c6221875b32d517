"""N-gram Jaccard join by vertical partitioning: partial overlaps per fragment of the n-gram order, summed per pair.

Every document becomes the set of its hashed word n-grams; equal sets form one class. All n-grams
have one global order: rare ones first (by a fixed-size sketch that counts every n-gram of every
document), then by hash. The order is cut into FRAGMENTS pieces, and each set is cut with it.

1. Two sets that are similar enough share n-grams among the first few of each (the prefix filter), and
   the more of them the closer their sizes are. Classes become a candidate pair if they share as many
   as their sizes ask for, and if the sum over the fragments of the smaller segment size allows it.
   N-grams in the prefix of more than SHORT_LIST classes are common. They are not counted pair by pair:
   a pair is taken to share as many of them as both have. Classes with more than FEW of them, or with
   enough for a partner of their own size, are only tied together; the others are paired with those
   of the few sizes for which so little is enough.
2. The connected groups of candidates are dealt to tasks in blocks of at most BLOCK classes; large
   groups are cut by size band, and only blocks whose sizes can match meet.
3. A task counts the overlaps of all its pairs fragment by fragment and sums them. The sets of a block
   pair with many n-grams come to it in ranges of their hashes, one range after the other, so it holds
   one range of them at a time. It returns no pairs but one link from each class to the smallest class
   it is linked with, directly or through others.
4. The links of all tasks are closed into components.

Nothing is capped or sampled: the sketch, the limits and the blocks decide how work is dealt, not
which pairs are compared. N-grams are compared by 64-bit hashes, classes by a 64-bit sum of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.llm.components import connected_components
from fareline.llm.text import LOWER, NONSPACE, U64, distinct_per_row, give_back, hashes, mix, shingles, slices, spans, utf8
from fareline.operators.lookups import maybe_broadcast
from fareline.session import scratch_path

SKETCH_BITS = 23  # counters of the order sketch: 2**23, of any corpus
SKETCH_PARTS, SLOTS = 64, 32
LEVELS, STEPS = 64, 4  # levels of the order, so many for each doubling of a counter
RARE_PARTS, COMMON_PARTS = 96, 32  # fragments of the rare and of the common n-grams
SHORT_LIST = 64
FEW = 8  # common n-grams of a prefix up to which a class is not tied to all others that have them
BLOCK = 1024
RANGE = 1 << 18  # n-grams of the sets of a block pair that a task holds at once, about
COLUMNS = 512  # n-grams counted at once in a task
SETS_BYTES = 1 << 18  # bytes of text whose n-grams are found at once: they take some 100 times as much
SMALL_SIDE = 1_000_000  # rows of at most 64 MB together up to which a side of a join is sent to all tasks
PLACED_SIDE = 250_000  # the same for wider rows: classes with their places in blocks


def gram_sets(buf: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text: (hashes, bounds)."""
    low = LOWER[buf]
    starts, ends = spans(low, offsets, NONSPACE)
    h, rows = shingles(hashes(low, starts, ends), np.searchsorted(starts, offsets), n)
    return distinct_per_row(h, rows, len(offsets) - 1)


def _sets(batches: Iterator[pa.RecordBatch], column: int, n: int):
    """(batch, first row, hashes, bounds) of slices of texts."""
    for batch in batches:
        buf, off = utf8(batch.column(column))
        for a, b in slices(off, SETS_BYTES):
            yield batch.slice(a, b - a), *gram_sets(buf[off[a] : off[b]], off[a : b + 1] - off[a], n)
    give_back()


class Order(NamedTuple):
    """The global order: a level for each sketch counter, 0 for rare n-grams."""

    levels: np.ndarray

    def level(self, h: np.ndarray) -> np.ndarray:
        return self.levels[(h >> U64(64 - SKETCH_BITS)).astype(np.int64)]

    def fragment(self, h: np.ndarray, level: np.ndarray) -> np.ndarray:
        low = h & U64(0xFFFFFFFF)
        return np.where(level == 0, low % U64(RARE_PARTS), U64(RARE_PARTS) + low % U64(COMMON_PARTS)).astype(np.int64)


def _pack(counts: np.ndarray) -> bytes:
    """Counters as bytes, compressed; the higher bytes of all counters come together, as most of them are zero."""
    return pa.compress(np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def _unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, size).T).view(np.uint32).ravel()


def fit_order(docs: DataFrame, n: int) -> Order:
    """Count every document's n-grams in a sketch of 2**SKETCH_BITS counters (32 MB), summed in Spark.

    The driver gets one byte of each counter: its binary logarithm, in eighths.
    """
    size = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << SKETCH_BITS, np.uint32), 0
        for part, h, _ in _sets(batches, 0, n):
            np.add.at(total, (h >> U64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            rows += len(h)
        if rows:
            data = [_pack(total[k * size : (k + 1) * size]) for k in range(SKETCH_PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([rows % SLOTS] * SKETCH_PARTS, pa.int32()), pa.array(data, pa.binary())], names=["part", "slot", "counts"])

    def summed(group: pa.Table) -> np.ndarray:
        total = np.zeros(size, np.uint32)
        for x in group["counts"]:
            total += _unpack(x.as_py(), size)
        return total

    def added(group: pa.Table) -> pa.Table:
        return pa.table({"part": group["part"][:1], "slot": group["slot"][:1], "counts": pa.array([_pack(summed(group))], pa.binary())})

    def logs(group: pa.Table) -> pa.Table:
        total = summed(group)
        eighths = np.log2(np.maximum(total, 1)) * 8  # below 256
        return pa.table({"part": group["part"][:1], "total": pa.array([int(total.sum(dtype=np.int64))]), "eighths": pa.array([eighths.astype(np.uint8).tobytes()], pa.binary())})

    parts = docs.select("_text").mapInArrow(count, "part int, slot int, counts binary").groupBy("part", "slot").applyInArrow(added, "part int, slot int, counts binary")
    sums = parts.groupBy("part").applyInArrow(logs, "part int, total long, eighths binary").orderBy("part").collect()  # SKETCH_PARTS rows
    usual = max(16.0, sum(r["total"] for r in sums) / (1 << SKETCH_BITS))
    of = np.clip((np.arange(256) - np.floor(np.log2(usual) * 8)) * STEPS // 8, 0, LEVELS - 1).astype(np.uint8)
    return Order(np.concatenate([of[np.frombuffer(r["eighths"], np.uint8)] for r in sums]) if sums else np.zeros(1 << SKETCH_BITS, np.uint8))


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap with a similar enough set, for sets of size n."""
    return (percent * n + 99) // 100


def _enough(overlap, total, percent: int):
    """percent or more of the union, for two sets of ``total`` members together."""
    return overlap * (100 + percent) >= percent * total


def class_ids(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit id of each set."""
    size = np.diff(bounds)
    total = np.zeros(len(size), U64)
    np.add.at(total, np.repeat(np.arange(len(size)), size), mix(h ^ U64(0x5851F42D4C957F2D)))
    return mix(total + size.astype(U64)).view(np.int64)


def describe(docs: DataFrame, order: Order, n: int, percent: int) -> DataFrame:
    """_id and other columns, cls, n, grams (prefix in the global order, at most about 1 - percent of the set), parts (segment
    sizes, one byte each, 255 for more) of each document; cls and grams are null for an empty set."""
    own = [c for c in docs.columns if c != "_text"]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, h, bounds in _sets(batches, len(own), n):
            size = np.diff(bounds)
            row = np.repeat(np.arange(len(size)), size)
            level = order.level(h)
            shape = (len(size), RARE_PARTS + COMMON_PARTS)
            sizes = np.bincount(row * shape[1] + order.fragment(h, level), minlength=shape[0] * shape[1])
            sizes = np.minimum(sizes, 255).astype(np.uint8).reshape(shape)
            by = np.argsort(row * LEVELS + level, kind="stable")  # hashes are sorted already
            place = np.arange(len(h)) - bounds[:-1][row]
            keep = place < (size - _needed(size, percent) + 1)[row]
            prefix = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(size)))])
            empty = size == 0
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[: len(own)],
                    pa.array(class_ids(h, bounds), mask=empty),
                    pa.array(size.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(prefix, pa.int32()), pa.array(h[by][keep].view(np.int64))),
                    pa.array([x.tobytes() for x in sizes], pa.binary()),
                ],
                names=[*own, "cls", "n", "grams", "parts"],
            )

    return docs.select(*own, "_text").mapInArrow(run, f"{kinds}, cls long, n long, grams array<bigint>, parts binary")


def _segments_allow(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose smaller segments sum to enough over all fragments."""
    sides = pairs
    for x in ("a", "b"):
        sides = sides.join(classes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("parts").alias(f"p{x}")), x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pa_, pb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (4, 5))
            most = np.minimum(pa_, pb).astype(np.int64)
            most[most == 255] = 1 << 40  # both larger than a byte holds
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ok = _enough(np.minimum(most.sum(axis=1), np.minimum(na, nb)), na + nb, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    return sides.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def shared_needed(x: Column, y: Column, percent: int) -> Column:
    """How many n-grams the prefixes of two sets of x and y n-grams share at least, x >= y, if the sets are similar enough.

    All shared n-grams up to the end of the prefix that ends first are in both prefixes; of the set with
    that prefix, at most what follows its prefix can be shared beyond. That is least for the larger set.
    """
    overlap = F.floor((F.lit(percent) * (x + y) + (99 + percent)) / (100 + percent))
    return (overlap - F.floor((F.lit(percent) * x + 99) / 100) + 1).cast("long")


def _common_edges(spark: SparkSession, lists: DataFrame, hot: DataFrame, percent: int, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cls, common) of the classes with common n-grams in their prefixes; edges (a, b) that tie classes; pairs (a, b) that may
    be similar though their prefixes share common n-grams only. ``lists``: (cls, n, gram); ``hot``: (gram)."""
    lists.join(hot, "gram").select("gram", "cls", F.col("n").cast("long").alias("n")).write.parquet(f"{base}/common")
    rows = spark.read.parquet(f"{base}/common")
    own = shared_needed(F.col("n"), F.col("n"), percent)
    rows.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("common")).withColumn("tied", (F.col("common") > FEW) | (F.col("common") >= own)).write.parquet(f"{base}/commons")
    commons = spark.read.parquet(f"{base}/commons")
    rows = rows.drop("n").join(maybe_broadcast(commons, SMALL_SIDE), "cls")
    tied = rows.filter("tied").select("gram", "cls")
    first = tied.groupBy("gram").agg(F.min("cls").alias("a"))
    star = tied.join(first, "gram").select("a", F.col("cls").alias("b"))
    # a class that is not tied: its few common n-grams are enough only for partners of nearly the smallest or the largest size
    x, y, few = F.col("n"), F.col("s"), F.col("common")
    least, most = F.ceil(x * percent / 100).cast("long"), F.floor(x * 100 / percent).cast("long")
    reach = F.ceil(few * (100 + percent) / percent).cast("long") + 3  # sizes beyond the outermost one for which so few are enough
    above = F.ceil(few * (100 * (100 + percent)) / (percent * percent)).cast("long") + 3
    sizes = F.array_union(F.sequence(least, F.least(x, least + reach)), F.sequence(F.greatest(x, most - above), most))
    asked = rows.filter("not tied").select("gram", "cls", "n", "common", F.explode(sizes).alias("s"))
    asked = asked.filter(shared_needed(F.greatest(x, y), F.least(x, y), percent) <= few)
    other = rows.select("gram", F.col("cls").alias("with"), F.col("n").alias("s"), F.col("common").alias("_few"))
    met = asked.join(other, ["gram", "s"]).filter(F.col("cls") != F.col("with"))
    met = met.filter(shared_needed(F.greatest(x, y), F.least(x, y), percent) <= F.col("_few"))
    return commons.select("cls", "common"), star, met.select(F.least("cls", "with").alias("a"), F.greatest("cls", "with").alias("b")).distinct()


def _candidate_edges(spark: SparkSession, classes: DataFrame, percent: int, base: str) -> DataFrame:
    """Edges between classes that may be similar, or between classes and a common n-gram of their prefixes."""
    lists = classes.select("cls", F.col("n").cast("int").alias("n"), F.explode("grams").alias("gram"))
    # a list longer than SHORT_LIST is cut there while it is gathered; its members are read again below
    ranked = lists.withColumn("r", F.row_number().over(Window.partitionBy("gram").orderBy("cls"))).filter(F.col("r") <= SHORT_LIST + 1)
    short = ranked.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("n", "cls"))).alias("l")).filter(F.size("l") > 1)
    short.write.parquet(f"{base}/lists")
    short = spark.read.parquet(f"{base}/lists")
    hot = maybe_broadcast(short.filter(F.size("l") > SHORT_LIST).select("gram"), SMALL_SIDE)
    commons, star, few = _common_edges(spark, lists, hot, percent, base)
    x, y = F.col("x"), F.col("y")
    meet = short.filter(F.size("l") <= SHORT_LIST).select(F.posexplode("l").alias("k", "y"), "l")
    meet = meet.select("y", F.explode(F.slice("l", F.lit(1), F.col("k"))).alias("x")).filter(x["n"].cast("long") * 100 >= y["n"].cast("long") * percent)  # x is no larger than y
    needed = shared_needed(y["n"].cast("long"), x["n"].cast("long"), percent)
    pairs = meet.groupBy(F.least(x["cls"], y["cls"]).alias("a"), F.greatest(x["cls"], y["cls"]).alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.max(needed).alias("needed"))
    for side in ("a", "b"):
        more = maybe_broadcast(commons.select(F.col("cls").alias(side), F.col("common").alias(f"common_{side}")), SMALL_SIDE)
        pairs = pairs.join(more, side, "left")
    both = F.least(F.coalesce("common_a", F.lit(0)), F.coalesce("common_b", F.lit(0)))
    pairs = pairs.filter(F.col("shared") + both >= F.col("needed")).select("a", "b")
    return _segments_allow(pairs.unionByName(few), classes, percent).unionByName(star)


def _blocks(families: DataFrame, percent: int) -> DataFrame:
    """(cls, root, block_a, block_b, in_a, in_b): the class belongs to a block pair of its family.

    A family of at most BLOCK classes is one block. Larger ones are cut into size bands so that
    similar sets lie in the same or the next band, and bands into parts of about BLOCK classes.
    """
    band = F.floor(F.log(F.col("n")) / float(np.log(100.0 / percent)) + 1e-9).cast("int")
    members = families.withColumn("band", band)
    total = members.groupBy("root").agg(F.count(F.lit(1)).alias("total")).filter("total > 1")
    members = members.join(total, "root").withColumn("band", F.when(F.col("total") <= BLOCK, F.lit(0)).otherwise(F.col("band")))
    cut = members.groupBy("root", "band").agg(F.count(F.lit(1)).alias("size")).withColumn("m", F.ceil(F.col("size") / BLOCK).cast("int"))
    beside = [cut.select("root", (F.col("band") + d).alias("band"), F.col("m").alias(name)) for d, name in ((1, "m_before"), (-1, "m_after"))]
    cut = cut.join(beside[0], ["root", "band"], "left").join(beside[1], ["root", "band"], "left").drop("size")
    members = members.join(cut, ["root", "band"]).withColumn("i", F.pmod(F.xxhash64("cls"), F.col("m")).cast("int"))
    own = F.struct(F.col("band").alias("band"), F.col("i").alias("i"))

    def others(shift: int, m: str) -> Column:
        return F.when(F.coalesce(F.col(m), F.lit(0)) > 0, F.transform(F.sequence(F.lit(0), F.col(m) - 1), lambda j: F.struct((F.col("band") + shift).alias("band"), j.alias("i")))).otherwise(F.array().cast("array<struct<band:int,i:int>>"))

    met = F.concat(others(0, "m"), others(-1, "m_before"), others(1, "m_after"))
    # a block's pairs with itself are compared beside those with the block after it, if there is one
    after = F.when(F.col("i") + 1 < F.col("m"), F.struct(F.col("band").alias("band"), (F.col("i") + 1).alias("i")))
    after = after.when(F.coalesce("m_after", F.lit(0)) > 0, F.struct((F.col("band") + 1).alias("band"), F.lit(0).alias("i")))
    rows = members.select("cls", "root", "n", own.alias("own"), after.alias("after"), F.explode(met).alias("other"))
    rows = rows.filter((F.col("own") != F.col("other")) | F.col("after").isNull())
    with_own = (F.col("own") >= F.col("other")) | F.col("other").eqNullSafe(F.col("after"))
    return rows.select("cls", "root", "n", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") <= F.col("other")).alias("in_lo"), with_own.alias("in_hi"))


def overlaps(grams: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """Overlap of every set of ``rows`` with every one of ``cols``: partial counts of one fragment of the
    n-grams after the other, summed (and added to ``total``). N-grams of a single set are left out first.
    All sets may be empty."""
    total = np.zeros((len(rows), len(cols)), np.int32) if total is None else total
    size = np.array([len(g) for g in grams])
    h = np.concatenate(grams)
    if not len(h):  # a range into which no n-gram of these sets falls
        return total
    order = np.argsort(h)
    who = np.repeat(np.arange(len(grams), dtype=np.int32), size)[order]
    h = h[order]
    del order  # these arrays decide a task's memory
    new = np.append(True, h[1:] != h[:-1])
    del h
    shared = ~(new & np.append(new[1:], True))
    gram, who = np.cumsum(new[shared], dtype=np.int32) - 1, who[shared]
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, COLUMNS):  # one fragment
        a, b = np.searchsorted(gram, [low, low + COLUMNS])
        has = np.zeros((len(grams), min(COLUMNS, int(gram[b - 1]) + 1 - low)), np.float32)
        has[who[a:b], gram[a:b] - low] = 1
        np.add(total, has[rows] @ has[cols].T, out=total, casting="unsafe")  # small whole numbers
    return total


def least_linked(links: np.ndarray) -> np.ndarray:
    """Smallest index in the component of each node of a symmetric link matrix."""
    label = np.arange(len(links))
    while True:
        new = np.minimum(label, np.array([label[row].min(initial=len(links)) for row in links]))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _ranges(blocks: DataFrame) -> DataFrame:
    """(root, ranges): how many ranges of hashes the sets of a family are cut into, where it is more than one."""
    grams = blocks.groupBy("root", "lo", "hi").agg(F.sum("n").alias("grams"))
    ranges = grams.groupBy("root").agg(F.ceil(F.max("grams") / RANGE).cast("int").alias("ranges"))
    return ranges.filter("ranges > 1")


def cut_sets(h: np.ndarray, size: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Bounds in ``h`` of the parts of all sets: sets of ``size`` sorted hashes, one after the other, each cut into as
    many equal ranges of hashes as ``ranges`` says. Parts may be empty."""
    row = np.repeat(np.arange(len(size)), size)
    at = ((h >> U64(32)) * ranges.astype(U64)[row]) >> U64(32)
    first = np.cumsum(ranges) - ranges
    return np.concatenate([[0], np.cumsum(np.bincount(first[row] + at.astype(np.int64), minlength=int(ranges.sum())))])


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of all batches, cut where the value of ``column`` changes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch[column].to_numpy()
        cuts = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1), len(value)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and a < b and held[0][column][0].as_py() != value[a]:
                yield pa.Table.from_batches(held)
                held = []
            if a < b:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def links_of_pair(batches: Iterator[pa.RecordBatch], percent: int) -> pa.RecordBatch:
    """(a, b): each class of a block pair with the smallest one it is linked with, directly or through others.

    ``batches``: cls, n, in_lo, in_hi, number, grams of all sets, one range of hashes (``number``) after the other;
    only the rows of one range and of the batch that is read are held.
    """
    cls = None
    for group in runs(batches, "number"):
        found, first = np.unique(group["cls"].to_numpy(), return_index=True)
        if cls is None:
            cls, size = found, group["n"].to_numpy()[first]
            lo, hi = (np.flatnonzero(group[x].to_numpy()[first]) for x in ("in_lo", "in_hi"))
            total = np.zeros((len(lo), len(hi)), np.int32)
        elif not np.array_equal(cls, found):
            raise RuntimeError("the rows of a block pair do not come one range after the other")
        data = group["grams"].combine_chunks()
        flat, at = np.frombuffer(data.buffers()[2] or b"", np.uint8), np.frombuffer(data.buffers()[1], np.int32)[data.offset :]
        overlaps([flat[at[i] : at[i + 1]].view(U64) for i in first], lo, hi, total)
    links = np.zeros((len(cls), len(cls)), bool)
    for i, shared in zip(lo, total, strict=True):
        links[i, hi] = _enough(shared.astype(np.int64), size[i] + size[hi], percent)
    links |= links.T
    np.fill_diagonal(links, True)
    label = least_linked(links)
    some = label != np.arange(len(cls))
    return pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(cls[label[some]])], names=["a", "b"])


def near_duplicates(spark: SparkSession, docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text", with_group: bool = False) -> DataFrame:
    """``id_col``, n_shingles (distinct word n-grams), component_id (smallest id reachable by links).

    Two documents are linked when their sets share ``percent`` of their union or more. A text of fewer
    than ``n`` words has its whole sequence as one member; a null text or one without words has an
    empty set and is linked with nothing (component_id is its own id). One row per row; rows of one id
    are compared like others; a null id never is a component's smallest unless all are null. Other
    columns are ignored, an empty table gives an empty result.

    ``with_group`` adds _text_hash (xxhash64 of the text) and _group, which tells the groups apart also
    where ids are null or repeated; it is null for an empty set.
    """
    base = scratch_path(spark, "fragments")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    more = ["_text_hash"] if with_group else []
    if with_group:
        rows = rows.withColumn("_text_hash", F.xxhash64("_text"))
    order = fit_order(rows, n)
    describe(rows, order, n, percent).withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{base}/described")
    described = spark.read.parquet(f"{base}/described")
    meta = described.select("_id", "cls", "n", *more)
    # one row of each class: copies are equal in all columns but the id
    described.filter("cls is not null").groupBy("cls").agg(F.min("at").alias("_at")).select("_at").write.parquet(f"{base}/first")
    first = spark.read.parquet(f"{base}/first")
    described.join(maybe_broadcast(first, SMALL_SIDE), F.col("at") == F.col("_at")).select("cls", "_id", "n", "grams", "parts").write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")

    edges = _candidate_edges(spark, classes, percent, base)
    families = connected_components(spark, edges).withColumnRenamed("node", "cls").join(classes.select("cls", "n"), "cls")
    _blocks(families, percent).write.parquet(f"{base}/blocks")
    blocks = spark.read.parquet(f"{base}/blocks")
    # each class with its places in blocks, so that a set goes straight from its text to the blocks, in one exchange
    place = F.struct("root", F.struct("lo", "hi").cast("string").alias("pair"), "in_lo", "in_hi")
    cut = blocks.join(_ranges(blocks), "root", "left").withColumn("ranges", F.coalesce("ranges", F.lit(1)))
    places = cut.groupBy("cls", "n", "ranges").agg(F.collect_list(place).alias("places"))
    wanted = places.join(classes.select("cls", F.col("_id").alias("_w")), "cls")
    wanted.write.parquet(f"{base}/wanted")
    wanted = spark.read.parquet(f"{base}/wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, h, bounds in _sets(batches, 4, n):
            own = class_ids(h, bounds) == part.column(0).to_numpy()  # other texts of the same id go
            size, ranges = np.diff(bounds), part.column(3).to_numpy().astype(np.int64)[own]
            h, row = h[np.repeat(own, size)], np.repeat(np.flatnonzero(own), ranges)
            at = pa.array(cut_sets(h, size[own], ranges) * 8, pa.int32())
            grams = pa.Array.from_buffers(pa.binary(), len(row), [None, at.buffers()[1], pa.py_buffer(h)])
            number = np.arange(len(row)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
            kept = [part.column(k).take(pa.array(row)) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(number, pa.int32()), grams], names=["cls", "n", "places", "number", "grams"])

    side = maybe_broadcast(wanted, PLACED_SIDE)
    kind = f"cls long, n long, places {wanted.schema['places'].dataType.simpleString()}, number int, grams binary"
    grams = rows.join(side, rows["_id"].eqNullSafe(F.col("_w"))).select("cls", "n", "places", "ranges", "_text").mapInArrow(sets, kind)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield links_of_pair(batches, percent)

    dealt = grams.select("cls", "n", "number", "grams", F.explode("places").alias("p")).select("cls", "n", "number", "grams", "p.*")
    dealt = dealt.repartition("root", "pair").sortWithinPartitions("root", "pair", "number")
    links = dealt.groupBy("root", "pair").applyInArrow(verify, "a long, b long")
    found = connected_components(spark, links).withColumnsRenamed({"node": "cls", "root": "top"})

    rooted = meta.join(found, "cls", "left").withColumn("top", F.coalesce("top", "cls"))
    least = rooted.filter("top is not null").groupBy("top").agg(F.min("_id").alias("least"))
    out = rooted.join(least, "top", "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "_id").alias("component_id"), *more, *([F.col("top").alias("_group")] if with_group else []))

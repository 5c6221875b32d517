"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is projected to ``DIMS`` random directions, each coordinate is replaced by its quantile
on a grid of 2**BITS cells, shifted, and the cell is numbered along a Hilbert curve; ``CURVES`` curves
use other directions and shifts. Near vectors are often near on one of the curves. The rows of each
curve are range-partitioned and sorted by (key, id), which gives every row its place; the rows within
a window of places around a query are its candidates. Blocks of places are searched one task each:
a query visits every block that its window touches on every curve, candidates are ranked by exact
distance, and the best of all blocks merge.

The width of the window is a share of all places, fitted before the search: a bounded sample of
queries is compared with every row, and the width is the smallest that finds ``RECALL`` of their true
neighbours. Clustered vectors get narrow windows, vectors without structure wide ones.

Equal vectors are searched once: they form a class that stands for its smallest ids (no more than
k + 1 of them can be among the k nearest).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.session import scratch_path

CURVES, DIMS, BITS = 4, 6, 5
BLOCK_ROWS = 4096
SAMPLE_ROWS, SAMPLE_QUERIES = 10_000, 64  # rows the grid is fitted on, queries the width is fitted on
RECALL = 0.95  # of the sample; the promise is 0.9
WIDTHS = np.array([0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0])  # places on each side
SEED = 11


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of cell numbers (rows, dims), as int64.

    Works from the coarsest bit down: the visiting order of the sub-cubes is a Gray code, and in each
    sub-cube the axes are turned and mirrored so that the curve enters where the last one left.
    """
    rows, dims = cells.shape
    entry, turn = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    key, full = np.zeros(rows, np.int64), (1 << dims) - 1

    def right(v: np.ndarray, by: np.ndarray) -> np.ndarray:
        by = by % dims
        return ((v >> by) | (v << (dims - by))) & full

    def left(v: np.ndarray, by: np.ndarray) -> np.ndarray:
        by = by % dims
        return ((v << by) | (v >> (dims - by))) & full

    def gray(i: np.ndarray) -> np.ndarray:
        return i ^ (i >> 1)

    def ones_at_end(i: np.ndarray) -> np.ndarray:
        low = ~i & (i + 1)  # the lowest zero bit
        return np.log2(low.astype(np.float64)).astype(np.int64)

    for bit in range(bits - 1, -1, -1):
        corner = np.zeros(rows, np.int64)
        for d in range(dims):
            corner |= ((cells[:, d].astype(np.int64) >> bit) & 1) << d
        corner = right(corner ^ entry, turn + 1)
        step = corner.copy()  # inverse Gray code
        for shift in (1, 2, 4, 8, 16):
            step ^= step >> shift
        key = (key << dims) | step
        at = np.where(step == 0, 0, gray(2 * ((step - 1) // 2)))
        entry ^= left(at, turn + 1)
        way = np.where(step == 0, 0, np.where(step % 2 == 0, ones_at_end(np.maximum(step - 1, 0)), ones_at_end(step)))
        turn = (turn + way + 1) % dims
    return key


class Grid:
    """Directions, quantile bounds and shifts of all curves, fitted on a sample of vectors."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, bits: int):
        rng = np.random.default_rng(SEED)
        width = sample.shape[1]
        self.bits, self.dims = bits, min(dims, width)
        self.axes = [np.linalg.qr(rng.normal(size=(width, width)))[0][:, : self.dims] for _ in range(curves)]
        cells = 1 << bits
        self.bounds = []
        for axes in self.axes:
            shift = rng.random(self.dims) / cells
            at = np.clip((np.arange(1, cells)[:, None] / cells) - shift, 0, 1)  # the grid lines, shifted
            p = sample @ axes
            self.bounds.append([np.quantile(p[:, d], at[:, d]) for d in range(self.dims)])

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        p = x @ self.axes[curve]
        return hilbert(np.stack([np.searchsorted(self.bounds[curve][d], p[:, d]) for d in range(self.dims)], axis=1), self.bits)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _best(q: np.ndarray, q_class: np.ndarray, x: np.ndarray, x_class: np.ndarray, k: int, near: np.ndarray | None):
    """Per query row: indices of the k nearest rows of another class (all ties of the last), by exact distance."""
    for a in range(0, len(q), 64):
        part = q[a : a + 64]
        rough = (part * part).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2.0 * part @ x.T
        rough[q_class[a : a + 64][:, None] == x_class[None, :]] = np.inf
        if near is not None:
            rough[~near[a : a + 64]] = np.inf
        for j in range(len(part)):
            r = rough[j]
            found = np.isfinite(r).sum()
            if not found:
                continue
            last = np.partition(r, min(k, found) - 1)[min(k, found) - 1]
            some = np.flatnonzero(r <= last + 1e-9 * (1.0 + abs(last)))
            yield a + j, some, np.sqrt(((x[some] - part[j]) ** 2).sum(1))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """_id, _v (array of double) of the vectors that take part: no null, no non-finite component, not zero."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), v.alias("_v")).filter("_id is not null and _v is not null and size(_v) > 0")
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(fine & F.exists("_v", lambda x: x != 0))


def search(spark: SparkSession, vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The k nearest rows of each query row: query_id, rank, vec_id, score (Euclidean distance).

    ``is_query``: a condition on the id column named _id. Vectors that are null, zero, or hold a null
    or non-finite component take no part. Vectors of each length are searched among themselves.
    Repeated ids count as one row (the smallest vector). Ties go to the smaller id. Fewer
    than k other rows give fewer results, an empty table none. Other columns are ignored.
    """
    rows = usable(vectors, id_col, vec_col).groupBy("_id").agg(F.min("_v").alias("_v"))
    sizes = rows.groupBy(F.size("_v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).collect()  # a row a length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    large = [r["width"] for k, r in enumerate(sizes) if k == 0 or r["n"] > BLOCK_ROWS]
    found = [_search_curves(spark, rows.filter(F.size("_v") == width), is_query, k, recall) for width in large]
    if len(large) < len(sizes):
        found.append(_search_small(rows.filter(~F.size("_v").isin(large)), is_query, k))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _search_small(rows: DataFrame, is_query, k: int) -> DataFrame:
    """Exact search of every length that at most BLOCK_ROWS vectors have; one task a length."""

    def near(group: pa.Table) -> pa.Table:
        ids, asked = group["_id"].to_numpy(), group["_asked"].to_numpy()
        x = _matrix(group["_v"].combine_chunks())
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0))]
        for j in np.flatnonzero(asked):
            d = np.sqrt(((x - x[j]) ** 2).sum(axis=1))
            best = np.lexsort((ids, d))
            best = best[best != j][:k]
            out.append((np.full(len(best), ids[j]), np.arange(1, len(best) + 1, dtype=np.int32), ids[best], d[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "rank", "vec_id", "score"])

    asked = F.coalesce(is_query, F.lit(False)).alias("_asked")
    rows = rows.select("_id", "_v", asked, F.size("_v").alias("_width"))
    return rows.groupBy("_width").applyInArrow(near, "query_id long, rank int, vec_id long, score double")


def _search_curves(spark: SparkSession, rows: DataFrame, is_query, k: int, recall: float) -> DataFrame:
    """Search along the curves: _id and _v of vectors of one length."""
    base = scratch_path(spark, "ann")
    # a class of equal vectors: its smallest ids; the window keeps k + 1 rows of each map task
    order = Window.partitionBy("_v").orderBy("_id")
    small = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    small.write.parquet(f"{base}/rows")
    small = spark.read.parquet(f"{base}/rows")
    classes = small.filter("_n = 1").select(F.col("_id").alias("cls"), F.col("_v").alias("v"))
    members = small.join(classes.select("cls", F.col("v").alias("_v")), "_v").select("cls", "_id")
    queries = rows.filter(is_query).join(classes.select("cls", F.col("v").alias("_v")), "_v").select("_id", "cls")
    asked = classes.join(queries.select("cls").distinct(), "cls", "left_semi")

    # fit the grid and the width on bounded samples: the rows of smallest hash
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE_ROWS).select("v").toArrow()
    grid = Grid(_matrix(sample["v"].combine_chunks()), CURVES, DIMS, BITS)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            for c in range(CURVES):
                yield pa.RecordBatch.from_arrays([pa.array([c] * b.num_rows, pa.int32()), pa.array(grid.keys(x, c)), b.column(0), b.column(1)], names=["curve", "key", "cls", "v"])

    n = classes.count()
    parts = max(CURVES, -(-n * CURVES // (4 * BLOCK_ROWS)))
    sorted_ = classes.select("cls", "v").mapInArrow(keyed, "curve int, key long, cls long, v array<double>")
    sorted_ = sorted_.repartitionByRange(parts, "curve", "key", "cls").sortWithinPartitions("curve", "key", "cls")
    sorted_.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{base}/sorted")
    placed = spark.read.parquet(f"{base}/sorted")
    # a row's place on its curve: its place in its partition and curve, plus the rows of the curve before
    runs = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    runs = runs.withColumn("before", F.sum("n").over(Window.partitionBy("curve").orderBy("part")) - F.col("n")).select("curve", "part", "first", "before")
    placed = placed.join(runs, ["curve", "part"]).select("curve", "cls", "v", (F.col("at") - F.col("first") + F.col("before")).alias("place"))
    placed.write.parquet(f"{base}/placed")
    placed = spark.read.parquet(f"{base}/placed")

    width_share = _fit_width(spark, placed, asked, n, k, recall)
    reach = max(2 * k, int(np.ceil(width_share * n)))
    blocks = placed.withColumn("block", F.floor(F.col("place") / BLOCK_ROWS).cast("int"))
    # the visitors of a block are dealt to as many tasks as keep each small
    chunks = max(1, -(-asked.count() // BLOCK_ROWS))
    blocks = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    spots = spark.read.parquet(f"{base}/placed").join(asked.select("cls"), "cls", "left_semi")
    low, high = F.greatest(F.col("place") - reach, F.lit(0)), F.least(F.col("place") + reach, F.lit(n - 1))
    visits = spots.select("curve", "cls", "v", "place", F.explode(F.sequence(F.floor(low / BLOCK_ROWS).cast("int"), F.floor(high / BLOCK_ROWS).cast("int"))).alias("block"))
    visits = visits.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.lit(chunks)).cast("int"))

    def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_x, out_d = [], [], []
        if left.num_rows and right.num_rows:
            q, x = _matrix(left["v"].combine_chunks()), _matrix(right["v"].combine_chunks())
            qc, xc = left["cls"].to_numpy(), right["cls"].to_numpy()
            near = np.abs(left["place"].to_numpy()[:, None] - right["place"].to_numpy()[None, :]) <= reach
            for j, some, d in _best(q, qc, x, xc, k, near):
                keep = np.lexsort((xc[some], d))[:k]
                out_q.append(np.full(len(keep), qc[j]))
                out_x.append(xc[some][keep])
                out_d.append(d[keep])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"q": join(out_q, pa.int64()), "cls": join(out_x, pa.int64()), "score": join(out_d, pa.float64())})

    found = visits.groupBy("curve", "block", "chunk").cogroup(blocks.groupBy("curve", "block", "chunk")).applyInArrow(ranked, "q long, cls long, score double")
    found = found.groupBy("q", "cls").agg(F.min("score").alias("score"))  # several curves find the same class
    top = Window.partitionBy("q").orderBy("score", "cls")
    found = found.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k).drop("r")
    own = asked.select(F.col("cls").alias("q"), F.col("cls"), F.lit(0.0).alias("score"))  # equal vectors
    ids = found.unionByName(own).join(members, "cls").select("q", "score", F.col("_id").alias("vec_id"))
    # at most (k + 1)**2 rows a class; per query its own id goes
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    ids = ids.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")
    pairs = queries.join(ids, queries["cls"] == ids["q"]).filter(F.col("_id") != F.col("vec_id"))
    order = Window.partitionBy("_id").orderBy("score", "vec_id")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return pairs.select(F.col("_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _fit_width(spark: SparkSession, placed: DataFrame, asked: DataFrame, n: int, k: int, recall: float) -> float:
    """Smallest share of places on each side that finds ``recall`` of the true neighbours of a bounded
    sample of query classes, each compared with every row."""
    probe = asked.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE_QUERIES).toArrow()
    if n <= 2 * k or not probe.num_rows:
        return 1.0
    q, qc = _matrix(probe["v"].combine_chunks()), probe["cls"].to_numpy()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, xc = _matrix(b.column(1)), b.column(0).to_numpy()
            for j, some, d in _best(q, qc, x, xc, k, None):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), qc[j])), pa.array(xc[some]), pa.array(d)], names=["q", "cls", "d"])

    rows = placed.filter("curve = 0").select("cls", "v").mapInArrow(near, "q long, cls long, d double")
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("d", "cls"))).filter(F.col("r") <= k).select("q", "cls")
    near_q = placed.select("curve", F.col("cls").alias("q"), F.col("place").alias("pq"))
    gaps = best.join(near_q, "q").join(placed.select("curve", "cls", "place"), ["curve", "cls"])
    gaps = gaps.groupBy("q", "cls").agg(F.min(F.abs(F.col("place") - F.col("pq"))).alias("gap")).select("gap").toArrow()["gap"].to_numpy()
    share = (gaps[:, None] <= np.maximum(2 * k, np.ceil(WIDTHS * n))[None, :]).mean(axis=0)
    return float(WIDTHS[np.argmax(share >= recall)])

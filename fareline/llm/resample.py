"""Importance resampling towards a target corpus: array-scored weights, Gumbel noise, radix sort.

Features are runs of one and two words, hashed into buckets. Counting both corpora gives every bucket a
gain (how much likelier the target is to use it); a document's weight is the mean gain of its features,
looked up in one array. Weight plus noise drawn from the id orders the documents, so the best share of
them is a sample without replacement.

The order comes from a distributed radix sort, least significant digit first. Rows lie in blocks of
consecutive places. A pass counts digits per block, turns the counts into global prefix offsets (digit
before block) and sends every row to the offset of its digit and block plus its place among the rows of
that digit in the block: a stable counting sort. The places after the last pass are the ranks.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.llm.text import ALNUM, LOWER, spans, utf8, words_per_text
from fareline.session import scratch_path

BUCKETS = 10_000
PIECE = 1 << 20
LONG_WORD = 64  # bytes; the checksums of longer words are taken one by one
DIGIT_BITS = 12
BLOCK_ROWS = 1 << 18


# --- features --------------------------------------------------------------------------------


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def _shift_tables() -> np.ndarray:
    """[length, byte, value]: what a checksum's byte becomes after ``length`` zero bytes."""
    now = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    out = [now]
    for _ in range(LONG_WORD):
        now = _CRC[now & 255] ^ (now >> 8)
        out.append(now)
    return np.stack(out)


_SHIFT = _shift_tables()


def word_crcs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each word: one step for the k-th byte of all words that have one."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")
    order = order[np.searchsorted(-size[order], -LONG_WORD) :] if (size > LONG_WORD).any() else order
    at, left = starts[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(left.max(initial=0))):
        m = np.searchsorted(-left, -k, side="left")  # words of more than k bytes come first
        crc[:m] = _CRC[(crc[:m] ^ buf[at[:m] + k]) & 255] ^ (crc[:m] >> 8)
    out = np.zeros(len(starts), np.uint32)
    out[order] = ~crc
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = zlib.crc32(buf[starts[k] : ends[k]])
    return out


def pair_crcs(first: np.ndarray, second: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of "a b" from those of a and b: the checksum of "a " moved on by the bytes of b."""
    crc = ~first
    crc = ~(_CRC[(crc ^ 0x20) & 255] ^ (crc >> 8))
    size = ends - starts
    n = np.minimum(size, LONG_WORD)
    moved = np.zeros(len(crc), np.uint32)
    for k in range(4):
        moved ^= _SHIFT[n, k, (crc >> np.uint32(8 * k)) & 255]
    out = moved ^ second
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = zlib.crc32(buf[starts[k] : ends[k]], int(crc[k]))
    return out


def _pieces(buf: np.ndarray, off: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, bool]]:
    """(bytes in lower case, offsets, first row, does it go on from the piece before?): whole texts, or parts
    of a long one that end beside a word."""
    row, n = 0, len(off) - 1
    while row < n:
        end = min(n, max(row + 1, int(np.searchsorted(off, off[row] + most, side="right")) - 1))
        a, b = int(off[row]), int(off[end])
        if b - a <= most:
            yield LOWER[buf[a:b]], off[row : end + 1] - a, row, False
        else:
            at = a
            while at < b:
                stop = min(b, at + most)
                while stop < b and ALNUM[LOWER[buf[stop]]]:
                    ahead = buf[stop : min(b, stop + most)]
                    gap = np.flatnonzero(~ALNUM[LOWER[ahead]])
                    stop += int(gap[0]) if len(gap) else len(ahead)
                part = LOWER[buf[at:stop]]
                yield part, np.array([0, len(part)]), row, at > a
                at = stop
        row = end


def features(column: pa.Array, buckets: int = BUCKETS, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of words, buckets of words, rows of pairs, buckets of pairs), piece by piece."""
    buf, off = utf8(column)
    last = None  # checksum of the last word of the piece before
    for part, at, row, goes_on in _pieces(buf, off, piece):
        starts, ends = spans(part, at, ALNUM)
        counts = np.diff(words_per_text(starts, at))
        rows = row + np.repeat(np.arange(len(counts)), counts)
        crc = word_crcs(part, starts, ends)
        second = np.flatnonzero(rows[1:] == rows[:-1]) + 1
        before = crc[second - 1]
        if goes_on and last is not None and len(crc):
            second, before = np.append(0, second), np.append(last, before)
        pair = pair_crcs(before, crc[second], part, starts[second], ends[second])
        if len(crc):
            last = crc[-1]
        elif not goes_on:
            last = None
        yield rows, (crc % buckets).astype(np.int64), rows[second], (pair % buckets).astype(np.int64)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts: one array a task, summed in Spark; at most ``buckets`` rows
    reach the driver."""

    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, one, _, two in features(batch.column(0), buckets, piece):
                total += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, floored."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (s_all + k)) / ((s + 1.0) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: int, doc_id) -> int:
    """A standard Gumbel variate times 1000, floored, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gain: np.ndarray, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_features, weight, score."""

    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, pairs, total = (np.zeros(n, np.int64) for _ in range(3))
            for row1, one, row2, two in features(batch.column(1), len(gain), piece):
                words += np.bincount(row1, minlength=n)
                pairs += np.bincount(row2, minlength=n)
                np.add.at(total, row1, gain[one])
                np.add.at(total, row2, gain[two])
            count = words + pairs
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            drawn = np.array([noise(seed, i) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, count, weight, weight + drawn))], names=[id_col, "n_words", "n_features", "weight", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long, score long")


# --- radix sort ------------------------------------------------------------------------------


def _move(block: pa.Table, offsets: pa.Table) -> pa.Table:
    """New places of the rows of one block: offset of the digit plus the place among the digit's rows."""
    place, digit = block.column("_place").to_numpy(), block.column("_digit").to_numpy()
    base = dict(zip(offsets.column("_d").to_pylist(), offsets.column("_offset").to_pylist()))
    order = np.lexsort((place, digit))
    ordered = digit[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    new = np.empty(len(order), np.int64)
    new[order] = np.array([base[d] for d in ordered[first].tolist()], np.int64)[np.cumsum(first) - 1] + np.arange(len(order)) - start
    keep = block.drop_columns(["_block", "_digit", "_place"])
    return keep.append_column("_place", pa.array(new))


def radix_sort(spark: SparkSession, rows: DataFrame, keys: list[str], digit_bits: int | None = None, block_rows: int | None = None) -> DataFrame:
    """``rows`` with _place: 0, 1, 2... in ascending order of ``keys`` (most significant first).

    Keys are non-negative longs; as many passes as their largest values have digits. Rows equal in all
    keys keep the order in which they were read. No row meets more than ``block_rows`` others, whatever
    the keys are. Every pass is written to the shared folder; an empty table gives no rows.
    """
    bits, block_rows = digit_bits or DIGIT_BITS, block_rows or BLOCK_ROWS
    path, step = scratch_path(spark, "radix"), 0

    def stored(df: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        df.write.parquet(f"{path}/{step}")
        return spark.read.parquet(f"{path}/{step}")

    now = stored(rows.withColumn("_place", F.monotonically_increasing_id()))
    most = now.agg(*(F.max(k).alias(k) for k in keys)).first()
    kinds = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields] + [("_place", "bigint")]
    schema = ", ".join(f"`{n}` {t}" for n, t in kinds)
    passes = [(k, shift) for k in reversed(keys) for shift in range(0, (most[k] or 0).bit_length(), bits)]
    for key, shift in passes or [(keys[0], 0)]:  # one pass at least: it makes the places dense
        cut = now.withColumn("_digit", F.shiftright(key, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("long"))
        cut = cut.withColumn("_block", F.expr(f"_place div {block_rows}"))
        count = cut.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_n"))
        total = {r["_digit"]: r["_n"] for r in count.groupBy("_digit").agg(F.sum("_n").alias("_n")).collect()}  # 2**bits rows at most
        base, before = [], 0
        for digit in sorted(total):
            base.append((digit, before))
            before += total[digit]
        bases = F.broadcast(spark.createDataFrame(base, "_digit long, _base long"))
        within = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
        offsets = count.withColumn("_in", within).join(bases, "_digit").select(F.col("_digit").alias("_d"), F.col("_block").alias("_b"), (F.col("_base") + F.col("_in")).alias("_offset"))
        now = stored(cut.groupBy("_block").cogroup(offsets.groupBy("_b")).applyInArrow(_move, schema))
    return now


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS
) -> DataFrame:
    """Ranks of the documents drawn towards the texts of ``target``.

    Per row of ``docs``: id (as long), n_features, weight, score, rank (1 for the best; null if not drawn).
    Of the N rows with ``least_words`` words or more, floor(percent * N / 100) are drawn by score, ties to
    the smaller id, null ids last; rows alike in score and id keep the order in which they are read. Null
    texts have no words, a null id counts as empty in its hash. Other columns are ignored. An empty
    table gives no rows; an empty target only smooths.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    gain = gains(bucket_counts(docs, "_text", buckets), bucket_counts(target, target_text, buckets))
    path = scratch_path(spark, "scores")
    score_documents(docs, gain, seed, "_id", "_text").write.parquet(path)
    scored = spark.read.parquet(path)
    able = scored.where(F.col("n_words") >= least_words)
    known = able.agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top"), F.min(F.shiftright("_id", 32)).alias("low")).first()
    able = able.select(
        "*",
        (F.lit(known["top"] or 0) - F.col("score")).alias("_score"),
        F.col("_id").isNull().cast("long").alias("_last"),
        F.coalesce(F.shiftright("_id", 32) - F.lit(known["low"] or 0), F.lit(0)).alias("_high"),
        F.coalesce(F.col("_id").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0)).alias("_low"),
    )
    ranked = radix_sort(spark, able, ["_score", "_last", "_high", "_low"])
    ranked = ranked.withColumn("rank", F.when(F.col("_place") < known["n"] * percent // 100, F.col("_place") + 1))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    cols = [F.col("_id").alias(id_col), "n_features", "weight", "score", "rank"]
    return ranked.select(*cols).unionByName(rest.select(*cols))

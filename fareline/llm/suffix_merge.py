"""Repeated passages by a distributed, common-prefix-aware merge sort of sampled suffixes.

A window is a string of ``length`` bytes. Its anchor is the place inside it where the gram of ``gram``
bytes has the smallest hash (the first of equal ones), so equal windows have their anchor at the same
distance from their start, and consecutive windows mostly share one. Every anchor whose gram occurs
more than once gives one suffix: the bytes from the anchor to the end of its last window, with the
bytes from its first window to the anchor beside it.

Sorting: every task sorts its suffixes into runs and cuts each run by ranges of the gram's fingerprint
(equal grams meet in one range). The runs are exchanged front-coded (length of the prefix shared with
the suffix before, then the rest) and merged by a loser tree that keeps common-prefix lengths and
compares from there on, so no known prefix is compared again. The merged order has the length of the
prefix that neighbours share, hence for every distance ``a`` the suffixes that agree in their first
``length - a`` bytes; two of them that also agree in the ``a`` bytes before the anchor are a repeated
window.

Skew: equal texts are sorted once, equal suffixes with equal bytes before them once a run. Grams that
occur more than ``HOT`` times are not brought together: their windows are spread by 128-bit hashes of
all their bytes and counted with partial sums.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.text import U64, hashes, mix, slices, utf8, _BYTES, _power
from fareline.session import scratch_path

GRAM = 50
HOT = 20_000  # anchors of one gram that may meet in one range
RUN = 65_536  # suffixes in one sorted run
RANGE = 50_000  # suffixes in one range, about
PIECE = 1 << 20
_PLACE = U64((1 << 21) - 1)  # places inside a piece
_STEP = U64(0x9E3779B97F4A7C15)


# --- anchors ---------------------------------------------------------------------------------


def pieces(column: pa.Array, length: int, most: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first row, place of the bytes in their text): whole texts, or overlapping pieces
    of a long one, such that each window lies in exactly one piece."""
    buf, off = utf8(column)
    for a, b in slices(off, most):
        size = int(off[b] - off[a])
        if size <= most:
            yield buf[off[a] : off[b]], off[a : b + 1] - off[a], a, 0
            continue
        for at in range(0, size - length + 1, most):
            part = buf[off[a] + at : off[a] + min(size, at + most + length - 1)]
            yield part, np.array([0, len(part)]), a, at


def anchors(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, first window, anchor, last window) of each anchor; windows lie inside one text."""
    n, wide = len(buf), length - gram + 1
    if n < length:
        return np.zeros(0, U64), *(np.zeros(0, np.int64),) * 3
    run = np.zeros(n + 1, U64)
    np.cumsum(_BYTES[buf] * _power("up", n), out=run[1:])
    h = mix((run[gram:] - run[:-gram]) * _power("down", n)[: n - gram + 1])
    value = (h & ~_PLACE) | np.arange(len(h), dtype=U64)
    # smallest of each ``wide`` neighbours, from running minima of blocks in both directions
    blocks = np.concatenate([value, np.full(-len(value) % wide, ~U64(0))]).reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = (np.minimum(back[:windows], ahead[wide - 1 : wide - 1 + windows]) & _PLACE).astype(np.int64)
    inside = np.zeros(windows + 1, np.int64)  # windows that start and end in one text
    lo, hi = off[:-1], np.maximum(off[1:] - length + 1, off[:-1])
    np.add.at(inside, np.minimum(lo, windows), 1)
    np.add.at(inside, np.minimum(hi, windows), -1)
    starts = np.flatnonzero(np.cumsum(inside)[:windows] > 0)
    if not len(starts):
        return np.zeros(0, U64), *(np.zeros(0, np.int64),) * 3
    p = least[starts]
    new = np.ones(len(starts), bool)
    text = np.searchsorted(off, starts, side="right")
    new[1:] = (p[1:] != p[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return h[p[first]], starts[first], p[first], starts[last]


def _in(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def _listed(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.unique(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def _grams(length: int, gram: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (batch.column(k).to_numpy() for k in (0, 1))
            for buf, off, row, _ in pieces(batch.column(2), length, piece):
                g, s0, _, _ = anchors(buf, off, length, gram)
                rows = row + np.searchsorted(off, s0, side="right") - 1
                order = np.lexsort((g, rows))
                g, rows = g[order], rows[order]
                new = np.ones(len(g), bool)
                new[1:] = (g[1:] != g[:-1]) | (rows[1:] != rows[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(g)))
                yield _batch(gram=g[first].view(np.int64), t1=t1[rows[first]], t2=t2[rows[first]], n=n.astype(np.int64))

    return run


# --- runs ------------------------------------------------------------------------------------


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in their first ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


def front_code(entries: list[tuple]) -> bytes:
    """Sorted (suffix, bytes before, t1, t2, first window) as one binary run."""
    lcp, rest, before, last = [], [], [], b""
    for suffix, left, *_ in entries:
        same = shared(last, suffix)
        lcp.append(same)
        rest.append(suffix[same:])
        before.append(left)
        last = suffix
    sizes = np.array([lcp, [len(r) for r in rest], [len(x) for x in before]], "<u4")
    ids = np.array([e[2:5] for e in entries], "<i8").reshape(-1, 3)
    return b"".join((np.array([len(entries)], "<i8").tobytes(), sizes.tobytes(), ids.tobytes(), *rest, *before))


def decode(run: bytes) -> tuple[list[bytes], np.ndarray, list[bytes], np.ndarray]:
    """(suffixes, shared prefix with the one before, bytes before them, ids) of a front-coded run."""
    n = int(np.frombuffer(run, "<i8", 1)[0])
    lcp, size, left = np.frombuffer(run, "<u4", 3 * n, 8).reshape(3, n)
    ids = np.frombuffer(run, "<i8", 3 * n, 8 + 12 * n).reshape(n, 3)
    at, out, before, last = 8 + 36 * n, [], [], b""
    for same, more in zip(lcp.tolist(), size.tolist()):
        last = last[:same] + run[at : at + more]
        out.append(last)
        at += more
    for more in left.tolist():
        before.append(run[at : at + more])
        at += more
    return out, lcp, before, ids


def _runs(length: int, gram: int, ranges: int, piece: int, most: int):
    """Sorted front-coded runs: (range, run). Equal suffixes with equal bytes before them are repeated windows
    already; they go on as rows (t1, t2, windows) and one of them stays in the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, bytes], list] = {}

        def out() -> pa.RecordBatch:
            by_range: dict[int, list] = {}
            found = []
            for (suffix, left), (where, t1, t2, first, others) in seen.items():
                by_range.setdefault(where, []).append((suffix, left, t1, t2, first))
                if others:
                    last = first + len(left) + len(suffix) - length
                    found.append((where, t1, t2, first, last))
                    found.extend((where, a, b, f, f + last - first) for a, b, f in others)
            seen.clear()
            made = [(k, front_code(sorted(v))) for k, v in by_range.items()]
            cols = list(zip(*found)) or [()] * 5
            n, m = len(found), len(made)
            return _batch(
                range=pa.array([*cols[0], *(k for k, _ in made)], pa.int32()),
                t1=pa.array([*cols[1], *[None] * m], pa.int64()),
                t2=pa.array([*cols[2], *[None] * m], pa.int64()),
                windows=pa.array([*((f << 32) | last for f, last in zip(cols[3], cols[4])), *[None] * m], pa.int64()),
                run=pa.array([*[None] * n, *(r for _, r in made)], pa.binary()),
            )

        for batch in batches:
            t1, t2 = (batch.column(k).to_pylist() for k in (0, 1))
            listed, hot = _listed(batch.column(3)), _listed(batch.column(4))
            for buf, off, row, base in pieces(batch.column(2), length, piece):
                g, s0, p, s1 = anchors(buf, off, length, gram)
                take = _in(g.view(np.int64), listed) & ~_in(g.view(np.int64), hot)
                g, s0, p, s1 = g[take], s0[take], p[take], s1[take]
                text = np.searchsorted(off, s0, side="right") - 1
                where = (mix(g ^ _STEP) % U64(ranges)).astype(np.int64).tolist()
                data = buf.tobytes()
                for k, r, a, m, b, first in zip(where, text.tolist(), s0.tolist(), p.tolist(), s1.tolist(), (s0 - off[text] + base).tolist()):
                    key = data[m : b + length], data[a:m]
                    have = seen.get(key)
                    if have is None:
                        seen[key] = [k, t1[row + r], t2[row + r], first, []]
                    else:
                        have[4].append((t1[row + r], t2[row + r], first))
                if len(seen) >= most:
                    yield out()
        yield out()

    return run


# --- merging ---------------------------------------------------------------------------------


def merge(runs: list[tuple[list[bytes], np.ndarray]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Loser tree over sorted runs with common-prefix lengths: (run, place) in order, and what each shares
    with the one before.

    Every run's head knows how much it shares with the last string put out. Of two heads the one that
    shares more is smaller; only equal lengths are compared, from there on, and the loser keeps the
    length it shares with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    knows, at = [0] * k, [0] * k
    rest = [r[1].tolist() for r in runs]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's length is set to what it shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        i, j = knows[a], knows[b]
        if i > j:
            return a, b
        if i < j:
            return b, a
        same = shared(x, y, i)
        if x[same:] <= y[same:]:
            knows[b] = same
            return a, b
        knows[a] = same
        return b, a

    losers, level = [0] * k, list(range(k))
    size = k
    while size > 1:
        size //= 2
        won = []
        for i in range(size):
            w, lost = play(level[2 * i], level[2 * i + 1])
            losers[size + i] = lost
            won.append(w)
        level = won
    top = level[0]
    order, lcp = [], []
    while heads[top] is not None:
        place = at[top]
        order.append((top, place))
        lcp.append(knows[top])
        place += 1
        at[top] = place
        strings = runs[top][0]
        if place < len(strings):
            heads[top], knows[top] = strings[place], rest[top][place]
        else:
            heads[top] = None
        node = (k + top) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2
    return order, lcp


def repeated_windows(lcp: np.ndarray, size: np.ndarray, before: list[bytes], length: int) -> np.ndarray:
    """Boolean (suffix, distance): is the window that starts ``distance`` bytes before the suffix repeated?

    ``lcp``: what each suffix of the sorted order shares with the one before; ``size``: its bytes. A
    window at distance a needs the suffix's first ``length - a`` bytes and the last a of ``before``.
    """
    n, have = len(lcp), np.array([len(b) for b in before], np.int64)
    far = int(have.max(initial=0))
    left = np.frombuffer(b"".join(b[::-1].ljust(far, b"\0") for b in before), np.uint8).reshape(n, far)
    out = np.zeros((n, far + 1), bool)
    h = np.zeros(n, U64)
    for a in range(far + 1):
        if a:
            h = (h + _BYTES[left[:, a - 1]]) * _STEP
        active = np.flatnonzero((have >= a) & (size >= length - a))
        if len(active) < 2:
            continue
        group = np.cumsum(lcp < length - a)[active]
        key = mix(h[active] ^ mix(group.astype(U64)))
        order = np.argsort(key)
        key, group = key[order], group[order]
        same = np.flatnonzero((key[1:] == key[:-1]) & (group[1:] == group[:-1]))
        out[active[order[same]], a] = True
        out[active[order[same + 1]], a] = True
    return out


def _merge_range(length: int):
    schema = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("windows", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        made = group.column("run")
        known = group.filter(pc.is_null(made)).select(["t1", "t2", "windows"])
        runs = [decode(r.as_py()) for r in made if r.is_valid]
        if not runs:
            return known.cast(schema)
        order, lcp = merge([r[:2] for r in runs])
        size = np.array([len(runs[r][0][i]) for r, i in order], np.int64)
        before = [runs[r][2][i] for r, i in order]
        ids = np.array([runs[r][3][i] for r, i in order])
        hit = repeated_windows(np.array(lcp, np.int64), size, before, length)
        # runs of neighbouring windows: distance a is the window that starts at first + len(before) - a
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        at, near = np.nonzero(edge == 1)
        far = np.nonzero(edge == -1)[1] - 1
        place = ids[at, 2] + np.array([len(b) for b in before], np.int64)[at]
        found = pa.table([ids[at, 0], ids[at, 1], ((place - far) << 32) | (place - near)], schema=schema)
        return pa.concat_tables([known.cast(schema), found])

    return run


# --- windows of hot grams --------------------------------------------------------------------


def _hot_windows(length: int, gram: int, piece: int):
    """Each window of a hot gram: 128 bits of its bytes, its place, and is it known to be repeated?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (batch.column(k).to_numpy() for k in (0, 1))
            hot = _listed(batch.column(4))
            for buf, off, row, base in pieces(batch.column(2), length, piece):
                g, s0, _, s1 = anchors(buf, off, length, gram)
                take = _in(g.view(np.int64), hot)
                n = (s1 - s0 + 1)[take]
                at = np.repeat(s0[take] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                half = length // 2
                h1, h2 = hashes(buf, at, at + half), hashes(buf, at + half, at + length)
                order = np.lexsort((h2, h1))
                h1, h2, at = h1[order], h2[order], at[order]
                again = np.zeros(len(at), bool)
                again[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
                known = again.copy()
                known[:-1] |= again[1:]
                text = np.searchsorted(off, at, side="right") - 1
                place = at - off[text] + base
                yield _batch(h1=h1.view(np.int64), h2=h2.view(np.int64), t1=t1[row + text], t2=t2[row + text], windows=(place << 32) | place, known=known, again=again)

    return run


# --- the operator ----------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2"))


def distinct_texts(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The different texts (t1, t2, text, copies), stored in buckets of their 128-bit key: every later join of
    the texts goes bucket by bucket and does not move them again."""
    texts = _keyed(docs, id_col, text_col).groupBy("t1", "t2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"fareline_texts_{uuid.uuid4().hex}"
    texts.write.bucketBy(buckets, "t1", "t2").sortBy("t1", "t2").option("compression", "zstd").option("path", path).format("parquet").saveAsTable(name)
    stored = spark.table(name)
    stored.schema  # resolved: the files stay when the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored


def repeated(spark: SparkSession, texts: DataFrame, path: str, length: int = 200, gram: int = GRAM) -> DataFrame:
    """(t1, t2, windows): runs of windows that also start anywhere else, first << 32 | last start."""
    long_ = texts.where(F.octet_length("text") >= length)
    grams = long_.select("t1", "t2", "text").mapInArrow(_grams(length, gram, PIECE), "gram long, t1 long, t2 long, n long")
    often = grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").withColumnRenamed("n", "all")
    listed = grams.select("gram", "t1", "t2").join(often, "gram")
    listed = listed.groupBy("t1", "t2").agg(F.collect_list("gram").alias("grams"), F.collect_list(F.when(F.col("all") > HOT, F.col("gram"))).alias("hot"))
    listed.write.parquet(f"{path}/grams")
    listed = spark.read.parquet(f"{path}/grams")
    suffixes = listed.agg(F.sum(F.size("grams"))).first()[0] or 0
    both = long_.select("t1", "t2", "text").join(listed, ["t1", "t2"]).select("t1", "t2", "text", "grams", "hot")
    runs = both.mapInArrow(_runs(length, gram, max(1, -(-suffixes // RANGE)), PIECE, RUN), "range int, t1 long, t2 long, windows long, run binary")
    found = runs.groupBy("range").applyInArrow(_merge_range(length), "t1 long, t2 long, windows long")
    found.write.parquet(f"{path}/windows/of=runs")
    if not listed.where(F.size("hot") > 0).isEmpty():
        schema = "h1 long, h2 long, t1 long, t2 long, windows long, known boolean, again boolean"
        both.where(F.size("hot") > 0).mapInArrow(_hot_windows(length, gram, PIECE), schema).write.parquet(f"{path}/hot")
        hot = spark.read.parquet(f"{path}/hot")
        one = hot.where("not again")  # one of those that a piece of text has, so a window of many copies is few rows
        more = one.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
        rest = one.where("not known").join(more, ["h1", "h2"], "left_semi")
        hot.where("known").select("t1", "t2", "windows").unionByName(rest.select("t1", "t2", "windows")).write.parquet(f"{path}/windows/of=hot")
    return spark.read.parquet(f"{path}/windows").select("t1", "t2", "windows")


def spans(windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes (starts, ends) of packed window runs; touching ones are one."""
    w = np.sort(windows)
    first, end = w >> 32, np.maximum.accumulate((w & 0xFFFFFFFF) + length)
    new = np.ones(len(w), bool)
    new[1:] = first[1:] > end[:-1]
    return first[new], end[np.append(np.flatnonzero(new)[1:], len(w)) - 1] if len(w) else first


def _cut(length: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = utf8(batch.column(2))
            removed, many, kept = [], [], []
            for k, (copies, windows) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4))):
                text = buf[off[k] : off[k + 1]]
                if copies > 1 and len(text) >= length:
                    first, end = np.array([0]), np.array([len(text)])
                elif not windows.is_valid:
                    first = end = np.zeros(0, np.int64)
                else:
                    first, end = spans(windows.values.to_numpy(), length)
                edges = np.concatenate([[0], np.column_stack([first, end]).ravel(), [len(text)]]).astype(np.int64).reshape(-1, 2)
                left = b"".join(text[a:b].tobytes() for a, b in edges)
                removed.append(len(text) - len(left))
                many.append(len(first))
                kept.append(hashlib.sha256(left).hexdigest() if digest else left)
            yield _batch(
                t1=batch.column(0), t2=batch.column(1), n_bytes=np.diff(off), n_removed=pa.array(removed, pa.int64()), n_spans=pa.array(many, pa.int64()),
                kept=pa.array(kept, pa.string() if digest else pa.binary()),
            )

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 200, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Every text without the bytes that a repeated string of ``length`` bytes covers.

    Per row of ``docs``: id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining
    bytes; with ``digest`` their SHA-256 in hex). A string is repeated if it also starts anywhere else, in
    the same text too; strings never cross texts and are judged on the whole input. Null texts count as
    empty, ids (null, repeated, of any type) are only carried, other columns are ignored, an empty table
    gives no rows. Texts shorter than ``length`` stay whole; equal texts at least as long go whole.
    """
    if not 2 <= gram <= length // 2:
        raise ValueError("gram must be between 2 and half the length")
    path = scratch_path(spark, "repeats")
    texts = distinct_texts(spark, docs, f"{path}/texts", id_col, text_col)
    found = repeated(spark, texts, path, length, gram)
    by_text = found.groupBy("t1", "t2").agg(F.collect_list("windows").alias("windows"))
    each = texts.join(by_text, ["t1", "t2"], "left").select("t1", "t2", "text", "copies", "windows")
    kind = "string" if digest else "binary"
    each.mapInArrow(_cut(length, digest), f"t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept {kind}").write.parquet(f"{path}/kept")
    rows = _keyed(docs, id_col, text_col).select(F.col("id").alias(id_col), "t1", "t2")
    return rows.join(spark.read.parquet(f"{path}/kept"), ["t1", "t2"]).drop("t1", "t2")

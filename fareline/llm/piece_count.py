"""Token counts of a BPE piece model by rank-synchronous merging of ragged numpy arrays.

The pre-tokens of many texts (parts across whose ends no piece reaches) are held as one flat symbol
array with bounds, each distinct pre-token once. Every round finds the lowest rank among the
neighbour pairs of each sequence and merges all its places of that pair at once; sequences without
a possible merge leave the array. The surviving symbols of each pre-token are summed per text.

Merging all places at once equals merging one after the other unless a merge makes a pair possible
that ranks as good or better than itself; for such pieces (``PieceArrays.single``) and for pieces
of equal rank only the leftmost place merges in a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.pieces import NEVER, SPACE, PieceModel, load
from fareline.llm.text import U64, mix, slices, utf8

LONG_PART = 512  # parts with equal ranks longer than this are merged one by one with a heap
_STEP = U64(0x9E3779B97F4A7C15)


class PieceArrays:
    """The tables of ``PieceModel`` as arrays, with an open-addressing table of pairs that merge."""

    def __init__(self, model: PieceModel):
        self.model = model
        chars = sorted(t for t in model.id if len(t) == 1)
        self.char = np.zeros(0x110000, np.int32)  # 0: no piece
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_piece = np.array([-1, *(model.id[c] for c in chars)], np.int32)
        n = len(chars) + 1
        self.inside = np.zeros((n, n), bool)
        for p in model.pairs:
            a, b = self.char[ord(p[0])], self.char[ord(p[1])]
            if a and b:
                self.inside[a, b] = True
        self.bits = max(4, int(len(model.merges) * 4).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.new = np.full(1 << self.bits, -1, np.int32)
        self.probes = 1
        for (a, b), new in model.merges.items():
            key, tries = a << 32 | b, 1
            at = int(self._slot(np.array([key], np.int64))[0])
            while self.key[at] >= 0:
                at, tries = (at + 1) & ((1 << self.bits) - 1), tries + 1
            self.key[at], self.new[at], self.probes = key, new, max(self.probes, tries)
        self.rank = np.append(model.rank, NEVER)  # index -1: no piece
        self.single = model.tied.copy()
        for (a, b), new in model.merges.items():
            for part in (a, b):
                if model.rank[new] <= model.rank[part] and len(model.text[part]) > 1:
                    self.single[part] = True
        self.tied_char = np.zeros(n, bool)
        self.tied_char[[self.char[ord(c)] for i, t in enumerate(model.text) if model.tied[i] for c in t]] = True
        self.tied_char[0] = False

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.astype(U64)) >> U64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece that each pair makes, or -1."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        out = np.where(self.key[at] == key, self.new[at], np.int32(-1))
        open_ = np.flatnonzero((self.key[at] >= 0) & (self.key[at] != key))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            hit = self.key[at[open_]]
            same = hit == key[open_]
            out[open_[same]] = self.new[at[open_[same]]]
            open_ = open_[(hit >= 0) & ~same]
        return out

    def survivors(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence ``symbols[bounds[i]:bounds[i + 1]]`` (none empty) after all merges."""
        left = np.diff(bounds).astype(np.int64)
        seq = np.arange(len(left))  # original index of the sequences still held
        sym, start = symbols.astype(np.int32), bounds[:-1].astype(np.int64)
        size = left.copy()
        pair = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            pair[:-1] = self.merged(sym[:-1], sym[1:])
        if len(left):
            pair[start + size - 1] = -1  # no pair crosses two sequences
        while len(seq):
            rank = self.rank[pair]
            best = np.minimum.reduceat(rank, start)
            live = best < NEVER
            if not live.all():
                left[seq[~live]] = size[~live]
                keep = np.repeat(live, size)
                sym, pair, rank = sym[keep], pair[keep], rank[keep]
                seq, size, best = seq[live], size[live], best[live]
                if not len(seq):
                    break
                start = np.cumsum(size) - size
            owner = np.repeat(np.arange(len(seq)), size)
            at = np.flatnonzero(rank == best[owner])
            first = np.ones(len(at), bool)  # first place of each sequence in this round
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            run = np.ones(len(at), bool)  # begins a run of overlapping places
            run[1:] = at[1:] != at[:-1] + 1
            order = np.arange(len(at))
            in_run = order - np.maximum.accumulate(np.where(run, order, 0))
            leader = np.maximum.accumulate(np.where(first, order, 0))
            take = np.where(self.single[pair[at[leader]]], first, in_run % 2 == 0)
            at = at[take]
            sym[at] = pair[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            end = np.zeros(len(sym), bool)
            end[start + size - 1] = True
            end[at] |= end[at + 1]
            moved = np.cumsum(keep) - 1
            sym, pair, end = sym[keep], pair[keep], end[keep]
            size = size - np.bincount(owner[at], minlength=len(seq))
            start = np.cumsum(size) - size
            at = moved[at]
            redo = np.concatenate([at, at[at > 0] - 1])
            redo = redo[~end[redo]]
            pair[redo] = self.merged(sym[redo], sym[redo + 1])
            pair[end] = -1
        return left

    def counts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text in a UTF-8 buffer."""
        n = len(offsets) - 1
        cp = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
        char_at = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offsets]
        full = np.flatnonzero(np.diff(char_at))
        cp[cp == 0x20] = ord(SPACE)
        cp = np.insert(cp, char_at[full], ord(SPACE))
        if not len(cp):
            return np.zeros(n, np.int64)
        text_start = char_at[full] + np.arange(len(full))
        c = self.char[cp]
        cut = np.ones(len(cp), bool)
        cut[1:] = ~self.inside[c[:-1], c[1:]]
        cut[text_start] = True
        starts = np.flatnonzero(cut)
        size = np.diff(starts, append=len(cp))
        # each distinct part once, by a 64-bit hash of its characters
        place = np.arange(len(cp)) - np.repeat(starts, size)
        h = np.add.reduceat(mix(cp.astype(U64) + (place.astype(U64) + U64(1)) * _STEP), starts)
        _, pick, back = np.unique(mix(h + size.astype(U64)), return_index=True, return_inverse=True)
        u_start, u_size = starts[pick], size[pick]
        out = np.ones(len(pick), np.int64)
        lone = u_size == 1
        odd = lone & (c[u_start] == 0)  # characters without a piece
        if self.model.fallback and odd.any():
            x = cp[u_start[odd]]
            out[odd] = 1 + (x >= 0x80) + (x >= 0x800) + (x >= 0x10000)
        many = np.flatnonzero(~lone)
        if len(many):
            bounds = np.concatenate([[0], np.cumsum(u_size[many])])
            flat = np.repeat(u_start[many] - bounds[:-1], u_size[many]) + np.arange(bounds[-1])
            tied = np.add.reduceat(self.tied_char[c[flat]].astype(np.int64), bounds[:-1])
            slow = tied > LONG_PART
            for k in np.flatnonzero(slow):
                text = "".join(map(chr, cp[flat[bounds[k] : bounds[k + 1]]]))
                out[many[k]] = len(self.model.merge(text))
            if slow.any():
                flat = flat[np.repeat(~slow, u_size[many])]
                many = many[~slow]
                bounds = np.concatenate([[0], np.cumsum(u_size[many])])
            out[many] = self.survivors(self.char_piece[c[flat]], bounds)
        total = np.concatenate([[0], np.cumsum(out[back])])
        per = total[np.searchsorted(starts, np.append(text_start, len(cp)))]
        result = np.zeros(n, np.int64)
        result[full] = np.diff(per)
        return result


@lru_cache(maxsize=2)
def arrays(path: str) -> PieceArrays:
    return PieceArrays(load(path))


def count_documents(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count of each text: ``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit); no shuffle.

    A null or empty text has no bytes and no tokens. Repeated rows give repeated results; other
    columns of ``docs`` are ignored, an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = arrays(model)
        for batch in batches:
            buf, off = utf8(batch.column(1))
            n = [table.counts(buf[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in slices(off)]
            n_tokens = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off)), pa.array(n_tokens), pa.array(n_tokens > limit)], names=["_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"_id {id_type}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("_id", id_col)

"""Exact BPE piece encoding by backtracking over Aho-Corasick matches, and decoding.

A sequence of pieces is the merge result of its text exactly when every two neighbours, merged
again from their characters, give the same two pieces. The encoder walks the text from the left:
it takes the longest piece that starts at the position (Aho-Corasick matches), falls back to the
next shorter prefix piece, and keeps a piece only if it is compatible with its left neighbour. A
position from which nothing fits is marked as failed in a bitfield and never entered again, so
the walk is linear in the text.

Texts are first cut where no piece reaches across (see ``PieceModel.split``); parts holding pieces
of equal score (runs of spaces), for which merging is decided by place and not by rank, are merged
plainly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.cache import Generations
from fareline.llm.pieces import SPACE, PieceModel, load

WORDS_CACHED = 200_000  # words whose ids a Python worker remembers, twice at most (some 80 MB); they stay while it serves other stages
PARTS_CACHED = 50_000  # and other parts of texts
PAIRS_CACHED = 300_000  # neighbour checks that it remembers, twice at most
ENDLESS = 1 << 40


class BacktrackEncoder:
    def __init__(self, model: PieceModel):
        self.model = model
        self.trie = ahocorasick.Automaton()
        for text, i in model.id.items():
            self.trie.add_word(text, i)
        self.trie.make_automaton()
        self.length = [len(t) for t in model.text]
        #: the longest proper prefix of a piece that is a piece as well
        self.shorter = {i: next((model.id[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in model.id), -1) for t, i in model.id.items()}
        self.tied = {c for i, t in enumerate(model.text) if model.tied[i] for c in t}
        self.rank = model.rank.tolist()
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.compatible = Generations(self._compatible, PAIRS_CACHED)
        self.parts = Generations(self._part, PARTS_CACHED)
        self.words = Generations(self._word, WORDS_CACHED)
        self.decimal = [str(i) for i in range(len(model.text))]

    def _edges(self, piece: int) -> tuple[list, list] | None:
        """The symbols that stand at the left and right end of a piece while its text is merged, each
        with the rank at which it is absorbed; None for a piece that merging never makes."""
        if piece not in self.edges:
            text, ids = self.model.text[piece], self.model.id
            found = ([(piece, ENDLESS)], [(piece, ENDLESS)]) if len(text) == 1 else None
            for k in range(1, len(text)):
                a, b = ids.get(text[:k]), ids.get(text[k:])
                if a is not None and b is not None and self._apart(a, b):  # its last merge
                    left, right = self._edges(a)[0], self._edges(b)[1]
                    rank = self.rank[piece]
                    found = ([*left[:-1], (a, rank), (piece, ENDLESS)], [*right[:-1], (b, rank), (piece, ENDLESS)])
                    break
            self.edges[piece] = found
        return self.edges[piece]

    def _apart(self, a: int, b: int) -> bool:
        """Merge the text of two neighbours again along their common border: does nothing merge across
        it before both pieces stand whole? The leftmost of equal ranks goes first."""
        left, right = self._edges(a), self._edges(b)
        if left is None or right is None:
            return False
        left, right, i, j, merges = left[1], right[0], 0, 0, self.model.merges
        while True:
            (x, until_x), (y, until_y) = left[i], right[j]
            if until_x == until_y == ENDLESS:
                return True
            new = merges.get((x, y))
            if new is not None and self.rank[new] < until_x and self.rank[new] <= until_y:
                return False
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return pair not in self.model.merges and self._apart(*pair)

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text made of piece characters."""
        longest = [-1] * len(text)
        for end, i in self.trie.iter(text):
            longest[end + 1 - self.length[i]] = i  # later ends are longer
        failed = bytearray(len(text) // 8 + 1)
        out: list[int] = []
        at, piece = 0, longest[0]
        while True:
            end = at + self.length[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (not out or self.compatible[out[-1], piece]):
                out.append(piece)
                at = end
                if at == len(text):
                    return out
                piece = longest[at]
            elif self.shorter[piece] >= 0:
                piece = self.shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= self.length[piece]

    def _ids(self, text: str) -> list[int]:
        """Ids of any normalised text."""
        if all(c in self.model.id for c in text) and SPACE * 2 not in text:
            return self.backtrack(text)
        out: list[int] = []
        for part in self.model.split(text):
            if len(part) == 1:
                out += self.model.char_ids(part)
            elif any(x in self.tied and y in self.tied for x, y in zip(part, part[1:])):
                out += self.model.merge(part)
            else:
                out += self.backtrack(part)
        return out

    def _word(self, word: str) -> bytes:
        """Ids (little-endian unsigned 32-bit) of a space mark and a word without one."""
        end = len(word)
        while end and not word[end - 1].isalnum():
            end -= 1
        if 0 < end < len(word) and word[end - 1 : end + 1] not in self.model.pairs:  # closing marks, encoded apart
            return self.words[word[:end]] + self.parts[word[end:]]
        return self._part(SPACE + word)

    def _part(self, part: str) -> bytes:
        return np.array(self._ids(part), "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if not text:
            return np.zeros(0, "<u4")
        if SPACE in text or text[0] == " " or "  " in text or not self.model.space_starts:
            text = SPACE + text.replace(" ", SPACE)
            found = [self.parts[u] for u in (re.findall(f"{SPACE}+[^{SPACE}]*", text) if self.model.space_starts else [text])]
        else:
            words = text.split(" ")
            found = list(map(self.words.get, words))
            if None in found:
                found = [self.words[w] if ids is None else ids for w, ids in zip(words, found)]
        return np.frombuffer(b"".join(found), "<u4")

    def decode(self, ids) -> str:
        """Text of ids: pieces without the leading space, byte pieces as UTF-8, control pieces as nothing."""
        surface, ids = self.model.surface, np.asarray(ids).tolist()
        first = next((i for i in ids if surface[i]), None)
        out = b"".join([surface[i] for i in ids])
        if first is not None and self.model.text[first].startswith(SPACE):
            out = out[1:]
        return out.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> BacktrackEncoder:
    return BacktrackEncoder(load(path))


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Encode each text with an end id and decode the ids again; no shuffle.

    Returns ``id_col``, n_tokens and either ids (array of int) and decoded (string), or with
    ``digest`` the SHA-256 of both (ids as decimals joined by one space, decoded text as UTF-8). A
    null text counts as empty: only the end id. Repeated rows give repeated results; other columns
    of ``docs`` are ignored, an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # output arrays of a few MB
                part = batch.slice(at, 256)
                n_tokens, left, right = [], [], []
                for text in part.column(1):
                    ids = np.append(enc.encode(text.as_py() or ""), np.uint32(enc.model.eos))
                    decoded = enc.decode(ids)
                    n_tokens.append(len(ids))
                    if digest:
                        decimals = " ".join([enc.decimal[i] for i in ids.tolist()])
                        left.append(hashlib.sha256(decimals.encode()).hexdigest())
                        right.append(hashlib.sha256(decoded.encode()).hexdigest())
                    else:
                        left.append(ids.astype(np.int32))
                        right.append(decoded)
                kind = pa.string() if digest else pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_tokens, pa.int64()), pa.array(left, kind), pa.array(right, pa.string())],
                    names=["_id", "n_tokens", "ids_sha256" if digest else "ids", "decoded_sha256" if digest else "decoded"],
                )

    out = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return rows.mapInArrow(run, f"_id {id_type}, n_tokens long, {out}").withColumnRenamed("_id", id_col)

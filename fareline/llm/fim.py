"""Fill-in-middle transformation with an indexable skip list over the tokens of each text.

A token is a run of white space with the word after it, or white space at the end. The bottom lane of
the list has one link a token; a link of an express lane spans several. Every link carries its widths:
tokens, code points and bytes. Descending from the top lane by accumulated token widths reaches a rank
in about log(n) steps and gives the exact code point and byte there, so a text is cut without splitting
it into tokens.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareline.llm.text import NONSPACE, utf8

PIECE = 1 << 20
LANE = 4  # links of one lane that one link of the lane above spans, on average
# fixed values of the output format
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


def token_widths(text: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(code points, bytes) of every token of one text in UTF-8, piece by piece."""
    ends, points, before, carry = [], [], 0, False
    for at in range(0, len(text), piece):
        part = text[at : at + piece]
        word = NONSPACE[part]
        nxt = NONSPACE[text[at + len(part)]] if at + len(part) < len(text) else False
        last = word & ~np.append(word[1:], nxt)
        end = np.flatnonzero(last) + 1
        run = np.cumsum((part & 0xC0) != 0x80)
        ends.append(end + at)
        points.append(run[end - 1] + before)
        before += int(run[-1])
        carry = not word[-1]
    if carry:  # white space at the end is a token of its own
        ends.append(np.array([len(text)]))
        points.append(np.array([before]))
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.diff(np.concatenate(points), prepend=0), np.diff(np.concatenate(ends), prepend=0)


class SkipList:
    """Lanes of links (tokens, code points, bytes); a node's height is drawn from a fixed hash of its rank."""

    def __init__(self, points: np.ndarray, size: np.ndarray):
        self.n = n = len(points)
        width = np.column_stack([np.ones(n, np.int64), points, size])
        rank = np.arange(1, n + 1, dtype=np.uint64)  # node k stands after k tokens; node 0 is the head
        noise = (rank * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        self.lanes = [(width, np.arange(n))]  # links of the lane, and the link below at which each begins
        step = LANE
        while len(width) > LANE:
            tall = np.flatnonzero(noise % np.uint64(step) == 0)
            tall = tall[tall < len(noise) - 1]
            if not len(tall):
                break
            begin = np.concatenate([[0], tall + 1])
            width = np.add.reduceat(width, begin, axis=0)
            noise = np.append(noise[tall], noise[-1])
            self.lanes.append((width, begin))
            step *= LANE
        self.lanes = [(w.tolist(), b.tolist()) for w, b in self.lanes]

    def locate(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) before the token of this rank; rank n gives the whole text."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        units = points = size = link = 0
        for k in range(len(self.lanes) - 1, -1, -1):
            width, below = self.lanes[k]
            while link < len(width) and units + width[link][0] <= rank:
                u, p, s = width[link]
                units, points, size, link = units + u, points + p, size + s, link + 1
            if units == rank:
                break
            link = below[link]
        return points, size


def draws(seed: int, doc_id) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return struct.unpack(">4I", digest[:16])


def transform(text: np.ndarray, draw: tuple[int, int, int, int], fim_percent: int, spm_percent: int, piece: int = PIECE) -> tuple:
    """(tokens, form, code points of prefix and middle, output) of one text."""
    h1, h2, h3, h4 = draw
    data = text.tobytes()
    points, size = token_widths(text, piece)
    n = len(points)
    if not data or h3 % 100 >= fim_percent or any(m in data for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, data
    index = SkipList(points, size)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    (p, cut), (m, end) = index.locate(a), index.locate(b)
    prefix, middle, suffix = data[:cut], data[cut:end], data[end:]
    if h4 % 100 < spm_percent:
        return n, "spm", p, m - p, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", p, m - p, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made of. No part has a marker in it, so the first ones are the markers."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    at = output.index(second, len(first))
    mid = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(first) : at], output[at + len(second) : mid], output[mid + len(MIDDLE) :]
    return two + middle + one if form == "spm" else one + middle + two


def transform_documents(docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars, output.

    The cuts and the form come from a hash of ``seed`` and the id alone, so reruns agree and rows of one
    id are cut alike by rank; a null id counts as empty. Null texts count as empty. Texts that are empty or
    hold a marker stay plain, with null widths. Other columns are ignored; an empty table gives no rows.
    """

    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            made = [transform(buf[off[k] : off[k + 1]], draws(seed, i), fim_percent, spm_percent, piece) for k, i in enumerate(ids)]
            n, form, prefix, middle, output = zip(*made) if made else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in ((n, pa.int64()), (form, pa.string()), (prefix, pa.int64()), (middle, pa.int64()))), pa.array(output, pa.binary()).cast(pa.string())],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_documents(made: DataFrame) -> DataFrame:
    """The rows of ``transform_documents`` with the text rebuilt from output and form alone: restored."""
    out, form = made.columns.index("output"), made.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(form).to_pylist()
            buf, off = utf8(batch.column(out))
            texts = [restore(buf[off[k] : off[k + 1]].tobytes(), f) for k, f in enumerate(forms)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    return made.mapInArrow(run, f"{schema}, restored string")

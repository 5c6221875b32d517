"""Byte-level BPE ids through the tokenizers library, with the ids of repeated words remembered.

The pre-tokenizer never joins the end of one word with the space before the next, so a text without
double white space is encoded word by word, each with its leading space. A single line break between two
words is a part of its own. New words go through the library in strings of many words, closing marks and
what follows a line break apart from them; a worker keeps the words that it met, packed in Arrow and found
by their hashes, in two generations. Other texts go through the library whole.
"""

from __future__ import annotations

import gc
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fareline.llm.cache import Generations
from fareline.llm.text import hashes, slices, utf8

WORDS_CACHED = 500_000  # words whose ids a Python worker remembers, twice at most; some 45 bytes each
STARTS_CACHED = 300_000  # the same for words with no space before them, as Python objects
WORDS_JOINED = 64  # new words encoded in one string; longer ones cost more a word
TEXT_AT_ONCE = 2 << 20  # bytes of text whose words are numbered together


#: Letters with closing marks: two pre-tokens. White space other than single line breaks inside a word.
_MARKS = ".,;:!?#$%&*)"  # the usual ones
_MARKED = re.compile(r"([^\W\d_]+)([^\w\s'\"]+)").fullmatch
_GAP = re.compile(r"\n\s|[^\S\n]").search


class Words:
    """Words and their ids, packed. A sorted hash finds a word, the word itself tells whether it is the one."""

    def __init__(self):
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.words = self.ids = pa.array([], pa.large_binary())

    def find(self, words: pa.Array, h: np.ndarray) -> np.ndarray:
        """Places of the given words, -1 for those that are not here."""
        if not len(self.keys):
            return np.full(len(h), -1)
        p = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        place = np.where(self.keys[p] == h, self.place[p], -1)
        hit = np.flatnonzero(place >= 0)
        same = pc.equal(words.take(pa.array(hit)), self.words.take(pa.array(place[hit]))).to_numpy(zero_copy_only=False)
        place[hit[~same]] = -1
        return place

    def add(self, words: pa.Array, h: np.ndarray, ids: pa.Array) -> None:
        """Of words with one hash only the first is kept."""
        h, first = np.unique(h, return_index=True)
        p = np.searchsorted(self.keys, h)
        if len(self.keys):
            fresh = self.keys[np.minimum(p, len(self.keys) - 1)] != h
            h, first, p = h[fresh], first[fresh], p[fresh]
        self.keys = np.insert(self.keys, p, h)
        self.place = np.insert(self.place, p, len(self.words) + np.arange(len(h)))
        first = pa.array(first)
        self.words, self.ids = pa.concat_arrays([self.words, words.take(first)]), pa.concat_arrays([self.ids, ids.take(first)])


def _hashed(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words as bytes, with their hashes."""
    buf, off = utf8(words)
    # one byte more, so that an empty word at the end has a place
    return words.cast(pa.large_binary()), hashes(np.append(buf, np.uint8(0)), off[:-1], off[1:])


class ByteEncoder:
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.lib.get_vocab_size() <= 1 << 16 else "<u4")
        self.young, self.old = Words(), Words()  # with a leading space; the younger generation and the older
        self.starts: dict[str, bytes] = {}  # without a space before them
        self.old_starts: dict[str, bytes] = {}
        self.parts = Generations(self._whole, WORDS_CACHED // 10)
        self._break = self._whole("\n")
        self._break_id = self.lib.encode("\n", add_special_tokens=False).ids[0]
        space = self.lib.encode(" ", add_special_tokens=False).tokens[0][0]  # how tokens write a space
        self._spaced = np.zeros(self.lib.get_vocab_size(), bool)
        self._spaced[[i for t, i in self.lib.get_vocab().items() if t.startswith(space)]] = True

    def _pack(self, ids) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.lib.encode(text, add_special_tokens=False).ids)

    def _learn(self, words: list[str], known: dict[str, bytes], gap: str) -> None:
        """Puts the ids of words without white space into ``known``: each after a space, or each alone. Many go
        through the library as one string. Only the first token of a word can begin with the space before
        it, and a line break is a token of its own, so the tokens themselves tell where words begin."""
        if not words:
            return
        cuts = [words[k : k + WORDS_JOINED] for k in range(0, len(words), WORDS_JOINED)]
        texts = [" " + " ".join(c) if gap == " " else "\n".join([*c, ""]) for c in cuts]
        ids = np.concatenate([np.array(c.ids, self.dtype) for c in self.lib.encode_batch_fast(texts, add_special_tokens=False)])
        if gap == " ":
            first = np.flatnonzero(self._spaced[ids])
            last = np.append(first[1:], len(ids))
        else:
            last = np.flatnonzero(ids == self._break_id)
            first = np.append(0, last[:-1] + 1)
        if len(first) != len(words) or first[0] != 0:  # not as expected of this tokenizer: one by one
            known.update((w, self._whole(" " + w if gap == " " else w)) for w in words)
            return
        packed, width = ids.tobytes(), self.dtype.itemsize
        known.update((w, packed[a:b]) for w, a, b in zip(words, (first * width).tolist(), (last * width).tolist()))

    def _lookup(self, words: pa.Array, h: np.ndarray) -> pa.Array:
        """The ids of each word after a space, null where neither generation holds it; those of the older one
        become young again."""
        place = self.young.find(words, h)
        rest = np.flatnonzero(place < 0)
        if len(rest) and len(self.old.keys):
            old = self.old.find(words.take(pa.array(rest)), h[rest])
            again, old = rest[old >= 0], old[old >= 0]
            again_words = words.take(pa.array(again))
            self.young.add(again_words, h[again], self.old.ids.take(pa.array(old)))
            place[again] = self.young.find(again_words, h[again])
        return self.young.ids.take(pa.array(place, mask=place < 0))

    def _remember(self, new: list[str]) -> list[bytes]:
        """The ids of different words, each after a space, that ``_lookup`` does not hold; it does afterwards."""
        learn, cores, first, marked, lines, ids = [], set(), set(), [], [], {}
        for w in new:
            if w.isalpha():
                learn.append(w)
            elif (core := w.rstrip(_MARKS)).isalpha():
                marked.append((w, core, w[len(core) :]))
                cores.add(core)
            elif found := _MARKED(w):
                core, tail = found.groups()
                marked.append((w, core, tail))
                cores.add(core)
            elif "\n" in w:
                head, *rest = w.split("\n")
                if (core := head.rstrip(_MARKS)).isalpha():
                    tail = head[len(core) :]
                else:
                    core, tail = found.groups() if (found := _MARKED(head)) else (head, "")
                lines.append((w, core, tail, rest))
                cores.add(core)
                first.update(rest)
            else:
                learn.append(w)
        ask = list(cores.difference(learn))
        if ask:
            got = self._lookup(*_hashed(pa.array(ask, pa.string()))).to_pylist()
            ids = {w: b for w, b in zip(ask, got) if b is not None}
            learn += [w for w in ask if w not in ids]
        self._learn(learn, ids, " ")
        self._start({r for r in first if r not in self.starts})
        for w, core, tail in marked:
            ids[w] = ids[core] + self.parts[tail]
        for w, core, tail, rest in lines:
            head = ids[core] + self.parts[tail] if tail else ids[core]
            ids[w] = self._break.join([head, *(self.starts[r] for r in rest)])
        kept = learn + [x[0] for x in marked] + [x[0] for x in lines]
        if kept:
            words, h = _hashed(pa.array(kept, pa.string()))
            self.young.add(words, h, pa.array([ids[w] for w in kept], pa.large_binary()))
        return [ids[w] for w in new]

    def _start(self, words: set[str]) -> None:
        """Puts the ids of words with nothing before them into ``self.starts``."""
        again = self.old_starts.keys() & words
        self.starts.update((w, self.old_starts[w]) for w in again)
        self._learn(list(words - again), self.starts, "\n")

    def encode_batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``dtype``."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        _, off = utf8(column)
        gc.disable()  # many short-lived lists, no cycles
        try:
            return list(chain.from_iterable(self._encode_batch(column.slice(a, b - a)) for a, b in slices(off, TEXT_AT_ONCE)))
        finally:
            gc.enable()

    def _encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Texts are split and their words numbered in Arrow, so that Python sees each different word once; the ids
        of all words are then laid side by side by one ``take``."""
        if len(self.young.keys) > WORDS_CACHED:
            self.young, self.old = Words(), self.young
        if len(self.starts) > STARTS_CACHED:
            self.starts, self.old_starts = {}, self.starts
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        at, words = coded.indices.to_numpy().copy(), coded.dictionary
        begins = bounds[:-1]
        heads = words.take(pa.array(at[begins])).to_pylist()
        later = np.ones(len(at), bool)
        later[begins] = False
        used = np.zeros(len(words), bool)  # stand after a space somewhere
        used[at[later]] = True
        known = self._lookup(*_hashed(words))
        missing = np.flatnonzero(used & known.is_null().to_numpy(zero_copy_only=False))
        new, wide = [], []
        for k, w in zip(missing.tolist(), words.take(pa.array(missing)).to_pylist()):
            # white space beside a space belongs to one pre-token with it: such texts are encoded whole
            if not w.isalpha() and (not w or w[0].isspace() or w[-1].isspace() or _GAP(w)):
                wide.append(k)
            else:
                new.append((k, w))
        learned = self._remember([w for _, w in new])
        self._start({h for h in heads if h not in self.starts and h and not h[0].isspace() and not _GAP(h) and "\n" not in h})
        whole = np.fromiter((h[-1:].isspace() for h in heads), bool, len(heads))
        if wide:
            is_wide = np.zeros(len(words), bool)
            is_wide[wide] = True
            whole[np.repeat(np.arange(len(heads)), np.diff(bounds))[later & is_wide[at]]] = True
        place = np.arange(len(words))
        place[[k for k, _ in new]] = len(words) + np.arange(len(new))
        at = place[at]
        # after the words: nothing, then the beginning of each text, or all of it
        if whole.any():
            at[np.repeat(whole, np.diff(bounds))] = len(words) + len(new)
        at[begins] = len(words) + len(new) + 1 + np.arange(len(heads))
        more = [*learned, b""]
        for k, (h, all_) in enumerate(zip(heads, whole.tolist())):
            head = self._whole(texts[k].as_py()) if all_ else self.starts.get(h)
            more.append(self.parts[h] if head is None else head)
        laid = pa.concat_arrays([known, pa.array(more, pa.large_binary())]).take(pa.array(at))
        _, offsets, data = laid.buffers()
        cuts = np.frombuffer(offsets, np.int64)[laid.offset :][bounds].tolist()
        data = data.to_pybytes() if data is not None else b""
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)

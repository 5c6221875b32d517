"""License scan: notice templates with optional and replaceable regions, compiled into token automata.

Markup of a template: plain words are mandatory; ``<<opt>> ... <<end>>`` may be left out;
``<<var:PATTERN>>`` stands for one word matching PATTERN, ``<<var:PATTERN*N>>`` for one up to N of
them, ``<<any*N>>`` for one up to N arbitrary words. Texts and templates are compared as words
(lower case; letters, digits and everything beyond ASCII), so punctuation and line breaks do not
matter. A template is accepted when its mandatory words stand somewhere in the text exactly, from
the first to the last; a text whose later clauses are changed or left out is refused.

The automata of all phrases and templates are united into one, which reads a text once: the sets of
states that texts lead to are numbered as they turn up, so a word costs one look-up.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.text import ALNUM, LOWER, slices, spans, utf8

# Phrases and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Notices and the wording of common licenses, written through to its end: label, template.
TEMPLATES = (
    ("notice-gpl", "<<opt>>this <<any*3>> is<<end>> <<var:licensed|released|distributed>> under <<opt>>the terms of<<end>> the gnu general public license <<opt>>as published by the free software foundation<<end>> <<opt>>either<<end>> version <<var:[0-9]+*2>>"),
    ("notice-apache", "licensed under the apache license version <<var:[0-9]+*2>>"),
    ("notice-cc-by", "licensed under <<opt>>the<<end>> <<opt>>creative commons<<end>> cc by <<opt>><<var:nc|nd|sa*2>><<end>> <<var:[0-9]+*2>>"),
    ("notice-mit", "<<var:licensed|released|distributed>> under <<opt>>the terms of<<end>> the mit license"),
    ("reserved", "copyright <<any*6>> all rights reserved"),
    ("text-mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files <<opt>>(the "Software")<<end>>, to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        <<opt>>(including the next paragraph)<<end>> shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any*8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE"""),
    ("text-bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: <<opt>>1<<end>> Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. <<opt>>2<<end>> Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        <<opt>><<opt>>3<<end>> Neither the name of <<any*10>> nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission.<<end>>
        THIS SOFTWARE IS PROVIDED BY <<any*8>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any*8>> BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE"""),
    ("text-isc", """Permission to use, copy, modify, <<opt>>and<<end>> <<opt>>or<<end>> distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
        "AS IS" AND <<any*6>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL <<any*6>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
        RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"""),
    ("text-zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will <<any*6>> be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: <<opt>>1<<end>> The origin of
        this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
        product, an <<var:acknowledgment|acknowledgement>> in the product documentation would be appreciated but is not required.
        <<opt>>2<<end>> Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
        <<opt>>3<<end>> This notice may not be removed or altered from any source distribution"""),
    ("header-apache", """Licensed under the Apache License, Version 2.0 <<opt>>(the "License")<<end>>; you may not use this file except in compliance with
        the License. You may obtain a copy of the License at <<var:http|https>> www apache org licenses LICENSE 2 0 <<opt>>html<<end>>
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
        and limitations under the License"""),
    ("header-gpl", """<<var:this>> <<any*4>> is free software <<opt>>:<<end>> you can redistribute it and or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version <<var:[23]>> of the License, or <<opt>>at your option<<end>>
        any later version. <<any*6>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details"""),
)

#: Bounds of a template table: it is sent to every task.
MOST_TEMPLATES, MOST_TEMPLATE_BYTES = 10_000, 32 << 20

_TOKEN = re.compile(r"<<(opt|end)>>|<<var:((?:(?!\*\d+>>|>>).)+)(?:\*(\d+))?>>|<<any(?:\*(\d+))?>>|([^\s<]+)|(\S)")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(markup: str) -> Iterator[tuple[str, str, int]]:
    """(kind, word or pattern, most words) of a template; kinds: opt, end, word, var, any."""
    depth = 0
    for m in _TOKEN.finditer(markup):
        region, pattern, most, any_most, plain, stray = m.groups()
        if stray:
            raise ValueError(f"not markup: {markup[m.start() : m.start() + 20]!r} in {markup[:60]!r}")
        if region:
            depth += 1 if region == "opt" else -1
            if depth < 0:
                raise ValueError(f"a region is closed that was not opened: {markup[:60]!r}")
            yield region, "", 0
        elif plain:
            for word in _WORD.findall(plain.translate(_A_Z)):
                yield "word", word, 1
        else:
            times = int(most or any_most or 1)
            if times < 1:
                raise ValueError(f"a region of no word: {markup[:60]!r}")
            yield ("var", pattern, times) if pattern else ("any", "", times)
    if depth:
        raise ValueError(f"an optional region is not closed: {markup[:60]!r}")


class Automaton(NamedTuple):
    """States 0.. with moves on a word; ``moves[s]`` lists (literal or None, pattern or None, next)."""

    moves: list[list[tuple[bytes | None, bytes | None, int]]]
    skips: list[list[int]]  # moves without a word
    last: int
    needed: bytes | None  # expression for words that every accepted text holds

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skips[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def length(self, words: list[bytes], at: int) -> int:
        """Words of the longest accepted run from a place; 0 if none."""
        states, best = self.closure({0}), 0
        for k in range(at, len(words)):
            word = words[k]
            states = self.closure({t for s in states for lit, pat, t in self.moves[s] if (lit == word if lit is not None else pat is None or re.fullmatch(pat, word))})
            if not states:
                break
            if self.last in states:
                best = k + 1 - at
        return best


def compile_template(markup: str) -> Automaton:
    """The automaton of a template; a template that accepts no word at all is refused."""
    moves: list[list] = [[]]
    skips: list[list[int]] = [[]]
    opened: list[int] = []
    runs: list[list[str]] = [[]]  # mandatory words that stand next to each other

    def state() -> int:
        moves.append([])
        skips.append([])
        return len(moves) - 1

    at = 0
    for kind, value, most in tokens(markup):
        if kind == "word" and not opened:
            runs[-1].append(value)
        elif kind != "word":
            runs.append([])
        if kind == "opt":
            opened.append(at)
        elif kind == "end":
            end = state()
            skips[at].append(end)
            skips[opened.pop()].append(end)
            at = end
        else:
            end = state()
            for _ in range(most):
                nxt = state()
                moves[at].append((value.encode() if kind == "word" else None, value.encode() if kind == "var" else None, nxt))
                skips[nxt].append(end)
                at = nxt
            at = end
    pairs = [r[k : k + 2] for r in runs for k in range(max(len(r) - 1, 1)) if r]
    best = max(pairs, key=lambda p: (len(p), sum(map(len, p))), default=None)
    auto = Automaton(moves, skips, at, rb"[^0-9a-z\x80-\xff]+".join(re.escape(w.encode()) for w in best) if best else None)
    if at in auto.closure({0}):
        raise ValueError(f"a template without a mandatory word: {markup[:60]!r}")
    return auto


class Scanner:
    """All phrases and templates as one automaton, read from every place of a text at once."""

    MOST_SETS = 20_000  # numbered sets and known words; beyond it they are numbered anew

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        self.rules = [(label, compile_template(t), len(t.split())) for label, t in PHRASES]
        self.n_phrases = len(self.rules)
        self.rules += [(label, compile_template(t), 0) for label, t in templates]
        self.literal: list[dict[bytes, list[int]]] = []
        self.other: list[list[tuple[int, int]]] = []  # (pattern or -1, next)
        self.close: list[frozenset[int]] = []
        self.ends: dict[int, int] = {}
        patterns: dict[bytes, int] = {}
        start: set[int] = set()
        for n, (_, auto, _) in enumerate(self.rules):
            base = len(self.close)
            for s, moves in enumerate(auto.moves):
                lit: dict[bytes, list[int]] = {}
                self.other.append([(-1 if pat is None else patterns.setdefault(pat, len(patterns)), base + t) for word, pat, t in moves if word is None])
                for word, _, t in moves:
                    if word is not None:
                        lit.setdefault(word, []).append(base + t)
                self.literal.append(lit)
                self.close.append(frozenset(base + t for t in auto.closure({s})))
            self.ends[base + auto.last] = n
            start |= self.close[base]
        self.start = frozenset(start)
        self.patterns = [re.compile(p) for p in patterns]
        self.words = {w for lit in self.literal for w in lit}
        needed = {auto.needed for _, auto, _ in self.rules}
        # a text without any of these holds no rule; None where a rule has no word of its own
        self.hint = None if None in needed else re.compile(b"|".join(sorted(needed)))
        self.reset()

    def reset(self) -> None:
        self.symbols: dict[tuple, int] = {}
        self.kinds: list[tuple] = []
        self.known: dict[bytes, int] = {}
        self.number: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.next: list[dict[int, int]] = []
        self.hits: list[tuple[int, ...]] = []
        self.numbered(self.start)

    def numbered(self, states: frozenset[int]) -> int:
        if states not in self.number:
            self.number[states] = len(self.sets)
            self.sets.append(states)
            self.next.append({})
            self.hits.append(tuple(sorted(self.ends[s] for s in states if s in self.ends)))
        return self.number[states]

    def symbol(self, word: bytes) -> int:
        """Words that no move tells apart share a symbol."""
        kind = (word if word in self.words else None, tuple(n for n, p in enumerate(self.patterns) if p.fullmatch(word)))
        if kind not in self.symbols:
            self.symbols[kind] = len(self.kinds)
            self.kinds.append(kind)
        self.known[word] = self.symbols[kind]
        return self.known[word]

    def move(self, at: int, symbol: int) -> int:
        word, matched = self.kinds[symbol]
        found = set(self.start)
        for s in self.sets[at]:
            for t in self.literal[s].get(word, ()):
                found |= self.close[t]
            for pattern, t in self.other[s]:
                if pattern < 0 or pattern in matched:
                    found |= self.close[t]
        self.next[at][symbol] = self.numbered(frozenset(found))
        return self.next[at][symbol]

    def scan(self, words: list[bytes]) -> tuple[list[int], set[int]]:
        """Places of phrases, and the rules found."""
        places, found, at = [], set(), 0
        for k, word in enumerate(words):
            if len(self.sets) > self.MOST_SETS or len(self.known) > self.MOST_SETS:
                states = self.sets[at]
                self.reset()
                at = self.numbered(states)
            symbol = self.known.get(word)
            if symbol is None:
                symbol = self.symbol(word)
            nxt = self.next[at].get(symbol)
            at = self.move(at, symbol) if nxt is None else nxt
            for rule in self.hits[at]:
                found.add(rule)
                if rule < self.n_phrases:
                    places.append(k + 1 - self.rules[rule][2])
        return places, found

    def spans(self, words: list[bytes], found: set[int]) -> list[dict]:
        """First place and longest run there of every rule found."""
        out = []
        for rule in sorted(found, key=lambda r: (self.rules[r][0], r)):
            label, auto, _ = self.rules[rule]
            out.append(next({"label": label, "first": k, "words": n} for k in range(len(words)) if (n := auto.length(words, k))))
        return out


@lru_cache(maxsize=4)
def scanner(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Scanner:
    return Scanner(templates)


def template_table(templates: DataFrame | Iterable[tuple[str, str]]) -> tuple[tuple[str, str], ...]:
    """(label, template) pairs of a table with those columns, or of pairs; compiled once to refuse wrong markup.

    Rows with a null are ignored. More than MOST_TEMPLATES rows or MOST_TEMPLATE_BYTES bytes raise
    ValueError, since every task holds all templates; so does a label with a comma.
    """
    if isinstance(templates, DataFrame):
        size = templates.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("label") + F.octet_length("template")), F.lit(0))).first()
        if size[0] > MOST_TEMPLATES or size[1] > MOST_TEMPLATE_BYTES:
            raise ValueError(f"{size[0]} templates of {size[1]} bytes are too many for every task")
        templates = [tuple(r) for r in templates.select("label", "template").collect()]
    pairs = tuple(sorted({(label, t) for label, t in templates if label is not None and t is not None}))
    if len(pairs) > MOST_TEMPLATES or sum(len(t.encode()) for _, t in pairs) > MOST_TEMPLATE_BYTES:
        raise ValueError(f"{len(pairs)} templates are too many for every task")
    for label, t in pairs:
        if "," in label:
            raise ValueError(f"labels are joined by commas: {label!r}")
        compile_template(t)
    return pairs


OUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


SPANS = "array<struct<label:string,first:bigint,words:bigint>>"


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: DataFrame | Iterable[tuple[str, str]] = TEMPLATES, spans_col: str | None = None
) -> DataFrame:
    """License phrases and notices of each text; no shuffle.

    Returns ``id_col``, n_words, n_base (places of phrases), first_word and last_word (smallest and
    largest start of a place, words from 0; null without one), base_labels, labels (phrases and
    accepted templates; distinct, sorted, comma-joined; empty string if none) and score: 1 if a
    template is accepted, 0.5 if only a phrase stands there, else 0. ``templates`` are pairs, or a
    table, of label and template (see ``template_table``). With ``spans_col`` the first place of every
    phrase and template, and the words of its longest run there, follow under that name. A null text
    counts as empty. Repeated rows give repeated results, other columns are ignored, an empty table
    gives no row.
    """
    pairs = template_table(templates)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    names = ["_id", *(x.split()[0] for x in OUT.split(", "))]
    span_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(pairs)
        for batch in batches:
            buf, off = utf8(batch.column(1))
            n = len(off) - 1
            n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first, last, score = [None] * n, [None] * n, np.zeros(n)
            base_labels, labels, placed = [""] * n, [""] * n, [[] for _ in range(n if spans_col else 0)]
            for a, b in slices(off):
                low = LOWER[buf[off[a] : off[b]]]
                o = off[a : b + 1] - off[a]
                starts, ends = spans(low, o, ALNUM)
                bounds = np.searchsorted(starts, o)
                n_words[a:b] = np.diff(bounds)
                data = low.tobytes()
                if scan.hint is None:
                    rows_hit = range(b - a)
                else:
                    hits = np.array([m.start() for m in scan.hint.finditer(data)], np.int64)
                    rows_hit = np.unique(np.searchsorted(o, hits, side="right") - 1)
                for k in rows_hit:
                    words = [data[s:e] for s, e in zip(starts[bounds[k] : bounds[k + 1]].tolist(), ends[bounds[k] : bounds[k + 1]].tolist())]
                    places, found = scan.scan(words)
                    k += a
                    if places:
                        n_base[k], first[k], last[k] = len(places), min(places), max(places)
                    base = {scan.rules[r][0] for r in found if r < scan.n_phrases}
                    extra = {scan.rules[r][0] for r in found if r >= scan.n_phrases}
                    base_labels[k] = ",".join(sorted(base))
                    labels[k] = ",".join(sorted(base | extra))
                    score[k] = 1.0 if extra else 0.5 if base else 0.0
                    if spans_col:
                        placed[k] = scan.spans(words, found)
            cols = [pa.array(n_words), pa.array(n_base), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base_labels), pa.array(labels), pa.array(score)]
            more = [pa.array(placed, span_type)] if spans_col else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, *more], names=[*names, *(["_spans"] if spans_col else [])])

    made = rows.mapInArrow(run, f"_id {id_type}, {OUT}" + (f", _spans {SPANS}" if spans_col else ""))
    return made.withColumnsRenamed({"_id": id_col} | ({"_spans": spans_col} if spans_col else {}))

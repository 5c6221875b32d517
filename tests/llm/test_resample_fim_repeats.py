"""Importance resampling, fill-in-middle and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareline.llm import fim, resample, suffix_merge

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n\t ", "one", "ONE two", "é" * 70 + " ümlaut ﬁn 漢字 😀 x", "w" * 200 + " " + "w" * 65, "a  b\x0bc\x85d 　 e", "<P>x y", "a <S> b", "<M>", "< P > almost <P"]


# --- importance resampling -------------------------------------------------------------------


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def buckets(t, n=10_000):
    w = words(t)
    return [zlib.crc32(f.encode()) % n for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def resampled(docs, target, percent=25, least=20, seed=7, n=10_000):
    s, t = (Counter(b for _, x in rows for b in buckets(x, n)) for rows in (docs, target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + n) / ((s[b] + 1) * (big_t + n)))) for b in range(n)]
    out = []
    for i, x in docs:
        f = buckets(x, n)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(x)) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((str(r[0]), *r[1:4], rank.get(id(r))) for r in out)


def some_documents(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)] + ["élan", "Big", "naïve", "x" * 80]
    return [(k * 7 - 300, " ".join(rng.choices(vocab, k=rng.randint(1, 90)))) for k in range(n)]


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_resampling_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(resample, "PIECE", piece)  # small pieces carry the last word on
    monkeypatch.setattr(resample, "DIGIT_BITS", 3)
    monkeypatch.setattr(resample, "BLOCK_ROWS", 16)
    docs = some_documents(piece) + list(enumerate(ODD, 10_000)) + [(None, "n " * 30), (2**40, "far " * 25), (-(2**62), "low id " * 25), (5, "w1 w2 " * 20_000)]
    target = [(k, t) for k, t in some_documents(99, 30)]
    df = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, _id string").repartition(5)
    got = resample.resample(spark, df, spark.createDataFrame(target, "item_id long, text string"))
    assert sorted((str(r["doc_id"]), r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()) == resampled(docs, target)


def test_resampling_edge_tables(spark):
    kind = "doc_id long, text string"
    none = spark.createDataFrame([], kind)
    some = spark.createDataFrame([(1, "a b c " * 10)] * 8, kind)
    assert resample.resample(spark, none, none).count() == 0
    got = resample.resample(spark, some, none).collect()  # repeated rows: as many ranks as the share says
    assert sorted(r["rank"] or 0 for r in got) == [0] * 6 + [1, 2]
    assert len({(r["weight"], r["score"]) for r in got}) == 1


def test_radix_sort_is_stable_and_dense(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.randrange(5) if k % 3 else 0, rng.randrange(2000), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long, k long").coalesce(1)
    out = resample.radix_sort(spark, df, ["a", "b"], digit_bits=4, block_rows=64)
    got = [r["k"] for r in out.orderBy("_place").collect()]
    assert got == [k for _, _, k in sorted(rows)]
    assert [r["_place"] for r in out.select("_place").orderBy("_place").collect()] == list(range(3000))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZ9é漢 -\n", max_size=150), max_size=6))
def test_feature_buckets(texts):
    got = [[] for _ in texts]
    for r1, b1, r2, b2 in resample.features(pa.array(texts, pa.string()), 10_000):
        for r, b in zip([*r1, *r2], [*b1, *b2]):
            got[r].append(int(b))
    assert [sorted(g) for g in got] == [sorted(buckets(t)) for t in texts]


# --- fill in the middle ----------------------------------------------------------------------


def filled(i, text, fim_percent=50, spm_percent=80):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    hex_ = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(hex_[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_fill_in_middle_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(fim, "PIECE", piece)
    rng = random.Random(piece)
    texts = ODD + ["".join(rng.choices("ab é漢\n\t<PSM>", k=rng.randint(1, 200))) for _ in range(150)] + ["long words " * 9000]
    rows = [(k, t, k) for k, t in enumerate(texts)] + [(None, "no id here", 0), (3, "same id", 0), (3, "same id", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    made = fim.restore_documents(fim.transform_documents(df)).collect()
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made) == Counter((i, *filled(i, t)) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["restored"]) for r in made) == Counter((i, t or "") for i, t, _ in rows)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore_documents(fim.transform_documents(none)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a é漢\n<>PSM", max_size=120), st.tuples(*[st.integers(0, 2**32 - 1)] * 4))
def test_restore_is_exact(text, draw):
    n, form, p, m, out = fim.transform(np.frombuffer(text.encode(), np.uint8), draw, 100, 50)
    assert fim.restore(out, form) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(9, 30)), min_size=1, max_size=400))
def test_skip_list_reaches_every_rank(widths):
    points, size = (np.array(c) for c in zip(*widths))
    index = fim.SkipList(points, size)
    assert [index.locate(k) for k in range(len(widths) + 1)] == list(zip([0, *np.cumsum(points)], [0, *np.cumsum(size)]))
    assert len(widths) < 200 or len(index.lanes) > 2


# --- repeated passages -----------------------------------------------------------------------


def without_repeats(texts, length):
    """(bytes, removed, spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(d), int(gone.sum()), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def passages(seed, length):
    rng = random.Random(seed)
    letters = "abcdefgh é"
    shared = ["".join(rng.choices(letters, k=rng.randint(length, 4 * length))) for _ in range(8)]
    exact = "".join(rng.choices("xyz", k=length))  # just long enough; as bytes
    texts = []
    for _ in range(50):
        own = lambda: "".join(rng.choices(letters, k=rng.randint(0, 2 * length)))
        t = own()
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            cut = rng.randint(0, len(p))
            t += rng.choice([p, p, p[cut:], p[:cut], exact, exact[1:]]) + own()
        texts.append(t)
    near = list(shared[0] * 3)
    for _ in range(12):
        near[rng.randrange(len(near))] = rng.choice(letters)
        texts.append("".join(near))
    common = "".join(rng.choices(letters, k=length + 5))
    texts += [own() + common + own() for _ in range(30)]
    return texts + [shared[1]] * 3 + [" " * (5 * length), "ab" * 3 * length, "a" * (length - 1), None, "", "q" * length, shared[2] + shared[2], exact]


@pytest.mark.parametrize(("length", "gram", "hot", "run", "piece"), [(40, 10, 20_000, 65_536, 1 << 20), (40, 20, 4, 50, 1 << 20), (24, 8, 20_000, 40, 100)])
def test_repeats_equal_brute_force(spark, monkeypatch, length, gram, hot, run, piece):
    monkeypatch.setattr(suffix_merge, "HOT", hot)  # small limits reach every path
    monkeypatch.setattr(suffix_merge, "RUN", run)
    monkeypatch.setattr(suffix_merge, "RANGE", 200)
    monkeypatch.setattr(suffix_merge, "PIECE", piece)
    texts = passages(length + gram, length)
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, t1 string").repartition(6)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_merge.remove_repeats(spark, df, length, gram).collect()}
    assert [got[k] for k in range(len(texts))] == without_repeats(texts, length)


def test_repeats_edge_tables(spark):
    kind = "doc_id long, text string"
    assert suffix_merge.remove_repeats(spark, spark.createDataFrame([], kind)).count() == 0
    long_ = "no repeat in here " + "".join(map(str, range(200)))
    rows = [(None, long_), (4, None), (4, "short"), (4, "short"), (9, "é" * 150 + "!" * 300)]
    got = suffix_merge.remove_repeats(spark, spark.createDataFrame(rows, kind)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == Counter(
        [(None, len(long_), 0, 0), (4, 0, 0, 0), (4, 5, 0, 0), (4, 5, 0, 0), (9, 600, 600, 1)]
    )


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=12), max_size=12), min_size=1, max_size=7))
def test_loser_tree_merges_front_coded_runs(lists):
    coded = [suffix_merge.decode(suffix_merge.front_code(sorted((s, b"", 1, 2, 3) for s in x))) for x in lists if x]
    if not coded:
        return
    order, lcp = suffix_merge.merge([c[:2] for c in coded])
    strings = [coded[r][0][i] for r, i in order]
    assert strings == sorted(s for x in lists for s in x)
    assert lcp == [suffix_merge.shared(a, b) for a, b in zip([b"", *strings], strings)]


def test_whole_tables(spark):
    """The queries on the driver's smallest documents."""
    from fareline.llm.queries import QUERIES

    from tests.conftest import SF0001

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    target = [(0, r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    got = QUERIES["op11_importance_resampling"](spark, SF0001).collect()
    assert sorted((str(r["doc_id"]), r["n_features"], r["weight"], r["score"], r["rank"]) for r in got) == resampled(docs, target)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_fill_in_middle"](spark, SF0001).collect()}
    want = {i: (*filled(i, t)[:4], sha(filled(i, t)[4].encode()), sha((t or "").encode())) for i, t in docs}
    assert got == want
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op13_repeated_passages"](spark, SF0001).select(F.col("*")).collect()}
    assert got == {i: (*r[:3], sha(r[3])) for (i, _), r in zip(docs, without_repeats([t for _, t in docs], 200))}

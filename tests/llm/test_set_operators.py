"""Jaccard join, nearest neighbours, source mixing, components and the pipeline against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareline.llm import fragment_join, hilbert_ann, mixing
from fareline.llm.components import connected_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def closed(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near_copies(seed, n_base=12, copies=12):
    rng = random.Random(seed)
    vocab = [f"v{k}" for k in range(400)]
    common = " ".join(rng.choices(vocab, k=40))
    out = []
    for _ in range(n_base):
        base = rng.choices(vocab, k=rng.randint(5, 150))
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w) + (" " + common if rng.random() < 0.4 else ""))
    return out + [None, "", " \n", "one", "ONE", "two words", common, common.upper(), "x " * 3000]


@pytest.mark.parametrize(("n", "percent", "short"), [(4, 85, 64), (5, 80, 3), (3, 60, 2)])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, n, percent, short):
    monkeypatch.setattr(fragment_join, "SHORT_LIST", short)  # small limits reach every path
    monkeypatch.setattr(fragment_join, "BLOCK", 1024 if short == 64 else 5)
    monkeypatch.setattr(fragment_join, "COLUMNS", 16)
    texts = near_copies(n * percent)
    docs = spark.createDataFrame([(i * 3, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, cls string")
    got = {r["doc_id"]: r for r in fragment_join.near_duplicates(spark, docs, n, percent).collect()}
    sets = {i * 3: shingle_set(t, n) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = closed(sets, links)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}


def test_jaccard_edge_tables(spark):
    kind = "doc_id long, text string"
    assert fragment_join.near_duplicates(spark, spark.createDataFrame([], kind), 4, 85).count() == 0
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (2, None), (2, "other words here now ok")]
    out = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in fragment_join.near_duplicates(spark, spark.createDataFrame(rows, kind), 4, 85).collect())
    assert out == [("2", 0, 2), ("2", 2, 2), ("5", 2, 5), ("5", 2, 5), ("None", 2, 5)]


@pytest.mark.parametrize("sizes", [[40], [6] * 7, [3, 3, 100, 101, 102, 130, 131, 200] * 4, list(range(10, 60))])
def test_blocks_compare_every_pair_that_may_be_similar_once(spark, monkeypatch, sizes):
    monkeypatch.setattr(fragment_join, "BLOCK", 3)
    families = spark.createDataFrame([(k, 1, n) for k, n in enumerate(sizes)] + [(900, 2, 5), (901, 2, 90)], "cls long, root long, n long")
    rows = fragment_join._blocks(families, 85).collect()
    met, blocks = {}, {}
    for r in rows:
        blocks.setdefault((r["root"], r["lo"], r["hi"]), []).append(r)
    for members in blocks.values():
        pairs = {frozenset((a["cls"], b["cls"])) for a in members for b in members if a["in_lo"] and b["in_hi"] and a["cls"] != b["cls"]}
        for p in pairs:
            met[p] = met.get(p, 0) + 1
    want = {frozenset(p) for p in combinations(range(len(sizes)), 2) if 100 * min(sizes[p[0]], sizes[p[1]]) >= 85 * max(sizes[p[0]], sizes[p[1]])}
    assert want <= set(met) and frozenset((900, 901)) in met
    assert max(met.values()) == 1  # none twice
    alone = [k for k, b in blocks.items() if k[1] == k[2]]  # only where no block follows
    follow = {(root, lo) for root, lo, hi in blocks if lo != hi}
    assert all((root, lo) not in follow for root, lo, _ in alone)


def test_partial_overlaps_sum_to_the_overlap():
    rng = np.random.default_rng(1)
    grams = [np.unique(rng.integers(0, 200, rng.integers(1, 90))).astype(np.uint64) for _ in range(30)]
    rows, cols = np.arange(0, 20), np.arange(10, 30)
    got = fragment_join.overlaps(grams, rows, cols)
    for i, a in enumerate(rows):
        for j, b in enumerate(cols):
            assert a == b or got[i, j] == len(np.intersect1d(grams[a], grams[b]))  # a set is not compared with itself


@pytest.mark.parametrize("short", [64, 3])
def test_jaccard_components_of_sets_cut_in_ranges(spark, monkeypatch, short):
    """Sets that come to their block pairs in many ranges of hashes, with copies of ids and texts."""
    monkeypatch.setattr(fragment_join, "RANGE", 100)
    monkeypatch.setattr(fragment_join, "SHORT_LIST", short)
    monkeypatch.setattr(fragment_join, "BLOCK", 1024 if short == 64 else 5)
    texts = near_copies(7)
    rows = [(k, t, len(t or "")) for k, t in enumerate([*texts, *texts[:20]])] + [(3, texts[3], 0), (3, texts[9], 0), (5, "only a few", 0)]
    families = spark.createDataFrame([(k, k // 5, 60, 0, 0) for k in range(20)], "cls long, root long, n long, lo int, hi int")
    assert sorted((r["root"], r["ranges"]) for r in fragment_join._ranges(families).collect()) == [(k, 3) for k in range(4)]
    got = sorted(map(tuple, fragment_join.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, x long"), 4, 85).collect()))
    sets = [shingle_set(t, 4) for _, t, _ in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = closed(range(len(rows)), links)
    least = {}
    for k, r in root.items():
        least[r] = min(least.get(r, 10**9), rows[k][0])
    assert got == sorted((rows[k][0], len(sets[k]), least[root[k]]) for k in range(len(rows)))


def test_a_block_pair_is_held_one_range_at_a_time():
    """30 MB of n-grams in 60 ranges: what numpy and Arrow hold stays a few MB, and the links are right."""
    classes, each, ranges = 200, 20_000, 60
    rng = np.random.default_rng(5)
    base = [np.sort(rng.integers(0, 2**63, each).astype(np.uint64) * np.uint64(2)) for _ in range(classes // 2)]
    size = np.full(classes, each)

    def batches():
        parts = []
        for k in range(classes):  # k + classes / 2 has nine tenths of k's n-grams
            h = base[k % len(base)].copy()
            h[::10] += np.uint64(k // len(base))
            bounds = fragment_join.cut_sets(h, size[:1], np.array([ranges]))
            assert bounds[0] == 0 and bounds[-1] == each and (np.diff(bounds) > 200).all()
            parts.append((h, bounds))
        nonlocal before
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        for r in range(ranges):
            for a in (0, classes // 2):  # a range comes in two batches
                grams = [parts[k][0][parts[k][1][r] : parts[k][1][r + 1]].tobytes() for k in range(a, a + classes // 2)]
                own = pa.array(range(a, a + classes // 2), pa.int64())
                yield pa.record_batch({"cls": own, "n": pa.array([each] * len(own), pa.int64()), "in_lo": pa.array([True] * len(own)), "in_hi": pa.array([True] * len(own)), "number": pa.array([r] * len(own), pa.int32()), "grams": pa.array(grams, pa.binary())})

    before, arrow = 0, pa.total_allocated_bytes()
    tracemalloc.start()
    out = fragment_join.links_of_pair(batches(), 80)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert sorted(zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)) == [(k + classes // 2, k) for k in range(classes // 2)]
    assert peak < 12e6 and pa.total_allocated_bytes() - arrow < 4e6


def test_ranges_without_ngrams_add_nothing():
    """A block pair of short sets, in a family cut into as many ranges as its longest sets need: most ranges hold none of its n-grams."""
    none = np.zeros(0, np.uint64)
    assert fragment_join.overlaps([none, none], np.array([0, 1]), np.array([0, 1])).tolist() == [[0, 0], [0, 0]]
    ranges, sets = 50, [np.array([5, 7 << 60], np.uint64)] * 2 + [np.array([1 << 62], np.uint64)]
    bounds = [fragment_join.cut_sets(h, np.array([len(h)]), np.array([ranges])) for h in sets]

    def batches():
        for r in range(ranges):
            grams = [h[b[r] : b[r + 1]].tobytes() for h, b in zip(sets, bounds, strict=True)]
            yield pa.record_batch({"cls": pa.array([1, 2, 3]), "n": pa.array([2, 2, 1]), "in_lo": pa.array([True] * 3), "in_hi": pa.array([True] * 3), "number": pa.array([r] * 3, pa.int32()), "grams": pa.array(grams, pa.binary())})

    assert fragment_join.links_of_pair(batches(), 85).to_pylist() == [{"a": 2, "b": 1}]


def test_long_and_short_sets_of_one_family(spark, monkeypatch):
    """Short and long texts tied by a common n-gram: the ranges follow the long ones, the short ones meet in blocks of their own."""
    monkeypatch.setattr(fragment_join, "RANGE", 50)
    monkeypatch.setattr(fragment_join, "SHORT_LIST", 2)
    monkeypatch.setattr(fragment_join, "BLOCK", 3)
    rng = random.Random(4)
    long = [" ".join(rng.choices([f"l{k}" for k in range(5000)], k=600)) for _ in range(4)]
    texts = [f"all of them have this {x}" for x in long + [x + " more" for x in long]] + [f"all of them have this end {k % 4}{' ' * k}" for k in range(8)]
    sets = [shingle_set(t, 4) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in fragment_join.near_duplicates(spark, docs, 4, 85).collect()}
    assert got == closed(range(len(texts)), links)


@pytest.mark.parametrize("percent", [60, 80, 85, 100])
def test_similar_sets_share_what_their_sizes_ask_for(spark, percent):
    """No similar pair shares fewer n-grams of its prefixes than ``shared_needed``, whatever the order is."""
    rng, cases = random.Random(percent), []
    for _ in range(4000):
        both, x, y = rng.randint(1, 60), rng.randint(0, 25), rng.randint(0, 25)
        if 100 * both >= percent * (both + x + y):
            order = list(range(both + x + y))
            rng.shuffle(order)
            if rng.random() < 0.5:
                order.sort(key=lambda g: g < both)  # what they share comes last
            a, b = ({g for g in order if g < both or (g < both + x) == side} for side in (True, False))
            first = [set(sorted(s, key=order.index)[: len(s) - (percent * len(s) + 99) // 100 + 1]) for s in (a, b)]
            cases.append((max(len(a), len(b)), min(len(a), len(b)), len(first[0] & first[1])))
    rows = spark.createDataFrame(sorted(set(cases)), "x long, y long, shared long")
    found = rows.select("shared", fragment_join.shared_needed(F.col("x"), F.col("y"), percent).alias("needed")).collect()
    assert len(found) > 5 and all(r["shared"] >= r["needed"] for r in found)
    assert percent == 100 or any(r["shared"] == r["needed"] for r in found)


@pytest.mark.parametrize("few", [0, 1, 3, 50])
@pytest.mark.parametrize("percent", [80, 85])
def test_sets_that_share_common_ngrams_only(spark, tmp_path, few, percent, monkeypatch):
    """Every pair that shares enough common n-grams for its sizes is an edge or tied through one of them."""
    monkeypatch.setattr(fragment_join, "FEW", few)
    rng = random.Random(few + percent)
    sets = {k: (rng.randint(1, 90), set(rng.sample(range(12), rng.choice([1, 1, 2, 4, 9])))) for k in range(250)}
    sets = {k: (n, set(list(g)[: n - (percent * n + 99) // 100 + 1])) for k, (n, g) in sets.items()}
    lists = spark.createDataFrame([(k, n, x) for k, (n, g) in sets.items() for x in g], "cls long, n int, gram long")
    hot = spark.createDataFrame([(x,) for x in range(12)], "gram long")
    commons, star, pairs = fragment_join._common_edges(spark, lists, hot, percent, str(tmp_path))
    assert {r["cls"]: r["common"] for r in commons.collect()} == {k: len(g) for k, (n, g) in sets.items()}
    needed = lambda x, y: -(-percent * (x + y) // (100 + percent)) - (percent * x + 99) // 100 + 1
    tied = {k for k, (n, g) in sets.items() if len(g) > few or len(g) >= needed(n, n)}
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    together = closed(tied, [(r["a"], r["b"]) for r in star.collect()])
    want = set()
    for a, b in combinations(sets, 2):
        (x, g), (y, h) = sets[a], sets[b]
        if g & h and 100 * min(x, y) >= percent * max(x, y) and needed(max(x, y), min(x, y)) <= min(len(g), len(h)):
            if a in tied and b in tied:
                assert together[a] == together[b]
            else:
                want.add((a, b))
    assert found == want and (want or few in (0, 50))


def test_unlike_sets_make_no_families(spark, tmp_path):
    """Long texts that share some phrases, but far too few to be similar, are no candidates: a family of them all would grow with the square of the table."""
    rng = random.Random(3)
    phrases = [" ".join(rng.choices([f"p{k}" for k in range(900)], k=12)) for _ in range(150)]
    texts = [" ".join(" ".join(rng.choices([f"w{j}" for j in range(3000)], k=80)) + " " + x for x in rng.sample(phrases, 4)) for _ in range(120)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + [x + " end" for x in texts[:3]])], "_id long, _text string")
    order = fragment_join.fit_order(docs, 4)
    classes = fragment_join.describe(docs, order, 4, 85)
    edges = {(r["a"], r["b"]) for r in fragment_join._candidate_edges(spark, classes, 85, str(tmp_path)).collect()}
    of = {r["_id"]: r["cls"] for r in classes.select("_id", "cls").collect()}
    assert edges == {tuple(sorted((of[k], of[120 + k]))) for k in range(3)}


def test_sketch_counts_come_back_as_they_were():
    counts = np.random.default_rng(2).integers(0, 2**32, 4096, np.uint32)
    counts[:3000] = np.arange(3000) % 3
    assert np.array_equal(fragment_join._unpack(fragment_join._pack(counts), 4096), counts)


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(500, 500), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None]
    assert got == closed({x for e in real for x in e}, real)
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        key = hilbert_ann.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(hilbert_ann, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[rng.integers(0, 12, 500)] + 0.1 * rng.normal(size=(500, 16)), np.repeat(centres[:1], 40, axis=0)]).astype(np.float32)
    rows = [(i, v.tolist(), "z") for i, v in enumerate(x)]
    bad = [(1000, None, "z"), (1001, [0.0] * 16, "z"), (1002, [float("nan")] * 16, "z"), (1010, [1.0, None] + [0.0] * 14, "z"), (None, [1.0] * 16, "z"), (1020, [1.0, 2.0], "z")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, cls string")
    got: dict = {}
    for r in hilbert_ann.search(spark, df, F.col("_id") % 10 == 0, 10).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(range(0, 540, 10))
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        assert sorted(found) == list(range(1, 11))
        assert [found[k] for k in range(1, 11)] == sorted(found.values(), key=lambda f: (f[1], f[0]))
        assert all(s == pytest.approx(d[i], abs=1e-12) for i, s in found.values())
        hit += len(set(best.tolist()) & {i for i, _ in found.values()})
    assert hit >= 0.9 * 10 * len(got)


def test_nearest_neighbours_of_few_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert hilbert_ann.search(spark, spark.createDataFrame([], kind), F.col("_id") % 10 == 0, 10).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0])], kind)
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in hilbert_ann.search(spark, few, F.col("_id") % 2 == 0, 10).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (2, 1, 0), (2, 2, 1)]


def test_nearest_neighbours_of_mixed_lengths(spark, monkeypatch):
    monkeypatch.setattr(hilbert_ann, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    widths = {0: 1, **{i: 4 for i in range(1, 41)}, **{i: 3 for i in range(41, 50)}, **{i: 5 for i in range(50, 70)}}
    x = {i: rng.normal(size=w) for i, w in widths.items()}  # one malformed vector at the smallest id
    df = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in hilbert_ann.search(spark, df, F.col("_id") % 2 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in range(0, 70, 2):
        same = [i for i in x if widths[i] == widths[q] and i != q]
        assert got.get(q, []) == sorted(same, key=lambda i: (np.linalg.norm(x[i] - x[q]), i))[:20]


def plain_targets(sizes, weights=(5, 2, 1)):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in sizes if s not in capped]
        left = goal - sum(2 * sizes[s] for s in capped)
        t = {s: 2.0 * sizes[s] for s in capped} | {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = {s for s in rest if t[s] > 2 * sizes[s]}
        if not over:
            return t
        capped |= over


def test_mixing_targets_and_totals(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        source = rng.choice(["a", "b", "B", "é", "hot", "hot", "hot", None, "tiny"])
        rows.append((i, source, " ".join(["w"] * rng.randint(0, 3 if source == "tiny" else 60)) if i % 50 else None, 1.0))
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, target double")  # clashing name
    got = mixing.mix_documents(docs).collect()
    sizes: dict = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = plain_targets(sizes), {}
    for r in got:
        assert r["_source_size"] == sizes[r["source"]] and r["_target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["_copies"] <= 2 and r["target"] == 1.0
        taken[r["source"]] = taken.get(r["source"], 0) + r["_copies"] * r["_size"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 61
    again = {r["doc_id"]: r["_copies"] for r in mixing.mix_documents(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["_copies"] for r in got}
    assert mixing.mix_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("ids", ["null", "half", "one"])
def test_mixing_meets_targets_without_ids(spark, ids):
    rows = []
    for i in range(3000):
        doc_id = None if ids == "null" or (ids == "half" and i % 2) else (5 if ids == "one" else i)
        rows.append((doc_id, "abc"[i % 3], " ".join(f"w{i}x{k}" for k in range(20))))
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_documents(docs).groupBy("source").agg(F.sum(F.col("_copies") * F.col("_size")).alias("n"), F.max("_target").alias("t")).collect()
    assert len(got) == 3 and all(abs(r["n"] - r["t"]) <= 0.01 * r["t"] for r in got)


def test_pipeline_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline as P

    rng = random.Random(3)
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(["river", "stone", "light", "field", "house", "window"]) + str(rng.randrange(300)) for _ in range(90))
        rows.append((i, text if i % 7 else rows[i - 1][1] if i else text, "en", "ab"[i % 2], 7, -1.5, "n", {"k": i}, 3, "t", "g", 0.5))
    kind = "doc_id long, text string, lang string, source string, q_kept int, _score double, _id string, _hash map<string,int>, other0 int, _place string, _group string, _u double"
    docs = spark.createDataFrame(rows, kind)
    texts = {r[0]: r[1] for r in rows}
    for name, stage in P.STAGES[:-1]:
        if name == "toxicity":
            continue  # needs labels; the wrapper is the same
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        got = out.collect()
        assert got, name
        for r in got:
            assert (r["text"], r["q_kept"], r["_score"], r["_id"], r["_hash"], r["other0"], r["_u"]) == (texts[r["doc_id"]], 7, -1.5, "n", {"k": r["doc_id"]}, 3, 0.5), name
    kept = P.one_of_each(spark, docs, "").collect()
    assert len(kept) == len(set(texts.values()))


def test_mixing_prefers_short_documents_a_little(spark):
    docs = spark.createDataFrame([(i, "s" if i % 2 else "big", "w " * (5 if i % 4 < 2 else 80)) for i in range(4000)], "doc_id long, source string, text string")
    got = [r for r in mixing.mix_documents(docs, growth=0.4, weights=(1,)).collect() if r["source"] == "s"]
    share = {n: np.mean([r["_copies"] for r in got if r["_size"] == n]) for n in (5, 80)}
    assert share[5] > share[80] > 0


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as P

    rng = random.Random(21)
    text = lambda n=60: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    base, other, nulls, shared = text(), text(), [text() for _ in range(6)], text()
    rows = [(1, base, "en"), (7, base + " end", "en"), (7, other, "en")]  # a near copy of 1, and a group of its own
    rows += [(None, t, "de") for t in nulls] + [(None, nulls[0], "de"), (None, nulls[1].upper(), "de")]
    rows += [(None, shared, "fr"), (30, shared + " end", "fr"), (20, shared, "fr"), (20, shared, "es"), (20, shared + " stop", "fr")]
    rows += [(None, None, "en"), (40, "", "en"), (40, "", "en")]  # no words: in no group
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [tuple(r) for r in P.one_of_each(spark, docs.repartition(3), "").collect()]
    plain = [r for r in got if r[1]]
    assert (1, base, "en") in plain and (7, other, "en") in plain
    assert sorted(r[1].lower() for r in plain if r[2] == "de") == sorted(nulls)  # null ids are no group
    kept = [r for r in plain if r[2] in ("fr", "es")]
    assert len(kept) == 1 and kept[0][0] == 20
    assert len(plain) == 2 + 6 + 1 and len(got) == len(plain) + 3
    again = [tuple(r) for r in P.one_of_each(spark, docs.repartition(5), "").collect()]
    assert sorted(got, key=str) == sorted(again, key=str)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(10)
    vocab = [f"w{k}" for k in range(500)]
    rows, n = [], 400  # enough labelled rows for the classifier
    toxic = {i for i in range(n) if i % 4 == 1}
    for i in range(n):
        w = rng.choices(vocab, k=80)
        if i in toxic:
            w[3], w[40], w[60] = "vile", "nasty", "foul"
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 0))
    rows += [(1000 + i, rows[i][1] + " end", "en", "s1", 0) for i in (2, 4, 6, 7, 8)]  # near copies
    rows += [(2000, None, None, None, None), (2001, "too short", "en", "s1", 0), (2002, " ".join(["a b c"] * 40), "en", "s0", 0), (3, rows[3][1], "en", "s0", 0)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(n)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append([r["doc_id"] for r in docs.collect()])
    clean = set(range(n)) - toxic
    assert not set(seen[0]) & {2000, 2001, 2002} and set(range(n)) <= set(seen[0])
    assert clean <= set(seen[1]) and len(toxic & set(seen[1])) <= 0.03 * len(toxic)
    left = set(seen[1]) & set(range(n))
    assert left == set(seen[2]) and len(seen[2]) == len(left)  # one of each group, one of repeated ids
    assert set(seen[3]) <= left and max(map(seen[3].count, set(seen[3]))) <= 2
    assert sorted(seen[4]) == sorted(seen[3])
    texts = {i: t for i, t, *_ in rows}
    assert all(r["decoded"] == texts[r["doc_id"]] for r in docs.collect())
    assert P.run(spark, str(tmp_path)).count() == len(seen[4])
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert P.run(spark, f"{tmp_path}/empty").count() == 0

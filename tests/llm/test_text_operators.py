"""Tokenizers, records, licenses, quality rules, toxicity and the language model against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fareline.llm import adaptive_quality, byte_encode, license_templates, piece_count, piece_encode, records, text, toxicity, window_lm
from fareline.llm.queries import BYTE_MODEL, PIECE_MODEL, tokenizer_path

ODD = ["", " ", "  ", "a", " a", "a ", "   a   b  ", "▁", "▁▁a", "\n\n", "a" * 300, " " * 700, "x" + " " * 37 + "y", "\x00", "<s></s><unk><0x0A>", "<|endoftext|> x", "it's a dog's  life", "日本😀 ok", "word " * 3000]


def some_texts(n=400, seed=3):
    rng = random.Random(seed)
    letters = "abcdeéñ  ▁\n\t.,0123日😀'-_AB the"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def frame(spark, texts, **extra):
    rows = [(i, t, "junk", i * 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids long")  # clashing names


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))


@pytest.fixture(scope="module")
def byte_lib():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(BYTE_MODEL))


def test_piece_encoding_and_decoding_equal_the_library(pieces):
    enc = piece_encode.encoder(tokenizer_path(PIECE_MODEL))
    for t in some_texts():
        ids = pieces.encode(t)
        assert enc.encode(t).tolist() == ids, t
        assert enc.decode(ids + [2]) == pieces.decode(ids + [2]), t


def test_piece_counts_equal_the_library(pieces):
    texts = some_texts(800, 4)
    buf, off = text.utf8(pa.array(texts))
    table = piece_count.arrays(tokenizer_path(PIECE_MODEL))
    got = np.concatenate([table.counts(buf[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in text.slices(off, 500)])
    assert got.tolist() == [len(pieces.encode(t)) for t in texts]


def test_encode_documents_rows(spark, pieces):
    docs = frame(spark, ["hello world", None, "", "hello world"])
    out = {r["doc_id"]: r for r in piece_encode.encode_documents(docs, tokenizer_path(PIECE_MODEL)).collect()}
    assert out[0]["ids"] == pieces.encode("hello world") + [2] == out[3]["ids"]
    assert out[0]["decoded"] == "hello world" and out[1]["ids"] == [2] == out[2]["ids"]
    counts = piece_count.count_documents(docs, tokenizer_path(PIECE_MODEL), 2).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counts][1:3] == [(0, 0, False)] * 2
    assert piece_encode.encode_documents(docs.limit(0), tokenizer_path(PIECE_MODEL)).count() == 0
    assert piece_count.count_documents(docs.limit(0), tokenizer_path(PIECE_MODEL), 2).count() == 0


def test_byte_ids_equal_the_library(byte_lib):
    enc = byte_encode.encoder(tokenizer_path(BYTE_MODEL))
    texts = some_texts(1200, 5) + [" ".join(random.Random(k).choices(["the", "foo's", "a.", "'s", "12", "b\nC", "é!", "x²"], k=9)) for k in range(200)]
    for at in range(0, len(texts), 100):
        for t, ids in zip(texts[at : at + 100], enc.encode_batch(texts[at : at + 100])):
            assert np.frombuffer(ids, enc.dtype).tolist() == byte_lib.encode(t, add_special_tokens=False).ids, t


def test_byte_ids_of_a_column_look_up_each_different_word_once(byte_lib):
    enc = byte_encode.ByteEncoder(tokenizer_path(BYTE_MODEL))
    texts = ["one two three two one"] * 50 + ["", " two", "two  one", "one\ntwo three"]
    column = pa.array(["left out", *texts])[1:]  # a slice, as batches are

    class Counted(dict):
        times = 0

        def get(self, *key):
            Counted.times += 1
            return super().get(*key)

    enc.words = Counted()
    got = enc.encode_batch(column)
    assert [np.frombuffer(ids, enc.dtype).tolist() for ids in got] == [byte_lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counted.times <= 2 * len({w for t in texts for w in t.split(" ")})
    assert enc.encode_batch([]) == []


def by_library(lib, texts):
    return [lib.encode(t, add_special_tokens=False).ids for t in texts]


def by_encoder(enc, texts):
    return [np.frombuffer(ids, enc.dtype).tolist() for ids in enc.encode_batch(texts)]


def test_remembered_words_are_packed_and_not_encoded_again(byte_lib, monkeypatch):
    enc = byte_encode.ByteEncoder(tokenizer_path(BYTE_MODEL))
    rng, learnt, found = random.Random(8), [], []
    words = ["".join(rng.choices("abcdeé", k=9)) for _ in range(3000)]
    texts = ["x " + " ".join(rng.choices(words, k=60)) + rng.choice([".", "!!", "", ".\nNext"]) for _ in range(400)]
    learn, find = enc._learn, byte_encode.Words.find
    monkeypatch.setattr(enc, "_learn", lambda new, known, gap: (learnt.extend(new if gap == " " else []), learn(new, known, gap)))
    monkeypatch.setattr(byte_encode.Words, "find", lambda self, new, h: (found.append(len(h)), find(self, new, h))[1])
    assert by_encoder(enc, texts) == by_library(byte_lib, texts)
    different = len({w for t in texts for w in t.split(" ")})
    assert len(learnt) == len(set(learnt)) and sum(found) <= 2 * different  # each different word is looked up and learnt once
    learnt.clear()
    assert by_encoder(enc, texts) == by_library(byte_lib, texts) and not learnt
    held = enc.young.keys.nbytes + enc.young.place.nbytes + enc.young.words.nbytes + enc.young.ids.nbytes
    assert held < 64 * len(enc.young.keys)


def test_words_of_one_hash_are_told_apart(byte_lib, monkeypatch):
    monkeypatch.setattr(byte_encode, "hashes", lambda buf, starts, ends: (ends - starts).astype(np.uint64))
    enc = byte_encode.ByteEncoder(tokenizer_path(BYTE_MODEL))
    texts = some_texts(300, 9) + ["a one two, six! ten.\nOne", "b two one, ten! six.\nTwo"]
    for at in range(0, len(texts), 50):
        assert by_encoder(enc, texts[at : at + 50]) == by_library(byte_lib, texts[at : at + 50])
    assert by_encoder(enc, texts) == by_library(byte_lib, texts)


def test_texts_without_words(byte_lib):
    for texts in ([""], ["", ""], ["a "], ["a", ""], ["x y "], [" "]):
        assert by_encoder(byte_encode.ByteEncoder(tokenizer_path(BYTE_MODEL)), texts) == by_library(byte_lib, texts)


def test_older_words_are_kept_while_they_are_met(byte_lib, monkeypatch):
    monkeypatch.setattr(byte_encode, "WORDS_CACHED", 20)
    enc = byte_encode.ByteEncoder(tokenizer_path(BYTE_MODEL))
    rng, learnt, learn = random.Random(4), [], enc._learn
    monkeypatch.setattr(enc, "_learn", lambda new, known, gap: (learnt.extend(new if gap == " " else []), learn(new, known, gap)))
    for _ in range(30):
        texts = ["the often met words " + " ".join("".join(rng.choices("abcde,é", k=6)) for _ in range(15))]
        assert by_encoder(enc, texts) == by_library(byte_lib, texts)
    assert learnt.count("often") == 1 and len(enc.young.keys) + len(enc.old.keys) < 100


def test_records_round_trip_and_index(spark, byte_lib, tmp_path):
    texts = ["b text", None, "", "long " * 4000, "again", "again"]
    docs = spark.createDataFrame([(9 - i if i else None, t, "x") for i, t in enumerate(texts)] + [(4, "again", "x")], "doc_id long, text string, id string")
    path = str(tmp_path / "records")
    records.write_records(docs, path, tokenizer_path(BYTE_MODEL), end_id=0, shard_bytes=4000)
    want = sorted(((9 - i if i else -1, t or "") for i, t in enumerate(texts)), key=lambda x: x[0]) + []
    want = sorted([*want, (4, "again")], key=lambda x: x[0])
    back = sorted(records.read_digests(spark, path).collect(), key=lambda r: r["start"])
    start = 0
    for (i, t), r in zip(want, back, strict=True):
        ids = byte_lib.encode(t, add_special_tokens=False).ids + [0]
        assert (r["id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (None if i < 0 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    index = records.read_index(spark, path)
    some = records.read_records(spark, path, index.filter("id = 9 - 3")).collect()
    assert [r["tokens"] for r in some] == [byte_lib.encode(texts[3], add_special_tokens=False).ids + [0]]
    records.write_records(docs.limit(0), path, tokenizer_path(BYTE_MODEL), end_id=0)
    assert records.read_digests(spark, path).count() == 0


def test_damaged_record_is_noticed():
    good = records.frame(5, np.array([1, 2, 10], "<u2").tobytes(), 2)
    assert [(i, t.tolist()) for i, t in records.parse(good * 2)] == [(5, [1, 2, 10])] * 2
    for at in (0, 9, 14, len(good) - 3):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.parse(bytes(bad)))


def test_license_places_and_templates(spark):
    texts = [
        "Under the GNU General-Public  License, and the gnu general public license.",
        None,
        "",
        "Licensed under the Apache License, Version 2.0. Apache License",
        "Licensed under CC BY-NC-SA 4.0",
        "This great work is licensed under the terms of the GNU General Public License, version 3.",
        "gnu general public licenses; mit xlicense",
        "Released under the MIT License.",
        "x " * 5000 + "cc by",
        "Éapache license",
    ]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = {r["doc_id"]: r for r in license_templates.scan_licenses(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
        places = {lab: [k for k in range(len(words)) if words[k : k + len(p.split())] == p.split()] for lab, p in license_templates.PHRASES}
        every = sorted(k for p in places.values() for k in p)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(every), every[0] if every else None, every[-1] if every else None)
        assert r["base_labels"] == ",".join(sorted(lab for lab, p in places.items() if p))
    assert [got[i]["labels"] for i in (3, 4, 5, 7, 9)] == ["apache,notice-apache", "cc-by,notice-cc-by", "gpl,notice-gpl", "mit,notice-mit", ""]
    assert got[6]["score"] == 0.0 and got[0]["score"] == 0.5 and got[7]["score"] == 1.0
    assert license_templates.scan_licenses(frame(spark, texts).limit(0)).count() == 0


def test_template_regions():
    auto = license_templates.compile_template("a <<opt>>b <<any*2>> c<<end>> <<var:[0-9]+*2>> d")
    accepts = lambda s: auto.length(s.encode().split(), 0) == len(s.split())
    assert all(map(accepts, ["a 1 d", "a 1 2 d", "a b x c 1 d", "a b x y c 1 d"]))
    assert not any(map(accepts, ["a d", "a 1 2 3 d", "a b c 1 d", "a b x y z c 1 d", "b 1 d"]))
    with pytest.raises(ValueError):
        license_templates.compile_template("a <<opt>>b")


def words_of(t):
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())]


def written(template, holder="the Example Foundation"):
    """A license as a user writes it: all optional words, names filled in."""
    t = re.sub(r"<<any[^>]*>>", holder, template.replace("<<opt>>", "").replace("<<end>>", ""))
    return re.sub(r"<<var:([^|>*]+)[^>]*>>", lambda m: "2" if m[1].startswith("[") else m[1], t)


def test_whole_licenses_are_accepted_and_altered_ones_refused(spark):
    whole = {label: written(t) for label, t in license_templates.TEMPLATES if label.startswith(("text-", "header-"))}
    assert len(whole) == 6
    texts, wants = [], []
    for label, t in whole.items():
        words = t.split()
        cut, swap = " ".join(words[:-1]), " ".join([*words[:-6], "never", *words[-6:]])
        for x, found in ((f"Preface. {t}. More text", True), (t.upper(), True), (cut, False), (swap, False), (" ".join(words[1:]), False)):
            texts.append(x)
            wants.append((label, found))
    texts.append("All rights reserved.")
    got = [r["labels"].split(",") for r in license_templates.scan_licenses(frame(spark, texts)).orderBy("doc_id").collect()]
    for (label, found), labels, t in zip(wants, got, texts):
        assert (label in labels) == found, (label, t[:60], t[-60:])
    assert got[-1] == [""]


def test_templates_are_an_argument_and_one_automaton_equals_single_ones(spark):
    templates = [
        ("any-first", "<<any*2>> b c"),
        ("pattern-first", "<<var:[0-9]+>> a <<opt>>b<<end>> c"),
        ("open", "a <<any*3>> c"),
        ("nested", "c <<opt>>a <<opt>>b<<end>> a<<end>> <<var:x|y*2>> b"),
        ("no-word", "<<var:[0-9]+*2>> <<var:x>>"),
        ("same", "A, b!"),
    ]
    rng = random.Random(12)
    texts = [None, "", *(" ".join(rng.choice(["a", "b", "c", "x", "y", "1", "22", "cc by", "-"]) for _ in range(rng.randint(1, 12))) for _ in range(400))]
    table = spark.createDataFrame([*templates, *templates, (None, "a"), ("null", None)], "label string, template string")
    single = [(label, license_templates.compile_template(t)) for label, t in (*license_templates.PHRASES, *templates)]
    for many in (20_000, 3):  # the second numbers its sets anew again and again
        scan = license_templates.Scanner(license_templates.template_table(templates))
        scan.MOST_SETS = many
        for t in texts:
            words = words_of(t or "")
            want = {label for label, auto in single if any(auto.length(words, k) for k in range(len(words)))}
            places, found = scan.scan(words)
            assert {scan.rules[r][0] for r in found} == want, t
            assert len(places) == sum(words[k : k + 2] == [b"cc", b"by"] for k in range(len(words)))
    rows = license_templates.scan_licenses(frame(spark, texts), templates=table, spans_col="n_tokens").collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = words_of(texts[r["doc_id"]] or "")
        runs = {label: [(k, auto.length(words, k)) for k in range(len(words))] for label, auto in single}
        want = sorted((label, *next(run for run in every if run[1])) for label, every in runs.items() if any(n for _, n in every))
        assert [tuple(s) for s in r["n_tokens"]] == want
        assert r["labels"] == ",".join(label for label, _, _ in want)
    none = license_templates.scan_licenses(frame(spark, texts), templates=[]).where("score = 1").count()
    assert none == 0


@pytest.mark.parametrize("wrong", ["a <<opt>>b", "a<<end>>", "a <<var:x", "a < b", "<<opt>>a<<end>>", "", "a <<any*0>>"])
def test_wrong_markup_is_refused(wrong):
    with pytest.raises(ValueError):
        license_templates.template_table([("label", wrong)])


def quality_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    rng = random.Random(6)
    texts = [*ODD, None, *("".join(rng.choice(["a ", "b ", "c\n", "é# ", "\t", "|"]) for _ in range(rng.randint(1, 90))) for _ in range(150))]
    docs = spark.createDataFrame([(i, t, None if i % 3 else "en", "s" if i % 2 else None, 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n int")
    rows = adaptive_quality.judge_documents(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = quality_counts(texts[r["doc_id"]])
        assert (r["q_n_words"], r["q_word_chars"], r["q_n_symbols"], r["q_n_dup_lines"], r["q_n_repeat_words"]) == want
        assert r["q_base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["q_base_failed"] and r["q_kept"])
    assert adaptive_quality.judge_documents(docs.limit(0)).count() == 0


def test_fences_follow_the_group(spark):
    """A share that is usual in one source is beyond the fence in another."""
    plain, marked = "word{0} term{0} item{0} thing{0} part{0}", "w{0}## x{0}|y a{0}$b m{0} n{0}"
    rows = []
    for i in range(400):
        t = " ".join((marked if i % 2 else plain).format(i * 50 + k) for k in range(20))
        rows.append((i, t, "en", "b" if i % 2 else "a"))
    rows.append((400, rows[1][1], "en", "a"))
    out = {r["doc_id"]: r["q_kept"] for r in adaptive_quality.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not out[400] and all(out[i] for i in range(400))


def test_sketch_buckets_and_merging(spark):
    vals = [0, 1, 63, 64, 65, 127, 128, 1000, 12345, 10**9]
    df = spark.createDataFrame([(v,) for v in vals], "v long").withColumn("b", adaptive_quality.bucket(adaptive_quality.F.col("v")))
    rows = df.withColumn("low", adaptive_quality.lowest(adaptive_quality.F.col("b"))).collect()
    for r in rows:
        assert r["low"] <= r["v"] <= r["low"] * (1 + 1 / 32) + 1e-9, r
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)


def test_toxicity_learns_and_ignores_held_out(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(900):
        body = rng.choices(words, k=rng.randint(0, 80))
        bad = i % 4 == 0
        if bad:
            body = [*body, "vile", rng.choice(words), "nasty"]
            rng.shuffle(body)
        rows.append((i, " ".join(body) or None, "tox" if bad else "x"))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    got = toxicity.score_documents(docs, model, keep=["doc_id"]).withColumn("h", toxicity.held_out(toxicity.F.col("doc_id"))).collect()
    held = [r for r in got if r["h"]]
    assert {r["doc_id"] for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum((r["_score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held)
    assert right >= 0.97 * len(held)
    flipped = marks.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    assert np.array_equal(toxicity.fit(docs, flipped)[1], model[1])  # held-out labels change nothing
    empty = toxicity.fit(docs, marks.limit(0))
    assert {r["_score"] for r in toxicity.score_documents(docs, empty).collect()} == {0.5}
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_toxicity_learns_from_the_documents_at_hand(spark):
    rng = random.Random(6)
    vocab = [f"w{k}" for k in range(80)]
    body = lambda i: " ".join(rng.choices(vocab, k=20)) + (" vile nasty" if i % 2 else " kind")
    rows = [(i, body(i)) for i in range(120)]
    kind = "doc_id long, text string"
    marks = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, kind)
    model = toxicity.fit(docs, marks, sample=200)
    assert len(model[0]) > 1
    wide = marks.unionByName(spark.range(10_000, 20_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic"))
    assert np.array_equal(toxicity.fit(docs, wide, sample=200)[1], model[1])  # labels of other documents use up nothing
    hot = next(i for i in range(0, 120, 2) if zlib.crc32(str(i).encode()) % 3 != 1)
    copies = docs.unionByName(docs.filter(f"doc_id = {hot}").crossJoin(spark.range(500)).select("doc_id", "text"))
    assert np.array_equal(toxicity.fit(copies, marks, sample=200)[1], model[1])  # nor do copies of a row
    texts = docs.unionByName(spark.range(500).selectExpr(f"{hot}L AS doc_id", "concat('text ', id) AS text"))
    scored = toxicity.score_documents(docs, toxicity.fit(texts, marks, sample=200)).collect()
    assert all((r["_score"] >= toxicity.THRESHOLD) == bool(r["doc_id"] % 2) for r in scored)  # nor do an id's other texts


def test_ftrl_scores_equal_plain_sums():
    model = toxicity.train([(np.unique(toxicity.features(*text.utf8(pa.array([t])))[0]), y) for t, y in [("bad day", 1), ("good day", 0)] * 20])
    scorer, weights = toxicity.Scorer(*model), dict(zip(*(x.tolist() for x in model)))
    texts = ["bad", "good day today", "", "bad bad day", "day " * 50 + "bad"]
    buf, off = text.utf8(pa.array(texts))
    for t, got in zip(texts, scorer.scores(buf, off)):
        f = set(toxicity.features(*text.utf8(pa.array([t])))[0].tolist())
        total = weights.get(0, 0.0) + sum(weights.get(x, 0.0) for x in f)
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def plain_ftrl(rows, epochs):
    """FTRL-proximal row by row over dicts of all features."""
    z, n, bias = Counter(), Counter(), int(toxicity.BIAS)

    def weight(f):
        l1 = 0.0 if f == bias else toxicity.L1
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - (l1 if z[f] > 0 else -l1)) / ((toxicity.BETA + n[f] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for features, label in rows:
            w = {f: weight(f) for f in [bias, *features.tolist()]}
            g = 1.0 / (1.0 + np.exp(-sum(w.values()))) - label
            for f, x in w.items():
                z[f] += g - ((n[f] + g * g) ** 0.5 - n[f] ** 0.5) / toxicity.ALPHA * x
                n[f] += g * g
    return {f: weight(f) for f in z if weight(f) != 0.0}


@pytest.mark.parametrize("epochs", [1, 3, 6, 12])
def test_ftrl_training_equals_a_plain_loop(epochs):
    rng = random.Random(epochs)
    vocab = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(150):
        t = " ".join([*rng.choices(vocab, k=rng.randint(0, 12)), *(["vile", "nasty"] if i % 3 == 0 else []), *(["seldom"] if i in (3, 9, 30) else [])])
        rows.append((np.unique(toxicity.features(*text.utf8(pa.array([t])))[0]), int(i % 3 == 0)))
    got = dict(zip(*(x.tolist() for x in toxicity.train(rows, epochs))))
    want = plain_ftrl(rows, epochs)
    assert set(got) == set(want) and len(want) > 3
    assert all(got[f] == pytest.approx(w, rel=1e-9, abs=1e-12) for f, w in want.items())
    assert [len(x) for x in toxicity.train([])] == [0, 0]


def test_training_takes_little_more_than_its_rows():
    import tracemalloc

    rng = np.random.default_rng(0)
    rows = [(np.unique(rng.integers(1, 1 << 20, 900).astype(np.uint64)), k % 2) for k in range(3000)]
    tracemalloc.start()
    toxicity.train(rows, epochs=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.6 * sum(f.nbytes for f, _ in rows)  # 3.2 before


def test_words_that_an_encoder_keeps_are_bounded(pieces):
    enc = piece_encode.BacktrackEncoder(piece_encode.load(tokenizer_path(PIECE_MODEL)))
    at_a_time = [f"w{k}" for k in range(450_000)]
    assert enc.encode(" ".join(at_a_time[-500:])).tolist() == pieces.encode(" ".join(at_a_time[-500:]))
    enc.words.make = lambda w: b"\x00" * 8
    for w in at_a_time:
        enc.words[w]
    assert len(enc.words) + len(enc.words.old) <= 400_000  # they stay in the worker while it serves other stages


def test_language_model_scores_equal_a_plain_loop(spark):
    texts = ["the cat sat on the mat", None, "", "one", "the dog sat on the log . " * 30, "The Cat\tsat"]
    docs = frame(spark, texts)
    frequent, weights = window_lm.train(docs)
    got = {r["doc_id"]: r for r in window_lm.score_documents(docs, (frequent, weights)).collect()}
    net = window_lm.Network(weights)
    for i, t in enumerate(texts):
        buf, off = text.utf8(pa.array([t or ""]))
        token, _ = window_lm.tokens(buf, off, frequent)
        total = 0.0
        for k in range(len(token)):
            hidden = np.zeros(window_lm.SIZE)
            for d in range(1, window_lm.WINDOW + 1):
                left = token[k - d] if k - d >= 0 else window_lm.EDGE
                right = token[k + d] if k + d < len(token) else window_lm.EDGE
                hidden += net.emb[2 * d - 2][left] + net.emb[2 * d - 1][right]
            z = np.tanh(hidden) @ net.out + net.bias
            total += z[token[k]] - np.log(np.exp(z).sum())
        assert got[i]["n_tokens"] == len(token)
        assert got[i]["log_prob"] == pytest.approx(total, abs=1e-3 * max(1, len(token)))
    assert got[1]["perplexity"] is None and got[2]["log_prob"] == 0.0
    assert window_lm.score_documents(docs.limit(0), (frequent, weights)).count() == 0


def test_language_model_learns(spark):
    rng = random.Random(8)
    texts = [" ".join(x for _ in range(60) for x in rng.choice([("red", "fox"), ("blue", "sky"), ("old", "oak")])) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    frequent, counts = window_lm.vocabulary(docs)
    mean = lambda w: np.mean([r["log_prob"] / r["n_tokens"] for r in window_lm.score_documents(docs, (frequent, w)).collect()])
    before, after = mean(window_lm.Network.start(counts)), mean(window_lm.train(docs, rounds=1)[1])
    assert after > before + 0.5


@pytest.mark.parametrize("common", [0, 150, 1 << 18])
def test_language_model_gives_each_word_its_own_probability(spark, monkeypatch, common):
    monkeypatch.setattr(window_lm, "COMMON", common)
    rng = random.Random(12)
    vocab = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choices(vocab, weights=[1 / (k + 1) for k in range(300)], k=60)) for _ in range(80)] + [None, ""]
    docs = frame(spark, texts)
    words = window_lm.word_counts(docs)
    times = Counter(w for t in texts for w in (t or "").split())
    assert sorted(r["n"] for r in words.collect()) == sorted(times.values())  # every word, as often as it stands
    frequent, weights = model = window_lm.train(docs, words=words)
    net, mass = window_lm.Network(weights), Counter()

    def coded(t):
        buf, off = text.utf8(pa.array([t]))
        return window_lm.tokens(buf, off, frequent)

    of = {w: int(coded(w)[0][0]) for w in times}
    for w, n in times.items():
        mass[of[w]] += n
    asked = [(0, texts[0]), (0, texts[0]), (None, texts[1]), (3, None), (4, "w0 neverseen w250"), (5, "w1 alsounseen w299")]
    got = window_lm.score_documents(spark.createDataFrame(asked, "doc_id long, text string"), model, words=words).collect()
    want = []
    for i, t in asked:
        token, bounds = coded(t or "")
        total = net.log_probs(token, bounds).sum()
        for w, c in zip((t or "").split(), token):
            if c >= window_lm.FREQUENT:
                total += np.log(times.get(w, 1) / (mass[c] + 1))
        want.append((str(i), len(token), pytest.approx(total, abs=1e-3)))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["log_prob"]) for r in got) == sorted(want, key=lambda x: x[0])
    assert {r["doc_id"]: r["perplexity"] for r in got}[3] is None


def test_language_model_spreads_all_probability_over_all_words(spark):
    """In one context, the probabilities of every word of the corpus and of one it does not hold sum to 1."""
    rng = random.Random(21)
    vocab = [f"w{k}" for k in range(260)]
    docs = frame(spark, [" ".join(vocab)] + [" ".join(rng.choices(vocab[:150], k=50)) for _ in range(40)])
    words = window_lm.word_counts(docs)
    frequent, weights = window_lm.train(docs, words=words)
    net, totals = window_lm.Network(weights), window_lm.class_totals(words, frequent)
    left, right = (int(window_lm.tokens(*text.utf8(pa.array([w])), frequent)[0][0]) for w in ("w3", "w200"))
    bounds = np.array([0, 3])
    of_class = np.exp([net.log_probs(np.array([left, c, right]), bounds)[1] for c in range(window_lm.VOCAB)])
    total, met = 0.0, set()
    for r in words.collect():
        c = int(window_lm.classes(np.array([r["h"]], np.int64).view(np.uint64), frequent)[0])
        total += of_class[c] * (r["n"] / (totals[c - window_lm.FREQUENT] + 1) if c >= window_lm.FREQUENT else 1)
        met.add(c)
    assert len(met) == window_lm.VOCAB  # every class is in use
    total += sum(of_class[c] / (totals[c - window_lm.FREQUENT] + 1) for c in range(window_lm.FREQUENT, window_lm.VOCAB))
    assert total == pytest.approx(1, abs=1e-5)

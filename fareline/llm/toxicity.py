"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Every text becomes the set of its hashed features: words, neighbouring words, and words with one
word between them. Labelled rows are learnt in a fixed order with one learning rate per coordinate
(FTRL-proximal); the L1 term keeps weights of rare or uninformative features at exactly zero, so
the model is a short list of (feature, weight) pairs that is sent to every task.

The classifier is fitted on at most ``SAMPLE`` labelled rows of the documents at hand, half of them from the
ids of each class with the smallest hash; scoring covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.text import ALNUM, LOWER, U64, give_back, hashes, mix, slices, spans, utf8

SAMPLE = 6000  # labelled rows that the classifier is fitted on, at most; half of them of each class
EPOCHS, ALPHA, BETA, L1, L2 = 6, 1.0, 1.0, 6.0, 0.1
THRESHOLD = 0.7
BIAS = U64(0)
SLICE = 1 << 18  # bytes of text scored at once: their features take some 30 times as much

_PAIR, _SKIP, _NEXT = U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3)


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts in a UTF-8 buffer and the row of each; repeats are kept."""
    low = LOWER[buf]
    starts, ends = spans(low, offsets, ALNUM)
    word = hashes(low, starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    out, rows = [word], [row]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        same = row[gap:] == row[:-gap]
        out.append(mix(word[:-gap][same] * salt + word[gap:][same] * _NEXT))
        rows.append(row[gap:][same])
    f = np.concatenate(out)
    return np.where(f == BIAS, U64(1), f), np.concatenate(rows)


def train(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) without zeros, from (distinct features, label) rows learnt in order.

    A gradient is below 1, so the sum of a feature's gradients cannot pass L1 in ``L1 / epochs`` rows or fewer:
    such features would stay at zero, where they change no other weight, and are left out.
    """
    every = np.concatenate([np.zeros(0, U64), *(f for f, _ in rows)])
    every.sort()
    last = np.flatnonzero(np.append(every[1:] != every[:-1], True)) if len(every) else np.zeros(0, np.int64)  # of each feature
    often = np.diff(last, prepend=-1) * epochs > L1
    names = np.append(BIAS, every[last[often]])  # sorted: the bias is 0
    del every, last, often  # several times the model; the task goes on beside others
    coded = []
    for f, label in rows:
        at = np.minimum(np.searchsorted(names, f), len(names) - 1)
        coded.append((np.append(0, at[names[at] == f]).astype(np.int32), label))
    z, n = np.zeros(len(names)), np.zeros(len(names))

    def weights(zi: np.ndarray, ni: np.ndarray, l1: np.ndarray | float) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    l1 = np.full(len(names), L1)
    l1[0] = 0.0  # the bias is not held at zero
    for _ in range(epochs):
        for at, label in coded:
            w = weights(z[at], n[at], l1[at])
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(z, n, l1)
    keep = w != 0.0
    return names[keep], w[keep]


class Scorer:
    """Sums the weights of each text's distinct features; a bitmap drops nearly all other features first."""

    BITS = 22

    def __init__(self, names: np.ndarray, weights: np.ndarray):
        order = np.argsort(names)
        self.names, self.weights = names[order], weights[order]
        self.bias = float(self.weights[self.names == BIAS].sum())
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[(self.names >> U64(64 - self.BITS)).astype(np.int64)] = True

    def scores(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.bias)
        f, row = features(buf, offsets)
        some = self.seen[(f >> U64(64 - self.BITS)).astype(np.int64)]
        f, row = f[some], row[some]
        if len(f) and len(self.names):
            at = np.minimum(np.searchsorted(self.names, f), len(self.names) - 1)
            hit = self.names[at] == f
            pairs = np.unique(np.stack([row[hit], at[hit]], axis=1), axis=0)
            np.add.at(total, pairs[:, 0], self.weights[pairs[:, 1]])
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3: never learnt from."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Learn from labelled rows that are not held out; returns the sparse weights (bounded by the sample).

    An id labelled more than once counts as toxic if any of its labels says so; null ids and labels
    are skipped, and so are labels of ids that are not in ``docs``. Every different text of an id is learnt
    once; each id's first text comes before any id's second, up to ``sample`` rows.
    Without labelled rows the model is empty and every score is 0.5.
    """
    marks = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_y"))
    marks = marks.filter(~held_out(F.col("_id"))).withColumn("_h", F.xxhash64("_id"))
    marks = marks.withColumn("_y", (F.col("_y") > 0).cast("int"))
    marks = marks.join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi")
    each = [marks.filter(F.col("_y") == y).orderBy("_h", "_id").limit(sample // 2) for y in (0, 1)]
    marks = each[0].unionByName(each[1])  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    some = rows.join(F.broadcast(marks), "_id").select("_h", "_id", "_y", "_text").distinct().withColumn("_t", F.xxhash64("_text"))
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy("_t"))).filter(F.col("_n") <= sample)
    some = some.orderBy("_n", "_h", "_id").limit(sample).orderBy("_h", "_id", "_t").limit(sample)  # learnt in the order of the hashes

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = []
        for batch in batches:
            buf, off = utf8(batch.column(1))
            labels_ = batch.column(0).to_pylist()
            for k, y in enumerate(labels_):
                f, _ = features(buf[off[k] : off[k + 1]], np.array([0, off[k + 1] - off[k]]))
                coded.append((np.unique(f), int(y)))
        names, weights = train(coded) if coded else (np.zeros(0, U64), np.zeros(0))
        coded.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(weights)], names=["name", "weight"])

    # one task: the sample is bounded
    model = some.select("_y", "_text").coalesce(1).mapInArrow(learn, "name long, weight double").toArrow()
    return model["name"].to_numpy().astype(np.int64).view(U64), model["weight"].to_numpy()


def score_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with _score (0 to 1) of each text; no shuffle.

    A null text counts as empty and gets the score of the bias alone. Repeated rows give repeated
    results; all other columns pass through (the name _score is reserved).
    """
    names, weights = model
    keep = [c for c in (docs.columns if keep is None else keep) if c != "_score"]
    docs = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("_score"))  # the text's place becomes the score's
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(names, weights)
        for batch in batches:
            buf, off = utf8(batch.column(len(keep)))
            s = [scorer.scores(buf[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in slices(off, SLICE)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(s) if s else np.zeros(0))], names=batch.schema.names)
        give_back()

    return docs.mapInArrow(run, schema)

"""Corpus pipeline: quality rules, toxicity, near duplicates, source mixing, piece encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``docs``. The stages see doc_id, text,
lang and source; every other column goes through under a name of its own, whatever it was called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from fareline.llm import adaptive_quality, fragment_join, mixing, piece_encode, toxicity
from fareline.llm.queries import PIECE_MODEL, tokenizer_path
from fareline.session import scratch_path, shared_dir

KNOWN = ("doc_id", "text", "lang", "source")
WORDS, PERCENT = 5, 80  # near duplicates: words in a shingle, similarity


def beside(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with the columns it does not know kept out of the way of its own."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in KNOWN else f"other{k}" for k, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), sf_dir)
        return out.select(*(F.col(n).alias(c) for c, n in names.items()))

    return run_stage


@beside
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. They are counted once and stored with their counts, which the
    sketches and the verdict read."""
    path = scratch_path(spark, "quality_counts")
    adaptive_quality.with_counts(docs).write.parquet(path)
    counted = spark.read.parquet(path)
    shared_dir(spark)  # checkpoint() writes to the shared checkpoint folder
    limits = adaptive_quality.fences(adaptive_quality.sketches(counted, "lang", "source").checkpoint())
    return adaptive_quality.judge(counted, limits).filter("q_kept")


@beside
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; fitted on the labelled ones among them."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model).filter(F.col("_score") < toxicity.THRESHOLD)


@beside
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest id (null last), then the smallest hash of the
    text, then the smallest other columns. Rows without words are in no group and all stay."""
    groups = fragment_join.near_duplicates(spark, docs, WORDS, PERCENT, with_group=True)
    key = [F.col("doc_id").alias("_id"), F.col("_text_hash")]
    each = groups.groupBy("_group", *key).agg(F.count(F.lit(1)).alias("_rows"))
    alone = F.when(F.col("_group").isNull(), F.struct("_id", "_text_hash"))
    first = F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_text_hash", "_rows")).alias("f")
    stay = each.groupBy("_group", alone.alias("_alone")).agg(first)
    one = F.col("_group").isNull() | (F.col("f._rows") == 1)
    stay = stay.select(F.col("f._id").alias("_stays"), F.col("f._text_hash").alias("_with"), one.alias("_one"))
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    rows = hashed.join(stay, hashed["doc_id"].eqNullSafe(stay["_stays"]) & (hashed["_hash"] == stay["_with"]))
    others = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text") and not isinstance(f.dataType, MapType)]
    same = Window.partitionBy("doc_id", "_hash").orderBy(*others, F.lit(0))
    many = rows.filter("not _one").withColumn("_place", F.row_number().over(same)).filter("_place = 1")
    return rows.filter("_one").select(docs.columns).unionByName(many.select(docs.columns))


@beside
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    path = scratch_path(spark, "mix_sizes")
    mixing.with_sizes(docs, "doc_id", "text", "source").select("_id", "_source", "_size", "_u").write.parquet(path)
    out = mixing.mix_documents(docs, spark.read.parquet(path)).filter("_copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every row."""
    return piece_encode.encode_documents(docs, tokenizer_path(PIECE_MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("mix", mixed),
    ("sentencepiece", encoded),
]

#: None: SQL has neither the classifier nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs

"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "PIECE_MODEL", "QUERIES", "tokenizer_path"]

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.license_templates import scan_licenses

    return scan_licenses(_documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm import adaptive_quality as Q
    from fareline.session import scratch_path

    path = scratch_path(spark, "quality_counts")  # the counts are read twice: for the sketches and for the verdict
    Q.with_counts(_documents(spark, sf_dir).select("doc_id", "text", "lang", "source")).drop("text").write.parquet(path)
    counted = spark.read.parquet(path)
    out = Q.judge(counted, Q.fences(Q.sketches(counted, "lang", "source")))
    return out.select("doc_id", *(F.col(f"q_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.mixing import mix_documents, with_sizes
    from fareline.session import scratch_path

    docs = _documents(spark, sf_dir).select("doc_id", "source", "text")
    path = scratch_path(spark, "mix_sizes")
    with_sizes(docs, "doc_id", "text", "source").select("_id", "_source", "_size", "_u").write.parquet(path)
    sized = spark.read.parquet(path)
    mixed = mix_documents(docs, sized)
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.records import read_digests, write_records
    from fareline.session import scratch_path

    path = scratch_path(spark, "token_records")
    write_records(_documents(spark, sf_dir), path, tokenizer_path(BYTE_MODEL), end_id=0)
    return read_digests(spark, path).withColumnRenamed("id", "doc_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.piece_encode import encode_documents

    return encode_documents(_documents(spark, sf_dir), tokenizer_path(PIECE_MODEL), digest=True)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.piece_count import count_documents

    return count_documents(_documents(spark, sf_dir), tokenizer_path(PIECE_MODEL), limit=4096)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.fragment_join import near_duplicates

    return near_duplicates(spark, _documents(spark, sf_dir), n=4, percent=85)


def op6_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.hilbert_ann import search

    return search(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("_id") % 100 == 0, k=10)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm import toxicity as T

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = T.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = T.score_documents(docs, model, keep=["doc_id"])
    return scored.select("doc_id", T.held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= T.THRESHOLD).cast("int").alias("predicted"))


def op10_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm import window_lm as L

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    words = L.word_counts(docs)
    return L.score_documents(docs, L.train(docs, words=words), words=words)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.resample import resample

    return resample(spark, _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=25, least_words=20, seed=7)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.fim import restore_documents, transform_documents

    made = restore_documents(transform_documents(_documents(spark, sf_dir), seed=42, fim_percent=50, spm_percent=80))
    sha = [F.sha2(F.col(c).cast("binary"), 256).alias(a) for c, a in (("output", "output_sha256"), ("restored", "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sha)


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fareline.llm.suffix_merge import remove_repeats

    return remove_repeats(spark, _documents(spark, sf_dir), length=200, digest=True).withColumnRenamed("kept", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_records": op2_token_records,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality_rules": op4_quality_rules,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_hilbert_ann": op6_hilbert_ann,
    "op7_source_mix": op7_source_mix,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_masked_lm": op10_masked_lm,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_repeated_passages": op13_repeated_passages,
}

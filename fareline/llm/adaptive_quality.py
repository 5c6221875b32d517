"""Quality rules with adaptive thresholds; Spark built-ins only.

Every document gets counts (words, symbols, duplicate lines, words in repeated 3-word windows) and
shares per mille. The shares of all documents of a language and source go into a mergeable quantile
sketch: a histogram whose bucket widths grow with the value (relative error 1/32), so that sketches
merge by adding counts, in any order, with the same result. A group's fence for each share is

    upper quartile + SPREAD * (upper quartile - lower quartile) + margin,

read from its own sketch, or, for groups of fewer than LEAST documents, from the merged sketch of
their language, or of everything. Documents are joined with the fences of their group and rejected
beyond any of them. A histogram has at most a few thousand buckets for any number of documents, and
it is pre-aggregated before the shuffle, so a hot language or source costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.session import shared_dir

# White space of words, symbol characters.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
LEAST = 200  # documents for a fence of the group's own
SPREAD = 3
SUB_BITS = 5  # 32 buckets per doubling
#: per-mille shares under an upper fence, with the margin that holds where a share hardly varies
MARGINS = {"symbol_share": 60, "mark_share": 60, "upper_share": 250, "dup_line_share": 500, "repeat_share": 350}


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts in columns prefixed ``q_``; a null text counts as empty.

    Repeated windows are found by sorting 64-bit hashes of the 3-word windows of one text with their
    places; no text is exploded into rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn("q_words_", F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    d = d.withColumn("q_lines_", F.filter(F.split(text, "\n", -1), lambda x: _without(x, SPACES) > 0))
    n_words = F.size("q_words_")
    w = F.col("q_words_")
    d = d.withColumn(
        "q_grams_",
        F.when(n_words >= 3, F.transform(F.sequence(F.lit(0), n_words - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>")),
    )
    # windows beside an equal one once sorted; none if all are distinct
    some = F.size(F.array_distinct("q_grams_")) < F.size("q_grams_")
    d = d.withColumn("q_sorted_", F.when(some, F.sort_array(F.transform("q_grams_", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    s = F.col("q_sorted_")
    again = F.filter(s, lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    d = d.withColumns(
        {
            "q_n_words": n_words.cast("long"),
            "q_word_chars": _without(text, SPACES).cast("long"),
            "q_n_symbols": (F.length(text) - _without(text, SYMBOLS)).cast("long"),
            "q_n_marks": (F.length(text) - _without(text, "!")).cast("long"),
            "q_n_upper": (F.length(text) - _without(text, UPPER)).cast("long"),
            "q_n_lines": F.size("q_lines_").cast("long"),
            "q_n_dup_lines": (F.size("q_lines_") - F.size(F.array_distinct("q_lines_"))).cast("long"),
            "q_n_repeat_words": F.when(some, F.size(covered)).otherwise(0).cast("long"),
        }
    )
    d = d.drop("q_words_", "q_lines_", "q_grams_", "q_sorted_")

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.floor(F.col(part) * 1000 / F.col(whole))).otherwise(0).cast("long")

    d = d.withColumns(
        {
            "q_symbol_share": share("q_n_symbols", "q_word_chars"),
            "q_mark_share": share("q_n_marks", "q_word_chars"),
            "q_upper_share": share("q_n_upper", "q_word_chars"),
            "q_dup_line_share": share("q_n_dup_lines", "q_n_lines"),
            "q_repeat_share": share("q_n_repeat_words", "q_n_words"),
        }
    )
    return d.withColumn("q_base_failed", (F.col("q_n_words") < LEAST_WORDS) | (F.col("q_n_repeat_words") * 100 > F.col("q_n_words") * MOST_REPEATED))


def bucket(v: Column) -> Column:
    """Histogram bucket of a whole number >= 0: exact below 64, then 32 per doubling."""
    shift = F.greatest(F.length(F.bin(v)) - (SUB_BITS + 1), F.lit(0))
    return F.floor(v / F.pow(F.lit(2), shift)).cast("long") + shift * (1 << SUB_BITS)


def lowest(b: Column) -> Column:
    """Smallest number of a bucket."""
    shift = F.greatest(F.floor(b / (1 << SUB_BITS)) - 1, F.lit(0))
    return ((b - shift * (1 << SUB_BITS)) * F.pow(F.lit(2), shift)).cast("long")


def sketches(counted: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """One row per language, source, share and bucket: n documents that pass the base rules."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("share"), bucket(F.col(f"q_{m}")).alias("b")) for m in MARGINS)))
    # counted conditionally: a filter would be pushed below the projections and repeat their work
    ok = counted.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), (~F.col("q_base_failed")).cast("long").alias("ok"), pairs.alias("x"))
    return ok.groupBy("lang", "source", F.col("x.share").alias("share"), F.col("x.b").alias("b")).agg(F.sum("ok").alias("n")).filter("n > 0")


def _fences(sketch: DataFrame, keys: list[str], spread: int) -> DataFrame:
    merged = sketch.groupBy(*keys, "share", "b").agg(F.sum("n").alias("n"))
    part = Window.partitionBy(*keys, "share")
    merged = merged.withColumn("upto", F.sum("n").over(part.orderBy("b"))).withColumn("total", F.sum("n").over(part))
    at = {q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("b"))) for q in (1, 3)}
    out = merged.groupBy(*keys, "share").agg(F.max("total").alias("total"), lowest(at[1]).alias("low"), lowest(at[3]).alias("high"))
    return out.withColumn("fence", F.col("high") + (F.col("high") - F.col("low")) * spread)


def fences(sketch: DataFrame, least: int = LEAST, spread: int = SPREAD) -> DataFrame:
    """One row per language and source with a fence for each share (``q_fence_<share>``).

    The own sketch counts if it holds ``least`` documents, else the language's, else the one of all.
    Null is a group of its own.
    """
    own = _fences(sketch, ["lang", "source"], spread)
    by_lang = _fences(sketch, ["lang"], spread).select(F.col("lang").alias("l"), F.col("share").alias("s"), F.col("total").alias("t2"), F.col("fence").alias("f2"))
    overall = _fences(sketch, [], spread).select(F.col("share").alias("s3"), F.col("fence").alias("f3"))
    x = own.join(by_lang, own["lang"].eqNullSafe(by_lang["l"]) & (own["share"] == by_lang["s"])).join(overall, F.col("share") == F.col("s3"))
    x = x.withColumn("f", F.when(F.col("total") >= least, F.col("fence")).when(F.col("t2") >= least, F.col("f2")).otherwise(F.col("f3")))
    return x.groupBy("lang", "source").agg(*(F.max(F.when(F.col("share") == m, F.col("f") + margin)).alias(f"q_fence_{m}") for m, margin in MARGINS.items()))


def judge(counted: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Adds q_kept: passes the base rules and no share is beyond its group's fence."""
    limits = limits.withColumnsRenamed({"lang": "q_l", "source": "q_s"})
    out = counted.join(limits, counted[lang_col].eqNullSafe(F.col("q_l")) & counted[source_col].eqNullSafe(F.col("q_s")), "left")
    beyond = F.lit(False)
    for m in MARGINS:
        beyond = beyond | F.coalesce(F.col(f"q_{m}") > F.col(f"q_fence_{m}"), F.lit(False))
    # one expression over both sides of the join, which no filter on it can take apart and push down
    return out.withColumn("q_kept", F.when(beyond, False).otherwise(~F.col("q_base_failed"))).drop("q_l", "q_s", *(f"q_fence_{m}" for m in MARGINS))


def judge_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", limits: DataFrame | None = None) -> DataFrame:
    """``docs`` with the counts and the verdict (columns ``q_...``), one row per row.

    Null and empty texts have no words and fail the base rules. Documents of any group, null
    languages and sources included, are measured against that group's fences. An empty table gives
    an empty result; columns of other names than ``q_...`` pass through untouched.
    """
    counted = with_counts(docs, text_col)
    if limits is None:
        shared_dir(docs.sparkSession)  # checkpoint() writes to the shared checkpoint folder
        limits = fences(sketches(counted, lang_col, source_col).checkpoint())  # read three times, made once
    return judge(counted, limits, lang_col, source_col)

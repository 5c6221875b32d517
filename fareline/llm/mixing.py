"""Mixing sources to target weights by Pareto order sampling; Spark built-ins only.

Sources get target sizes in words by weight, capped at twice their own size. In a source with
target / size = c + f, every document gets c certain whole copies, and a sample of one further copy
fills the rest: each document has the ranking variable

    q = odds(u) / odds(p),    odds(p) = f / (1 - f) * (mean size / size) ** TILT,

with a random u fixed by the document's id and text, and the smallest q are taken up to the fixed total of
words. TILT favours shorter documents a little, so that one very long document does not decide a
small source's sample. The cut is found without sorting a source in one task: sizes are summed per
bucket of q, and only the bucket that holds the cut is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.operators.lookups import maybe_broadcast
from fareline.session import shared_dir

WEIGHTS = (5, 2, 1)  # by source in code-point order, repeating
GROWTH = 1.5  # size of the mix over the size of the input
MOST_COPIES = 2
TILT = 0.5
BUCKETS = 4096
SEED = "mix-1"

WORD = r"[^\x20\x09-\x0D]+"


def with_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with _id, _source, _size (words; null text 0) and _u in (0, 1)."""
    named = F.concat_ws("|", F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    u = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("long")
    return docs.withColumns(
        {
            "_id": F.col(id_col),
            "_source": F.col(source_col),
            "_size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long")),
            "_u": (u + F.lit(0.5)) / F.lit(float(1 << 52)),
        }
    )


def targets(sized: DataFrame, weights=WEIGHTS, growth: float = GROWTH, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: _source, _source_size, _n_docs, _target.

    The share per weight unit rises until the targets sum to ``growth`` times the input (or every
    source is at its cap): sources are capped in the order of cap / weight. Null is a source of its
    own and comes last.
    """
    per = sized.groupBy("_source").agg(F.sum("_size").alias("_source_size"), F.count(F.lit(1)).alias("_n_docs"))
    # from here on one row per source
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    per = per.withColumn("w", weight).withColumn("cap", F.col("_source_size") * F.lit(float(most)))
    total = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("_source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("place", F.row_number().over(by_cap))
    per = per.withColumn("goal", F.sum("_source_size").over(total) * F.lit(growth))
    per = per.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("w_left", F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    level = (F.col("goal") - F.col("capped")) / F.col("w_left")  # if the sources before are at their caps
    per = per.withColumn("open", F.when(F.col("w") * level < F.col("cap"), level))
    # the level of the first source that stays below its cap holds for all after it
    first_open = F.min(F.when(F.col("open").isNotNull(), F.struct("place", "open"))).over(total)
    per = per.withColumn("level", first_open["open"])
    return per.select("_source", "_source_size", "_n_docs", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("w"))).alias("_target"))


def _rank(sized: DataFrame, per: DataFrame, tilt: float) -> DataFrame:
    """Adds whole copies, the words left to fill, and the ranking variable with its bucket."""
    per = per.withColumnRenamed("_source", "_of")
    rows = sized.join(per, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    ratio = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("_whole", F.floor(ratio)).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    f = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), ratio - F.col("_whole")))
    mean = F.col("_source_size") / F.col("_n_docs")
    odds = f / (1 - f) * F.pow(mean / F.greatest(F.col("_size"), F.lit(1)), F.lit(tilt))
    rows = rows.withColumn("_q", F.col("_u") / (1 - F.col("_u")) / odds)
    return rows.withColumn("_bucket", F.floor(F.col("_q") / (1 + F.col("_q")) * BUCKETS))


def _per_source(table: DataFrame) -> DataFrame:
    """A table of one row per source: stored once, and sent to all tasks if its size allows; otherwise
    Spark joins it by shuffle and splits skewed sources at run time."""
    shared_dir(table.sparkSession)  # checkpoint() writes to the shared checkpoint folder
    return maybe_broadcast(table.checkpoint())


def mix_documents(docs: DataFrame, sized: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, growth: float = GROWTH, most: int = MOST_COPIES, tilt: float = TILT) -> DataFrame:
    """``docs`` with _size, _source_size, _target and _copies (how often the mix takes the row).

    Other columns of ``docs`` pass through; names with a leading underscore are reserved.

    ``sized``: the result of ``with_sizes`` without the text, stored by the caller so that sizes are
    counted once; by default it is derived again from ``docs``. Rows of equal id and text share a
    rank and are taken or left together; null and repeated ids with different texts do not. A null or empty text has size 0 and adds no words. Reruns
    give the same rows. Joins on the source use tables of one row per source; a source of any share
    of the rows is never gathered in one task.
    """
    rows = with_sizes(docs, id_col, text_col, source_col)
    small = (sized if sized is not None else rows).select("_id", "_source", "_size", "_u")
    per = _per_source(targets(small, weights, growth, most))
    ranked = _rank(small, per, tilt)
    sums = ranked.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_n"), F.first("_rest").alias("_rest"))
    by_q = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(by_q), F.lit(0)))
    cut = sums.filter((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_n") >= F.col("_rest"))).select("_source", "_bucket", "_before")
    # order the rows of the one bucket per source that holds the cut
    c = _per_source(cut.select(F.col("_source").alias("cs"), F.col("_bucket").alias("cb"), "_before"))
    near = ranked.join(c, F.col("_source").eqNullSafe(F.col("cs")) & (F.col("_bucket") == F.col("cb")))
    near = near.groupBy("cs", "cb", "_before", "_rest", "_q").agg(F.sum("_size").alias("_n"))
    within = Window.partitionBy("cs").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_have", F.col("_before") + F.coalesce(F.sum("_n").over(within), F.lit(0)))
    # taken if the total comes no farther from the rest than without it
    last = near.filter(F.col("_have") + F.col("_n") - F.col("_rest") <= F.col("_rest") - F.col("_have")).groupBy("cs").agg(F.max("_q").alias("_last_q"))
    c2 = c.join(last.withColumnRenamed("cs", "ls"), F.col("cs").eqNullSafe(F.col("ls")), "left").select(F.col("cs").alias("_cs"), F.col("cb").alias("_cb"), "_last_q")
    per_all = per.join(_per_source(c2), F.col("_source").eqNullSafe(F.col("_cs")), "left").drop("_cs")
    out = _rank(rows, _per_source(per_all.drop("_of")), tilt)
    extra = F.col("_cb").isNotNull() & ((F.col("_bucket") < F.col("_cb")) | ((F.col("_bucket") == F.col("_cb")) & (F.col("_q") <= F.col("_last_q"))))
    out = out.withColumn("_copies", F.col("_whole") + F.when(extra, 1).otherwise(0))
    return out.drop("_id", "_source", "_u", "_whole", "_rest", "_q", "_bucket", "_cb", "_last_q", "_n_docs")

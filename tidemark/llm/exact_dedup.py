"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions. Rows are compared by their normalised text; each level
looks at what the level before left, and only texts that share length and prefix
with another row get a full hash and take part in a shuffle of more than two numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small, text_of

#: Characters of the normalised text that the prefix hash reads.
PREFIX = 256


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    return F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", "")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    prefix: int = PREFIX,
) -> DataFrame:
    """One row per input row: ``keep_id``, ``group_size``, ``kept``, and ``_carry``.

    ``_carry`` is a struct of the columns named in ``carry`` (the id column by default),
    so their names never clash with the result's. Of rows with equal normalised texts
    the one with the most code points stays, then the smallest id; a NULL id comes last.
    Of repeated rows that tie in both, exactly one is kept. NULL texts count as empty,
    and empty texts equal each other. An empty table gives an empty result.

    Group counts are aggregated per task before each shuffle; the joins back to the rows
    are plain equi-joins with one row per group on one side, which Spark splits where a
    group is large, so a group may hold any share of the rows.
    """
    base = docs.select(
        F.struct(*(carry or [id_col])).alias("_carry"),
        F.col(id_col).alias("_id"),
        F.length(text_of(F.col(text_col))).alias("_chars"),
        normalised(F.col(text_col)).alias("_norm"),
    )
    rows = base.select(
        "*",
        F.length("_norm").alias("_len"),
        F.xxhash64(F.substring("_norm", 1, prefix)).alias("_head"),
    )
    heads = cut(rows.groupBy("_len", "_head").agg(F.count("*").alias("_n")))
    lengths = heads.groupBy("_len").agg(F.sum("_n").alias("_m")).where("_m > 1").select("_len")
    shared = small(cut(heads.join(lengths, "_len").where("_n > 1").select("_len", "_head")))

    single = rows.join(shared, ["_len", "_head"], "left_anti").select(
        "_carry",
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    full = cut(
        rows.join(shared, ["_len", "_head"], "left_semi").select(
            "_carry", "_id", "_chars", "_len", F.sha2("_norm", 256).alias("_sha")
        )
    )
    order = F.struct(-F.col("_chars"), F.col("_id").isNull(), "_id")
    repeats = full.groupBy("_len", "_sha", "_chars", "_id").agg(F.count("*").alias("_n"))
    best = repeats.groupBy("_len", "_sha").agg(
        F.min_by(F.struct("_chars", "_id", "_n"), order).alias("_best"),
        F.sum("_n").alias("group_size"),
    )
    # A table of its own, so that the join shuffles both sides, or none, and can be split.
    judged = full.join(small(cut(best)), ["_len", "_sha"]).withColumn(
        "_won", (F.col("_chars") == F.col("_best._chars")) & F.col("_id").eqNullSafe(F.col("_best._id"))
    )
    tied = F.col("_won") & (F.col("_best._n") > 1)
    # Repeated rows: one of each spread share, then one of these.
    by_share = Window.partitionBy("_len", "_sha", "_share").orderBy("_spread")
    rest = F.when(F.col("_first") > 1, F.col("_spread"))
    by_text = Window.partitionBy("_len", "_sha", rest).orderBy("_spread")
    settled = (
        judged.where(tied)
        .withColumn("_spread", F.monotonically_increasing_id())
        .withColumn("_share", F.pmod(F.xxhash64("_spread"), F.lit(256)))
        .withColumn("_first", F.row_number().over(by_share))
        .withColumn("kept", (F.col("_first") == 1) & (F.row_number().over(by_text) == 1))
    )
    columns = ["_carry", F.col("_best._id").alias("keep_id"), "group_size", "kept"]
    return (
        single.unionByName(judged.where(~tied).withColumn("kept", F.col("_won")).select(*columns))
        .unionByName(settled.select(*columns))
    )


def dedup_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows, with the columns of ``docs``."""
    found = exact_dedup(docs, id_col, text_col, carry=docs.columns)
    return found.where("kept").select("_carry.*")

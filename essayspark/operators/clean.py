"""Cleaning operators.

All are row-local expressions or joins against literal tables of a few
rows; the deduplication is a partial aggregate rather than a window, so a
key holding a third of all rows is combined map-side instead of sorted in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.functions import fixed_values as FV


def set_number(essay_set: str | Column) -> Column:
    """Numeric set code of an ``essay_set`` label (trailing digits)."""
    c = F.col(essay_set) if isinstance(essay_set, str) else essay_set
    return F.regexp_extract(c.cast("string"), r"([0-9]+)$", 1).try_cast("int")


def set_number_sql(e: str) -> str:
    return f"TRY_CAST(regexp_extract(CAST({e} AS VARCHAR), '([0-9]+)$', 1) AS INTEGER)"


def normalise_score(df: DataFrame, spark: SparkSession, set_col: str = "essay_set",
                    score: str = "domain1_score", out: str = "score_norm") -> DataFrame:
    """(score - lo) / width by the set's range; unknown set -> 0,
    null score in a known set stays null.  The 8-row range table is a
    literal, so broadcasting it is safe by construction."""
    rng = F.broadcast(FV.score_range_df(spark))
    j = df.withColumn("__set_no", set_number(set_col)).join(
        rng, F.col("__set_no") == rng["set_no"], "left")
    norm = F.when(F.col("lo").isNull(), F.lit(0.0)).otherwise(
        (F.col(score) - F.col("lo")) / F.col("width"))
    return j.withColumn(out, norm).drop("__set_no", "set_no", "lo", "width")


def grade(y: str | Column) -> Column:
    """P10 + P11: non-negative prediction x 100, rounded half to even."""
    c = F.col(y) if isinstance(y, str) else y
    return F.bround(F.greatest(c, F.lit(0.0)) * 100, 0)


def name_topics(df: DataFrame, spark: SparkSession, set_col: str = "essay_set",
                names=FV.TOPIC_NAMES_8) -> DataFrame:
    """P7 (D5 fixed): replace the set code by its title through a lookup
    join; unmatched codes keep their original value."""
    tn = F.broadcast(FV.topic_names_df(spark, names))
    j = df.withColumn("__set_no", set_number(set_col)).join(
        tn, F.col("__set_no") == tn["set_no"], "left")
    return j.withColumn("topic", F.coalesce(F.col("topic"), F.col(set_col).cast("string"))) \
            .drop("__set_no", "set_no")


def dedupe_keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the smallest ``order`` value
    (ties broken by the remaining columns, so the result is repeatable).

    ``min(struct(order, ...))`` is an ordinary aggregate with map-side
    partial aggregation: a hot key is combined in every task before the
    shuffle instead of being sorted whole in one task by a window."""
    rest = [c for c in df.columns if c not in (key, order)]
    first = F.min(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("__first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"__first.{c}").alias(c) for c in [order] + rest])


def bytes_to_text(c: str | Column) -> Column:
    """UTF-8 decode of a binary column; invalid bytes give null.
    String input passes through unchanged."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_validate_utf8(col.cast("string"))


def sample_rows(df: DataFrame, key: str, n: int = 10, salt: str = "") -> DataFrame:
    """A repeatable sample of n rows: smallest md5 of the key.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task
    keeps its top n, the driver merges n x tasks rows."""
    h = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")))
    return df.withColumn("sample_hash", h).orderBy("sample_hash", key).limit(n)

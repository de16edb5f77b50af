"""Repeatable splits and folds (ML4, ML7, U3).

A row's side of a split is a pure function of its key (an md5 prefix
compared with a threshold), so it does not depend on partitioning, task
retries or executor loss, unlike ``randomSplit``/``rand``.

Stratified folds need each row's rank inside its class.  A window over a
whole class would put a class holding a third of the rows into one task,
so the rank is assembled from (class, hash bucket) pieces: a small table
of bucket sizes gives each bucket's offset inside its class, and a window
over (class, bucket) ranks rows inside a bucket.  The result is exactly
``row_number() over (partition by class order by hash)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HEX_DIGITS = 4
BUCKET_DIGITS = 3       # 4096 buckets per class


def key_hash(key: str | Column, salt: str = "") -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(salt), c.cast("string")))


def threshold(fraction: float) -> str:
    """Hex prefix below which ``fraction`` of uniform md5 values fall."""
    return format(int(round(fraction * 16 ** HEX_DIGITS)), f"0{HEX_DIGITS}x")


def in_test(key: str | Column, fraction: float, salt: str = "") -> Column:
    """ML4: true for the held-out part (about ``fraction`` of the rows)."""
    return F.substring(key_hash(key, salt), 1, HEX_DIGITS) < F.lit(threshold(fraction))


def in_test_sql(key: str, fraction: float, salt: str = "") -> str:
    return (f"substr(md5(concat('{salt}', CAST({key} AS VARCHAR))), 1, {HEX_DIGITS}) "
            f"< '{threshold(fraction)}'")


def train_test(df: DataFrame, key: str, fraction: float, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Complementary parts from one predicate (disjoint by construction)."""
    t = in_test(key, fraction, salt)
    return df.filter(~t), df.filter(t)


def rank_in_class(df: DataFrame, key: str, cls: str, salt: str = "",
                  bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """Adds ``rank`` = 0-based position of the row inside its class when
    ordered by md5 of the key (ties by key)."""
    h = key_hash(key, salt)
    d = df.withColumn("__h", h).withColumn("__b", F.substring("__h", 1, bucket_digits))
    sizes = d.groupBy(cls, "__b").agg(F.count(F.lit(1)).alias("__nb"))
    # at most classes x 16^digits rows; one class's buckets fit one task
    w_cls = Window.partitionBy(cls).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__nb").over(w_cls), F.lit(0))).drop("__nb")
    w_b = Window.partitionBy(cls, "__b").orderBy("__h", key)
    return (d.join(offsets, [cls, "__b"])
            .withColumn("rank", (F.col("__off") + F.row_number().over(w_b) - 1).cast("bigint"))
            .drop("__h", "__b", "__off"))


def stratified_folds(df: DataFrame, key: str, cls: str, n_folds: int, salt: str = "") -> DataFrame:
    """ML7: fold = rank inside class mod n_folds, so every class is spread
    over the folds as evenly as possible (sizes differ by at most one)."""
    r = rank_in_class(df, key, cls, salt)
    return r.withColumn("fold", (F.col("rank") % n_folds).cast("int")).drop("rank")


def plain_folds(df: DataFrame, key: str, n_folds: int, salt: str = "") -> DataFrame:
    """Unstratified folds for the regressor: a hash of the key mod n."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(n_folds)).cast("int"))

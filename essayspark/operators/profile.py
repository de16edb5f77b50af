"""Profiling of a table.

Each profile is one aggregation with map-side partial aggregation; only a
bounded result (one row, or one row per group x column) is produced.  The
only driver round trip is in ``drop_sparse``: one row of null counts is
collected to decide which columns to drop, which is bounded by the number
of columns, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from essayspark.operators.quantiles import quantiles_of_counts, value_counts
from essayspark.session import checkpointed




def nonnull_counts(df: DataFrame, by: str) -> DataFrame:
    """A1: non-null count of every column per group; null group keys are
    dropped as pandas ``groupby`` does."""
    cols = [c for c in df.columns if c != by]
    return (df.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(*[F.count(c).alias(c) for c in cols]))


def null_shares(df: DataFrame) -> DataFrame:
    """(column_name, n_null, n_rows) for every column, from one aggregate."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (agg.unpivot("__n", df.columns, "column_name", "n_null")
            .select("column_name", F.col("n_null").cast("bigint").alias("n_null"),
                    F.col("__n").cast("bigint").alias("n_rows")))


def null_percent(df: DataFrame) -> DataFrame:
    """A2 + O1 + T25: percent null per column, 2 decimals (half even),
    zero removed, highest first."""
    s = null_shares(df)
    pct = F.bround(F.try_divide(F.col("n_null").cast("double"), F.col("n_rows").cast("double")) * 100, 2)
    return (s.select("column_name", pct.alias("null_percent"))
            .filter(F.col("null_percent") != 0)
            .orderBy(F.desc("null_percent"), "column_name"))


def sparse_columns(df: DataFrame, max_null_share: float) -> DataFrame:
    """(column_name, null_share, kept): columns with a null share above
    ``max_null_share`` are to be dropped (P5; P6 is ``max_null_share=0``)."""
    s = null_shares(df)
    share = F.try_divide(F.col("n_null").cast("double"), F.col("n_rows").cast("double"))
    return s.select("column_name", share.alias("null_share"),
                    (share <= F.lit(max_null_share)).alias("kept"))


def drop_sparse(df: DataFrame, max_null_share: float) -> DataFrame:
    """Drop the columns whose null share exceeds the bound."""
    decisions = sparse_columns(df, max_null_share).filter(~F.col("kept")).select("column_name")
    drop = [r["column_name"] for r in decisions.collect()]  # <= number of columns
    return df.drop(*drop)


def schema_table(df: DataFrame) -> DataFrame:
    """V1: (column_name, data_type, non_null, position) of a table."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pos = {n: i + 1 for i, n in enumerate(df.columns)}
    nn = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = nn.unpivot([], df.columns, "column_name", "non_null")
    type_col = F.coalesce(*[F.when(F.col("column_name") == n, F.lit(t)) for n, t in types.items()])
    pos_col = F.coalesce(*[F.when(F.col("column_name") == n, F.lit(p)) for n, p in pos.items()])
    return long.select("column_name", type_col.alias("data_type"),
                       F.col("non_null").cast("bigint").alias("non_null"),
                       pos_col.cast("bigint").alias("position"))


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def group_mean(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """A3 / A4: mean of ``value`` per group, nulls skipped."""
    return df.groupBy(by).agg(F.avg(value).alias(name), F.count(value).alias("n_values"))


# ------------------------------------------------------------------ A13 box plot
def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles (linear interpolation, exact), whiskers within 1.5 IQR and
    outlier counts per group.

    All of it comes from the table of distinct values and their numbers, quartiles by radix
    selection, so no group's values are held in one place.  Groups are joined to their quartiles, one row each."""
    counts = value_counts(df, [by], value)
    q = quantiles_of_counts(counts, [by], [0.25, 0.5, 0.75]).select(
        by, F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("q3"), "n")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    rows = counts.withColumnRenamed("n", "__n").join(q, by)
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    w = (rows.groupBy(by)
         .agg(F.min(F.when(inside, F.col("v"))).alias("whisker_lo"), F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
              F.sum(F.when(inside, 0).otherwise(F.col("__n"))).cast("bigint").alias("n_outliers")))
    return q.join(w, by)


def box_outliers(df: DataFrame, by: str, value: str, key: str) -> DataFrame:
    """Rows beyond the 1.5 IQR fences of their group."""
    stats = box_stats(df, by, value).select(by, "lo_fence", "hi_fence")
    v = F.col(value)
    return (df.filter(v.isNotNull()).select(key, by, value)
            .join(stats, by)
            .filter((v < F.col("lo_fence")) | (v > F.col("hi_fence")))
            .select(key, by, value))


# ------------------------------------------------------------------ A14 relation to score
def _pair(x: Column, y: Column) -> tuple[Column, Column]:
    """Restrict both sides to rows where both are present."""
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def corr_safe(x: Column, y: Column) -> Column:
    """Pearson correlation, null when either side has no spread.

    Written from population moments because ``corr`` raises on a zero
    variance under ANSI mode."""
    xp, yp = _pair(x, y)
    r = F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))
    return F.when((F.count(xp) > 1) & (F.var_pop(xp) > 0) & (F.var_pop(yp) > 0), r)


def feature_corr(df: DataFrame, by: str, features: list[str], target: str) -> DataFrame:
    """(group, feature, corr, n): correlation of each feature with the
    target per group, one aggregation for all features."""
    y = F.col(target).cast("double")
    agg = df.groupBy(by).agg(*[corr_safe(F.col(f).cast("double"), y).alias(f) for f in features])
    return agg.unpivot(by, features, "feature", "corr")


def feature_bins(df: DataFrame, by: str, features: list[str], target: str, key: str,
                 n_bins: int = 10) -> DataFrame:
    """Binned point cloud of (feature, target) per group: counts by
    (group, feature, bin, target).  Ranges come from a partial aggregate
    joined back, never from a window over a group.  The narrow rows are read twice, so they are written once:
    the features are not computed again."""
    long = checkpointed(df.select(key, by, target, *features)).select(key, by, F.col(target).cast("double").alias("target"),
                     F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                                  F.col(f).cast("double").alias("value"))
                                         for f in features])).alias("fv")) \
             .select(key, by, "target", "fv.feature", "fv.value") \
             .filter(F.col("value").isNotNull() & F.col("target").isNotNull())
    rng = long.groupBy(by, "feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.join(rng, [by, "feature"])
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * n_bins) + 1, F.lit(n_bins)))
    return (j.withColumn("bin", b.cast("bigint"))
            .groupBy(by, "feature", "bin", "target").agg(F.count(F.lit(1)).alias("n_points")))

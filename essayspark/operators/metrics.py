"""Agreement metrics over (y, yhat) pairs (M1-M5), each one aggregation.

The quadratic-weighted kappa needs no confusion matrix: with i and j the
ranks of the true and predicted grade in the sorted union of both columns,
kappa = 1 - E[(i-j)^2] / (E[i^2] + E[j^2] - 2 E[i] E[j]).  The ranks come
from a window over the distinct grades only (bounded by the grade scale),
joined back as a broadcast of that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def accuracy(y: str, yhat: str) -> Column:
    return F.avg((F.col(y) == F.col(yhat)).cast("double"))


def mse(y: str, yhat: str) -> Column:
    return F.avg(F.pow(F.col(y) - F.col(yhat), 2))


def mae(y: str, yhat: str) -> Column:
    return F.avg(F.abs(F.col(y) - F.col(yhat)))


def r2(y: str, yhat: str) -> Column:
    """1 - SSE / SST (sklearn ``r2_score``)."""
    sse = F.sum(F.pow(F.col(y) - F.col(yhat), 2))
    sst = F.var_pop(F.col(y)) * F.count(F.col(y))
    return F.lit(1.0) - F.try_divide(sse, sst)


def regression_summary(df: DataFrame, y: str = "y", yhat: str = "yhat", by: list[str] | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), mse(y, yhat).alias("mse"), mae(y, yhat).alias("mae"),
            r2(y, yhat).alias("r2")]
    return df.groupBy(*(by or [])).agg(*aggs)


def grade_ranks(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(grade, rank) over the sorted union of both columns."""
    vals = df.select(F.col(y).alias("grade")).union(df.select(F.col(yhat).alias("grade"))).distinct()
    # one row per distinct grade: a short ordered list, so a global window is fine
    return vals.withColumn("rank", F.row_number().over(Window.orderBy("grade")) - 1)


def quadratic_kappa(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """M5: one row (n, kappa).

    The (y, yhat) pairs are read twice (grade ranks, the scoring join), so they are written once first: two narrow
    columns, and the model that produced them does not run again."""
    from essayspark.session import checkpointed

    df = checkpointed(df.select(y, yhat))
    ranks = grade_ranks(df, y, yhat)
    ri = ranks.select(F.col("grade").alias("__gy"), F.col("rank").cast("double").alias("__i"))
    rj = ranks.select(F.col("grade").alias("__gh"), F.col("rank").cast("double").alias("__j"))
    p = df.join(ri, F.col(y) == F.col("__gy")).join(rj, F.col(yhat) == F.col("__gh"))
    i, j = F.col("__i"), F.col("__j")
    num = F.avg(F.pow(i - j, 2))
    den = F.avg(i * i) + F.avg(j * j) - 2 * F.avg(i) * F.avg(j)
    return p.agg(F.count(F.lit(1)).alias("n"), (F.lit(1.0) - F.try_divide(num, den)).alias("kappa"))

"""Exact quantiles per group by radix selection (A5, A13, ML12).

No task ever holds a group's values.  Equal values are first added up to one row with a number (in every task
before the shuffle, so a value that a third of the rows share is no task's burden).  A double's bits, read as a signed
integer, order as the doubles do; the rank that is looked for is then found from the highest bits down: a histogram of
the next ``DIGIT`` bits of the values that share the bits known so far (at most ``2**DIGIT`` counts per rank), the digit in which the
rank falls, and on with the rank inside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from essayspark.session import checkpointed

DIGIT = 16


def ordered_bits(value: Column) -> Column:
    """A long that orders as the double does (negative zero as zero, NaN last)."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def value_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by..., v, n): how often each value occurs; rows with a null value or key are left out.  A written table."""
    rows = df.select(*by, F.col(value).cast("double").alias("v")).dropna()
    return checkpointed(rows.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n")))


def quantiles_of_counts(counts: DataFrame, by: list[str], qs: list[float]) -> DataFrame:
    """(by..., n, quantiles): array of the quantiles ``qs``, linear between neighbours."""
    counts = counts.withColumn("key", ordered_bits(F.col("v")))
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("n"))
    places = [F.lit(float(q)) * (F.col("n") - 1) for q in qs]
    ranks = F.array_distinct(F.array(*[f(p).cast("bigint") for p in places for f in (F.floor, F.ceil)]))
    want = sizes.select(*by, F.explode(ranks).alias("rank")).withColumn("rest", F.col("rank"))
    known: list[str] = []  # the bits known so far, as the key shifted right
    for shift in range(64 - DIGIT, -1, -DIGIT):
        rows = counts
        if known:
            rows = rows.withColumn("known", F.shiftright("key", shift + DIGIT)).join(want.select(*by, "known").distinct(), [*by, "known"], "left_semi")
        digits = rows.groupBy(*by, *known, F.shiftright("key", shift).alias("digit")).agg(F.sum("n").alias("__n"))
        up_to = F.sum("__n").over(Window.partitionBy(*by, *known).orderBy("digit"))
        digits = digits.withColumn("__before", up_to - F.col("__n"))
        here = (F.col("rest") >= F.col("__before")) & (F.col("rest") < F.col("__before") + F.col("__n"))
        found = want.join(digits, [*by, *known]).filter(here)
        want = found.select(*by, "rank", (F.col("rest") - F.col("__before")).alias("rest"), F.col("digit").alias("known"))
        known = ["known"]
    values = want.join(counts.select(*by, F.col("key").alias("known"), "v"), [*by, "known"])
    at = values.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # two ranks per quantile
    low, high = [F.element_at("at", F.floor(p).cast("bigint")) for p in places], [F.element_at("at", F.ceil(p).cast("bigint")) for p in places]
    out = [lo + (hi - lo) * (p - F.floor(p)) for lo, hi, p in zip(low, high, places)]
    return sizes.join(at, by).select(*by, "n", F.array(*out).alias("quantiles"))


def exact_quantiles(df: DataFrame, by: list[str], value: str, qs: list[float]) -> DataFrame:
    """(by..., n, quantiles) of a numeric column; rows with a null value or key are left out."""
    return quantiles_of_counts(value_counts(df, by, value), by, qs)

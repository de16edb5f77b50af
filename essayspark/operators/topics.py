"""Topic model and its summaries (ML9-ML12, A5, A16, O3).

The model is batch variational Bayes over a bounded vocabulary (``operators/lda``).  Everything around it is DataFrame
work: topic-word weights become a long (topic, term, weight) table that
is normalised per topic with a window over one topic's terms (bounded by
the vocabulary), top terms per topic use ``row_number() <= n``, document
shares are exploded and summarised per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from essayspark.operators import lda
from essayspark.operators.quantiles import exact_quantiles


def fit_lda(docs: DataFrame, k: int, terms: int, max_iter: int = 30, seed: int = 7) -> lda.TopicModel:
    """ML9: priors 1/k as the original's defaults, batch updates, perplexity looked at every fifth step."""
    return lda.fit(docs, k, terms, max_iter, seed, check_every=5, tolerance=0.01)


def topic_terms(model: lda.TopicModel, vocab: list[str], spark: SparkSession) -> DataFrame:
    """ML10 + A16: (topic, term, weight) with each topic's weights summing to 1."""
    return normalise_rows(model.topic_terms(spark, vocab), "topic", "w", "weight")


def normalise_rows(df: DataFrame, row: str, value: str, out: str) -> DataFrame:
    """Value / sum(value) over the row (one topic's terms)."""
    res = df.withColumn(out, F.col(value) / F.sum(value).over(Window.partitionBy(row)))
    return res if value == out else res.drop(value)


def top_terms(tt: DataFrame, n: int = 15, topic: str = "topic", term: str = "term",
              weight: str = "weight") -> DataFrame:
    """O3: the n heaviest terms per topic (ties by term)."""
    w = Window.partitionBy(topic).orderBy(F.desc(weight), F.asc(term))
    return tt.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def document_topics(model: lda.TopicModel, docs: DataFrame, keys: list[str]) -> DataFrame:
    """ML11 + J7: (keys..., topic, p) of every document; keys ride along."""
    return lda.shares_long(model.transform(docs, keys), keys)


def exact_medians(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by..., median_p): exact, by radix selection over counts of equal values."""
    return exact_quantiles(df, by, value, [0.5]).select(*by, F.col("quantiles")[0].alias("median_p"))


def group_topic_medians(dt: DataFrame, group: str, topic: str = "topic", p: str = "p") -> DataFrame:
    """A5 + ML12: median share of each topic per group and whether it is
    the group's dominant topic (largest median, ties to the lower topic)."""
    m = exact_medians(dt, [group, topic], p)
    w = Window.partitionBy(group).orderBy(F.desc("median_p"), F.asc(topic))  # k rows per group
    return m.withColumn("is_dominant", F.row_number().over(w) == 1)


def heat_map(medians: DataFrame, group: str, k: int, topic: str = "topic") -> DataFrame:
    """V6: group x topic matrix (one column per topic)."""
    return medians.groupBy(group).pivot(topic, list(range(k))).agg(F.first("median_p"))

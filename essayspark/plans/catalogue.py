"""All driver queries, imported so that they register, plus the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.functions import text as T
from essayspark.operators import features as FT
from essayspark.plans import (jobs, model_queries, profile_queries, text_queries,  # noqa: F401
                              topic_queries, vector_queries, vocab_queries)
from essayspark.plans.registry import ORACLE, QUERIES, r6, r6_sql, register
from essayspark.sources.tables import ESSAYS_SQL, essay_texts

_FLAGSHIP_SQL = f"""
SELECT essay_set, CAST(count(*) AS BIGINT) AS n_essays,
       {r6_sql('avg(' + T.char_count_sql('essay') + ')')} AS mean_char_count,
       {r6_sql('avg(' + T.word_count_sql('essay') + ')')} AS mean_word_count,
       {r6_sql('avg(' + T.sent_count_sql('essay') + ')')} AS mean_sent_count,
       {r6_sql('avg(' + T.avg_word_len_sql('essay') + ')')} AS mean_avg_word_len
FROM {ESSAYS_SQL} e GROUP BY essay_set
"""


@register("set_feature_means", _FLAGSHIP_SQL)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """essays -> T5, T3, T6, T4 per text -> mean per essay_set (A3), sorted."""
    f = FT.basic_features(essay_texts(spark, sf).select("essay_set", "essay"))
    return (f.groupBy("essay_set")
            .agg(F.count(F.lit(1)).alias("n_essays"),
                 r6(F.avg("char_count"), "mean_char_count"),
                 r6(F.avg("word_count"), "mean_word_count"),
                 r6(F.avg("sent_count"), "mean_sent_count"),
                 r6(F.avg("avg_word_len"), "mean_avg_word_len"))
            .orderBy("essay_set"))


__all__ = ["QUERIES", "ORACLE", "flagship"]

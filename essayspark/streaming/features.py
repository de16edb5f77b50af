"""Structured Streaming form of the per-essay feature job.

The original job has no stream; essays arrive as whole files.  When new
essay files land in a folder over time, the same row-local feature
expressions run incrementally on each new file with ``readStream``; the
per-set means are a streaming aggregation kept in state.  Only operators
that already exist in the batch library are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.operators.features import basic_features


def essay_stream(spark: SparkSession, folder: str, schema: str,
                 max_files_per_trigger: int = 64) -> DataFrame:
    """Parquet files of (essay_id, essay_set, essay, ...) as they arrive."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(folder))


def streaming_features(stream: DataFrame, text: str = "essay") -> DataFrame:
    """Append-only stream of per-essay basic features (row-local)."""
    return basic_features(stream, text).drop(text)


def streaming_set_means(stream: DataFrame, text: str = "essay") -> DataFrame:
    """Running per-set means of the basic features (complete mode)."""
    f = basic_features(stream, text)
    return f.groupBy("essay_set").agg(
        F.count(F.lit(1)).alias("n_essays"),
        F.avg("char_count").alias("mean_char_count"),
        F.avg("word_count").alias("mean_word_count"),
        F.avg("sent_count").alias("mean_sent_count"),
        F.avg("avg_word_len").alias("mean_avg_word_len"),
    )

"""Reading the driver's Parquet tables and the essay view built on them.

The reference reads one table of graded essays (essay_id, essay_set,
essay, domain1_score, rater columns).  The test data has no such table,
so the essay view is bound to ``documents`` LEFT JOIN ``labels``:
``essay_id = doc_id``, ``essay_set = source``, ``essay = text``,
``domain1_score = quality``.  Scores are null for unlabelled documents,
which exercises the null rules of the profiling operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Tables whose rows carry whole texts: per-row work is CPU-bound regex and
# array work, so every core needs its own slice of rows.
TEXT_TABLES = {"documents", "conversations", "benchmark", "pages"}
# Set by a launcher whose text tables are single small files (tests, bench): they are
# then dealt to so many partitions.  Unset, a scan keeps its own splits.
SPREAD = "essayspark.text.partitions"


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """A text scan in the number of partitions the session asks for, if it does.

    A Parquet row group is never split, so a small file is read by one task.  Nothing
    here looks at the data's size: the plan depends on the setting only."""
    n = spark.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; column pruning and filters reach the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, spark) if name in TEXT_TABLES else df


def essays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graded-essay view: essay_id, essay_set, lang, essay, domain1_score.

    ``labels`` is keyed by doc_id and at most one row per document, so the
    left join never multiplies rows.  Catalyst prunes the label columns
    (and the whole join) when a query does not read the score.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return (
        docs.join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("essay_id"),
            F.col("source").alias("essay_set"),
            F.col("lang"),
            F.col("text").alias("essay"),
            F.col("quality").cast("double").alias("domain1_score"),
        )
    )


def essay_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The essay view without scores: essay_id, essay_set, lang, essay.

    Text work needs no label, so nothing is joined before it; at scale a
    label table too large to broadcast would otherwise shuffle whole texts."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("essay_id"), F.col("source").alias("essay_set"),
        F.col("lang"), F.col("text").alias("essay"))


def attach_scores(df: DataFrame, spark: SparkSession, sf_dir: str, key: str = "essay_id") -> DataFrame:
    """Add ``domain1_score`` to narrow per-essay rows (after the text work),
    so the join moves feature rows, never texts."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias(key), F.col("quality").cast("double").alias("domain1_score"))
    return df.join(labels, key, "left")


def essays_with_raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Essay view with sparse rater-style columns (over 80% null).

    The reference table carries rater columns that are almost all null and
    are dropped by rule.  Here ``toxic`` and a second copy of ``quality``
    kept only for toxic documents play that part.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return (
        docs.join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("essay_id"),
            F.col("source").alias("essay_set"),
            F.col("lang"),
            F.col("text").alias("essay"),
            F.col("quality").cast("double").alias("domain1_score"),
            F.col("toxic").cast("double").alias("rater1_domain1"),
            F.when(F.col("toxic") == 1, F.col("quality").cast("double")).alias("rater3_domain1"),
            F.when(F.col("toxic") == 1, F.col("n_chars").cast("double")).alias("rater3_trait1"),
        )
    )


# SQL text of the same views for the DuckDB oracle.
ESSAYS_SQL = (
    "(SELECT d.doc_id AS essay_id, d.source AS essay_set, d.lang, d.text AS essay, "
    "CAST(l.quality AS DOUBLE) AS domain1_score "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)

ESSAYS_RATERS_SQL = (
    "(SELECT d.doc_id AS essay_id, d.source AS essay_set, d.lang, d.text AS essay, "
    "CAST(l.quality AS DOUBLE) AS domain1_score, "
    "CAST(l.toxic AS DOUBLE) AS rater1_domain1, "
    "CASE WHEN l.toxic = 1 THEN CAST(l.quality AS DOUBLE) END AS rater3_domain1, "
    "CASE WHEN l.toxic = 1 THEN CAST(d.n_chars AS DOUBLE) END AS rater3_trait1 "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)

"""File sources (S1-S4) and sinks.

* Essay tables arrive as comma- or tab-separated text with a header, in
  ISO-8859-1, with quoted multi-line fields.  A multi-line CSV cannot be
  split between tasks, so it is read once (columns by header name) and
  landed as Parquet partitioned by ``essay_set``; every later job reads the
  Parquet copy (splittable, pruned by set, projected by column).
* A word-vector text file (``word v1 ... vN`` per line) is parsed with
  built-in string/array functions; malformed lines are returned apart.
* A plain-text corpus becomes a dictionary of ``[a-z]+`` word counts.
* Sinks write named columns; CSV output is quoted with a header.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from essayspark.operators.features import dictionary_counts

# Columns the code reads; the files carry more, which are kept as strings
# only when named here.
ESSAY_SCHEMA = T.StructType([
    T.StructField("essay_id", T.LongType()),
    T.StructField("essay_set", T.IntegerType()),
    T.StructField("essay", T.StringType()),
    T.StructField("domain1_score", T.DoubleType()),
])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType = ESSAY_SCHEMA,
                   sep: str = ",", encoding: str = "ISO-8859-1") -> DataFrame:
    """Header, Latin-1, quoted fields that may span lines.

    Columns are taken by their header name, whatever their order and however many others the
    file has: the header gives the full schema (all strings), the wanted columns are selected
    and cast.  A missing column raises; a cell that is no number becomes null."""
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", True)
              .option("mode", "PERMISSIVE"))
    names = [c.strip() for c in reader.csv(path).columns]  # reads the header, infers nothing
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(names)}")
    rows = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def land_as_parquet(df: DataFrame, out: str, partition_by: str | None = "essay_set") -> None:
    """Write once as Parquet so later scans split, prune and project."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(out)


def read_word_vectors(spark: SparkSession, path: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """S3: (word, vec array<float>) from ``word v1 ... v_dim`` lines, and the rejected lines
    (wrong number of fields, or a field that is no number), so none vanishes unseen."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    vec = F.transform(F.slice("p", 2, dim), lambda x: x.try_cast("float"))
    lines = spark.read.text(path).select("value", parts.alias("p")).select("value", "p", vec.alias("vec"))
    good = (F.size("p") == dim + 1) & ~F.exists("vec", lambda x: x.isNull())
    return (lines.filter(good).select(F.element_at("p", 1).alias("word"), "vec"),
            lines.filter(~good).select(F.col("value").alias("line")))


def read_corpus_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(word, n) counts of ``[a-z]+`` runs of a lower-cased text file."""
    return dictionary_counts(spark.read.text(path), "value")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Named columns, overwrite; CSV with header and quoting."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_id_score_text(df: DataFrame, path: str) -> None:
    """(id, score, essay) as quoted CSV with a header."""
    write_table(df.select("id", "score", "essay"), path, "csv")


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

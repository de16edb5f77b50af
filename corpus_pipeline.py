"""A training-data pipeline over ``documents``: toxic documents go, one document of each group of near
duplicates stays, repeated passages are cut, contaminated documents go, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last
return the columns of ``documents``.  Nulls, empty texts and repeated rows are treated as the operators'
docstrings say; documents whose text is cut to nothing stay, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.llm import bpe, decontaminate, simhash, substring, toxicity
from essayspark.llm.common import table, written

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that score 0.5 or more go."""
    return toxicity.keep_harmless(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group linked at 4 or fewer bits (4-word shingles) the smallest id stays."""
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: words in windows of 35 words that occur again go; the others are joined by one space."""
    return substring.replace_texts(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents with a window similar to a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: ids of every text, and digests of the ids and of the text decoded from them."""
    out = bpe.encode_documents(docs, TOKENIZER)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The stages hash, learn and tokenise in ways that SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

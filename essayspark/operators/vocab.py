"""Term counting and vocabularies (A7-A9, O2, O4, T23, T24, ML1, ML2).

Terms are counted in each batch (all occurrences for tf, a text's distinct terms for df) and
by term in one aggregation with map-side combine, so a
term that is a third of the corpus is combined inside every task and no
(document, term) row is shuffled.  Count vectors come after the cut: only
occurrences of vocabulary terms are counted per document.  The vocabulary cut is ``orderBy(tf desc, term).limit(N)``, which
plans as a per-task top-N merged once (TakeOrderedAndProject), never a
global window in one task.  The vocabulary is bounded by N, so it can be
broadcast back without a further check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from essayspark.functions import text as T
from essayspark.functions.fixed_values import ENGLISH_STOP_WORDS
from essayspark.session import checkpointed, ship_package, written


def vectorizer_terms(text: str | Column, stops=None, n_max: int = 1) -> Column:
    """Tokens of two or more word characters, lower-cased, stop words
    removed before n-grams are formed, then 1..n_max grams."""
    toks = T.vectorizer_tokens(text)
    if stops is not None:
        toks = T.remove_words(toks, list(stops))
    return toks if n_max == 1 else T.ngrams_upto(toks, n_max)


#: Terms of a batch that are counted at a time.
COUNTED = 500_000


def encoded_terms(batch: pa.RecordBatch, terms: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, pa.Array]]:
    """Runs of a batch's texts of about ``COUNTED`` terms: first and next text, each term's text (from 0) and number, and the distinct terms.
    A null list has no terms."""
    column = batch.column(terms)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // COUNTED)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)]):
        if b > a:
            flat = column.slice(a, b - a).flatten().dictionary_encode(null_encoding="encode")
            lens = np.diff(ends[a:b], prepend=ends[a - 1] if a else 0)
            yield a, b, np.repeat(np.arange(b - a), lens), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary


def term_stats(df: DataFrame, terms: Column) -> DataFrame:
    """(term, df, tf): document frequency and corpus term frequency.

    Arrow batches count their texts' terms and distinct terms; one aggregation by term adds them up."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, text, number, distinct in encoded_terms(batch, "__t"):
                n = len(distinct)
                if n:
                    once = np.unique(text * n + number) % n
                    yield pa.RecordBatch.from_arrays([distinct, pa.array(np.bincount(once, minlength=n)), pa.array(np.bincount(number, minlength=n))],
                                                     ["term", "df", "tf"])

    found = df.select(terms.alias("__t")).mapInArrow(run, "term string, df long, tf long")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def vocabulary_counts(df: DataFrame, keys: list[str], terms: Column, vocab: DataFrame,
                      on: list[str] = ("term",)) -> DataFrame:
    """Long sparse matrix (keys, term, n) over the vocabulary, joined on ``on`` (term, and a group if
    each has its own).  Occurrences of other terms are dropped before the per-document count."""
    rows = df.select(*keys, F.explode(terms).alias("term"))
    return (rows.join(vocab.select(*on), list(on)).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n")))


def bounded_vocabulary(stats: DataFrame, n_docs: int, max_terms: int,
                       min_df: int | float = 1, max_df: int | float = 1.0) -> DataFrame:
    """(term, df, tf) of the kept terms: document-frequency bounds as
    counts (int) or shares (float), then the ``max_terms`` most frequent
    terms, ties by term."""
    lo = min_df if isinstance(min_df, int) else min_df * n_docs
    hi = max_df if isinstance(max_df, int) else max_df * n_docs
    kept = stats.filter((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
    return kept.orderBy(F.desc("tf"), F.asc("term")).limit(max_terms)


#: A level's frequent terms are told to the scans if they are no more than so many times the vocabulary's size.
TOLD = 2


def _cut_classes(tf: DataFrame, by: list[str], max_terms: int) -> DataFrame:
    """(by..., __c): the count classes (one per doubling) that the ``max_terms`` most frequent terms can lie in."""
    classes = tf.groupBy(*by, "__c").agg(F.count(F.lit(1)).alias("__n"))  # at most 63 rows per group
    above = Window.partitionBy(*by).orderBy(F.desc("__c")).rowsBetween(Window.unboundedPreceding, -1)
    return (classes.withColumn("__above", F.coalesce(F.sum("__n").over(above), F.lit(0)))
            .filter(F.col("__above") < max_terms).select(*by, "__c"))


class NgramVocabulary:
    """The ``max_terms`` most frequent 1..n_max-grams of each group, counted level by level (T23, O4, ML1).

    An n-gram occurs no more often than any part of it.  So after the words are counted, a count that the cut
    cannot fall below is known (from a histogram of the counts, one class per doubling), and only pairs of two words that reach it are
    formed, counted and shuffled; likewise triples of two such pairs, and so on.  The result is exact.  The sets of
    frequent parts are told to the scans as literals while they are at most ``TOLD`` times the vocabulary; a larger set
    (very flat counts) prunes nothing at its level and changes no result.

    ``docs``: the keys and ``toks``, a written table: it is read once per level."""

    def __init__(self, docs: DataFrame, toks: str, n_max: int, max_terms: int, by: list[str] = ()):
        self.docs, self.by, self.max_terms = docs, list(by), max_terms
        groups = [F.col(c) for c in self.by] or [F.lit(0).alias("__all")]
        self.keys = self.by or ["__all"]
        rows = docs.filter(F.col(self.by[0]).isNotNull()) if self.by else docs
        self.levels: list[Column] = []  # each document's n-grams of two frequent parts, null elsewhere
        counted, parts = None, F.col(toks)
        for n in range(1, n_max + 1):
            if n > 1:
                size = F.greatest(F.size(toks), F.lit(1))
                both = F.arrays_zip(parts.alias("g0"), F.slice(parts, 2, size).alias("g1"), F.slice(toks, n, size).alias("t"))
                parts = F.transform(both, lambda s: F.when(s["g0"].isNotNull() & s["g1"].isNotNull(), F.concat_ws(" ", s["g0"], s["t"])))
            self.levels.append(parts)
            grams = rows.select(*groups, F.explode(F.filter(parts, lambda g: g.isNotNull())).alias("term"))
            tf = grams.groupBy(*self.keys, "term").agg(F.count(F.lit(1)).alias("tf")).withColumn("__c", F.floor(F.log2("tf")))
            tf = checkpointed(tf if counted is None else counted.unionByName(tf))
            # only what the cut can still reach goes on
            counted = tf.join(_cut_classes(tf, self.keys, max_terms), [*self.keys, "__c"])
            if n < n_max:
                low = _cut_classes(tf, self.keys, max_terms).groupBy(*self.keys).agg(F.min("__c").alias("__low"))
                reach = tf.join(low, self.keys).filter(F.col("__c") >= F.col("__low")).filter(F.size(F.split("term", " ")) == n)
                frequent = [r["term"] for r in reach.select("term").distinct().limit(TOLD * max_terms + 1).collect()]
                if len(frequent) <= TOLD * max_terms:
                    parts = F.transform(parts, lambda g: F.when(g.isin(frequent), g))
        w = Window.partitionBy(*self.keys).orderBy(F.desc("tf"), F.asc("term"))
        first = checkpointed(counted.drop("__c"))
        if self.by:
            # as Parquet its size is known in bytes: while it is small, no n-gram of a text is shuffled to meet it
            self.vocabulary = written(first.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= max_terms).select(*self.by, "term", "tf"))
        else:
            self.vocabulary = first.orderBy(F.desc("tf"), F.asc("term")).limit(max_terms).select("term", "tf")

    def counts(self, keys: list[str]) -> DataFrame:
        """Long sparse matrix (keys, term, n) of the documents over the vocabulary; ``keys`` hold the groups' columns."""
        rows = self.docs.select(*keys, F.explode(F.filter(F.concat(*self.levels), lambda g: g.isNotNull())).alias("term"))
        if self.by:
            rows = rows.join(self.vocabulary.select(*self.by, "term"), [*self.by, "term"])
        else:
            rows = rows.join(F.broadcast(self.vocabulary.select("term")), "term")  # at most max_terms
        return rows.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))


def vocabulary_by_group(df: DataFrame, group: str, terms: Column, max_terms: int) -> DataFrame:
    """(group, term, tf): the ``max_terms`` most frequent terms of each group
    (a vectorizer fitted per group).

    The cut is found per group from a histogram of its counts: a term whose count class (one per
    doubling) lies wholly under the ``max_terms`` most frequent is dropped before the ranking, so the
    ranking window gets at most the terms above and those of the one class in which
    the cut falls."""
    tf = (df.select(group, F.explode(terms).alias("term")).filter(F.col(group).isNotNull())
          .groupBy(group, "term").agg(F.count(F.lit(1)).alias("tf"))
          .withColumn("__c", F.floor(F.log2("tf"))))
    w = Window.partitionBy(group).orderBy(F.desc("tf"), F.asc("term"))
    return (tf.join(_cut_classes(tf, [group], max_terms), [group, "__c"]).drop("__c")
            .withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= max_terms).drop("__r"))


def count_vector_model(vocab_terms: list[str], input_col: str = "terms",
                       output_col: str = "features") -> CountVectorizerModel:
    """``CountVectorizerModel`` over an explicit vocabulary, so term order
    (and ties) are exactly those of :func:`bounded_vocabulary`."""
    return CountVectorizerModel.from_vocabulary(vocab_terms, inputCol=input_col, outputCol=output_col)


def english_stops(words=ENGLISH_STOP_WORDS) -> list[str]:
    return list(words)


def sparse_counts_by_group(docs: DataFrame, dtc: DataFrame, vocab: DataFrame, group: str, key: str,
                           max_terms: int) -> DataFrame:
    """ML1 + ML3 per group, sparse: (group, key, idx, val, width) where
    ``val[j]`` counts the group's ``idx[j]``-th vocabulary term (order
    ``tf desc, term``) in the document and ``width`` is the group's
    vocabulary size; every document of ``docs`` gets a row.

    The vocabulary is at most ``max_terms`` per group.  A document's entries are
    collected per document (bounded by ``max_terms``), never per group."""
    w = Window.partitionBy(group).orderBy(F.desc("tf"), F.asc("term"))
    idx = vocab.select(group, "term", "tf").withColumn("idx", (F.row_number().over(w) - 1).cast("int"))
    sizes = idx.groupBy(group).agg(F.count(F.lit(1)).cast("int").alias("__v"))
    hits = dtc.join(idx.select(group, "term", "idx"), [group, "term"])
    per_doc = (hits.groupBy(group, key)
               .agg(F.collect_list(F.struct("idx", F.col("n").cast("double").alias("n"))).alias("__e")))
    return (docs.select(group, key).join(per_doc, [group, key], "left")
            .join(sizes, group, "left")
            .select(group, key,
                    F.coalesce(F.transform("__e", lambda e: e["idx"]), F.array().cast("array<int>")).alias("idx"),
                    F.coalesce(F.transform("__e", lambda e: e["n"]), F.array().cast("array<double>")).alias("val"),
                    F.coalesce(F.col("__v"), F.lit(0)).alias("width")))

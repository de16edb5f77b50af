"""Word vectors and mean vector per text (S3 stand-in, J2, A12, P8).

Texts are dealt to blocks of a bounded number, and a word's vector goes once to every block that has the
word, not once to every text: what is shuffled is the texts' words and one vector per (block, distinct word).
A block's task averages its texts' vectors with numpy.  Texts without any known word get
no row (the original's NaN rows, dropped).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from essayspark.session import ensure_checkpoint_dir, written

#: Texts whose means one task makes at a time.
TEXTS_PER_BLOCK = 2048


def ranked_words(words: DataFrame, word: str, n_top: int) -> DataFrame:
    """(word, rank0) of the ``n_top`` most frequent words, ties by word.

    A rank is the number of words that are more frequent, plus those of equal frequency with a
    smaller beginning, plus the place among words of equal frequency and beginning.  The first two
    come from counts, so no window ever holds more than the words of one frequency and beginning."""
    top = (words.groupBy(word).agg(F.count(F.lit(1)).alias("__n"))
           .withColumn("__b", F.substring(word, 1, 3)))
    sizes = top.groupBy("__n", "__b").agg(F.count(F.lit(1)).alias("__m"))
    before = Window.unboundedPreceding, -1
    # one row per distinct frequency: the number of frequencies grows with the root of the corpus
    levels = (sizes.groupBy("__n").agg(F.sum("__m").alias("__l"))
              .withColumn("__over", F.coalesce(F.sum("__l").over(Window.orderBy(F.desc("__n")).rowsBetween(*before)), F.lit(0)))
              .filter(F.col("__over") < n_top).select("__n", "__over"))
    starts = (sizes.join(levels, "__n")
              .withColumn("__start", F.col("__over") + F.coalesce(
                  F.sum("__m").over(Window.partitionBy("__n").orderBy("__b").rowsBetween(*before)), F.lit(0)))
              .filter(F.col("__start") < n_top).select("__n", "__b", "__start"))
    w = Window.partitionBy("__n", "__b").orderBy(word)
    return (top.join(starts, ["__n", "__b"])
            .withColumn("rank0", (F.col("__start") + F.row_number().over(w) - 1).cast("bigint"))
            .filter(F.col("rank0") < n_top).select(word, "rank0"))


def word_vectors(words: DataFrame, word: str, vectors: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """(word, vec): the word of corpus rank r gets the vector with id r
    (stand-in for a word-vector file keyed by word)."""
    n = vectors.count()
    ranked = ranked_words(words, word, n)
    out = ranked.join(vectors.select(F.col(vec_id).alias("rank0"), F.col(vec).alias("vec")), "rank0") \
                .select(F.col(word).alias("word"), "vec")
    # small (n rows) and read twice (size check, join): cut the lineage by
    # writing it to the shared checkpoint folder instead of recomputing
    ensure_checkpoint_dir(words.sparkSession)
    return out.checkpoint(eager=True)


def mean_vectors(df: DataFrame, key: str, words: Column, vectors: DataFrame) -> DataFrame:
    """(key, n_known, mean) with ``mean`` a ml Vector: the average of the
    vectors of the text's known words, repeats counted each time."""
    blocks = -(-max(df.count(), 1) // TEXTS_PER_BLOCK)
    # written once: the texts' words go to their block, and so do those words' vectors
    texts = written(df.select(F.col(key).alias("key"), words.alias("words"), F.pmod(F.xxhash64(F.col(key), words), F.lit(blocks)).alias("block")))
    needed = texts.select(F.col("block").alias("at"), F.explode("words").alias("word")).distinct().join(vectors.select("word", "vec"), "word")

    def run(some: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(some) and len(known):
            names, place = np.unique(known["word"].to_numpy().astype(str), return_inverse=True)
            vec = np.stack(known["vec"].to_numpy()).astype(np.float64)
            total, times = np.zeros((len(names), vec.shape[1])), np.bincount(place)
            np.add.at(total, place, vec)  # a word with several vectors counts with each
            index = pd.Index(names)
            for k, w in zip(some["key"], some["words"]):
                at = index.get_indexer(w) if w is not None and len(w) else np.zeros(0, int)
                at = at[at >= 0]
                if len(at):
                    n = int(times[at].sum())
                    out.append((k, n, total[at].sum(0) / n))
        return pd.DataFrame(out, columns=["key", "n", "mean"])

    kind = dict(texts.dtypes)["key"]
    means = texts.groupBy("block").cogroup(needed.groupBy("at")).applyInPandas(run, f"key {kind}, n bigint, mean array<double>")
    # a key that several texts share has one mean of all their words
    return (means.groupBy(F.col("key").alias(key))
            .agg(F.sum("n").alias("n_known"),
                 Summarizer.mean(array_to_vector(F.col("mean")), F.col("n").cast("double")).alias("mean")))


def finite_rows(df: DataFrame, vec: str = "mean") -> DataFrame:
    """Keep rows whose mean vector has no NaN component."""
    return df.filter(F.forall(vector_to_array(F.col(vec)), lambda x: ~F.isnan(x)))

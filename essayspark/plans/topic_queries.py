"""Driver queries for the topic model (ML9-ML12, O3, A5, A16, J7, V6).

The LDA queries share one fitted model per (session, texts, k); the
fixed-matrix queries exercise A16, O3 and A5 against DuckDB on a
topic-term table derived from ``embeddings`` (label as topic)."""

from __future__ import annotations

from pyspark.sql import functions as F

from essayspark.operators import features as FT
from essayspark.operators import lda
from essayspark.operators import split as S
from essayspark.operators import topics as TP
from essayspark.operators import vocab as V
from essayspark.plans.registry import r6, r6_sql, register
from essayspark.plans.vocab_queries import MAX_DF, MIN_DF, STOPS, TOPIC_VOCAB
from essayspark.session import checkpointed
from essayspark.sources.tables import essay_texts

K_TOPICS = 8
_VECTORS: dict = {}
_MODELS: dict = {}


TRAIN_SALT = "topics"


def lemmatised_texts(spark, sf):
    """The topic model's input (T20): every text as its lemmas, joined by blanks."""
    texts = essay_texts(spark, sf).select("essay_id", "essay_set", "essay")
    return FT.with_pos_lemmas(texts, "essay", ["lemmatised"]).drop("essay")


def _vocab(docs, test_fraction: float | None):
    """The bounded vocabulary of all texts, or of the training texts only."""
    if test_fraction is not None:
        docs = S.train_test(docs, "essay_id", test_fraction, TRAIN_SALT)[0]
    return V.bounded_vocabulary(V.term_stats(docs, F.col("terms")), docs.count(), TOPIC_VOCAB, MIN_DF, MAX_DF)


def _vectors(spark, sf, test_fraction: float | None):
    """The vocabulary's terms and the count vectors of every text, which do not depend on the number of topics."""
    # the terms are written once: the vocabulary, its number of texts and the vectors read them, and no text is lemmatised twice
    texts = checkpointed(lemmatised_texts(spark, sf).select("essay_id", "essay_set", V.vectorizer_terms("lemmatised", STOPS).alias("terms")))
    terms = [r["term"] for r in _vocab(texts, test_fraction).orderBy(F.desc("tf"), F.asc("term")).collect()]
    cols = ["essay_id", "essay_set"]
    if test_fraction is not None:
        texts = texts.withColumn("part", F.when(S.in_test("essay_id", test_fraction, TRAIN_SALT), "test")
                                 .otherwise("train"))
        cols.append("part")
    # written once to the shared folder: every step of the fit reads these rows, nothing stays pinned in memory
    return terms, checkpointed(lda.count_rows(texts, "terms", terms, cols))


def lda_fit(spark, sf, k: int = K_TOPICS, test_fraction: float | None = None):
    """Vocabulary (bounded, collected: at most 2000 terms), count vectors
    from that exact vocabulary, and the fitted model.

    With ``test_fraction`` the vocabulary and the model come from the
    training texts only, and every text (``part`` = train / test) is
    vectorised with that vocabulary (defect D8: the original refits both on
    the test texts)."""
    source = essay_texts(spark, sf)
    # the run's texts, not their path, name the model: a table that changed is fitted anew
    content = source.agg(F.count(F.lit(1)), F.sum(F.xxhash64("essay_id", "essay_set", "essay").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, *content, test_fraction)
    if key not in _VECTORS:
        _VECTORS[key] = _vectors(spark, sf, test_fraction)
    terms, docs = _VECTORS[key]
    if (key, k) not in _MODELS:
        fit_on = docs if test_fraction is None else docs.filter(F.col("part") == "train")
        _MODELS[key, k] = TP.fit_lda(fit_on, k, len(terms))
    return terms, docs, _MODELS[key, k]


@register("topic_words")
def topic_words(spark, sf):
    """ML10 + A16: probability of each vocabulary term in each topic."""
    terms, _, model = lda_fit(spark, sf)
    return TP.topic_terms(model, terms, spark).select("topic", "term", r6("weight", "weight"))


@register("topic_top15_k5")
def topic_top15_k5(spark, sf):
    """ML9 + O3 with five topics."""
    terms, _, model = lda_fit(spark, sf, 5)
    return TP.top_terms(TP.topic_terms(model, terms, spark), 15).select("topic", "rank", "term", r6("weight", "weight"))


@register("topic_top15_k2")
def topic_top15_k2(spark, sf):
    """ML9 + O3 with two topics."""
    terms, _, model = lda_fit(spark, sf, 2)
    return TP.top_terms(TP.topic_terms(model, terms, spark), 15).select("topic", "rank", "term", r6("weight", "weight"))


@register("topic_perplexity")
def topic_perplexity(spark, sf):
    """ML9: log perplexity bound per token of the models with 8, 5 and 2 topics."""
    fits = [(k, lda_fit(spark, sf, k)) for k in (8, 5, 2)]
    rows = [(k, float(model.log_perplexity())) for k, (_, _, model) in fits]
    return spark.createDataFrame(rows, "k int, log_perplexity double").select("k", r6("log_perplexity", "log_perplexity"))


@register("topic_top15")
def topic_top15(spark, sf):
    """O3: the 15 most probable terms of each topic."""
    terms, _, model = lda_fit(spark, sf)
    return TP.top_terms(TP.topic_terms(model, terms, spark), 15).select("topic", "rank", "term", r6("weight", "weight"))


@register("document_topics")
def document_topics(spark, sf):
    """ML11 + J7: topic shares of every essay, with its set carried along."""
    _, docs, model = lda_fit(spark, sf)
    return TP.document_topics(model, docs, ["essay_id", "essay_set"]).select(
        "essay_id", "essay_set", "topic", r6("p", "p"))


@register("topic_by_set")
def topic_by_set(spark, sf):
    """ML12 + A5 + V6: median topic share per set and the dominant topic."""
    _, docs, model = lda_fit(spark, sf)
    dt = TP.document_topics(model, docs, ["essay_id", "essay_set"])
    return TP.group_topic_medians(dt, "essay_set").select("essay_set", "topic", r6("median_p", "median_p"),
                                                          "is_dominant")


# ------------------------------------------------------------------ fixed matrix (SQL-checked)
def _emb_weights(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    x = e.select(F.col("label").alias("topic"), F.posexplode("embedding").alias("dim", "v"))
    return (x.groupBy("topic", "dim").agg(F.sum(F.abs(F.col("v").cast("double"))).alias("w"))
            .select("topic", F.concat(F.lit("d"), F.col("dim").cast("string")).alias("term"), "w"))


_EMB_W_SQL = """
x AS (SELECT label AS topic, unnest(CAST(embedding AS DOUBLE[])) AS v,
             generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
w AS (SELECT topic, 'd' || CAST(dim AS VARCHAR) AS term, sum(abs(v)) AS w FROM x GROUP BY topic, dim),
nw AS (SELECT topic, term, w / sum(w) OVER (PARTITION BY topic) AS weight FROM w)
"""


@register("topic_matrix_normalise", f"WITH {_EMB_W_SQL} SELECT topic, term, {r6_sql('weight')} AS weight FROM nw")
def topic_matrix_normalise(spark, sf):
    """A16 on a fixed topic-term table: weights divided by their topic's total."""
    return TP.normalise_rows(_emb_weights(spark, sf), "topic", "w", "weight").select(
        "topic", "term", r6("weight", "weight"))


@register("topic_matrix_top15",
          f"WITH {_EMB_W_SQL} SELECT topic, CAST(rank AS INTEGER) AS rank, term, {r6_sql('weight')} AS weight FROM "
          f"(SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM nw) "
          f"WHERE rank <= 15")
def topic_matrix_top15(spark, sf):
    """O3 on a fixed topic-term table."""
    nw = TP.normalise_rows(_emb_weights(spark, sf), "topic", "w", "weight")
    return TP.top_terms(nw, 15).select("topic", "rank", "term", r6("weight", "weight"))


_MED_SQL = f"""
WITH x AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS v,
                  generate_subscripts(embedding, 1) - 1 AS topic FROM embeddings),
s AS (SELECT vec_id, label, topic, abs(v) / sum(abs(v)) OVER (PARTITION BY vec_id) AS p FROM x),
m AS (SELECT label, topic, median(p) AS median_p FROM s GROUP BY label, topic)
SELECT label, CAST(topic AS INTEGER) AS topic, {r6_sql('median_p')} AS median_p,
       row_number() OVER (PARTITION BY label ORDER BY median_p DESC, topic) = 1 AS is_dominant FROM m
"""


@register("topic_matrix_medians", _MED_SQL)
def topic_matrix_medians(spark, sf):
    """A5 + ML12 on fixed shares: |x_d| / sum |x| per row, all dimensions, median per (label, topic)."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    head = F.transform("embedding", lambda v: F.abs(v.cast("double")))
    shares = e.select("vec_id", "label", head.alias("a")).select(
        "vec_id", "label", F.posexplode("a").alias("topic", "v"),
        F.aggregate("a", F.lit(0.0), lambda acc, v: acc + v).alias("tot"))
    dt = shares.select("label", "topic", (F.col("v") / F.col("tot")).alias("p"))
    return TP.group_topic_medians(dt, "label").select("label", "topic", r6("median_p", "median_p"), "is_dominant")

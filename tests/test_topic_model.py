"""Batch variational topic model against a plain numpy reference, and exact quantiles and n-gram vocabularies against plain counting."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from essayspark.operators import lda
from essayspark.operators import vocab as V
from essayspark.operators.quantiles import exact_quantiles


def test_special_functions():
    x = np.array([1e-3, 0.1, 0.5, 1.0, 3.7, 50.0, 1e5])
    assert np.allclose(lda.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    step = 1e-5
    slope = [(math.lgamma(v + step * v) - math.lgamma(v - step * v)) / (2 * step * v) for v in x]
    assert np.allclose(lda.digamma(x), slope, rtol=1e-5, atol=1e-6)
    assert abs(lda.digamma(np.array(1.0)) + 0.5772156649015329) < 1e-13


def corpus(rng, n=60, terms=25, k=3):
    topics = rng.dirichlet(np.full(terms, 0.1), k)
    docs = []
    for i in range(n):
        share = rng.dirichlet(np.full(k, 0.3))
        words = Counter(rng.choice(terms, p=share @ topics, size=int(rng.integers(0, 40))).tolist())
        idx = sorted(words)
        docs.append((i, idx, [float(words[j]) for j in idx]))
    return docs + [(n, [], [])]


def plain_steps(docs, start, alpha, eta, steps):
    """One document at a time, loops written out."""
    weights, bounds = start.copy(), []
    k, terms = start.shape
    for _ in range(steps):
        e_beta = lda.digamma(weights) - lda.digamma(weights.sum(1))[:, None]
        stats, bound = np.zeros_like(weights), 0.0
        for _, idx, cnt in docs:
            gamma = np.ones(k) if idx else np.full(k, alpha)
            for _ in range(lda.INNER_STEPS if idx else 0):
                e_theta = lda.digamma(gamma) - lda.digamma(gamma.sum())
                new = np.full(k, alpha)
                for j, c in zip(idx, cnt):
                    phi = np.exp(e_theta + e_beta[:, j])
                    new += c * phi / phi.sum()
                done = np.abs(new - gamma).mean() < lda.INNER_CHANGE
                gamma = new
                if done:
                    break
            e_theta = lda.digamma(gamma) - lda.digamma(gamma.sum())
            for j, c in zip(idx, cnt):
                phi = np.exp(e_theta + e_beta[:, j])
                stats[:, j] += c * phi / phi.sum()
                bound += c * math.log(phi.sum())
            bound += float(((alpha - gamma) * e_theta).sum()) + sum(math.lgamma(g) - math.lgamma(alpha) for g in gamma) + math.lgamma(alpha * k) - math.lgamma(gamma.sum())
        for t in range(k):
            bound += float(((eta - weights[t]) * e_beta[t]).sum()) + sum(math.lgamma(w) - math.lgamma(eta) for w in weights[t])
            bound += math.lgamma(eta * terms) - math.lgamma(weights[t].sum())
        bounds.append(bound)
        weights = eta + stats
    return weights, bounds


def test_batch_topic_model_equals_plain_updates(spark):
    docs, start = corpus(np.random.default_rng(1)), lda.start_weights(3, 25, 5)
    df = spark.createDataFrame(docs, "i int, idx array<int>, cnt array<double>")
    want, bounds = plain_steps(docs, start, 1 / 3, 1 / 3, 8)
    for parts in (1, 7, 40):
        model = lda.fit(df.repartition(parts), 3, 25, max_iter=8, tolerance=0.0, start=start)
        assert np.allclose(model.weights, want, rtol=1e-6) and np.allclose(model.bounds, bounds, rtol=1e-9)
    assert model.tokens == sum(sum(c) for *_, c in docs)
    rises = np.diff(bounds) / abs(bounds[0])
    assert (rises > -1e-6).all() and bounds[-1] > bounds[0]


def test_topic_model_stops_when_perplexity_settles(spark):
    docs = spark.createDataFrame(corpus(np.random.default_rng(2)), "i int, idx array<int>, cnt array<double>").repartition(2)
    early = lda.fit(docs, 2, 25, max_iter=60, check_every=5, tolerance=1e6)
    assert len(early.bounds) == 10  # the second look is the first that can compare
    assert len(lda.fit(docs, 2, 25, max_iter=7, tolerance=0.0).bounds) == 7


def test_shares_of_documents(spark):
    docs = corpus(np.random.default_rng(3))
    df = spark.createDataFrame(docs, "i int, idx array<int>, cnt array<double>")
    model = lda.fit(df, 3, 25, max_iter=5)
    got = {r["i"]: r["shares"] for r in model.transform(df.repartition(5), ["i"]).collect()}
    assert len(got) == len(docs) and all(abs(sum(s) - 1) < 1e-9 for s in got.values())
    assert np.allclose(got[len(docs) - 1], 1 / 3)  # no term: the prior
    assert lda.fit(df.limit(0), 3, 25, max_iter=5).tokens == 0


def test_count_rows(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "zz"]), (2, []), (3, None)], "i int, t array<string>")
    assert {r["i"]: (r["idx"], r["cnt"]) for r in lda.count_rows(df, "t", ["a", "b"], ["i"]).collect()} == {1: ([0, 1], [1.0, 2.0]), 2: ([], []), 3: ([], [])}


@pytest.mark.parametrize("seed", range(3))
def test_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    groups = {
        "a": rng.normal(size=101) * 10.0 ** rng.integers(-200, 200), "b": np.r_[np.full(500, 0.125), rng.uniform(size=400)], "c": np.array([3.0]),
        "d": np.array([-0.0, 0.0, -1e-300, 1e-300, -5.0, 7.0]), "e": rng.integers(-3, 4, 50).astype(float),
    }
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("a", None), (None, 1.0), ("f", None)]
    got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(6), ["g"], "v", qs).collect()}
    assert got.keys() == groups.keys()
    for g, x in groups.items():
        assert got[g][0] == len(x) and np.allclose(got[g][1], np.quantile(x, qs), rtol=1e-12, atol=0)


def test_equal_values_do_not_meet_as_rows(spark):
    """A third of all rows share a value: after the first aggregation they are one row."""
    from essayspark.operators.quantiles import value_counts

    df = spark.range(3000).select(F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 3000).alias("v"))
    counts = value_counts(df, ["g"], "v")
    assert counts.count() == df.select("v").distinct().count() and counts.agg(F.max("n")).first()[0] >= 1000


@pytest.mark.parametrize("by,max_terms,told", [([], 12, 16), (["g"], 9, 16), ([], 500, 16), ([], 15, 0)])
def test_ngrams_by_levels_equal_plain_counting(spark, monkeypatch, by, max_terms, told):
    monkeypatch.setattr(V, "TOLD", told)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(12)]
    p = np.array([1 / (i + 1) for i in range(12)])
    rows = [(i, "ab"[i % 2] if i % 7 else None, [words[j] for j in rng.choice(12, size=int(rng.integers(0, 30)), p=p / p.sum())]) for i in range(80)]
    docs = spark.createDataFrame(rows, "i int, g string, toks array<string>").repartition(3)
    grams = V.NgramVocabulary(docs, "toks", 3, max_terms, by)
    every = [(r[1] if by else "", r[0], " ".join(r[2][j:j + n])) for r in rows for n in (1, 2, 3) for j in range(len(r[2]) - n + 1) if not (by and r[1] is None)]
    tf, want = Counter((g, t) for g, _, t in every), set()
    for g in {g for g, _ in tf}:
        want |= set(sorted(((h, t, n) for (h, t), n in tf.items() if h == g), key=lambda x: (-x[2], x[1]))[:max_terms])
    assert {(r["g"] if by else "", r["term"], r["tf"]) for r in grams.vocabulary.collect()} == want
    kept = {(g, t) for g, t, _ in want}
    counts = Counter((i, t) for g, i, t in every if (g, t) in kept)
    got = {(r["i"], r["term"]): r["n"] for r in grams.counts([*by, "i"]).collect()}
    assert got == counts


def test_count_vectors_are_made_once_for_every_number_of_topics(spark):
    """The texts are lemmatised and counted once, whatever the number of topics."""
    from essayspark.plans import topic_queries as TQ

    terms, docs, small = TQ.lda_fit(spark, "/root/testdata/sf0.001", 2)
    again, same, large = TQ.lda_fit(spark, "/root/testdata/sf0.001", 3)
    assert docs is same and terms == again and (small.k, large.k) == (2, 3)


def test_documents_of_any_length_keep_their_weights_beside_others():
    """Blocks of like length, padded and thinned out, give what each document gives alone."""
    rng = np.random.default_rng(4)
    beta = np.exp(lda.expected_log(lda.start_weights(3, 40, 1)))
    lens = np.array([0, 1, 40, 3, 0, 17, 2, 29, 40, 5] * 3)
    term = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in lens]).astype(np.int32)
    count = rng.integers(1, 5, len(term)).astype(float)
    gamma, theta = lda.infer(lens, term, count, beta, 1 / 3)
    ends = np.cumsum(lens)
    for i, n in enumerate(lens):
        at = slice(ends[i] - n, ends[i])
        g, t = lda.infer(lens[i:i + 1], term[at], count[at], beta, 1 / 3)
        assert np.allclose(g[0], gamma[i], rtol=1e-9) and np.allclose(t[0], theta[i], rtol=1e-9)

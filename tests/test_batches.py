"""Tags, lemmas, term counts and topic updates that go by Arrow batches, against the expressions and plain loops."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from essayspark.functions import lexicon as L
from essayspark.operators import features as FT
from essayspark.operators import lda
from essayspark.operators import vocab as V


def test_words_in_python_follow_the_expressions(spark):
    draw = random.Random(4)
    ends = [s for s, _ in L.SUFFIX_TAGS] + [s for _, s, *_ in L.LEMMA_RULES] + ["", "0", "9"]
    words = sorted({"".join(draw.choice("abeiosz09") for _ in range(draw.randrange(6))) + draw.choice(ends) for _ in range(3000)} | set(L.LEX_TAG) | {"12", "1a", "a1"} - {""})
    w = F.col("w")
    df = spark.createDataFrame([(x,) for x in words], "w string").select("w", L.pos_tag(w).alias("t")).select("w", "t", L.lemma(w, F.col("t")).alias("l"))
    for r in df.collect():
        assert (L.tag_word(r.w), L.lemma_word(r.w, r.t)) == (r.t, r.l)


def test_tags_and_lemmas_of_a_batch(spark, monkeypatch):
    texts = [None, "", "...", "The Children were RUNNING, quickly; 42 cats' naïve studies é", "cat " * 700 + "dogs"] * 60
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    tokens = FT.lower_tokens("t")
    tagged = F.transform(tokens, lambda w: F.struct(L.pos_tag(w).alias("t"), L.lemma(w, L.pos_tag(w)).alias("l")))
    by_tag = [F.size(F.filter(tagged, lambda x: x["t"] == "N")), F.size(F.filter(tagged, lambda x: x["t"] == "J")),
              F.size(F.filter(tagged, lambda x: x["t"] == "V")), F.size(F.filter(tagged, lambda x: x["t"] == "R"))]
    lemmas = F.transform(tagged, lambda x: x["l"])
    want = df.select("i", "t", *[c.cast("bigint") for c in by_tag], F.size(F.array_distinct(lemmas)).cast("bigint"), F.array_join(lemmas, " "))
    got = FT.with_pos_lemmas(df, "t")
    assert got.columns == ["i", "t", *FT.POS_LEMMA] and "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    asked = Counter()
    monkeypatch.setattr(L, "tag_word", lambda w: asked.update([w]) or "N")
    words = FT._Words()
    assert [words[b"cats"], words[b"cats"]] == [("N", b"cat")] * 2 and asked == {"cats": 1}


def test_term_stats_and_count_rows_by_batches(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(i, [draw.choice("abcdefg") * draw.randrange(1, 3) for _ in range(draw.randrange(30))]) for i in range(200)] + [(200, None), (201, []), (202, ["a", None, None])]
    df = spark.createDataFrame(rows, "i int, t array<string>").repartition(4)
    tf, dfs = Counter(w for _, t in rows for w in t or []), Counter(w for _, t in rows for w in set(t or []))
    assert {r.term: (r.df, r.tf) for r in V.term_stats(df, F.col("t")).collect()} == {w: (dfs[w], tf[w]) for w in tf}
    known = ["b", "aa", "g", "zz"]
    want = {i: sorted(Counter(known.index(w) for w in t or [] if w in known).items()) for i, t in rows}
    assert {r.i: list(zip(r.idx, r.cnt)) for r in lda.count_rows(df, "t", known, ["i"]).collect()} == want
    assert {r.i: r.idx for r in lda.count_rows(df, "t", [], ["i"]).collect()} == {i: [] for i, _ in rows}


def test_runs_of_a_batch_cover_it(monkeypatch):
    import pyarrow as pa

    rows = [None, ["a"] * 5, [], ["b", "a"], ["c"] * 9, None, ["a"]]
    monkeypatch.setattr(V, "COUNTED", 4)
    got = []
    for a, b, text, number, distinct in V.encoded_terms(pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["t"]), "t"):
        assert a == len(got)
        got += [[distinct[n].as_py() for n in number[text == i]] for i in range(b - a)]
    assert got == [r or [] for r in rows]


def test_exponents_of_digamma():
    x = np.array([0.05, 0.1, 0.5, 1.0, 3.7, 50.0, 1e5])
    assert np.allclose(lda.exp_digamma(x), np.exp(lda.digamma(x)), rtol=1e-12)


@pytest.mark.parametrize("run", [1, 3, 1000])
def test_documents_laid_out_anew_end_where_one_document_alone_ends(run, monkeypatch):
    rng = np.random.default_rng(6)
    k, terms, alpha = 4, 30, 0.25
    beta = np.exp(lda.expected_log(rng.gamma(1.0, 1.0, (k, terms))))
    docs = [sorted(rng.choice(terms, size=int(n), replace=False).tolist()) for n in rng.integers(0, 25, 40)]
    counts = [rng.integers(1, 9, len(d)).astype(float) for d in docs]
    monkeypatch.setattr(lda, "RUN", run)
    monkeypatch.setattr(lda, "BLOCK", 300)
    lens = np.array([len(d) for d in docs])
    gamma, theta = lda.infer(lens, np.concatenate([np.array(d, np.int64) for d in docs]), np.concatenate(counts), beta, alpha)
    for i, (d, c) in enumerate(zip(docs, counts)):
        g = np.ones(k) if len(d) else np.full(k, alpha)
        for _ in range(lda.INNER_STEPS if len(d) else 0):
            t = np.exp(lda.expected_log(g))
            new = alpha + t * (beta[:, d] @ (c / (t @ beta[:, d])))
            done = np.abs(new - g).mean() < lda.INNER_CHANGE
            g = new
            if done:
                break
        assert np.allclose(gamma[i], g, rtol=1e-9) and np.allclose(theta[i], np.exp(lda.expected_log(g)), rtol=1e-9)
        assert math.isclose(gamma[i].sum(), k * alpha + c.sum(), rel_tol=1e-9)

"""Properties: splits, folds, exact KNN, Lasso, partition invariance, topics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from essayspark.operators import knn as K
from essayspark.operators import linear as LN
from essayspark.operators import split as S
from essayspark.sources.tables import table


def test_split_disjoint_and_complete(spark):
    e = table(spark, SF001, "embeddings")
    tr, te = S.train_test(e, "vec_id", 0.3)
    a = {r[0] for r in tr.select("vec_id").collect()}
    b = {r[0] for r in te.select("vec_id").collect()}
    assert not (a & b) and len(a | b) == e.count()
    assert 0.2 < len(b) / (len(a) + len(b)) < 0.4


def test_stratified_folds_balanced_and_exact(spark):
    e = table(spark, SF001, "embeddings")
    f = S.stratified_folds(e, "vec_id", "label", 5, salt="")
    sizes = f.groupBy("label", "fold").count().toPandas()
    for _, g in sizes.groupby("label"):
        assert g["count"].max() - g["count"].min() <= 1
    # small buckets force many (class, bucket) windows: same answer
    r1 = {r["vec_id"]: r["rank"] for r in S.rank_in_class(e, "vec_id", "label", bucket_digits=1).collect()}
    r3 = {r["vec_id"]: r["rank"] for r in S.rank_in_class(e, "vec_id", "label", bucket_digits=3).collect()}
    assert r1 == r3


def test_knn_matches_brute_force(spark):
    e = table(spark, SF001, "embeddings")
    tr, te = S.train_test(e, "vec_id", 0.3)
    k = 7
    nb = K.neighbours(te.select(F.col("vec_id").alias("qid"), "embedding"), tr, k, qkey="qid",
                      tkey="vec_id", vec="embedding", label="label", rows_per_block=64)
    got = {}
    for r in nb.collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["vec_id"]))
    trp, tep = tr.toPandas(), te.toPandas()
    T = np.stack(trp.embedding.to_numpy()).astype(np.float64)
    for _, q in tep.iterrows():
        d = ((T - np.asarray(q.embedding, dtype=np.float64)) ** 2).sum(axis=1)
        order = np.lexsort((trp.vec_id.to_numpy(), d))[:k]
        assert [v for _, v in sorted(got[q.vec_id])] == list(trp.vec_id.to_numpy()[order])


def test_lasso_closed_form_matches_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(0)
    x = rng.uniform(0, 10, 400)
    y = 3 * x + 2 + rng.normal(0, 1, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    closed = {r["alpha"]: r for r in LN.lasso_1d(df, "x", "y", [1.0]).collect()}[1.0]
    lr = LinearRegression(featuresCol="f", labelCol="y", elasticNetParam=1.0, regParam=1.0,
                          standardization=False, tol=1e-12, maxIter=500)
    m = lr.fit(VectorAssembler(inputCols=["x"], outputCol="f").transform(df))
    assert m.coefficients[0] == pytest.approx(closed["coef"], rel=1e-4)
    assert m.intercept == pytest.approx(closed["intercept"], rel=1e-3)


def test_same_result_for_1_and_8_shuffle_partitions(spark):
    import __spark_entry__ as entry

    q = entry.queries()["spelling_errors"]
    res = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        res.append(sorted(map(tuple, q(spark, SF001).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1]


def test_topic_shares_sum_to_one(spark):
    from essayspark.operators import topics as TP
    from essayspark.plans import topic_queries as TQ

    terms, docs, model = TQ.lda_fit(spark, SF001)
    dt = TP.document_topics(model, docs, ["essay_id"])
    shares = dt.groupBy("essay_id").agg(F.sum("p").alias("s"), F.min("p").alias("low"), F.max("p").alias("high"))
    rows = docs.select("essay_id", F.size("idx").alias("nnz")).join(shares, "essay_id", "left").collect()
    assert rows and all(abs(r["s"] - 1.0) < 1e-9 for r in rows)
    # a text with no vocabulary term keeps the prior: the same share of every topic
    assert all(abs(r["high"] - r["low"]) < 1e-9 for r in rows if not r["nnz"])
    tw = TP.topic_terms(model, terms, spark)
    for r in tw.groupBy("topic").agg(F.sum("weight").alias("s")).collect():
        assert abs(r["s"] - 1.0) < 1e-9


def test_knn_block_holds_few_distances_at_a_time():
    """A block pair's memory does not follow queries x training rows."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    from essayspark.operators import knn as K

    rng = np.random.default_rng(3)
    rows = rng.integers(0, 4, (3000, 5)).astype(float)  # many ties
    qp = pd.DataFrame({"qid": np.arange(3000), "v": list(rows), "fold": np.arange(3000) % 5})
    tp = pd.DataFrame({"id": np.arange(3000)[::-1], "v": list(rows[::-1]), "label": np.arange(3000) % 3, "__tfold": np.arange(3000)[::-1] % 5})
    fn = K._block_topk(4, "qid", "id", "v", "label", [], "fold", "__tfold")
    tracemalloc.start()
    got = fn(qp, tp)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    for q in (0, 1, 1499, 2999):
        d = ((rows - rows[q]) ** 2).sum(1)
        want = sorted((d[i], i) for i in range(3000) if i % 5 != q % 5)[:4]
        mine = got[got["qid"] == q]
        assert list(zip(mine["dist"], mine["id"])) == want


def test_tags_and_lemmas_equal_the_rules_one_by_one(spark):
    """words are tried by their last letter; endings that give the default tag are not tried at all."""
    from essayspark.functions import lexicon as L

    endings = {s for s, _ in L.SUFFIX_TAGS} | {s for _, s, _, _ in L.LEMMA_RULES} | {"a", "ss", "bical"}
    words = sorted({stem + e for stem in ("", "a", "ab", "abc", "abcd", "uses") for e in endings} | set(L.LEX_TAG) | {"1", "12s", ""})

    def tag(w):
        if w in L.LEX_TAG:
            return L.LEX_TAG[w]
        if w and all("0" <= c <= "9" for c in w):
            return "O"
        return next((t for s, t in L.SUFFIX_TAGS if w.endswith(s) and len(w) > len(s) + 2), L.DEFAULT_TAG)

    def lemma(w, t):
        if w in L.LEX_LEMMA:
            return L.LEX_LEMMA[w]
        n = t if t in ("N", "V") else "N"
        return next((w[:len(w) - len(s)] + r for k, s, r, least in L.LEMMA_RULES if k == n and w.endswith(s) and len(w) >= least), w)

    w = F.col("w")
    df = spark.createDataFrame([(x,) for x in words], "w string").select("w", L.pos_tag(w).alias("t"))
    got = {r.w: (r.t, r.l) for r in df.select("w", "t", L.lemma(w, F.col("t")).alias("l")).collect()}
    assert got == {x: (tag(x), lemma(x, tag(x))) for x in words}
    assert "tion" not in str(L.pos_tag(w))  # a noun's ending: the default


def test_feature_bins_read_their_rows_once(spark):
    """ranges and counts read written rows, the features are not computed twice."""
    from essayspark.operators import profile as PR

    df = spark.range(20).selectExpr("id as k", "'g' as s", "id % 3 as y", "sqrt(id * 1.0D) as f")
    out = PR.feature_bins(df, "s", ["f"], "y", "k")
    assert "SQRT" not in out._jdf.queryExecution().executedPlan().toString()
    assert sum(r.n_points for r in out.collect()) == 20

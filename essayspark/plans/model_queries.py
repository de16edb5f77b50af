"""Driver queries for splits, folds, KNN, metrics and Lasso
(ML4-ML8, ML15, J5, J6, M1-M5, O7, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from essayspark.functions import fixed_values as FV
from essayspark.operators import clean as C
from essayspark.operators import knn as K
from essayspark.operators import linear as LN
from essayspark.operators import metrics as M
from essayspark.operators import split as S
from essayspark.operators import features as FT
from essayspark.plans.registry import r6, r6_sql, register
from essayspark.session import checkpointed
from essayspark.plans.text_queries import _TEN_SQL
from essayspark.sources.tables import attach_scores, essay_texts, table

KNN_K = 23
TEST = FV.TEST_FRACTION

# ------------------------------------------------------------------ SQL building blocks
_TR_SQL = f"SELECT vec_id, embedding, label FROM embeddings WHERE NOT ({S.in_test_sql('vec_id', TEST)})"
_TE_SQL = f"SELECT vec_id, embedding, label FROM embeddings WHERE {S.in_test_sql('vec_id', TEST)}"
_FOLDS_SQL = (f"SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), "
              f"vec_id) - 1) % {FV.N_FOLDS} AS INTEGER) AS fold FROM ({_TR_SQL})")


def _dist_sql(a: str, b: str) -> str:
    return (f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: "
            f"(CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE)) * (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE))))")


def _knn_pred_sql(q: str, t: str, k: int | str, group: str | None = None) -> str:
    """(qid, ql, pred[, grp]) for the k nearest of each query row."""
    same = f"AND q.{group} = t.{group}" if group else ""
    gsel = f", q.{group} AS grp" if group else ""
    return f"""
d AS (SELECT q.id AS qid, q.label AS ql, t.id AS tid, t.label AS tl {gsel}, {_dist_sql('q.vec', 't.vec')} AS dist
      FROM ({q}) q JOIN ({t}) t ON TRUE {same}),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM d),
v AS (SELECT qid, ql, tl {', grp' if group else ''}, count(*) AS c FROM r WHERE rn <= {k} GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c DESC, tl) AS rk FROM v)
"""


_EMB_Q = f"SELECT vec_id AS id, embedding AS vec, label FROM ({_TE_SQL})"
_EMB_T = f"SELECT vec_id AS id, embedding AS vec, label FROM ({_TR_SQL})"
_KNN_PRED = _knn_pred_sql(_EMB_Q, _EMB_T, KNN_K)


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


# ------------------------------------------------------------------ ML4 / U3
@register("split_train", f"SELECT vec_id, label FROM ({_TR_SQL})")
def split_train(spark, sf):
    """ML4 + U3: the training part (about 70%), by md5 of the key."""
    return S.train_test(_emb(spark, sf), "vec_id", TEST)[0].select("vec_id", "label")


@register("split_test", f"SELECT vec_id, label FROM ({_TE_SQL})")
def split_test(spark, sf):
    """ML4 + U3: the held-out part (about 30%), disjoint from the training part."""
    return S.train_test(_emb(spark, sf), "vec_id", TEST)[1].select("vec_id", "label")


# ------------------------------------------------------------------ ML7
@register("fold_sizes", f"SELECT label, fold, CAST(count(*) AS BIGINT) AS n FROM ({_FOLDS_SQL}) GROUP BY label, fold")
def fold_sizes(spark, sf):
    """ML7: stratified 5-fold sizes per class of the training part."""
    tr = S.train_test(_emb(spark, sf), "vec_id", TEST)[0]
    return (S.stratified_folds(tr, "vec_id", "label", FV.N_FOLDS)
            .groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")))


@register("fold_assignment", f"SELECT vec_id, label, fold FROM ({_FOLDS_SQL})")
def fold_assignment(spark, sf):
    """ML7: each training row's fold."""
    tr = S.train_test(_emb(spark, sf), "vec_id", TEST)[0]
    return S.stratified_folds(tr, "vec_id", "label", FV.N_FOLDS).select("vec_id", "label", "fold")


# ------------------------------------------------------------------ J6 / ML5 / M1
def knn_pairs(spark, sf):
    tr, te = S.train_test(_emb(spark, sf), "vec_id", TEST)
    pred = K.predict(te.select(F.col("vec_id").alias("qid"), "embedding"), tr, KNN_K,
                     qkey="qid", tkey="vec_id", vec="embedding", label="label")
    return te.select("vec_id", "label").join(pred.withColumnRenamed("qid", "vec_id"), "vec_id")


@register("knn_predict", f"WITH {_KNN_PRED} SELECT qid AS vec_id, ql AS label, tl AS pred FROM p WHERE rk = 1")
def knn_predict(spark, sf):
    """J6 + ML5: label of each held-out row by vote of its 23 nearest training rows."""
    return knn_pairs(spark, sf)


@register("knn_accuracy", f"WITH {_KNN_PRED} SELECT CAST(count(*) AS BIGINT) AS n, "
                          f"{r6_sql('avg(CASE WHEN tl = ql THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM p WHERE rk = 1")
def knn_accuracy(spark, sf):
    """M1: test accuracy of the 23-nearest-neighbour vote."""
    p = knn_pairs(spark, sf)
    return p.agg(F.count(F.lit(1)).alias("n"), r6(M.accuracy("label", "pred"), "accuracy"))


# ------------------------------------------------------------------ M5 (+ J5)
_KAPPA_SQL = f"""
WITH {_KNN_PRED},
pr AS (SELECT ql AS y, tl AS yhat FROM p WHERE rk = 1),
g AS (SELECT grade, CAST(row_number() OVER (ORDER BY grade) - 1 AS DOUBLE) AS rnk
      FROM (SELECT y AS grade FROM pr UNION SELECT yhat FROM pr)),
ij AS (SELECT gi.rnk AS i, gj.rnk AS j FROM pr JOIN g gi ON pr.y = gi.grade JOIN g gj ON pr.yhat = gj.grade)
SELECT CAST(count(*) AS BIGINT) AS n,
       {r6_sql('1.0 - avg((i - j) * (i - j)) / (avg(i * i) + avg(j * j) - 2 * avg(i) * avg(j))')} AS kappa
FROM ij
"""


@register("kappa_quadratic", _KAPPA_SQL)
def kappa_quadratic(spark, sf):
    """M5 + J5: quadratic-weighted kappa of the KNN predictions, pairs aligned by key."""
    k = M.quadratic_kappa(knn_pairs(spark, sf), "label", "pred")
    return k.select("n", r6("kappa", "kappa"))


# ------------------------------------------------------------------ ML6 / O7
_GRID_VALUES = ", ".join(f"({k})" for k in FV.KNN_K_GRID)
_GRID_SQL = f"""
WITH tr AS ({_FOLDS_SQL}),
d AS (SELECT q.vec_id AS qid, q.label AS ql, q.fold AS qf, t.vec_id AS tid, t.label AS tl,
             {_dist_sql('q.embedding', 't.embedding')} AS dist
      FROM tr q JOIN tr t ON q.fold <> t.fold),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM d),
g AS (SELECT r.*, ks.k FROM r JOIN (VALUES {_GRID_VALUES}) ks(k) ON r.rn <= ks.k),
v AS (SELECT qid, ql, qf, k, tl, count(*) AS c FROM g GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY c DESC, tl) AS rk FROM v),
acc AS (SELECT k, qf, avg(CASE WHEN tl = ql THEN 1.0 ELSE 0.0 END) AS a FROM p WHERE rk = 1 GROUP BY k, qf),
m AS (SELECT k, avg(a) AS mean_accuracy FROM acc GROUP BY k)
SELECT k, {r6_sql('mean_accuracy')} AS mean_accuracy,
       row_number() OVER (ORDER BY round(mean_accuracy, 12) DESC, k) = 1 AS is_best FROM m
"""


@register("knn_grid", _GRID_SQL)
def knn_grid(spark, sf):
    """ML6 + ML7 + O7: 5-fold grid search over k = 5, 8, ..., 23, one ranking pass."""
    tr = S.train_test(_emb(spark, sf), "vec_id", TEST)[0]
    folded = S.stratified_folds(tr, "vec_id", "label", FV.N_FOLDS)
    g = K.grid_search(folded, FV.KNN_K_GRID, key="vec_id", vec="embedding", label="label", fold="fold")
    return g.select(F.col("k").cast("int").alias("k"), r6("mean_accuracy", "mean_accuracy"), "is_best")


# ------------------------------------------------------------------ ML15: per set, ten features
def _k_for_set_sql(e: str) -> str:
    parts = " ".join(f"WHEN {e} = {s} THEN {k}" for s, k in sorted(FV.KNN_FINAL_K.items()))
    return f"CASE {parts} ELSE {KNN_K} END"


_FEAT_VEC_SQL = "[" + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in FT.TEN_FEATURES) + "]"
_SET_BASE = (f"SELECT essay_id AS id, essay_set, CAST(domain1_score AS INTEGER) AS label, {_FEAT_VEC_SQL} AS vec "
             f"FROM tf WHERE domain1_score IS NOT NULL")
_KNN_SET_SQL = f"""
WITH tf AS ({_TEN_SQL}),
base AS ({_SET_BASE}),
qq AS (SELECT * FROM base WHERE {S.in_test_sql('id', TEST)}),
tt AS (SELECT * FROM base WHERE NOT ({S.in_test_sql('id', TEST)})),
d AS (SELECT q.id AS qid, q.label AS ql, q.essay_set, t.id AS tid, t.label AS tl,
             {_dist_sql('q.vec', 't.vec')} AS dist
      FROM qq q JOIN tt t ON q.essay_set = t.essay_set),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM d),
v AS (SELECT qid, ql, essay_set, tl, count(*) AS c FROM r
      WHERE rn <= {_k_for_set_sql(C.set_number_sql('essay_set'))} GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c DESC, tl) AS rk FROM v)
SELECT essay_set, CAST({_k_for_set_sql(C.set_number_sql('essay_set'))} AS INTEGER) AS k,
       CAST(count(*) AS BIGINT) AS n_test, {r6_sql('avg(CASE WHEN tl = ql THEN 1.0 ELSE 0.0 END)')} AS accuracy
FROM p WHERE rk = 1 GROUP BY essay_set
"""


def _checkpointed(df):
    """Narrow per-essay feature rows, written once: the KNN sizes its blocks
    by counting both sides and then runs its join, and none of these should
    recompute the text features."""
    return checkpointed(df)


def _k_for_set(c):
    out = None
    for s, k in sorted(FV.KNN_FINAL_K.items()):
        out = F.when(c == s, k) if out is None else out.when(c == s, k)
    return out.otherwise(KNN_K)


@register("knn_by_set", _KNN_SET_SQL)
def knn_by_set(spark, sf):
    """ML15 + ML5 + M1: per essay set, KNN on the ten features with the set's k."""
    dictionary = FT.dictionary_counts(table(spark, sf, "benchmark"), "text")
    tf = FT.ten_features(essay_texts(spark, sf).select("essay_id", "essay_set", "essay"), dictionary)
    tf = attach_scores(tf, spark, sf).filter(F.col("domain1_score").isNotNull())
    tf = tf.withColumn("avg_word_len", r6("avg_word_len"))
    base = _checkpointed(tf.select("essay_id", "essay_set", F.col("domain1_score").cast("int").alias("label"),
                                   F.array(*[F.col(c).cast("double") for c in FT.TEN_FEATURES]).alias("vec")))
    tr, te = S.train_test(base, "essay_id", TEST)
    nb = K.neighbours(te.select(F.col("essay_id").alias("qid"), "essay_set", "vec"), tr, max(FV.KNN_FINAL_K.values()),
                      qkey="qid", tkey="essay_id", vec="vec", label="label", group="essay_set")
    nb = nb.withColumn("k", _k_for_set(C.set_number("essay_set"))).filter(F.col("rank") <= F.col("k"))
    pred = K.vote(nb, "qid", "label", ["essay_set", "k"])  # the set and its k ride along as vote keys
    scored = pred.join(te.select(F.col("essay_id").alias("qid"), F.col("label").alias("truth")), "qid")
    return (scored.groupBy("essay_set", "k")
            .agg(F.count(F.lit(1)).alias("n_test"), r6(M.accuracy("truth", "pred"), "accuracy"))
            .select("essay_set", F.col("k").cast("int").alias("k"), "n_test", "accuracy"))


# ------------------------------------------------------------------ ML8 closed form + M2-M4
LI_KEY_SQL = "concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))"
LASSO_TEST, LASSO_SALT = 0.25, "0"
_LI_SQL = "SELECT l_quantity AS x, l_extendedprice / 1000.0 AS y, " + LI_KEY_SQL + " AS k FROM lineitem"
_ALPHAS = ", ".join(f"(CAST({a} AS DOUBLE))" for a in FV.LASSO_ALPHAS)
_COEF_SQL = f"""
li AS ({_LI_SQL}),
trn AS (SELECT * FROM li WHERE NOT ({S.in_test_sql('k', LASSO_TEST, LASSO_SALT)})),
mo AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS cxy, var_pop(x) AS vx FROM trn),
cf AS (SELECT a.alpha, sign(cxy) * greatest(abs(cxy) - a.alpha, 0.0) / vx AS coef, mx, my
       FROM mo, (VALUES {_ALPHAS}) a(alpha)),
cf2 AS (SELECT alpha, coef, my - coef * mx AS intercept FROM cf)
"""


def _lineitem_xy(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000.0).alias("y"),
                     F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                 F.col("l_linenumber").cast("string")).alias("k"))


@register("lasso_one_feature", f"WITH {_COEF_SQL} SELECT alpha, {r6_sql('coef')} AS coef, "
                               f"{r6_sql('intercept')} AS intercept FROM cf2")
def lasso_one_feature(spark, sf):
    """ML8 (one feature, closed form): price in thousands on quantity, per alpha."""
    tr, _ = S.train_test(_lineitem_xy(spark, sf), "k", LASSO_TEST, LASSO_SALT)
    c = LN.lasso_1d(tr, "x", "y", FV.LASSO_ALPHAS)
    return c.select("alpha", r6("coef", "coef"), r6("intercept", "intercept"))


_REG_SQL = f"""
WITH {_COEF_SQL},
tst AS (SELECT * FROM li WHERE {S.in_test_sql('k', LASSO_TEST, LASSO_SALT)}),
pr AS (SELECT cf2.alpha, tst.y, cf2.coef * tst.x + cf2.intercept AS yhat FROM tst, cf2)
SELECT alpha, CAST(count(*) AS BIGINT) AS n, {r6_sql('avg((y - yhat) * (y - yhat))')} AS mse,
       {r6_sql('avg(abs(y - yhat))')} AS mae,
       {r6_sql('1.0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y))')} AS r2
FROM pr GROUP BY alpha
"""


@register("regression_metrics", _REG_SQL)
def regression_metrics(spark, sf):
    """M2 + M3 + M4 + J5: test MSE, MAE and R^2 of each alpha's fit."""
    tr, te = S.train_test(_lineitem_xy(spark, sf), "k", LASSO_TEST, LASSO_SALT)
    coefs = LN.lasso_1d(tr, "x", "y", FV.LASSO_ALPHAS)
    pred = LN.predict_1d(te, coefs, "x", "y")
    s = M.regression_summary(pred, "y", "yhat", ["alpha"])
    return s.select("alpha", "n", r6("mse", "mse"), r6("mae", "mae"), r6("r2", "r2"))


# ------------------------------------------------------------------ ML6 + ML15: grid per set
_GRID_SET_SQL = f"""
WITH tf AS ({_TEN_SQL}),
base AS ({_SET_BASE}),
tr AS (SELECT *, CAST((row_number() OVER (PARTITION BY concat_ws('|', essay_set, CAST(label AS VARCHAR))
                                          ORDER BY md5(CAST(id AS VARCHAR)), id) - 1) % {FV.N_FOLDS} AS INTEGER) AS fold
       FROM base WHERE NOT ({S.in_test_sql('id', TEST)})),
d AS (SELECT q.id AS qid, q.label AS ql, q.fold AS qf, q.essay_set, t.id AS tid, t.label AS tl,
             {_dist_sql('q.vec', 't.vec')} AS dist
      FROM tr q JOIN tr t ON q.essay_set = t.essay_set AND q.fold <> t.fold),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM d),
g AS (SELECT r.*, ks.k FROM r JOIN (VALUES {_GRID_VALUES}) ks(k) ON r.rn <= ks.k),
v AS (SELECT qid, ql, qf, essay_set, k, tl, count(*) AS c FROM g GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY c DESC, tl) AS rk FROM v),
acc AS (SELECT essay_set, k, qf, avg(CASE WHEN tl = ql THEN 1.0 ELSE 0.0 END) AS a FROM p WHERE rk = 1
        GROUP BY essay_set, k, qf),
m AS (SELECT essay_set, k, avg(a) AS mean_accuracy FROM acc GROUP BY essay_set, k)
SELECT essay_set, k, {r6_sql('mean_accuracy')} AS mean_accuracy,
       row_number() OVER (PARTITION BY essay_set ORDER BY round(mean_accuracy, 12) DESC, k) = 1 AS is_best FROM m
"""


@register("knn_grid_by_set", _GRID_SET_SQL)
def knn_grid_by_set(spark, sf):
    """ML6 + ML7 + ML15 + O7: per essay set, 5-fold grid search over k on the
    ten features, folds stratified by score inside each set, one ranking pass."""
    dictionary = FT.dictionary_counts(table(spark, sf, "benchmark"), "text")
    tf = FT.ten_features(essay_texts(spark, sf).select("essay_id", "essay_set", "essay"), dictionary)
    tf = attach_scores(tf, spark, sf).filter(F.col("domain1_score").isNotNull())
    tf = tf.withColumn("avg_word_len", r6("avg_word_len"))
    base = _checkpointed(tf.select("essay_id", "essay_set", F.col("domain1_score").cast("int").alias("label"),
                                   F.array(*[F.col(c).cast("double") for c in FT.TEN_FEATURES]).alias("vec")))
    tr = S.train_test(base, "essay_id", TEST)[0]
    strat = tr.withColumn("__cls", F.concat_ws("|", F.col("essay_set"), F.col("label").cast("string")))
    folded = S.stratified_folds(strat, "essay_id", "__cls", FV.N_FOLDS)
    g = K.grid_search(folded, FV.KNN_K_GRID, key="essay_id", vec="vec", label="label", fold="fold",
                      group="essay_set")
    return g.select("essay_set", F.col("k").cast("int").alias("k"), r6("mean_accuracy", "mean_accuracy"),
                    "is_best")

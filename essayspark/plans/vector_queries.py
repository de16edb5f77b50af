"""Driver queries for word vectors, the vector regressor and the Lasso grid
(J2, A12, P8, ML3, ML8, ML13, ML14)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from essayspark.functions import fixed_values as FV
from essayspark.functions import text as T
from essayspark.operators import clean as C
from essayspark.operators import embed as EM
from essayspark.operators import linear as LN
from essayspark.operators import metrics as M
from essayspark.operators import split as S
from essayspark.operators import vocab as V
from essayspark.plans.registry import r6, r6_sql, register
from essayspark.plans.model_queries import _lineitem_xy
from essayspark.session import checkpointed
from essayspark.sources.tables import ESSAYS_SQL, attach_scores, essay_texts, table

STOPS = V.english_stops()


def essay_words(spark, sf):
    """(essay_id, essay_set, words): T10 without stop words."""
    return essay_texts(spark, sf).select("essay_id", "essay_set",
                                         T.remove_words(T.clean_words("essay"), STOPS).alias("words"))


def essay_vectors(spark, sf):
    ew = essay_words(spark, sf)
    vecs = EM.word_vectors(ew.select(F.explode("words").alias("word")), "word",
                           table(spark, sf, "embeddings"), "vec_id", "embedding")
    return ew, EM.finite_rows(EM.mean_vectors(ew, "essay_id", F.col("words"), vecs))


_MWV_SQL = f"""
WITH w AS (SELECT essay_id, unnest({T.remove_words_sql(T.clean_words_sql('essay'), STOPS)}) AS word
           FROM {ESSAYS_SQL} e),
voc AS (SELECT word, rn - 1 AS vec_id FROM
          (SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS rn
           FROM (SELECT word, count(*) AS cnt FROM w GROUP BY word))
        WHERE rn <= (SELECT count(*) FROM embeddings)),
vecs AS (SELECT voc.word, CAST(em.embedding AS DOUBLE[]) AS vec FROM voc JOIN embeddings em ON em.vec_id = voc.vec_id),
m AS (SELECT w.essay_id, unnest(v.vec) AS val, generate_subscripts(v.vec, 1) AS dim
      FROM w JOIN vecs v ON w.word = v.word)
SELECT essay_id, CAST(dim - 1 AS INTEGER) AS dim, {r6_sql('avg(val)')} AS value FROM m GROUP BY essay_id, dim
"""


@register("mean_word_vector", _MWV_SQL)
def mean_word_vector(spark, sf):
    """J2 + A12 + P8: mean vector of each essay's known words, long form."""
    _, mv = essay_vectors(spark, sf)
    return (mv.select("essay_id", F.posexplode(vector_to_array(F.col("mean"))).alias("dim", "value"))
            .select("essay_id", F.col("dim").cast("int").alias("dim"), r6("value", "value")))


VALID_SALT = "v"


@register("vector_regression")
def vector_regression(spark, sf):
    """ML13 + ML14: regressor on mean word vectors of scored essays, 80/20
    split, prediction clipped at 0, x100 and rounded, quadratic kappa."""
    ew, mv = essay_vectors(spark, sf)
    scored = C.normalise_score(attach_scores(ew.select("essay_id", "essay_set"), spark, sf), spark) \
        .filter(F.col("score_norm").isNotNull())
    data = mv.join(scored.select("essay_id", F.col("score_norm").alias("label")), "essay_id") \
             .withColumnRenamed("mean", "features")
    data = checkpointed(data)  # one narrow row per essay, read by the fit, the predictions and the counts
    tr, te = S.train_test(data, "essay_id", FV.VALIDATION_FRACTION, VALID_SALT)
    model = LN.vector_regressor("label", "features").fit(tr)
    pred = model.transform(te).select("essay_id", "label",
                                      F.greatest(F.col("prediction"), F.lit(0.0)).alias("yhat"))
    pairs = pred.select("essay_id", C.grade("label").alias("y_grade"), C.grade("yhat").alias("yhat_grade"),
                        F.col("label").alias("y"), "yhat")
    kappa = M.quadratic_kappa(pairs, "y_grade", "yhat_grade").select("kappa")
    summ = pairs.agg(F.count(F.lit(1)).alias("n_test"), M.mse("y", "yhat").alias("mse"),
                     M.mae("y", "yhat").alias("mae"))
    n_train = tr.count()
    kv = kappa.collect()[0]["kappa"]  # one number
    return summ.select(F.lit(n_train).cast("bigint").alias("n_train"), "n_test", r6("mse", "mse"),
                      r6("mae", "mae"), r6(F.lit(kv).cast("double"), "kappa"))


@register("lasso_grid")
def lasso_grid(spark, sf):
    """ML8 + ML3 + ML7: L1 regression of price (thousands) on quantity,
    discount and tax; 5-fold CV over the alpha grid, best by mean R^2."""
    li = table(spark, sf, "lineitem")
    df = li.select(F.concat_ws("-", F.col("l_orderkey").cast("string"),
                               F.col("l_linenumber").cast("string")).alias("k"),
                   "l_quantity", "l_discount", "l_tax",
                   (F.col("l_extendedprice") / 1000.0).alias("y"))
    tr, _ = S.train_test(df, "k", 0.25, "0")
    tr = S.plain_folds(tr, "k", FV.N_FOLDS)
    _, scores = LN.lasso_grid(tr, ["l_quantity", "l_discount", "l_tax"], "y", FV.LASSO_ALPHAS, "fold")
    best = max(scores, key=lambda s: (s[1], -FV.LASSO_ALPHAS.index(s[0])))[0]
    rows = [(float(a), float(r2), a == best) for a, r2 in scores]
    return spark.createDataFrame(rows, "alpha double, mean_r2 double, is_best boolean") \
        .select("alpha", r6("mean_r2", "mean_r2"), "is_best")


__all__ = ["_lineitem_xy"]

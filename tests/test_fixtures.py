"""Hand-computed micro fixtures (FIXTURES.md part C)."""

import math

import pytest
from pyspark.sql import functions as F

from essayspark.functions import text as T
from essayspark.operators import clean as C
from essayspark.operators import embed as EM
from essayspark.operators import features as FT
from essayspark.operators import knn as K
from essayspark.operators import linear as LN
from essayspark.operators import metrics as M
from essayspark.operators import profile as PR


def one(spark, text, col):
    return spark.createDataFrame([(text,)], "t string").select(col.alias("v")).first()["v"]


def test_word_count_and_mean_length(spark):
    assert one(spark, "can't stop_it, now", T.word_count("t")) == 4
    assert one(spark, "can't stop_it, now", T.avg_word_len("t")) == pytest.approx(3.5)
    assert one(spark, "", T.avg_word_len("t")) is None


def test_char_count(spark):
    assert one(spark, " A b\n", T.char_count("t")) == 2


def test_white_space_words(spark):
    assert one(spark, "", T.ws_word_count("t")) == 0
    assert one(spark, " a b\nc ", T.ws_word_count("t")) == 3


def test_sentences(spark):
    assert one(spark, "Hi there. How are you?  Fine", T.sent_count("t")) == 3
    assert one(spark, "  ", T.sent_count("t")) == 0
    assert one(spark, 'He said "go." Then left!', T.sent_count("t")) == 2


def test_spelling_errors(spark):
    docs = spark.createDataFrame([(1, "Can't stop_it, now9")], "essay_id long, essay string")
    dictionary = spark.createDataFrame([("can",), ("t",), ("now",)], "word string")
    r = FT.spelling_errors(docs, dictionary).first()
    assert r["spell_err_count"] == 1


def test_normalise_score(spark):
    df = spark.createDataFrame([(1, "1", 7.0), (2, "2", 6.0), (3, "5", 0.0), (4, "9", 4.0), (5, "3", None)],
                               "essay_id int, essay_set string, domain1_score double")
    out = {r["essay_id"]: r["score_norm"] for r in C.normalise_score(df, spark).collect()}
    assert out == {1: 0.5, 2: 1.0, 3: -0.5, 4: 0.0, 5: None}


def test_grade_round_half_even(spark):
    df = spark.createDataFrame([(0.025,), (0.005,), (0.5,), (-0.2,)], "y double")
    assert [r["g"] for r in df.select(C.grade("y").alias("g")).collect()] == [2.0, 0.0, 50.0, 0.0]


def test_quadratic_kappa(spark):
    a = spark.createDataFrame(list(zip([0, 1, 2, 2], [0, 2, 2, 1])), "y int, yhat int")
    b = spark.createDataFrame(list(zip([0, 10, 90, 90], [0, 90, 90, 10])), "y int, yhat int")
    for df in (a, b):
        assert M.quadratic_kappa(df).first()["kappa"] == pytest.approx(0.636364, abs=1e-6)


def test_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "y double, yhat double")
    assert M.regression_summary(df).first()["r2"] == pytest.approx(0.5)


def test_vote_tie_smallest_label(spark):
    nb = spark.createDataFrame([(1, 2), (1, 1), (1, 1), (1, 2)], "q int, label int")
    assert K.vote(nb, "q", "label").first()["pred"] == 1


def test_lasso_one_feature(spark):
    x = [1, 2, 3, 4, 5, 7]
    y = [2, 3.5, 7, 8.5, 10, 15.5]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = {r["alpha"]: r["coef"] for r in LN.lasso_1d(df, "x", "y", [3.0, 1.0, 0.1]).collect()}
    assert got[3.0] == pytest.approx(1.457143, abs=1e-6)
    assert got[1.0] == pytest.approx(1.971429, abs=1e-6)
    assert got[0.1] == pytest.approx(2.202857, abs=1e-6)


def test_box_plot(spark):
    df = spark.createDataFrame([("s", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    b = PR.box_stats(df, "g", "v").first()
    assert (b["q1"], b["median"], b["q3"]) == (2.0, 3.0, 4.0)
    assert (b["whisker_lo"], b["whisker_hi"], b["n_outliers"]) == (1.0, 4.0, 1)
    assert [r["v"] for r in PR.box_outliers(df.withColumn("k", F.lit(1)), "g", "v", "k").collect()] == [100.0]


def test_dedupe_keep_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 3, "c")], "id int, o int, v string")
    out = sorted((r["id"], r["v"]) for r in C.dedupe_keep_first(df, "id", "o").collect())
    assert out == [(1, "a"), (2, "c")]


def test_mean_vector(spark):
    docs = spark.createDataFrame([(1, ["x", "y", "zz"]), (2, ["zz"])], "id int, words array<string>")
    vecs = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [3.0, 4.0])], "word string, vec array<double>")
    rows = EM.mean_vectors(docs, "id", F.col("words"), vecs).collect()
    assert len(rows) == 1 and rows[0]["id"] == 1
    assert list(rows[0]["mean"]) == [2.0, 3.0]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (["a", "b", "c"],)], "t array<string>")
    got = [r["g"] for r in df.select(T.ngrams_upto(F.col("t"), 3).alias("g")).collect()]
    assert got == [["a", "b", "a b"], [], ["a", "b", "c", "a b", "b c", "a b c"]]


def test_readability_rules(spark):
    r = spark.createDataFrame([("The cat sat. It ran away!",)], "t string").select(
        *[c.alias(k) for k, c in T.readability("t").items()]).first()
    assert r["n_sentences"] == 2 and r["n_words"] == 6
    assert r["n_syllables"] == 7  # the cat sat it ran a-way
    assert r["flesch"] == pytest.approx(206.835 - 1.015 * 3 - 84.6 * 7 / 6)
    assert not math.isnan(r["ari"])


def test_bytes_to_text(spark):
    df = spark.createDataFrame([(bytearray("héllo".encode("utf-8")),), (bytearray(b"\xff\xfe"),)], "b binary")
    assert [r["t"] for r in df.select(C.bytes_to_text("b").alias("t")).collect()] == ["héllo", None]


def test_heat_map_pivot(spark):
    from essayspark.operators import topics as TP

    med = spark.createDataFrame([("s1", 0, 0.7), ("s1", 1, 0.3), ("s2", 0, 0.2), ("s2", 1, 0.8)],
                                "g string, topic int, median_p double")
    rows = {r["g"]: (r["0"], r["1"]) for r in TP.heat_map(med, "g", 2).collect()}
    assert rows == {"s1": (0.7, 0.3), "s2": (0.2, 0.8)}


def test_lone_i_and_marker_characters(spark):
    from essayspark.functions import text as T
    from essayspark.operators import grammar as G

    df = spark.createDataFrame([("i i i am the the cat . hello",), ("a b\u0001c d.",), ("I see.",)], "essay string")
    rows = G.check(df).withColumn("n_sent", T.sent_count("essay")).collect()
    assert [r["n_lone_i"] for r in rows] == [3, 0, 0]
    assert rows[0]["corrected"].startswith("I I I am")
    assert rows[1]["n_sent"] == 1


def test_drop_sparse_and_topic_names(spark):
    from essayspark.functions import fixed_values as FV
    from essayspark.operators import clean as C
    from essayspark.operators import profile as P

    df = spark.createDataFrame([(1, None, "set1"), (2, None, "set2"), (3, "x", "set9")], "a int, b string, essay_set string")
    assert P.drop_sparse(df, 0.5).columns == ["a", "essay_set"]
    for names in (FV.TOPIC_NAMES_5, FV.TOPIC_NAMES_2):
        got = {r["a"]: r["topic"] for r in C.name_topics(df, spark, names=names).collect()}
        assert got[1] == "effect of computers" and got[3] == "set9"


def test_rows_with_missing_components_keep_their_prediction(spark):
    from essayspark.operators import knn as K

    rows = [(i, [float(i), None if i % 3 == 0 else 1.0], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    got = K.predict(df.selectExpr("id AS q", "vec"), df, 3, qkey="q", tkey="id", vec="vec", label="label")
    assert got.count() == 30


def test_word_vectors_are_sent_once_per_block(spark):
    """no shuffle by (text, word) carries vectors; repeated and null keys, words and vectors count as before."""
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (1, ["c"]), (None, ["b"]), (2, ["z"]), (3, []), (4, None)], "id int, words array<string>")
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [4.0, 4.0]), ("c", [0.0, 0.0])], "word string, vec array<double>")
    out = EM.mean_vectors(docs, "id", F.col("words"), vecs)
    got = {r["id"]: (r["n_known"], [round(x, 9) for x in r["mean"]]) for r in out.collect()}
    assert got == {1: (5, [1.2, 1.2]), None: (1, [0.0, 2.0])}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan

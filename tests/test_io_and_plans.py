"""Sources and sinks (S1-S8), streaming, and plan shape checks."""

import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import SF001
from essayspark.sources import files as IO
from essayspark.streaming import features as ST


def test_latin1_multiline_csv_round_trip(spark, scratch):
    path = os.path.join(scratch, "essays.csv")
    with open(path, "wb") as f:
        f.write("essay_id,essay_set,essay,domain1_score\n".encode("latin-1"))
        f.write('1,1,"Café line one\nline two, with ""quotes""",8\n'.encode("latin-1"))
        f.write('2,2,"short",\n'.encode("latin-1"))
    df = IO.read_delimited(spark, path)
    rows = sorted(df.collect(), key=lambda r: r["essay_id"])
    assert rows[0]["essay"] == 'Café line one\nline two, with "quotes"'
    assert rows[0]["domain1_score"] == 8.0 and rows[1]["domain1_score"] is None
    out = os.path.join(scratch, "landed")
    IO.land_as_parquet(df, out)
    back = spark.read.parquet(out)
    assert back.filter(F.col("essay_set") == 1).count() == 1


def test_tsv(spark, scratch):
    path = os.path.join(scratch, "essays.tsv")
    with open(path, "w", encoding="latin-1") as f:
        f.write("essay_id\tessay_set\tessay\tdomain1_score\n1\t3\thello there\t2\n")
    assert IO.read_delimited(spark, path, sep="\t").first()["essay"] == "hello there"


def test_columns_come_by_header_name(spark, scratch):
    path = os.path.join(scratch, "full.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write("essay_id,essay_set,essay,rater1_domain1,rater2_domain1,rater3_domain1,domain1_score\n1,2,text,4,5,,9\n2,2,more,4,5,,n/a\n")
    rows = IO.read_delimited(spark, path).orderBy("essay_id").collect()
    assert [r["domain1_score"] for r in rows] == [9.0, None] and rows[0]["essay"] == "text"
    with open(path, "w", encoding="latin-1") as f:
        f.write("essay_id,essay_set,essay\n1,2,text\n")
    with pytest.raises(ValueError, match="domain1_score"):
        IO.read_delimited(spark, path)


def test_word_vectors_and_corpus(spark, scratch):
    p = os.path.join(scratch, "vec.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("the 0.1 0.2 0.3\nbad 1 2\ncat 1 2 3\ndog 1 x 3\n")
    v = {r["word"]: list(r["vec"]) for r in IO.read_word_vectors(spark, p, 3)[0].collect()}
    assert [r["line"] for r in IO.read_word_vectors(spark, p, 3)[1].collect()] == ["bad 1 2", "dog 1 x 3"]
    assert set(v) == {"the", "cat"} and v["cat"] == [1.0, 2.0, 3.0]
    c = os.path.join(scratch, "corpus.txt")
    with open(c, "w") as f:
        f.write("The cat, the DOG.\n42 cats")
    d = {r["word"]: r["n"] for r in IO.read_corpus_dictionary(spark, c).collect()}
    assert d == {"the": 2, "cat": 1, "dog": 1, "cats": 1}


def test_sinks_and_model_save_load(spark, scratch):
    df = spark.createDataFrame([(1, 0.5, "a b"), (2, 0.25, 'say "hi"')], "id long, score double, essay string")
    out = os.path.join(scratch, "ids")
    IO.write_id_score_text(df, out)
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    assert sorted(r["essay"] for r in back.collect()) == ["a b", 'say "hi"']
    data = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"),
                            LinearRegression(featuresCol="f", labelCol="y")])
    m = pipe.fit(data)
    p = os.path.join(scratch, "model")
    IO.save_model(m, p)
    a = [r["prediction"] for r in m.transform(data).collect()]
    b = [r["prediction"] for r in IO.load_model(p).transform(data).collect()]
    assert a == b
    IO.write_table(m.transform(data).select("y", F.col("prediction").alias("yhat")),
                   os.path.join(scratch, "pairs"), "csv")


def test_streaming_features(spark, scratch):
    src = os.path.join(scratch, "in")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        F.col("doc_id").alias("essay_id"), F.col("source").alias("essay_set"), F.col("text").alias("essay"))
    docs.write.parquet(src)
    stream = ST.essay_stream(spark, src, "essay_id long, essay_set string, essay string")
    q = (ST.streaming_set_means(stream).writeStream.outputMode("complete").format("memory")
         .queryName("set_means_test").option("checkpointLocation", os.path.join(scratch, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT sum(n_essays) AS n FROM set_means_test").first()["n"]
    assert got == docs.count()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_features_stay_in_jvm_and_prune_columns(spark):
    import __spark_entry__ as entry

    df = entry.queries()["text_basic_features"](spark, SF001)
    plan = _plan(df)
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "documents" in ln][0]
    assert "n_chars" not in scan and "lang" not in scan.split("ReadSchema")[1]


def test_spelling_dictionary_is_broadcast(spark):
    import __spark_entry__ as entry

    df = entry.queries()["spelling_errors"](spark, SF001)
    df.collect()
    assert "BroadcastHashJoin" in _plan(df) or "BroadcastHashJoin" in df._jdf.queryExecution().toString()


def test_knn_final_ranking_uses_group_limit(spark):
    import __spark_entry__ as entry

    df = entry.queries()["knn_predict"](spark, SF001)
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString() or \
        "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def _no_exchange_on(plan, *columns):
    return not any("hashpartitioning(" in ln and all(c in ln for c in columns) for ln in plan.split("\n"))


def test_vocabulary_never_shuffles_documents_and_terms(spark):
    """The statistics of all terms are shuffled by term only."""
    import __spark_entry__ as entry

    df = entry.queries()["vocabulary_bounded"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert _no_exchange_on(plan, "essay_id", "term")


def test_count_vectors_drop_other_terms_before_the_shuffle(spark):
    """The only exchange by (document, term) lies above the join with the vocabulary."""
    import __spark_entry__ as entry

    df = entry.queries()["ngram_counts"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") > plan.index("hashpartitioning(essay_id")


def test_no_operator_changes_the_session(spark):
    import __spark_entry__ as entry

    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    entry.queries()["ngram_counts_by_set"](spark, SF001)
    assert before == {r["key"]: r["value"] for r in spark.sql("SET").collect()}

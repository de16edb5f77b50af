"""Corrections as edits, and lemmas that the dictionary attests."""

from pyspark.sql import functions as F

from essayspark.operators import edits as ED
from essayspark.operators import lemmas as LM

CASES = [
    ("the the cat", "The cat", ["double_word", "sentence_start"]),
    ("The the THE cat", "The cat", ["double_word"] * 2),
    ("He had had that that", "He had had that that", []),
    ("a  b , c !", "A b, c!", ["double_space", "sentence_start", "space_before_punct", "space_before_punct"]),
    ("So i i  say: i'm i", "So I say: i'm I", ["double_space", "double_word", "lone_i", "lone_i"]),
    ("End. next?  ok! Ünd. über 1.5 x", "End. Next? Ok! Ünd. über 1.5 x", ["double_space", "sentence_start", "sentence_start"]),
    ("a.b. .c", "A.b..c", ["sentence_start", "space_before_punct"]),
    ("no\n no 😀 i  ", "No\n no 😀 I ", ["double_space", "lone_i", "sentence_start"]),
    ("", "", []),
    (None, None, []),
]


def test_edits_by_hand_and_applied_from_the_end(spark):
    rows = [(i, t, "x") for i, (t, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "essay_id long, essay string, pieces string").repartition(3)
    fixed = {r.essay_id: r for r in ED.corrected(df).collect()}
    found = ED.edits(df).collect()
    for i, (text, want, rules) in enumerate(CASES):
        mine = sorted((r for r in found if r.essay_id == i), key=lambda r: -r.offset)
        assert sorted(r.rule for r in mine) == rules, text
        assert (fixed[i].corrected, fixed[i].n_edits) == (want, len(rules))
        assert all(a.offset >= b.offset + b.length for a, b in zip(mine, mine[1:]))  # no overlaps
        for r in mine:
            text = text[:r.offset] + r.replacement + text[r.offset + r.length:]
        assert text == want
    assert ED.corrected(df.limit(0)).collect() == ED.edits(df.limit(0)).collect() == []


def test_corrected_again_changes_nothing_in_long_texts(spark):
    long = spark.createDataFrame([(1, "so  i i went ,went . and and so " * 20_000)], "essay_id long, essay string")
    once = ED.corrected(long)
    assert once.first().corrected == "So " + "I went,went. And so " * 20_000
    assert ED.corrected(once.select("essay_id", F.col("corrected").alias("essay"))).first().n_edits == 0


def test_lemmas_are_attested(spark):
    known = {"hope": 5, "hop": 5, "run": 3, "fly": 2, "wolf": 1, "box": 4, "plan": 1, "plane": 1, "bus": 1, "go": 9}
    dictionary = spark.createDataFrame(list(known.items()), "word string, n long")
    texts = [(1, "Hoping running flies wolves boxes planned went the"), (2, "buses hops runs Hops zorping axes gs"), (3, ""), (4, None)]
    docs = spark.createDataFrame(texts, "essay_id long, essay string").repartition(2)
    table = LM.lemma_table(docs, dictionary)
    got = {r.word: r.lemma for r in table.collect()}
    assert got == {"hoping": "hope", "running": "run", "flies": "fly", "wolves": "wolf", "boxes": "box", "planned": "plan", "went": "go", "the": "the",
                   "buses": "bus", "hops": "hop", "runs": "run", "zorping": "zorping", "axes": "axes", "gs": "gs"}
    counts = {r.essay_id: r.lemma_count for r in LM.lemma_counts(docs, table).collect()}
    assert counts == {1: 8, 2: 6, 3: 0, 4: 0}
    lines = {r.essay_id: r.lemmatised for r in LM.lemmatised(docs, table).collect()}
    assert lines == {1: "hope run fly wolf box plan go the", 2: "bus hop run hop zorping axes gs", 3: "", 4: ""}


def test_no_lemma_is_made_up(spark):
    words = ["walking", "walked", "tables", "bigger", "nicest", "dies", "asses", "s", "ing", "ed"]
    known = {"walk", "tabl", "nice", "die", "dy", "ass"}
    docs = spark.createDataFrame([(1, " ".join(words))], "essay_id long, essay string")
    dictionary = spark.createDataFrame([(w, 1) for w in known], "word string, n long")
    for r in LM.lemma_table(docs, dictionary).collect():
        assert r.lemma in known or r.lemma == r.word


def test_running_sums_take_no_object_per_text():
    """the running sums of a batch are made of its flat values."""
    import pyarrow as pa

    kind = pa.list_(pa.int32())
    rows = [[2, 1], None, [], [3, 1, 4], None]
    got = ED._starts.func(pa.array(rows, kind))
    assert got.to_pylist() == [[0, 2], None, [], [0, 3, 4], None]
    assert ED._starts.func(pa.array(rows, kind).slice(1, 3)).to_pylist() == [None, [], [0, 3, 4]]
    assert ED._starts.func(pa.array([None, []], kind)).to_pylist() == [None, []]
    assert ED._starts.func(pa.array([], kind)).to_pylist() == []


def test_a_word_is_not_tried_against_the_rules_for_blanks(spark):
    """whether a piece is blank is asked once, not once for each rule."""
    df = spark.createDataFrame([(1, "a  a")], "essay_id long, essay string")
    plan = ED.corrected(df)._jdf.queryExecution().analyzed().toString()
    assert plan.count(".w,  )") <= 1, plan.count(".w,  )")


def test_lemmas_meet_blocks_of_texts_not_tokens(spark, monkeypatch):
    """a text moves once and whole, its tokens are no rows; keys that repeat or are null keep their results."""
    monkeypatch.setattr(LM, "BLOCK_BYTES", 40)
    texts = [(1, "Hoping runs, hops\u0130 \u212a9"), (2, "runs Runs x"), (2, "hops runs"), (None, "runs"), (None, None), (5, ""), (6, None)]
    texts += [(k, "runs the hops") for k in range(10, 30)]
    docs = spark.createDataFrame(texts, "essay_id long, essay string").repartition(3)
    dictionary = spark.createDataFrame([("hope", 5), ("hop", 5), ("run", 3)], "word string, n long")
    table = spark.createDataFrame(LM.lemma_table(docs, dictionary).filter("word != 'x'").collect())
    lines, counts = LM.lemmatised(docs, table), LM.lemma_counts(docs, table)
    for df in (lines, counts):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "Generate" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1
    many = [(k, "run the hop") for k in range(10, 30)]
    want = [(1, "hope run hop 9"), (2, "hop run run run"), (2, "hop run run run"), (None, ""), (None, ""), (5, ""), (6, ""), *many]
    assert sorted(map(tuple, lines.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, counts.collect()), key=str) == sorted([(k, len(set(s.split()))) for k, s in want], key=str)
    blank = docs.filter("essay = ''")
    assert [tuple(r) for r in LM.lemmatised(blank, table).collect()] == [(5, "")]
    assert LM.lemmatised(docs.limit(0), table).collect() == LM.lemma_counts(docs.limit(0), table).collect() == []

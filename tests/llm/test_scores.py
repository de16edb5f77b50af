"""Operators 4, 6, 7 and 8: exact parts against brute force, learnt parts on held-out rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import awkward
from pyspark.sql import functions as F

from essayspark.llm import lm, quality_model, quality_rules, toxicity
from essayspark.llm.common import remainder, table
from essayspark.llm.toxicity import BEGINNINGS, uncovered

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


def held(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


# ---------------------------------------------------------------- 4
@pytest.mark.parametrize("head", [400_000, 5])
def test_language_model(frame, head):
    texts = awkward(8)
    docs = frame(texts)
    got = lm.language_model_scores(docs, remainder("doc_id", 7) != 2, own=4, endings=3, head=head).collect()
    words = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter(w for i, t in texts if held(i, 7) != 2 for w in words(t))
    n, v = counts.total(), len(counts)
    want = sorted((str(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in texts)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_probabilities_sum_to_one():
    unigram = np.array([5.0, 3, 1, 1]) / 10
    model = lm.LogBilinear(unigram, 3)
    cells, n = np.array([0, 5, 17, 63, 33]), np.array([4.0, 3, 2, 1, 9])
    model.train(cells, n, 50, 64, 4, 0.1, 1)
    assert np.allclose((10 ** model.log10_probabilities()).sum(1), 1)


def test_model_beats_the_base_on_held_out_documents(spark):
    docs = table(spark, SF01, "documents")
    out = lm.language_model_scores(docs, remainder("doc_id", 7) != 2).filter(remainder("doc_id", 7) == 2)
    r = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_most_frequent_takes_no_more_than_asked(spark):
    rows = [(f"t{i}".encode(), c) for i, c in enumerate([5000, 4000, 7, 7, 3, 1, 1, 1])]
    counts = spark.createDataFrame(rows, "token binary, c long")
    assert lm.most_frequent(counts, 3)[1].tolist() == [5000, 4000]
    assert lm.most_frequent(counts, 5)[0] == [b"t0", b"t1", b"t2", b"t3", b"t4"]
    assert len(lm.most_frequent(counts, 100)[0]) == 8 and lm.most_frequent(counts.limit(0), 3)[0] == []


# ---------------------------------------------------------------- 6
def slow_base(text):
    raw = (text or "").encode()
    words = raw.split()
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in raw.split(b"\n") if x.split()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(inside))


def test_quality_rules(frame):
    texts = awkward(9) + [(500, "a b\na b\n\n \na b ### <>&"), (501, "word " * 12), (502, "é " * 9)]
    docs = frame(texts)
    refs = quality_rules.language_references(docs, common=5)
    got = quality_rules.quality_rules(docs, refs).collect()
    want = []
    for i, t in texts:
        base = slow_base(t)
        want.append((str(i), *base, base[0] < 10 or 100 * base[4] > 20 * base[0]))
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(want)
    assert all(not (r.base_failed and r.kept) and 0 <= r.class_distance <= 1 and 0 <= r.word_distance <= 1 for r in got)


def test_references_count_everything(frame):
    texts = [(1, "a a b\nC1"), (3, "A ccc"), (5, None), (2, "other language has null lang")]
    refs = quality_rules.language_references(frame(texts), common=1)
    assert list(refs) == ["en"] and refs["en"]["words"] == {b"a": 3} and refs["en"]["rest"] == 3
    assert sum(refs["en"]["classes"]) == len("a a b\nC1") + len("A ccc")


def test_every_language_has_its_reference(spark):
    def text(k):
        return " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{j % 12}x" if j % 3 else f"r{k}n{j}" for j in range(90))

    small, large = [f"l{k}" for k in range(230)], text(300)
    rows = [(k, text(k), lang) for k, lang in enumerate(small)] + [(1000 + i, large, "big") for i in range(3)] + [(2000, text(229), None), (2001, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = quality_rules.language_references(docs)
    assert set(refs) == {*small, "big"}
    by_id = {}
    for block in (2_000, 7):  # in one block, or a block after the other
        got = {r.doc_id: r for r in quality_rules.quality_rules(docs, quality_rules.reference_table(docs), block=block).collect()}
        assert len(got) == len(rows) and all(got[i].word_distance < 0.01 for i, t, _ in rows if t) and not got[2001].kept
        assert not by_id or by_id == got
        by_id = got
    same = {r.doc_id: r for r in quality_rules.quality_rules(docs, refs).collect()}
    assert {i: r.kept for i, r in same.items()} == {i: r.kept for i, r in by_id.items()}


def test_distance():
    p = np.array([1.0, 1, 0])
    assert quality_rules.distance(p, 5 * p) == pytest.approx(0) and quality_rules.distance(p, np.array([0, 0, 2.0])) == pytest.approx(1)
    assert quality_rules.distance(p, 0 * p) == 1


def test_clean_documents_are_kept_and_junk_is_not(spark):
    docs = table(spark, SF01, "documents")
    got = quality_rules.quality_rules(docs, quality_rules.language_references(docs)).join(table(spark, SF01, "labels"), "doc_id")
    share = {r.quality: r.k for r in got.filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert share[1] > 0.98 and share[0] < 0.2


# ---------------------------------------------------------------- 7 and 8
def rates(spark, scores, column, at):
    got = scores.filter(remainder("doc_id", 5) == 0).join(table(spark, SF1, "labels"), "doc_id")
    return {r[column]: r.p for r in got.groupBy(column).agg(F.avg((F.col("score") >= at).cast("double")).alias("p")).collect()}


def test_quality_on_held_out_rows(spark):
    scores = quality_model.quality_scores(table(spark, SF1, "documents"), table(spark, SF1, "labels"))
    share = rates(spark, scores, "quality", 0.3)
    assert share[1] > 0.95 and share[0] < 0.15


def test_toxicity_on_held_out_rows(spark):
    scores = toxicity.toxicity_scores(table(spark, SF1, "documents"), table(spark, SF1, "labels"))
    share = rates(spark, scores, "toxic", 0.5)
    assert share[1] > 0.85 and share[0] < 0.01


@pytest.mark.parametrize("operator,column", [(quality_model.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_awkward_rows_have_scores(frame, spark, operator, column):
    texts = awkward(10) + [(600 + i, "you stupid idiot " + "a b " * i) for i in range(20)]
    labels = spark.createDataFrame([(i, int(i >= 600)) for i, t in texts if i is not None and i != 0] + [(None, 1), (3, None)], f"doc_id long, {column} int")
    for given in (labels, labels.limit(0)):
        got = operator(frame(texts), given).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in texts)
        assert all(0 <= r.score <= 1 for r in got)
    assert operator(frame([]), labels).collect() == []


def test_isotonic():
    curve = quality_model.isotonic(np.array([0.0, 2, 1, 0, 5]), np.array([2.0, 4, 4, 0, 5]))
    assert (np.diff(curve) >= 0).all() and curve[1] == curve[2]


def test_harmless_rows_stay_with_all_columns(frame, spark):
    texts = [(i, f"plain words number {i} and some more of them") for i in range(40)] + [(100 + i, f"you idiot and moron {i}") for i in range(20)] + [(7, None)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in texts[:-1]], "doc_id long, toxic int")
    docs = frame(texts)
    kept = toxicity.keep_harmless(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(40), 7])

def test_covered_entries_go_before_the_bound(spark):
    """The same entries as going through them by certainty, one by one."""
    draw = random.Random(5)
    words = ["".join(draw.choice("ab") for _ in range(draw.randrange(3, 11))) for _ in range(150)]
    entries = sorted({w for w in words} | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k})
    sure = {e: float(draw.randrange(4)) for e in entries}
    kept = []
    for e in sorted(entries, key=lambda e: (-sure[e], e)):
        if not any(k.endswith("*") and e.startswith(k[:-1]) for k in kept):
            kept.append(e)
    got = uncovered(spark.createDataFrame(list(sure.items()), "entry string, sure double").repartition(3))
    assert sorted(r.entry for r in got.collect()) == sorted(kept)

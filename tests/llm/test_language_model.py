"""Operator 4's model: its counts against brute force, training on all of them, and the second level's tokens."""

from collections import Counter

import numpy as np
from llm_data import awkward
from pyspark.sql import functions as F

from essayspark.llm import lm


def test_sequence_counts_hold_every_sequence(frame):
    texts = awkward(11) + [(900, "the cat the dog THE cat")] * 3
    words = lambda t: (t or "").encode().lower().split() + [b""]
    names, known, own, endings = [b"the"], [b"the", b"cat", b""], 2, 3
    classes = lm.Classes(names, own, endings)
    total, n_known = own + endings, 3
    number = {b"the": 0, b"cat": 1, b"": 2}
    cells, pairs = Counter(), Counter()
    for _, t in texts:
        kinds = classes.of(words(t))
        c2 = c1 = classes.end
        for w, k in zip(words(t), kinds):
            cells[c2, c1, k] += 1
            if k >= len(names):
                pairs[number.get(w, n_known + k - own), c1] += 1
            c2, c1 = c1, k
    packed = (b" ".join(t for t in known if t), True, names, own, endings)
    for lanes, word_lanes in ((1, 1), (3, 2)):
        got = lm.sequence_counts(frame(texts).repartition(5), packed, lanes, word_lanes).collect()
        assert len({(r.level, r.lane) for r in got}) == len(got)
        one, two = {}, {}
        for r in got:
            for at, n in zip(np.frombuffer(r.at, np.int32).tolist(), np.frombuffer(r.n, np.int64).tolist()):
                row, k = at // total * (lanes if r.level == 1 else word_lanes) + r.lane, at % total
                if r.level == 1:
                    one[row // total, row % total, k] = n
                else:
                    two[row, k] = n
        assert one == dict(cells) and two == dict(pairs)


def test_a_step_goes_through_all_counts():
    unigram = np.full(4, 0.25)
    cells, n = np.arange(64), np.arange(1.0, 65.0)
    got = []
    for seed in (1, 2):
        model = lm.LogBilinear(unigram, 3)
        model.train(cells, n, 20, 64, 4, 0.1, seed)
        got.append(model.get())
    assert np.allclose(*got)
    again = lm.LogBilinear(unigram, 3)  # a sequence that occurs once among a million counts as well
    again.train(cells, np.where(cells == 17, n + 1e6, n), 20, 64, 4, 0.1, 1)
    other = lm.LogBilinear(unigram, 3)
    other.train(cells, np.where(cells == 17, n + 1e6, np.where(cells == 40, 0, n)), 20, 64, 4, 0.1, 1)
    assert not np.array_equal(again.get(), other.get())


def test_tokens_of_one_ending_are_told_apart_by_what_precedes_them(spark):
    rows = [(i, "x pans y bans " * 6 if i % 2 else "y bans x pans " * 6) for i in range(40)] + [(100, "x pans"), (101, "x bans"), (102, "x fans")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm.language_model_scores(docs, F.col("doc_id") < 100, own=3, endings=2).filter("doc_id >= 100").collect()}
    assert got[100].base_score == got[101].base_score and got[100].score > got[101].score + 0.5 > got[102].score + 0.5


def test_second_level_sums_to_one_in_every_class():
    rng = np.random.default_rng(3)
    kind = np.array([0, 2, 2, 3, 3, 3, 2, 3])
    q, b = rng.normal(size=(8, 4)).astype(np.float32), rng.normal(size=8).astype(np.float32)
    contexts = rng.normal(size=(5, 4)).astype(np.float32)
    logs = lm.class_logs(q, b, contexts, kind)
    p = np.exp(contexts @ q.T + b - logs[:, kind])
    for k in (0, 2, 3):
        assert np.allclose(p[:, kind == k].sum(1), 1, atol=1e-5)

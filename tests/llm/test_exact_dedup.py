"""Operator 12 against brute force."""

import random
from collections import defaultdict

import pytest
from llm_data import awkward
from pyspark.sql import functions as F

from essayspark.llm import exact_dedup
from essayspark.llm.exact_dedup import drop_duplicates, exact_duplicates


def expected(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            out.append((i, keep, len(ids), first and i == keep))
            first = first and i != keep
    return sorted(out, key=str)


def same_ends(n=40):
    """Texts with equal lengths and beginnings that differ at the end only, some of them copies."""
    rng = random.Random(2)
    return [(i, "x" * 300 + rng.choice("abc") + "é" * rng.randint(0, 1)) for i in range(n)]


@pytest.mark.parametrize("texts", [awkward(1), awkward(2) + awkward(2), same_ends(), [(7, "a")] * 9 + [(None, "a")] * 3, [(None, None), (None, "")]])
@pytest.mark.parametrize("bits", [6, exact_dedup.BITMAP_BITS])
def test_against_brute_force(frame, monkeypatch, texts, bits):
    monkeypatch.setattr(exact_dedup, "BITMAP_BITS", bits)  # a full bitmap lets more rows through, and gives the same result
    got = exact_duplicates(frame(texts), carry={"size": F.length("text")}).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == expected(texts)
    assert sorted((r.size for r in got), key=str) == sorted((None if t is None else len(t) for _, t in texts), key=str)


@pytest.mark.parametrize("texts", [awkward(1) + awkward(2), same_ends(), [(7, "a")] * 9 + [(None, "b")] * 3])
def test_rows_that_stay(frame, texts):
    docs = frame(texts)
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted(((i, t) for t in {t or "" for _, t in texts} for i in [max((j for j, u in texts if (u or "") == t and j is not None), default=None)]), key=str)
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == want


def test_only_candidates_are_hashed(frame):
    texts = [(i, "same beginning " * 30 + ("x" * i)) for i in range(50)] + [(90, "short"), (91, "short"), (92, "other")]
    rows = exact_dedup._hashed(frame(texts), 256, "n_", "h_").collect()
    assert {r.doc_id for r in rows if r.h_ is not None} == {90, 91}


def test_empty_table(frame):
    assert exact_duplicates(frame([])).collect() == [] and drop_duplicates(frame([])).collect() == []


def test_no_python_in_the_plan(frame):
    plan = exact_duplicates(frame(awkward(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

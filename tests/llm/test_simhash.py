"""Operator 3 against brute force."""

import random

import numpy as np
import pytest
from llm_data import awkward
from xxhash import xxh64_intdigest

from essayspark.llm.components import components
from essayspark.llm.simhash import fingerprint, gray_rank, keep_one, local_components, near_duplicates


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, radius):
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(prints))]


def expected(texts, radius=4):
    prints = [slow_fingerprint(t) for _, t in texts]
    roots = slow_components(prints, radius)
    least = {}
    for (i, _), r in zip(texts, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, p, least.get(r)) for (i, _), p, r in zip(texts, prints, roots)]


@pytest.mark.parametrize("seed,radius,hot", [(1, 4, 20_000), (2, 14, 2), (3, 18, 4)])
def test_near_duplicates(frame, seed, radius, hot):
    texts = awkward(seed)
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in near_duplicates(frame(texts), radius=radius, hot=hot).collect()), key=str)
    assert got == sorted(expected(texts, radius), key=str)


def test_one_row_of_each_group_stays(frame):
    texts = awkward(5)
    docs = frame(texts)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    roots = slow_components([slow_fingerprint(t) for _, t in texts], 4)
    groups = {r: [row for row, root in zip(texts, roots) if root == r] for r in roots}  # two groups may share an id
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(groups)
    for group in groups.values():
        least = min((i for i, _ in group if i is not None), default=None)
        stays = next(row for row in left if row[0] == least and row in group)
        left.remove(stays)


def test_every_group_keeps_one_row_whatever_its_ids(frame):
    rng = random.Random(6)
    a, b, c, d, e, f = (" ".join(f"v{rng.randint(0, 10**6)}" for _ in range(40)) for _ in range(6))
    texts = [(None, a), (None, b), (None, b), (None, c),  # unrelated texts without ids
             (7, d), (7, e), (9, e), (7, e),  # one id stands for two groups
             (3, f), (7, f)]  # and is no representative in a third
    kept = sorted(((r.doc_id, r.text) for r in keep_one(frame(texts)).collect()), key=str)
    assert kept == sorted([(None, a), (None, b), (None, c), (7, d), (7, e), (3, f)], key=str)


def test_empty_table(frame):
    assert near_duplicates(frame([])).collect() == []


def test_fingerprint_of_short_and_null_texts():
    assert fingerprint(None) == fingerprint(" \n") == 0
    for t in ("A", "a B c", "a b c d", "x " * 40, "é É ß word"):
        assert fingerprint(t) == slow_fingerprint(t)


def test_index_finds_all_links_and_skips_none():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    x = set()
    for _ in range(300):
        v = rng.choice(base)
        for _ in range(rng.randint(0, 9)):
            v ^= 1 << rng.randrange(64)
        x.add(v)
    x = np.array(sorted(x), np.uint64)
    group = np.array([rng.randrange(3) for _ in x])
    order = np.lexsort((gray_rank(x), group))
    x, group = x[order], group[order]
    want = np.arange(len(x))
    for g in range(3):
        at = np.flatnonzero(group == g)
        want[at] = at[slow_components([int(v) for v in x[at]], 4)]
    for chunk in (16, 4096):
        assert (local_components(x, group, 4, chunk) == want).all()


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5, 5)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)}

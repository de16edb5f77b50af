"""Operators 1 and 5 against brute force, with hot anchors told apart and not."""

from collections import Counter

import pytest
from llm_data import awkward

from essayspark.llm.anchors import Bytes, Words, covered, union
from essayspark.llm.substring import remove_repeated_words, repeated_windows, replace_texts
from essayspark.llm.suffix_dedup import remove_repeated_bytes, repeated_strings


def brute(texts, read, length):
    """Per row: unit list and a flag per unit whether a repeated window covers it."""
    units = [read((t or "").encode()) for _, t in texts]
    seen = Counter(tuple(u[i:i + length]) for u in units for i in range(len(u) - length + 1))
    out = []
    for u in units:
        flag = [False] * len(u)
        for i in range(len(u) - length + 1):
            if seen[tuple(u[i:i + length])] > 1:
                flag[i:i + length] = [True] * length
        out.append((u, flag))
    return out


@pytest.mark.parametrize("seed,hot", [(1, 20_000), (2, 3), (3, 1)])
def test_words(frame, seed, hot):
    texts = awkward(seed)
    got = sorted((tuple(r) for r in remove_repeated_words(frame(texts), length=6, gram=3, hot=hot, batch_bytes=400).collect()), key=str)
    want = sorted(((i, len(u), sum(f), b" ".join(w for w, x in zip(u, f) if not x).decode())
                   for (i, _), (u, f) in zip(texts, brute(texts, bytes.split, 6))), key=str)
    assert got == want


@pytest.mark.parametrize("seed,hot", [(1, 20_000), (2, 3), (3, 1)])
def test_bytes(frame, seed, hot):
    texts = awkward(seed, vocabulary=8, longest=40)
    got = sorted((tuple(r[:4]) + (bytes(r[4]),) for r in remove_repeated_bytes(frame(texts), length=40, gram=8, hot=hot, batch_bytes=500).collect()), key=str)
    want = []
    for (i, _), (u, f) in zip(texts, brute(texts, list, 40)):
        runs = sum(x and not (k and f[k - 1]) for k, x in enumerate(f))
        want.append((i, len(u), sum(f), runs, bytes(b for b, x in zip(u, f) if not x)))
    assert got == sorted(want, key=str)


def test_replaced_texts_keep_all_columns(frame):
    texts = awkward(4)
    docs = frame(texts)
    out = replace_texts(docs, length=6, gram=3)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted(((r.doc_id, r.text, r.n_chars, r.k1) for r in out.collect()), key=str)
    want = []
    for (i, t), (u, f) in zip(texts, brute(texts, bytes.split, 6)):
        kept = b" ".join(w for w, x in zip(u, f) if not x).decode() if any(f) else t
        want.append((i, kept, None if kept is None else len(kept), "z"))
    assert got == sorted(want, key=str)


def test_empty_table(frame):
    assert remove_repeated_words(frame([]), length=6, gram=3).collect() == []
    assert remove_repeated_bytes(frame([]), length=40, gram=8).collect() == []


def test_solvers_agree_with_counting():
    import random

    import numpy as np

    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([2, 4, 6])
        letters = "abcd"[:rng.choice([1, 2, 4])]
        parts = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(length, 4 * length))) for _ in range(rng.randint(1, 12))})
        weights = np.array([rng.choice([1, 1, 3]) for _ in parts])
        seen = Counter()
        for p, w in zip(parts, weights.tolist()):
            seen.update({})
            for i in range(len(p) - length + 1):
                seen[p[i:i + length]] += w
        want = [[seen[p[i:i + length]] > 1 for i in range(len(p) - length + 1)] for p in parts]
        assert [g.tolist() for g in repeated_strings([p.encode() for p in parts], weights, length, stride=2, shards=3)] == want
        assert [g.tolist() for g in repeated_windows([" ".join(p).encode() for p in parts], weights, length)] == want


def test_union():
    assert union([(5, 9), (0, 2), (2, 3), (6, 7), (20, 21)]) == [(0, 3), (5, 9), (20, 21)]


@pytest.mark.parametrize("units,length,gram", [(Bytes, 60, 20), (Words, 12, 4)])
def test_no_group_holds_a_segment_of_every_document_with_a_passage(frame, units, length, gram):
    import random

    rng = random.Random(11)
    some = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    passage, many, hot = some(40), 120, 10
    texts = [(i, f"{some(6)} {passage} {some(20)}") for i in range(many)]

    def counting(segments, weights, length):  # a task's groups come one by one, as batch_bytes is 1
        if len(segments) > hot:
            raise AssertionError(f"{len(segments)} segments in one group")
        return (repeated_strings if units is Bytes else repeated_windows)(segments, weights, length)

    spans = {(r.k1, r.k2): union(list(zip(r.starts, r.ends))) for r in covered(frame(texts), units, length, gram, counting, 1, hot).collect()}
    assert len(spans) == many
    got = sorted(s for s in spans.values())
    want = []
    for _, flag in brute(texts, list if units is Bytes else bytes.split, length):
        edge = [k for k in range(len(flag) + 1) if (k < len(flag) and flag[k]) != (k > 0 and flag[k - 1])]
        want.append(list(zip(edge[::2], edge[1::2])))
    assert got == sorted(want)


def test_a_group_of_near_copies_stays_small_in_memory():
    """4,000 segments around one passage (1.6 MB): the solver's arrays take under 60 bytes per byte, 90 before."""
    import tracemalloc

    import numpy as np

    from essayspark.llm.suffix_dedup import repeated_strings

    rng = np.random.default_rng(3)
    passage = bytes(rng.integers(97, 123, 330, dtype=np.uint8))
    segments = [bytes(rng.integers(97, 123, 40, dtype=np.uint8)) + passage + bytes([97 + k % 3]) * 30 for k in range(4_000)]
    tracemalloc.start()
    got = repeated_strings(segments, np.ones(len(segments)), 360)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * sum(map(len, segments)), peak
    assert all(g[40] and not g[:20].any() for g in got)  # the passage with its thirty letters

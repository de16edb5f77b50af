"""Operator 11 against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import SCHEMA, awkward, rows

from essayspark.llm import collocations as C


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counts(docs, max_words):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def expected(docs, min_count, max_words, top, percent=50):
    f, n = counts(docs, max_words)
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        ranked = []
        for p, a in found.items():
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                ranked.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def documents(seed, n=60):
    rng = random.Random(seed)
    words = ["new", "York", "city", "été", "日本", "of", "the", "x\x00y", "e-mail", "b"]
    make = lambda k: "".join(rng.choice(words) + rng.choice(["  ", " ", "\t", " ", " ", ". ", "\n", ",", " "]) for _ in range(k))
    docs = [(rng.choice(["en", "en", "de", None, "und", ""]), rng.choice([make(rng.randint(0, 50)), "New York City", "of the city"])) for _ in range(n)]
    return docs + docs[:5] + [("en", None), ("xx", ""), ("en", make(4000)), (None, ".,;"), ("en", " ".join(f"u{i}" for i in range(500)))]


@pytest.mark.parametrize("seed,min_count,max_words,top,chunk,size", [(1, 3, 3, 2000, 2_000_000, 2_000_000), (2, 2, 3, 7, 50, 100), (3, 4, 4, 2000, 200, 300), (4, 2, 2, 5, 3, 10**6)])
def test_against_brute_force(spark, monkeypatch, seed, min_count, max_words, top, chunk, size):
    monkeypatch.setattr(C, "SLICE", 64 if chunk < 1000 else C.SLICE)
    docs = documents(seed)
    made = [(i, t, lang, *r[3:]) for i, ((lang, t), r) in enumerate(zip(docs, rows([(i, t) for i, (_, t) in enumerate(docs)])))]
    got = C.collocations(spark.createDataFrame(made, SCHEMA).repartition(4), min_count, max_words, top, chunk=chunk, range_size=size).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == expected(docs, min_count, max_words, top)


def test_awkward_texts(frame):
    texts = awkward(7) * 2
    got = C.collocations(frame(texts), 2).collect()
    docs = [("en" if (i or 0) % 2 else None, t) for i, t in texts]
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == expected(docs, 2, 3, 2000)


@pytest.mark.parametrize("texts", [[], [(1, None), (2, " . ")], [(1, "a b c")]])
def test_nothing_to_find(frame, texts):
    assert C.collocations(frame(texts)).collect() == []


def test_collisions_come_apart():
    """All words hash alike: every phrase has the fingerprint of all others, and is still counted by itself."""
    numbers = C._new_numbers()
    ids = np.concatenate(list(C.word_numbers("a b. a b. b a. c c c", numbers)))
    words, same = list(numbers), np.full(len(numbers), 9, np.uint64)
    frequent = np.unique(np.concatenate([C.fingerprints(ids, same, n, len(ids))[1] for n in (1, 2, 3)]))
    assert len(frequent) == 3
    got = {p.decode(): n for _, phrases, counts in C.verified(ids, words, len(ids), 3, frequent, same) for p, n in zip(phrases, counts.tolist())}
    assert got == {"a": 3, "b": 3, "c": 3, "a b": 2, "b a": 1, "c c": 2, "c c c": 1}


def test_fingerprints_are_those_of_the_words():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 4, 300).astype(np.int32)
    hashes = rng.integers(0, 2**63, 4).astype(np.uint64)
    for n in (1, 2, 3):
        at, fp = C.fingerprints(ids, hashes, n, 290)
        assert at.tolist() == [i for i in range(290) if (ids[i:i + n] > 0).all()]
        by_words = defaultdict(set)
        for i, x in zip(at, fp.tolist()):
            by_words[tuple(ids[i:i + n])].add(x)
        assert all(len(v) == 1 for v in by_words.values()) and len(set.union(*by_words.values())) == len(by_words)


def test_packing():
    for x in ([], [0], [255, 256], [2**64 - 1, 0, 7]):
        assert C.unpack(C.pack(np.array(x, np.uint64))).tolist() == x

"""Operator 13 against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import SCHEMA, awkward, rows

from essayspark.llm.divergence import Tree, audit, terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, min_docs, top):
    """From (lang, source, text) rows."""
    in_docs, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        in_docs[lang].update(set(slow_terms(text)))
        count[lang, source].update(slow_terms(text))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            above = [(p[s][t] - q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", above, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def documents(seed, n_sources, n=120):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)] + ["É", "日本", "Bb", "bB"]
    out = []
    for _ in range(n):
        source = rng.choice([None, "", *[f"s{i}" for i in range(n_sources)]])
        own = words[len(source or "") + ord((source or "0")[-1]) % 7 :: 3]
        out.append((rng.choice(["en", "en", "de", None, ""]), source, rng.choice([None, "", "12 .;", *[" ".join(rng.choices(own, k=rng.randint(1, 40))) for _ in range(9)]])))
    return out + [("xx", "alone", None), ("yy", "a", "rare"), ("yy", "b", "rare"), ("yy", "c", "")]


@pytest.mark.parametrize("seed,n_sources,min_docs,top", [(1, 3, 5, 4), (2, 12, 2, 50), (3, 25, 1, 3), (4, 2, 1000, 5)])
def test_against_brute_force(spark, seed, n_sources, min_docs, top):
    docs = documents(seed, n_sources)
    made = [(i, t, lang, source, *r[4:]) for i, ((lang, source, t), r) in enumerate(zip(docs, rows([(i, t) for i, (_, _, t) in enumerate(docs)])))]
    got = audit(spark.createDataFrame(made, SCHEMA).repartition(5), min_docs, top).collect()
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in got) == expected(docs, min_docs, top)


def test_awkward_texts(frame):
    texts = awkward(3)
    got = audit(frame(texts), 2).collect()
    made = [("en" if (i or 0) % 2 else None, "src", t) for i, t in texts]
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in got) == expected(made, 2, 50)


def test_empty_table(frame):
    assert audit(frame([])).collect() == []


def test_terms():
    for t in ("Ab1cÉé-x_Z", "", None, "\x80é@[a`{", "日本 a"):
        assert [w.decode() for w in terms(t)] == slow_terms(t)


def test_tree_shares_beginnings():
    """Every pair's correction, from rows in any split; a shared beginning is one node."""
    rng = random.Random(5)
    table = sorted({tuple(sorted((f"s{s}", rng.randint(1, 3), s) for s in rng.sample(range(8), rng.randint(1, 6)))) for _ in range(200)})
    weights = [rng.randint(1, 4) for _ in table]
    as_row = lambda path: [{"source": s, "p": 10 * p, "b": b} for s, p, b in path]
    want = Counter()
    for path, m in zip(table, weights):
        for i, (s, ps, bs) in enumerate(path):
            for t, pt, bt in path[:i]:
                want[min(s, t), max(s, t)] += m * (abs(10 * ps - 10 * pt) - abs(10 * ps - bt) - abs(bs - 10 * pt) + abs(bs - bt))
    got = Counter()
    for part in np.array_split(np.arange(len(table)), 3):
        tree = Tree()
        for k in part:
            tree.add(as_row(table[k]), weights[k])
        tree.close(0)
        assert tree.nodes < sum(len(table[k]) for k in part)
        for pair, v in tree.take().items():
            got[pair] += v
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}

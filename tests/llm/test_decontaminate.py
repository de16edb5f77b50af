"""Operator 2 against brute force."""

import random
from collections import Counter

from essayspark.llm.decontaminate import HammingBlocks, _blocks, contaminated, keep_clean, shingles, weighted_similarity

RNG = random.Random(7)
WORDS = [f"w{i}" for i in range(400)]
ITEMS = [(k, " ".join(RNG.choice(WORDS) for _ in range(n))) for k, n in enumerate((12, 20, 33, 5, 3, 1, 20))] + [(7, None), (8, "  "), (9, None), (None, "w1 w2")]
ITEMS[5] = (5, "rareword")


def documents():
    out = []
    for i in range(40):
        words = [RNG.choice(WORDS) for _ in range(RNG.randint(0, 120))]
        if i % 4 == 0:
            item = ITEMS[i // 4 % 7][1].split()
            if i % 8 == 0 and len(item) > 15:
                item = item[1:]  # a near copy
            at = RNG.randint(0, len(words))
            words[at:at] = [w.upper() if i % 3 == 0 else w for w in item]
        out.append((i, "\n ".join(words)))
    return out + [(100, None), (101, ""), (None, ITEMS[0][1]), (102, " ".join(ITEMS[2][1].split()[:-1])), (0, out[0][1])]


def brute(texts):
    low = lambda t: (t or "").encode().lower().split()
    out = []
    for i, t in texts:
        words = low(t)
        for k, item in ITEMS:
            own = low(item)
            if not own or k is None or not words:
                continue
            size = min(len(own), len(words))
            best = None
            for a in range(len(words) - size + 1):
                s = weighted_similarity(shingles(words[a:a + size]), shingles(own))
                if s >= 0.8 and (best is None or s > best[0]):
                    best = (s, a, size)
            if best:
                out.append((i, k, *best))
    return sorted(out, key=str)


def test_contaminated(frame, spark):
    texts = documents()
    bench = spark.createDataFrame([(k, t, "z") for k, t in ITEMS], "item_id long, text string, doc_id string")
    docs = frame(texts)
    want = brute(texts)
    assert want
    for block_items in (20_000, 3):
        assert sorted((tuple(r) for r in contaminated(docs, bench, block_items=block_items).collect()), key=str) == want
    bad = Counter((i, t) for i, t in texts if any(w[0] == i for w in brute([(i, t)])))
    kept = keep_clean(docs, bench, block_items=3)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(texts) - bad


def test_items_without_id_and_of_one_id(frame, spark):
    some = lambda k: " ".join(f"x{k}y{j}" for j in range(12))
    items = [(None, some(0)), (None, some(1)), *[(5, some(k)) for k in range(2, 12)], (5, some(2))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [(k, f"before {some(k)} after") for k in range(12)] + [(20, "clean " * 20), (21, f"{some(2)} {some(0)} {some(7)}")]
    want = sorted([(k, None if k < 2 else 5, 1.0, 1, 12) for k in range(12)] + [(21, None, 1.0, 12, 12), (21, 5, 1.0, 0, 12)], key=str)
    for block_items in (20_000, 3):
        assert sorted((tuple(r) for r in contaminated(frame(texts), bench, block_items=block_items).collect()), key=str) == want
        assert [r.doc_id for r in keep_clean(frame(texts), bench, block_items=block_items).collect()] == [20]
    assert max(map(len, _blocks(bench, 3))) < 10  # of 12 different items, ten have one id


def test_empty_tables(frame, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(frame([(1, "a b c")]), bench).collect() == []
    assert contaminated(frame([]), spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []


def test_blocks_find_everything_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(1)
    stored = rng.integers(0, 2**63, 60, dtype=np.uint64)
    queries = rng.integers(0, 2**63, 30, dtype=np.uint64)
    queries[:10] = stored[:10] ^ np.uint64(0b1011)
    for radius, blocks in ((3, 4), (22, 6), (26, 5)):
        want = [(i, j) for i in range(30) for j in range(60) if int(queries[i] ^ stored[j]).bit_count() <= radius]
        assert HammingBlocks(stored, radius, blocks).search(queries) == want

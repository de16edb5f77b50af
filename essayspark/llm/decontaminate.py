"""Benchmark decontamination by SimHash windows (operator 2).

Words are lower-cased (A-Z) and split on ASCII white space; a shingle is five words (all
words of an item with fewer).  A document is contaminated by an item if one of its
windows of the item's size (the whole text, if it is shorter) has a weighted
similarity of ``similarity`` or more to the item: the sum over shingles of the
smaller multiplicity, divided by the sum of the larger.

Windows get a 64-bit SimHash of their shingles, from running sums over the text.  Items are
indexed by multi-index hashing: the bits are cut into blocks; two fingerprints within
``radius`` agree on some block up to radius / blocks bits, so looking up each block's
value and its neighbours up to so many bits finds all of them.  Candidates are
verified with exact shingles.  Only windows that can reach the similarity are
fingerprinted: so many of their shingles must occur in the benchmark at all.

Benchmark items are a query set: they go to all tasks in blocks of about ``block_items`` and at most about
``BLOCK_BYTES`` of text, dealt by a hash of id and text, each block in a pass of its own over the documents, so what
is broadcast is bounded whatever the benchmark's size and ids.

Input: documents with ``doc_id``, ``text`` and a benchmark with ``item_id``, ``text``; other columns
are ignored.  Null and empty texts contaminate nothing and are not contaminated.  Repeated
documents are reported as often as they occur, repeated item ids, null ones included, with their best match.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.anchors import Words, gram_hashes
from essayspark.llm.common import map_batches, ship_package

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 22, 6
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 1 << 25


def simhash_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of the bits of shingle hashes: row i has the sums of the first i."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def simhash_of(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Fingerprints of windows with so many set bits among ``n`` hashes."""
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def window_prints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles at ``starts``; running sums cover one stretch at a time."""
    out, k = [], 0
    while k < len(starts):
        end = int(np.searchsorted(starts, starts[k] + 16_384))
        at = starts[k:end] - starts[k]
        sums = simhash_sums(hashes[starts[k]:starts[end - 1] + size])
        out.append(simhash_of(sums[at + size] - sums[at], np.full(len(at), size)))
        k = end
    return np.concatenate(out)


class HammingBlocks:
    """All stored fingerprints within ``radius`` bits of a query, by looking up blocks of bits."""

    def __init__(self, stored: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.stored, self.radius = stored, radius
        edges = [64 * k // blocks for k in range(blocks + 1)]
        self.blocks = []
        for lo, hi in itertools.pairwise(edges):
            value = self._part(stored, lo, hi)
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << (hi - lo)) + 1))
            near = [sum(1 << b for b in c) for k in range(radius // blocks + 1) for c in itertools.combinations(range(hi - lo), k)]
            self.blocks.append((lo, hi, order, first, np.array(near, np.int64)))

    @staticmethod
    def _part(x, lo, hi):
        return ((x >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray) -> list[tuple[int, int]]:
        """Pairs (query, stored) within the radius."""
        found = set()
        for at in range(0, len(queries), 256):
            q = queries[at:at + 256]
            for lo, hi, order, first, near in self.blocks:
                value = self._part(q, lo, hi)[:, None] ^ near
                a, b = first[value], first[value + 1]
                row, col = np.nonzero(b > a)
                many = (b - a)[row, col]
                start = a[row, col]
                item = order[np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)]
                row = np.repeat(row, many)
                close = np.bitwise_count(q[row] ^ self.stored[item]) <= self.radius
                found.update(zip((row[close] + at).tolist(), item[close].tolist()))
        return sorted(found)


def shingles(words: list[bytes]) -> Counter:
    """Shingles of a word sequence with their multiplicity."""
    if len(words) < SHINGLE:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(zip(*(words[k:] for k in range(SHINGLE))))


def weighted_similarity(a: Counter, b: Counter) -> float:
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low / (a.total() + b.total() - low) if a or b else 0.0


class Benchmark:
    """Index of some benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, radius: int, blocks: int):
        self.similarity = similarity
        self.reader = Words()
        self.items = []
        hashes = []
        for item_id, text in items:
            words = (text or "").encode("utf-8").lower().split()
            if words:
                _, codes = self.reader.read_bytes(b" ".join(words))
                h = gram_hashes(codes, min(SHINGLE, len(words)))
                self.items.append((item_id, len(words), shingles(words)))
                hashes.append(h)
        self.sizes = sorted({n for _, n, _ in self.items})
        prints = [simhash_of(h_bits[-1:], np.array([len(h)])) for h in hashes for h_bits in [simhash_sums(h)]]
        self.index = HammingBlocks(np.concatenate(prints) if prints else np.zeros(0, np.uint64), radius, blocks)
        # hashes of the items' shingles by gram size, and a bit table in front of them
        self.known = {}
        for g in {min(SHINGLE, n) for n in self.sizes}:
            h = np.unique(np.concatenate([x for x, (_, n, _) in zip(hashes, self.items) if min(SHINGLE, n) == g]))
            table = np.zeros(1 << 18, bool)
            table[(h >> np.uint64(46)).astype(np.int64)] = True
            self.known[g] = (h, table, sorted({n for _, n, _ in self.items if min(SHINGLE, n) == g}))

    def search(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """item id -> best similarity, first word and number of words of its window."""
        raw = (text or "").encode("utf-8").lower()
        units, codes = self.reader.read_bytes(raw)
        best: dict[int, tuple[float, int, int]] = {}
        words = None
        for gram, (known, table, sizes) in self.known.items():
            if len(codes) < gram:
                continue
            h = gram_hashes(codes, gram)
            maybe = np.flatnonzero(table[(h >> np.uint64(46)).astype(np.int64)])
            if not len(maybe):
                continue
            place = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            hit = np.zeros(len(h) + 1, np.int32)
            hit[maybe[known[place] == h[maybe]] + 1] = 1
            if not hit.any():
                continue
            before = np.cumsum(hit)
            for size in sizes:
                window = min(size, len(codes))
                mine, its = window - gram + 1, size - gram + 1
                # both have so many shingles; so many must be shared for the similarity
                need = self.similarity / (1 + self.similarity) * (mine + its)
                at = np.flatnonzero(before[mine:] - before[:len(before) - mine] >= need - 1e-9)
                if not len(at):
                    continue
                for q, k in self.index.search(window_prints(h, at, mine)):
                    item_id, n, own = self.items[k]
                    if n != size:
                        continue
                    words = raw.split() if words is None else words
                    a = int(at[q])
                    s = weighted_similarity(shingles(words[a:a + window]), own)
                    if s >= self.similarity and (item_id not in best or s > best[item_id][0]):
                        best[item_id] = (s, a, window)
        return best


def _blocks(benchmark: DataFrame, block_items: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_items``, one collected after the other."""
    bench = benchmark.select("item_id", "text").filter("text is not null").distinct()
    size = bench.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    rounds = max(1, -(-size["n"] // block_items), -(-size["bytes"] // BLOCK_BYTES))
    for k in range(rounds):
        block = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k)
        yield [(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                 blocks: int = BLOCKS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: for each contaminated document and item
    the first window with the highest similarity."""
    # what earlier blocks found goes along with the document
    docs = docs.select("doc_id", "text", F.lit(None).cast(_FOUND).alias("found"))
    for items in _blocks(benchmark, block_items):
        docs = _search(docs, items, similarity, radius, blocks)
    return docs.select("doc_id", F.inline("found"))


_FOUND = "array<struct<item_id:long,similarity:double,first_word:long,n_words:long>>"


def _search(docs: DataFrame, items: list, similarity: float, radius: int, blocks: int) -> DataFrame:
    def make():
        index = Benchmark(items, similarity, radius, blocks)

        def step(cols):
            found = []
            for text, before in zip(cols["text"], cols["found"]):
                best = {f["item_id"]: (f["similarity"], f["first_word"], f["n_words"]) for f in before or ()}
                for item_id, (s, a, n) in index.search(text).items():
                    if item_id not in best or (s, -a, -n) > (best[item_id][0], -best[item_id][1], -best[item_id][2]):
                        best[item_id] = (s, a, n)
                order = sorted(best, key=lambda i: (i is None, i or 0))
                found.append([dict(zip(("item_id", "similarity", "first_word", "n_words"), (i, *best[i]))) for i in order] or None)
            return {"doc_id": cols["doc_id"], "text": cols["text"], "found": found}

        return step

    return map_batches(docs, make, f"doc_id long, text string, found {_FOUND}")


def keep_clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
               blocks: int = BLOCKS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark item contaminates."""
    ship_package(docs.sparkSession)
    for items in _blocks(benchmark, block_items):
        docs = docs.filter(~_found(items, similarity, radius, blocks)(F.col("text")))
    return docs


def _found(items: list, similarity: float, radius: int, blocks: int):
    index: list = []  # built once in each worker

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        if not index:
            index.append(Benchmark(items, similarity, radius, blocks))
        return pd.Series([bool(index[0].search(t)) for t in texts], dtype="bool")

    return found

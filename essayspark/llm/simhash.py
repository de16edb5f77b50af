"""SimHash near-duplicate detection over a Gray-order hierarchical index (operator 3).

Fingerprints: texts are lower-cased (A-Z only) and split on ASCII white space; every
run of ``shingle`` words, repeats included, is hashed with XXH64 (seed 42), and a bit
of the fingerprint is set if it is set in over half of the hashes.

Links: two fingerprints link at ``radius`` or fewer differing bits.  Equal fingerprints
are one entry from here on.  To search in parallel without comparing all with all,
the 64 bits are cut into radius + 1 blocks: linked fingerprints agree on one
whole block at least, so they meet in that block's bucket.  A bucket of more
than ``hot`` entries is cut again by the same rule on its other bits.

In a bucket the entries are sorted by Gray rank (neighbours differ in few bits) and
indexed by a tree: a node holds the bits that all entries below it share, beyond
those its parent holds.  A query goes down the tree with the differences
accumulated so far and drops a whole group once they exceed the radius; a group whose free
bits cannot exceed it any more is taken whole.  Groups already known to be
connected to the query are skipped, so a dense cluster costs about its
size, not its square.  Each bucket returns a spanning star per local component, at most one
row per entry; components of these links are found in Spark.

Input: ``doc_id`` and ``text``; other columns are ignored.  A null or empty text has no
words: fingerprint 0, linked like any other.  Repeated rows link to each
other.  A null id never becomes a component's id unless all ids are null.  An empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.anchors import text_key
from essayspark.llm.common import free_names, map_batches, ship_package, written
from essayspark.llm.components import components

SHINGLE, RADIUS = 4, 4
HOT = 20_000
FAN = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends[: len(words) - shingle + 1] - np.fromiter(map(len, words[: len(words) - shingle + 1]), np.int64) - 1
    joined = b" ".join(words)
    hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):  # a bit takes a byte meanwhile: long texts go by parts
        part = np.array(hashes[at:at + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in Gray order."""
    x = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    return x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (long with the fingerprint's bits), k1, k2 (the text's name)."""

    def make():
        def step(cols):
            fp = np.array([fingerprint(t, shingle) for t in cols["text"]], np.uint64)
            return {"doc_id": cols["doc_id"], "fp": fp.view(np.int64).tolist(), "k1": cols["k1"], "k2": cols["k2"]}

        return step

    k1, k2 = text_key()
    return map_batches(docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2")), make, "doc_id long, fp long, k1 long, k2 long")


class GrayIndex:
    """Index of entries that lie group after group, each group in Gray order."""

    def __init__(self, x: np.ndarray, group: np.ndarray):
        self.x, n = x, len(x)
        self.first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])  # of each group
        sizes = np.diff(np.r_[self.first, n])
        self.of = np.repeat(np.arange(len(self.first)), sizes)
        self.levels = []  # leaves first: start, end, pattern, shared bits, first child
        start = np.arange(n)
        shared, pattern = np.full(n, ~np.uint64(0)), x
        bounds = self.first  # first node of each group on the level below
        while True:
            inside = np.arange(len(start)) - np.repeat(bounds, np.diff(np.r_[bounds, len(start)]))
            child = np.flatnonzero(inside % FAN == 0)
            differ = np.bitwise_or.reduceat(pattern ^ np.repeat(pattern[child], np.diff(np.r_[child, len(start)])), child)
            shared = np.bitwise_and.reduceat(shared, child) & ~differ
            pattern = pattern[child] & shared
            start = start[child]
            self.levels.append((start, np.r_[start[1:], n], pattern, shared, np.r_[child, len(inside)]))
            bounds = np.searchsorted(start, self.first)
            if len(start) == len(self.first):
                break

    def links(self, queries: np.ndarray, radius: int, label: np.ndarray):
        """Pairs (query, entry) that connect each query with all entries behind it within ``radius``
        that are not in its component yet."""
        out_a, out_b = [], []
        q, node = queries, self.of[queries]
        spent = np.zeros(len(q), np.int64)
        above = None  # shared bits of each pair's parent
        for start, end, pattern, shared, child in reversed(self.levels):
            low, high = np.minimum.reduceat(label, start), np.maximum.reduceat(label, start)
            known = np.where(low == high, low, -1)
            held = shared[node] if above is None else shared[node] & ~above
            spent = spent + np.bitwise_count((self.x[q] ^ pattern[node]) & held).astype(np.int64)
            keep = (spent <= radius) & (end[node] > q + 1) & (known[node] != label[q])
            q, node, spent = q[keep], node[keep], spent[keep]
            # free bits cannot carry any entry of the group beyond the radius: all of it is linked
            whole = spent + 64 - np.bitwise_count(shared[node]).astype(np.int64) <= radius
            a, many = q[whole], (end - start)[node[whole]]
            out_a.append(np.repeat(a, many))
            out_b.append(_ranges(start[node[whole]], many))
            q, node, spent = q[~whole], node[~whole], spent[~whole]
            above = shared[node]
            many = (child[1:] - child[:-1])[node]
            above, spent, q, node = np.repeat(above, many), np.repeat(spent, many), np.repeat(q, many), _ranges(child[node], many)
        # now nodes are entries
        diff = spent + np.bitwise_count((self.x[q] ^ self.x[node]) & ~above).astype(np.int64) if above is not None else spent
        keep = (diff <= radius) & (node > q)
        out_a.append(q[keep])
        out_b.append(node[keep])
        return np.concatenate(out_a), np.concatenate(out_b)


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (many[0] numbers), start[1], ..."""
    at = np.cumsum(many) - many
    return np.arange(int(many.sum())) - np.repeat(at, many) + np.repeat(start, many)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest index of the component) after joining each a[i] with b[i]."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        low, high = np.minimum(x, y)[open_], np.maximum(x, y)[open_]
        label = label.copy()
        np.minimum.at(label, high, low)
        while True:
            deeper = label[label]
            if (deeper == label).all():
                break
            label = deeper


def local_components(x: np.ndarray, group: np.ndarray, radius: int = RADIUS, chunk: int = 4096) -> np.ndarray:
    """For entries sorted by (group, Gray rank): the first entry of each one's component in its group."""
    index, label = GrayIndex(x, group), np.arange(len(x))
    done, size = 0, 64
    sizes = np.diff(np.r_[index.first, len(x)])
    if len(sizes) and sizes.max() < 512:  # small groups have no dense cluster worth finding early
        size = chunk
    while done < len(x):
        a, b = index.links(np.arange(done, min(done + size, len(x))), radius, label)
        if len(a):
            label = _merge(label, a, b)
        done, size = done + size, min(2 * size, chunk)
    return label


def links(entries: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """``entries``: distinct fp.  Links a, b whose components are those of all pairs within ``radius``."""
    ship_package(entries.sparkSession)
    n_blocks = radius + 1
    edges = [64 * k // n_blocks for k in range(n_blocks + 1)]

    def part(fp, lo, hi):
        return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))

    fp = F.col("fp")
    blocks = F.array(*[F.struct(F.lit(k).alias("block"), part(fp, edges[k], edges[k + 1]).alias("key")) for k in range(n_blocks)])
    keyed = entries.select("fp", F.inline(blocks))
    # an oversized bucket is cut by a second block, taken from the bits outside the first
    large = keyed.groupBy("block", "key").count().filter(F.col("count") > hot).select("block", "key", F.lit(True).alias("large"))
    subs = None
    for k in range(n_blocks):
        # rotated so that the block's own bits are on top and the others below
        turned = F.shiftrightunsigned(fp, edges[k + 1]).bitwiseOR(F.shiftleft(fp, 64 - edges[k + 1]))
        free = 64 - (edges[k + 1] - edges[k])
        cuts = [free * j // n_blocks for j in range(n_blocks + 1)]
        cut = F.array(*[F.struct(F.lit(j).alias("sub"), part(turned, cuts[j], cuts[j + 1]).alias("subkey")) for j in range(n_blocks)])
        subs = F.when(F.col("block") == k, cut) if subs is None else subs.when(F.col("block") == k, cut)
    none = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("subkey")))
    keyed = (keyed.join(large, ["block", "key"], "left")
             .select("fp", "block", "key", F.inline(F.when(F.col("large"), subs).otherwise(none))))
    group = F.xxhash64("block", "key", "sub", "subkey")
    return _bucket_links(keyed.select("fp", group.alias("g")), radius)


def _bucket_links(keyed: DataFrame, radius: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        held, rows = [], 0

        def solve(x, g):
            # the sort of the shuffle brings groups together; Gray order within each of them
            order = np.lexsort((gray_rank(x), g))
            x, g = x[order], g[order]
            label = local_components(x, g, radius)
            own = np.flatnonzero(label != np.arange(len(x)))
            return pa.RecordBatch.from_arrays([pa.array(x[own].view(np.int64)), pa.array(x[label[own]].view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False)))
            rows += batch.num_rows
            if rows < 100_000:
                continue
            x, g = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            whole = int(np.searchsorted(g, g[-1]))  # the last group may go on
            if whole:
                yield solve(x[:whole], g[:whole])
            held, rows = [(x[whole:], g[whole:])], len(x) - whole
        if rows:
            x, g = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            yield solve(x, g)

    return keyed.repartition("g").sortWithinPartitions("g").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """doc_id, fp (long), component_id: the smallest id of all documents reachable over links."""
    fps = written(fingerprints(docs, shingle).select("doc_id", "fp"))
    rooted = _rooted(fps, radius, hot)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(fps: DataFrame, radius: int, hot: int) -> DataFrame:
    """fp, least (its smallest id), root (the fingerprint that names its group)."""
    entries = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(entries.select("fp"), radius, hot))
    return entries.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """One row of ``docs`` (all columns) for each group: the one with the smallest id (null ids last), of
    several texts under that id the one whose hash is smallest.  Rows that repeat both are the same document."""
    fps = written(fingerprints(docs, shingle))
    rows = fps.groupBy("doc_id", "fp", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    # a row is named by its id and its text's hash, which also decide its group
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "n")).alias("first")
    chosen = written(rows.join(_rooted(fps, radius, hot).select("fp", "root"), "fp").groupBy("root").agg(first).select("first.*"))
    k1, k2 = text_key()
    names = free_names(docs, "k1", "k2")
    named = docs.withColumns(dict(zip(names, (k1, k2))))
    same = named["doc_id"].eqNullSafe(chosen["doc_id"]) & (named[names[0]] == chosen["k1"]) & (named[names[1]] == chosen["k2"])
    single = named.join(chosen.filter("n = 1"), same, "left_semi")
    repeated = named.join(chosen.filter("n > 1"), same, "left_semi").dropDuplicates(["doc_id", *names])
    return single.unionByName(repeated).select(docs.columns)

"""Source divergence audit (operator 13) over a frequent-pattern tree.

How far do the sources of a language differ in their words?  Each language keeps the terms that at least
``MIN_DOCS`` of its documents hold; a group (language, source) and the language itself give every kept term a smoothed
share p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)).  ``pair`` rows give the sum of |p - q| over all kept
terms for any two sources of a language, ``term`` rows the terms that a source uses more than its language does.

Most terms occur in few sources, so sums over V terms for every pair of sources would mostly add what is known
beforehand.  With b the share of a count of zero, |p_s - p_t| summed over the terms is

    V |b_s - b_t|  +  sum over the terms of s (|p_s - b_t| - |b_s - b_t|)  +  the same for t
                   +  sum over the terms of both (|p_s - p_t| - |p_s - b_t| - |b_s - p_t| + |b_s - b_t|)

The second sum needs the counts of one source only (a histogram, sorted once and read by cumulative sums).  For the
last, each term is a row of its nonzero counts in source order; equal rows are one row with a multiplicity.  Rows,
sorted, are a depth-first walk through their frequent-pattern tree: a node is a shared beginning, its
multiplicity the terms below it, and it gives one correction for itself and each of its ancestors.  Only the current path is
held.  Ranges of sorted rows go to tasks; a node at a border counts its part in each, which adds up to the same sum.

Documents are counted in every task before rows are shuffled, so a hot source or term arrives as at most a row for
each task.  A term's row, a path and a histogram are bounded by the number of sources and of distinct counts; the pairs of sources
are the result itself.  All arithmetic is exact (integers; the shares by decimals).

Null text, lang and source count as ''.  Texts without terms still make their group occur.  Repeated rows count each
time; an empty table gives an empty table; other columns are ignored.  Ranks go by value, then by the item's UTF-8 bytes.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches, written

MIN_DOCS, SMOOTH, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Distinct terms, and cells of pair sums, that a task holds before it hands them on.
HELD_TERMS, HELD_CELLS = 300_000, 4_000_000

#: Bytes to terms: letters of ASCII in lower case and all bytes of other characters stay, the rest are blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode("utf-8").translate(_TERM_BYTES).split()


def _count_terms():
    """Step for ``map_batches``: occurrences and documents of every (lang, source, term) of a task."""
    n: dict = {}
    docs: dict = {}

    def rows():
        out = {"lang": [], "source": [], "term": [], "n": [], "docs": []}
        for group, counts in n.items():
            out["lang"] += [group[0]] * len(counts)
            out["source"] += [group[1]] * len(counts)
            out["term"] += counts.keys()
            out["n"] += counts.values()
            out["docs"] += map(docs[group].__getitem__, counts)
        out["term"] = [t.decode("utf-8") for t in out["term"]]
        n.clear()
        docs.clear()
        return out

    def step(cols):
        for lang, source, text in zip(cols["lang"], cols["source"], cols["text"]):
            group = (lang or "", source or "")
            found = terms(text)
            if found:
                n.setdefault(group, Counter()).update(found)
                docs.setdefault(group, Counter()).update(set(found))
        return rows() if sum(map(len, n.values())) > HELD_TERMS else None

    step.rest = lambda: [rows()]
    return step


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = wide(count + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)")
    below = wide(total + kept * SMOOTH)
    return F.when(kept > 0, F.call_function("div", above, below) + 1)


def _one_source():
    """Step for ``map_batches``: for a source of a language and every other one, what needs the counts of the first only,
    and (once for a pair) what needs no counts."""

    def step(cols):
        out = {"lang": [], "a": [], "b": [], "value": []}
        for lang, source, base, kept, shares, weights, names, bases in zip(*cols.values()):
            order = np.argsort(shares or [], kind="stable")
            p, m = np.array(shares or [], np.int64)[order], np.array(weights or [], np.int64)[order]
            other = np.array(bases, np.int64)
            at = np.searchsorted(p, other)
            below_m, below_pm = (np.concatenate([[0], np.cumsum(x)]) for x in (m, p * m))
            # sum of m |p - b|: those under b, and those from b on
            far = (other * below_m[at] - below_pm[at]) + (below_pm[-1] - below_pm[at]) - other * (below_m[-1] - below_m[at])
            apart = np.abs(other - base)
            value = far - apart * below_m[-1]
            for name, v, d in zip(names, value.tolist(), apart.tolist()):
                if name != source:
                    out["lang"].append(lang)
                    out["a"].append(min(name, source))
                    out["b"].append(max(name, source))
                    out["value"].append(v + kept * d if source < name else v)
        return out

    return step


class Tree:
    """Pair corrections of a frequent-pattern tree whose rows arrive in sorted order."""

    def __init__(self):
        self.path: list = []  # (source, p) of the open nodes
        self.number: dict = {}  # source: its place in the sums
        self.at, self.p, self.b, self.m = (np.zeros(0, np.int64) for _ in range(4))  # of the open nodes; m: terms below
        self.sums: dict[int, np.ndarray] = {}  # of a node's source, by its ancestors' sources
        self.nodes = 0

    def close(self, depth: int) -> None:
        """Nodes from ``depth`` on are complete: each corrects the pairs with its ancestors, with all its terms."""
        n = len(self.path)
        if n <= depth:
            return
        below = np.cumsum(self.m[depth:n][::-1])[::-1]
        some = max(1, HELD_CELLS // n)
        for at in range(depth, n, some):
            end = min(at + some, n)
            p, b, up, low = self.p[at:end, None], self.b[at:end, None], self.p[:n], self.b[:n]
            change = below[at - depth:end - depth, None] * (np.abs(p - up) - np.abs(p - low) - np.abs(b - up) + np.abs(b - low))
            for k in range(max(at, 1), end):
                row = self.sums.get(int(self.at[k]))
                if row is None or len(row) < len(self.number):
                    grown = np.zeros(2 * len(self.number), np.int64)
                    if row is not None:
                        grown[: len(row)] = row
                    row = self.sums[int(self.at[k])] = grown
                row[self.at[:k]] += change[k - at, :k]
        if depth:
            self.m[depth - 1] += below[0]
        self.nodes += n - depth
        del self.path[depth:]

    def add(self, row: list[dict], m: int) -> None:
        """A row of {source, p, b} in source order, ``m`` times."""
        shared = 0
        while shared < min(len(row), len(self.path)) and self.path[shared] == (row[shared]["source"], row[shared]["p"]):
            shared += 1
        self.close(shared)
        new = row[shared:]
        self.path += [(x["source"], x["p"]) for x in new]
        for name, of in (("at", lambda x: self.number.setdefault(x["source"], len(self.number))), ("p", lambda x: x["p"]), ("b", lambda x: x["b"]), ("m", lambda x: 0)):
            setattr(self, name, np.concatenate([getattr(self, name)[:shared], np.array([of(x) for x in new], np.int64)]))
        self.m[len(self.path) - 1] += m

    def take(self) -> dict[tuple[str, str], int]:
        """The sums so far, by the two sources in order; they start again from nothing."""
        names = list(self.number)
        out = {}
        for k, row in self.sums.items():
            for j in np.flatnonzero(row).tolist():
                out[min(names[k], names[j]), max(names[k], names[j])] = int(row[j])
        self.sums = {}
        return out


def _walk():
    """Step for ``map_batches`` over rows sorted by lang and path."""
    trees: dict[str, Tree] = {}

    def rows():
        out = {"lang": [], "a": [], "b": [], "value": []}
        for lang, tree in trees.items():
            for (a, b), v in tree.take().items():
                for name, x in zip(out, (lang, a, b, v)):
                    out[name].append(x)
        return out

    def step(cols):
        done = None
        for lang, path, m in zip(cols["lang"], cols["path"], cols["m"]):
            if lang not in trees:
                for tree in trees.values():
                    tree.close(0)
                if trees:
                    done = rows() if done is None else {k: done[k] + v for k, v in rows().items()}
                trees.clear()
                trees[lang] = Tree()
            trees[lang].add(path, m)
        if sum(len(r) for t in trees.values() for r in t.sums.values()) > HELD_CELLS:
            more = rows()
            done = more if done is None else {k: done[k] + more[k] for k in done}
        return done

    def rest():
        for tree in trees.values():
            tree.close(0)
        yield rows()

    step.rest = rest
    return step


def _counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, term, n (of the language), by: (source, n) in source order, for every kept term."""
    found = map_batches(docs.select("lang", "source", "text"), _count_terms, "lang string, source string, term string, n long, docs long")
    each = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("by"))
    return written(whole.filter(F.col("docs") >= min_docs).select("lang", "term", "n", "by"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    kept = _counts(docs, min_docs)
    each = kept.select("lang", "term", F.col("n").alias("n_lang"), F.inline("by"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("total_lang"))
    groups = docs.select(empty("lang"), empty("source")).distinct()
    groups = groups.join(each.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "total_lang")])
    groups = written(groups.withColumn("b", F.coalesce(_share(zero, F.col("total"), F.col("kept")), zero)))
    each = written(each.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "b", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), _share(F.col("n_lang"), F.col("total_lang"), F.col("kept")).alias("q")))

    # rows of the tree: equal rows of shares are one row; a source alone in its row corrects no pair
    rows = each.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "b"))).alias("path"))
    paths = rows.filter(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m"))
    # ranges are chosen from a sample of the paths' beginnings, which stay small however many sources there are
    walk = paths.repartitionByRange("lang", F.slice("path", 1, 4)).sortWithinPartitions("lang", "path")
    both = map_batches(walk, _walk, "lang string, a string, b string, value long", rows=4096)

    shares = each.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    shares = shares.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("s"))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "b")).alias("o"))
    alone = groups.join(shares, ["lang", "source"], "left").join(others, "lang").select(
        "lang", "source", "b", "kept", F.col("s.p").alias("shares"), F.col("s.m").alias("weights"), F.col("o.source").alias("names"), F.col("o.b").alias("bases"))
    alone = map_batches(alone, _one_source, "lang string, a string, b string, value long", rows=16)

    pairs = both.unionByName(alone).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", F.inline(ways), "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    above = each.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(by)).unionByName(above.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top))

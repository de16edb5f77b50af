"""Bringing equal windows of long texts together, without moving every window.

Operators 1 and 5 remove what is covered by windows of ``length`` units (bytes or
words) that start anywhere else too.  Each window is represented by its
*anchor*: the run of ``gram`` units inside it with the smallest hash (the leftmost
of equal ones).  The choice depends on the window's content only, so equal windows
have equal anchors at equal places, whatever document they are in; and neighbouring windows
mostly share one, so a document has few anchors.  A *segment* is the text of the windows
that share one anchor: it holds these windows and no other ones.

1. Every task lists its documents' anchors by hash; only hashes that occur twice or more in
   the corpus matter.
2. Texts with such anchors are cut into segments, once, and the places and contents are written.  Equal texts are one text with
   a number of copies before they are shuffled, and a task shows the content of equal segments once.
3. In each partition whole groups of distinct segments meet: a solver (an FM-index, or merged
   Burrows-Wheeler transforms) tells which windows occur at least twice.
4. The answers are joined to the places where the segments lie, and the covered stretches to the texts.
   Both are plain joins, so a segment or text that very many documents share is split by the skewed-join handling.

An anchor that very many segments share (inside a passage copied all over the corpus) has no group:
the segments around the passage's ends differ in every document, and whatever inside a window decides
where it goes may lie in the passage.  Each window of the distinct segments of such an anchor is named by a
128-bit hash of its whole content; blocks of segments send each name once, with its number, to the name's part, and get back a bit
for each, so a window that all documents share is no task's burden either, and windows' places never travel.

A document is named by a 128-bit hash of its text: equal texts have equal answers, whatever their ids, and
each copy, repeated rows included, counts as an occurrence.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from essayspark.llm.common import map_batches, ship_package, written

#: Segments of one anchor beyond which its windows are counted one by one instead of in a group.
HOT = 20_000
#: Window starts of a block of segments of hot anchors, and window names of a part.
BLOCK, PART = 500_000, 2_000_000
#: A position takes so many bits beside the hash; longer texts are read in overlapping slices.
POSITION_BITS = 24
_POSITION = np.uint64((1 << POSITION_BITS) - 1)
_ODD = np.random.default_rng(2024).integers(0, 2**63, 80, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Bytes:
    """Units are the bytes of a text's UTF-8 form."""

    _codes = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64)

    def read(self, text: str | None):
        raw = (text or "").encode("utf-8")
        return raw, self._codes[np.frombuffer(raw, np.uint8)]

    @staticmethod
    def cut(units, a: int, b: int) -> bytes:
        return units[a:b]

    @staticmethod
    def windows(content: bytes, length: int) -> list[bytes]:
        return [content[i:i + length] for i in range(len(content) - length + 1)]


class Words:
    """Units are the words between ASCII white space, unchanged."""

    _factor = np.uint64(6364136223846793005)
    _inverse = np.uint64(pow(6364136223846793005, -1, 2**64))

    def __init__(self):
        self._up = self._down = np.ones(1, np.uint64)

    def read(self, text: str | None):
        return self.read_bytes((text or "").encode("utf-8"))

    def read_bytes(self, raw: bytes):
        """(text, starts, ends) and a code per word: a polynomial over its bytes, taken from
        running sums over the whole text, so no word is handled on its own."""
        data = np.frombuffer(raw, np.uint8)
        word = np.r_[False, ~_BLANK[data], False]
        edge = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = edge[::2], edge[1::2]
        if len(self._up) <= len(raw):  # powers of the factor and its inverse, kept for the next text
            n = 2 * len(raw)
            self._up = np.cumprod(np.r_[np.uint64(1), np.full(n, self._factor)])
            self._down = np.cumprod(np.r_[np.uint64(1), np.full(n, self._inverse)])
        total = np.r_[np.uint64(0), np.cumsum(Bytes._codes[data] * self._up[: len(raw)])]
        return (raw, starts, ends), (total[ends] - total[starts]) * self._down[starts]

    @staticmethod
    def cut(units, a: int, b: int) -> bytes:
        raw, starts, ends = units
        return b" ".join(raw[starts[a]:ends[b - 1]].split())

    @staticmethod
    def windows(content: bytes, length: int) -> list[bytes]:
        words = content.split(b" ")
        return [b" ".join(words[i:i + length]) for i in range(len(words) - length + 1)]


_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[k]
    return h ^ (h >> np.uint64(29))


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` units, built from runs of 1, 2, 4 ... units."""
    h, size, out, have, left, level = codes, 1, None, 0, gram, 0
    while True:
        if left & 1:
            if out is None:
                out, have = h, size
            else:
                n = len(codes) - have - size + 1
                out = _mix(out[:n] * _ODD[40 + level] + h[have:have + n], level)
                have += size
        left >>= 1
        if not left:
            return _mix(out, 39)
        h = h[:-size] * _ODD[level] + h[size:]
        h ^= h >> np.uint64(31)
        size, level = 2 * size, level + 1


def window_anchors(hashes: np.ndarray, windows: int, width: int) -> np.ndarray:
    """For every window the place of the smallest hash among its ``width`` runs, leftmost first."""
    v = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = width - span
    return (np.minimum(v[:windows], v[rest:rest + windows]) & _POSITION).astype(np.int64)


def document_anchors(codes: np.ndarray, length: int, gram: int):
    """Start of a slice, and (hash, first window, last window) of each anchor in it."""
    total = len(codes) - length + 1
    slice_ = min(1 << 20, int(_POSITION) - length)
    for at in range(0, max(total, 0), slice_):
        part = codes[at:at + slice_ + length - 1]
        windows = len(part) - length + 1
        hashes = gram_hashes(part, gram)
        place = window_anchors(hashes, windows, length - gram + 1)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], windows] - 1
        yield at, hashes[place[first]], first, last


def packed(text: str = "text") -> Column:
    """A text as it travels through a shuffle: compressed on its own, null for null."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        return pd.Series([None if t is None else squeeze(t.encode("utf-8")) for t in texts], dtype="object")

    return pack(F.col(text))


def unpacked(body: bytes | None) -> str | None:
    return None if body is None else zstandard.ZstdDecompressor().decompress(body).decode("utf-8")


def text_key() -> tuple[Column, Column]:
    """128 bits that name a text."""
    return F.xxhash64("text"), F.xxhash64(F.lit("again"), F.col("text"))


def _named(docs: DataFrame, *more: str | Column) -> DataFrame:
    k1, k2 = text_key()
    return docs.select(*more, k1.alias("k1"), k2.alias("k2"))


def covered(docs: DataFrame, units: type, length: int, gram: int, solver: Callable, batch_bytes: int,
            hot: int = HOT) -> DataFrame:
    """k1, k2 (a text's name), starts, ends: stretches of units covered by windows that occur
    at least twice.  Documents without any are left out.

    ``solver(segments, weights, length)`` gets the distinct segments of whole anchor groups
    (bytes) with the number of their occurrences, and returns for each a boolean array: which of its
    windows occur at least twice in all."""
    ship_package(docs.sparkSession)

    def listing():
        kind = units()

        def step(cols):
            out = {n: [] for n in ("h", "k1", "k2", "n")}
            for k1, k2, text in zip(cols["k1"], cols["k2"], cols["text"]):
                _, codes = kind.read(text)
                for _, h, *_ in document_anchors(codes, length, gram):
                    h, n = np.unique(h, return_counts=True)
                    out["h"] += h.view(np.int64).tolist()
                    out["n"] += n.tolist()
                    out["k1"] += [k1] * len(h)
                    out["k2"] += [k2] * len(h)
            return out

        return step

    listed = map_batches(_named(docs, "text"), listing, "h long, k1 long, k2 long, n int")
    totals = listed.groupBy("h").agg(F.sum("n").alias("total")).filter("total > 1")
    wanted = written(listed.join(totals, "h").groupBy("k1", "k2")
                     .agg(F.collect_set(F.struct("h", (F.col("total") > hot).alias("hot"))).alias("wanted")))
    texts = (_named(docs, packed().alias("body")).groupBy("k1", "k2")
             .agg(F.first("body").alias("body"), F.count(F.lit(1)).alias("copies")).join(wanted, ["k1", "k2"]))

    def cut(kind, body, want):
        """(key, sid) -> content and first windows of a text's segments."""
        pieces, codes = kind.read(unpacked(body))
        hashes = np.array(sorted(w["h"] for w in want), np.int64).view(np.uint64)
        found: dict = {}
        for at, h, first, last in document_anchors(codes, length, gram):
            for i in np.flatnonzero(np.isin(h, hashes)).tolist():
                key, x, y = int(h[i:i + 1].view(np.int64)[0]), at + int(first[i]), at + int(last[i])
                content = kind.cut(pieces, x, y + length)
                found.setdefault((key, xxh3_128_digest(content)), (content, []))[1].append(x)
        return found

    def cutting():
        kind, sent = units(), set()  # segments whose content this task has sent

        def step(cols):
            out = {n: [] for n in ("key", "sid", "k1", "k2", "firsts", "weight", "hot", "content")}
            for k1, k2, body, copies, want in zip(*(cols[n] for n in ("k1", "k2", "body", "copies", "wanted"))):
                many = {w["h"] for w in want if w["hot"]}
                for name, (content, firsts) in cut(kind, body, want).items():
                    row = (*name, k1, k2, firsts, copies * len(firsts), name[0] in many, None if name in sent else content)
                    for n, v in zip(out, row):
                        out[n].append(v)
                    sent.add(name)
            if len(sent) > 300_000:
                sent.clear()
            return out

        return step

    # each text is cut once: its places, and the contents that they are the first to show in a task
    pieces = written(map_batches(texts.select("k1", "k2", "body", "copies", "wanted"), cutting,
                                 "key long, sid binary, k1 long, k2 long, firsts array<int>, weight long, hot boolean, content binary", rows=256))
    places = pieces.select("key", "sid", "k1", "k2", "firsts")

    def segments(of_hot):
        return pieces.filter(F.col("hot") if of_hot else ~F.col("hot")).select("key", "sid", "content", "weight")

    def solve(batches):
        # whole groups are solved together up to batch_bytes; a group that is larger is solved on its own
        held, size, group, more, key = [], 0, [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)):
                    if row[0] != key:
                        if size + more > batch_bytes and held:
                            yield _solved(held, length, solver, units)
                            held, size = [], 0
                        held.extend(group)
                        size, group, more, key = size + more, [], 0, row[0]
                    group.append(row)
                    more += len(row[2] or b"") + 16
        if size + more > batch_bytes and held:
            yield _solved(held, length, solver, units)
            held = []
        yield _solved(held + group, length, solver, units)

    answers = (segments(False).repartition("key").sortWithinPartitions("key", "sid")
               .mapInArrow(solve, "key long, sid binary, runs array<struct<a:int,b:int>>"))
    if not pieces.filter("hot").isEmpty():
        answers = answers.unionByName(_counted(segments(True), units, length))
    stretch = F.flatten(F.transform("firsts", lambda f: F.transform("runs", lambda r: F.struct((f + r["a"]).alias("a"), (f + r["b"]).alias("b")))))
    found = places.join(answers, ["key", "sid"]).groupBy("k1", "k2").agg(F.flatten(F.collect_list(stretch)).alias("s"))
    return found.select("k1", "k2", F.col("s.a").alias("starts"), F.col("s.b").alias("ends"))


def _names(contents: list[bytes], units: type, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit names of all windows of some segments, and where each segment's begin."""
    names = [[xxh3_128_digest(w) for w in units.windows(c, length)] for c in contents]
    return np.frombuffer(b"".join(x for n in names for x in n), "S16"), np.cumsum([0] + [len(n) for n in names])


def _parts(names: np.ndarray, bits: int) -> np.ndarray:
    """The part of each name, by its first bits."""
    return (names.view(np.uint8).reshape(-1, 16)[:, :4].copy().view(">u4").reshape(-1).astype(np.int64) >> (32 - bits)) if bits else np.zeros(len(names), np.int64)


def _counted(segments: DataFrame, units: type, length: int) -> DataFrame:
    """key, sid, runs: the covered stretches of segments, from the occurrences of each of their windows.

    Distinct segments are put into blocks.  A block sends its windows' names, each once with its number and packed by part, and gets back a bit
    for each: whether it occurs twice or more in all blocks.  No window travels with its place."""
    distinct = segments.groupBy("key", "sid").agg(F.first("content", ignorenulls=True).alias("content"), F.sum("weight").alias("weight"))

    def blocking():
        held = {n: [] for n in ("key", "sid", "content", "weight")}
        size = [0]

        def block():
            out = {"block": [uuid.uuid4().hex], "windows": [size[0]]} | {n: [list(v)] for n, v in held.items()}
            for v in held.values():
                v.clear()
            size[0] = 0
            return out

        def step(cols):
            done: dict = {n: [] for n in ("block", "windows", *held)}
            for row in zip(*(cols[n] for n in held)):
                for n, v in zip(held, row):
                    held[n].append(v)
                size[0] += len(row[2]) if units is Bytes else row[2].count(b" ") + 1
                if size[0] >= BLOCK:
                    done = {n: done[n] + v for n, v in block().items()}
            return done

        step.rest = lambda: [block()] if held["key"] else []
        return step

    blocks = written(map_batches(distinct, blocking, "block string, windows long, key array<long>, sid array<binary>, content array<binary>, weight array<long>"))
    bits = min(32, ((blocks.agg(F.sum("windows")).first()[0] or 0) // PART).bit_length())

    def sending():
        def step(cols):
            out = {n: [] for n in ("part", "block", "names", "counts")}
            for name, contents, weights in zip(cols["block"], cols["content"], cols["weight"]):
                names, start = _names(contents, units, length)
                names, inverse = np.unique(names, return_inverse=True)
                counts = np.bincount(inverse, np.repeat(weights, np.diff(start)), len(names)).astype("<i8")
                part = _parts(names, bits)
                first = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
                for a, b in zip(first, [*first[1:], len(part)]):
                    for n, v in zip(out, (int(part[a]), name, names[a:b].tobytes(), counts[a:b].tobytes())):
                        out[n].append(v)
            return out

        return step

    def adding():
        held: list = []
        now = [None]

        def answers():
            out = {n: [] for n in ("part", "block", "twice")}
            if held:
                names = np.frombuffer(b"".join(n for _, n, _ in held), "S16")
                _, inverse = np.unique(names, return_inverse=True)
                twice = np.bincount(inverse, np.frombuffer(b"".join(c for *_, c in held), "<i8"))[inverse] > 1
                for (block, n, _), bits_ in zip(held, np.split(twice, np.cumsum([len(n) // 16 for _, n, _ in held])[:-1])):
                    for k, v in zip(out, (now[0], block, np.packbits(bits_).tobytes())):
                        out[k].append(v)
                held.clear()
            return out

        def step(cols):
            done: dict = {n: [] for n in ("part", "block", "twice")}
            for part, *row in zip(*(cols[n] for n in ("part", "block", "names", "counts"))):
                if part != now[0]:
                    done = {n: done[n] + v for n, v in answers().items()}
                    now[0] = part
                held.append(row)
            return done

        step.rest = lambda: [answers()]
        return step

    def joining():
        def step(cols):
            out = {n: [] for n in ("key", "sid", "runs")}
            for keys, sids, contents, told in zip(cols["key"], cols["sid"], cols["content"], cols["told"]):
                names, start = _names(contents, units, length)
                names, inverse = np.unique(names, return_inverse=True)
                parts, sizes = np.unique(_parts(names, bits), return_counts=True)
                flags = {t["part"]: t["twice"] for t in told}
                twice = np.concatenate([np.unpackbits(np.frombuffer(flags[p], np.uint8), count=n) for p, n in zip(parts.tolist(), sizes.tolist())])[inverse]
                for key, sid, a, b in zip(keys, sids, start, start[1:]):
                    edge = np.flatnonzero(np.diff(twice[a:b].astype(np.int8), prepend=0, append=0))
                    runs = union(list(zip(edge[::2].tolist(), (edge[1::2] - 1 + length).tolist())))
                    if runs:
                        for n, v in zip(out, (key, sid, [{"a": x, "b": y} for x, y in runs])):
                            out[n].append(v)
            return out

        return step

    sent = map_batches(blocks.select("block", "content", "weight"), sending, "part long, block string, names binary, counts binary", rows=1)
    told = map_batches(sent.repartition("part").sortWithinPartitions("part"), adding, "part long, block string, twice binary", rows=16)
    told = told.groupBy("block").agg(F.collect_list(F.struct("part", "twice")).alias("told"))
    back = blocks.select("block", "key", "sid", "content").join(told, "block")
    return map_batches(back, joining, "key long, sid binary, runs array<struct<a:int,b:int>>", rows=1)


def _solved(rows, length, solver, units):
    """The covered stretches inside every segment of whole anchor groups that has any."""
    weight: dict = {}
    content: dict = {}
    groups: dict = {}
    for key, sid, text, n in rows:
        weight[key, sid] = weight.get((key, sid), 0) + n
        if text is not None:
            content[key, sid] = text
        groups.setdefault(key, set()).add(sid)
    # Equal segments are one string with a weight; alone in its group, a segment repeats by its weight only.
    several = [(k, s) for k, sids in groups.items() if len(sids) > 1 for s in sorted(sids)]
    runs: dict = {}
    if several:
        answers = solver([content[x] for x in several], np.array([weight[x] for x in several]), length)
        for x, windows in zip(several, answers):
            edge = np.flatnonzero(np.diff(np.r_[0, windows.view(np.int8), 0]))
            runs[x] = union(list(zip(edge[::2].tolist(), (edge[1::2] - 1 + length).tolist())))
    for key, sids in groups.items():
        x = (key, next(iter(sids)))
        if len(sids) == 1 and weight[x] > 1:
            runs[x] = [(0, len(content[x]) if units is Bytes else content[x].count(b" ") + 1)]
    out = [(k, s, [{"a": a, "b": b} for a, b in r]) for (k, s), r in runs.items() if r]
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                                       pa.array([o[2] for o in out], kind)], ["key", "sid", "runs"])


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches of overlapping or touching ones."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def apply_spans(docs: DataFrame, spans: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make()(text, stretches)`` per document, as the columns of ``schema`` after doc_id."""
    names = [f.split()[0] for f in schema.split(", ")]
    bodies = _named(docs, "doc_id", packed().alias("body"))
    joined = bodies.join(spans, ["k1", "k2"], "left").select("doc_id", "body", "starts", "ends")

    def run():
        one = make()

        def step(cols):
            rows = [one(unpacked(t), union(list(zip(a or (), b or ())))) for t, a, b in zip(cols["body"], cols["starts"], cols["ends"])]
            return {"doc_id": cols["doc_id"]} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

        return step

    return map_batches(joined, run, "doc_id long, " + schema, rows=256)

"""Exact substring deduplication over merged Burrows-Wheeler transforms (operator 1).

A text is its UTF-8 bytes.  A byte is removed if a string of ``length`` bytes covers it that also
starts anywhere else, in the same document or another; matches never cross documents,
overlaps count, and strings are judged on the input, not on what is left.

``anchors`` brings the segments that may share such strings together.  In a task, the
distinct segments are dealt to shards and each shard's suffixes are sorted once, giving its
Burrows-Wheeler transform.  The transforms are then merged without sorting suffixes again: an
interleave vector (which shard the next suffix comes from) starts as one shard after the other and
is refined by passing it through the transforms, stably by symbol; after h passes it is the
order of all suffixes by their first h symbols.  Boundaries found in a pass part suffixes that agree on
fewer symbols: this is the common-prefix array, cut off at the window.  Intervals without a
boundary are the repeated strings; the number of copies of their segments tells how often they occur.

A symbol is a run of ``stride`` bytes (its rank among the task's runs), so a text is read as
``stride`` interleaved strings and ``length / stride`` passes reach the whole window, instead of
one pass per byte.  Ranks are those of a hash, checked against the bytes.

Input: ``doc_id``, ``text``; other columns are ignored.  A null or empty text has no bytes: nothing
removed, nothing kept.  Repeated rows are documents of their own: texts of ``length`` bytes or
more are then repeated throughout.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from essayspark.llm.anchors import Bytes, apply_spans, covered, gram_hashes

LENGTH, GRAM, STRIDE = 400, 128, 100
SHARDS = 4
BATCH_BYTES = 1_500_000
#: Segments of one anchor beyond which its windows are counted one by one: about 5 MB of text at most meet in a solver.
HOT = 8_000
#: Places hashed at a time, and runs compared with their first at a time.
SLICE, CHECKED = 1 << 18, 1 << 15


def _sorted_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of small non-negative integers, and the sorted integers."""
    bits = np.int64(max(len(key) - 1, 1).bit_length())
    packed = key.astype(np.int64)
    packed <<= bits
    packed |= np.arange(len(key), dtype=np.int32)
    packed.sort()
    order, key = np.empty(len(packed), np.int32), np.empty(len(packed), np.int32)
    np.bitwise_and(packed, (np.int64(1) << bits) - 1, out=order, casting="unsafe")
    np.right_shift(packed, bits, out=key, casting="unsafe")
    return order, key


def run_ranks(raw: np.ndarray, valid: np.ndarray, stride: int) -> np.ndarray:
    """For each valid place the rank (from 1 on) of its run of ``stride`` bytes; 0 elsewhere."""
    out = np.zeros(len(raw), np.int32)
    at = np.flatnonzero(valid).astype(np.int32)
    if not len(at):
        return out
    h = np.empty(len(at), np.uint64)
    for a in range(0, len(raw) - stride + 1, SLICE):
        x, y = np.searchsorted(at, [a, a + SLICE])
        h[x:y] = gram_hashes(Bytes._codes[raw[a:a + SLICE + stride - 1]], stride)[at[x:y] - a]
    order = np.argsort(h).astype(np.int32)
    h = h[order]
    place, rank = at[order], np.cumsum(np.r_[True, h[1:] != h[:-1]], dtype=np.int32)
    del h, order
    first = place[np.flatnonzero(np.diff(rank, prepend=0))]  # of each rank
    runs = np.lib.stride_tricks.sliding_window_view(raw, stride)
    if all((runs[place[a:a + CHECKED]] == runs[first[rank[a:a + CHECKED] - 1]]).all() for a in range(0, len(place), CHECKED)):
        out[place] = rank
    else:  # two runs share a hash: rank the bytes themselves
        out[at] = np.unique(runs[at], axis=0, return_inverse=True)[1].reshape(-1) + 1
    return out


class Strings:
    """Segments laid out one after the other; a place is a suffix of one of the interleaved strings."""

    def __init__(self, contents: list[bytes], stride: int):
        self.size = np.array([len(c) for c in contents], np.int64)
        self.start = np.cumsum(np.r_[0, self.size + 1])[:-1]  # one place for the empty suffix at the end
        raw = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
        self.n, self.stride = len(raw), stride
        self.of = np.repeat(np.arange(len(contents), dtype=np.int32), self.size + 1)
        self.inside = np.arange(self.n, dtype=np.int32)
        self.inside -= self.start.astype(np.int32)[self.of]
        self.symbol = run_ranks(raw, self.inside + np.int32(stride) <= self.size.astype(np.int32)[self.of], stride)

    def transform(self, segments: np.ndarray):
        """Sorted suffixes of some segments, and their Burrows-Wheeler transform: the symbol before each, 0 at a start."""
        places = np.concatenate([np.arange(self.start[s], self.start[s] + self.size[s] + 1, dtype=np.int32) for s in segments])
        where = np.zeros(self.n, np.int32)
        where[places] = np.arange(1, len(places) + 1)  # place -> row, from 1 on
        rank, step = self.symbol[places], self.stride
        rest = self.size.astype(np.int32)[self.of[places]] - self.inside[places]
        longest = int(self.size[segments].max())
        while step <= longest:
            follows = rest >= step
            after = np.zeros(len(places), np.int64)
            after[follows] = rank[where[places[follows] + step] - 1] + np.int64(1)
            after += rank * np.int64(int(after.max()) + 1)
            _, pair = np.unique(after, return_inverse=True)
            rank, step = pair.reshape(-1).astype(np.int32), 2 * step
        order, _ = _sorted_order(rank)
        suffixes = places[order]
        before = np.where(self.inside[suffixes] >= self.stride, self.symbol[suffixes - np.int32(self.stride)], np.int32(0))
        return suffixes, before


def merge(transforms: list[tuple[np.ndarray, np.ndarray]], passes: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all shards in the order of their first ``passes`` symbols, and the number of the interval
    of suffixes that agree on all of these, by interleave refinement."""
    sizes = [len(s) for s, _ in transforms]
    interleave = np.repeat(np.arange(len(sizes), dtype=np.int16), sizes)
    interval = np.zeros(sum(sizes), np.int32)
    for _ in range(passes):
        symbol = np.empty(len(interleave), np.int32)
        for s, (_, before) in enumerate(transforms):
            symbol[interleave == s] = before
        order, symbol = _sorted_order(symbol)
        interleave, interval = interleave[order], interval[order]
        # a boundary: other symbol, other interval before, or an end of a string (ends never agree)
        interval = np.cumsum(np.r_[False, (np.diff(symbol) != 0) | (np.diff(interval) != 0) | (symbol[1:] == 0)], dtype=np.int32)
    suffixes = np.empty(len(interleave), np.int32)
    for s, (mine, _) in enumerate(transforms):
        suffixes[interleave == s] = mine
    return suffixes, interval


def repeated_strings(contents: list[bytes], weights: np.ndarray, length: int, stride: int = STRIDE, shards: int = SHARDS) -> list[np.ndarray]:
    """Per segment: which of its strings of ``length`` bytes occur at least twice."""
    stride = next(s for s in range(min(stride, length), 0, -1) if length % s == 0)
    strings = Strings(contents, stride)
    dealt = [np.arange(k, len(contents), shards) for k in range(min(shards, len(contents)))]
    suffixes, interval = merge([strings.transform(d) for d in dealt], length // stride)
    total = np.bincount(interval, weights=weights[strings.of[suffixes]])
    twice = np.zeros(strings.n, bool)
    twice[suffixes] = total[interval] >= 2
    return [twice[a:a + n - length + 1] for a, n in zip(strings.start.tolist(), strings.size.tolist())]


def _kept():
    def one(text, stretches):
        raw = (text or "").encode("utf-8")
        kept, at = [], 0
        for a, b in stretches:
            kept.append(raw[at:a])
            at = b
        kept = b"".join([*kept, raw[at:]])
        return len(raw), len(raw) - len(kept), len(stretches), kept

    return one


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES,
                          hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the other bytes; cutting may
    split a character, so they are binary)."""
    spans = covered(docs, Bytes, length, gram, repeated_strings, batch_bytes, hot)
    return apply_spans(docs, spans, _kept, "n_bytes long, n_removed long, n_spans long, kept binary")

"""Substring deduplication with a compressed FM-index per shard (operator 5).

Words are what stands between ASCII white space, unchanged.  A window is ``length``
consecutive words of one document.  A word is removed if it lies in a window whose word
sequence starts anywhere else too, in the same document or another; windows are judged on
the input, not on what is left.

``anchors`` brings documents' segments that may share windows into one shard.  The
shard's distinct segments are indexed by an FM-index: the Burrows-Wheeler transform of the
segments, as a wavelet matrix of bit vectors with popcount ranks, and the weights of
the suffixes as a running sum, so an interval tells how often its words occur.  Then the
segments are streamed through it by backward search, all in lock step: each tries to match from
its end; where the interval's weight falls under two, the match that is left is the
matching statistic there, and the windows that contain the failing stretch are out.

Input: ``doc_id``, ``text``; other columns are ignored.  A null or empty text has no words,
nothing to remove, kept text "".  Repeated rows are documents of their own: texts of ``length`` words
or more are then repeated throughout.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.anchors import HOT, Words, apply_spans, covered, packed, text_key, union, unpacked
from essayspark.llm.common import free_names

LENGTH, GRAM = 35, 12
BATCH_BYTES = 4_000_000


class WaveletMatrix:
    """Rank over a sequence of small integers, one bit vector per bit, packed into 64-bit words."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, (sigma - 1).bit_length())
        self.levels = []
        for level in reversed(range(self.bits)):
            bit = (seq >> level) & 1
            n = len(seq) // 64 + 1
            padded = np.zeros(64 * n, np.uint8)
            padded[: len(seq)] = bit
            words = np.packbits(padded.reshape(-1, 8), axis=1, bitorder="little").reshape(-1).view("<u8")
            before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)][:-1]
            zeros = len(seq) - int(bit.sum())
            self.levels.append((level, words, before, zeros))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place on the last level of the first ``at`` entries that equal ``symbol``."""
        for level, words, before, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(words[block] & mask)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """FM-index of weighted segments (arrays of symbols from 1 on); 0 stands between segments."""

    def __init__(self, segments: list[np.ndarray], weights: np.ndarray, sigma: int):
        longest = max(map(len, segments))
        zero = np.zeros(1, np.int64)
        self.text = np.concatenate([x for s in segments for x in (s, zero)])
        self.start = np.cumsum([0] + [len(s) + 1 for s in segments])[:-1]
        n = len(self.text)
        weight = np.repeat(weights, [len(s) + 1 for s in segments])
        rank, size = self.text, 1
        while size <= longest:  # order by the first 1, 2, 4 ... symbols; equal beyond a segment's length does not matter
            after = np.zeros(n, np.int64)
            after[: n - size] = rank[size:] + 1
            key = rank * (int(after.max()) + 1) + after
            order = np.argsort(key, kind="stable")
            step = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
            rank = np.empty(n, np.int64)
            rank[order] = step
            size *= 2
            if step[-1] == n - 1:
                break
        suffixes = np.argsort(rank, kind="stable")
        self.matrix = WaveletMatrix(self.text[suffixes - 1], sigma)
        self.weight = np.r_[0, np.cumsum(weight[suffixes])]
        # LF(c, i) = C[c] + rank_c(i): both offsets of a symbol in one table
        symbols = np.arange(sigma)
        smaller = np.r_[0, np.cumsum(np.bincount(self.text, minlength=sigma))][:-1]
        self.offset = smaller - self.matrix.descend(symbols, np.zeros(sigma, np.int64))
        self.n = n

    def prepend(self, symbol, lo, hi):
        """The interval of the suffixes that start with ``symbol`` and then an entry of [lo, hi)."""
        ends = self.matrix.descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.tile(self.offset[symbol], 2)
        return ends[: len(symbol)], ends[len(symbol):]


def repeated_windows(contents: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """Per segment: which of its windows of ``length`` words occur at least twice."""
    ids: dict[bytes, int] = {}
    segments = [np.array([ids.setdefault(w, len(ids) + 1) for w in c.split(b" ")], np.int64) for c in contents]
    index = FMIndex(segments, weights, len(ids) + 1)
    size = np.array([len(s) for s in segments])
    windows = size - length + 1
    good = [np.zeros(w, bool) for w in windows.tolist()]
    live = np.arange(len(segments))
    first = np.zeros(len(live), np.int64)          # the first window that is not decided
    stop = windows.copy()                          # windows from here on are decided
    reach = windows.copy()                         # windows that the attempt under way covers
    end = size - 1                                 # its last word
    at = end.copy()                                # the word that comes next
    lo, hi = np.zeros(len(live), np.int64), np.full(len(live), index.n, np.int64)
    whole = np.ones(len(live), bool)               # the first attempt covers all of the segment
    while len(live):
        nlo, nhi = index.prepend(index.text[index.start[live] + at[live]], lo[live], hi[live])
        twice = index.weight[nhi] - index.weight[nlo] >= 2
        lo[live], hi[live] = nlo, nhi
        reached = twice & (at[live] == first[live])
        at[live[twice]] -= 1
        for s in live[reached].tolist():           # the whole attempt occurs twice
            good[s][first[s]:end[s] - length + 2] = True
        failed = live[~twice]
        for s in failed[end[failed] - at[failed] >= length].tolist():
            good[s][at[s] + 1:end[s] - length + 2] = True
        # windows that contain the failing stretch are out; with one window tried, all up to its start
        one = reach[failed] == 1
        w = failed[whole[failed]]
        stop[w] = np.minimum(stop[w], at[w] + 1)
        first[failed[one]] = at[failed[one]] + 1
        reach[failed] = 1
        done = live[reached]
        first[done] = end[done] - length + 2
        reach[done] *= 2
        again = np.concatenate([failed, done])
        whole[again] = False
        end[again] = np.minimum(first[again] + length - 1 + np.minimum(reach[again], np.maximum(stop[again] - first[again], 1)) - 1, size[again] - 1)
        reach[again] = end[again] - length + 2 - first[again]
        at[again], lo[again], hi[again] = end[again], 0, index.n
        live = live[first[live] < stop[live]]
    return good


def _kept():
    def one(text, stretches):
        words = (text or "").encode("utf-8").split()
        kept, at = [], 0
        for a, b in stretches:
            kept += words[at:a]
            at = b
        kept += words[at:]
        return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")

    return one


def remove_repeated_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES,
                          hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words, joined by one space)."""
    spans = covered(docs, Words, length, gram, repeated_windows, batch_bytes, hot)
    return apply_spans(docs, spans, _kept, "n_words long, n_removed long, kept string")


def replace_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """The rows of ``docs``, all columns, with the kept words as ``text`` and ``n_chars``, if there, its new length.
    A null text stays null."""
    spans = covered(docs, Words, length, gram, repeated_windows, batch_bytes, hot)
    k1, k2 = text_key()

    @F.pandas_udf("string")
    def kept(bodies: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        one = _kept()
        return pd.Series([unpacked(t) if a is None else one(unpacked(t), union(list(zip(a.tolist(), b.tolist()))))[2]
                          for t, a, b in zip(bodies, starts, ends)], dtype="object")

    a1, a2, starts, ends, b1, b2, body = free_names(docs, *spans.columns, "b1", "b2", "body")
    moved = docs.withColumns({b1: k1, b2: k2, body: packed()}).drop("text")
    joined = moved.join(spans.toDF(a1, a2, starts, ends), (F.col(a1) == F.col(b1)) & (F.col(a2) == F.col(b2)), "left")
    joined = joined.withColumn("text", kept(body, starts, ends))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast("long"))
    return joined.select(docs.columns)

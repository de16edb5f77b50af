"""Phrase collocation mining by Rabin-Karp fingerprints (operator 11).

A phrase of some words is a collocation if it occurs more often than its parts would by themselves:
score = floor(SCALE * a * a / (l * r)), with a its occurrences and l, r those of the two parts of its worst cut.

1. Texts become rows of word numbers, a *chunk* of about ``CHUNK`` words each (its own vocabulary beside it), written
   to the shared folder.  Ends of pieces and of texts are the number 0, which no n-gram may hold.
2. Every chunk hashes all its n-grams of 1 to ``max_words`` words at once: a word's 64-bit hash times a power of an odd
   base, cumulative sums modulo 2**64 (prefix polynomials), and a window's sum times the inverse power is its fingerprint.  Distinct
   fingerprints with their counts are packed by ranges of the fingerprint and shuffled there; the chunk's number
   is the pointer to their occurrences.
3. A range adds up its counts and answers each chunk with those of its fingerprints that are frequent.
4. The chunk verifies them against its text: occurrences of a frequent fingerprint are counted by their words, so two phrases that
   share a fingerprint come apart again, and only these phrases become strings.  They go to their range, sorted and compressed,
   where their exact counts are added by the phrase itself.
5. Parts, containment and ranks are joins and aggregates over the frequent phrases: every part of a frequent phrase is
   frequent itself.

Rows shuffled are distinct n-grams of a chunk (about 7 bytes each), so a very frequent word or phrase is one entry per chunk.  Nothing
is broadcast; the number of ranges follows the number of n-grams, so that one holds about ``RANGE`` of them.

Null text counts as empty, null lang as ``und``.  Repeated rows count each time; an empty table, or one without frequent phrases,
gives an empty table; other columns are ignored.  Very long texts run over several chunks, whose n-grams overlap without counting twice.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches, written

MIN_COUNT, MAX_WORDS, TOP, CONTAINED_PERCENT, SCALE = 10, 3, 2000, 50, 1_000_000
NO_LANG = "und"
#: Words of a chunk, bytes of text that are split into words at once, n-grams of a range of fingerprints.
CHUNK, SLICE, RANGE = 1_000_000, 1 << 20, 2_000_000
#: Parts that a language's phrases are ranked in before the last ranking.
RANK_PARTS = 32

#: Ends of pieces become " . "; tabs are blanks; letters of ASCII are lowered.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 46 if b in _ENDS else 32 if b == 9 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Numbers(dict):
    """Words to numbers from 1; the end of a piece is 0."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def word_numbers(text: str | None, numbers: _Numbers) -> Iterator[np.ndarray]:
    """The words of a text as numbers, slice by slice, 0 between pieces."""
    raw = (text or "").encode("utf-8").translate(_BYTES)
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > SLICE:  # a slice ends at a blank or at the end of a piece
            end = min((x for x in (raw.find(b" ", at + SLICE), raw.find(b".", at + SLICE)) if x >= 0), default=end)
        words = raw[at:end].replace(b".", b" . ").split(b" ")
        words = [w for w in words if w]
        yield np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        at = end


def _new_numbers() -> _Numbers:
    out = _Numbers()
    out[b"."] = 0
    return out


def fingerprints(ids: np.ndarray, hashes: np.ndarray, n: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (before ``starts``) of the n-grams without a 0, and their fingerprints."""
    size = min(len(ids) - n + 1, starts)
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(ids == 0)])
    at = np.flatnonzero(ends[n : n + size] == ends[:size])
    power, inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(ids), b, np.uint64)])) for b in (_BASE, _INVERSE))
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(hashes[ids] * power[:-1])])
    fp = (prefix[at + n] - prefix[at]) * inverse[at]
    # lengths differ and high bits are mixed: they choose the range
    fp = (fp + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
    return at, fp ^ (fp >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _loose(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers by as many low bytes as the largest one needs, byte by byte, compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return _squeeze(bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    raw = _loose(raw)
    width = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _gaps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


def _chunks(max_words: int, size: int):
    """Step for ``map_batches``: lang, text to chunks; the last max_words - 1 words of a full one also begin the next."""

    def make():
        numbers: dict[str, _Numbers] = {}
        held: dict[str, list[np.ndarray]] = {}
        length: dict[str, int] = {}

        def cut(out: dict, lang: str, last: bool) -> None:
            ids = np.concatenate(held[lang]) if held[lang] else np.zeros(0, np.int32)
            words = list(numbers[lang])
            keep = 0 if last else min(max_words - 1, len(ids))
            own = len(ids) - keep
            for k, v in (("chunk", uuid.uuid4().hex), ("lang", lang), ("ids", pack(ids)), ("vocabulary", _squeeze(b" ".join(words[1:]))),
                         ("starts", own), ("words", int(np.count_nonzero(ids[:own]))), ("ngrams", max_words * own)):
                out[k].append(v)
            numbers[lang] = fresh = _new_numbers()
            held[lang] = [np.fromiter((fresh[words[i]] for i in ids[own:].tolist()), np.int32, keep)]
            length[lang] = keep

        def step(cols):
            out = {k: [] for k in ("chunk", "lang", "ids", "vocabulary", "starts", "words", "ngrams")}
            for lang, text in zip(cols["lang"], cols["text"]):
                lang = NO_LANG if lang is None else lang
                if lang not in held:
                    numbers[lang], held[lang], length[lang] = _new_numbers(), [], 0
                for ids in word_numbers(text, numbers[lang]):
                    held[lang].append(ids)
                    length[lang] += len(ids)
                    if length[lang] >= size:
                        cut(out, lang, False)
                held[lang].append(np.zeros(1, np.int32))
                length[lang] += 1
                if sum(length.values()) >= 2 * size:  # many languages at once
                    for other in [x for x in held if length[x]]:
                        cut(out, other, True)
                        held[other], length[other] = [], 0
            return out

        def rest():
            for lang in held:
                if length[lang]:
                    out = {k: [] for k in ("chunk", "lang", "ids", "vocabulary", "starts", "words", "ngrams")}
                    cut(out, lang, True)
                    yield out

        step.rest = rest
        return step

    return make


def _read(ids: bytes, vocabulary: bytes) -> tuple[np.ndarray, list[bytes]]:
    words = _loose(vocabulary)
    return unpack(ids).astype(np.int32), [b"."] + (words.split(b" ") if words else [])


def _ranges(prints: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Number, begin and end of each range of sorted fingerprints, by their first bits."""
    part = (prints >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(prints), np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    yield from ((int(part[a]), a, b) for a, b in zip(cuts, [*cuts[1:], len(part)]))


def _send(max_words: int, bits: int):
    """Step for ``map_batches``: a chunk's distinct fingerprints and counts, packed by range."""

    def make():
        def step(cols):
            out = {k: [] for k in ("lang", "part", "chunk", "prints", "counts")}
            for lang, chunk, ids, vocabulary, starts in zip(cols["lang"], cols["chunk"], cols["ids"], cols["vocabulary"], cols["starts"]):
                ids, words = _read(ids, vocabulary)
                hashes = word_hashes(words)
                for n in range(1, max_words + 1):
                    prints, counts = np.unique(fingerprints(ids, hashes, n, starts)[1], return_counts=True)
                    for part, a, b in _ranges(prints, bits):
                        for k, v in (("lang", lang), ("part", part), ("chunk", chunk), ("prints", pack(_gaps(prints[a:b]))), ("counts", pack(counts[a:b]))):
                            out[k].append(v)
            return out

        return step

    return make


def _answer(min_count: int):
    """Step for ``map_batches`` over rows sorted by lang and part: to each chunk its frequent fingerprints."""

    def make():
        held: list[tuple] = []
        now = [None]

        def rows():
            out = {"chunk": [], "prints": []}
            if held:
                prints = [np.cumsum(unpack(p)) for _, p, _ in held]
                counts = np.concatenate([unpack(c) for _, _, c in held]).astype(np.int64)
                every = np.concatenate(prints)
                order = np.argsort(every, kind="stable")
                first = np.flatnonzero(np.diff(every[order], prepend=~every[order[0]]))
                sums = np.add.reduceat(counts[order], first)
                frequent = np.zeros(len(every), bool)
                frequent[order] = np.repeat(sums >= min_count, np.diff(first, append=len(every)))
                for (chunk, _, _), p, mine in zip(held, prints, np.split(frequent, np.cumsum([len(p) for p in prints])[:-1])):
                    if mine.any():
                        out["chunk"].append(chunk)
                        out["prints"].append(pack(_gaps(p[mine])))
                held.clear()
            return out

        def step(cols):
            done = {"chunk": [], "prints": []}
            for lang, part, chunk, prints, counts in zip(*(cols[k] for k in ("lang", "part", "chunk", "prints", "counts"))):
                if now[0] != (lang, part):
                    for k, v in rows().items():
                        done[k] += v
                    now[0] = lang, part
                held.append((chunk, prints, counts))
            return done

        step.rest = lambda: [rows()]
        return step

    return make


def verified(ids: np.ndarray, words: list[bytes], starts: int, max_words: int, frequent: np.ndarray, hashes: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Fingerprints (sorted), phrases and occurrences of all n-grams whose fingerprint is in ``frequent`` (sorted), for each n."""
    hashes = word_hashes(words) if hashes is None else hashes
    mask = np.uint64((1 << 22) - 1)  # a quick first look; the search decides
    look = np.zeros(1 << 22, bool)
    look[(frequent & mask).astype(np.int64)] = True
    for n in range(1, max_words + 1):
        at, fp = fingerprints(ids, hashes, n, starts)
        maybe = look[(fp & mask).astype(np.int64)]
        at, fp = at[maybe], fp[maybe]
        there = frequent[np.minimum(np.searchsorted(frequent, fp), len(frequent) - 1)] == fp
        at, fp = at[there], fp[there]
        if not len(at):
            continue
        code = ids[at].astype(np.int64)
        for j in range(1, n):  # equal codes are equal words
            code = np.unique(code, return_inverse=True)[1] * np.int64(len(words)) + ids[at + j]
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        order = np.argsort(fp[first], kind="stable")
        first, counts = first[order], counts[order]
        yield fp[first], [b" ".join([words[i] for i in row]) for row in np.stack([ids[at[first] + j] for j in range(n)], 1).tolist()], counts


def _verify(max_words: int, bits: int):
    """Step for ``map_batches``: a chunk's frequent phrases and their occurrences, packed by range of the fingerprint."""

    def make():
        def step(cols):
            out = {k: [] for k in ("lang", "part", "phrases", "counts")}
            for lang, ids, vocabulary, starts, answers in zip(cols["lang"], cols["ids"], cols["vocabulary"], cols["starts"], cols["answers"]):
                ids, words = _read(ids, vocabulary)
                frequent = np.sort(np.concatenate([np.cumsum(unpack(a)) for a in answers]))
                for prints, phrases, counts in verified(ids, words, starts, max_words, frequent):
                    counts = counts.tolist()
                    for part, a, b in _ranges(prints, bits):
                        some = sorted(zip(phrases[a:b], counts[a:b]))  # neighbours share beginnings
                        for k, v in (("lang", lang), ("part", part), ("phrases", _squeeze(b"\n".join([p for p, _ in some]))), ("counts", pack(np.array([c for _, c in some], np.uint64)))):
                            out[k].append(v)
            return out

        return step

    return make


def _add(min_count: int):
    """Step for ``map_batches`` over rows sorted by lang and part: phrases that are frequent by their words."""

    def make():
        sums: Counter = Counter()
        now = [None]

        def rows():
            found = [(p, n) for p, n in sums.items() if n >= min_count]
            sums.clear()
            return {"lang": [now[0] and now[0][0]] * len(found), "phrase": [p.decode("utf-8") for p, _ in found],
                    "k": [p.count(b" ") + 1 for p, _ in found], "f": [n for _, n in found]}

        def step(cols):
            done: dict = {k: [] for k in ("lang", "phrase", "k", "f")}
            for lang, part, phrases, counts in zip(cols["lang"], cols["part"], cols["phrases"], cols["counts"]):
                if now[0] != (lang, part):
                    done = {k: done[k] + v for k, v in rows().items()}
                    now[0] = lang, part
                for p, n in zip(_loose(phrases).split(b"\n"), unpack(counts).tolist()):
                    sums[p] += n
            return done

        step.rest = lambda: [rows()]
        return step

    return make


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, chunk: int = CHUNK, range_size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f): all phrases of k <= max_words words with f >= min_count, exactly; and (lang, n): all words."""
    chunks = written(map_batches(docs.select("lang", "text"), _chunks(max_words, chunk),
                                 "chunk string, lang string, ids binary, vocabulary binary, starts long, words long, ngrams long"))
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    ngrams = chunks.agg(F.sum("ngrams")).first()[0] or 0
    bits = max(0, (ngrams // range_size).bit_length())
    sent = map_batches(chunks.select("lang", "chunk", "ids", "vocabulary", "starts"), _send(max_words, bits),
                       "lang string, part long, chunk string, prints binary, counts binary", rows=1)
    answers = map_batches(sent.repartition("lang", "part").sortWithinPartitions("lang", "part"), _answer(min_count), "chunk string, prints binary", rows=64)
    answers = answers.groupBy("chunk").agg(F.collect_list("prints").alias("answers"))
    asked = chunks.select("lang", "chunk", "ids", "vocabulary", "starts").join(answers, "chunk")
    found = map_batches(asked.select("lang", "ids", "vocabulary", "starts", "answers"), _verify(max_words, bits),
                        "lang string, part long, phrases binary, counts binary", rows=1)
    phrases = map_batches(found.repartition("lang", "part").sortWithinPartitions("lang", "part"), _add(min_count), "lang string, phrase string, k int, f long", rows=64)
    return written(phrases), totals


def _cut(words: str, k, rest: bool):
    w = F.col(words)
    return F.array_join(F.slice(w, k + 1, F.size(w) - k) if rest else F.slice(w, F.lit(1), k), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, contained_percent: int = CONTAINED_PERCENT,
                 chunk: int = CHUNK, range_size: int = RANGE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    phrases, totals = frequent_phrases(docs, min_count, max_words, chunk, range_size)
    part = phrases.select("lang", "phrase", "f")
    found = phrases.filter("k > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    # all cuts of a phrase, its parts' counts by two joins; the lowest score counts, the smallest k among equals
    k = F.col("cut")
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", _cut("w", k, False).alias("left"), _cut("w", k, True).alias("right"))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", wide("a") * wide("a") * F.lit(SCALE).cast("decimal(7,0)"), wide("l") * wide("r"))
    worst = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), worst).select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    # shorter runs of words inside a longer phrase, with the longer one's count
    size = F.size("w")
    inside = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    longer = found.filter(size > 2).select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = left.withColumn("some", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "some").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Quality rules by distribution divergence (operator 6).

Every document's histogram of character classes, and of the common words of
its language, is compared with the language's reference by Jensen-Shannon
distance (square root of the divergence to base 2, so 0 to 1).  The
references are counted over all documents of the language: one aggregation
of class counts and one of word counts with per-task pre-aggregation.  A
reference is the class counts and the ``common`` most frequent words; those of all
languages, however many, are a written table that documents join by language.

Minimum-length guards: a histogram of few characters or words is far from
any reference by chance, so the class distance only counts from
``min_chars`` non-blank characters and the word distance from ``min_words``.

Input: ``doc_id``, ``text``, ``lang``; other columns are ignored.  A null text has no
words (and fails the base rule).  A null language is compared with
every reference, ``REFERENCE_BLOCK`` of them in a pass, and the nearest counts.  Repeated rows give repeated results; an
empty table gives an empty table.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches, written

#: Bytes of UTF-8 by class; bytes that continue a character count nowhere.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\n\r\x0b\x0c",
    "sentence": b".,;:?'\"-",
    "exclaim": b"!",
    "symbol": b"#*$%&|<>",
}
OTHER_ASCII, OTHER_LETTER, N_CLASSES = len(CLASSES), len(CLASSES) + 1, len(CLASSES) + 2
SYMBOLS = CLASSES["symbol"]

COMMON_WORDS = 60
#: References that a task holds at once for documents without a language.
REFERENCE_BLOCK = 2_000
MIN_CHARS, MIN_WORDS = 200, 30
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.48


def _class_table() -> np.ndarray:
    out = np.full(256, OTHER_ASCII, np.int64)
    out[0xC0:] = OTHER_LETTER
    out[0x80:0xC0] = N_CLASSES
    for k, chars in enumerate(CLASSES.values()):
        out[list(chars)] = k
    return out


_TABLE = _class_table()


def class_counts(raw: bytes) -> np.ndarray:
    """Characters of each class in UTF-8 bytes."""
    return np.bincount(_TABLE[np.frombuffer(raw, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 1 if either is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(d / 2, 0.0)))


def repeated_words(ids: np.ndarray, size: int = 5) -> int:
    """Words inside windows of ``size`` words that occur at least twice (all occurrences)."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    code = ids.astype(np.int64)
    top = int(code.max()) + 1
    bound = top
    for j in range(1, size):
        if bound * top >= 2**62:
            code = np.unique(code[: len(ids) - j + 1], return_inverse=True)[1]
            bound = int(code.max()) + 1
        code = code[: len(ids) - j] * top + ids[j:]
        bound *= top
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base_counts(text: str | None, raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not words:
        return 0, 0, len(raw) - len(raw.translate(None, SYMBOLS)), 0, 0
    blank = len(raw) - sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip(CLASSES["blank"])]
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    return (len(words), len(text) - blank, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(ids) if len(seen) < len(words) else 0)


def reference_table(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """lang, ref: of every language the pickled {"classes": counts, "words": {word: count}, "rest": count of other words}."""

    def count():
        held: dict = {}
        classes: dict = {}

        def rows():
            out = {"lang": [], "word": [], "n": [], "classes": []}
            for lang, words in held.items():
                out["lang"] += [lang] * len(words)
                out["word"] += list(words.keys())
                out["n"] += list(words.values())
                out["classes"] += [None] * len(words)
            for lang, n in classes.items():
                for k, v in (("lang", lang), ("word", None), ("n", 0), ("classes", n.tolist())):
                    out[k].append(v)
            held.clear()
            classes.clear()
            return out

        def step(cols):
            for lang, text in zip(cols["lang"], cols["text"]):
                if text is None or lang is None:
                    continue
                raw = text.encode("utf-8")
                held.setdefault(lang, Counter()).update(raw.lower().split())
                classes[lang] = classes.get(lang, 0) + class_counts(raw)
            return rows() if sum(map(len, held.values())) > 300_000 else None

        step.rest = lambda: [rows()]
        return step

    counted = map_batches(docs.select("lang", "text"), count, "lang string, word binary, n long, classes array<long>")
    # one table for both kinds of row: class counts are rows without a word
    each = [F.sum(F.coalesce(F.col("classes")[k], F.lit(0))).alias(f"c{k}") for k in range(N_CLASSES)]
    summed = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), *each)
    # per language: class counts, all words, and the most frequent words (ties by the word)
    summed = written(summed)
    totals = summed.groupBy("lang").agg(F.sum("n").alias("n"), F.array(*[F.sum(f"c{k}") for k in range(N_CLASSES)]).alias("classes"))
    by = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (summed.filter("word is not null").select("lang", "word", "n")
           .withColumn("k", F.row_number().over(by)).filter(F.col("k") <= common)
           .groupBy("lang").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts")))

    def pack():
        def step(cols):
            refs = []
            for n, classes, words, counts in zip(cols["n"], cols["classes"], cols["words"], cols["counts"]):
                held = dict(zip(map(bytes, words or ()), counts or ()))
                refs.append(pickle.dumps({"classes": classes, "words": held, "rest": n - sum(held.values())}))
            return {"lang": cols["lang"], "ref": refs}

        return step

    return written(map_batches(totals.join(top, "lang", "left").select("lang", "n", "classes", "words", "counts"), pack, "lang string, ref binary"))


def language_references(docs: DataFrame, common: int = COMMON_WORDS) -> dict[str, dict]:
    """The references of all languages, on the driver."""
    return {r["lang"]: pickle.loads(r["ref"]) for r in reference_table(docs, common).collect()}


def _ready(r: dict):
    order = sorted(r["words"])
    return np.array(r["classes"], float), {w: i for i, w in enumerate(order)}, np.array([r["words"][w] for w in order] + [r["rest"]], float)


def _distances(low: list[bytes], classes: np.ndarray, ref) -> tuple[float, float]:
    place, rest = ref[1], len(ref[1])
    hist = np.bincount([place.get(w, rest) for w in low], minlength=rest + 1) if low else np.zeros(rest + 1)
    return distance(classes, ref[0]), distance(hist, ref[2])


def _nearer(docs: DataFrame, references: dict[str, dict]) -> DataFrame:
    """doc_id, text, near: the smaller of the distances so far (``near``) and those to the nearest of some references."""

    def make():
        refs = [_ready(r) for r in references.values()]

        def step(cols):
            near = []
            for text, best in zip(cols["text"], cols["near"]):
                raw = (text or "").encode("utf-8")
                classes, low = class_counts(raw), raw.lower().split()
                near.append(min(([best] if best else []) + [_distances(low, classes, r) for r in refs], key=sum, default=None))
            return {"doc_id": cols["doc_id"], "text": cols["text"], "near": near}

        return step

    return map_batches(docs, make, "doc_id long, text string, near array<double>")


def quality_rules(docs: DataFrame, references: dict[str, dict] | DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
                  max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE, block: int = REFERENCE_BLOCK) -> DataFrame:
    """doc_id, the base counts, base_failed, class_distance, word_distance, kept.  ``references``: the table of
    ``reference_table``, or a dict, whose unknown languages are treated as null ones."""
    spark = docs.sparkSession
    if isinstance(references, dict):
        rows = [(lang, bytearray(pickle.dumps(r))) for lang, r in references.items()]
        references = spark.createDataFrame(rows, "lang string, ref binary")
        known = F.col("lang").isin([r[0] for r in rows])
        docs = docs.withColumn("lang", F.when(known, F.col("lang")))
    docs = docs.select("doc_id", "text", "lang")
    none = F.lit(None)
    own = docs.filter("lang is not null").join(references, "lang", "left").select("doc_id", "text", "lang", "ref", none.cast("array<double>").alias("near"))
    lost = docs.filter("lang is null").select("doc_id", "text", none.cast("array<double>").alias("near"))
    rounds = max(1, -(-references.count() // block))
    for k in range(rounds):
        some = references.filter(F.pmod(F.xxhash64("lang"), F.lit(rounds)) == k)
        lost = _nearer(lost, {r["lang"]: pickle.loads(r["ref"]) for r in some.orderBy("lang").collect()})
    rows = own.unionByName(lost.select("doc_id", "text", none.cast("string").alias("lang"), none.cast("binary").alias("ref"), "near"))

    def make():
        refs: dict = {}  # languages this task has met

        def step(cols):
            out = {n: [] for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                   "base_failed", "class_distance", "word_distance", "kept")}
            for doc_id, text, lang, ref, near in zip(cols["doc_id"], cols["text"], cols["lang"], cols["ref"], cols["near"]):
                raw = (text or "").encode("utf-8")
                words = raw.split()
                base = base_counts(text, raw, words)
                classes = class_counts(raw)
                if ref is not None:
                    if lang not in refs:
                        if len(refs) >= block:
                            refs.clear()
                        refs[lang] = _ready(pickle.loads(ref))
                    near = _distances(raw.lower().split(), classes, refs[lang])
                # a language without a reference has null texts only, at distance 1 from all
                by_class, by_word = near or ((1.0, 1.0) if lang is not None else (0.0, 0.0))
                failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
                far = (by_class > max_class and classes.sum() - classes[3] >= min_chars) or (by_word > max_word and base[0] >= min_words)
                for name, v in zip(out, (doc_id, *base, failed, by_class, by_word, not (failed or far))):
                    out[name].append(v)
            return out

        return step

    return map_batches(rows, make,
                       "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                       "base_failed boolean, class_distance double, word_distance double, kept boolean")

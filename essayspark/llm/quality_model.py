"""Quality classifier: random Fourier features, ridge scores, isotonic calibration (operator 7).

A document is described by statistics of its text.  Standardised, they go through
random Fourier features, cos(x W + b), whose inner products approximate a Gaussian
kernel.  Every task sums its part of the normal equations over the labelled training
rows; the sums are added in Spark in two levels, and only one matrix of fixed size
reaches the driver, which solves the ridge equations.  Raw scores are counted by
label in ``bins`` bins of fixed number, and pooling adjacent violators turns the counts into a
monotone calibration.

Labels are learnt only from rows whose crc32(doc_id) mod 5 is not 0 (all of them);
labels, lang, source and doc_id are never inputs of a score.

Input: ``doc_id``, ``text``; other columns are ignored.  A null text is the empty
text; it has a score too.  Repeated rows give repeated results, an empty table an empty
table; without labelled training rows every score is 0.5.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches, remainder, written

DIMENSIONS = 256
GAMMA = 0.08
RIDGE = 1e-3
BINS = 400
HELD_MOD = 5
LEVEL = 64

_KINDS = np.zeros(256, np.int64)  # 0 lower, 1 upper, 2 digit, 3 blank, 4 line end, 5 sentence marks, 6 other marks, 7 beyond ASCII
_KINDS[33:128] = 6
_KINDS[list(b"abcdefghijklmnopqrstuvwxyz")] = 0
_KINDS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_KINDS[list(b"0123456789")] = 2
_KINDS[:33] = 3
_KINDS[10] = 4
_KINDS[list(b".,;:?'-")] = 5
_KINDS[128:] = 7

N_STATS = 16


def statistics(text: str | None) -> list[float]:
    """Statistics of a text, all finite, also for an empty one."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=8) / size
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(w, len(seen)) for w in words]
    counts = np.bincount(ids) if ids else np.zeros(1)
    pairs = len(set(zip(ids, ids[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    return [math.log1p(n), *kinds[:6].tolist(), float(kinds[6]), float(kinds[7]), float(lengths.mean()) / 10, float(lengths.std()) / 5,
            len(seen) / math.sqrt(n or 1) / 10, float(counts.max()) / max(n, 1), 1 - pairs / max(n - 1, 1),
            1 - len(set(lines)) / max(len(lines), 1), math.log1p(n / max(len(lines), 1))]


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every whole text."""

    def make():
        return lambda cols: {"doc_id": cols["doc_id"], "x": [statistics(t) for t in cols["text"]]}

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, x array<double>")


def fourier(x: np.ndarray, mean, scale, gamma: float, dimensions: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=math.sqrt(2 * gamma), size=(x.shape[1], dimensions))
    b = rng.uniform(0, 2 * math.pi, dimensions)
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([math.sqrt(2 / dimensions) * np.cos(z @ w + b), np.ones((len(x), 1))])


def _sums(rows: DataFrame, mean, scale, gamma, dimensions) -> np.ndarray:
    """Normal equations, summed per task, then per group of tasks, then on the driver (``LEVEL`` rows)."""
    width = dimensions + 1

    def make():
        total = np.zeros((width, width + 1))

        def step(cols):
            z = fourier(np.array(cols["x"]), mean, scale, gamma, dimensions)
            total[:, :width] += z.T @ z
            total[:, width] += z.T @ np.array(cols["y"], float)

        step.rest = lambda: [{"total": [total.tobytes()]}]
        return step

    def add():
        total = np.zeros(width * (width + 1))

        def step(cols):
            for t in cols["total"]:
                np.add(total, np.frombuffer(t), out=total)

        step.rest = lambda: [{"total": [total.tobytes()]}]
        return step

    parts = map_batches(rows, make, "total binary", rows=4096)
    parts = map_batches(parts.repartition(LEVEL), add, "total binary", rows=16)
    return sum((np.frombuffer(r["total"]) for r in parts.toLocalIterator()), np.zeros(width * (width + 1))).reshape(width, width + 1)


def isotonic(positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: a non-decreasing rate for each bin; empty bins take their neighbours' value."""
    blocks: list[list[float]] = []
    for p, n in zip(positive, total):
        if n:
            blocks.append([p, n, 1])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    rates = np.concatenate([np.full(int(k), (p + 0.5) / (n + 1)) for p, n, k in blocks]) if blocks else np.array([])
    rates = np.maximum.accumulate(rates) if len(rates) else rates
    at = np.flatnonzero(total)
    return np.interp(np.arange(len(total)), at, rates) if len(at) else np.full(len(total), 0.5)


def quality_scores(docs: DataFrame, labels: DataFrame, column: str = "quality", dimensions: int = DIMENSIONS,
                   gamma: float = GAMMA, ridge: float = RIDGE, bins: int = BINS) -> DataFrame:
    """doc_id, score (0 to 1)."""
    x = written(text_statistics(docs))
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (remainder("doc_id", HELD_MOD) != 0))
             .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y")))
    train = written(x.join(known, "doc_id").select("x", "y"))
    moments = train.agg(F.count(F.lit(1)).alias("n"), *[f(F.col("x")[k]).alias(f"{name}{k}") for k in range(N_STATS)
                                                        for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not moments["n"]:
        return x.select("doc_id", F.lit(0.5).alias("score"))
    mean = np.array([moments[f"m{k}"] for k in range(N_STATS)])
    scale = np.array([moments[f"s{k}"] or 1.0 for k in range(N_STATS)])
    normal = _sums(train, mean, scale, gamma, dimensions)
    penalty = ridge * moments["n"] * np.eye(dimensions + 1)
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(normal[:, :-1] + penalty, normal[:, -1])

    def raw(cols):
        return np.clip(fourier(np.array(cols["x"]), mean, scale, gamma, dimensions) @ beta, -0.5, 1.5)

    def place(s):
        return (s + 0.5) / 2 * bins - 0.5

    def binned():
        return lambda cols: {"bin": np.clip(np.rint(place(raw(cols))), 0, bins - 1).astype(int).tolist(), "y": cols["y"]}

    got = map_batches(train, binned, "bin int, y int", rows=4096).groupBy("bin").agg(F.sum("y").alias("p"), F.count("y").alias("n")).collect()
    positive, total = np.zeros(bins), np.zeros(bins)
    for r in got:
        positive[r["bin"]], total[r["bin"]] = r["p"], r["n"]
    curve = isotonic(positive, total)

    def score():
        return lambda cols: {"doc_id": cols["doc_id"], "score": np.clip(np.interp(place(raw(cols)), np.arange(bins), curve), 0, 1).tolist()}

    return map_batches(x, score, "doc_id long, score double", rows=4096)

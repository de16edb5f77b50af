"""Latent Dirichlet allocation by batch variational Bayes (ML9).

Every step reads each document once.  The E-step runs on Arrow batches: all documents of a slice are updated together, each until
its own topic weights settle, so a document's result does not depend on its neighbours.  A task adds
its documents' topic-term statistics and its part of the bound into one message of fixed size (topics x terms); messages are added
in levels (``tree_sum``), and the driver, which holds topics x terms numbers and nothing of the documents, makes the M-step.

The evidence lower bound falls out of the E-step, so perplexity costs no pass of its own.  It is looked at
every ``check_every`` steps; a change under ``tolerance`` ends the run.  A fixed start for every document and tight
inner updates keep the bound from falling.

A document without a term of the vocabulary keeps the prior: the same share of every topic."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.operators.tree_sum import n_tasks, tree_sum
from essayspark.operators.vocab import encoded_terms
from essayspark.session import ship_package

#: Term entries of the documents that are updated together.
SLICE = 500_000
#: Numbers (documents x terms x topics) of a block that is updated by one product; 2 MB.
BLOCK = 1 << 18
#: Inner steps after which the documents that still move are laid out anew.
RUN = 64
INNER_STEPS, INNER_CHANGE = 200, 1e-5
_SHIFT = 8


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log gamma for positive numbers: the recurrence up to 8, then the asymptotic series."""
    x = np.asarray(x, np.float64)
    # the eight terms 1 / (x + i) in pairs of i and 7 - i, by u = x (x + 7), and these in pairs again
    u = x * (x + 7)
    low = (2 * x + 7) * ((2 * u + 12) / (u * (u + 12)) + (2 * u + 16) / ((u + 6) * (u + 10)))
    y = x + _SHIFT
    r = 1.0 / y
    z = r * r
    return np.log(y) - 0.5 * r - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z * (1 / 132 - z * 691 / 32760))))) - low


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    low = sum(np.log(x + i) for i in range(_SHIFT))
    y = x + _SHIFT
    z = 1.0 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - low


def expected_log(weights: np.ndarray) -> np.ndarray:
    """E[log p] under Dirichlet rows."""
    return digamma(weights) - digamma(weights.sum(-1, keepdims=True))


def exp_digamma(x: np.ndarray) -> np.ndarray:
    """exp(digamma(x)) for positive numbers: as ``digamma``, but without a logarithm, in few temporaries."""
    u = x * (x + 7)
    first, second = 2 * u, (u + 6) * (u + 10)
    low, more = first + 12, (first + 16) / second
    low /= u * (u + 12)
    low += more
    low *= 2 * x + 7
    y = x + _SHIFT
    r = 1.0 / y
    z = r * r
    s = z * (-691 / 32760)
    s += 1 / 132
    for c in (1 / 240, 1 / 252, 1 / 120, 1 / 12):
        s *= z
        np.subtract(c, s, out=s)
    s *= z
    s += low
    r *= 0.5
    s += r
    np.negative(s, out=s)
    np.exp(s, out=s)
    s *= y
    return s


def infer(lens: np.ndarray, term: np.ndarray, count: np.ndarray, exp_beta: np.ndarray, alpha: float, steps: int = INNER_STEPS,
          change: float = INNER_CHANGE) -> tuple[np.ndarray, np.ndarray]:
    """Topic weights of some documents, and the exponents of their expected logarithms.

    ``lens``: terms of each document; ``term`` and ``count`` hold them one document after the other.  Documents of like length are
    laid side by side in blocks of about ``BLOCK`` numbers, which stay in the processor's cache and need two
    batched products a step.  A settled document's weights are final whatever its block goes on with; after ``RUN`` steps
    the documents that are left are laid out in blocks anew.  An update does not depend on the scale of a document's
    exponents, so they are divided by that of the sum only at the end."""
    k, n = exp_beta.shape[0], len(lens)
    gamma = np.ones((n, k))
    gamma[lens == 0] = alpha
    first = np.cumsum(lens) - lens
    order = np.argsort(lens, kind="stable")
    order = order[lens[order] > 0]
    for done in range(0, steps, RUN):
        size, at, moving = lens[order], 0, []
        while at < len(order):
            longest = max(size[at] + 16, size[at] * 3 // 2)  # padding costs less than many small blocks
            end = min(int(np.searchsorted(size, longest, "right")), at + max(1, BLOCK // int(longest * k)))
            some, at = order[at:end], end
            places = np.arange(int(lens[some].max()))
            pos = first[some][:, None] + places
            real = places < lens[some][:, None]
            pos[~real] = 0
            # documents x places, documents x topics x places
            c, b = np.where(real, count[pos], 0.0), np.ascontiguousarray(exp_beta[:, term[pos]].transpose(1, 0, 2))
            g = gamma[some]
            t, live = exp_digamma(g), np.ones(len(some), bool)
            for _ in range(min(RUN, steps - done)):
                share = (b.transpose(0, 2, 1) @ t[:, :, None])[:, :, 0]
                share += 1e-100
                np.divide(c, share, out=share)
                new = (b @ share[:, :, None])[:, :, 0]
                new *= t
                new += alpha
                g -= new
                settled = live & (np.abs(g, out=g).sum(1) < change * k)
                g = new
                if settled.any():
                    gamma[some[settled]] = g[settled]
                    live &= ~settled
                    left = int(live.sum())
                    if not left:
                        break
                    if left <= 0.8 * len(live):
                        some, c, b, g = some[live], c[live], b[live], g[live]
                        live = np.ones(left, bool)
                t = exp_digamma(g)
            gamma[some[live]] = g[live]
            moving.append(some[live])
        order = np.concatenate(moving) if moving else order[:0]
        if not len(order):
            break
    return gamma, np.exp(expected_log(gamma))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a batch's documents of about ``SLICE`` entries: first and next document, lengths, terms, counts."""
    idx, cnt = batch.column("idx"), batch.column("cnt")
    lens = np.diff(idx.offsets.to_numpy()).astype(np.int64)
    term, count = idx.flatten().to_numpy(), cnt.flatten().to_numpy()  # no document's idx or cnt is null
    ends = np.cumsum(lens)
    cuts = np.flatnonzero(np.diff(ends // SLICE)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(lens)]):
        if b > a:
            at = slice(int(ends[a] - lens[a]), int(ends[b - 1]))
            yield int(a), int(b), lens[a:b], term[at], count[at]


@dataclass
class TopicModel:
    """Dirichlet weights of the topics (topics x terms), the priors, and the bound after each step."""

    weights: np.ndarray
    alpha: float
    eta: float
    bounds: list[float] = field(default_factory=list)
    tokens: float = 0.0

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def exp_beta(self) -> np.ndarray:
        return np.exp(expected_log(self.weights))

    def log_perplexity(self) -> float:
        """Minus the bound per token after the last step (lower is better)."""
        return -self.bounds[-1] / self.tokens if self.tokens else 0.0

    def transform(self, docs: DataFrame, keys: list[str]) -> DataFrame:
        """keys and ``shares``: the topic shares of every document."""
        exp_beta, alpha = self.exp_beta, self.alpha

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b, lens, term, count in _slices(batch):
                    gamma, _ = infer(lens, term, count, exp_beta, alpha)
                    shares = pa.ListArray.from_arrays(np.arange(0, gamma.size + 1, gamma.shape[1], dtype=np.int32),
                                                      pa.array((gamma / gamma.sum(1, keepdims=True)).ravel()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keys), shares], [*keys, "shares"])

        kinds = dict(docs.dtypes)
        return docs.select(*keys, "idx", "cnt").mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", shares array<double>")

    def topic_terms(self, spark: SparkSession, vocabulary: list[str]) -> DataFrame:
        """(topic, term, w): the weights, a table of topics x terms rows."""
        rows = [(t, vocabulary[j], float(self.weights[t, j])) for t in range(self.k) for j in range(len(vocabulary))]
        return spark.createDataFrame(rows, "topic int, term string, w double")


def start_weights(k: int, terms: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).gamma(100.0, 0.01, (k, terms))


def topic_bound(weights: np.ndarray, eta: float) -> float:
    """The part of the bound that the topics give."""
    e = expected_log(weights)
    terms = weights.shape[1]
    return float(((eta - weights) * e).sum() + (log_gamma(weights) - log_gamma(np.array(eta))).sum()
                 + (log_gamma(np.array(eta * terms)) - log_gamma(weights.sum(1))).sum())


def step_message(lens: np.ndarray, term: np.ndarray, count: np.ndarray, exp_beta: np.ndarray, alpha: float) -> np.ndarray:
    """Of some documents: topics x terms statistics, then the bound's part and the tokens."""
    k, terms = exp_beta.shape
    gamma, theta = infer(lens, term, count, exp_beta, alpha)
    each = np.repeat(theta, lens, 0)
    norm = np.einsum("ek,ek->e", each, np.ascontiguousarray(exp_beta.T)[term]) + 1e-100
    each *= (count / norm)[:, None]
    stats = np.stack([np.bincount(term, each[:, t], terms) for t in range(k)]) * exp_beta
    e = expected_log(gamma)
    bound = (count * np.log(norm)).sum() + ((alpha - gamma) * e).sum() + (log_gamma(gamma) - log_gamma(np.array(alpha))).sum() \
        + (log_gamma(np.array(alpha * k)) - log_gamma(gamma.sum(1))).sum()
    return np.concatenate([stats.ravel(), [bound, count.sum()]])


def fit(docs: DataFrame, k: int, terms: int, max_iter: int = 30, seed: int = 7, alpha: float | None = None, eta: float | None = None,
        check_every: int = 5, tolerance: float = 0.01, start: np.ndarray | None = None) -> TopicModel:
    """``docs``: idx array<int>, cnt array<double> (a written table: it is read once in each step).  Priors are 1 / k unless given."""
    alpha, eta = (1.0 / k if p is None else p for p in (alpha, eta))
    model = TopicModel(start_weights(k, terms, seed) if start is None else start.copy(), alpha, eta)
    rows = docs.select("idx", "cnt")
    tasks, last = n_tasks(rows), None

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["sums"].iloc[0]).copy()
        for x in pdf["sums"].iloc[1:]:
            total += np.frombuffer(x)
        return pdf.iloc[:1].assign(sums=[total.tobytes()])

    for step in range(1, max_iter + 1):
        exp_beta = model.exp_beta

        def run(batches: Iterator[pa.RecordBatch], exp_beta=exp_beta) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for _, _, *some in _slices(batch):
                    new = step_message(*some, exp_beta, alpha)
                    total = new if total is None else total + new
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  pa.array([total.tobytes()], pa.binary())], ["one", "node", "sums"])

        sums = tree_sum(rows.mapInArrow(run, "one int, node int, sums binary"), ["one"], add, tasks).collect()
        total = sum((np.frombuffer(r["sums"]) for r in sums), np.zeros(k * terms + 2))
        model.bounds.append(float(total[-2]) + topic_bound(model.weights, eta))
        model.tokens = float(total[-1])
        if step % check_every == 0:
            now = math.exp(min(model.log_perplexity(), 700))
            if last is not None and abs(last - now) < tolerance:
                break
            last = now
        model.weights = eta + total[:-2].reshape(k, terms)
    return model


def count_rows(docs: DataFrame, terms: str, vocabulary: list[str], keys: list[str]) -> DataFrame:
    """keys, idx (sorted places in the vocabulary), cnt: counts of a document's known terms."""
    place, n = {t: i for i, t in enumerate(vocabulary)}, max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text, number, distinct in encoded_terms(batch, terms):
                at = np.array([place.get(t, -1) for t in distinct.to_pylist()] or [-1], np.int64)[number]
                found, count = np.unique((text * n + at)[at >= 0], return_counts=True)
                ends = np.searchsorted(found, np.arange(b - a + 1) * n).astype(np.int32)
                rows = [pa.ListArray.from_arrays(ends, x) for x in (pa.array((found % n).astype(np.int32)), pa.array(count.astype(np.float64)))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keys), *rows], [*keys, "idx", "cnt"])

    ship_package(docs.sparkSession)
    kinds = dict(docs.dtypes)
    return docs.select(*keys, terms).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", idx array<int>, cnt array<double>")


def shares_long(shares: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., topic, p)."""
    return shares.select(*keys, F.posexplode("shares").alias("topic", "p"))

"""Toxicity scoring by weak supervision (operator 8).

Voters are lexicons and patterns: whole words and word beginnings.  Those that go
with the toxic label are found by counting, over the labelled training rows,
how many documents of either class hold each word or beginning; a general list of
insults is one more voter.  Entries that a surer beginning covers are left out, the ``entries`` surest of the others
(the model's size) are dealt to ``voters`` lexicons, so no voter rests on one word.

Each voter fires or not on every document of the corpus.  Spark counts the
patterns of votes (at most 2^voters rows) over all documents, and a generative
label model is fitted to those counts on the driver: a latent class, with each
voter's rate of firing in either class (its accuracy) estimated by
expectation-maximisation, together with the counts on labelled training rows.
Voters whose votes remain correlated within a class are not independent
witnesses: their evidence is divided by the sum of their residual
correlations, and the model is fitted once more.  On training rows the label votes as well, with an
accuracy estimated like any other voter's, and the posterior labels
train a linear (logistic) classifier on hit rates, which gives every document's score.

Learning reads labels of rows whose crc32(doc_id) mod 5 is not 0, at most
``max_labelled`` of them, chosen by a hash of the id; everything else runs over all documents.
The label, lang, source and id are never inputs of a score.

Input: ``doc_id``, ``text``; other columns are ignored.  A null text is the empty
text and gets the score of a text without hits.  Repeated rows get repeated
results; an empty table gives an empty table; without any labelled training row
of both classes only the general list votes.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches, remainder, written

MAX_LABELLED = 40_000
VOTERS = 10
ENTRIES = 400
MIN_SUPPORT = 5
#: The lower end of an entry's log odds for the toxic label, against documents without it.
MIN_LOG_ODDS = 1.5
BEGINNINGS = (4, 5, 6, 7, 8)
HELD_MOD = 5

# ---- fixed values: general insults ----------------------------------------------
INSULTS = """
asshole bastard bitch clown coward creep crap cretin cunt damn degenerate dickhead disgusting dumbass
dumb dunce fool freak fuck garbage hate hateful idiot idiotic imbecile jackass jerk kill loser lowlife
moron moronic nasty pathetic pig prick psycho rat repulsive retard scum shit shithead slut
stupid subhuman trash ugly vermin vile whore worthless
""".split()

_WORDS = re.compile(r"[^\W\d_]+").findall


def training_labels(labels: DataFrame, column: str, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, y of training rows: at most about ``max_labelled``, chosen by a hash of the id
    whatever their order.  Null ids and labels teach nothing."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (remainder("doc_id", HELD_MOD) != 0))
             .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y")))
    n = known.count()
    if n <= max_labelled:
        return known
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_labelled / n))


def entry_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """entry, documents with the toxic label that hold it, and documents without that label.
    An entry is a word, or a beginning of words (written with a trailing ``*``)."""
    rows = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")  # at most max_labelled labels

    def make():
        held: dict = {}

        def flush():
            out = {"entry": list(held), "a": [v[1] for v in held.values()], "b": [v[0] for v in held.values()]}
            held.clear()
            return out

        def step(cols):
            for text, y in zip(cols["text"], cols["y"]):
                words = set(_WORDS((text or "").lower()))
                for w in words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}:
                    held.setdefault(w, [0, 0])[y != 0] += 1
            return flush() if len(held) > 300_000 else None

        step.rest = lambda: [flush()]
        return step

    counted = map_batches(rows.select("text", "y"), make, "entry string, a long, b long")
    return counted.groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def choose_voters(docs: DataFrame, labels: DataFrame, voters: int = VOTERS, entries: int = ENTRIES,
                  min_support: int = MIN_SUPPORT) -> list[list[str]]:
    """Lexicons of the entries that go with the toxic label most surely, then the general list."""
    totals = labels.agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).first()
    if not totals["a"] or not totals["b"]:
        return [list(INSULTS)]
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (totals["a"] + 1)) - F.log((b + 0.5) / (totals["b"] + 1))
    # the lower end of the log odds: a surely toxic entry is frequent as well
    sure = odds - 2 * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    found = written(entry_counts(docs, labels).filter(a >= min_support).withColumn("sure", sure).filter(F.col("sure") > MIN_LOG_ODDS)
                    .select("entry", "sure"))
    kept = [r["entry"] for r in uncovered(found).orderBy(F.desc("sure"), "entry").limit(entries).collect()]
    return [kept[k::voters] for k in range(voters) if kept[k::voters]] + [list(INSULTS)]


def uncovered(found: DataFrame) -> DataFrame:
    """Of ``found`` (entry, sure) the entries that no surer beginning covers (equally sure: the first in order): a word
    that a chosen beginning finds is no further witness."""
    begins = found.filter(F.col("entry").endswith("*")).select(F.expr("left(entry, length(entry) - 1)").alias("beginning"), F.col("sure").alias("s"),
                                                              F.col("entry").alias("e"))
    bare = F.rtrim(F.col("entry"), F.lit("*"))
    beginnings = F.filter(F.array(*[F.when(F.length(bare) >= k, F.substring(bare, 1, k)) for k in BEGINNINGS]), lambda x: x.isNotNull())
    covered = (found.select("entry", "sure", F.explode(beginnings).alias("beginning")).join(begins, "beginning")
               .filter((F.col("s") > F.col("sure")) | ((F.col("s") == F.col("sure")) & (F.col("e") < F.col("entry")))).select("entry").distinct())
    return found.join(covered, "entry", "left_anti")


class Hits:
    """Counts the words of a text that each lexicon holds (a word counts once per lexicon)."""

    def __init__(self, lexicons: list[list[str]]):
        import ahocorasick

        self.n, self.whole, self.begins = len(lexicons), {}, {}
        self.find = ahocorasick.Automaton()
        for k, entries in enumerate(lexicons):
            for e in entries:
                (self.begins if e[-1] == "*" else self.whole).setdefault(e.rstrip("*"), []).append(k)
                self.find.add_word(e.rstrip("*"), 1)
        self.lengths = sorted({len(e) for e in self.begins})
        self.find.make_automaton()

    def __call__(self, text: str | None) -> tuple[int, list[int]]:
        low = (text or "").lower()
        got = [0] * self.n
        if next(self.find.iter(low), None):
            for w in _WORDS(low):
                who = set(self.whole.get(w, ()))
                for m in self.lengths:
                    who.update(self.begins.get(w[:m], ()))
                for k in who:
                    got[k] += 1
        return len(low.split()), got


def hits(docs: DataFrame, lexicons: list[list[str]]) -> DataFrame:
    """doc_id, n_words, hits: of every whole text."""

    def make():
        count = Hits(lexicons)

        def step(cols):
            got = [count(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_words": [g[0] for g in got], "hits": [g[1] for g in got]}

        return step

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_words long, hits array<long>")


def label_model(patterns: np.ndarray, counts: np.ndarray, fired: np.ndarray, size: np.ndarray, rounds: int = 50):
    """Rates of firing per class (voters x 2), class prior, weights of the voters.

    ``patterns``: votes (0 or 1), one row per pattern.  ``fired`` and ``size``: on how many labelled
    rows of either class each voter fires, and how many there are; they start the rates and stay in
    every estimate, so the latent class keeps its meaning."""
    counts = counts.astype(float)
    rates = np.clip((fired + 0.5) / (size + 1), 1e-6, 1 - 1e-6)
    prior = float(np.clip(size[1] / max(size.sum(), 1), 1e-3, 0.999))
    weights = np.ones(patterns.shape[1])
    for _ in range(2):
        for _ in range(rounds):
            post = posterior(patterns, rates, prior, weights)
            n1, n0 = (counts * post).sum(), (counts * (1 - post)).sum()
            seen = np.stack([(counts * (1 - post)) @ patterns, (counts * post) @ patterns], 1)
            new = (seen + fired + 0.5) / (np.array([n0, n1]) + size + 1)
            new = np.clip(new, 1e-6, 1 - 1e-6)
            prior = float(np.clip(n1 / max(counts.sum(), 1), 1e-4, 1 - 1e-4))
            if np.abs(new - rates).max() < 1e-7:
                break
            rates = new
        # correlation that the class does not explain, within either class
        post = posterior(patterns, rates, prior, weights)
        cov = sum(((patterns - rates[:, y]).T * (counts * p)) @ (patterns - rates[:, y]) for y, p in ((0, 1 - post), (1, post)))
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        corr = np.abs(cov / np.outer(sd, sd))
        weights = 1 / np.maximum(corr.sum(1), 1)
    return rates, prior, weights


def posterior(patterns, rates, prior, weights):
    """P(toxic | votes), each voter's evidence times its weight."""
    on, off = np.log(rates), np.log1p(-rates)
    gain = (on - off) * weights[:, None]
    logit = patterns @ (gain[:, 1] - gain[:, 0]) + ((off[:, 1] - off[:, 0]) * weights).sum() + np.log(prior / (1 - prior))
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def with_labels(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Posteriors of labelled rows with the label as one more voter, whose accuracy is estimated from them too."""
    hit, false = (p @ y + 1) / (p.sum() + 2), ((1 - p) @ y + 1) / ((1 - p).sum() + 2)
    logit = np.log(p / (1 - p)) + np.where(y == 1, np.log(hit / false), np.log((1 - hit) / (1 - false)))
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def features(n_words: np.ndarray, got: np.ndarray) -> np.ndarray:
    """Per voter: whether it fires and its rate per word; all hits per word; a constant."""
    rate = got / np.maximum(n_words, 1)[:, None]
    return np.hstack([(got > 0).astype(float), np.minimum(30 * rate, 3.0), np.minimum(10 * rate.sum(1, keepdims=True), 3.0),
                      (got.sum(1, keepdims=True) > 0).astype(float), np.ones((len(got), 1))])


def fit_linear(x: np.ndarray, p: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (q - p) + penalty * w
        step = np.linalg.solve((x.T * (q * (1 - q) + 1e-6)) @ x + penalty * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, column: str = "toxic", max_labelled: int = MAX_LABELLED):
    """Lexicons, the classifier's weights, and the hits of all documents (written)."""
    train = written(training_labels(labels, column, max_labelled))
    lexicons = choose_voters(docs, train)
    got = written(hits(docs, lexicons))
    votes = F.transform("hits", lambda h: (h > 0).cast("int"))
    # at most 2^voters patterns, counted with a partial count in every task
    table = got.groupBy(votes.alias("v")).count().collect()
    # at most max_labelled ids; repeated rows of an id teach once, by the text with fewest words, then hits
    one = F.min(F.struct("n_words", "hits")).alias("h")
    taught = got.join(F.broadcast(train), "doc_id").groupBy("doc_id", "y").agg(one).select("h.*", "y").toPandas()
    w = np.zeros(2 * len(lexicons) + 3)
    w[-1], w[-2] = -3.0, 6.0
    if len(taught) and taught["y"].nunique() == 2:
        patterns = np.array([r["v"] for r in table], float)
        counts = np.array([r["count"] for r in table], float)
        h, n, y = np.array(taught["hits"].tolist()), taught["n_words"].to_numpy(), taught["y"].to_numpy()
        fire = h > 0
        fired, size = np.stack([fire[y == k].sum(0) for k in (0, 1)], 1), np.array([(y == k).sum() for k in (0, 1)])
        rates, prior, weights = label_model(patterns, counts, fired, size)
        p = np.clip(posterior(fire.astype(float), rates, prior, weights), 1e-9, 1 - 1e-9)
        w = fit_linear(features(n, h), with_labels(p, y))
    return lexicons, w, got


def score_hits(n_words: list[int], got: list[list[int]], w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features(np.array(n_words), np.array(got)) @ w, -30, 30)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, column: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, score (0 to 1)."""
    _, w, got = fit_toxicity(docs, labels, column, max_labelled)

    def make():
        return lambda cols: {"doc_id": cols["doc_id"], "score": score_hits(cols["n_words"], cols["hits"], w).tolist()}

    return map_batches(got, make, "doc_id long, score double", rows=8192)


def keep_harmless(docs: DataFrame, labels: DataFrame, below: float = 0.5, column: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under ``below``."""
    lexicons, w, _ = fit_toxicity(docs, labels, column, max_labelled)
    counters: list = []

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not counters:
            counters.append(Hits(lexicons))
        got = [counters[0](t) for t in texts]
        return pd.Series(score_hits([g[0] for g in got], [g[1] for g in got], w) if got else [], dtype="float64")

    return docs.filter(score(F.col("text")) < below)

"""Language-model scores by a log-bilinear model (operator 4).

Tokens: words between ASCII white space of the text, A-Z lower-cased, then one end token per document.
The base score sums log10((c + 1) / (N + V + 1)) over a document's tokens; c is the token's count in the
training documents, N all training tokens, V the distinct ones.

The model has two levels, and every number in it comes from counts of the whole corpus.  The ``own`` most frequent tokens are classes of
their own; all others are classed by their last two bytes into ``endings`` classes.

1. A log-bilinear network predicts the next token's class from the ``CONTEXT`` classes before it: the context's vectors, each weighted by
   its place's vector, add up to a predicted vector, whose product with each class's vector, plus a bias, is the class's score.
2. Within a shared class each of the ``head`` most frequent tokens has a vector and a bias of its own, and so have all the class's other
   tokens together; its score is the vector's product with that of the class before it.

Both are trained in numpy with noise-contrastive estimation: a token from the corpus has to be told from ``NOISE`` tokens drawn from the
unigram distribution (of the class, in the second).  Nothing is drawn: the training data are the counts of all class sequences (no more than
classes^3) and of all tokens after each class (no more than head x classes) of all training documents, a step is a pass over all of them, and
the noise counts by its expectation.  Several lanes train the first level on their contexts from common parameters, which are averaged after
each round; the second level's tokens are independent of each other, given the contexts' vectors, and are dealt to lanes.  Batched
matrix products then give normalised log-probabilities for every context.  A token outside the head takes its share of its class's
others by (c + 1) / (their tokens + distinct ones + 1), so the whole is a distribution over all words, unseen ones included.

Counts cover all training documents, whatever their number.  The ``head`` most frequent tokens' counts (a
fixed number) go to every task; all other tokens are joined to their counts by a shuffle.

Input: ``doc_id``, ``text``; other columns are ignored.  A null text is empty and has the end token only.
A null id counts as the empty text when documents are dealt to training and held-out ones.  Repeated rows
count and are scored as often as they occur; an empty table gives an empty table.  Without training
documents every token is unseen (the base score's denominator is 1).
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches, remainder, written

OWN, ENDINGS, CONTEXT = 64, 64, 2
HEAD = 262_144
WIDTH, NOISE = 24, 8
LANES, ROUNDS, STEPS, BATCH = 12, 4, 80, 256
#: Second level: lanes, passes, weight of the prior that holds a rare token's vector near zero, tokens that are trained at a time.
WORD_LANES, WORD_STEPS, RIDGE, WORDS = 48, 40, 1.0, 2048
#: Tokens whose contexts a task holds before it sends their counts.
SENT = 4_000_000
END = b""  # no word is empty


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8").lower().split(), END]


def token_counts(docs: DataFrame) -> DataFrame:
    """token, c over all documents; every task sums what it reads before it sends."""

    def make():
        held = Counter()

        def flush():
            out = {"token": list(held), "c": list(held.values())}
            held.clear()
            return out

        def step(cols):
            for text in cols["text"]:
                held.update(tokens(text))
            return flush() if len(held) > 300_000 else None

        step.rest = lambda: [flush()]
        return step

    return map_batches(docs.select("text"), make, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, n: int) -> tuple[list[bytes], np.ndarray]:
    """Tokens, and their counts, that occur so often that no more than ``n`` do, the most frequent first.  The bound is read from a
    histogram of the counts (exact up to 1000, then 16 steps to each doubling), so no task merges other tasks' tops."""
    step = F.when(F.col("c") <= 1000, F.col("c")).otherwise((984 + F.floor(16 * F.log2(F.col("c") / 1000)) + 17).cast("long"))
    low, total = None, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low")).orderBy(F.desc("step")).collect():
        total += r["n"]
        if total > n:
            break
        low = r["low"]
    if low is None:
        return [], np.zeros(0, np.int64)
    rows = counts.filter(F.col("c") >= low).select("token", "c").toArrow()  # at most n rows
    rows = rows.sort_by([("c", "descending"), ("token", "ascending")])
    return rows["token"].to_pylist(), rows["c"].to_numpy()


class Classes(dict):
    """Class of every token: its own, or that of its last two bytes."""

    def __init__(self, names: list[bytes], own: int = OWN, endings: int = ENDINGS):
        super().__init__({t: i for i, t in enumerate(names)})
        self.own, self.endings, self.total = own, endings, own + endings
        self.by_end: dict[bytes, int] = {}
        self.end = self.of([END])[0]

    def of(self, words: list[bytes]) -> list[int]:
        get, by_end = self.get, self.by_end
        out = []
        for w in words:
            k = get(w)
            if k is None:
                k = by_end.get(w[-2:])
                if k is None:
                    k = by_end[w[-2:]] = self.own + zlib.crc32(w[-2:]) % self.endings
            out.append(k)
        return out


class Vocabulary:
    """Numbers of the known tokens, and the classes of all.  ``packed``: the known ones but for the end token, joined by blanks."""

    def __init__(self, packed: bytes, has_end: bool, names: list[bytes], own: int, endings: int):
        words = packed.split() + [END] * has_end
        self.number = {w: i for i, w in enumerate(words)}
        self.classes = Classes(names, own, endings)
        self.own, self.total, self.known, self.shared = own, own + endings, len(words), len(names)
        self.kind = np.array([*self.classes.of(words), 0], np.int64)  # the last for unknown ones

    def read(self, texts: list[str | None]):
        """All tokens of some texts, the texts' lengths, the tokens' numbers (-1: not known), classes, and the classes at each place before them,
        the nearest first; before a text there are end tokens."""
        each = [tokens(t) for t in texts]
        flat, lens = [w for ws in each for w in ws], np.array([len(ws) for ws in each], np.int64)
        get = self.number.get
        ids = np.array([get(w, -1) for w in flat], np.int64)
        kind, rare = self.kind[ids], np.flatnonzero(ids < 0)
        kind[rare] = self.classes.of([flat[i] for i in rare.tolist()])
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        before = [np.where(place >= k, np.roll(kind, k), self.classes.end) for k in range(1, CONTEXT + 1)]
        return flat, lens, ids, kind, before

    def cells(self, kind: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
        """The number of each context and its token's class, in base ``total``."""
        cell = before[-1]
        for k in [*before[-2::-1], kind]:
            cell = cell * self.total + k
        return cell

    def items(self, ids: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Numbers of the second level: known tokens, then each shared class's others."""
        return np.where(ids >= 0, ids, self.known + kind - self.own)


#: A worker's vocabulary and tables of the run it works on; its next tasks find them.
_KEPT: dict = {}


def kept(run: str, make: Callable):
    if run not in _KEPT:
        _KEPT.clear()
        _KEPT[run] = make()
    return _KEPT[run]


def sequence_counts(docs: DataFrame, vocabulary: tuple, lanes: int = LANES, word_lanes: int = WORD_LANES) -> DataFrame:
    """level, lane, at, n: how often each run of CONTEXT + 1 classes occurs (level 1, dealt by its context), and each token of a shared class
    after each class (level 2, dealt by token).  A lane's counts are one row: places (int32) in a table of its contexts or tokens x classes,
    and counts (int64).  What a task has counted goes to the lanes as messages of the same form, which are summed into such a table."""
    run_id = uuid.uuid4().hex

    def split(level, at, n, total, lanes):
        row, rest = at // total, at % total
        lane, place = row % lanes, (row // lanes * total + rest).astype(np.int32)
        order = np.argsort(lane, kind="stable")
        cuts = np.searchsorted(lane[order], np.arange(lanes + 1)).tolist()
        some = [(k, order[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return {"level": [level] * len(some), "lane": [k for k, _ in some], "at": [place[o].tobytes() for _, o in some],
                "n": [n[o].astype(np.int64).tobytes() for _, o in some]}

    def make():
        v = kept(run_id, lambda: Vocabulary(*vocabulary))
        classes, waiting = np.zeros(v.total ** (CONTEXT + 1), np.int64), []

        def words():
            at, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return split(2, at, n, v.total, word_lanes)

        def step(cols):
            _, _, ids, kind, before = v.read(cols["text"])
            at, n = np.unique(v.cells(kind, before), return_counts=True)
            classes[at] += n
            inside = kind >= v.shared
            waiting.append(v.items(ids[inside], kind[inside]) * v.total + before[0][inside])
            return words() if sum(map(len, waiting)) > SENT else None

        def rest():
            at = np.flatnonzero(classes)
            return [x for x in (split(1, at, classes[at], v.total, lanes), words() if waiting else None) if x and x["lane"]]

        step.rest = rest
        return step

    def merge():
        held: dict = {}

        def step(cols):
            for level, lane, at, n in zip(cols["level"], cols["lane"], cols["at"], cols["n"]):
                at = np.frombuffer(at, np.int32)
                table = held.get((level, lane), np.zeros(0, np.int64))
                if len(table) <= at.max():
                    table = np.concatenate([table, np.zeros(max(int(at.max()) + 1, 2 * len(table)) - len(table), np.int64)])
                table[at] += np.frombuffer(n, np.int64)  # a message has a place once
                held[level, lane] = table

        def rest():
            for (level, lane), table in held.items():
                at = np.flatnonzero(table)
                yield {"level": [level], "lane": [lane], "at": [at.astype(np.int32).tobytes()], "n": [table[at].tobytes()]}

        step.rest = rest
        return step

    schema = "level int, lane int, at binary, n binary"
    sent = map_batches(docs.select("text"), make, schema, rows=128)
    return map_batches(sent.repartition(lanes + word_lanes, "level", "lane"), merge, schema, rows=64)


def class_sizes(counts: DataFrame, names: list[bytes], own: int, endings: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each class, and distinct ones."""

    def make():
        classes = Classes(names, own, endings)
        n, v = np.zeros(classes.total, np.int64), np.zeros(classes.total, np.int64)

        def step(cols):
            k = classes.of([bytes(t) for t in cols["token"]])
            np.add.at(n, k, cols["c"])
            np.add.at(v, k, 1)

        step.rest = lambda: [{"k": list(range(classes.total)), "n": n.tolist(), "v": v.tolist()}]
        return step

    rows = map_batches(counts, make, "k int, n long, v long", rows=20_000).groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    n, v = np.zeros(own + endings, np.int64), np.zeros(own + endings, np.int64)
    for r in rows:
        n[r["k"]], v[r["k"]] = r["n"], r["v"]
    return n, v


class LogBilinear:
    """Vectors of context classes (r), predicted classes (q) and context places (p), and a bias (b)."""

    NAMES = ("r", "q", "p", "b")

    def __init__(self, unigram: np.ndarray, width: int = WIDTH, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = len(unigram)
        self.log_noise = np.log(unigram)
        self.r, self.q = rng.normal(0, 0.1, (n, width)), rng.normal(0, 0.1, (n, width))
        self.p = np.ones((CONTEXT, width)) / CONTEXT
        self.b = self.log_noise.copy()

    def get(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, flat[at:at + old.size].reshape(old.shape).copy())
            at += old.size

    def context(self, cells: np.ndarray) -> np.ndarray:
        """Classes at each place of the context, from the cell number of context and token."""
        n = len(self.b)
        return np.stack([cells // n ** (CONTEXT - k) % n for k in range(CONTEXT)], 1)

    def train(self, cells: np.ndarray, counts: np.ndarray, steps: int, batch: int, noise: int, rate: float, seed: int) -> None:
        """Noise-contrastive estimation on (context, token) by their counts; each step goes through all of them, ``batch`` contexts at
        a time in an order by ``seed``, with the expected noise, and makes an AdaGrad step for each batch."""
        rng = np.random.default_rng(seed)
        n = len(self.b)
        contexts, row = np.unique(cells // n, return_inverse=True)
        ctx, table = self.context(contexts * n), np.zeros((len(contexts), n))
        np.add.at(table, (row, cells % n), counts)
        unigram, shift = np.exp(self.log_noise), self.log_noise + math.log(noise)
        squares = {k: np.full_like(getattr(self, k), 1e-3) for k in self.NAMES}
        for _ in range(steps):
            order = rng.permutation(len(contexts))
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                true, places = table[some], ctx[some]
                each = true.sum(1)
                vectors = self.r[places]
                hidden = (vectors * self.p).sum(1)
                told = 1 / (1 + np.exp(-np.clip(hidden @ self.q.T + self.b - shift, -30, 30)))
                # the true token ought to be told from noise, the others ought not
                error = ((true + (noise * each)[:, None] * unigram) * told - true) / each.sum()
                back = error @ self.q
                grads = {"q": error.T @ hidden, "b": error.sum(0), "r": np.zeros_like(self.r), "p": np.zeros_like(self.p)}
                for k in range(CONTEXT):
                    np.add.at(grads["r"], places[:, k], back * self.p[k])
                    grads["p"][k] = (back * vectors[:, k]).sum(0)
                for k in self.NAMES:
                    squares[k] += grads[k] ** 2
                    setattr(self, k, getattr(self, k) - rate * grads[k] / np.sqrt(squares[k]))

    def log10_probabilities(self) -> np.ndarray:
        """Normalised log10 probability of every class after every context."""
        n = len(self.b)
        contexts = self.context(np.arange(n ** CONTEXT) * n)
        out = np.empty((len(contexts), n))
        for at in range(0, len(contexts), 4096):
            hidden = (self.r[contexts[at:at + 4096]] * self.p).sum(1)
            score = hidden @ self.q.T + self.b
            score -= score.max(1, keepdims=True)
            out[at:at + 4096] = (score - np.log(np.exp(score).sum(1, keepdims=True))) / math.log(10)
        return out


def fit(counts: DataFrame, unigram: np.ndarray, width: int = WIDTH, lanes: int = LANES, rounds: int = ROUNDS, steps: int = STEPS,
        batch: int = BATCH, noise: int = NOISE, rate: float = 0.15) -> tuple[LogBilinear, np.ndarray]:
    """Rounds of parallel training on the first level of ``sequence_counts``; each lane's parameters weigh as much as its rows.  With the model
    comes how often each class follows each other."""
    model, total = LogBilinear(unigram, width), len(unigram)
    follows = np.zeros((total, total))
    dealt = counts.filter(F.col("level") == 1).repartition(lanes, "lane")
    for k in range(rounds):
        start = model.get()

        def make(k=k, start=start):
            def step(cols):
                out = {c: [] for c in ("weight", "flat", "follows")}
                for lane, at, n in zip(cols["lane"], cols["at"], cols["n"]):
                    at, n = np.frombuffer(at, np.int32).astype(np.int64), np.frombuffer(n, np.int64).astype(np.float64)
                    c = (at // total * lanes + lane) * total + at % total
                    own = LogBilinear(unigram, width)
                    own.put(start)
                    own.train(c, n, steps, batch, noise, rate / (1 + k), seed=1000 * k + lane)
                    out["weight"].append(float(n.sum()))
                    out["flat"].append(own.get().tobytes())
                    out["follows"].append(None if k else np.bincount(c % total**2, n, total**2).tobytes())
                return out

            return step

        got = map_batches(dealt, make, "weight double, flat binary, follows binary").collect()  # one row per lane
        if not got:
            break
        weight = np.array([r["weight"] for r in got])
        model.put((np.array([np.frombuffer(r["flat"]) for r in got]) * weight[:, None]).sum(0) / weight.sum())
        follows += sum((np.frombuffer(r["follows"]).reshape(total, total) for r in got if r["follows"]), np.zeros((total, total)))
    return model, follows


def train_words(true: np.ndarray, noise: np.ndarray, start: np.ndarray, shift: np.ndarray, contexts: np.ndarray, steps: int = WORD_STEPS,
                ridge: float = RIDGE, rate: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and biases of some tokens.  ``true``, ``noise``: tokens x contexts, how often each follows each and the expected noise; ``shift``:
    the logarithm of each one's noise for one true token.  Every step is a pass over all of it."""
    q, b = np.zeros((len(true), contexts.shape[1]), np.float32), start.astype(np.float32)
    both, q2, b2 = true + noise, np.full_like(q, 1e-3), np.full_like(b, 1e-3)
    for _ in range(steps):
        error = q @ contexts.T
        error += (b - shift)[:, None]
        np.clip(error, -30, 30, out=error)
        np.negative(error, out=error)
        np.exp(error, out=error)
        error += 1
        np.divide(both, error, out=error)
        error -= true
        dq, db = error @ contexts + np.float32(ridge) * q, error.sum(1)
        q2 += dq * dq
        b2 += db * db
        q -= np.float32(rate) * dq / np.sqrt(q2)
        b -= np.float32(rate) * db / np.sqrt(b2)
    return q, b


def fit_words(counts: DataFrame, contexts: np.ndarray, follows: np.ndarray, kind: np.ndarray, share: np.ndarray, lanes: int = WORD_LANES,
              noise: int = NOISE) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and biases of all of the second level's tokens.  ``kind``: the class of each, ``share``: its part of the class."""
    total, width = contexts.shape

    def make():
        def step(cols):
            out = {c: [] for c in ("lane", "at", "q", "b")}
            for lane, at, n in zip(cols["lane"], cols["at"], cols["n"]):
                at, n = np.frombuffer(at, np.int32).astype(np.int64), np.frombuffer(n, np.int64)
                rows, row = np.unique(at // total, return_inverse=True)
                for a in range(0, len(rows), WORDS):
                    some = slice(*np.searchsorted(row, [a, a + WORDS]))
                    word = rows[a:a + WORDS] * lanes + lane
                    true = np.zeros((len(word), total), np.float32)
                    true[row[some] - a, at[some] % total] = n[some]
                    part = share[word]
                    false = (noise * part[:, None] * follows.T[kind[word]]).astype(np.float32)
                    log = np.log(part)
                    q, b = train_words(true, false, log, (log + math.log(noise)).astype(np.float32), contexts)
                    for c, x in zip(out, (lane, word.tobytes(), q.tobytes(), b.tobytes())):
                        out[c].append(x)
            return out

        return step

    dealt = counts.filter(F.col("level") == 2).repartition(lanes, "lane")
    q, b = np.zeros((len(kind), width), np.float32), np.log(share).astype(np.float32)
    for r in map_batches(dealt, make, "lane int, at binary, q binary, b binary", rows=1).toLocalIterator():  # head x (width + 1) numbers in all
        at = np.frombuffer(r["at"], np.int64)
        q[at], b[at] = np.frombuffer(r["q"], np.float32).reshape(-1, width), np.frombuffer(r["b"], np.float32)
    return q, b


def class_logs(q: np.ndarray, b: np.ndarray, contexts: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """contexts x classes: the logarithm of the sum of the exponents of a class's tokens' scores."""
    total = len(contexts)
    out = np.zeros((total, total))
    for at in range(0, len(b), 8192):
        score = np.exp(contexts.astype(np.float64) @ q[at:at + 8192].T.astype(np.float64) + b[at:at + 8192])
        for h in range(total):
            out[h] += np.bincount(kind[at:at + 8192], score[h], total)
    return np.log(np.where(out > 0, out, 1.0))


def language_model_scores(docs: DataFrame, training: Column, own: int = OWN, endings: int = ENDINGS, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; the model learns from the rows for which ``training`` holds."""
    taught = docs.filter(training)
    counts = written(token_counts(taught))
    known, known_counts = most_frequent(counts, head)
    names = known[:own]
    n_class, v_class = class_sizes(counts, names, own, endings)
    n_all, v_all = int(n_class.sum()), int(v_class.sum())
    unigram = (n_class + 0.5) / (n_class + 0.5).sum()
    # the end token is the last of the known ones
    at = np.array([bool(t) for t in known], bool)
    known_counts = np.concatenate([known_counts[at], known_counts[~at]])
    vocabulary = (b" ".join([t for t in known if t]), END in known, names, own, endings)
    del known
    v = Vocabulary(*vocabulary)
    kind = np.concatenate([v.kind[:-1], np.arange(own, own + endings)])  # each shared class's others come after the known tokens
    n_rest = np.maximum(n_class - np.bincount(v.kind[:-1], known_counts, own + endings), 0)
    v_rest = np.maximum(v_class - np.bincount(v.kind[:-1], minlength=own + endings), 0)
    del v
    n_item = np.concatenate([known_counts, n_rest[own:]]) + 0.5
    share = n_item / np.bincount(kind, n_item, own + endings)[kind]
    sequences = written(sequence_counts(taught, vocabulary))
    model, follows = fit(sequences, unigram)
    parameters, contexts = model.get(), model.r * model.p[-1]
    contexts = (contexts / max(np.sqrt((contexts**2).sum(1).mean()), 1e-9)).astype(np.float32)
    q, b = fit_words(sequences, contexts, follows, kind, share)
    within = class_logs(q, b, contexts, kind)
    run_id = uuid.uuid4().hex

    def tables():
        model = LogBilinear(unigram)
        model.put(parameters)
        return (Vocabulary(*vocabulary), model.log10_probabilities().ravel(), np.append(np.log10(known_counts + 1.0), 0.0),
                np.log10(n_rest + v_rest + 1.0))

    def make():
        v, table, logs, log_rest = kept(run_id, tables)
        log_all = math.log10(n_all + v_all + 1)

        def step(cols):
            flat, lens, ids, kind, before = v.read(cols["text"])
            score = table[v.cells(kind, before)]
            inside = np.flatnonzero(kind >= v.shared)
            item, last = v.items(ids[inside], kind[inside]), before[0][inside]
            score[inside] += (np.einsum("ij,ij->i", contexts[last], q[item]) + b[item] - within[last, kind[inside]]) / math.log(10)
            rare = np.flatnonzero(ids < 0)
            score[rare] -= log_rest[kind[rare]]
            first = np.cumsum(lens) - lens
            cuts = np.searchsorted(rare, [*first, len(flat)]).tolist()
            tails = [Counter([flat[i] for i in rare[x:y].tolist()]) for x, y in zip(cuts, cuts[1:])]
            return {k: cols[k] for k in ("doc_id", "k1", "k2")} | {
                "n_tokens": lens.tolist(), "head_known": [n - t.total() for n, t in zip(lens.tolist(), tails)],
                "base": (np.add.reduceat(logs[ids], first) - lens * log_all).tolist(), "model": np.add.reduceat(score, first).tolist(),
                "tail": [list(t) for t in tails], "times": [list(t.values()) for t in tails]}

        return step

    # rows that agree in id and text are alike: their tails are summed once and divided by their number
    k1, k2 = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), F.hash("text")
    named = docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2"))
    parts = written(map_batches(named, make, "doc_id long, k1 long, k2 int, n_tokens long, head_known long, base double, "
                                             "model double, tail array<binary>, times array<long>", rows=128))
    # a further entry without token counts the rows
    entry = F.explode(F.arrays_zip(F.concat("tail", F.array(F.lit(None).cast("binary"))).alias("token"),
                                   F.concat("times", F.array(F.lit(1).cast("long"))).alias("times")))
    rare = parts.filter(F.size("tail") > 0).select("k1", "k2", entry.alias("e")).select("k1", "k2", "e.token", "e.times")
    c = F.coalesce("c", F.lit(0))
    copies = F.sum(F.when(F.col("token").isNull(), 1))
    summed = (rare.join(counts, "token", "left").groupBy("k1", "k2")
              .agg((F.sum(F.when(c > 0, F.col("times")).otherwise(0)) / copies).cast("long").alias("tail_known"),
                   (F.sum(F.col("times") * F.log10(c + 1)) / copies).alias("tail_log")))
    log = F.coalesce("tail_log", F.lit(0.0))
    return (parts.drop("tail", "times").join(summed, ["k1", "k2"], "left")
            .select("doc_id", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                    F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base") + log).alias("base_score"),
                    (F.col("model") + log).alias("score")))

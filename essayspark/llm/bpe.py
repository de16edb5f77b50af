"""BPE encoding and decoding with a public vocabulary (operator 9).

The vocabulary splits a text into words by a pattern and merges inside a
word only, so a text is encoded word by word and every distinct word of a
task once.  A word may still be very long (a text without white space).  Such
*unsplit* text is encoded by tree concatenation: its halves are encoded
on their own, then a window of tokens around the join is encoded again and
doubled until its first token equals the left half's token there and its
last token the right half's.  All neighbouring pairs of tokens are then
pairs that the merge rules produce, and a sequence with that property is the
only encoding of its text, so the result is exact.

Long runs are cut into pieces that Spark spreads over all tasks; the joins
of one text's pieces are done where its rows meet.  Nothing larger than one
text ever meets in a task.

Input: ``doc_id`` and ``text``; other columns are ignored, so their names
cannot clash.  A null text is the empty text: no ids, decoded text "".
Repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import json
import re
from pathlib import Path

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.common import map_batches

#: Unsplit runs of more code points are spread over tasks in pieces of this size.
PIECE = 16_384
#: Inside a task, unsplit text is halved down to so many symbols.
LEAF = 256
#: Words whose encoding a task remembers; beyond that it starts anew.
MEMO = 400_000

# Code points for which Python's and the tokenizer's lower case, composition
# and classes agree without question: Latin letters and common punctuation.
_PLAIN = regex.compile("[^\t\n\r\x20-\x7e¡-¬®-ɏ‐-―‘-…€]")


def tokenizer_path(name: str) -> str:
    """A path is used as it is; a bare file name is looked up among the public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Coder:
    """Encodes texts as the tokenizer in ``path`` does without special tokens added."""

    def __init__(self, path: str, leaf: int = LEAF, memo: int = MEMO):
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text("utf-8"))
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.whole = Tokenizer.from_file(path)
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": [], "truncation": None, "padding": None}
        self.ending = Tokenizer.from_str(json.dumps(bare))
        self.inner = Tokenizer.from_str(json.dumps(bare | {"model": spec["model"] | {"end_of_word_suffix": None}}))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in self.special) + ")").split if self.special else lambda t: [t]
        self.symbols = _byte_symbols()
        self.tokens = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        self.leaf, self.limit, self.memo = leaf, memo, {}
        for t, i in self.special.items():
            self._keep("\0" + t, [i])

    def _keep(self, word: str, ids: list[int]) -> None:
        self.memo[word] = (np.array(ids, "<u4").tobytes(), " ".join([self.tokens[i] for i in ids]))

    # ---- unsplit text -------------------------------------------------------------
    def mapped(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.symbols)

    def part(self, symbols: str, last: bool) -> list[int]:
        """Encode symbols that end a word (``last``) or that something follows, by halves."""
        if len(symbols) <= self.leaf:
            return (self.ending if last else self.inner).encode(symbols, add_special_tokens=False).ids
        half = len(symbols) // 2
        return self.join(self.part(symbols[:half], False), self.part(symbols[half:], last), last)

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """One encoding from the encodings of two neighbouring parts."""
        k = 4
        while left and right:
            a, b = left[-k:], right[:k]
            from_start, to_end = len(left) <= k, len(right) <= k
            text = "".join([self.bare(i) for i in a]) + "".join([self.bare(i) for i in b])
            mid = (self.ending if last and to_end else self.inner).encode(text, add_special_tokens=False).ids
            if (from_start or mid[0] == a[0]) and (to_end or mid[-1] == b[-1]):
                return left[: len(left) - len(a)] + mid + right[len(b):]
            k *= 2
        return left or right

    def bare(self, token: int) -> str:
        return self.tokens[token].removesuffix(self.suffix) if self.suffix else self.tokens[token]

    # ---- whole texts --------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """The words of a text in order; a special token is marked with a leading NUL."""
        out = []
        for k, part in enumerate(self.cut(text)):
            if k % 2:
                out.append("\0" + part)
            elif _PLAIN.search(part) is None:
                out += self.words(part.lower())
            elif part:  # the library's own rules for every other script
                plain = self.whole.normalizer.normalize_str(part)
                out += self.words(plain)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not remembered yet."""
        if len(self.memo) + len(words) > self.limit:
            self.memo = {k: v for k, v in self.memo.items() if k[:1] == "\0"}
        new = [w for w in words if w not in self.memo]
        short = [w for w in new if len(w) <= self.leaf // 4]
        for w, e in zip(short, self.ending.encode_batch([self.mapped(w) for w in short], add_special_tokens=False)):
            self._keep(w, e.ids)
        for w in new:
            if len(w) > self.leaf // 4:
                self._keep(w, self.part(self.mapped(w), True))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """Per text: the ids as little-endian 32-bit integers, and the decoded text."""
        split = [self.split(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        out = []
        for words in split:
            got = [self.memo[w] for w in words]
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got])))
        return out


@functools.lru_cache(maxsize=4)
def coder(name: str, leaf: int = LEAF, memo: int = MEMO) -> Coder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
    return Coder(tokenizer_path(name), leaf, memo)


def encode_documents(docs: DataFrame, tokenizer: str, piece: int = PIECE, leaf: int = LEAF) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers), decoded
    (the ids decoded again, special tokens kept), n_tokens."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # a run without white space of more than ``piece`` code points
    unsplit = (F.length("text") > piece) & F.exists(F.split("text", r"\s+"), lambda w: F.length(w) > piece)

    def simple():
        c = coder(tokenizer, leaf)

        def step(cols):
            got = c.encode(cols["text"])
            return {"doc_id": cols["doc_id"], "ids": [g[0] for g in got], "decoded": [g[1] for g in got]}

        return step

    short = map_batches(docs.filter(~unsplit), simple, "doc_id long, ids binary, decoded string", rows=256)
    long = _encode_pieces(docs.filter(unsplit), tokenizer, piece, leaf)
    return short.unionByName(long).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def _encode_pieces(docs: DataFrame, tokenizer: str, piece: int, leaf: int) -> DataFrame:
    """Texts with long unsplit runs: pieces as rows, encoded anywhere, joined per text.

    A row is a piece of an unsplit run (kind 0: something of the run follows, kind 1:
    its end) or the words between two runs (kind 2).  Rows of a text are keyed
    by its id and hash, so repeated rows of a text are encoded once per
    copy number and a null id is a key of its own."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    copies = keyed.groupBy("doc_id", "h").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))

    def cut():
        c = coder(tokenizer, leaf)

        def step(cols):
            out = {n: [] for n in ("doc_id", "h", "n", "seq", "kind", "body", "words")}
            for doc_id, h, n, text in zip(cols["doc_id"], cols["h"], cols["n"], cols["text"]):
                rows, plain = [], []
                for w in c.split(text):
                    if len(w) <= piece:
                        plain.append(w)
                        continue
                    if plain:
                        rows.append((2, "", plain))
                        plain = []
                    s = c.mapped(w)
                    rows += [(int(at + piece >= len(s)), s[at:at + piece], []) for at in range(0, len(s), piece)]
                if plain or not rows:
                    rows.append((2, "", plain))
                for seq, row in enumerate(rows):
                    for name, v in zip(out, (doc_id, h, n, seq, *row)):
                        out[name].append(v)
            return out

        return step

    def encode():
        c = coder(tokenizer, leaf)

        def step(cols):
            ids = []
            for kind, body, words in zip(cols["kind"], cols["body"], cols["words"]):
                if kind == 2:
                    c.learn(set(words))
                    ids.append(b"".join([c.memo[w][0] for w in words]))
                else:
                    ids.append(np.array(c.part(body, kind == 1), "<u4").tobytes())
            return {k: cols[k] for k in ("doc_id", "h", "n", "seq", "kind")} | {"ids": ids}

        return step

    def concatenate(rows):
        import pandas as pd

        c = coder(tokenizer, leaf)
        rows = rows.sort_values("seq")
        parts, run = [], []
        for kind, ids in zip(rows["kind"], rows["ids"]):
            ids = np.frombuffer(ids, "<u4").tolist()
            if kind == 2:
                parts += ids
                continue
            run.append((ids, kind == 1))
            if kind == 1:  # the run is complete: neighbours are joined level by level
                while len(run) > 1:
                    pairs = zip(run[::2], run[1::2])
                    run = [(c.join(a[0], b[0], b[1]), b[1]) for a, b in pairs] + (run[-1:] if len(run) % 2 else [])
                parts += run[0][0]
                run = []
        ids = np.array(parts, "<u4").tobytes()
        decoded = " ".join([c.tokens[i] for i in parts])
        return pd.DataFrame({"doc_id": rows["doc_id"].iloc[:1], "n": rows["n"].iloc[:1], "ids": [ids], "decoded": [decoded]})

    pieces = map_batches(copies, cut, "doc_id long, h long, n long, seq long, kind int, body string, words array<string>", rows=8)
    pieces = pieces.repartition("doc_id", "h", "seq")
    coded = map_batches(pieces, encode, "doc_id long, h long, n long, seq long, kind int, ids binary", rows=8)
    whole = coded.groupBy("doc_id", "h").applyInPandas(concatenate, "doc_id long, n long, ids binary, decoded string")
    return whole.select("doc_id", "ids", "decoded", F.explode(F.sequence(F.lit(1), "n"))).drop("col")

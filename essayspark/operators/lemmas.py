"""Lemmas that the dictionary attests (T8, T20, A10 with S4).

Detachment rules give a word several candidates (``hoping``: hop, hope).  Only candidates that occur in the corpus dictionary
count, and the most frequent one is the lemma (equal counts: the longer, then the first in order); a word without any is its own lemma.
The closed-class lexicon comes first.  A lemma depends on the word alone, so it is found once for each distinct word by a
join with the dictionary.  Texts are dealt by key to blocks of about ``BLOCK_BYTES``: a block's distinct words join the table
of lemmas, not its tokens, and the answers meet the block's texts.  So texts are shuffled, never one row for each token.
Both tables grow with the vocabulary; the planner decides by their bytes whether a join broadcasts.

A null or empty text has no words: lemma count 0, lemmatised text "".  Texts that share a key count as one, their tokens
in order of place and then lemma; a null key has no words.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from essayspark.functions import lexicon as L
from essayspark.functions.patterns import ALNUM_TOKEN
from essayspark.functions.patterns import sql_str as q
from essayspark.operators.features import lower_tokens
from essayspark.session import ship_package

#: UTF-8 bytes of the texts that meet their words' lemmas at a time, on average.
BLOCK_BYTES = 8_000_000

# ---- fixed values: detachment rules (tag, ending, replacement) --------------------
RULES = [
    ("N", "s", ""), ("N", "ses", "s"), ("N", "ves", "f"), ("N", "ves", "fe"), ("N", "xes", "x"), ("N", "zes", "z"),
    ("N", "ches", "ch"), ("N", "shes", "sh"), ("N", "men", "man"), ("N", "ies", "y"),
    ("V", "s", ""), ("V", "ies", "y"), ("V", "es", "e"), ("V", "es", ""), ("V", "ied", "y"),
    ("V", "ed", "e"), ("V", "ed", ""), ("V", "ing", "e"), ("V", "ing", ""),
    ("J", "er", ""), ("J", "est", ""), ("J", "er", "e"), ("J", "est", "e"), ("J", "ier", "y"), ("J", "iest", "y"),
]
#: After these endings a doubled last letter may lose its second half (running: run).
UNDOUBLED = {("V", "ed"), ("V", "ing"), ("J", "er"), ("J", "est")}
#: Letters that must be left before an ending.
MIN_STEM = 2


def candidates(word: Column, tag: Column) -> Column:
    """Array of possible lemmas of a lower-cased word; other tags are treated as nouns."""
    kind = F.when(tag.isin("N", "V", "J"), tag).otherwise(F.lit("N"))
    out = []
    for t, ending, rep in RULES:
        stem = F.substr(word, F.lit(1), F.length(word) - len(ending))
        fits = (kind == t) & word.endswith(ending) & (F.length(word) >= len(ending) + MIN_STEM)
        out.append(F.when(fits, F.concat(stem, F.lit(rep))))
        if not rep and (t, ending) in UNDOUBLED:
            doubled = F.substr(stem, F.length(stem), F.lit(1)) == F.substr(stem, F.length(stem) - 1, F.lit(1))
            out.append(F.when(fits & doubled & (F.length(stem) > MIN_STEM), F.substr(stem, F.lit(1), F.length(stem) - 1)))
    return F.array_compact(F.array(*out))


def lemma_table(texts: DataFrame, dictionary: DataFrame, text: str = "essay") -> DataFrame:
    """(word, tag, lemma) of every distinct lower-cased token of ``texts``; ``dictionary`` has word, n."""
    words = texts.select(F.explode(F.array_distinct(lower_tokens(text))).alias("word")).distinct()
    tagged = words.select("word", L.pos_tag(F.col("word")).alias("tag"))
    fixed = F.col("word").isin(*sorted(L.LEX_LEMMA))
    # one pass over the words: those without candidates stay, with a null
    tried = F.when(~fixed, F.array_distinct(candidates(F.col("word"), F.col("tag"))))
    known = dictionary.select(F.col("word").alias("lemma"), "n")
    order = F.struct((-F.col("n")).alias("n"), (-F.length("lemma")).alias("len"), "lemma")
    best = (tagged.select("word", "tag", F.explode_outer(tried).alias("lemma")).join(known, "lemma", "left").groupBy("word", "tag")
            .agg(F.min(F.when(F.col("n").isNotNull(), order))["lemma"].alias("best")))
    return best.select("word", "tag", F.when(fixed, L.lemma(F.col("word"), F.col("tag"))).otherwise(F.coalesce("best", "word")).alias("lemma"))


def lemma_table_sql(tokens: str, dictionary: str) -> str:
    """``tokens``: a query with column t; ``dictionary``: a query with word, n."""
    rules = ", ".join(f"({q(t)}, {q(e)}, {q(r)}, {str(not r and (t, e) in UNDOUBLED).lower()})" for t, e, r in RULES)
    return f"""
WITH words AS (SELECT DISTINCT lower(t) AS word FROM ({tokens})),
tagged AS (SELECT w.word, coalesce(lex.tag, {L.pos_tag_sql('w.word')}) AS tag, lex.lemma AS lex_lemma
           FROM words w LEFT JOIN {L.lexicon_values_sql()} ON lex.word = w.word),
stems AS (SELECT word, rep, undouble, substr(word, 1, length(word) - length(ending)) AS stem
          FROM tagged JOIN (VALUES {rules}) AS r(kind, ending, rep, undouble)
            ON r.kind = CASE WHEN tag IN ('N', 'V', 'J') THEN tag ELSE 'N' END AND suffix(word, ending) AND length(word) >= length(ending) + {MIN_STEM}
          WHERE lex_lemma IS NULL),
tried AS (SELECT word, stem || rep AS lemma FROM stems
          UNION SELECT word, substr(stem, 1, length(stem) - 1) FROM stems WHERE undouble AND length(stem) > {MIN_STEM} AND stem[-1] = stem[-2]),
best AS (SELECT word, lemma FROM (SELECT t.word, t.lemma, row_number() OVER (PARTITION BY t.word ORDER BY d.n DESC, length(t.lemma) DESC, t.lemma) AS k
                                  FROM tried t JOIN ({dictionary}) d ON d.word = t.lemma) WHERE k = 1)
SELECT t.word, t.tag, coalesce(t.lex_lemma, b.lemma, t.word) AS lemma FROM tagged t LEFT JOIN best b ON b.word = t.word
"""


def _words(text: str | None) -> list[str]:
    """As ``lower_tokens``; tokens are ASCII, so they are lower-cased together."""
    return " ".join(re.findall(ALNUM_TOKEN, text or "")).lower().split()


def _in_blocks(texts: DataFrame, lemmas: DataFrame, key: str, text: str, value: Callable[[list[str]], object], none: Column) -> DataFrame:
    """(key, value): ``value`` of the lemmas of every text's tokens, in order; ``none`` for a null key.  Tokens that
    ``lemmas`` does not list are left out."""
    ship_package(texts.sparkSession)
    held = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    blocks = (held.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES + 1
    dealt = held.filter(F.col("key").isNotNull()).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))

    def listing(some: pa.Table) -> pa.Table:
        found = {w for t in some["text"].to_pylist() for w in _words(t)}
        return pa.table({"block": pa.repeat(some["block"][0], len(found)), "word": pa.array(found, pa.string())})

    # both uses of ``dealt`` need all its columns by block: one shuffle serves them
    needed = dealt.groupBy("block").applyInArrow(listing, "block long, word string")
    known = needed.join(lemmas.select("word", "lemma"), "word").select(F.col("block").alias("at"), "word", "lemma")
    kind = f"key {dict(dealt.dtypes)['key']}, value {dict(texts.select(none.alias('value')).dtypes)['value']}"
    fields = texts.sparkSession.createDataFrame([], kind).schema

    def run(some: pa.Table, known: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        lemma = dict(zip(known["word"].to_pylist(), known["lemma"].to_pylist())) if known.num_rows else {}
        keys, found = some["key"].to_pylist(), {}
        for k, t in zip(keys, some["text"].to_pylist()):
            found.setdefault(k, []).append([lemma.get(w) for w in _words(t)])
        for k, lines in found.items():
            if len(lines) > 1:
                lines = [[x for _, x in sorted((i, x) for line in lines for i, x in enumerate(line) if x is not None)]]
            found[k] = value([x for x in lines[0] if x is not None])
        out = to_arrow_schema(fields)
        return pa.table([some["key"].cast(out.field("key").type), pa.array([found[k] for k in keys], out.field("value").type)], schema=out)

    done = dealt.groupBy("block").cogroup(known.groupBy("at")).applyInArrow(run, kind)
    return done.unionByName(held.filter(F.col("key").isNull()).select("key", none.alias("value")))


def lemma_counts(texts: DataFrame, lemmas: DataFrame, key: str = "essay_id", text: str = "essay") -> DataFrame:
    """(key, lemma_count): distinct lemmas of every text."""
    n = _in_blocks(texts, lemmas, key, text, lambda found: len(set(found)), F.lit(0).cast("bigint"))
    return n.select(F.col("key").alias(key), F.col("value").alias("lemma_count"))


def lemmatised(texts: DataFrame, lemmas: DataFrame, key: str = "essay_id", text: str = "essay") -> DataFrame:
    """(key, lemmatised): every token replaced by its lemma, joined by blanks."""
    lines = _in_blocks(texts, lemmas, key, text, " ".join, F.lit(""))
    return lines.select(F.col("key").alias(key), F.col("value").alias("lemmatised"))

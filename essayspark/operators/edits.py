"""Grammar corrections as edits (T21): spans of (offset, length, replacement, rule), applied once.

A text is cut into pieces that cover it: words, runs of blanks, single other characters.  A rule looks at a piece and its
neighbours; every piece has at most one edit, the first rule of its kind that holds, so edits never overlap and
their order does not matter:

* blanks: ``double_word`` (between equal words: they go with the second word), ``space_before_punct``, ``double_space``;
* words: ``lone_i``, ``sentence_start`` (a lower-case ASCII letter at the text's start or after ``. ! ?`` and blanks); a word that
  a ``double_word`` edit removes has none.

Rules are built-in expressions over arrays; only the running sum of piece lengths is a numpy helper on Arrow
batches.  Row-local, no shuffle, linear in the text.  A null text has no edits and stays null.  Offsets count code points from 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from essayspark.functions import patterns as P
from essayspark.functions.patterns import sql_str as q
from essayspark.session import ship_package

_WORD_CLASS = f"[{P.WORD_CHARS}']"
PIECE = f"({_WORD_CLASS}+| +|[^{P.WORD_CHARS}' ])"
# ---- fixed values: words that stand twice in correct sentences, and marks --------
MAY_DOUBLE = ["had", "that"]
NO_BLANK_BEFORE = [",", ".", ";", ":", "!", "?"]
SENTENCE_ENDS = [".", "!", "?"]


@F.arrow_udf(ArrayType(LongType()))
def _starts(lengths: pa.Array) -> pa.Array:
    """Running sums that begin with 0, over a batch's flat values: no Python object per text or piece."""
    n = lengths.flatten().to_numpy(zero_copy_only=False)  # without those under a null
    sizes = lengths.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    starts = np.cumsum(n, dtype=np.int64)
    starts -= n
    if len(n):
        starts -= np.repeat(starts[np.minimum(ends - sizes, len(n) - 1)], sizes)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(starts), mask=lengths.is_null())


def _is_word(piece: Column) -> Column:
    return piece.rlike(f"^{_WORD_CLASS}")


def _same(a: Column, b: Column) -> Column:
    # cheap tests first
    return (F.length(a) == F.length(b)) & (F.lower(a) == F.lower(b)) & _is_word(a) & ~F.lower(a).isin(*MAY_DOUBLE)


def _rule(x: Column) -> Column:
    w, before, before2, after = x["w"], x["b1"], x["b2"], F.coalesce(x["a1"], F.lit(""))
    blank = w.startswith(" ")
    start = (w >= "a") & (w < "{") & ((before == "") | (before.startswith(" ") & before2.isin(*SENTENCE_ENDS)))
    # a piece is either kind: its first character is looked at once
    blanks = (F.when(_same(before, after), F.lit("double_word"))
              .when(after.isin(*NO_BLANK_BEFORE), F.lit("space_before_punct"))
              .when(F.length(w) > 1, F.lit("double_space")))
    words = (F.when(before.startswith(" ") & _same(before2, w), F.lit("removed"))
             .when(w == "i", F.lit("lone_i"))
             .when(start, F.lit("sentence_start")))
    return F.when(blank, blanks).otherwise(words)


def _replacement(x: Column) -> Column:
    return (F.when(x["rule"] == "double_space", F.lit(" ")).when(x["rule"] == "lone_i", F.lit("I"))
            .when(x["rule"] == "sentence_start", F.upper(F.substring(x["w"], 1, 1))).otherwise(F.lit("")))


def with_pieces(df: DataFrame, text: str = "essay", starts: bool = True) -> DataFrame:
    """Add ``pieces``: array of (w, after, start, rule), ``after`` being the next piece; without ``starts`` these are
    null and no Python runs."""
    cut = df.withColumn("pieces", F.regexp_extract_all(F.col(text), F.lit(PIECE), 1))
    p, none = F.col("pieces"), F.lit("")
    zipped = F.arrays_zip(p.alias("w"), F.concat(F.array(none), p).alias("b1"), F.concat(F.array(none, none), p).alias("b2"),
                          F.slice(p, 2, F.greatest(F.size(p), F.lit(1))).alias("a1"), F.col("starts").alias("s"))
    ruled = F.transform(F.filter(zipped, lambda x: x["w"].isNotNull()),
                        lambda x: F.struct(x["w"].alias("w"), x["a1"].alias("after"), x["s"].alias("start"), _rule(x).alias("rule")))
    begin = F.array().cast("array<bigint>")  # the zip fills it up with nulls
    if starts:
        ship_package(df.sparkSession)
        begin = _starts(F.transform("pieces", lambda w: F.length(w)))
    return cut.withColumn("starts", begin).withColumn("pieces", ruled).drop("starts")


def edits(df: DataFrame, key: str = "essay_id", text: str = "essay") -> DataFrame:
    """(key, offset, length, replacement, rule), one row per edit."""
    found = with_pieces(df.select(key, text), text).select(
        key, F.explode(F.filter("pieces", lambda x: x["rule"].isNotNull() & (x["rule"] != "removed"))).alias("x"))
    x = F.col("x")
    length = (F.when(x["rule"] == "double_word", F.length(x["w"]) + F.length(x["after"])).when(x["rule"] == "sentence_start", F.lit(1))
              .otherwise(F.length(x["w"])))
    return found.select(key, x["start"].alias("offset"), length.cast("bigint").alias("length"), _replacement(x).alias("replacement"),
                        x["rule"].alias("rule"))


def corrected(df: DataFrame, key: str = "essay_id", text: str = "essay") -> DataFrame:
    """(key, n_edits, corrected): the text with all edits applied."""
    def apply(x: Column) -> Column:
        rest = F.when(x["rule"] == "sentence_start", F.substr(x["w"], F.lit(2))).otherwise(F.lit(""))
        return F.when(x["rule"].isNull(), x["w"]).otherwise(F.concat(_replacement(x), rest))

    n = F.size(F.filter("pieces", lambda x: x["rule"].isNotNull() & (x["rule"] != "removed"))).cast("bigint")
    return with_pieces(df.select(key, text), text, starts=False).select(
        key, F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(n).cast("bigint").alias("n_edits"),
        F.array_join(F.transform("pieces", apply), "").alias("corrected"))


def _list(words: list[str]) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def pieces_sql(rows: str, key: str = "essay_id", text: str = "essay") -> str:
    """One row per piece: key, i, w, after, start, rule, replacement."""
    def same(a, b):
        return f"(regexp_matches({a}, {q('^' + _WORD_CLASS)}) AND length({a}) = length({b}) AND lower({a}) = lower({b}) AND lower({a}) NOT IN {_list(MAY_DOUBLE)})"

    return f"""
SELECT *, CASE rule WHEN 'double_space' THEN ' ' WHEN 'lone_i' THEN 'I' WHEN 'sentence_start' THEN upper(w[1]) ELSE '' END AS replacement
FROM (SELECT *, CASE WHEN starts_with(w, ' ') AND {same('b1', 'after')} THEN 'double_word'
                     WHEN starts_with(w, ' ') AND after IN {_list(NO_BLANK_BEFORE)} THEN 'space_before_punct'
                     WHEN starts_with(w, ' ') AND length(w) > 1 THEN 'double_space'
                     WHEN NOT starts_with(w, ' ') AND starts_with(b1, ' ') AND {same('b2', 'w')} THEN 'removed'
                     WHEN w = 'i' THEN 'lone_i'
                     WHEN regexp_matches(w, '^[a-z]') AND (b1 = '' OR starts_with(b1, ' ') AND b2 IN {_list(SENTENCE_ENDS)}) THEN 'sentence_start'
                END AS rule
      FROM (SELECT *, lag(w, 1, '') OVER o AS b1, lag(w, 2, '') OVER o AS b2, lead(w, 1, '') OVER o AS after,
                   sum(length(w)) OVER o - length(w) AS start
            FROM (SELECT {key}, unnest(ps) AS w, generate_subscripts(ps, 1) AS i
                  FROM (SELECT {key}, regexp_extract_all({text}, {q(PIECE)}, 1) AS ps FROM {rows} r))
            WINDOW o AS (PARTITION BY {key} ORDER BY i)))
"""

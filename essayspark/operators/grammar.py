"""Rule-based grammar findings and correction (T21, re-aimed).

The reference sends every essay to an external grammar-checking process.
Here a fixed, ordered rule table is applied with regex expressions inside
the plan: findings are counts per rule, the correction is the chain of
regex replacements.  Row-local, no shuffle, no external process.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from essayspark.functions import lexicon as L
from essayspark.functions import patterns as P
from essayspark.functions import text as T
from essayspark.functions.patterns import sql_str as q


def _spark_rep(rep: str) -> str:
    return rep.replace("{1}", "$1").replace("{2}", "$2")


def _sql_rep(rep: str) -> str:
    return rep.replace("{1}", "\\1").replace("{2}", "\\2")


def double_words(text: Column) -> Column:
    """Adjacent equal words (case-insensitive) with only blanks between.

    ``zip_with`` pairs each token with its predecessor, so the token array
    is computed once (indexing it inside a lambda would recompute it for
    every element)."""
    t = T.raw_tokens(text)
    pairs = F.zip_with(F.slice(t, 2, F.greatest(F.size(t), F.lit(1))), t,
                       lambda a, b: a.rlike(P.WORD) & (F.lower(a) == F.lower(b)))
    return F.size(F.filter(pairs, lambda x: F.coalesce(x, F.lit(False)))).cast("bigint")


def double_words_sql(e: str) -> str:
    t = T.raw_tokens_sql(e)
    return (f"CAST((SELECT count(*) FROM (SELECT {t} AS t) s, range(2, len(s.t) + 1) r(i) "
            f"WHERE regexp_matches(s.t[i], {q(P.WORD)}) AND lower(s.t[i]) = lower(s.t[i - 1])) AS BIGINT)")


# A match takes its neighbours with it; with every separator doubled, "i i i" has one for each side.
SEPARATOR = r"([^\p{L}\p{N}_'])"


def findings(text: str | Column) -> dict[str, Column]:
    c = F.col(text) if isinstance(text, str) else text
    out = {"n_double_word": double_words(c)}
    for name, pat, _ in L.GRAMMAR_RULES:
        seen = F.regexp_replace(c, SEPARATOR, "$1$1") if name == "lone_i" else c
        out[f"n_{name}"] = F.regexp_count(seen, F.lit(pat)).cast("bigint")
    out["n_lower_start"] = F.regexp_count(c, F.lit(L.LOWER_START)).cast("bigint")
    return out


def findings_sql(e: str) -> dict[str, str]:
    out = {"n_double_word": double_words_sql(e)}
    for name, pat, _ in L.GRAMMAR_RULES:
        seen = f"regexp_replace({e}, {q(SEPARATOR)}, '\\1\\1', 'g')" if name == "lone_i" else e
        out[f"n_{name}"] = f"CAST(len(regexp_extract_all({seen}, {q(pat)})) AS BIGINT)"
    out["n_lower_start"] = f"CAST(len(regexp_extract_all({e}, {q(L.LOWER_START)})) AS BIGINT)"
    return out


def corrected(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    for name, pat, rep in L.GRAMMAR_RULES:
        for _ in range(2 if name == "lone_i" else 1):  # neighbours share a separator
            c = F.regexp_replace(c, pat, _spark_rep(rep))
    return c


def corrected_sql(e: str) -> str:
    for name, pat, rep in L.GRAMMAR_RULES:
        for _ in range(2 if name == "lone_i" else 1):
            e = f"regexp_replace({e}, {q(pat)}, {q(_sql_rep(rep))}, 'g')"
    return e


def check(df: DataFrame, text: str = "essay") -> DataFrame:
    """Add one count column per rule and the ``corrected`` text."""
    cols = findings(text)
    return df.select("*", *[v.alias(k) for k, v in cols.items()], corrected(text).alias("corrected"))

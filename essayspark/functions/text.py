"""Per-text features as Spark column expressions.

Every function returns a ``Column`` built only from built-in functions and
higher-order array functions, so it stays inside whole-stage codegen and
never crosses into Python.  Each has a twin ``*_sql`` that renders the same
rule as DuckDB SQL text for the oracle; both are generated from the shared
patterns in :mod:`essayspark.functions.patterns`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from essayspark.functions import patterns as P
from essayspark.functions.patterns import sql_str as q


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- T26 strip
def strip(c) -> Column:
    """Python ``str.strip()``: Unicode white space at both ends."""
    return F.regexp_replace(_c(c), f"^{P.WS}+|{P.WS}+$", "")


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, {q(f'^{P.WS}+|{P.WS}+$')}, '', 'g')"


# ---------------------------------------------------------------- T3 words
def word_count(c) -> Column:
    """Runs of word characters (``re.sub(r'\\W',' ')`` then tokens)."""
    return F.regexp_count(_c(c), F.lit(P.WORD + "+")).cast("bigint")


def word_count_sql(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, {q(P.WORD + '+')})) AS BIGINT)"


# ---------------------------------------------------------------- T4 mean word length
def avg_word_len(c) -> Column:
    """Letters in words / words; null for a text without words."""
    n_chars = F.length(F.regexp_replace(_c(c), P.NON_WORD, ""))
    return F.try_divide(n_chars.cast("double"), word_count(c).cast("double"))


def avg_word_len_sql(e: str) -> str:
    wc = word_count_sql(e)
    return (f"CASE WHEN {wc} = 0 THEN NULL ELSE "
            f"CAST(length(regexp_replace({e}, {q(P.NON_WORD)}, '', 'g')) AS DOUBLE) / {wc} END")


# ---------------------------------------------------------------- T5 characters
def char_count(c) -> Column:
    """Characters other than white space, after lower-casing."""
    return F.length(F.regexp_replace(F.lower(_c(c)), P.WS, "")).cast("bigint")


def char_count_sql(e: str) -> str:
    return f"CAST(length(regexp_replace(lower({e}), {q(P.WS)}, '', 'g')) AS BIGINT)"


# ---------------------------------------------------------------- T6 / T2 sentences
def sentences(c) -> Column:
    """Split into sentences by the boundary rule; blank pieces dropped."""
    marked = F.regexp_replace(F.translate(strip(c), P.SENT_MARK, ""), P.SENT_BOUNDARY_GROUPED, "$1" + P.SENT_MARK)
    pieces = F.split(marked, P.SENT_MARK, -1)
    return F.filter(pieces, lambda p: p.rlike(P.NON_WS))


def sentences_sql(e: str) -> str:
    marked = f"regexp_replace(replace({strip_sql(e)}, chr(1), ''), {q(P.SENT_BOUNDARY_GROUPED)}, '\\1' || chr(1), 'g')"
    return (f"list_filter(string_split({marked}, chr(1)), "
            f"lambda p: regexp_matches(p, {q(P.NON_WS)}))")


def sent_count(c) -> Column:
    return F.size(sentences(c)).cast("bigint")


def sent_count_sql(e: str) -> str:
    return f"CAST(len({sentences_sql(e)}) AS BIGINT)"


# ---------------------------------------------------------------- T1 / T2 tokens
def alnum_tokens(c) -> Column:
    """``re.sub('[^a-zA-Z0-9]',' ')`` then word tokens."""
    return F.regexp_extract_all(_c(c), F.lit(P.ALNUM_TOKEN), 1)


def alnum_tokens_sql(e: str) -> str:
    return f"regexp_extract_all({e}, {q(P.ALNUM_TOKEN)}, 1)"


def sentence_tokens(c) -> Column:
    """Sentences, each as its list of alphanumeric tokens."""
    return F.transform(sentences(c), lambda s: alnum_tokens(strip(s)))


def sentence_tokens_sql(e: str) -> str:
    return f"list_transform({sentences_sql(e)}, lambda s: {alnum_tokens_sql(strip_sql('s'))})"


def text_tokens(c) -> Column:
    """All alphanumeric tokens of all sentences, in order (U2 flatten)."""
    return F.flatten(sentence_tokens(c))


def text_tokens_sql(e: str) -> str:
    return f"flatten({sentence_tokens_sql(e)})"


# ---------------------------------------------------------------- T10 clean words
def clean_words(c) -> Column:
    """Lower-case alphabetic words: non-letters to blanks, lower, split."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(_c(c), "[^a-zA-Z]", " ")),
                                F.lit(P.ALPHA_TOKEN), 1)


def clean_words_sql(e: str) -> str:
    return (f"regexp_extract_all(lower(regexp_replace({e}, '[^a-zA-Z]', ' ', 'g')), "
            f"{q(P.ALPHA_TOKEN)}, 1)")


def remove_words(arr: Column, stops: list[str]) -> Column:
    """Stop-word removal against a fixed list (J3), kept JVM side.

    ``isin`` over many literals is planned as ``InSet`` (a hash set), so
    each word costs one lookup instead of a scan of the list."""
    return F.filter(arr, lambda w: ~w.isin(*stops))


def remove_words_sql(e: str, stops: list[str]) -> str:
    lit = "[" + ", ".join(q(w) for w in stops) + "]"
    return f"list_filter({e}, lambda w: NOT list_contains({lit}, w))"


# ---------------------------------------------------------------- T11 white-space words
def ws_word_count(c) -> Column:
    return F.regexp_count(_c(c), F.lit(P.NON_WS + "+")).cast("bigint")


def ws_word_count_sql(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, {q(P.NON_WS + '+')})) AS BIGINT)"


# ---------------------------------------------------------------- T12 ASCII clean
def ascii_clean(c) -> Column:
    return F.regexp_replace(_c(c), P.NON_ASCII_RUN, " ")


def ascii_clean_sql(e: str) -> str:
    return f"regexp_replace({e}, {q(P.NON_ASCII_RUN)}, ' ', 'g')"


# ---------------------------------------------------------------- T14 lexicon words
def lexicon_words(c) -> Column:
    """Words after deleting ASCII punctuation, split on white space."""
    return F.regexp_extract_all(F.regexp_replace(_c(c), P.ASCII_PUNCT, ""),
                                F.lit(f"({P.NON_WS}+)"), 1)


def lexicon_words_sql(e: str) -> str:
    return (f"regexp_extract_all(regexp_replace({e}, {q(P.ASCII_PUNCT)}, '', 'g'), "
            f"{q(f'({P.NON_WS}+)')}, 1)")


# ---------------------------------------------------------------- T13 syllables
def syllables(words: Column) -> Column:
    """Sum over words of max(1, vowel runs - silent final e)."""
    per_word = F.transform(
        words,
        lambda w: F.greatest(
            F.lit(1),
            F.regexp_count(F.lower(w), F.lit(P.VOWEL_RUN))
            - F.when(F.lower(w).rlike(P.SILENT_E), 1).otherwise(0)),
    )
    return F.aggregate(per_word, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def syllables_sql(words: str) -> str:
    return (
        "CAST(coalesce(list_sum(list_transform(" + words + ", lambda w: greatest(1, "
        f"len(regexp_extract_all(lower(w), {q(P.VOWEL_RUN)})) - "
        f"CASE WHEN regexp_matches(lower(w), {q(P.SILENT_E)}) THEN 1 ELSE 0 END))), 0) AS BIGINT)"
    )


# ---------------------------------------------------------------- T19 raw tokens
def raw_tokens(c) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(P.RAW_TOKEN), 1)


def raw_tokens_sql(e: str) -> str:
    return f"regexp_extract_all({e}, {q(P.RAW_TOKEN)}, 1)"


# ---------------------------------------------------------------- T24 vectorizer tokens
def vectorizer_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(P.VECTORIZER_TOKEN), 1)


def vectorizer_tokens_sql(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {q(P.VECTORIZER_TOKEN)}, 1)"


# ---------------------------------------------------------------- T23 n-grams
def ngrams_upto(tokens: Column, n_max: int) -> Column:
    """Union of 1..n_max grams (``ngram_range=(1, n_max)``), in order of n.

    The shifted copies are zipped (``arrays_zip`` pads with nulls), so the
    token array is evaluated once per copy, never per element."""
    parts = [tokens]
    for n in range(2, n_max + 1):
        shifted = [tokens.alias("g0")] + [
            F.slice(tokens, k + 1, F.greatest(F.size(tokens), F.lit(1))).alias(f"g{k}") for k in range(1, n)]
        z = F.arrays_zip(*shifted)  # fields named g0..g{n-1} by the aliases
        grams = F.transform(z, _gram_joiner(n))
        parts.append(F.filter(grams, lambda g: g.isNotNull()))
    return F.concat(*parts)


def _gram_joiner(n: int):
    def join(s: Column) -> Column:
        return F.when(s[f"g{n - 1}"].isNotNull(), F.concat_ws(" ", *[s[f"g{k}"] for k in range(n)]))
    return join


def ngrams_upto_sql(tokens: str, n_max: int) -> str:
    parts = [tokens]
    for n in range(2, n_max + 1):
        parts.append(
            f"CASE WHEN len({tokens}) >= {n} THEN list_transform(range(1, len({tokens}) - {n} + 2), "
            f"lambda i: array_to_string({tokens}[i:i + {n - 1}], ' ')) ELSE [] END"
        )
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


# ---------------------------------------------------------------- T15-T17 readability
def readability(c) -> dict[str, Column]:
    """Sentences, syllables, words, Flesch reading ease and ARI of a text.

    The text is first ASCII-cleaned (T12) as the reference does.
    Flesch (1948): 206.835 - 1.015 w/s - 84.6 syl/w.
    ARI (Smith and Senter 1967): 4.71 chars/w + 0.5 w/s - 21.43.
    """
    t = ascii_clean(c)
    words = lexicon_words(t)
    n_s = sent_count(t).cast("double")
    n_w = F.size(words).cast("double")
    n_syl = syllables(words).cast("double")
    n_ch = F.length(F.regexp_replace(F.regexp_replace(t, P.ASCII_PUNCT, ""), P.WS, "")).cast("double")
    flesch = (F.lit(206.835) - F.lit(1.015) * F.try_divide(n_w, n_s)
              - F.lit(84.6) * F.try_divide(n_syl, n_w))
    ari = (F.lit(4.71) * F.try_divide(n_ch, n_w) + F.lit(0.5) * F.try_divide(n_w, n_s)
           - F.lit(21.43))
    return {
        "n_sentences": n_s.cast("bigint"),
        "n_syllables": n_syl.cast("bigint"),
        "n_words": n_w.cast("bigint"),
        "flesch": flesch,
        "ari": ari,
    }


def readability_sql(e: str) -> dict[str, str]:
    t = ascii_clean_sql(e)
    words = lexicon_words_sql(t)
    n_s = f"CAST({sent_count_sql(t)} AS DOUBLE)"
    n_w = f"CAST(len({words}) AS DOUBLE)"
    n_syl = f"CAST({syllables_sql(words)} AS DOUBLE)"
    n_ch = (f"CAST(length(regexp_replace(regexp_replace({t}, {q(P.ASCII_PUNCT)}, '', 'g'), "
            f"{q(P.WS)}, '', 'g')) AS DOUBLE)")

    def div(a, b):
        return f"(CASE WHEN {b} = 0 THEN NULL ELSE {a} / {b} END)"

    flesch = (f"(CAST(206.835 AS DOUBLE) - CAST(1.015 AS DOUBLE) * {div(n_w, n_s)} "
              f"- CAST(84.6 AS DOUBLE) * {div(n_syl, n_w)})")
    ari = (f"(CAST(4.71 AS DOUBLE) * {div(n_ch, n_w)} + CAST(0.5 AS DOUBLE) * {div(n_w, n_s)} "
           f"- CAST(21.43 AS DOUBLE))")
    return {
        "n_sentences": f"CAST({n_s} AS BIGINT)",
        "n_syllables": f"CAST({n_syl} AS BIGINT)",
        "n_words": f"CAST({n_w} AS BIGINT)",
        "flesch": flesch,
        "ari": ari,
    }


# ---------------------------------------------------------------- T25 rounding
def round_half_even(c, scale: int = 0) -> Column:
    return F.bround(_c(c), scale)


def round_half_even_sql(e: str, scale: int = 0) -> str:
    return f"round_even({e}, {scale})"

"""Driver queries over single texts: features, tokens, readability, rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from essayspark.functions import lexicon as L
from essayspark.functions.fixed_values import ENGLISH_STOP_WORDS
from essayspark.functions import patterns as P
from essayspark.functions import text as T
from essayspark.functions.patterns import sql_str as q
from essayspark.operators import features as FT
from essayspark.operators import edits as ED
from essayspark.operators import grammar as G
from essayspark.operators import lemmas as LM
from essayspark.plans.registry import r6, r6_sql, register
from essayspark.session import written
from essayspark.sources.tables import ESSAYS_SQL, attach_scores, essay_texts, essays, table

E = "essay"

# ------------------------------------------------------------------ text_basic_features
_BASIC_SQL = f"""
SELECT essay_id,
       {T.char_count_sql(E)} AS char_count,
       {T.word_count_sql(E)} AS word_count,
       {T.sent_count_sql(E)} AS sent_count,
       {r6_sql(T.avg_word_len_sql(E))} AS avg_word_len,
       {T.ws_word_count_sql(E)} AS ws_word_count,
       CAST(length({T.strip_sql(E)}) AS BIGINT) AS stripped_len,
       CAST(length(lower({E})) AS BIGINT) AS lower_len
FROM {ESSAYS_SQL} e
"""


@register("text_basic_features", _BASIC_SQL)
def text_basic_features(spark, sf):
    """T3 T4 T5 T6 T11 T22 T26 per essay."""
    return essay_texts(spark, sf).select(
        "essay_id",
        T.char_count(E).alias("char_count"),
        T.word_count(E).alias("word_count"),
        T.sent_count(E).alias("sent_count"),
        r6(T.avg_word_len(E), "avg_word_len"),
        T.ws_word_count(E).alias("ws_word_count"),
        F.length(T.strip(E)).cast("bigint").alias("stripped_len"),
        F.length(F.lower(E)).cast("bigint").alias("lower_len"),
    )


# ------------------------------------------------------------------ mean_words_by_set
_MEAN_WORDS_SQL = f"""
SELECT essay_set, {r6_sql('avg(' + T.ws_word_count_sql(E) + ')')} AS mean_word_count,
       CAST(count(*) AS BIGINT) AS n_essays
FROM {ESSAYS_SQL} e GROUP BY essay_set
"""


@register("mean_words_by_set", _MEAN_WORDS_SQL)
def mean_words_by_set(spark, sf):
    """A3 / V2: the bar data of mean white-space word count per set."""
    return (essay_texts(spark, sf)
            .withColumn("word_count", T.ws_word_count(E))
            .groupBy("essay_set")
            .agg(r6(F.avg("word_count"), "mean_word_count"),
                 F.count(F.lit(1)).alias("n_essays"))
            .orderBy("essay_set"))


# ------------------------------------------------------------------ rows_of_set
ROWS_OF_SET = "src3"


@register("rows_of_set", f"SELECT essay_id, essay_set, domain1_score, essay FROM {ESSAYS_SQL} e "
                         f"WHERE essay_set = {q(ROWS_OF_SET)}")
def rows_of_set(spark, sf):
    """P1 + P2: projection and equality filter on the group key."""
    return (essays(spark, sf).select("essay_id", "essay_set", "domain1_score", "essay")
            .filter(F.col("essay_set") == ROWS_OF_SET))


# ------------------------------------------------------------------ sentence_tokens
_SENT_SQL = f"""
SELECT essay_id, CAST(generate_subscripts(toks, 1) AS BIGINT) AS sent_no,
       CAST(len(unnest(toks)) AS BIGINT) AS n_tokens,
       array_to_string(unnest(toks), ' ') AS tokens
FROM (SELECT essay_id, {T.sentence_tokens_sql(E)} AS toks FROM {ESSAYS_SQL} e)
"""


@register("sentence_tokens", _SENT_SQL)
def sentence_tokens(spark, sf):
    """T1 + T2: each sentence as its alphanumeric tokens, one row per sentence."""
    return (essay_texts(spark, sf)
            .select("essay_id", F.posexplode(T.sentence_tokens(E)).alias("pos", "toks"))
            .select("essay_id", (F.col("pos") + 1).cast("bigint").alias("sent_no"),
                    F.size("toks").cast("bigint").alias("n_tokens"),
                    F.array_join("toks", " ").alias("tokens")))


# ------------------------------------------------------------------ raw_tokens
_RAW_SQL = f"""
SELECT essay_id, CAST(len(t) AS BIGINT) AS n_raw_tokens, array_to_string(t, ' ') AS raw_tokens,
       CAST(len(list_filter(t, lambda x: NOT regexp_matches(x, {q(P.WORD)}))) AS BIGINT) AS n_symbols
FROM (SELECT essay_id, {T.raw_tokens_sql(E)} AS t FROM {ESSAYS_SQL} e)
"""


@register("raw_tokens", _RAW_SQL)
def raw_tokens(spark, sf):
    """Words and single punctuation symbols, in order."""
    return (essay_texts(spark, sf).select("essay_id", T.raw_tokens(E).alias("t"))
            .select("essay_id", F.size("t").cast("bigint").alias("n_raw_tokens"),
                    F.array_join("t", " ").alias("raw_tokens"),
                    F.size(F.filter("t", lambda x: ~x.rlike(P.WORD))).cast("bigint").alias("n_symbols")))


@register("text_tokens", f"SELECT essay_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens "
                         f"FROM (SELECT essay_id, {T.text_tokens_sql(E)} AS t FROM {ESSAYS_SQL} e)")
def text_tokens(spark, sf):
    """The tokens of all sentences of a text as one list."""
    return (essay_texts(spark, sf).select("essay_id", T.text_tokens(E).alias("t"))
            .select("essay_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens")))


# ------------------------------------------------------------------ clean_words
_STOPS = list(ENGLISH_STOP_WORDS)
_CLEAN_SQL = f"""
SELECT essay_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(k) AS BIGINT) AS n_kept,
       array_to_string(k, ' ') AS kept_words
FROM (SELECT essay_id, w, {T.remove_words_sql('w', _STOPS)} AS k
      FROM (SELECT essay_id, {T.clean_words_sql(E)} AS w FROM {ESSAYS_SQL} e))
"""


@register("clean_words", _CLEAN_SQL)
def clean_words(spark, sf):
    """T10 + J3 + U2: lower-case alphabetic words without stop words."""
    return (essay_texts(spark, sf).select("essay_id", T.clean_words(E).alias("w"))
            .select("essay_id", F.size("w").cast("bigint").alias("n_words"),
                    T.remove_words(F.col("w"), _STOPS).alias("k"))
            .select("essay_id", "n_words", F.size("k").cast("bigint").alias("n_kept"),
                    F.array_join("k", " ").alias("kept_words")))


# ------------------------------------------------------------------ ascii_clean
@register("ascii_clean", f"SELECT essay_id, {T.ascii_clean_sql(E)} AS ascii_text, "
                         f"CAST(length({T.ascii_clean_sql(E)}) AS BIGINT) AS ascii_len FROM {ESSAYS_SQL} e")
def ascii_clean(spark, sf):
    """Each run of non-ASCII characters becomes one blank."""
    return essay_texts(spark, sf).select("essay_id", T.ascii_clean(E).alias("ascii_text"),
                                    F.length(T.ascii_clean(E)).cast("bigint").alias("ascii_len"))


# ------------------------------------------------------------------ readability
_RD = T.readability_sql(E)
_READ_SQL = f"""
SELECT essay_id, {_RD['n_sentences']} AS n_sentences, {_RD['n_syllables']} AS n_syllables,
       {_RD['n_words']} AS n_words, {r6_sql(_RD['flesch'])} AS flesch, {r6_sql(_RD['ari'])} AS ari
FROM {ESSAYS_SQL} e
"""


@register("readability", _READ_SQL)
def readability(spark, sf):
    """The five-number readability row, keyed by essay (D13 fixed)."""
    rd = T.readability(E)
    return essay_texts(spark, sf).select(
        "essay_id", rd["n_sentences"].alias("n_sentences"), rd["n_syllables"].alias("n_syllables"),
        rd["n_words"].alias("n_words"), r6(rd["flesch"], "flesch"), r6(rd["ari"], "ari"))


# ------------------------------------------------------------------ grammar_rules
_GR_SQL = f"""
SELECT essay_id, {', '.join(f'{v} AS {k}' for k, v in G.findings_sql(E).items())},
       {G.corrected_sql(E)} AS corrected
FROM {ESSAYS_SQL} e
"""


@register("grammar_rules", _GR_SQL)
def grammar_rules(spark, sf):
    """Rule findings per essay and the corrected text."""
    return G.check(essay_texts(spark, sf).select("essay_id", E)).drop(E)


# ------------------------------------------------------------------ grammar_edits
_PIECES = ED.pieces_sql(ESSAYS_SQL)


@register("grammar_edits", f"""
SELECT essay_id, CAST(start AS BIGINT) AS "offset",
       CAST(CASE rule WHEN 'double_word' THEN length(w) + length(after) WHEN 'sentence_start' THEN 1 ELSE length(w) END AS BIGINT) AS "length",
       replacement, rule
FROM ({_PIECES}) WHERE rule <> 'removed'
""")
def grammar_edits(spark, sf):
    """Every correction as a span and its replacement."""
    return ED.edits(essay_texts(spark, sf))


@register("grammar_corrected", f"""
SELECT e.essay_id, CAST(coalesce(n, 0) AS BIGINT) AS n_edits, CASE WHEN e.essay IS NOT NULL THEN coalesce(t, '') END AS corrected
FROM {ESSAYS_SQL} e LEFT JOIN (
  SELECT essay_id, count(*) FILTER (WHERE rule <> 'removed') AS n,
         string_agg(CASE WHEN rule IS NULL THEN w WHEN rule = 'sentence_start' THEN replacement || substr(w, 2) ELSE replacement END, '' ORDER BY i) AS t
  FROM ({_PIECES}) GROUP BY essay_id) c ON c.essay_id = e.essay_id
""")
def grammar_corrected(spark, sf):
    """Texts with all edits applied, doubled words and sentence starts included."""
    return ED.corrected(essay_texts(spark, sf))


# ------------------------------------------------------------------ dictionary + spelling
_DICT_SQL = (f"SELECT word, CAST(count(*) AS BIGINT) AS n FROM "
             f"(SELECT unnest(regexp_extract_all(lower(text), {q(P.ALPHA_TOKEN)}, 1)) AS word FROM benchmark) "
             f"GROUP BY word")


@register("dictionary_counts", _DICT_SQL)
def dictionary_counts(spark, sf):
    """S4 + A9: word counts of the dictionary corpus (``benchmark``)."""
    return FT.dictionary_counts(table(spark, sf, "benchmark"), "text")


def _spell_tokens_sql(e: str) -> str:
    return (f"regexp_extract_all(regexp_replace(regexp_replace(lower({e}), {q(P.NON_WORD)}, ' ', 'g'), "
            f"'[0-9]', '', 'g'), '([^ ]+)', 1)")


_SPELL_SQL = f"""
WITH d AS (SELECT DISTINCT word FROM ({_DICT_SQL})),
     t AS (SELECT essay_id, unnest({_spell_tokens_sql(E)}) AS word FROM {ESSAYS_SQL} e),
     m AS (SELECT essay_id, count(*) AS n FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.word = t.word)
           GROUP BY essay_id)
SELECT e.essay_id, CAST(coalesce(m.n, 0) AS BIGINT) AS spell_err_count
FROM {ESSAYS_SQL} e LEFT JOIN m ON e.essay_id = m.essay_id
"""


@register("spelling_errors", _SPELL_SQL)
def spelling_errors(spark, sf):
    """T9 + J1: tokens of each essay that the dictionary lacks."""
    dictionary = FT.dictionary_counts(table(spark, sf, "benchmark"), "text")
    return FT.spelling_errors(essay_texts(spark, sf), dictionary)


# ------------------------------------------------------------------ POS, lemmas
def _tagged_sql() -> str:
    """Token table with tag and lemma: lexicon join, else the rules."""
    rule_tag = L.pos_tag_sql("t.w")
    return f"""
tok AS (SELECT essay_id, unnest(toks) AS w, generate_subscripts(toks, 1) AS pos
        FROM (SELECT essay_id, list_transform({T.alnum_tokens_sql(E)}, lambda x: lower(x)) AS toks
              FROM {ESSAYS_SQL} e)),
tg AS (SELECT t.essay_id, t.pos, t.w, coalesce(lex.tag, {rule_tag}) AS tag, lex.lemma AS lex_lemma
       FROM tok t LEFT JOIN {L.lexicon_values_sql()} ON lex.word = t.w),
lm AS (SELECT essay_id, pos, w, tag, coalesce(lex_lemma, {L.lemma_sql('w', 'tag')}) AS lemma FROM tg)
"""


_POS_SQL = f"""
WITH {_tagged_sql()}
SELECT e.essay_id,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'N') AS BIGINT) AS noun_count,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'J') AS BIGINT) AS adj_count,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'V') AS BIGINT) AS verb_count,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'R') AS BIGINT) AS adv_count
FROM {ESSAYS_SQL} e LEFT JOIN lm ON e.essay_id = lm.essay_id
GROUP BY e.essay_id
"""


@register("pos_counts", _POS_SQL)
def pos_counts(spark, sf):
    """T7 + A11: noun, adjective, verb, adverb counts by lexicon and rules."""
    return FT.with_pos_lemmas(essay_texts(spark, sf).select("essay_id", E), E,
                              ["noun_count", "adj_count", "verb_count", "adv_count"]).drop(E)


_LEMMA_COUNT_SQL = f"""
WITH {_tagged_sql()}
SELECT e.essay_id, CAST(count(DISTINCT lm.lemma) AS BIGINT) AS lemma_count
FROM {ESSAYS_SQL} e LEFT JOIN lm ON e.essay_id = lm.essay_id
GROUP BY e.essay_id
"""


@register("lemma_count", _LEMMA_COUNT_SQL)
def lemma_count(spark, sf):
    """T8 + A10 + U1: distinct lemmas per essay."""
    return FT.with_pos_lemmas(essay_texts(spark, sf).select("essay_id", E), E, ["lemma_count"]).drop(E)


_LEMMATISED_SQL = f"""
WITH {_tagged_sql()}
SELECT e.essay_id, coalesce(string_agg(lm.lemma, ' ' ORDER BY lm.pos), '') AS lemmatised
FROM {ESSAYS_SQL} e LEFT JOIN lm ON e.essay_id = lm.essay_id
GROUP BY e.essay_id
"""


@register("lemmatised_text", _LEMMATISED_SQL)
def lemmatised_text(spark, sf):
    """T20 (D6 fixed): each token replaced by its lemma, re-joined."""
    return FT.with_pos_lemmas(essay_texts(spark, sf).select("essay_id", E), E, ["lemmatised"]).drop(E)


# ------------------------------------------------------------------ attested lemmas
_ATTESTED = LM.lemma_table_sql(f"SELECT unnest({T.alnum_tokens_sql(E)}) AS t FROM {ESSAYS_SQL} e", _DICT_SQL)
_ATTESTED_TOKENS = f"""
SELECT t.essay_id, t.i, a.lemma
FROM (SELECT essay_id, lower(unnest(ts)) AS word, generate_subscripts(ts, 1) AS i
      FROM (SELECT essay_id, {T.alnum_tokens_sql(E)} AS ts FROM {ESSAYS_SQL} e)) t JOIN ({_ATTESTED}) a ON a.word = t.word
"""


def _attested(spark, sf):
    texts = essay_texts(spark, sf).select("essay_id", E)
    return texts, written(LM.lemma_table(texts, FT.dictionary_counts(table(spark, sf, "benchmark"), "text"), E))


@register("attested_lemmas", _ATTESTED)
def attested_lemmas(spark, sf):
    """T8 + S4: every word's tag and lemma; a lemma is a word of the dictionary, or the word itself."""
    texts = essay_texts(spark, sf).select("essay_id", E)
    return LM.lemma_table(texts, FT.dictionary_counts(table(spark, sf, "benchmark"), "text"), E)


@register("attested_lemma_count", f"""
SELECT e.essay_id, CAST(count(DISTINCT a.lemma) AS BIGINT) AS lemma_count
FROM {ESSAYS_SQL} e LEFT JOIN ({_ATTESTED_TOKENS}) a ON a.essay_id = e.essay_id GROUP BY e.essay_id
""")
def attested_lemma_count(spark, sf):
    """T8 + A10: distinct attested lemmas per essay."""
    return LM.lemma_counts(*_attested(spark, sf))


@register("attested_lemmatised_text", f"""
SELECT e.essay_id, coalesce(string_agg(a.lemma, ' ' ORDER BY a.i), '') AS lemmatised
FROM {ESSAYS_SQL} e LEFT JOIN ({_ATTESTED_TOKENS}) a ON a.essay_id = e.essay_id GROUP BY e.essay_id
""")
def attested_lemmatised_text(spark, sf):
    """Each token replaced by its attested lemma."""
    return LM.lemmatised(*_attested(spark, sf))


# ------------------------------------------------------------------ ten_features
_TEN_SQL = f"""
WITH {_tagged_sql()},
pos AS (SELECT e.essay_id,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'N') AS BIGINT) AS noun_count,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'J') AS BIGINT) AS adj_count,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'V') AS BIGINT) AS verb_count,
       CAST(count(lm.w) FILTER (WHERE lm.tag = 'R') AS BIGINT) AS adv_count,
       CAST(count(DISTINCT lm.lemma) AS BIGINT) AS lemma_count
       FROM {ESSAYS_SQL} e LEFT JOIN lm ON e.essay_id = lm.essay_id GROUP BY e.essay_id),
sp AS ({_SPELL_SQL})
SELECT e.essay_id, e.essay_set, e.domain1_score,
       {T.char_count_sql(E)} AS char_count, {T.word_count_sql(E)} AS word_count,
       {T.sent_count_sql(E)} AS sent_count, {r6_sql(T.avg_word_len_sql(E))} AS avg_word_len,
       pos.lemma_count, sp.spell_err_count, pos.noun_count, pos.adj_count, pos.verb_count, pos.adv_count
FROM {ESSAYS_SQL} e JOIN pos ON e.essay_id = pos.essay_id JOIN sp ON e.essay_id = sp.essay_id
"""


@register("ten_features", _TEN_SQL)
def ten_features(spark, sf):
    """T18 + J4: the ten-feature row of every essay."""
    dictionary = FT.dictionary_counts(table(spark, sf, "benchmark"), "text")
    df = FT.ten_features(essay_texts(spark, sf).select("essay_id", "essay_set", E), dictionary)
    return attach_scores(df.withColumn("avg_word_len", r6("avg_word_len")), spark, sf)

"""Rule tables that replace the trained tagger, lemmatizer and grammar tool.

The reference tags words with a trained tagger and lemmatizes with a
dictionary; neither is available here, so part of speech and lemma come
from a small closed-class lexicon plus ordered suffix rules.  The tables
are small literal maps, so lookups are row-local map expressions inside
codegen: no join, no shuffle, and nothing grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from essayspark.functions.patterns import sql_str as q


# ---- fixed values: part-of-speech lexicon --------------------------------------
# Tags: N noun, J adjective, V verb, R adverb, O anything else.  Each entry is
# "word tag lemma"; the lemma column is "-" when the word is its own lemma.
_LEXICON_TEXT = """
the O - a O - an O - and O - or O - but O - if O - of O - in O - on O - at O -
to O - for O - with O - by O - from O - as O - into O - about O - than O -
that O - this O - these O - those O - it O - its O - i O - you O - he O -
she O - we O - they O - me O - him O - her O - us O - them O - my O - your O -
his O - our O - their O - who O - which O - what O - whom O - whose O -
there O - so O - because O - while O - although O - each O - every O -
some O - any O - all O - both O - either O - neither O - can O - could O -
will O - would O - shall O - should O - may O - might O - must O - no O -
is V be are V be was V be were V be be V - been V be being V be am V be
have V - has V have had V have having V have do V - does V do did V do
done V do go V - goes V go went V go gone V go make V - made V make
take V - took V take taken V take get V - got V get say V - said V say
see V - saw V see seen V see know V - knew V know known V know
think V - thought V think come V - came V come give V - gave V give
given V give find V - found V find tell V - told V tell become V -
became V become leave V - left V leave feel V - felt V feel bring V -
brought V bring begin V - began V begin keep V - kept V keep hold V -
held V hold write V - wrote V write written V write stand V - stood V stand
run V - ran V run mean V - meant V mean let V - put V - grow V - grew V grow
not R - very R - also R - just R - often R - never R - always R -
sometimes R - here R - now R - then R - still R - even R - too R - again R -
already R - soon R - well R - only R - almost R - quite R - perhaps R -
yet R - ever R -
good J - bad J - new J - old J - great J - big J - small J - long J -
little J - high J - low J - young J - other J - same J - few J - many J -
much J - own J - more J much most J much better J good best J good
worse J bad worst J bad
men N man women N woman children N child feet N foot teeth N tooth
mice N mouse
"""


def _parse_lexicon() -> tuple[dict[str, str], dict[str, str]]:
    toks = _LEXICON_TEXT.split()
    tags, lemmas = {}, {}
    for i in range(0, len(toks), 3):
        w, t, lem = toks[i:i + 3]
        tags[w] = t
        lemmas[w] = w if lem == "-" else lem
    return tags, lemmas


LEX_TAG, LEX_LEMMA = _parse_lexicon()

# ---- fixed values: ordered suffix rules for words not in the lexicon ------------
# (suffix, tag); first match wins; the word must be longer than suffix + 2.
SUFFIX_TAGS = [
    ("ly", "R"),
    ("ing", "V"), ("ed", "V"), ("ize", "V"), ("ise", "V"), ("ify", "V"),
    ("ous", "J"), ("ful", "J"), ("ive", "J"), ("able", "J"), ("ible", "J"),
    ("less", "J"), ("ish", "J"), ("ical", "J"), ("al", "J"), ("ic", "J"),
    ("tion", "N"), ("sion", "N"), ("ment", "N"), ("ness", "N"), ("ity", "N"),
    ("ship", "N"), ("ism", "N"), ("ist", "N"), ("er", "N"), ("or", "N"),
]
# All-digit tokens are numbers (tag O); anything else defaults to noun.
DEFAULT_TAG = "N"

# ---- fixed values: lemma suffix rules by tag ------------------------------------
# (tag, suffix, replacement, min_length); first match for the tag wins.
# Words tagged O or unknown are lemmatised as nouns.
LEMMA_RULES = [
    ("N", "sses", "ss", 5), ("N", "ies", "y", 5), ("N", "xes", "x", 4),
    ("N", "ches", "ch", 5), ("N", "shes", "sh", 5), ("N", "ss", "ss", 3),
    ("N", "us", "us", 3), ("N", "is", "is", 3), ("N", "s", "", 4),
    ("V", "ies", "y", 5), ("V", "ied", "y", 5), ("V", "ing", "", 6),
    ("V", "ed", "", 5), ("V", "es", "e", 5), ("V", "ss", "ss", 3), ("V", "s", "", 4),
]


def _map_lit(d: dict[str, str]) -> Column:
    args = []
    for k in sorted(d):
        args += [F.lit(k), F.lit(d[k])]
    return F.create_map(*args)


def _words_by_tag() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for w, t in sorted(LEX_TAG.items()):
        out.setdefault(t, []).append(w)
    return out


def pos_tag(word: Column) -> Column:
    """Tag of one lower-cased token: lexicon, then suffix rules, then noun.

    The lexicon is one ``isin`` set per tag (hash lookups, planned as
    ``InSet``) rather than a map literal, whose lookup scans its keys."""
    rule = None
    for tag, words in _words_by_tag().items():
        cond = word.isin(*words)
        rule = F.when(cond, F.lit(tag)) if rule is None else rule.when(cond, F.lit(tag))
    # cheap tests first: only a token that starts with a digit sorts before "a", and a suffix
    # is compared before the characters are counted
    rule = rule.when((word < "a") & word.rlike("^[0-9]+$"), F.lit("O"))
    # rules at the end of the list that give the default tag change nothing; the others are tried by the word's last
    # letter, which keeps their order among those that one word can meet
    last = max(i for i, (_, tag) in enumerate(SUFFIX_TAGS) if tag != DEFAULT_TAG) + 1
    by_letter: dict[str, Column] = {}
    for suf, tag in SUFFIX_TAGS[:last]:
        cond = word.endswith(suf) & (F.length(word) > len(suf) + 2)
        got = by_letter.get(suf[-1])
        by_letter[suf[-1]] = F.when(cond, F.lit(tag)) if got is None else got.when(cond, F.lit(tag))
    for letter, some in by_letter.items():
        rule = rule.when(word.endswith(letter), some.otherwise(F.lit(DEFAULT_TAG)))
    return rule.otherwise(F.lit(DEFAULT_TAG))


def pos_tag_sql(word: str) -> str:
    """Suffix part only; the oracle joins the lexicon table itself."""
    parts = [f"WHEN regexp_matches({word}, '^[0-9]+$') THEN 'O'"]
    for suf, tag in SUFFIX_TAGS:
        parts.append(f"WHEN length({word}) > {len(suf) + 2} AND suffix({word}, {q(suf)}) THEN {q(tag)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(DEFAULT_TAG)} END"


def lemma(word: Column, tag: Column) -> Column:
    """Lemma of one lower-cased token given its tag."""
    ntag = F.when(tag.isin("N", "V"), tag).otherwise(F.lit("N"))
    rule = ruled = None
    for t, suf, rep, min_len in LEMMA_RULES:
        cond = word.endswith(suf) & (ntag == t) & (F.length(word) >= min_len)
        val = F.concat(word.substr(F.lit(1), F.length(word) - len(suf)), F.lit(rep))
        rule = F.when(cond, val) if rule is None else rule.when(cond, val)
    for letter in sorted({suf[-1] for _, suf, _, _ in LEMMA_RULES}):  # a word with another last letter meets no rule
        ruled = word.endswith(letter) if ruled is None else ruled | word.endswith(letter)
    irregular = {w: lem for w, lem in LEX_LEMMA.items() if lem != w}
    # a map literal's lookup scans its keys: only for words that it holds
    return (F.when(word.isin(*sorted(irregular)), F.try_element_at(_map_lit(irregular), word))
            .when(word.isin(*sorted(LEX_LEMMA)), word).when(ruled, rule.otherwise(word)).otherwise(word))


def tag_word(word: str) -> str:
    """As ``pos_tag``, of one word in Python."""
    if word in LEX_TAG:
        return LEX_TAG[word]
    if word and not word.strip("0123456789"):
        return "O"
    return next((tag for suf, tag in SUFFIX_TAGS if word.endswith(suf) and len(word) > len(suf) + 2), DEFAULT_TAG)


def lemma_word(word: str, tag: str) -> str:
    """As ``lemma``, of one word in Python."""
    if word in LEX_LEMMA:
        return LEX_LEMMA[word]
    kind = tag if tag in ("N", "V") else "N"
    return next((word[: len(word) - len(suf)] + rep for t, suf, rep, least in LEMMA_RULES
                 if t == kind and word.endswith(suf) and len(word) >= least), word)


def lemma_sql(word: str, tag: str) -> str:
    ntag = f"(CASE WHEN {tag} IN ('N', 'V') THEN {tag} ELSE 'N' END)"
    parts = []
    for t, suf, rep, min_len in LEMMA_RULES:
        parts.append(
            f"WHEN {ntag} = {q(t)} AND length({word}) >= {min_len} AND suffix({word}, {q(suf)}) "
            f"THEN substr({word}, 1, length({word}) - {len(suf)}) || {q(rep)}"
        )
    return "CASE " + " ".join(parts) + f" ELSE {word} END"


def lexicon_values_sql() -> str:
    """The lexicon as a VALUES table (word, tag, lemma) for oracle joins."""
    rows = ", ".join(f"({q(w)}, {q(LEX_TAG[w])}, {q(LEX_LEMMA[w])})" for w in sorted(LEX_TAG))
    return f"(VALUES {rows}) AS lex(word, tag, lemma)"


# ---- fixed values: grammar rules (rule, pattern, replacement) --------------------
# Applied in this order; each pattern is portable (Java regex and RE2).
# The replacement uses group 1 / group 2 where given.
GRAMMAR_RULES = [
    ("space_before_punct", r" +([,.;:!?])", "{1}"),
    ("double_space", r"  +", " "),
    ("lone_i", r"(^|[^\p{L}\p{N}_'])i([^\p{L}\p{N}_']|$)", "{1}I{2}"),
]
# Counted only (no regex replacement can change case): a lower-case letter
# that starts a sentence after . ! or ?.
LOWER_START = r"[.!?] +[a-z]"

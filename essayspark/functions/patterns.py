"""Regular-expression building blocks that behave the same in Java regex
(Spark) and RE2 (the DuckDB oracle).

Python's ``\\w`` and ``\\s`` are Unicode aware; Java's and RE2's are ASCII
only, so the Unicode classes are spelled out.  No look-around and no
back-references are used anywhere (RE2 has neither).
"""

# ---- fixed values: character classes -------------------------------------
WORD_CHARS = r"\p{L}\p{N}_"                       # Python 3 \w
WS_CHARS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"          # Python 3 \s
WORD = f"[{WORD_CHARS}]"
NON_WORD = f"[^{WORD_CHARS}]"
WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"                  # string.punctuation
NON_ASCII_RUN = r"[^\x00-\x7F]+"

# ---- fixed values: token shapes --------------------------------------------
ALNUM_TOKEN = r"([a-zA-Z0-9]+)"                   # words of a sentence
ALPHA_TOKEN = r"([a-z]+)"                         # dictionary / clean words
VECTORIZER_TOKEN = f"([{WORD_CHARS}]{{2,}})"      # two or more word chars
RAW_TOKEN = f"({WORD}+|[^{WS_CHARS}{WORD_CHARS}])"  # words and single symbols

# ---- fixed values: sentence boundary rule -----------------------------------
# A sentence ends at a run of . ! ? followed by closing quotes/brackets and
# then white space or the end of the text.
SENT_END = r"""[.!?]+["')\]]*"""
SENT_BOUNDARY = f"{SENT_END}(?:{WS}|$)"
SENT_BOUNDARY_GROUPED = f"({SENT_END})(?:{WS}|$)"
ENDS_WITH_SENT_END = f"{SENT_END}$"
# Marker written between sentences before splitting; it is removed from the text first.
SENT_MARK = "\u0001"

# ---- fixed values: syllable rule ----------------------------------------------
VOWEL_RUN = r"[aeiouy]+"
SILENT_E = r"[^aeiouyl]e$"


def sql_str(s: str) -> str:
    """Quote a Python string as a SQL literal (no backslash processing)."""
    return "'" + s.replace("'", "''") + "'"

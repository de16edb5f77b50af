"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

from essayspark.llm import quality_rules as Q

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def repeated_words_sql(length: int) -> str:
    """Operator 5: windows as strings, counted over the corpus."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + {length - 1}], ' ') AS s
        FROM (SELECT rid, w, unnest(range(1, len(w) - {length - 2})) AS i FROM d WHERE len(w) >= {length})),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT rid, i + j AS p FROM rep, range(0, {length}) r(j)),
lost AS (SELECT rid, list(p) AS p FROM gone GROUP BY rid),
kept AS (SELECT d.doc_id, d.w, coalesce(len(l.p), 0) AS n,
                CASE WHEN l.p IS NULL THEN d.w ELSE list_filter(list_transform(range(1, len(d.w) + 1),
                     lambda x: CASE WHEN list_contains(l.p, x) THEN NULL ELSE d.w[x] END), lambda x: x IS NOT NULL) END AS k
         FROM d LEFT JOIN lost l USING (rid))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


def quality_rules_sql(common: int = Q.COMMON_WORDS, min_chars: int = Q.MIN_CHARS, min_words: int = Q.MIN_WORDS,
                      max_class: float = Q.MAX_CLASS_DISTANCE, max_word: float = Q.MAX_WORD_DISTANCE) -> str:
    """Operator 6: base counts, references by language, Jensen-Shannon distances."""
    classes = {
        "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "blank": r"[\x20\x09-\x0D]", "sentence": r"[.,;:?''\"\-]", "exclaim": "[!]",
        "symbol": "[#*$%&|<>]", "other_ascii": r"[^a-zA-Z0-9\x20\x09-\x0D.,;:?''\"\-!#*$%&|<>\x{80}-\x{10FFFF}]", "other_letter": r"[\x{80}-\x{10FFFF}]",
    }
    count = ", ".join(f"length(text) - length(regexp_replace(text, '{p}', '', 'g')) AS c{k}" for k, p in enumerate(classes.values()))
    cells = ", ".join(f"c{k}" for k in range(len(classes)))
    half = "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, text IS NULL AS no_text, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, lang, no_text, text, regexp_extract_all(text, '{_WORD}') AS w,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines, {count} FROM d),
win AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) > 4)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM rep, range(0, 5) r(j) GROUP BY rid),
tok AS (SELECT rid, lang, no_text, translate(unnest(w), '{_UPPER}', '{_LOWER}') AS t FROM w),
cnt AS (SELECT lang, t, count(*) AS n FROM tok WHERE lang IS NOT NULL GROUP BY lang, t),
top AS (SELECT lang, t, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, t) AS k FROM cnt) WHERE k <= {common}),
refs AS (SELECT lang, (SELECT coalesce(sum(n), 0) FROM cnt c WHERE c.lang = w.lang) AS n_all, {", ".join(f"sum(c{k}) AS c{k}" for k in range(len(classes)))}
         FROM w WHERE lang IS NOT NULL AND NOT no_text GROUP BY lang),
pair AS (SELECT w.rid, r.lang FROM w JOIN refs r ON w.lang = r.lang OR w.lang IS NULL OR w.lang NOT IN (SELECT lang FROM refs)),
rc AS (SELECT lang, unnest([{cells}]) AS v, unnest(range({len(classes)})) AS k FROM refs),
dc AS (SELECT rid, unnest([{cells}]) AS v, unnest(range({len(classes)})) AS k FROM w),
cd AS (SELECT pair.rid, pair.lang, sum(dc.v) AS np, sum(rc.v) AS nq,
              list({{'p': dc.v, 'q': rc.v}}) AS x FROM pair JOIN dc USING (rid) JOIN rc ON rc.lang = pair.lang AND rc.k = dc.k GROUP BY ALL),
cls AS (SELECT rid, lang, CASE WHEN np = 0 OR nq = 0 THEN 1.0 ELSE sqrt(greatest(list_sum(list_transform(
               list_transform(x, lambda e: {{'p': e.p / np, 'q': e.q / nq}}),
               lambda e: CASE WHEN e.p > 0 THEN e.p * log2(2 * e.p / (e.p + e.q)) ELSE 0 END
                       + CASE WHEN e.q > 0 THEN e.q * log2(2 * e.q / (e.p + e.q)) ELSE 0 END)) / 2, 0)) END AS dist FROM cd),
dn AS (SELECT rid, t, count(*) AS n FROM tok GROUP BY rid, t),
hit AS (SELECT pair.rid, pair.lang, top.t, top.n AS q, coalesce(dn.n, 0) AS p
        FROM pair JOIN top ON top.lang = pair.lang LEFT JOIN dn ON dn.rid = pair.rid AND dn.t = top.t),
part AS (SELECT hit.rid, hit.lang, hit.p, hit.q FROM hit
         UNION ALL SELECT hit.rid, hit.lang, any_value(len(w.w)) - sum(hit.p), any_value(refs.n_all) - sum(hit.q)
         FROM hit JOIN w ON w.rid = hit.rid JOIN refs ON refs.lang = hit.lang GROUP BY hit.rid, hit.lang),
norm AS (SELECT rid, lang, sum(p) OVER g AS np, sum(q) OVER g AS nq, p, q FROM part WINDOW g AS (PARTITION BY rid, lang)),
wds AS (SELECT rid, lang, CASE WHEN any_value(np) = 0 OR any_value(nq) = 0 THEN 1.0 ELSE sqrt(greatest(sum({half}) / 2, 0)) END AS dist
        FROM (SELECT rid, lang, np, nq, CASE WHEN np > 0 THEN p / np ELSE 0 END AS p, CASE WHEN nq > 0 THEN q / nq ELSE 0 END AS q FROM norm) GROUP BY rid, lang),
near AS (SELECT rid, arg_min(cls.dist, cls.dist + wds.dist) AS by_class, arg_min(wds.dist, cls.dist + wds.dist) AS by_word
         FROM cls JOIN wds USING (rid, lang) GROUP BY rid),
base AS (SELECT w.*, coalesce(cov.n, 0) AS n_rep, len(w.w) < 10 OR 100 * coalesce(cov.n, 0) > 20 * len(w.w) AS failed FROM w LEFT JOIN cov USING (rid))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(c6 AS BIGINT) AS n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words, failed AS base_failed,
       NOT (failed OR (coalesce(by_class, 0) > {max_class} AND length(text) - c3 >= {min_chars}) OR (coalesce(by_word, 0) > {max_word} AND len(w) >= {min_words})) AS kept
FROM base LEFT JOIN near USING (rid)
"""


def exact_duplicates_sql() -> str:
    """Operator 12: groups by the text itself."""
    return """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def source_divergence_sql(min_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50) -> str:
    """Operator 13: shares of all kept terms in all groups, summed pair by pair."""
    share = f"1 + (CAST({scale} AS HUGEINT) * ({{n}} + {smooth})) // ({{total}} + {smooth} * v)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tok AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= {min_docs}),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY lang, source, term),
vl AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM cnt c WHERE c.lang = x.lang AND c.source = x.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) x),
p AS (SELECT g.lang, g.source, kept.term, coalesce(cnt.n, 0) AS n, {share.format(n="coalesce(cnt.n, 0)", total="g.total")} AS p, {share.format(n="kept.n", total="vl.total")} AS q
      FROM g JOIN vl USING (lang) JOIN kept USING (lang) LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = kept.term),
diff AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(diff.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN diff ON diff.lang = a.lang AND diff.source = a.source AND diff.item = b.source),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u) WHERE part = 'pair' OR rank <= {top}
"""


def collocations_sql(min_count: int = 10, top: int = 2000, percent: int = 50, scale: int = 1_000_000) -> str:
    """Operator 11 for phrases of 2 to 3 words: n-grams as strings."""
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
piece AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
tot AS (SELECT lang, sum(len(w)) AS n FROM piece GROUP BY lang),
gram AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM piece
         UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM piece WHERE len(w) > 1
         UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM piece WHERE len(w) > 2),
f AS MATERIALIZED (SELECT lang, phrase, k, string_split(phrase, ' ') AS w, count(*) AS f FROM gram GROUP BY lang, phrase, k HAVING count(*) >= {min_count}),
part AS MATERIALIZED (SELECT lang || chr(10) || phrase AS part, f FROM f),
cuts AS MATERIALIZED (SELECT lang, phrase, f AS a, k AS cut, lang || chr(10) || array_to_string(w[1:k], ' ') AS pl, lang || chr(10) || array_to_string(w[k + 1:], ' ') AS pr
                      FROM (SELECT lang, phrase, f, w, unnest(range(1, k)) AS k FROM f WHERE k > 1)),
cut AS (SELECT lang, phrase, a, cut, l.f AS l, r.f AS r, (CAST({scale} AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS score
        FROM cuts JOIN part l ON l.part = pl JOIN part r ON r.part = pr),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM cut) WHERE o = 1),
longer AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, f, array_to_string(w[i:i + 1], ' ') AS phrase FROM f, range(1, 3) r(i) WHERE k = 3) GROUP BY lang, phrase),
left_ AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer.f IS NULL OR 100 * longer.f < {percent} * best.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(tot.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM left_ JOIN tot USING (lang) QUALIFY rank <= {top}
"""

"""Driver queries for profiling and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from essayspark.functions import fixed_values as FV
from essayspark.functions import text as T
from essayspark.operators import clean as C
from essayspark.operators import features as FT
from essayspark.operators import profile as PR
from essayspark.plans.registry import r6, r6_sql, register
from essayspark.plans.text_queries import _TEN_SQL
from essayspark.session import checkpointed
from essayspark.sources.tables import (ESSAYS_RATERS_SQL, ESSAYS_SQL, attach_scores, essay_texts, essays,
                                       essays_with_raters, table)

RATER_COLS = ["essay_id", "essay_set", "lang", "essay", "domain1_score",
              "rater1_domain1", "rater3_domain1", "rater3_trait1"]
RATER_TYPES = ["bigint", "string", "string", "string", "double", "double", "double", "double"]
SPARSE_SHARE = 0.90


# ------------------------------------------------------------------ A4 / V3
@register("mean_score_by_set",
          f"SELECT essay_set, {r6_sql('avg(domain1_score)')} AS mean_score, "
          f"CAST(count(domain1_score) AS BIGINT) AS n_values FROM {ESSAYS_SQL} e GROUP BY essay_set")
def mean_score_by_set(spark, sf):
    """A4 / V3: mean score per set, null scores skipped."""
    g = PR.group_mean(essays(spark, sf), "essay_set", "domain1_score", "mean_score")
    return g.select("essay_set", r6("mean_score", "mean_score"), "n_values").orderBy("essay_set")


# ------------------------------------------------------------------ A1
_NN_SQL = ("SELECT essay_set, " + ", ".join(f"CAST(count({c}) AS BIGINT) AS {c}" for c in RATER_COLS
                                            if c != "essay_set")
           + f" FROM {ESSAYS_RATERS_SQL} r WHERE essay_set IS NOT NULL GROUP BY essay_set")


@register("nonnull_counts_by_set", _NN_SQL)
def nonnull_counts_by_set(spark, sf):
    """A1: non-null count of every column per set."""
    return PR.nonnull_counts(essays_with_raters(spark, sf), "essay_set")


# ------------------------------------------------------------------ A2 / O1 / T25
def _null_union_sql(expr_fn) -> str:
    parts = [f"SELECT '{c}' AS column_name, {expr_fn(c)} FROM {ESSAYS_RATERS_SQL} r" for c in RATER_COLS]
    return " UNION ALL ".join(parts)


_NULLPCT_SQL = ("SELECT column_name, null_percent FROM (" + _null_union_sql(
    lambda c: f"round_even(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100, 2) "
              f"AS null_percent") + ") WHERE null_percent <> 0")


@register("null_percent", _NULLPCT_SQL)
def null_percent(spark, sf):
    """A2 + O1 + T25: null percentage per column, zero removed, highest first."""
    return PR.null_percent(essays_with_raters(spark, sf))


def _sparse_sql(share: float) -> str:
    inner = _null_union_sql(
        lambda c: f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) AS null_share")
    return (f"SELECT column_name, {r6_sql('null_share')} AS null_share, null_share <= {share} AS kept "
            f"FROM ({inner})")


@register("drop_sparse_columns", _sparse_sql(SPARSE_SHARE))
def drop_sparse_columns(spark, sf):
    """P4 + P5: which columns the over-90%-null rule drops."""
    d = PR.sparse_columns(essays_with_raters(spark, sf), SPARSE_SHARE)
    return d.select("column_name", r6("null_share", "null_share"), "kept")


@register("drop_null_columns", _sparse_sql(0.0))
def drop_null_columns(spark, sf):
    """Columns holding any null are dropped."""
    d = PR.sparse_columns(essays_with_raters(spark, sf), 0.0)
    return d.select("column_name", r6("null_share", "null_share"), "kept")


# ------------------------------------------------------------------ A6 / V1
@register("table_shape", f"SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST({len(RATER_COLS)} AS BIGINT) "
                         f"AS n_cols FROM {ESSAYS_RATERS_SQL} r")
def table_shape(spark, sf):
    """Rows and columns of the essay table."""
    return PR.shape(essays_with_raters(spark, sf))


_SCHEMA_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, CAST(count({c}) AS BIGINT) AS non_null, "
    f"CAST({i + 1} AS BIGINT) AS position FROM {ESSAYS_RATERS_SQL} r"
    for i, (c, t) in enumerate(zip(RATER_COLS, RATER_TYPES)))


@register("table_schema", _SCHEMA_SQL)
def table_schema(spark, sf):
    """V1 + P1: column listing with types and non-null counts."""
    return PR.schema_table(essays_with_raters(spark, sf))


# ------------------------------------------------------------------ A13 / V4
_BOX_CORE = f"""
s AS (SELECT essay_set, domain1_score AS v, essay_id FROM {ESSAYS_SQL} e WHERE domain1_score IS NOT NULL),
q AS (SELECT essay_set, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3, count(*) AS n FROM s GROUP BY essay_set),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
"""
_BOX_SQL = f"""
WITH {_BOX_CORE}
SELECT f.essay_set, {r6_sql('q1')} AS q1, {r6_sql('median')} AS median, {r6_sql('q3')} AS q3,
       CAST(n AS BIGINT) AS n, {r6_sql('iqr')} AS iqr, {r6_sql('lo_fence')} AS lo_fence,
       {r6_sql('hi_fence')} AS hi_fence,
       {r6_sql('min(v) FILTER (WHERE v >= lo_fence AND v <= hi_fence)')} AS whisker_lo,
       {r6_sql('max(v) FILTER (WHERE v >= lo_fence AND v <= hi_fence)')} AS whisker_hi,
       CAST(count(*) FILTER (WHERE NOT (v >= lo_fence AND v <= hi_fence)) AS BIGINT) AS n_outliers
FROM f JOIN s ON f.essay_set = s.essay_set
GROUP BY f.essay_set, q1, median, q3, n, iqr, lo_fence, hi_fence
"""


@register("score_boxplot", _BOX_SQL)
def score_boxplot(spark, sf):
    """Box-plot statistics of the score per set."""
    b = PR.box_stats(essays(spark, sf), "essay_set", "domain1_score")
    return b.select("essay_set", *[r6(c, c) for c in ("q1", "median", "q3")], "n",
                    *[r6(c, c) for c in ("iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi")],
                    F.col("n_outliers").cast("bigint").alias("n_outliers"))


@register("score_outliers", f"WITH {_BOX_CORE} SELECT s.essay_id, s.essay_set, s.v AS domain1_score "
                            f"FROM s JOIN f ON s.essay_set = f.essay_set WHERE s.v < f.lo_fence OR s.v > f.hi_fence")
def score_outliers(spark, sf):
    """The outlier rows themselves."""
    return PR.box_outliers(essays(spark, sf), "essay_set", "domain1_score", "essay_id")


# ------------------------------------------------------------------ A14 / V5
def _pair_sql(x: str, y: str) -> tuple[str, str]:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return f"CASE WHEN {both} THEN CAST({x} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({y} AS DOUBLE) END"


def _corr_sql(x: str, y: str) -> str:
    xp, yp = _pair_sql(x, y)
    return (f"CASE WHEN count({xp}) > 1 AND var_pop({xp}) > 0 AND var_pop({yp}) > 0 "
            f"THEN covar_pop({xp}, {yp}) / (stddev_pop({xp}) * stddev_pop({yp})) END")


_CORR_SQL = f"WITH tf AS ({_TEN_SQL}) " + " UNION ALL ".join(
    f"SELECT essay_set, '{f}' AS feature, {r6_sql(_corr_sql(f, 'domain1_score'))} AS corr "
    f"FROM tf GROUP BY essay_set" for f in FT.TEN_FEATURES)


def _ten(spark, sf):
    dictionary = FT.dictionary_counts(table(spark, sf, "benchmark"), "text")
    f = FT.ten_features(essay_texts(spark, sf).select("essay_id", "essay_set", "essay"), dictionary)
    f = attach_scores(f, spark, sf)
    return f.withColumn("avg_word_len", r6("avg_word_len"))  # as reported by ten_features


@register("feature_score_corr", _CORR_SQL)
def feature_score_corr(spark, sf):
    """Correlation of each of the ten features with the score, per set."""
    c = PR.feature_corr(_ten(spark, sf), "essay_set", FT.TEN_FEATURES, "domain1_score")
    return c.select("essay_set", "feature", r6("corr", "corr"))


_BIN_LONG = " UNION ALL ".join(
    f"SELECT essay_id, essay_set, CAST(domain1_score AS DOUBLE) AS target, '{f}' AS feature, "
    f"CAST({f} AS DOUBLE) AS value FROM tf" for f in FT.TEN_FEATURES)
_BINS_SQL = f"""
WITH tf AS ({_TEN_SQL}),
l AS (SELECT * FROM ({_BIN_LONG}) WHERE value IS NOT NULL AND target IS NOT NULL),
r AS (SELECT essay_set, feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY essay_set, feature)
SELECT l.essay_set, l.feature,
       CAST(CASE WHEN r.hi - r.lo = 0 THEN 1
            ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 10) + 1, 10) END AS BIGINT) AS bin,
       l.target, CAST(count(*) AS BIGINT) AS n_points
FROM l JOIN r ON l.essay_set = r.essay_set AND l.feature = r.feature
GROUP BY ALL
"""


@register("feature_score_bins", _BINS_SQL)
def feature_score_bins(spark, sf):
    """V5: binned (feature, score) point counts per set, the scatter data."""
    # the ten-feature rows feed a range aggregate, its size check and the
    # binning join: written once, so the texts are featurised once
    tf = checkpointed(_ten(spark, sf))
    return PR.feature_bins(tf, "essay_set", FT.TEN_FEATURES, "domain1_score", "essay_id")


# ------------------------------------------------------------------ A15 / P13
@register("dedupe_keep_first",
          "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER "
          "(PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations) WHERE rn = 1")
def dedupe_keep_first(spark, sf):
    """A15 + P13: first turn of every conversation, keyed by id."""
    return C.dedupe_keep_first(table(spark, sf, "conversations"), "conv_id", "turn")


# ------------------------------------------------------------------ P9 / P10 / P11
_NORM_SQL = f"""
SELECT e.essay_id, e.essay_set, e.domain1_score,
       {r6_sql('CASE WHEN sr.lo IS NULL THEN 0.0 ELSE (e.domain1_score - sr.lo) / sr.width END')} AS score_norm
FROM {ESSAYS_SQL} e LEFT JOIN {FV.score_range_sql()} ON {C.set_number_sql('e.essay_set')} = sr.set_no
"""


@register("normalise_score", _NORM_SQL)
def normalise_score(spark, sf):
    """Score scaled to 0-1 by the set's range."""
    df = C.normalise_score(essays(spark, sf).select("essay_id", "essay_set", "domain1_score"), spark)
    return df.withColumn("score_norm", r6("score_norm"))


_GRADE_SQL = f"""
SELECT essay_id, score_norm, CAST(round_even(greatest(score_norm, 0.0) * 100, 0) AS BIGINT) AS grade
FROM (SELECT e.essay_id,
        CASE WHEN sr.lo IS NULL THEN 0.0 ELSE (e.domain1_score - sr.lo) / sr.width END AS score_norm
      FROM {ESSAYS_SQL} e LEFT JOIN {FV.score_range_sql()} ON {C.set_number_sql('e.essay_set')} = sr.set_no)
WHERE score_norm IS NOT NULL
"""


@register("grade_round", _GRADE_SQL.replace("SELECT essay_id, score_norm,",
                                            f"SELECT essay_id, {r6_sql('score_norm')} AS score_norm,", 1))
def grade_round(spark, sf):
    """P10 + P11: non-negative x 100, rounded half to even."""
    df = C.normalise_score(essays(spark, sf).select("essay_id", "essay_set", "domain1_score"), spark)
    return (df.filter(F.col("score_norm").isNotNull())
            .select("essay_id", r6("score_norm", "score_norm"),
                    C.grade("score_norm").cast("bigint").alias("grade")))


# ------------------------------------------------------------------ P7
@register("name_topics",
          f"SELECT e.essay_id, e.essay_set, coalesce(tn.topic, e.essay_set) AS topic FROM {ESSAYS_SQL} e "
          f"LEFT JOIN {FV.topic_names_sql()} ON {C.set_number_sql('e.essay_set')} = tn.set_no")
def name_topics(spark, sf):
    """Set code replaced by the topic title where one is known."""
    return C.name_topics(essays(spark, sf).select("essay_id", "essay_set"), spark)


# ------------------------------------------------------------------ O5 / O6
@register("sample_rows",
          f"SELECT essay_id, essay_set, md5(CAST(essay_id AS VARCHAR)) AS sample_hash FROM {ESSAYS_SQL} e "
          f"ORDER BY sample_hash, essay_id LIMIT 10")
def sample_rows(spark, sf):
    """O5 + O6: ten rows chosen by hash, repeatable across partitionings."""
    return C.sample_rows(essays(spark, sf).select("essay_id", "essay_set"), "essay_id", 10)


# ------------------------------------------------------------------ T11 per set (V2 detail)
__all__ = ["T"]

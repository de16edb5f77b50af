"""Small literal tables whose values must equal the original job's.

All are a handful of rows; they are broadcast by construction (a bound
proven by the literal itself).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from essayspark.functions.patterns import sql_str as q

# ---- fixed values: score range per essay set (lo, width) ------------------------
# Normalised score = (score - lo) / width; sets not listed normalise to 0.
SCORE_RANGE = [
    (1, 2.0, 10.0),
    (2, 1.0, 5.0),
    (3, 0.0, 3.0),
    (4, 0.0, 3.0),
    (5, 2.0, 4.0),
    (6, 2.0, 4.0),
    (7, 0.0, 30.0),
    (8, 0.0, 60.0),
]

# ---- fixed values: topic titles of the essay sets ---------------------------------
TOPIC_NAMES_8 = [
    (1, "effect of computers"),
    (2, "censorship views"),
    (3, "effect of setting on a cyclist"),
    (4, "winter hibiscus"),
    (5, "mood in memoir"),
    (6, "empire state building and dirigibles"),
    (7, "patience"),
    (8, "laughter"),
]

TOPIC_NAMES_5 = [
    (1, "effect of computers"),
    (2, "mood in memoir"),
    (3, "empire state building and dirigibles"),
    (4, "patience"),
    (5, "laughter"),
]
TOPIC_NAMES_2 = [
    (1, "effect of computers"),
    (2, "laughter"),
]

# ---- fixed values: English stop words (Spark's default list, 181 words, in its order) ----
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())

# ---- fixed values: grid parameters --------------------------------------------------
KNN_K_GRID = list(range(5, 25, 3))          # 5, 8, ..., 23
KNN_FINAL_K = {1: 23, 2: 23, 3: 17, 4: 23, 5: 23, 6: 23, 7: 11, 8: 23}
LASSO_ALPHAS = [3.0, 2.0, 1.0, 0.6, 0.3, 0.1]
N_FOLDS = 5
TEST_FRACTION = 0.30
VALIDATION_FRACTION = 0.20


def score_range_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCORE_RANGE, "set_no int, lo double, width double")


def score_range_sql() -> str:
    rows = ", ".join(f"({s}, CAST({lo} AS DOUBLE), CAST({w} AS DOUBLE))" for s, lo, w in SCORE_RANGE)
    return f"(VALUES {rows}) AS sr(set_no, lo, width)"


def topic_names_df(spark: SparkSession, names=TOPIC_NAMES_8) -> DataFrame:
    return spark.createDataFrame(names, "set_no int, topic string")


def topic_names_sql(names=TOPIC_NAMES_8) -> str:
    rows = ", ".join(f"({s}, {q(t)})" for s, t in names)
    return f"(VALUES {rows}) AS tn(set_no, topic)"

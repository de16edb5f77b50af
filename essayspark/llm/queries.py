"""Thin ``opN_<name>`` queries: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from essayspark.llm import oracle
from essayspark.llm.common import remainder, table

QUERIES: dict = {}
#: The others hash with keys, learn, tokenise or parse in ways SQL does not express; tests hold them against brute force.
ORACLE: dict = {"op5_substring_dedup": oracle.repeated_words_sql(35), "op6_quality_rules": oracle.quality_rules_sql(),
                "op12_exact_dedup": oracle.exact_duplicates_sql(), "op13_source_divergence": oracle.source_divergence_sql(),
                "op11_collocations": oracle.collocations_sql()}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark, sf):
    from essayspark.llm.suffix_dedup import remove_repeated_bytes

    out = remove_repeated_bytes(table(spark, sf, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_decontaminate(spark, sf):
    from essayspark.llm.decontaminate import contaminated

    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op3_simhash(spark, sf):
    from essayspark.llm.simhash import near_duplicates

    out = near_duplicates(table(spark, sf, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_language_model(spark, sf):
    from essayspark.llm.lm import language_model_scores

    held_out = remainder("doc_id", 7) == 2
    out = language_model_scores(table(spark, sf, "documents"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_substring_dedup(spark, sf):
    from essayspark.llm.substring import remove_repeated_words

    out = remove_repeated_words(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_quality_rules(spark, sf):
    from essayspark.llm.quality_rules import quality_rules, reference_table

    docs = table(spark, sf, "documents")
    out = quality_rules(docs, reference_table(docs))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _scored(scores, at):
    return scores.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= at).cast("int").alias("predicted"))


@query
def op7_quality_model(spark, sf):
    from essayspark.llm.quality_model import quality_scores

    return _scored(quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels")), 0.3)


@query
def op8_toxicity(spark, sf):
    from essayspark.llm.toxicity import toxicity_scores

    return _scored(toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels")), 0.5)


@query
def op9_bpe(spark, sf):
    from essayspark.llm.bpe import encode_documents

    out = encode_documents(table(spark, sf, "documents"), "word_bpe_49k.json")
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op10_main_text(spark, sf):
    from essayspark.llm.html_text import main_text

    return main_text(table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op12_exact_dedup(spark, sf):
    from essayspark.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf, "documents"), carry={"text_sha256": F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)})


@query
def op13_source_divergence(spark, sf):
    from essayspark.llm.divergence import audit

    return audit(table(spark, sf, "documents"))


@query
def op11_collocations(spark, sf):
    from essayspark.llm.collocations import collocations

    return collocations(table(spark, sf, "documents"))

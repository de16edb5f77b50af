"""The pipeline's stages against what their operators say, and the registered queries."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from essayspark.llm import bpe, decontaminate, queries, simhash, substring, toxicity
from essayspark.llm.common import table, written

SF001 = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    from oracle_harness import compare, duck

    line = compare(spark, duck(SF001), name, queries.QUERIES[name], queries.ORACLE[name], SF001)
    assert line.startswith("OK"), line


def test_stages_and_run(spark):
    docs = first = table(spark, SF001, "documents")
    labels, bench = table(spark, SF001, "labels"), table(spark, SF001, "benchmark")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, SF001))
        assert out.columns == first.columns, name
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.toxicity_scores(docs, labels).filter("score >= 0.5").collect()}
            assert bad and rows(out) == rows(docs.filter(~F.col("doc_id").isin(bad)))
        elif name == "simhash_near_dedup":
            assert docs.count() == docs.select("doc_id").distinct().count()  # so that a group is known by its smallest id
            keep = {r.component_id for r in simhash.near_duplicates(docs).collect()}
            assert rows(out) == rows(docs.filter(F.col("doc_id").isin(keep)))
        elif name == "substring_dedup":
            kept = {r.doc_id: (r.n_removed, r.kept) for r in substring.remove_repeated_words(docs).collect()}
            assert any(n for n, _ in kept.values())
            for a, b in zip(sorted(docs.collect()), sorted(out.collect())):
                assert b.text == (kept[a.doc_id][1] if kept[a.doc_id][0] else a.text) and b.n_chars == len(b.text)
        else:
            bad = {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()}
            assert rows(out) == rows(docs.filter(~F.col("doc_id").isin(bad)) if bad else docs)
        docs = out
    got = {r.doc_id: r for r in P.run(spark, SF001).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts)
    coder = bpe.Coder(bpe.tokenizer_path(P.TOKENIZER))
    for i, t in texts.items():
        ids = coder.whole.encode(t, add_special_tokens=False).ids
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and got[i].n_tokens == len(ids)


@pytest.mark.parametrize("name", [q for q in entry.queries() if q.startswith("op")])
def test_query_columns(spark, name):
    want = {
        "1": "doc_id n_bytes n_removed n_spans kept_sha256", "3": "doc_id fingerprint component_id",
        "4": "doc_id held_out n_tokens n_known train_tokens base_score score", "5": "doc_id n_words n_removed kept_sha256",
        "6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "7": "doc_id held_out score predicted",
        "8": "doc_id held_out score predicted", "9": "doc_id n_tokens ids_sha256 decoded_sha256", "10": "page_id url text n_chars",
        "11": "lang rank phrase a l r n score", "12": "doc_id keep_id group_size kept text_sha256", "13": "lang source part item value rank",
    }.get(name[2:].split("_")[0], "doc_id item_id")
    out = entry.queries()[name](spark, SF001)
    assert set(want.split()) <= set(out.columns)
    n = out.count()
    if not name.startswith(("op2_", "op11_", "op13_")):
        assert n == table(spark, SF001, "pages" if name.startswith("op10_") else "documents").count()

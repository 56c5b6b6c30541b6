"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for operators whose own tests lack them."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from llm_rows import ODD, bag
from shoreline.llm import importance, jaccard, licences, passages, token_counts, urls

NAMES = ["doc", "key", "text_key", "rows", "x", "license", "n_lines", "whole", "digest", "candidates", "length", "n_words", "n_removed", "kept"]


def clashing(docs):
    return docs.withColumns({c: F.lit(7) for c in NAMES})


def test_licences_of_odd_rows(documents):
    rows = ODD + [(30, "SPDX-License-Identifier: MIT\n" + "word " * 50_000, "en", "a")]
    docs = documents(rows)
    plain, odd = licences.licences(docs).collect(), licences.licences(clashing(docs)).collect()
    assert bag(plain) == bag(odd) and len(plain) == len(rows)
    assert [(r.license, r.n_lines, r.line_licenses) for r in plain if r.doc_id == 30] == [(None, 1, "MIT")]
    assert all(r.license is None and r.n_lines == 0 for r in plain if r.doc_id != 30)
    assert licences.licences(docs.where("false")).count() == 0


def test_substring_dedup_with_clashing_columns(documents):
    docs = documents([r for r in ODD if r[0] is not None])
    assert bag(passages.without_repeats(clashing(docs)).select("doc_id", "n_words", "n_removed", "text").collect()) == bag(
        passages.without_repeats(docs).select("doc_id", "n_words", "n_removed", "text").collect())


def test_token_counts_of_odd_rows(documents):
    docs = documents(ODD)
    found = token_counts.by_limit(token_counts.histogram(docs)).collect()
    assert bag(found) == bag(token_counts.by_limit(token_counts.histogram(clashing(docs))).collect())
    assert sum(r.docs for r in found) == len(ODD)


def test_links_of_odd_rows_and_nothing(documents):
    docs = documents(ODD)
    counts = jaccard.link_counts(docs, n=3, num=90, den=100)
    assert counts.count() == len(ODD)
    assert jaccard.link_counts(docs.where("false"), n=3, num=90, den=100).count() == 0
    assert jaccard.links(docs.where("false"), n=3, num=90, den=100).count() == 0


def test_urls_that_repeat_and_a_long_one(spark):
    long_url = "https://a.org/" + "x" * 50_000
    rows = [(1, "https://a.org/x"), (1, "https://a.org/x"), (2, None), (3, ""), (4, "no scheme"), (5, long_url)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = urls.judged(pages).collect()
    assert len(out) == len(rows)
    assert {(r.host, r.path) for r in out if r.page_id in (2, 3, 4)} == {("", "")}
    assert [r.rule for r in out if r.page_id in (1, 5)] == ["org/"] * 3
    assert urls.judged(pages.where("false")).count() == 0


def test_stages_keep_clean_odd_rows(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(ODD).withColumn("_doc", F.lit(7))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert bag(clean.collect()) == bag(docs.collect())
    assert bag(stages["size_sharding"](spark, docs, str(tmp_path)).select(*docs.columns).collect()) == bag(docs.collect())
    single = stages["ngram_jaccard_join"](spark, docs, str(tmp_path)).collect()
    # of the three that say the same one stays; nothing is linked with texts without words
    assert sum((r.text or "").lower() == "one two three four" for r in single) == 1
    assert {1, 2, 3} <= {r.doc_id for r in single}


def test_resampling_of_a_long_text(spark, documents):
    out = importance.scored(documents([(1, "one two " * 200_000)]), documents([(1, "one")])).first()
    assert out.n_features == 400_000

"""Queries against their DuckDB twins, or whole-table invariants where SQL can't express them."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from brute import components
from compare import difference
from shoreline.llm import decontamination, mixing
from shoreline.llm.queries import ORACLES, QUERIES
from shoreline.llm.token_counts import VOCABULARY, load

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_twin(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), FOLDER, ORACLES[name]) is None


def test_shards(spark):
    rows = QUERIES["op4_sharding"](spark, FOLDER).collect()
    text = dict(texts(spark))
    assert sorted(r.doc_id for r in rows) == sorted(text)
    load_, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        load_[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[data].add(r.shard)
    assert set(load_) == set(range(8))
    assert max(load_.values()) < 1.05 * min(load_.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, where.values())) == 1


def test_languages_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_token_histogram(spark):
    encoding = load(VOCABULARY)
    lengths = [len(encoding.encode_ordinary(t or "")) for _, t in texts(spark)]
    rows = QUERIES["op9_token_counts"](spark, FOLDER).collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths))
    for r in rows:
        longer = [n for n in lengths if n >= r.length]
        assert (r.docs, r.docs_from, r.tokens_from) == (lengths.count(r.length), len(longer), sum(longer))
        assert (r.docs_to, r.tokens_cut) == (sum(n <= r.length for n in lengths), sum(min(n, r.length) for n in lengths))


def test_pipeline(spark):
    """Each stage's decisions, worked out anew from the stage's own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "language_id", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "size_sharding"]

    told = stages["language_id"](spark, docs, FOLDER).cache()
    assert told.columns == columns
    # only a few very short texts are not told
    gone = docs.join(told, "doc_id", "left_anti").collect()
    assert len(gone) < 0.03 * docs.count() and all(r.n_chars < 200 for r in gone)

    single = stages["ngram_jaccard_join"](spark, told, FOLDER).cache()
    rows = [(r.doc_id, r.text) for r in told.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(
        d for d, n, c in components(rows, 5, 4, 5) if n == 0 or c == d)
    assert single.columns == columns

    clean = stages["benchmark_decontamination"](spark, single, FOLDER).cache()
    found = decontamination.contamination(single, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("not contaminated")
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in found.collect())
    assert clean.columns == columns

    mixed = stages["source_mixing"](spark, clean, FOLDER).cache()
    times = defaultdict(int)
    for r in mixed.collect():
        times[r.doc_id] += 1
    for r in mixing.mixed_counts(clean).collect():
        assert r.taken == times[r.doc_id] * r.size
    assert mixed.columns == columns

    shards = stages["size_sharding"](spark, mixed, FOLDER)
    assert shards.drop("shard", "slot").exceptAll(mixed).isEmpty() and mixed.exceptAll(shards.drop("shard", "slot")).isEmpty()

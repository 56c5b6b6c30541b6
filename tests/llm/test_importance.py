"""Importance resampling against a plain version, odd rows, ties."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from brute import fold
from llm_rows import ODD, bag
from shoreline.llm import importance

TARGET = "item_id long, text string"


def runs(text, n):
    w = [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold(text)) if x]
    return w, [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n=1, buckets=10_000, least=20, percent=10):
    def counted(texts):
        return Counter(crc32(f.encode()) % buckets for t in texts for f in runs(t, n)[1])

    s, t = counted(x for _, x in docs), counted(target)
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for doc, text in docs:
        w, f = runs(text, n)
        h = int(hashlib.sha256(f"2024:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc32(x.encode()) % buckets] for x in f)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    drawn = percent * len(able) // 100
    rank = {id(r): i + 1 for i, r in enumerate(able[:drawn])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def corpus(seed, n=150):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "ß2", "漢字", "I'm", "A-B"]
    return [(i, " ".join(pick.choice(words) for _ in range(pick.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_scores_equal_brute_force(spark, documents, monkeypatch, n):
    monkeypatch.setattr(importance, "PART", 500)
    rows = corpus(n) + [(1000, None), (1001, ""), (1002, "x" * 50_000), (1003, "a b " * 5_000)]
    target = [t for _, t in corpus(9, 10)] + [None, ""]
    wanted = spark.createDataFrame(list(enumerate(target)), TARGET)
    out = importance.scored(documents(rows).repartition(3), wanted, n=n, buckets=500, percent=30)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in out.collect()]
    assert bag(got) == bag(plain(rows, target, n, 500, percent=30))
    kept = importance.resampled(documents(rows).repartition(2), wanted, n=n, buckets=500, percent=30)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(g[0] for g in got if g[4])
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_odd_rows_ties_and_clashing_columns(spark, documents):
    wanted = spark.createDataFrame([(1, "one two three")], TARGET)
    rows = [(i, t) for i, t, *_ in ODD] + [(50, "same words " * 20)] * 40 + [(None, "no id " * 20)] * 20
    docs = documents(rows).withColumns({c: F.lit(7) for c in ("weight", "n_words", "score", "rank", "_said", "bucket", "_rank")})
    out = importance.scored(docs, wanted).collect()
    expected = plain(rows, ["one two three"])
    assert bag(r[:4] for r in out) == bag(r[:4] for r in expected)
    ranks = sorted(r.rank for r in out if r.rank)
    assert ranks == list(range(1, len(ranks) + 1)) == list(range(1, sum(r[4] is not None for r in expected) + 1))
    # a tie at the end of the draw stays whole
    kept = importance.resampled(docs, wanted)
    assert kept.columns == docs.columns
    drawn = {r.doc_id for r in out if r.rank}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in rows if i in drawn and len((t or "").split()) >= 20)


def test_nothing(spark, documents):
    docs, none = documents([(1, "a b")]), spark.createDataFrame([], TARGET)
    assert importance.scored(docs, none).count() == 1
    assert importance.scored(docs.where("false"), none).count() == 0
    assert importance.resampled(docs, none).count() == 0

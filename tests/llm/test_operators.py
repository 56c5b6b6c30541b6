"""Small cases of the operators: odd rows, hot groups, clashing columns, brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_rows import ODD, bag
from shoreline.llm import decontamination, language, licences, license_texts, mixing, passages, quality, sharding, token_counts, urls

ITEMS = "item_id long, text string"


def clashing(docs):
    names = ["_doc", "_key", "_gone", "_source", "_rate", "_nth", "_said", "lang_pred", "score", "rejected", "shard", "slot",
             "key", "id", "size", "range", "part", "row", "kept", "words", "base_failed", "doc"]
    return docs.withColumns({c: F.lit(7) for c in names})


# substring dedup

def passages_of(seed):
    pick = random.Random(seed)
    shared = [[f"s{k}_{i}" for i in range(pick.randrange(4, 14))] for k in range(6)]
    out = []
    for _ in range(60):
        text = []
        for _ in range(pick.randrange(0, 6)):
            if pick.random() < 0.5:
                own = pick.choice(shared)
                a = pick.randrange(len(own))
                text += own[a:a + pick.randrange(1, 12)]
            else:
                text += [f"u{pick.randrange(40)}" for _ in range(pick.randrange(1, 8))]
        out.append(pick.choice([" ", "  ", "\n"]).join(text))
    out += out[:5] + ["a b c d e f g h i j"] * 9
    pick.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("known,hot", [(True, 1000), (False, 1000), (False, 3)])
def test_substring_dedup_equals_brute_force(documents, monkeypatch, known, hot):
    monkeypatch.setattr(passages, "ANCHOR", 3)
    monkeypatch.setattr(passages, "BLOCK", 40)
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "FIRSTS", hot)
    if not known:
        monkeypatch.setattr(passages, "KNOWN", 0)
    rows = passages_of(int(known)) + [(1000 + i, t) for i, t, *_ in ODD if i is not None]
    got = passages.without_repeats(documents(rows).repartition(3), window=7)
    assert bag((r.doc_id, r.n_words, r.n_removed, r.text or "") for r in got.collect()) == bag(brute.without_repeats(rows, 7))


@pytest.mark.parametrize("batch", [13, 10_000])
def test_a_hot_anchor_fills_no_block(monkeypatch, batch):
    import pyarrow as pa

    for name, value in (("ANCHOR", 3), ("BLOCK", 100), ("HOT", 10), ("FIRSTS", 25)):
        monkeypatch.setattr(passages, name, value)
    pick = random.Random(4)
    # an anchor that is in many texts, mostly among other words, and at times within a whole passage
    around = [f"p{i}" for i in range(4)]
    texts = []
    for i in range(400):
        own = [f"d{i}w{k}" for k in range(8)]
        texts.append(" ".join(own[:4] + (around if pick.random() < 0.2 else own[4:]) + ["hot", "anchor", "here"] + (around if pick.random() < 0.5 else [f"e{i}"])))
    docs = pa.record_batch([pa.array(range(400)), pa.array(range(400)), pa.array(texts)], names=["doc", "key", "text"])
    # the anchor is the run with the least hash
    low = passages._anchor_hashes
    runs = passages.shingle_hashes
    hot = runs(passages.hash_words(np.frombuffer(b"hot anchor here", np.uint8)), 3)[0]
    monkeypatch.setattr(passages, "shingle_hashes", lambda w, n: np.where(runs(w, n) == hot, np.uint64(1), runs(w, n)) if n == 3 else runs(w, n))
    assert low(passages.hash_words(np.frombuffer(b"hot anchor here", np.uint8)), np.array([0]))[0] == 1

    def sorted_by(batches, *columns):
        table = pa.Table.from_batches(list(batches)).sort_by([(c, "ascending") for c in columns]).combine_chunks()
        return table.to_batches(max_chunksize=batch)

    again = sorted_by(passages._recurring(iter(sorted_by(passages._sent(iter([docs]), 7, np.zeros(0, np.int64)), "known", "anchor"))), "doc")
    lists = {}
    for r in (r for b in again for r in b.to_pylist()):
        lists.setdefault(r["doc"], (set(), set()))[0].add(r["anchor"])
        if r["hot"]:
            lists[r["doc"]][1].add(r["anchor"])
    assert sum(1 in hot for _, hot in lists.values()) == 400
    found = pa.record_batch(
        [pa.array(list(lists)), pa.array(list(lists)), pa.array([texts[d] for d in lists]),
         *(pa.array([sorted(x[i]) for x in lists.values()], pa.list_(pa.int64())) for i in (0, 1))], names=["doc", "key", "text", "anchors", "hot"])
    largest = []
    located = passages._located
    monkeypatch.setattr(passages, "_located", lambda held, window: largest.append(sum(len(x[3]) for x in held)) or located(held, window))
    pieces = sorted_by(passages._pieces(iter([found]), 7), "route")
    gone = {}
    for r in (r for b in passages._spans(iter(pieces), 7) for r in b.to_pylist()):
        gone.setdefault(r["doc"], set()).update(range(r["start"], r["stop"]))
    want = {d: n for d, _, n, _ in brute.without_repeats(list(enumerate(texts)), 7) if n}
    assert {d: len(x) for d, x in gone.items()} == want
    assert len(want) > 50 and max(largest) <= 100 + 10 * 11


def test_a_text_is_hashed_once_for_its_anchors(monkeypatch):
    import pyarrow as pa

    runs, asked = passages.shingle_hashes, []
    monkeypatch.setattr(passages, "shingle_hashes", lambda w, n: asked.append(n) or runs(w, n))
    words = passages.mix(np.random.default_rng(3).integers(0, 9, 300).astype(np.uint64))
    for window in (7, 8, 20):
        at, own = passages.anchors(words, window)
        hashes = runs(words, passages.ANCHOR)
        assert at.tolist() == [i + int(hashes[i:i + window - passages.ANCHOR + 1].argmin()) for i in range(300 - window + 1)]
        assert (own.view(np.uint64) == hashes[at]).all()
    asked.clear()
    docs = pa.record_batch([pa.array([1]), pa.array([1]), pa.array([" ".join(f"w{i % 30}" for i in range(90))])], names=["doc", "key", "text"])
    sent = list(passages._sent(iter([docs]), 20, np.zeros(0, np.int64)))
    assert sent[0].num_rows > 3 and asked == [passages.ANCHOR]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 13, 20, 40])
def test_runs_of_words_hash_as_their_polynomial(n):
    words = passages.mix(np.arange(30, dtype=np.uint64))
    given = words.copy()
    n_here, want = min(n, 30), []
    for i in range(30 - n_here + 1):
        total = 0
        for w in words[i:i + n_here].tolist():
            total = (total * 0x2545F4914F6CDD1D + w) % 2**64
        want.append((total + n_here) % 2**64)
    assert passages.shingle_hashes(words, n).tolist() == passages.mix(np.array(want, dtype=np.uint64)).tolist()
    assert (words == given).all()


def test_substring_dedup_of_repeated_ids_and_nothing(documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(4, text), (4, text), (5, "x " + text), (None, text), (6, None), (7, text + " " + text)]
    got = passages.without_repeats(documents(rows)).collect()
    assert sorted((r.n_removed, r.text) for r in got if r.doc_id == 4) == [(0, text)] * 2
    assert next(r.text for r in got if r.doc_id == 5) == "x"
    want = {d: (n, k) for d, n, k, _ in brute.without_repeats(rows, 20)}
    assert all((r.n_words, r.n_removed) == want[r.doc_id] for r in got)
    assert passages.without_repeats(documents([])).count() == 0


# decontamination

def test_contamination_equals_brute_force(spark, documents):
    items = [(1, "Alpha beta-gamma delta"), (2, "alpha BETA"), (30, "x y z alpha beta gamma delta epsilon"), (4, None), (5, "?!"), (2, "alpha beta")]
    pick = random.Random(5)
    vocabulary = "alpha beta gamma delta epsilon x y z É é".split()
    docs = [(i, pick.choice([" ", "-", ", "]).join(pick.choices(vocabulary, k=pick.randrange(0, 60)))) for i in range(80)]
    docs += [(i, t) for i, t, *_ in ODD] + [(200, "alpha beta " + "pad " * 38), (201, "alpha beta " + "pad " * 39)]
    got = decontamination.contamination(documents(docs), spark.createDataFrame(items, ITEMS), window=5).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got]
    assert bag(rows) == bag(brute.contamination(docs, items, 5))


def test_contamination_beyond_the_broadcast_bound(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", -1)
    docs = [(1, "a b c d e f"), (2, "a b"), (2, "a b"), (3, None)]
    got = decontamination.contamination(documents(docs), spark.createDataFrame([(1, "b c d"), (2, "a")], ITEMS), window=3).collect()
    assert sorted((r.doc_id, r.n_hit) for r in got) == [(1, 4), (2, 1), (2, 1), (3, 0)]


def test_contamination_across_blocks_and_of_shared_prompts(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 3)
    pick = random.Random(8)
    prompt = "answer the question that follows"
    items = [(i, f"{prompt} q{i % 7} r{i % 5} s{i % 3}") for i in range(60)] + [(100, "q1 r1"), (101, "s1")]
    pool = [t for _, t in items] + ["q1", "r1 s1", "other words here", prompt]
    docs = [(i, " ".join(pick.choices(pool, k=pick.randrange(0, 5)))) for i in range(60)] + [(7, "same " + prompt)] * 5 + [(900, None)]
    got = decontamination.contamination(documents(docs), spark.createDataFrame(items, ITEMS), window=5).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got]
    assert bag(rows) == bag(brute.contamination(docs, items, 5))


def test_a_window_with_a_known_hash_and_other_words_is_no_hit(spark, documents, monkeypatch):
    # one hash for all windows
    monkeypatch.setattr(decontamination.F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    got = decontamination.contamination(documents([(1, "a b c d"), (2, "b a d c")]), spark.createDataFrame([(1, "b c")], ITEMS), window=2).collect()
    assert sorted((r.doc_id, r.n_hit) for r in got) == [(1, 2), (2, 0)]


def test_decontaminate_keeps_clean_rows_and_columns(spark, documents):
    docs = clashing(documents([(1, "a b c"), (1, "clean text"), (2, "a b c x"), (2, None), (3, "")]))
    benchmark = spark.createDataFrame([(1, "a b c")], ITEMS)
    got = decontamination.decontaminate(docs, benchmark)
    assert got.columns == docs.columns
    assert bag((r.doc_id, r.text) for r in got.collect()) == bag([(1, "clean text"), (2, None), (3, "")])
    assert decontamination.decontaminate(docs, benchmark.limit(0)).count() == 5
    assert decontamination.contamination(documents([]), benchmark).count() == 0


# mixing

def test_targets_stop_at_the_cap_and_are_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 2), ("d", 0), (None, 500)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    cap = {"a": 30.0, "b": 3000.0, "c": 6.0, "d": 0.0, None: 1500.0}
    left, open_, want = 1512.0, set(weight), {}
    while True:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > cap[s]]
        if not over:
            break
        for s in over:
            want[s] = cap[s]
        open_ -= set(over)
        left = 1512.0 - sum(want.values())
    want |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-12) for s in want)


def test_mixing_odd_rows_reruns_and_columns(documents):
    docs = clashing(documents(ODD)).repartition(3)
    rows = mixing.mixed_counts(docs).collect()
    assert bag(rows) == bag(mixing.mixed_counts(docs.coalesce(1)).collect())
    assert len(rows) == len(ODD)
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0 for r in rows)
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert mixing.mixed_counts(documents([])).count() == mixing.mix_sources(documents([])).count() == 0


def test_mix_comes_near_its_targets(documents):
    pick = random.Random(2)
    rows = [(i, "w " * pick.randrange(1, 40), "en", pick.choice("aaaaab")) for i in range(3000)]
    got = mixing.mixed_counts(documents(rows)).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)


# sharding

def test_sharding_keeps_groups_and_cuts_what_does_not_fit(documents):
    rows = [(i, "same text " * 30) for i in range(400)] + [(1000 + i, f"own {i} " * (i % 7)) for i in range(300)] + [(5000, "z" * 9_000)]
    got = sharding.shard_rows(documents(rows), shards=4).collect()
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows) and max(load.values()) < 1.1 * min(load.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_equals_brute_force_and_splits_hot_keys(documents):
    rows = [(i, "") for i in range(3000)] + [(5000 + i, f"own {i} " * (i % 40)) for i in range(2000)] + [(i, "twice " * 9) for i in (1, 1, 2)]
    records = documents(rows).select(
        F.col("doc_id").alias("id"), sharding.key_of(F.col("text")).alias("key"), sharding.size_of(F.col("text")).alias("size"))
    made = sharding.plan(records, 8)
    got = sharding.placed(records, made).collect()
    want, numbered = brute.sharded(rows, made.splitters, made.ranges)
    assert bag((r.id, r.size, r.shard, r.slot) for r in got) == bag(want)
    # the empty texts are one range of 3000 rows; numbered in parts, but kept together
    assert max(numbered) <= 6 * len(rows) / (8 * sharding.RANGES_PER_SHARD)
    assert len({r.shard for r in got if r.size == 1}) == 1
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) < 1.05 * min(load.values())


def test_sharding_deals_equal_rows_of_one_id(documents):
    got = sharding.shard_rows(documents([(7, "same")] * 300 + [(i, f"t{i}") for i in range(100)])).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 400 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_odd_rows(documents):
    got = sharding.shard_rows(documents(ODD)).collect()
    assert bag((r.doc_id, r.size) for r in got) == bag((i, len((t or "").encode()) + 1) for i, t, *_ in ODD)
    docs = clashing(documents(ODD))
    out = sharding.sharded(docs)
    assert out.columns[:-2] == docs.columns and out.columns[-2:] == ["shard_", "slot_"]
    assert out.count() == len(ODD)
    assert sharding.shard_rows(documents([])).count() == 0


# language

def test_language_odd_rows(documents):
    words = {"en": "the of and to in that", "fr": "le la des que et pour", "de": "der die und nicht ein"}
    rows = [(10 * i + k, " ".join(random.Random(i).choices(w.split(), k=30)), lang) for i in range(40) for k, (lang, w) in enumerate(words.items())]
    got = {r.doc_id: r for r in language.identify(documents(rows + [(9001, None, None), (9002, "12 34!", "en"), (9003, "die und der nicht", None)])).collect()}
    assert all(got[d].lang_pred == lang for d, _, lang in rows)
    assert (got[9001].lang_pred, got[9001].score, got[9002].lang_pred) == ("und", 0.0, "und")
    assert got[9003].lang_pred == "de"
    only = language.identify(documents(ODD)).collect()
    assert len(only) == len(ODD)
    docs = clashing(documents([(i, t, lang) for i, t, lang in rows] + [(9001, None, None)]))
    out = language.accepted(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert language.identify(documents([])).count() == 0
    assert {r.lang_pred for r in language.identify(documents([(1, "no label")])).collect()} == {"und"}


def test_language_sends_a_bounded_sample_to_the_driver(documents, monkeypatch):
    assert [language.level(x, 100) for x in ([10, 20], [10, 200], [60, 70, 80], [5])] == [20, 90, 33, 5]
    monkeypatch.setattr(language, "DICTIONARY", 1000)
    folded, seen = language.folded, []
    monkeypatch.setattr(language, "folded", lambda text: seen.append(text) or folded(text))
    learned = language.train(documents([(i, f"word{i % 7} und " * 300, "de") for i in range(90)] + [(900, "a short one", "en")]))
    assert sum(map(len, seen)) <= 2 * language.READ * 1000
    assert 900 <= len(learned["de"]) <= 1000 + 90 and learned["en"] == b"a short one"


# quality

def test_quality_counts_equal_brute_force(documents):
    pick = random.Random(4)
    rows = [(i, pick.choice([" ", "\n", " \t"]).join(pick.choices("a bb c# the und $x".split(), k=pick.randrange(0, 60)))) for i in range(60)]
    rows += [(i, t) for i, t, *_ in ODD] + [(100, "p q r s t u v w " * 3 + "x " * 30), (101, "l 1\nl 1\n\nl 2\nl 1\n" * 5)]
    got = quality.judged(clashing(documents(rows)).drop("kept", "words", "base_failed")).collect()
    counted = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert bag(counted) == bag((d, *brute.base_quality(t)) for d, t in rows)
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.judged(documents([])).count() == 0


def test_quality_verdict(documents):
    clean = " ".join(f"the of word{i}" for i in range(20))
    rows = [(1, clean), (2, clean.replace(" ", "### ")), (3, " ".join(f"wordwithoutstop{i}" for i in range(60)))]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judged(documents(rows)).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (False, False)}


# licences

def test_licences(documents):
    isc = dict(licences.KNOWN)["ISC"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n" + isc.upper()), (2, "text\n  licensed under the Apache Licence -- version 2.0\nmore"),
        (3, None), (4, ""), (5, "Licensed under CC BY NC 4.0!\nReleased under the MIT License."), (5, "other"), (6, "MIT")]
    got = licences.licences(documents(rows)).collect()
    assert bag(got) == bag([
        (1, "ISC", 1, "ISC"), (2, None, 1, "Apache-2.0"), (3, None, 0, ""), (4, None, 0, ""),
        (5, None, 2, "CC-BY-NC-4.0,MIT"), (5, None, 0, ""), (6, None, 0, "")])
    assert licences.licences(documents([])).count() == 0


def test_whole_licences_in_any_wrap(documents):
    folder = license_texts.FOLDER
    want = {p.name: p.name.removesuffix(".txt").removesuffix(".regents") for p in folder.glob("*.txt")}
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0"} <= set(want.values())
    rows, expected = [], []
    for name, license in sorted(want.items()):
        text = (folder / name).read_text()
        # copyright lines of the text itself stay as they are; all else is wrapped anew
        for width in (40, 61, 78):
            parts = [p if re.search(r"(?i)copyright[ (]+c\)|copyright \[|\(c\) *[_1y]", p) else textwrap.fill(p, width, break_long_words=False) for p in re.split(r"\n\s*\n", text)]
            rows.append((len(rows), "Copyright 2024 Someone\n\n" + "\n\n".join(parts)))
            expected.append(license)
    got = {r.doc_id: r.license for r in licences.licences(documents(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == expected


def test_licence_titles_headers_and_cuts(documents):
    mit, gpl, apache = ((license_texts.FOLDER / f"{x}.txt").read_text() for x in ("MIT", "GPL-2.0-only", "Apache-2.0"))
    header = license_texts.APACHE
    rows = [
        (1, "The MIT License (MIT)\n\nCopyright Someone Inc.\n\n" + mit), (2, gpl[:gpl.index("How to Apply")]),
        (3, gpl.replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA")),
        (4, apache[:apache.index("END OF TERMS")]), (5, "/*\n * Copyright 2020 A\n */"), (6, textwrap.fill(header, 50)),
        (7, "x\n// SPDX-License-Identifier: GPL-2.0-or-later\ny"), (8, "a\nAll rights reserved.\nb"), (9, mit + "\nand more")]
    got = {r.doc_id: (r.license, r.line_licenses) for r in licences.licences(documents(rows)).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 6, 9)] == ["MIT", "GPL-2.0-only", "GPL-2.0-only", "Apache-2.0", "Apache-2.0", None]
    assert (got[5], got[7], got[8]) == ((None, ""), (None, "GPL-2.0-or-later"), (None, "LicenseRef-All-Rights-Reserved"))


# token counts

def test_lengths_by_limit_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 4)
    pick = random.Random(1)
    lengths = [pick.randrange(0, 40) for _ in range(200)]
    frame = spark.createDataFrame(list(Counter(lengths).items()), "length long, docs long")
    limits = token_counts.by_limit(frame).cache()
    for r in limits.collect():
        longer = [n for n in lengths if n >= r.length]
        assert (r.docs_from, r.tokens_from, r.docs_to) == (len(longer), sum(longer), sum(n <= r.length for n in lengths))
        assert r.tokens_cut == sum(min(n, r.length) for n in lengths)
    assert token_counts.quantile(limits, 0.5) == sorted(lengths)[99]
    assert token_counts.by_limit(frame.limit(0)).count() == 0


def test_parts_of_a_text_add_up(documents):
    encoding = token_counts.load(token_counts.VOCABULARY)
    for text in ("many words here and there, 12 34\n\n  " * 300, "x" * 3_000, "", "a b " * 2_000):
        whole = len(encoding.encode_ordinary(text))
        assert sum(len(encoding.encode_ordinary(p)) for p in token_counts.parts(text, 50)) == whole
        assert "".join(token_counts.parts(text, 50)) == text
    rows = token_counts.histogram(documents(ODD)).collect()
    assert sum(r.docs for r in rows) == len(ODD)


# URLs

PAGES = "page_id long, url string, host string, score double"


def test_url_parts_and_rules(spark):
    cases = [
        ("http://A.Org/x", "a.org", "/x", "org/"), ("https://www.example.org/es/1?q#f", "www.example.org", "/es/1", "example.org/es/"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"), ("http://example.org/en/2", "example.org", "/en/2", "org/"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/"), ("x://b.com/fr/", "b.com", "/fr/", "com/fr/"),
        ("x://b.com/de/1", "b.com", "/de/1", "com/de/"), ("x://b.com/en/1", "b.com", "/en/1", None), ("x://org", "org", "", None),
        ("x://a.org?y=/z", "a.org", "", None), ("no scheme.org/", "", "", None), (None, "", "", None), ("", "", "", None), ("a://b://c/d", "b:", "//c/d", None),
    ]
    pages = spark.createDataFrame([(i, c[0], "h", 0.0) for i, c in enumerate(cases)], PAGES)
    got = sorted(urls.judged(pages).collect())
    assert [(r.url, r.host_, r.path, r.rule) for r in got] == cases
    said = {"org/": "allow", "com/fr/": "allow"}
    assert all(r.verdict == said.get(r.rule, "block") for r in got if r.rule)
    assert all(r.verdict in ("allow", "block") for r in got)
    assert urls.judged(pages.limit(0)).count() == 0


def plain_score(labelled, text, order, smoothing):
    """The log-likelihood difference of a text, by recursion over counts."""
    count = {True: Counter(), False: Counter()}
    for t, allowed, n in labelled:
        for k in range(1, order + 2):
            padded = "^" * (k - 1) + t + "$"
            for i in range(len(t) + 1):
                count[allowed][padded[i:i + k]] += n
    total = {s: defaultdict(int) for s in count}
    for side, grams in count.items():
        for g, n in grams.items():
            total[side][len(g), g[:-1]] += n

    def likelihood(side, gram):
        below = likelihood(side, gram[1:]) if len(gram) > 1 else 1 / len(urls.SYMBOLS)
        return (count[side][gram] + smoothing * below) / (total[side][len(gram), gram[:-1]] + smoothing)

    padded = "^" * order + text + "$"
    ratios = [math.log(likelihood(True, padded[i:i + order + 1]) / likelihood(False, padded[i:i + order + 1])) for i in range(len(text) + 1)]
    return sum(ratios) / len(ratios)


def test_url_scores_equal_brute_force(spark):
    labelled = [("a.org/x0", True, 2), ("b.org/yy", True, 1), ("c.com/de/0", False, 3), ("d.com/_", False, 1)]
    table = urls.model(spark.createDataFrame(labelled, "text string, allowed boolean, n long").select("text", "allowed", "n"))
    texts = ["a.org/x0", "e.com/de/", "zzz", "q", "a.org.c.com", "--"]
    got = urls.scores(spark.createDataFrame([(t,) for t in texts], "text string"), table).collect()
    assert len(got) == len(texts)
    for r in got:
        assert math.isclose(r.score, plain_score(labelled, r.text, urls.ORDER, urls.SMOOTHING), rel_tol=1e-9, abs_tol=1e-12)


def test_url_threshold(spark):
    scored = spark.createDataFrame([(0.5, True)] * 9 + [(0.3, False)] * 9 + [(9.0, True), (-9.0, False)], "score double, allowed boolean")
    assert 0.3 < urls.threshold(scored) <= 0.5
    assert urls.threshold(scored.where("allowed")) == 0.0

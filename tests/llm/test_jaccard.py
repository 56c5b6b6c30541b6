from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from brute import components as brute
from brute import shingles
from llm_rows import ODD, bag
from shoreline.llm import graph, jaccard, trie, words


def near_copies(seed, groups=6, most=7, vocabulary=400):
    pick = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{pick.randrange(vocabulary)}" for _ in range(pick.randrange(3, 90))]
        for _ in range(pick.randrange(1, most)):
            own = list(base)
            for _ in range(pick.randrange(0, 3)):
                own[pick.randrange(len(own))] = f"v{pick.randrange(50)}"
            texts.append(" ".join(own))
    common = " ".join(f"c{i}" for i in range(25))
    texts += [common + f" own{i}" for i in range(40)] + [common] * 3
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 4, 5)])
def test_components_equal_brute_force(documents, n, num, den):
    rows = near_copies(n) + [(1000 + i, t) for i, t, *_ in ODD if i is not None and i > 3]
    got = jaccard.linked_components(documents(rows), n=n, num=num, den=den).collect()
    assert bag(got) == bag(brute(rows, n, num, den))


def test_split_clusters_and_vertices_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 150)
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    rows = near_copies(11)
    got = jaccard.linked_components(documents(rows), n=3, num=90, den=100).collect()
    assert bag(got) == bag(brute(rows, 3, 90, 100))


def test_common_tokens_dont_run_clusters_together(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 4)
    monkeypatch.setattr(jaccard, "ORDERED", 0)
    pick = random.Random(7)
    common = [" ".join(f"c{i}w{k}" for k in range(8)) for i in range(30)]
    rows = []
    for i in range(120):
        parts = pick.sample(common, 5) + [f"own{i}a{k} own{i}b{k} own{i}c{k} own{i}d{k}" for k in range(6)]
        pick.shuffle(parts)
        rows += [(10 * i + k, " ".join([*parts, *["end"] * k])) for k in range(1 + i % 3)]
    largest = []
    blocks = jaccard._blocks

    def seen(members, num, den):
        largest.append(members.groupBy("component").count().agg({"count": "max"}).first()[0])
        return blocks(members, num, den)

    monkeypatch.setattr(jaccard, "_blocks", seen)
    for chunk in (10**9, 200):
        monkeypatch.setattr(jaccard, "CHUNK", chunk)
        got = jaccard.linked_components(documents(rows).repartition(3), n=3, num=90, den=100).collect()
        assert bag(got) == bag(brute(rows, 3, 90, 100))
    assert largest[0] > 100 and largest[1] == 3


@pytest.mark.parametrize("looked,batch", [(10**6, 1000), (40, 7)])
def test_counted_tokens(monkeypatch, looked, batch):
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "PAIRED", 3)
    monkeypatch.setattr(jaccard, "LOOKED", looked)
    pick = random.Random(looked)
    texts = [" ".join(f"t{min(pick.randrange(40), pick.randrange(40))}" for _ in range(12)) for _ in range(25)]
    sets = {jaccard._class_of(s)[0]: s for s in (jaccard.shingle_set(np.frombuffer(t.encode(), np.uint8), 1) for t in texts)}
    own = [jaccard._class_of(jaccard.shingle_set(np.frombuffer(t.encode(), np.uint8), 1))[0] for t in texts]
    rows = []
    # two tasks, of which the second repeats some texts
    for part in (slice(0, 15), slice(12, 25)):
        given = pa.record_batch([pa.array(texts[part]), pa.array(own[part])], names=["text", "class"])
        rows += [r for b in jaccard._all_tokens(iter([given]), 1) for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["spread"], r["token"], r["class"] is not None, r["class"] or 0))
    columns = pa.Table.from_pylist(rows, schema=pa.schema([("token", pa.int64()), ("class", pa.int64()), ("size", pa.int64()), ("spread", pa.bool_())]))
    out = [r for b in jaccard._counted(iter(columns.to_batches(max_chunksize=batch))) for r in b.to_pylist()]
    count = {}
    for s in sets.values():
        for t in s.view(np.int64).tolist():
            count[t] = count.get(t, 0) + 1
    want = {(c, t, min(count[t], 4)) for c, s in sets.items() for t in s.view(np.int64).tolist() if count[t] > 1}
    assert {(r["class"], r["token"], r["place"]) for r in out if r["token"] is not None} == want
    for c, s in sets.items():
        assert sum(r["single"] for r in out if r["class"] == c) == sum(count[t] == 1 for t in s.view(np.int64).tolist())
        assert {r["size"] for r in out if r["class"] == c} <= {len(s)}


def test_frequent_tokens_of_a_block():
    pick = random.Random(2)
    for size in (0, 1, 2, 5, 60):
        sets = [np.unique(np.array([pick.randrange(9) for _ in range(6)], dtype=np.uint64)) for _ in range(size)]
        tokens, count = jaccard._frequent(sets)
        every = [t for s in sets for t in s.tolist()]
        assert dict(zip(tokens.tolist(), count.tolist())) == {t: every.count(t) for t in set(every) if every.count(t) >= jaccard.LEAST}


def linked_pairs(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    return [(i, j) for i, s in enumerate(sets) for j in range(len(sets)) if i != j and s and sets[j] and den * len(s & sets[j]) >= num * len(s | sets[j])]


@pytest.mark.parametrize("chunk", [500_000, 150])
def test_every_link_is_found(documents, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    base = [f"w{i}" for i in range(60)]
    # all of these link with each other
    rows = near_copies(5) + [(900 + i, " ".join(base + [f"x{i}"])) for i in range(6)]
    rows += [(None, " ".join(base + ["y"])), (None, " ".join(base + ["y"])), (900, " ".join(base + ["z"]))]
    both = linked_pairs(rows, 3, 90, 100)
    got = jaccard.link_counts(documents(rows)).collect()
    assert bag(got) == bag([(d, len(shingles(t, 3)), sum(i == k for i, _ in both)) for k, (d, t) in enumerate(rows)])
    sets = [shingles(t, 3) for _, t in rows]
    least = {s: min((d is None, d or 0) for (d, _), x in zip(rows, sets) if x == s) for s in sets}
    want = {frozenset((sets[i], sets[j])) for i, j in both if sets[i] != sets[j]}
    ends = [sorted(least[s] for s in pair) for pair in want]
    found = jaccard.links(documents(rows)).collect()
    assert len(set(found)) == len(found)
    assert sorted(sorted([(r.a is None, r.a or 0), (r.b is None, r.b or 0)]) for r in found) == sorted(ends)


def test_blocks_are_broadcast_by_their_entries(spark, documents, monkeypatch):
    rows = spark.range(2).selectExpr("id as at", "array_repeat(named_struct('block', id, 'side', -1), 5) as blocks")
    for most, hinted in ((10, True), (9, False)):
        monkeypatch.setattr(jaccard, "ENTRIES", most)
        assert ("broadcast" in jaccard._narrow(rows)._jdf.queryExecution().logical().toString()) == hinted
    monkeypatch.setattr(jaccard, "ENTRIES", 0)
    docs = near_copies(2, groups=3)
    assert bag(jaccard.linked_components(documents(docs)).collect()) == bag(brute(docs, 3, 90, 100))


def test_odd_rows(documents):
    rows = [(i, t) for i, t, *_ in ODD]
    got = jaccard.linked_components(documents(ODD), n=3, num=90, den=100).collect()
    assert bag(got) == bag(brute(rows, 3, 90, 100))


def test_a_repeated_id_with_several_texts(documents):
    rows = [(1, "a b c d e"), (1, "f g h i j"), (2, "f g h i j"), (3, "k l m n o")]
    got = jaccard.linked_components(documents(rows), n=3, num=90, den=100).collect()
    assert bag(got) == bag(brute(rows, 3, 90, 100))


def test_empty_table(documents):
    assert jaccard.linked_components(documents([])).count() == 0
    assert jaccard.one_of_each(documents([])).count() == 0


def test_one_of_each_keeps_columns_and_one_row(documents):
    from pyspark.sql import functions as F

    docs = documents([(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, "z y x"), (3, "z y x"), (4, ""), (4, "")])
    docs = docs.withColumns({c: F.lit(1) for c in ("_gone", "_again", "component_id", "doc", "key")})
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4, 4]


def test_one_of_each_tells_texts_of_an_id_apart(documents):
    x, y, p, q, z = ("a b c d e f g", "h i j k l m n", "o p q r s t u", "v w x y z a b", "nothing else is like this one")
    rows = [(2, x), (5, x), (5, y), (6, p), (6, q), (6, q), (5, ""), (6, None), (None, x), (None, z), (None, z)]
    got = jaccard.one_of_each(documents(rows))
    assert bag([(r.doc_id, r.text) for r in got.collect()]) == bag([(2, x), (5, y), (6, p), (6, q), (5, ""), (6, None), (None, z)])
    assert jaccard.one_of_each(documents([(None, x), (None, x), (None, y)])).count() == 2


def test_trie_join_equals_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(60):
        top, sets, seen = (10**6, 60)[trial % 2], [], set()
        for _ in range(rng.integers(1, 5)):
            base = rng.choice(top, size=rng.integers(1, 40), replace=False)
            for _ in range(rng.integers(1, 9)):
                k = rng.integers(0, max(1, len(base) // 6) + 1)
                drop = rng.choice(len(base), size=min(k, len(base) - 1), replace=False)
                s = np.unique(np.concatenate([np.delete(base, drop), rng.integers(0, top, size=k)]))
                if s.tobytes() not in seen:
                    seen.add(s.tobytes())
                    sets.append(s)
        num, den = [(9, 10), (4, 5), (1, 2)][trial % 3]
        sides = rng.integers(0, 2, size=len(sets))
        plain = [set(map(int, s)) for s in sets]
        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if den * len(plain[i] & plain[j]) >= num * len(plain[i] | plain[j]):
                    want = [want[i] if x == want[j] else x for x in want]
        halves = [np.flatnonzero(sides == k) for k in (0, 1)]
        apart = [(h[i], h[j]) for h in halves for i, j in trie.join([sets[x] for x in h], num, den)]
        for found in (trie.join(sets, num, den), apart + trie.join(sets, num, den, sides)):
            got = list(range(len(sets)))
            for i, j in found:
                got = [got[i] if x == got[j] else x for x in got]
            same = lambda g: [g.index(x) for x in g]
            assert same(got) == same(want)


def test_components_of_a_graph(spark):
    pick = random.Random(3)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.vertex: r.component for r in got} == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_hash_as_they_compare():
    text = " the The  cat\n\tsat a\x0bb\x0cc ünï the"
    plain = text.split()
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    hashes, starts, ends = words.hash_words(data, spans=True)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == plain
    assert len(set(hashes.tolist())) == len(set(plain))
    assert len(set(words.hash_words(data, fold=True).tolist())) == len({w.lower() for w in plain})


def test_long_texts_are_read_in_blocks(monkeypatch):
    data = np.frombuffer(("word " * 5_000 + "y" * 3_000 + " end").encode(), dtype=np.uint8)
    whole = words.hash_words(data)
    monkeypatch.setattr(words, "BLOCK", 777)
    assert (words.hash_words(data) == whole).all()


def test_ranks_of_a_chunk_take_little_more_than_the_chunk():
    pick = np.random.default_rng(3)
    sets = [np.unique(pick.integers(0, 50_000, 200).astype(np.uint64)) for _ in range(1000)]
    given = sum(s.nbytes for s in sets)
    tracemalloc.start()
    ranks = trie._ranks(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * given
    tokens, count = np.unique(np.concatenate(sets), return_counts=True)
    place = {int(t): i for i, t in enumerate(tokens[np.lexsort((tokens, count))])}
    assert all(sorted(place[int(t)] for t in s) == r.tolist() for s, r in zip(sets, ranks))
    assert [len(r) for r in trie._ranks([sets[0][:0], sets[1][:0]])] == [0, 0]


def resident():
    with open("/proc/self/status") as f:
        return next(int(x.split()[1]) for x in f if x.startswith("VmRSS"))


def test_memory_goes_back_after_a_task_and_after_a_large_block(monkeypatch):
    def used_and_freed():
        # small pieces, of which the last stays, are kept by the allocator
        held = [np.ones(10_000, np.uint8) for _ in range(12_000)]
        last = held.pop()
        yield last
        held.clear()
        kept.append((resident(), last))

    kept = []
    assert len(list(words.freed(used_and_freed()))) == 1
    assert kept[0][0] - resident() > 50_000
    calls = []
    monkeypatch.setattr(jaccard, "give_back", lambda: calls.append(1))
    for tokens, given in ((10, 0), (300_000, 1)):
        values = np.sort(np.random.default_rng(1).integers(0, 1 << 62, tokens))
        rows = [values.tolist(), values[1:].tolist()]
        group = pa.table({"block": [1, 1], "side": [-1, -1], "class": [5, 6], "copies": [1, 1], "shingles": pa.array(rows, pa.list_(pa.int64()))})
        assert sorted(jaccard._joined(group, jaccard._linked, 9, 10).to_pylist()[0].values()) == [5, 6]
        assert len(calls) == given

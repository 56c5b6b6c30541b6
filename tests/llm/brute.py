"""Plain Python versions of the operators, over lists of (doc_id, text)."""

from __future__ import annotations

import bisect
import hashlib
import re

import xxhash

GAP = re.compile("[\x20\x09-\x0d]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def shingles(text, n):
    w = words(fold(text))
    return frozenset(tuple(w[i:i + n]) for i in range(max(len(w) - n, 0) + 1)) if w else frozenset()


def components(docs, n, num, den):
    sets = [shingles(t, n) for _, t in docs]
    group = list(range(len(docs)))
    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and den * len(s & sets[j]) >= num * len(s | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, docs):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [(doc, len(s), least.get(g)) if s else (doc, 0, doc) for (doc, _), s, g in zip(docs, sets, group)]


def without_repeats(docs, window):
    def at(i, s):
        return (float("inf") if docs[i][0] is None else docs[i][0], s)

    cut = [words(t) for _, t in docs]
    first = {}
    for i, w in enumerate(cut):
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, at(i, s)), at(i, s))
    out = []
    for i, w in enumerate(cut):
        gone = set()
        for s in range(len(w) - window + 1):
            if at(i, s) > first[tuple(w[s:s + window])]:
                gone.update(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((docs[i][0], len(w), len(gone), kept))
    return out


def contamination(docs, items, window):
    def cut(text):
        return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold(text)) if w]

    known = {}
    for item, text in items:
        w = cut(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if w else ():
            known.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    lengths = {len(k) for k in known}
    out = []
    for doc, text in docs:
        w, hit, found = cut(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (own := known.get(tuple(w[i:i + n]))):
                    hit.update(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def base_quality(text):
    w = words(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeat = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeat), failed)


def signed(value, bits=64):
    return value - (1 << bits) if value >> (bits - 1) else value


def spark_hash(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed)


def sharded(docs, splitters, ranges):
    """(id, size, shard, slot) of each document by a given plan, and how many rows are numbered together."""
    of = {at: (shards, firsts) for at, shards, firsts in ranges}
    groups = {}
    for doc, text in docs:
        data = (text or "").encode()
        key = signed(spark_hash(data))
        at = bisect.bisect_right(list(splitters), key)
        # the id's text, then the number 9 as four bytes that are hashed with the first hash as seed
        draw = spark_int_hash(9, spark_hash(str(doc).encode())) >> 11
        part = draw * len(of[at][0]) >> 53
        groups.setdefault((at, part), []).append((key, doc, len(data) + 1))
    out = []
    for (at, part), rows in groups.items():
        shards, firsts = of[at]
        out += [(doc, size, shards[part], firsts[part] + nth) for nth, (_, doc, size) in enumerate(sorted(rows))]
    return out, [len(rows) for rows in groups.values()]


def spark_int_hash(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed=seed)

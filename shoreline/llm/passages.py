"""Removal of passages that occur earlier in the corpus.

A word is removed if a window of `window` words covers it that also starts earlier: in a document
with a smaller id, or before in the same one. Windows are judged on the input.

1. Documents with the same words are one class; all but the first lose every word if they have a
   window. The rest are unique texts.
2. Confirming. Each window has an anchor, its run of ANCHOR words with the least hash. Windows
   that are equal have equal anchors, so only windows over a recurring anchor can recur. About one
   anchor in eight words is sent, 16 bytes each.
3. Windows over recurring anchors go, as short pieces of text, to the shard of their anchor.
   Anchors that are frequent somewhere don't meet for confirming. Their windows, and those over anchors that
   the confirming shuffle counts more than HOT times, go one by one, by content; equal ones of a task are
   reduced to the first before that. So neither a passage in a third of all documents nor one in a thousandth of them meets in one task.
4. A shard takes pieces in blocks of BLOCK words and whole anchors, of at most HOT places each, keeps the first
   of equal windows that go by content, compiles the windows that recur there into an Aho-Corasick automaton over word numbers, and streams the pieces through it. Hits are exact: words
   are compared, not hashes. Equal windows of one text go as their first, the others are cut at once.
5. Hits but the first of a window are merged to spans and cut out of the documents.

Words of null, empty and blank texts: none. A text shorter than the window is kept. A null id comes after
all others. Rows that repeat an id count as the same place: equal windows at the same start don't remove one
another. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import small_side
from shoreline.llm.words import hash_words, mix, shingle_hashes, texts_as_bytes
from shoreline.session import cut_lineage

WINDOW = 20
ANCHOR = 6
#: Words that one automaton is made from, and those of one more anchor.
BLOCK = 100_000
#: Places of an anchor that meet in one block; windows over anchors with more go by content.
HOT = 1_000
#: Windows by content of which a task knows the first at a time.
FIRSTS = 100_000
#: Anchors counted at a time, and the share of documents and the count that make one frequent.
COUNTED = 500_000
RARE, LEAST = 500, 4
#: Frequent anchors that are known to all tasks, 8 bytes each.
KNOWN = 200_000
#: Numbers of a broadcast side.
NARROW = 4_000_000
LAST = (1 << 63) - 1

_SIGNED = np.int64


def _anchor_hashes(words: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    return shingle_hashes(words, ANCHOR)[at].view(_SIGNED)


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The start of the anchor of each window, and its hash."""
    least = runs = _anchor_hashes(words).view(np.uint64)
    at = np.arange(len(runs))
    wide, length = window - ANCHOR + 1, 1
    # the first of the least hashes of 2, 4, ... runs, and at last of all in the window
    while length < wide:
        step = min(length, wide - length)
        at = np.where(least[step:] < least[:-step], at[step:], at[:-step])
        least = runs[at]
        length += step
    return at, least.view(_SIGNED)


def _distinct_anchors(words: np.ndarray, window: int) -> np.ndarray:
    """The hash of the anchor at each place that has one."""
    at, own = anchors(words, window)
    # no window's anchor is before that of the window before
    return own[np.concatenate([[True], at[1:] != at[:-1]])]


_PLACES: dict[int, np.ndarray] = {}


def _placed(words: np.ndarray, salt: int) -> np.ndarray:
    """The words' hashes, mixed with their places."""
    if len(_PLACES.get(salt, ())) < len(words):
        _PLACES[salt] = mix(np.arange(max(len(words), 1 << 15), dtype=np.uint64) + np.uint64(salt << 40))
    return mix(words ^ _PLACES[salt][: len(words)])


def _describe(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(doc, key, text) to (doc, key, n, a, b) and to (anchor, count) of frequent anchors."""
    names = ["doc", "key", "n", "a", "b", "anchor", "count"]
    held, docs, size = [], 0, 0

    def reported():
        found, count = np.unique(np.concatenate(held), return_counts=True)
        often = count >= max(LEAST, docs // RARE)
        none = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none] * 5 + [pa.array(found[often]), pa.array(count[often])], names=names)

    for batch in batches:
        n, a, b = [], [], []
        for text in texts_as_bytes(batch.column(2)):
            words = hash_words(text) if text is not None else np.zeros(0, np.uint64)
            n.append(len(words))
            for out, salt in ((a, 1), (b, 2)):
                out.append(int(np.add.reduce(_placed(words, salt)).view(_SIGNED)) if len(words) else 0)
            docs += 1
            if len(words) >= window:
                held.append(np.unique(_distinct_anchors(words, window)))
                size += len(held[-1])
                if size > COUNTED:
                    yield reported()
                    held, docs, size = [], 0, 0
        none = pa.nulls(batch.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (n, a, b)), none, none], names=names)
    if held:
        yield reported()


def _known(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(hashes), dtype=bool)
    return frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes


def _sent(batches: Iterator[pa.RecordBatch], window: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc, key, text) to (anchor, doc, key, known); an anchor comes as often as it occurs, up to one more than HOT."""
    for batch in batches:
        parts = []
        doc, key = (batch.column(i).to_numpy() for i in (0, 1))
        for i, text in enumerate(texts_as_bytes(batch.column(2))):
            words = hash_words(text) if text is not None else ()
            if len(words) < window:
                continue
            found, count = np.unique(_distinct_anchors(words, window), return_counts=True)
            found = np.repeat(found, np.minimum(count, HOT + 1))
            parts.append((found, np.full(len(found), doc[i]), np.full(len(found), key[i])))
        if parts:
            columns = [np.concatenate(x).astype(_SIGNED) for x in zip(*parts)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(_known(columns[0], frequent))], names=["anchor", "doc", "key", "known"])


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by known and anchor to those that are known or not the only one of their anchor. hot: whether
    it is known or has more than HOT rows."""
    kept = np.zeros((3, 0), dtype=_SIGNED)
    large = None

    def out(rows, hot):
        return pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(hot)], names=["anchor", "doc", "key", "hot"])

    def settled(rows):
        group = np.cumsum(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])) - 1
        count = np.bincount(group)[group]
        return out(rows[:, count > 1], count[count > 1] > HOT)

    def surely(rows):
        return out(rows, np.ones(rows.shape[1], dtype=bool))

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
        known = batch.column(3).to_numpy(zero_copy_only=False)
        if known.any():
            yield surely(rows[:, known])
            rows = rows[:, ~known]
        if large is not None:
            more = rows[0] == large
            if more.any():
                yield surely(rows[:, more])
                rows = rows[:, ~more]
        rows = np.concatenate([kept, rows], axis=1)
        # the last anchor waits for more of its rows, up to HOT
        open_ = rows[0] == rows[0, -1] if rows.shape[1] else np.zeros(0, dtype=bool)
        if not open_.all():
            yield settled(rows[:, ~open_])
        kept = rows[:, open_]
        if kept.shape[1] > HOT:
            large = kept[0, 0]
            yield surely(kept)
            kept = kept[:, :0]
    if kept.shape[1]:
        yield settled(kept)


PIECES = "route long, doc long, key long, start long, stop long, text binary"


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [*(pa.array(columns[i], pa.int64()) for i in range(5)), pa.array(columns[5], pa.binary())],
        names=["route", "doc", "key", "start", "stop", "text"])


def _route(content: bytes, window: int) -> int:
    return int(shingle_hashes(hash_words(np.frombuffer(content, np.uint8)), window)[0].view(_SIGNED))


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(doc, key, text, recurring anchors, hot ones) to pieces of text with a route, and to spans (without one) of windows that aren't
    the first of this task."""
    first: dict[bytes, tuple] = {}

    def firsts():
        rows = []
        for content, (d, s, k) in first.items():
            rows.append((_route(content, window), d, k, s, s + window, content))
            if len(rows) == 10_000:
                yield _piece_batch(rows)
                rows = []
        yield _piece_batch(rows)

    for batch in batches:
        rows, again = [], []
        doc, key = (batch.column(i).to_numpy() for i in (0, 1))
        lists, hot = batch.column(3), batch.column(4)
        for i, text in enumerate(texts_as_bytes(batch.column(2))):
            words, starts, ends = hash_words(text, spans=True)
            at, own = anchors(words, window)
            wanted = np.flatnonzero(np.isin(own, lists[i].values.to_numpy()))
            if not len(wanted):
                continue
            # within a text only the first of equal windows goes on; their words are compared by hash
            _, first_here, same = np.unique(shingle_hashes(words, window)[wanted], return_index=True, return_inverse=True)
            like = wanted[first_here][same]
            equal = like != wanted
            one, two = (x[equal][:, None] + np.arange(window) for x in (wanted, like))
            equal[equal] = (words[one] == words[two]).all(axis=1)
            if equal.any():
                ones = np.ones(int(equal.sum()), dtype=_SIGNED)
                again.append(_merged(ones * doc[i], ones * key[i], wanted[equal], window))
                wanted = wanted[~equal]
            raw = text.tobytes()
            known = np.isin(own[wanted], hot[i].values.to_numpy())
            for s in wanted[known].tolist():
                content = b" ".join(raw[starts[s]:ends[s + window - 1]].split())
                here, other = (int(doc[i]), s, int(key[i])), first.get(content)
                if other is None:
                    first[content] = here
                    continue
                if here[:2] < other[:2]:
                    first[content] = here
                    here, other = other, here
                if here[:2] > other[:2]:
                    rows.append((None, here[0], here[2], here[1], here[1] + window, None))
                else:
                    rows.append((_route(content, window), here[0], here[2], here[1], here[1] + window, content))
            rest = wanted[~known]
            if len(rest):
                # windows over the same anchor, one after another, are one piece
                cut = np.flatnonzero((np.diff(rest) != 1) | (np.diff(at[rest]) != 0)) + 1
                low, high = rest[np.append(0, cut)], rest[np.append(cut - 1, -1)] + window
                runs = (x.tolist() for x in (own[low], low, high, starts[low], ends[high - 1]))
                d, k = int(doc[i]), int(key[i])
                rows += [(to, d, k, a, b, b" ".join(raw[x:y].split())) for to, a, b, x, y in zip(*runs)]
        for spans in again:
            rows += [(None, d, k, a, b, None) for d, k, a, b in zip(*(x.tolist() for x in spans))]
        yield _piece_batch(rows)
        if len(first) > FIRSTS:
            yield from firsts()
            first.clear()
    yield from firsts()


def _merged(doc: np.ndarray, key: np.ndarray, start: np.ndarray, window: int) -> list[np.ndarray]:
    """Windows to the spans they cover: doc, key, start, stop."""
    order = np.lexsort((start, key, doc))
    doc, key, start = doc[order], key[order], start[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (start[1:] > start[:-1] + window)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return [doc[first], key[first], start[first], start[last] + window]


def _located(pieces: list[tuple[int, int, int, list[bytes]]], window: int) -> list[np.ndarray] | None:
    """Spans of all windows that aren't the first with their words."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    length = np.array([len(words) for *_, words in pieces])
    each = itertools.chain.from_iterable(words for *_, words in pieces)
    flat = np.fromiter(map(numbers.__getitem__, each), dtype=_SIGNED, count=int(length.sum()))
    end = np.cumsum(length)
    piece = np.repeat(np.arange(len(pieces)), length)
    whole = np.flatnonzero(np.arange(len(flat)) + window <= end[piece])
    hashes = shingle_hashes(mix(flat.astype(np.uint64)), window)[whole]
    _, first, count = np.unique(hashes, return_index=True, return_counts=True)
    phrases = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for n, s in enumerate(whole[first[count > 1]].tolist()):
        phrases.add_word(tuple(flat[s:s + window].tolist()), n)
    if not len(phrases):
        return None
    phrases.make_automaton()
    # one stream; a number that no phrase has keeps pieces apart
    apart = np.insert(flat, end[:-1], len(numbers))
    hits = np.array(list(phrases.iter(tuple(apart.tolist()))), dtype=_SIGNED).reshape(-1, 2)
    at, phrase = hits[:, 0] - window + 1, hits[:, 1]
    of = np.searchsorted(end + np.arange(len(pieces)), at, side="right")
    doc, key, start = (np.array([x[i] for x in pieces], dtype=_SIGNED)[of] for i in range(3))
    start = start + at - (end - length + np.arange(len(pieces)))[of]
    order = np.lexsort((start, doc, phrase))
    doc, key, start, phrase = doc[order], key[order], start[order], phrase[order]
    new = np.ones(len(phrase), dtype=bool)
    new[1:] = phrase[1:] != phrase[:-1]
    least = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[least]) | (start != start[least])
    return _merged(doc[later], key[later], start[later], window)


SPANS = "doc long, key long, start long, stop long"


def _spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by route to spans that are removed; those without text are spans already. Of equal pieces of one
    window the first place is held, the others are spans at once."""
    held, words, route = [], 0, None
    single: dict[bytes, int] = {}

    def done(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "key", "start", "stop"])

    def searched():
        found = _located(held, window) if held else None
        return [done(found)] if found else []

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        ready = []
        for to, doc, key, start, stop, text in zip(*columns):
            if text is None:
                ready.append((doc, key, start, stop))
                continue
            if to != route:
                single.clear()
                if words > BLOCK:
                    yield from searched()
                    held, words = [], 0
            route = to
            if stop - start == window:
                at = single.setdefault(text, len(held))
                if at < len(held):
                    here, other = (doc, start), (held[at][0], held[at][2])
                    if here > other:
                        ready.append((doc, key, start, stop))
                        continue
                    if here < other:
                        ready.append((*held[at][:3], held[at][2] + window))
                        held[at] = (doc, key, start, held[at][3])
                        continue
            held.append((doc, key, start, text.split(b" ")))
            words += len(held[-1][3])
        if ready:
            yield done(zip(*ready))
    yield from searched()


def _cut(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """(doc, text, all, spans) to doc, n_words, n_removed and the kept words joined by a space; null for null."""
    for batch in batches:
        n, removed, kept = [], [], []
        whole, spans = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for text, all_, cut in zip(texts_as_bytes(batch.column(1)), whole, spans):
            words = text.tobytes().split() if text is not None else []
            n.append(len(words))
            if all_:
                words = []
            elif cut:
                out, at = [], 0
                for start, stop in sorted((x["start"], x["stop"]) for x in cut):
                    out += words[at:start]
                    at = max(at, stop)
                words = out + words[at:]
            removed.append(n[-1] - len(words))
            kept.append(b" ".join(words) if text is not None else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=names)


def place(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and text (the kept words, joined by a space) of each document."""
    given = docs.select(
        place(F.col(doc_id)).alias("doc"), F.xxhash64(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"))
    described = cut_lineage(given.mapInArrow(
        lambda x: _describe(x, window), "doc long, key long, n long, a long, b long, anchor long, count long"))
    counts = described.where("anchor is not null").groupBy("anchor").agg(F.sum("count").alias("count"))
    known = counts.orderBy(F.desc("count"), "anchor").limit(KNOWN).select("anchor").toArrow()
    frequent = docs.sparkSession.sparkContext.broadcast(np.sort(known.column(0).to_numpy().astype(_SIGNED)))

    long = described.where(f"anchor is null and n >= {window}").select("doc", "key", "n", "a", "b")
    classes = long.groupBy("n", "a", "b").agg(F.min("doc").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    copies = long.join(classes, ["n", "a", "b"]).where("doc > least").select("doc", "key").distinct()
    copies = small_side(copies.withColumnsRenamed({"doc": "copy", "key": "copy_key"}), NARROW)
    at = (F.col("doc") == F.col("copy")) & (F.col("key") == F.col("copy_key"))
    unique = given.join(copies, at, "left_anti")

    sent = unique.mapInArrow(lambda x: _sent(x, window, frequent.value), "anchor long, doc long, key long, known boolean")
    sent = sent.repartition(F.when(F.col("known"), F.xxhash64("anchor", "doc")).otherwise(F.col("anchor")))
    again = sent.sortWithinPartitions("known", "anchor").mapInArrow(_recurring, "anchor long, doc long, key long, hot boolean")
    again = cut_lineage(again.groupBy("doc", "key").agg(
        F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot")))
    numbers = again.agg(F.sum(F.size("anchors") + F.size("hot"))).first()[0] or 0
    again = again.withColumnsRenamed({"doc": "of", "key": "of_key"})
    again = F.broadcast(again) if numbers <= NARROW else again
    # rows that repeat id and text are one place
    found = unique.join(again, (F.col("doc") == F.col("of")) & (F.col("key") == F.col("of_key")))
    pieces = found.select("doc", "key", "text", "anchors", "hot").mapInArrow(lambda x: _pieces(x, window), PIECES)
    pieces = pieces.repartition(F.coalesce("route", F.xxhash64("doc", "start"))).sortWithinPartitions("route")
    spans = pieces.mapInArrow(lambda x: _spans(x, window), SPANS)

    cut = cut_lineage(spans.groupBy("doc", "key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    numbers = cut.agg(F.sum(F.size("spans"))).first()[0] or 0
    cut = cut.withColumnsRenamed({"doc": "of", "key": "of_key"})
    cut = F.broadcast(cut) if numbers <= NARROW else cut
    rows = docs.select(
        F.col(doc_id).alias("id"), place(F.col(doc_id)).alias("doc"), F.xxhash64(F.col(text)).alias("key"),
        F.col(text).cast("string").alias("text"))
    rows = rows.join(copies, at, "left").join(cut, (F.col("doc") == F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    rows = rows.select("id", "text", F.col("copy").isNotNull().alias("whole"), "spans")
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "n_words", "n_removed", "text"]
    return rows.mapInArrow(lambda x: _cut(x, names), f"doc_id {kind}, n_words long, n_removed long, text string")

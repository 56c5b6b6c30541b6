"""N-gram Jaccard join: which documents are linked, directly or through others, by similar n-gram sets.

Two documents link when their sets of n-word shingles have `num`/`den` of their union in common, or more.
The answer is exact but for 64-bit hashes of shingles.

1. Classes. One pass over the texts hashes the sets; equal sets are one class. The same pass counts
   tokens block by block and reports the frequent ones.
2. Order. All tokens have one order: by hash, but those that are frequent anywhere come last, by how
   frequent they are. Any order is right; this one keeps common passages out of the prefixes.
3. Prefixes. Linked sets share k tokens (or all they need) of the first size - needed + k ones; k is SHARED
   and one more for each SPARE tokens, so that a passage in common makes no pair of long texts. A
   second pass sends these as (token, size, class). A task sends a class once, so copies don't pile up.
4. Candidates. Tokens of at most PAIRED classes give pairs of fitting sizes, and pairs need k of
   them. Other tokens, and the frequent ones, don't meet in one task at all: the token is a vertex
   that each of its classes is joined to. Components of that graph are clusters; linked sets are in
   one cluster.
5. Clusters above CHUNK tokens are formed anew. The tokens of their sets are counted exactly and ordered by
   these counts, so texts that only have common tokens in common part, however many tokens are common. A token that a
   task sees in more than PAIRED sets is sent on by token and set; only one row of each task tells the others.
6. Prefix tree. The sets of a cluster are stored in a trie and joined by traversal. A cluster above
   CHUNK tokens is cut by size, so that linked sets are in one class of sizes or in neighbouring ones, and a class
   above CHUNK tokens is dealt into chunks; each pair of chunks that may hold links is joined by itself.
7. `linked_components` gives each document the least id it is connected with. For that a traversal leaves
   out what is connected already, so a task returns at most one link a set. `links` returns every link
   between different sets, in parts, and `link_counts` adds them up within the blocks, so that
   only a row for each set and block leaves a task.

Null, empty and blank texts have no shingles and are linked with nothing. A text with fewer words
than n is one shingle. Equal texts are linked. Rows that repeat an id are judged each by its own
text. Null ids are the last; a component that only has null ids is null. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StructField, StructType, VariantType

from shoreline.llm import trie
from shoreline.llm.graph import components
from shoreline.llm.text import fresh, small_side
from shoreline.llm.words import freed, give_back, hash_words, mix, shingle_hashes, texts_as_bytes
from shoreline.session import cut_lineage

#: Tokens of prefixes that linked sets share: SHARED and a SPARE-th of the smaller set.
SHARED, SPARE = 3, 20
#: Classes of a token that are paired; above, the token is a vertex.
PAIRED = 128
#: Tokens of one chunk of a cluster, 8 bytes each.
CHUNK = 500_000
#: Tokens that a task looks through at a time for those in more than PAIRED sets.
LOOKED = 1_000_000
#: Tokens are counted in blocks of about so many words; those found LEAST times in one are frequent.
BLOCK_WORDS, LEAST = 2_000_000, 3
#: Bytes of a block from which on its join takes memory that is worth giving back.
LARGE = 1 << 20
#: Tokens that leave a task at a time.
SENT = 250_000
#: Blocks of sets that are broadcast, some 32 bytes each.
ENTRIES = 2_000_000
#: Frequent tokens that have a place in the order, 16 bytes each; the rest are ordered by hash.
ORDERED = 1_000_000

_SIGNED = np.int64


def distinct(values: np.ndarray) -> np.ndarray:
    out = np.sort(values)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


def shingle_set(text: np.ndarray | None, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    if text is None:
        return np.zeros(0, dtype=np.uint64)
    return distinct(shingle_hashes(hash_words(text, fold=True), n))


def _class_of(shingles: np.ndarray) -> tuple[int, int]:
    total = np.add.reduce(mix(shingles))
    bits = np.bitwise_xor.reduce(mix(shingles + np.uint64(77)))
    return tuple(int(x) for x in mix(np.array([total ^ np.uint64(len(shingles)), bits])).view(_SIGNED))


def _frequent(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that are in LEAST sets or more, and in how many. Sorted in place, so that a block is held twice at most."""
    tokens = np.concatenate([np.zeros(0, np.uint64), *sets])
    tokens.sort()
    often = np.flatnonzero(tokens[LEAST - 1:] == tokens[:len(tokens) - LEAST + 1])
    found = distinct(tokens[often])
    count = np.searchsorted(tokens, found, side="right") - np.searchsorted(tokens, found, side="left")
    return found.view(_SIGNED), count.astype(_SIGNED)


def _describe(batches: Iterator[pa.RecordBatch], n: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, words = [], 0

    def reported(sets):
        tokens, count = _frequent(sets)
        nulls = pa.nulls(len(tokens))
        columns = [nulls.cast(schema.field(0).type), *[nulls.cast(pa.int64())] * 4, pa.array(tokens), pa.array(count)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        size, own, check = [], [], []
        for text in texts_as_bytes(batch.column(1)):
            shingles = shingle_set(text, n)
            a, b = _class_of(shingles)
            size.append(len(shingles)), own.append(a), check.append(b)
            held.append(shingles)
            words += len(shingles)
            if words > BLOCK_WORDS:
                yield reported(held)
                held, words = [], 0
        none = pa.nulls(batch.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(schema.field(0).type), batch.column(2), pa.array(size, pa.int64()), pa.array(own, pa.int64()), pa.array(check, pa.int64()), none, none],
            schema=schema)
    if held:
        yield reported(held)


def prefix(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of a set, and which of them are frequent. frequent: hashes in order, and each one's rank."""
    size = len(shingles)
    length = min(size, size - -(-num * size // den) + SHARED + size // SPARE)
    hashes, rank = frequent
    at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
    late = hashes[at] == shingles if len(hashes) else np.zeros(size, dtype=bool)
    rare = shingles[~late][:length]
    common = shingles[late][np.argsort(rank[at[late]])[:length - len(rare)]]
    return np.concatenate([rare, common]), np.arange(length) >= len(rare)


PREFIXES = "token long, size long, class long, frequent boolean"


def _prefixes(batches: Iterator[pa.RecordBatch], n: int, frequent: tuple[np.ndarray, np.ndarray], num: int, den: int) -> Iterator[pa.RecordBatch]:
    sent, rows, held = set(), [], 0

    def packed() -> pa.RecordBatch:
        token, size, own, late = (np.concatenate(x) for x in zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(token.view(_SIGNED)), pa.array(size.astype(_SIGNED)), pa.array(own.astype(_SIGNED)), pa.array(late)],
            names=["token", "size", "class", "frequent"])

    for batch in batches:
        for text in texts_as_bytes(batch.column(0)):
            shingles = shingle_set(text, n)
            if not len(shingles):
                continue
            own = _class_of(shingles)[0]
            if own in sent:
                continue
            sent.add(own)
            tokens, late = prefix(shingles, frequent, num, den)
            rows.append((tokens, np.full(len(tokens), len(shingles)), np.full(len(tokens), own), late))
            held += len(tokens)
            if held > SENT:
                yield packed()
                rows, held = [], 0
    if rows:
        yield packed()


#: enough: how many such rows make an edge.
CANDIDATES = "a long, b long, enough long"


def _candidates(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by frequent, token, size and class to edges of classes or of class and token."""
    kept = np.zeros((3, 0), dtype=_SIGNED)
    large = None

    def edges(a, b, enough):
        return pa.RecordBatch.from_arrays([pa.array(x.astype(_SIGNED)) for x in (a, b, enough)], names=["a", "b", "enough"])

    def vertex(rows):
        return mix(rows[0].view(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5)).view(_SIGNED)

    def starred(rows):
        return edges(rows[2], vertex(rows), np.ones(rows.shape[1]))

    def settled(rows):
        if not rows.shape[1]:
            return
        first = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
        group = np.cumsum(first) - 1
        count = np.bincount(group)[group]
        many = count > PAIRED
        if many.any():
            yield starred(rows[:, many])
        some = (count > 1) & ~many
        rows, group = rows[:, some], group[some]
        for step in range(1, int(count[some].max()) if some.any() else 0):
            at = np.flatnonzero(group[step:] == group[:-step])
            at = at[rows[1, at] * den >= rows[1, at + step] * num]
            if len(at):
                small, big, one, two = rows[1, at], rows[1, at + step], rows[2, at], rows[2, at + step]
                enough = np.minimum(SHARED + small // SPARE, -(-num * (small + big) // (num + den)))
                yield edges(np.minimum(one, two), np.maximum(one, two), enough)

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy().astype(_SIGNED) for i in range(3)])
        late = batch.column(3).to_numpy(zero_copy_only=False)
        if late.any():
            yield starred(rows[:, late])
            rows = rows[:, ~late]
        rows = np.concatenate([kept, rows], axis=1)
        if rows.shape[1] > 1:
            rows = rows[:, np.concatenate([[True], (rows[0, 1:] != rows[0, :-1]) | (rows[2, 1:] != rows[2, :-1])])]
        if large is not None:
            more = rows[0] == large
            if more.any():
                yield starred(rows[:, more])
                rows = rows[:, ~more]
        open_ = rows[0] == rows[0, -1] if rows.shape[1] else np.zeros(0, dtype=bool)
        yield from settled(rows[:, ~open_])
        kept = rows[:, open_]
        if kept.shape[1] > PAIRED:
            large = kept[0, 0]
            yield starred(kept)
            kept = kept[:, :0]
    yield from settled(kept)


TOKENS = "token long, class long, size long, spread boolean"


def _all_tokens(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(text, class) to all tokens of each class once. Tokens in more than PAIRED sets are spread: their rows need
    not meet, and a row without a class stands for them."""
    sent, held, words = set(), [], 0

    def packed() -> pa.RecordBatch:
        size = np.array([len(s) for _, s in held])
        token = np.concatenate([s for _, s in held])
        own, size = (np.repeat(np.array(x, dtype=_SIGNED), size) for x in ([c for c, _ in held], size))
        found, count = np.unique(token, return_counts=True)
        hot = found[count > PAIRED]
        spread = np.concatenate([np.isin(token, hot), np.zeros(len(hot), dtype=bool)])
        token, size = np.concatenate([token, hot]), np.concatenate([size, np.zeros(len(hot), dtype=_SIGNED)])
        own = pa.chunked_array([pa.array(own), pa.nulls(len(hot), pa.int64())]).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pa.array(token.view(_SIGNED)), own, pa.array(size), pa.array(spread)], names=["token", "class", "size", "spread"])

    for batch in batches:
        for text, c in zip(texts_as_bytes(batch.column(0)), batch.column(1).to_pylist()):
            shingles = shingle_set(None if c in sent else text, n)
            if not len(shingles) or _class_of(shingles)[0] != c:
                continue
            sent.add(c)
            held.append((c, shingles))
            words += len(shingles)
            if words > LOOKED:
                yield packed()
                held, words = [], 0
    if held:
        yield packed()


#: place: in how many sets the token is, PAIRED + 1 for more. Tokens of one set only come as their number.
COUNTED = "class long, size long, token long, place long, single long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by spread, token and class, nulls first, to the place of each token of each class."""
    kept = np.zeros((4, 0), dtype=_SIGNED)
    large = None

    def placed(rows, place):
        one = place == 1
        own, first, count = np.unique(rows[1, one], return_index=True, return_counts=True)
        zeros = np.zeros(int((~one).sum()), dtype=_SIGNED)
        columns = [np.concatenate([rows[1, ~one], own]), np.concatenate([rows[2, ~one], rows[2, one][first]])]
        token = pa.chunked_array([pa.array(rows[0, ~one]), pa.nulls(len(own), pa.int64())]).combine_chunks()
        columns += [token, np.concatenate([place[~one], np.ones(len(own), dtype=_SIGNED)]), np.concatenate([zeros, count])]
        names = ["class", "size", "token", "place", "single"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def beyond(rows):
        rows = rows[:, rows[3] == 1]
        return placed(rows, np.full(rows.shape[1], PAIRED + 1))

    def settled(rows):
        first = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
        group = np.cumsum(first) - 1
        named = rows[3] == 1
        place = np.bincount(group)[group]
        # a token that some task has spread has a nameless row in front
        place = np.where(~named[first][group], PAIRED + 1, np.minimum(place, PAIRED + 1))
        return placed(rows[:, named], place[named])

    for batch in batches:
        named = batch.column(1).is_valid().to_numpy(zero_copy_only=False).astype(_SIGNED)
        rows = np.stack([batch.column(i).fill_null(0).to_numpy().astype(_SIGNED) for i in range(3)] + [named])
        spread = batch.column(3).to_numpy(zero_copy_only=False)
        if spread.any():
            yield beyond(rows[:, spread])
            rows = rows[:, ~spread]
        rows = np.concatenate([kept, rows], axis=1)
        if rows.shape[1] > 1:
            rows = rows[:, np.concatenate([[True], (rows[[0, 1, 3], 1:] != rows[[0, 1, 3], :-1]).any(axis=0)])]
        if large is not None:
            more = rows[0] == large
            if more.any():
                yield beyond(rows[:, more])
                rows = rows[:, ~more]
        open_ = rows[0] == rows[0, -1] if rows.shape[1] else np.zeros(0, dtype=bool)
        if not open_.all():
            yield settled(rows[:, ~open_])
        kept = rows[:, open_]
        if kept.shape[1] > PAIRED + 1:
            large = kept[0, 0]
            yield beyond(kept)
            kept = kept[:, :0]
    if kept.shape[1]:
        yield settled(kept)


def _edges(prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """Prefix tokens (PREFIXES) to edges between classes, or between classes and tokens, that hold all links."""
    # a frequent token's classes need not meet
    rows = prefixes.repartition(F.when(F.col("frequent"), F.xxhash64("token", "class")).otherwise(F.col("token")))
    rows = rows.sortWithinPartitions("frequent", "token", "size", "class")
    edges = rows.mapInArrow(lambda x: freed(_candidates(x, num, den)), CANDIDATES)
    return edges.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("enough").alias("enough")).where("n >= enough")


def _formed_anew(given: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The members, those of clusters above CHUNK tokens in smaller clusters where their tokens' exact counts allow it."""
    total = members.groupBy("component").agg(F.sum("size").alias("all")).where(f"all > {CHUNK}").select("component")
    total = cut_lineage(total)
    if total.isEmpty():
        return members
    large = small_side(members.join(total, "component").select("class", "at"))
    texts = given.withColumn("at", F.xxhash64("doc", "key")).join(large, "at").select("text", "class")
    rows = texts.mapInArrow(lambda x: freed(_all_tokens(x, n)), TOKENS)
    rows = rows.repartition(F.when(F.col("spread"), F.xxhash64("token", "class")).otherwise(F.col("token")))
    rows = rows.sortWithinPartitions("spread", "token", F.col("class").asc_nulls_first()).mapInArrow(lambda x: freed(_counted(x)), COUNTED)
    # one row of a text's tokens at most, as its own set has them
    sets = rows.groupBy("class", "size").agg(
        F.sum("single").alias("single"), F.array_sort(F.collect_set(F.when(F.col("token").isNotNull(), F.struct("place", "token")))).alias("more"))
    length = f"least(size, size - ({num} * size + {den} - 1) div {den} + {SHARED} + size div {SPARE})"
    sets = sets.withColumn("to", F.explode(F.expr(f"slice(more, 1, cast(greatest(0, {length} - single) as int))")))
    prefixes = sets.select("to.token", "size", "class", (F.col("to.place") > PAIRED).alias("frequent"))
    clusters = components(_edges(prefixes, num, den)).withColumnRenamed("component", "smaller")
    again = members.join(total, "component", "left_semi").drop("component").join(clusters, F.col("class") == F.col("vertex"))
    again = again.select(F.col("smaller").alias("component"), "class", "at", "copies", "size")
    return cut_lineage(members.join(total, "component", "left_anti").unionByName(again))


#: side: the chunk of a pair of chunks, -1 where all sets are joined with one another.
BLOCKS = "array<struct<block: long, side: int>>"


def _blocks(members: DataFrame, num: int, den: int) -> DataFrame:
    """(component, class, at, copies, size) to class, at, copies and the blocks in which the set is joined."""
    # a little wide, so that rounding can't part neighbours
    step = F.floor(F.log(F.col("size").cast("double")) / (math.log(den / num) + 1e-9))
    totals = members.groupBy("component").agg(F.sum("size").alias("all"), F.count("*").alias("sets"))
    members = members.join(totals.where("sets > 1"), "component")
    whole = members.where(f"all <= {CHUNK}")
    whole = whole.select("class", "at", "copies", F.col("component").alias("block"), F.lit(-1).alias("side"))

    large = members.where(f"all > {CHUNK}").withColumn("step", step)
    steps = large.groupBy("component", "step").agg(F.ceil(F.sum("size") / CHUNK).cast("long").alias("chunks"))
    large = large.join(steps, ["component", "step"]).withColumn("chunk", F.pmod("class", "chunks"))
    chunks = steps.select("component", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    one, two = (chunks.select("component", F.struct("step", "chunk").alias(c)) for c in ("one", "two"))
    near = (F.col("two.step") - F.col("one.step")).isin(0, 1) & (F.col("one") <= F.col("two"))
    pairs = one.join(two, "component").where(near).withColumn("block", F.xxhash64("component", "one", "two"))
    alone = F.array(F.struct(F.col("one").alias("at"), F.lit(-1).alias("side")))
    both = F.array(*[F.struct(F.col(c).alias("at"), F.lit(i).alias("side")) for i, c in enumerate(("one", "two"))])
    pairs = pairs.select("component", "block", F.explode(F.when(F.col("one") == F.col("two"), alone).otherwise(both)).alias("x"))
    pairs = pairs.select("component", "block", "x.at.step", "x.at.chunk", "x.side")
    cut = large.join(pairs, ["component", "step", "chunk"]).select("class", "at", "copies", "block", "side")
    return whole.unionByName(cut).groupBy("class", "at", "copies").agg(F.collect_list(F.struct("block", "side")).alias("blocks"))


def _narrow(blocks: DataFrame) -> DataFrame:
    """Broadcast if the entries of the arrays allow; few rows can have many."""
    blocks = cut_lineage(blocks)
    entries = blocks.agg(F.sum(F.size("blocks"))).first()[0] or 0
    return F.broadcast(blocks) if entries <= ENTRIES else blocks


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(text, class, copies, blocks) to (class, copies, blocks, shingles), a class once. Sets leave in parts of
    about SENT tokens, however many texts come at a time."""
    sent = set()
    for batch in batches:
        sets, rows, held = [], [], 0

        def packed(batch=batch):
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(_SIGNED))
            own = batch.select(["class", "copies", "blocks"]).take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays(
                [*own.columns, pa.ListArray.from_arrays(pa.array(ends), values)], names=["class", "copies", "blocks", "shingles"])

        for i, (text, c) in enumerate(zip(texts_as_bytes(batch.column(0)), batch.column(1).to_pylist())):
            shingles = shingle_set(None if c in sent else text, n)
            if not len(shingles) or _class_of(shingles)[0] != c:
                continue
            sent.add(c)
            sets.append(shingles), rows.append(i)
            held += len(shingles)
            if held > SENT:
                yield packed()
                sets, rows, held = [], [], 0
        if sets:
            yield packed()


def _of_block(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray | None]:
    """The classes of a block, how many rows each one has, their sets, and the sides if there are two."""
    own, at = np.unique(group.column("class").to_numpy(), return_index=True)
    group = group.take(pa.array(at)).combine_chunks()
    shingles = group.column("shingles").chunk(0)
    ends, values = shingles.offsets.to_numpy(), shingles.values.to_numpy().view(np.uint64)
    sides = group.column("side").to_numpy()
    sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return own, group.column("copies").to_numpy(), sets, sides if sides.max() >= 0 else None


def _linked(group: pa.Table, num: int, den: int) -> pa.Table:
    """Links of one block that connect all that are linked."""
    own, _, sets, sides = _of_block(group)
    found = trie.join(sets, num, den, sides)
    a, b = (np.array([own[x[i]] for x in found], dtype=_SIGNED) for i in (0, 1))
    return pa.table({"a": a, "b": b})


def _every_link(group: pa.Table, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """All links of one block, in parts."""
    own, _, sets, sides = _of_block(group)
    rows, held = [], 0

    def packed() -> pa.RecordBatch:
        a, b = (np.concatenate(x).astype(_SIGNED) for x in zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for i, others in trie.every(sets, num, den, sides):
        rows.append((np.full(len(others), own[i]), own[others]))
        held += len(others)
        if held > SENT:
            yield packed()
            rows, held = [], 0
    if rows:
        yield packed()


def _link_sums(group: pa.Table, num: int, den: int) -> pa.Table:
    """For each class with links in one block, how many rows it is linked with there."""
    own, copies, sets, sides = _of_block(group)
    total = np.zeros(len(own), dtype=_SIGNED)
    for i, others in trie.every(sets, num, den, sides):
        total[i] += copies[others].sum()
        total[others] += copies[i]
    some = total > 0
    return pa.table({"class": own[some], "n": total[some]})


def _joined(group: pa.Table, join: Callable[[pa.Table, int, int], pa.Table], num: int, den: int) -> pa.Table:
    """One block by `join`. After a large one the worker gives memory back."""
    out = join(group, num, den)
    if group.nbytes > LARGE:
        give_back()
    return out


CLASS = ["size", "class", "check"]


def _dealt(docs: DataFrame, doc_id: str, text: str, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (doc, key of the text, class), their classes (first, copies), and the sets dealt to blocks."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    given = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    longs = [StructField(c, LongType()) for c in ("key", *CLASS, "token", "count")]
    schema = StructType([StructField("doc", kind), *longs])
    arrow = pa.schema([("doc", _arrow_type(kind)), *[(c.name, pa.int64()) for c in longs]])
    described = cut_lineage(given.select("doc", "text", "key").mapInArrow(lambda x: freed(_describe(x, n, arrow)), schema))
    signed = described.where(F.col("token").isNull()).select("doc", "key", *CLASS)

    counts = described.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("count").alias("n"))
    often = counts.orderBy(F.desc("n"), "token").limit(ORDERED).toArrow()
    tokens, seen = (often.column(i).to_numpy().astype(_SIGNED) for i in (0, 1))
    order = np.argsort(tokens.view(np.uint64))
    rank = np.argsort(np.argsort(seen[order], kind="stable"))
    shared = spark.sparkContext.broadcast((tokens.view(np.uint64)[order], rank))

    rows = given.select("text").mapInArrow(lambda x: freed(_prefixes(x, n, shared.value, num, den)), PREFIXES)
    clusters = components(_edges(rows, num, den))

    first = F.min(F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "key")).alias("first")
    classes = cut_lineage(signed.where("size > 0").groupBy(*CLASS).agg(first, F.count("*").alias("copies")))
    named = classes.withColumn("at", F.xxhash64("first.doc", "first.key"))
    members = cut_lineage(clusters.join(named, F.col("vertex") == F.col("class")).select("component", "class", "at", "copies", "size"))
    members = _formed_anew(given, members, n, num, den)
    blocks = _narrow(_blocks(members, num, den))
    found = given.withColumn("at", F.xxhash64("doc", "key")).join(blocks, "at").select("text", "class", "copies", "blocks")
    sets = found.mapInArrow(lambda x: freed(_sets(x, n)), f"class long, copies long, blocks {BLOCKS}, shingles array<long>")
    return signed, classes, sets.withColumn("to", F.explode("blocks")).select("to.block", "to.side", "class", "copies", "shingles")


def _components(docs: DataFrame, doc_id: str, text: str, n: int, num: int, den: int) -> DataFrame:
    """doc, key, size, and the first (unnamed, doc, key) of its component, null without shingles."""
    signed, classes, dealt = _dealt(docs, doc_id, text, n, num, den)
    links = dealt.groupBy("block").applyInArrow(lambda x: _joined(x, _linked, num, den), "a long, b long")
    connected = components(links)
    named = classes.join(connected, F.col("class") == F.col("vertex"), "left").withColumn("group", F.coalesce("component", "class"))
    named = cut_lineage(named.select(*CLASS, "group", "first"))
    least = named.groupBy("group").agg(F.min("first").alias("least"))
    return signed.join(named.join(least, "group").select(*CLASS, "least"), CLASS, "left").select("doc", "key", "size", "least")


def linked_components(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 3, num: int = 90, den: int = 100
) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id connected with it) for each document."""
    found = _components(docs, doc_id, text, n, num, den)
    return found.select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("least.doc", "doc").alias("component_id"))


def links(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 3, num: int = 90, den: int = 100
) -> DataFrame:
    """Every link between different shingle sets, once: a and b, the least ids with these sets, and a_key and
    b_key, the xxhash64 of the text that has it. Their number can be the square of a group's; equal sets are one."""
    _, classes, dealt = _dealt(docs, doc_id, text, n, num, den)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _every_link(pa.Table.from_batches(list(batches)), num, den)

    out = dealt.groupBy("block").applyInArrow(found, "a long, b long")
    for c in ("a", "b"):
        side = classes.select(F.col("class").alias(c), F.col("first").alias(f"{c}_first"))
        out = out.join(side, c).drop(c)
    low, high = (f("a_first", "b_first") for f in (F.least, F.greatest))
    out = out.select(low.alias("low"), high.alias("high"))
    return out.select(
        F.col("low.doc").alias("a"), F.col("low.key").alias("a_key"), F.col("high.doc").alias("b"), F.col("high.key").alias("b_key"))


def link_counts(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 3, num: int = 90, den: int = 100
) -> DataFrame:
    """doc_id, n_shingles, n_links (how many other documents it is linked with) for each document."""
    signed, classes, dealt = _dealt(docs, doc_id, text, n, num, den)
    sums = dealt.groupBy("block").applyInArrow(lambda x: _joined(x, _link_sums, num, den), "class long, n long")
    sums = sums.groupBy("class").agg(F.sum("n").alias("n"))
    linked = classes.join(sums, "class", "left").select(*CLASS, (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    return signed.join(linked, CLASS, "left").select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The documents, with one row of each group of linked ones: that with the least id, null ids last. Rows
    are told apart by id and text, so that an unlinked text stays if its id is repeated."""
    found = _components(docs, doc_id, text, n, num, den).where("size > 0")
    least = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "key")
    found = cut_lineage(found.groupBy("doc", "key").agg(F.first(least == F.col("least")).alias("stays"), F.count("*").alias("rows")))
    doc, key, nth = fresh(docs, "_doc", "_key", "_nth")

    def named(rows: DataFrame) -> DataFrame:
        return small_side(rows.select(F.col("doc").alias(doc), F.col("key").alias(key)))

    here = docs[doc_id].eqNullSafe(F.col(doc)) & (F.xxhash64(docs[text].cast("string")) == F.col(key))
    out = docs.join(named(found.where("not stays")), here, "left_anti")
    again = found.where("stays and rows > 1")
    if again.isEmpty():
        return out
    here = out[doc_id].eqNullSafe(F.col(doc)) & (F.xxhash64(out[text].cast("string")) == F.col(key))
    twice = named(again)
    rest, some = (out.join(twice, here, how) for how in ("left_anti", "left_semi"))
    # only the first is asked for, so a task sends one row of each key at most
    plain = [c.name for c in docs.schema if not isinstance(c.dataType, (ArrayType, MapType, StructType, VariantType))]
    order = Window.partitionBy(doc_id, F.xxhash64(F.col(text).cast("string"))).orderBy(F.xxhash64(*plain))
    return rest.unionByName(some.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(nth))

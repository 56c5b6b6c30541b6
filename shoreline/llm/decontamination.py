"""Benchmark decontamination.

Benchmark texts and documents are cut into the same words after A-Z became a-z. The n-word
windows of the benchmark are a set of 64-bit hashes, which is broadcast. Documents are cut into blocks of
words, so that only the windows of one block are in memory at a time; one scan looks up the windows of all
lengths. Only windows with a known hash leave it, and these are verified by their words. Overlapping
windows of one document are merged in position order and count each word once.

A window that occurs stands for its set of items, by number. Items are looked up afterwards, once for each
distinct combination of such sets: a prompt that many items share is one number in every hit.

Beyond BROADCAST_BYTES, by what the rows hold, a shuffle join takes the place of a broadcast, with the same result.

Null and empty texts have no words, no hits and are clean. An item shorter than the window
is one window of its own length; one without words is none. Very long texts are judged whole. Rows that
repeat an id are judged each by its own text; equal rows are judged once and given back as often as they came.
Other columns pass through `decontaminate`, whatever their names. Empty tables give an empty
result, or only clean documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.text import fold_ascii, fresh, let, small_side
from shoreline.session import cut_lineage

WINDOW = 13
#: What the rows of a broadcast side may hold, with OVERHEAD for each row.
BROADCAST_BYTES = 128 << 20
OVERHEAD = 64
#: Windows that begin in a block of a document.
BLOCK = 512
#: What separates words: all of ASCII but digits and a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(fold_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def windows(cut: Column, length: int, most: Column | int = BLOCK) -> Column:
    """The runs of `length` words, joined by one space, that begin at the first `most` words; start, h and window."""
    def all_windows(w: Column) -> Column:
        def one(i: Column) -> Column:
            # words hold no space, so a window's text also tells its length
            text = F.array_join(F.slice(w, i + 1, length), " ")
            return let(text, lambda t: F.struct(i.alias("start"), F.xxhash64(t).alias("h"), t.alias("window")))
        return F.when(F.size(w) >= length, F.transform(F.sequence(F.lit(0), F.least(F.size(w) - length, F.lit(most) - 1)), one)).otherwise(
            F.array().cast("array<struct<start:int,h:bigint,window:string>>"))

    return let(cut, all_windows)


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """window, h, length and the distinct sorted items of each distinct window."""
    cut = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    long = cut.where(F.size("w") >= window).select("item", F.explode(windows(F.col("w"), window, F.size("w"))).alias("x"))
    each = long.select("item", "x.window", F.lit(window).alias("length")).unionByName(
        cut.where(F.size("w") < window).select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("length")))
    each = each.groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return each.select("window", F.xxhash64("window").alias("h"), "length", "items")


def _bounded(df: DataFrame, held: Column | None = None) -> DataFrame:
    """A materialised frame, to be broadcast if its rows hold few enough bytes."""
    size = F.lit(OVERHEAD) if held is None else held + OVERHEAD
    total = df.agg(F.sum(size).alias("bytes")).first().bytes or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def hits(docs: DataFrame, found: DataFrame, lengths: list[int], doc_id: str, text: str) -> DataFrame:
    """A row for each occurrence of a benchmark window (doc, key, n_words, start, length,
    items_no), and one without start for each document. key tells texts of one id apart.
    `found` is materialised and holds window, h, length and items_no."""
    cut = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("key"), words(F.col(text)).alias("w")
    ).withColumn("n_words", F.size("w").cast("long"))
    at = ["doc", "key", "n_words"]
    found_nothing = [F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("length"), F.lit(None).cast("long").alias("items_no")]
    if not lengths:
        return cut.select(*at, *found_nothing)
    n, longest = F.size("w"), max(lengths)
    begins = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK))
    blocks = let(F.col("w"), lambda w: F.transform(begins, lambda i: F.slice(w, i + 1, BLOCK + longest - 1)))
    block = cut.select(*at, F.posexplode(blocks).alias("nth", "w"))
    each = F.concat(*[windows(F.col("w"), length) for length in lengths])
    hashes = found.select("h").distinct()
    mark = F.struct(F.lit(None).cast("int").alias("start"), F.lit(0).cast("long").alias("h"), F.lit(None).cast("string").alias("window"))
    small = (hashes.count() + 1) * OVERHEAD <= BROADCAST_BYTES
    if small:
        # each document's own row comes out of the same scan
        each = F.when(F.col("nth") == 0, F.array_append(each, mark)).otherwise(each)
        hashes = F.broadcast(hashes.union(found.sparkSession.range(1).select(F.lit(0).cast("long"))))
    rows = block.select(*at, "nth", F.explode(each).alias("x")).select(*at, "nth", "x.*").join(hashes, "h", "left_semi")
    known = cut_lineage(rows.select(*at, (F.col("nth") * BLOCK + F.col("start")).alias("start"), "window"))
    verified = known.where(F.col("start").isNotNull()).join(
        _bounded(found.select("window", "length", "items_no"), F.octet_length("window")), "window")
    whole = known.where(F.col("start").isNull()) if small else cut
    return verified.select(*at, "start", "length", "items_no").unionByName(whole.select(*at, *found_nothing))


def _judged(docs, benchmark, doc_id, text, item_id, item_text, window, share) -> tuple[DataFrame, DataFrame]:
    """doc, key, n_words, n_hit, sets (numbers of item sets), copies, contaminated for each
    distinct document; and items_no, items."""
    found = cut_lineage(benchmark_windows(benchmark, item_id, item_text, window))
    # numbers of a checkpoint do not change when an executor is lost
    sets = cut_lineage(found.select("items").distinct().withColumn("items_no", F.monotonically_increasing_id()))
    numbered = cut_lineage(found.join(sets.select("items", "items_no"), "items").select("window", "h", "length", "items_no"))
    lengths = sorted(r.length for r in found.select("length").distinct().collect())
    rows = hits(docs, numbered, lengths, doc_id, text)
    rows = rows.groupBy("doc", "key", "n_words", "start", "length", "items_no").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("doc", "key").orderBy(F.col("start").asc_nulls_first(), "length")
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    merged = rows.withColumn("new", F.greatest(end - F.greatest("start", reached), F.lit(0)))
    out = merged.groupBy("doc", "key").agg(
        F.first("n_words").alias("n_words"),
        F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set("items_no")).alias("sets"),
        F.max(F.when(F.col("start").isNull(), F.col("copies"))).alias("copies"),
    )
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    return out, sets.select("items_no", "items")


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = SHARE,
) -> DataFrame:
    """doc_id, key (hash of the text), n_words, n_hit, items (sorted), contaminated, a row for each document.

    Contaminated: at least one word in `share` lies in an occurrence of a benchmark window.
    """
    judged, sets = _judged(docs, benchmark, doc_id, text, item_id, item_text, window, share)
    judged = cut_lineage(judged)
    hit = judged.where("n_hit > 0")
    combined = hit.select("sets").distinct().select("sets", F.explode("sets").alias("items_no"))
    combined = combined.join(_bounded(sets, F.octet_length(F.array_join("items", ","))), "items_no")
    combined = combined.select("sets", F.explode("items").alias("item")).groupBy("sets").agg(F.array_sort(F.collect_set("item")).alias("items"))
    combined = cut_lineage(combined)
    held = F.octet_length(F.array_join("items", ",")) + 8 * F.size("sets")
    out = hit.join(_bounded(combined, held), "sets").unionByName(
        judged.where("n_hit = 0").withColumn("items", F.array().cast("array<string>")))
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return out.withColumn("again", again).select(F.col("doc").alias("doc_id"), "key", "n_words", "n_hit", "items", "contaminated")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = SHARE,
) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    d, k = fresh(docs, "_doc", "_key")
    judged, _ = _judged(docs, benchmark, doc_id, text, item_id, item_text, window, share)
    bad = small_side(judged.where("contaminated").select(F.col("doc").alias(d), F.col("key").alias(k)))
    return docs.join(bad, docs[doc_id].eqNullSafe(F.col(d)) & (F.xxhash64(docs[text]) == F.col(k)), "left_anti")

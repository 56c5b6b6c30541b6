"""Language identification by compression.

For each language a bounded sample of labelled texts (SAMPLE of them, chosen by hash) is a raw-content
zstandard dictionary of at most about DICTIONARY bytes. Short texts are in it whole; of a longer one only the first DICTIONARY
characters are read, and its beginning is taken, an equal share of what the short ones leave. All languages
together send READ dictionaries each to the driver, however many texts are long. A text is
folded to lower-case words of letters, cut into pieces of PIECE bytes and compressed with each dictionary;
the language with the fewest bytes in total wins, the first in name order among equals. The score is the share
by which the winner is smaller than the next one; a score below MARGIN is a rejection.

A null text, and one without a letter, is `und` with score 0 and rejected. With one known
language the score is 1; with none everything is `und`. Rows that repeat are judged alike;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import fresh, small_side
from shoreline.session import cut_lineage

#: Labelled texts of a language that are learned at most, one for each bucket of a hash.
SAMPLE = 128
#: Bytes of a dictionary.
DICTIONARY = 112_000
#: Bytes that are compressed at a time.
PIECE = 4_096
LEVEL = 8
#: Characters of a language's texts that are folded for its dictionary, in dictionaries: folding leaves fewer.
READ = 4
MARGIN = 0.002
UNKNOWN = "und"


LETTER = regex.compile(r"\p{L}")
NO_LETTER = regex.compile(r"[^\p{L}]+")


def folded(text: str) -> bytes:
    return NO_LETTER.sub(" ", text.lower()).encode()


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def level(lengths: list[int], total: int) -> int:
    """The greatest length to which all can be cut so that they hold at most `total` together."""
    for nth, length in enumerate(sorted(lengths)):
        share = total // (len(lengths) - nth)
        if length > share:
            return share
        total -= length
    return max(lengths)


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language, from `docs`; at most READ * DICTIONARY characters each reach the driver."""
    labelled = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    own = F.xxhash64(F.col("id").cast("string"), F.lit(5))
    chosen = labelled.groupBy("lang", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(SAMPLE)).alias("bucket")).agg(
        F.min(F.struct(own.alias("order"), "id")).alias("x"))
    chosen = small_side(chosen.select(F.col("lang").alias("of"), "x.order", F.col("x.id").alias("of_id")))
    texts = labelled.join(chosen, (F.col("id") == F.col("of_id")) & (F.col("lang") == F.col("of")))
    texts = cut_lineage(texts.select("lang", "order", F.substring("text", 1, DICTIONARY).alias("text")).distinct())
    lengths: dict[str, list[int]] = {}
    for row in texts.select("lang", F.length("text").alias("length")).toLocalIterator():
        lengths.setdefault(row.lang, []).append(row.length)
    if not lengths:
        return {}
    most = texts.sparkSession.createDataFrame([(k, level(v, READ * DICTIONARY)) for k, v in lengths.items()], "lang string, most int")
    # one row a language
    texts = texts.join(F.broadcast(most), "lang")
    rows = texts.select("lang", "order", F.expr("substring(text, 1, most)").alias("text")).toLocalIterator()
    learned: dict[str, list[tuple[int, bytes]]] = {}
    for row in rows:
        learned.setdefault(row.lang, []).append((row.order, folded(row.text)))
    out = {}
    for name, parts in learned.items():
        # short texts stay whole; what they leave free is shared by the long ones
        left, content = DICTIONARY, []
        for nth, (_, part) in enumerate(sorted(parts, key=lambda p: (len(p[1]), p))):
            take = part[: left // (len(parts) - nth)]
            content.append(take)
            left -= len(take)
        out[name] = b"\n".join(content)
    return out


class Compressors:
    """One compressor for each language."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.by_name = {}
        for name in sorted(dictionaries):
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.by_name[name] = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)

    def judge(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.by_name or not LETTER.search(text):
            return UNKNOWN, 0.0
        data = memoryview(folded(text))
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = sorted((sum(len(c.compress(p)) for p in pieces), name) for name, c in self.by_name.items())
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]


def predicted(docs: DataFrame, dictionaries: dict[str, bytes], *, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("name string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(shared.value)
        for texts in batches:
            yield pd.DataFrame([compressors.judge(t) for t in texts], columns=["name", "score"])

    said, name, score, rejected = fresh(docs, "_said", "lang_pred", "score", "rejected")
    out = docs.withColumn(said, judge(F.col(f"`{text}`").cast("string")))
    return out.withColumns({
        name: F.col(f"{said}.name"), score: F.col(f"{said}.score"),
        rejected: (F.col(f"{said}.name") == UNKNOWN) | (F.col(f"{said}.score") < MARGIN),
    }).drop(said)


def identify(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the documents that aren't held out."""
    learned = train(docs.where(~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull()), doc_id=doc_id, text=text, lang=lang)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return predicted(rows, learned).drop("text")


def accepted(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language is told with enough margin, unchanged."""
    learned = train(docs.where(~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull()), doc_id=doc_id, text=text, lang=lang)
    rejected = fresh(docs, "_said", "lang_pred", "score", "rejected")[3]
    return predicted(docs, learned, text=text).where(~F.col(rejected)).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Fill-in-the-middle transformation.

A text is cut twice, at units chosen by a hash of its id, and written as prefix, suffix, middle or as suffix,
prefix, middle with a sentinel before each. The texts of a batch stand one after another in a wavelet matrix of
character classes; ranks of classes count the units of each text and bisection on them locates all cuts of the batch
together, so no text is decoded. Cuts never split a character. Units are characters, words (with the gap
after them), sentences (up to the mark) or lines.

`restored` rebuilds each text exactly from the output and its form, as long as no sentinel overlaps itself or another.

A null or empty text is plain with an empty output. A text that holds a sentinel is plain, so every output can be
taken apart. The form and both cuts follow from seed, id and the number of units: rows that repeat get the same.
A null id is hashed as the word null. Long texts are worked on whole; PART only bounds how many short ones share a
matrix. An empty table gives an empty result. Columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import fresh
from shoreline.llm.wavelet import WaveletMatrix, classes

#: Percent of the texts that are transformed, and of these that begin with the suffix.
RATE, SUFFIX_FIRST = 90, 20
SEED = 1
#: Bytes of text that share a matrix; a longer text has one of its own.
PART = 4 << 20


class Sentinels(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


MARKS = Sentinels()
RESULT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def hashes(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _parts(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last text, bytes and offsets of each run of texts of about `size` bytes."""
    binary = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset:binary.offset + len(binary) + 1]
    held = binary.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(binary):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def transform(texts: pa.Array, draws: list[np.ndarray], unit: str, rate: int, suffix_first: int, marks: Sentinels, part: int) -> pa.Array:
    """The struct of RESULT for each text of a batch."""
    p, s, m = (x.encode() for x in marks)
    n, form, prefix, middle, output = [], [], [], [], []
    for first, last, data, offsets in _parts(texts, part):
        starts, ends = offsets[:-1], offsets[1:]
        matrix = WaveletMatrix(classes(data, ends))
        units = matrix.units(unit, starts, ends)
        one, two, three, four = (d[first:last] for d in draws)
        cuts = np.sort(np.stack([one % (units + 1), two % (units + 1)]), axis=0)
        # both cuts of all texts are searched for together
        at = matrix.cut(unit, np.tile(starts, 2), np.tile(ends, 2), cuts.ravel()).reshape(2, -1)
        chars = matrix.count("chars", np.concatenate([starts, at[0], at[1]])).reshape(3, -1)
        raw = data.tobytes()
        n += units.tolist()
        for i, (a, b, c, d) in enumerate(zip(starts.tolist(), at[0].tolist(), at[1].tolist(), ends.tolist())):
            whole = raw[a:d]
            if a == d or three[i] % 100 >= rate or p in whole or s in whole or m in whole:
                form.append("plain")
                prefix.append(None)
                middle.append(None)
                output.append(whole)
                continue
            prefix.append(int(chars[1, i] - chars[0, i]))
            middle.append(int(chars[2, i] - chars[1, i]))
            if four[i] % 100 < suffix_first:
                form.append("spm")
                output.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
            else:
                form.append("psm")
                output.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
    columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
               pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
    return pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"])


def infilled(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", unit: str = "chars", rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST, seed: int = SEED, marks: Sentinels = MARKS, part: int = PART,
) -> DataFrame:
    """`docs` with n (units), form, prefix_chars, middle_chars and output."""

    @F.arrow_udf(RESULT)
    def cut(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *draws in batches:
            yield transform(texts, [d.to_numpy(zero_copy_only=False) for d in draws], unit, rate, suffix_first, marks, part)

    said, *names = fresh(docs, "_said", "n", "form", "prefix_chars", "middle_chars", "output")
    fields = ("n", "form", "prefix_chars", "middle_chars", "output")
    given = docs.withColumn(said, cut(F.col(f"`{text}`").cast("string"), *hashes(F.col(f"`{doc_id}`"), seed)))
    return given.withColumns({name: F.col(f"{said}.{field}") for name, field in zip(names, fields)}).drop(said)


def restored(output: Column, form: Column, marks: Sentinels = MARKS) -> Column:
    """The text that an output was made of."""
    def between(after: str, before: str) -> Column:
        rest = F.substring_index(output, after, -1)
        return rest if not before else F.substring_index(rest, before, 1)

    p, s, m = marks
    psm = F.concat(between(p, s), between(m, ""), between(s, m))
    spm = F.concat(between(p, m), between(m, ""), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

"""Fill-in-the-middle: the matrix against counting, cuts against slicing, exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import ODD, bag
from shoreline.llm import infill
from shoreline.llm.wavelet import UNITS, WaveletMatrix, classes


def random_texts(seed, n=300):
    pick = random.Random(seed)
    return ["".join(pick.choice("ab é漢🙂\n .!?\t") for _ in range(pick.randrange(30))) for _ in range(n)]


def laid_out(texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return np.frombuffer(b"".join(data), np.uint8), offsets[:-1], offsets[1:]


def test_ranks_equal_counts():
    codes = np.random.default_rng(0).integers(0, 8, 1000).astype(np.uint8)
    matrix = WaveletMatrix(codes)
    at = np.arange(1001)
    for c in range(8):
        assert matrix.rank(c, at).tolist() == [0, *np.cumsum(codes == c).tolist()]
    assert WaveletMatrix(np.zeros(0, np.uint8)).rank(3, np.array([0])).tolist() == [0]


def pieces(text, unit):
    """The units of a text, in order."""
    if unit == "chars":
        return list(text)
    out, at = [], 0
    for i, c in enumerate(text):
        after = text[i + 1:i + 2]
        ends = {"words": c in " \t\n" and after not in ("", " ", "\t", "\n"), "sentences": c in ".!?", "lines": c == "\n"}[unit]
        if ends:
            out.append(text[at:i + 1])
            at = i + 1
    return out + [text[at:]] * (at < len(text))


@pytest.mark.parametrize("unit", list(UNITS))
def test_cuts_equal_slices(unit):
    texts = random_texts(unit)
    data, starts, ends = laid_out(texts)
    matrix = WaveletMatrix(classes(data, ends))
    n = matrix.units(unit, starts, ends)
    assert n.tolist() == [len(pieces(t, unit)) for t in texts]
    for share in (0, 0.3, 0.7, 1):
        nth = np.floor(n * share).astype(np.int64)
        cut = matrix.cut(unit, starts, ends, nth)
        for t, a, b, k in zip(texts, starts, cut, nth):
            assert data[a:b].tobytes().decode() == "".join(pieces(t, unit)[:k])


def plain(doc, text, unit="chars"):
    text = text or ""
    digest = hashlib.sha256(f"1:{'null' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = pieces(text, unit)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", list(UNITS))
@pytest.mark.parametrize("part", [64, 1 << 22])
def test_outputs_equal_brute_force(documents, unit, part):
    rows = [(i, t) for i, t, *_ in ODD] + list(enumerate(random_texts(3), 100)) + [
        (900 + i, t) for i, t in enumerate(("a<P>b", "<S>", "x<M>", "<P", "P>", "<<S", "<M<M") * 8)]
    if unit == "words":
        # other gaps than those of the plain version
        rows = [(i, t) for i, t in rows if t is None or len(t) < 1000]
    out = infill.infilled(documents(rows).repartition(2), unit=unit, part=part)
    got = out.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == (r.text or "") for r in got)
    assert bag((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == bag(
        plain(i, t, unit) for i, t in rows)


def test_clashing_columns_and_nothing(documents):
    docs = documents([(1, "some text here", "en", "s")]).withColumns(
        {c: F.lit(7) for c in ("n", "form", "output", "_said", "prefix_chars")})
    out = infill.infilled(docs)
    assert out.columns == [*docs.columns, "n_", "form_", "prefix_chars_", "middle_chars", "output_"]
    assert out.first().n_ == 14 and out.first().n == 7
    assert infill.infilled(docs.where("false")).count() == 0

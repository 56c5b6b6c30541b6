"""Personal data: base spans against plain patterns, votes, reliabilities, the final classifier."""

from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import ODD, bag
from shoreline.llm import labelers, personal
from shoreline.llm.labelers import CARD, EMAIL, IP, KINDS, PHONE
from shoreline.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

PLAIN = [re.compile(x) for x in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == IP else True,
                    16 <= len(digits) <= 19 and labelers.luhn(digits), 8 <= len(digits) <= 15)[kind]
            if fits:
                out.append((kind, *m.span()))
    return out


def base_of(text):
    return [c[:3] for c in labelers.candidates(text) if c[3]]


def added(text):
    return [(KINDS[c[0]], text[c[1]:c[2]]) for c in labelers.candidates(text) if not c[3]]


@pytest.mark.parametrize("alphabet", ["a.@-b", "12.0", "4 -1", "+1 (2)-.3", "a1@.+ -(:é", "25.6"])
def test_base_equals_plain_patterns(alphabet):
    pick = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(40)))
        assert base_of(text) == plain_base(text), text


def test_luhn():
    assert labelers.luhn("4111111111111111") and not labelers.luhn("4111111111111112")


def test_candidates_beyond_the_base():
    assert added("write to jo.doe (at) mail (dot) example (dot) com now") == [("email", "jo.doe (at) mail (dot) example (dot) com")]
    assert added("jo at mail dot example dot com") == [("email", "jo at mail dot example dot com")]
    assert added("looked at the. Next") == []
    assert added("card 4111111111111111 4012888888881881 end") == [("card", "4111111111111111"), ("card", "4012888888881881")]
    assert added("call +1 (269) 555-3296 4524132264652876 now") == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    assert added("call +1 (269) 555-3296 190.1.2.3 now") == [("phone", "+1 (269) 555-3296")]
    assert added("tel (269) 555-3296 or 212-555-0188") == [("phone", "(269) 555-3296"), ("phone", "212-555-0188")]
    assert added("host 2001:db8:0:0:0:0:2:1 at 12:30:45") == [("ip", "2001:db8:0:0:0:0:2:1")]
    assert added("version 1.2.3, 2024-01-15, 3.14") == []


@pytest.mark.parametrize("text", [
    "x" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+" * 100_000, "+1" * 100_000, "1 " * 100_000, "a:" * 100_000,
    "x" * 100_000 + "@b.c", " at " * 50_000, "(at)" * 50_000, "1-" * 100_000, "(1" * 100_000,
])
def test_long_texts_take_linear_time(text):
    labelers.candidates(text)


def test_reliabilities_are_recovered_without_labels():
    pick = np.random.default_rng(1)
    truth = pick.random(20_000) < 0.6
    right = [0.97, 0.99, 0.9, 0.95, 0.8, 0.7]
    votes = np.stack([np.where(pick.random(len(truth)) < r, truth, ~truth) * 2 for r in right], axis=1)
    patterns, inverse, counts = np.unique(votes @ 3 ** np.arange(6), return_inverse=True, return_counts=True)
    posterior, chance = personal.reliabilities(patterns, counts.astype(float))
    assert ((posterior[inverse] > 0.5) == truth).mean() > 0.99
    for i, r in enumerate(right):
        assert abs(chance[1][i][2] - r) < 0.02 and abs(chance[0][i][0] - r) < 0.02


def test_numbers_that_only_look_like_cards_are_left_alone(documents):
    pick = random.Random(3)

    def number(valid):
        while True:
            body = "4" + "".join(pick.choice("0123456789") for _ in range(15)) if valid else "".join(
                pick.choice("0123456789") for _ in range(16))
            if labelers.luhn(body) == valid:
                return body

    cards, others = [number(True) for _ in range(60)], [number(False) for _ in range(60)]
    texts = [f"some words here {x} and more of them" for x in cards + others] + [f"two of them {cards[0]} {cards[1]} in a row"]
    rows = personal.spans(documents(texts)).orderBy("doc_id").collect()
    found = [[r.text[c.start:c.end] for c in r.spans] for r in rows]
    assert found == [[x] for x in cards] + [[]] * 60 + [[cards[0], cards[1]]]


def test_odd_rows_and_digests(documents):
    rows = ODD + [
        (20, "mail a@b.org, ip 10.0.0.256 or 10.0.0.25, 🙂 +1 (743) 555-3824."), (21, None), (22, "a@b.c@d.e 1.2.3.4.5.6.7.8")]
    docs = documents(rows).withColumns({c: F.lit(7) for c in ("candidates", "spans", "kind", "start", "base")})
    full = personal.spans(docs)
    assert full.columns == [*docs.columns, "spans_"]
    out = personal.digests(full, "spans_").collect()
    expected = []
    for doc, text, *_ in rows:
        base = plain_base(text)
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base)
        counts = [sum(k == kind for k, _, _ in base) for kind in range(4)]
        expected.append((doc, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    assert bag(r[:6] for r in out) == bag(expected)
    assert {r.spans for r in out if r.doc_id == 20} == {"email:5:12,ip:31:40,phone:44:61"}
    assert personal.spans(docs.where("false")).count() == 0


def test_masked(documents):
    docs = documents([(1, "mail a@b.org or call +1 (743) 555-3824 now", "en", "s"), (2, None), (3, "nothing")])
    out = personal.masked(docs)
    assert out.columns == docs.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["mail <email> or call <phone> now", None, "nothing"]


def test_kinds():
    assert (EMAIL, IP, CARD, PHONE) == tuple(map(KINDS.index, ("email", "ip", "card", "phone")))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_over_the_whole_table(spark):
    """Base spans equal the plain patterns; every span lies in its text, in order, and added ones are no base spans."""
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_pii"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        base = plain_base(text[r.doc_id])
        listed = [f"{KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in range(4))
        found = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(found) and len(found) == len(listed) + r.n_added
        places = [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in found)]
        assert places == sorted(places) and all(0 <= a < b <= len(text[r.doc_id]) for _, a, b in places)

"""Personal data found by weak supervision.

Patterns give the base spans of four kinds (email, ip, card, phone), which always count, and looser candidates: spelt
addresses, numbers inside longer digit chains or without a valid checksum, phone numbers without a plus. On every
candidate, base or not, six labelers vote yes, no or nothing: two regular expressions, a gazetteer and three on the context
(`labelers`). Expectation-maximisation estimates from the counts of the vote patterns how often each labeler of a kind votes
what on true and on false candidates, without any labels. The posteriors are soft labels for the final classifier, a naive Bayes
model over hashed features of the span and its surroundings, which decides on each candidate beyond the base.

The texts are scanned once. Vote patterns (at most 3^6 a kind) and features (FEATURES a kind) bound what reaches the driver,
whatever the input; counts run over all candidates of all documents, in whole numbers, so a rerun agrees.

Positions count code points. A null or empty text has no spans. Rows that repeat are judged alike. A long
text is scanned whole, in linear time. Without any candidate the model is its prior and nothing is added. An empty
table gives an empty result. Columns of any name pass through `spans` and `masked`.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.labelers import FEATURES, KINDS, LABELERS, candidates
from shoreline.llm.text import fresh
from shoreline.session import cut_lineage

SPAN = "kind int, start int, end int, base boolean, pattern int, features array<int>"
#: What is held before any vote is seen, in candidates: how often each labeler says no, nothing, yes on true and on false
#: ones. One number in ten passes a card's checksum by chance, hardly any card fails it; what stands alone in prose in the usual form may be any number.
PRIOR_TRUE = np.array([(2, 1, 17), (0.5, 2, 17.5), (2, 3, 15), (2, 1, 17), (1, 13, 6), (2, 5, 13)], float)
PRIOR_FALSE = np.array([(8, 2, 10), (17, 1, 2), (12, 4, 4), (7, 1, 12), (4, 14, 2), (6, 5, 9)], float)
#: True candidates and false ones that are held to have been seen.
PRIOR_EACH = 5.0
ROUNDS = 200
SETTLED = 1e-9
#: Posteriors are summed in thousandths, log odds are whole thousandths.
UNIT = 1000
#: Occurrences of a feature that are assumed on both sides.
SMOOTH = 2.0


def found(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """`docs` with the candidates of each text, under a name that it doesn't have."""

    @F.pandas_udf(f"array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "end", "base", "pattern", "features")
        for texts in batches:
            yield pd.Series([[dict(zip(names, c)) for c in candidates(t)] for t in texts])

    name, = fresh(docs, "candidates")
    return docs.withColumn(name, scan(F.col(f"`{text}`").cast("string")))


# --- labelers' reliabilities -------------------------------------------------------------------------


def said(patterns: np.ndarray) -> np.ndarray:
    """Each labeler's vote (0 no, 1 nothing, 2 yes) in each pattern."""
    return np.stack([patterns // 3 ** i % 3 for i in range(LABELERS)], axis=1)


def reliabilities(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern, and the chance of each vote by class and labeler, for one kind.

    Labelers are taken as independent given the class. Starts from the prior and ends when no posterior moves.
    """
    votes = said(patterns)
    one_hot = np.eye(3)[votes]
    prior = np.stack([PRIOR_FALSE, PRIOR_TRUE])
    chance = prior / prior.sum(axis=2, keepdims=True)
    share = np.array([0.5, 0.5])
    posterior = np.full(len(patterns), 0.5)
    for _ in range(ROUNDS):
        picked = np.stack([chance[c][np.arange(LABELERS), votes] for c in (0, 1)])
        logs = np.log(picked).sum(axis=2) + np.log(share)[:, None]
        now = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
        settled = np.abs(now - posterior).max(initial=0) < SETTLED
        posterior = now
        if settled:
            break
        for c, weight in ((0, counts * (1 - posterior)), (1, counts * posterior)):
            seen = prior[c] + np.einsum("p,plv->lv", weight, one_hot)
            chance[c] = seen / seen.sum(axis=1, keepdims=True)
        of_true = float((counts * posterior).sum())
        share = np.array([counts.sum() - of_true + PRIOR_EACH, of_true + PRIOR_EACH])
        share = share / share.sum()
    return posterior, chance


def posteriors(pattern_counts: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """(kind, pattern) to the posterior in thousandths."""
    out = {}
    for kind in range(len(KINDS)):
        own = sorted((p, n) for (k, p), n in pattern_counts.items() if k == kind)
        if own:
            patterns, counts = (np.array(x) for x in zip(*own))
            found_ = reliabilities(patterns, counts.astype(float))[0]
            out |= {(kind, int(p)): round(UNIT * float(q)) for p, q in zip(patterns, found_)}
    return out


# --- the classifier ----------------------------------------------------------------------------------


def log_odds(sums: dict[tuple[int, int], tuple[int, int]], totals: dict[int, tuple[int, int]]) -> list[list[int]]:
    """For each kind: the prior, then what each feature adds, in thousandths. A feature never seen adds nothing."""
    out = []
    for kind in range(len(KINDS)):
        yes, no = (x / UNIT for x in totals.get(kind, (0, 0)))
        row = [round(UNIT * float(np.log((yes + SMOOTH) / (no + SMOOTH))))] + [0] * FEATURES
        for (k, feature), (a, b) in sums.items():
            if k == kind:
                ratio = (a / UNIT + SMOOTH) / (yes + 2 * SMOOTH) * (no + 2 * SMOOTH) / (b / UNIT + SMOOTH)
                row[1 + feature] = round(UNIT * float(np.log(ratio)))
        out.append(row)
    return out


def train(rows: DataFrame, name: str = "candidates") -> list[list[int]]:
    """The classifier, from the candidates of all documents."""
    spark = rows.sparkSession
    each = rows.select(F.explode(name).alias("c")).select("c.kind", "c.pattern", "c.features")
    counted = each.groupBy("kind", "pattern").agg(F.count("*").alias("n")).collect()
    soft = posteriors({(r.kind, r.pattern): r.n for r in counted})
    # one row for each vote pattern, 4 * 3^6 at most
    judged = spark.createDataFrame([(k, p, q) for (k, p), q in sorted(soft.items())], "kind int, pattern int, yes long")
    marked = each.join(F.broadcast(judged), ["kind", "pattern"])
    sums = marked.select("kind", "yes", F.explode("features").alias("feature")).groupBy("kind", "feature").agg(
        F.sum("yes").alias("yes"), F.sum(UNIT - F.col("yes")).alias("no")).collect()
    totals: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for r in counted:
        totals[r.kind][0] += r.n * soft[r.kind, r.pattern]
        totals[r.kind][1] += r.n * (UNIT - soft[r.kind, r.pattern])
    return log_odds({(r.kind, r.feature): (r.yes, r.no) for r in sums}, {k: tuple(v) for k, v in totals.items()})


def spans(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs`, or the columns of it to keep, with spans: the base ones and those that the classifier adds, by kind, then start, as
    structs of kind, start, end and base. Candidates and kept columns are written once to the shared folder; leave
    out the text where only the spans are asked for."""
    at, of = fresh(docs, "candidates", "spans")
    kept_columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    rows = cut_lineage(found(docs, text=text).select(*kept_columns, at))
    weights = F.from_json(F.lit(json.dumps(train(rows, at))), "array<array<bigint>>")

    def is_data(c: Column) -> Column:
        own = F.get(weights, c["kind"])
        score = F.aggregate(c["features"], F.get(own, F.lit(0)), lambda sum_, f: sum_ + F.get(own, f + 1))
        return c["base"] | (score > 0)

    kept = F.transform(F.filter(at, is_data), lambda c: F.struct(c["kind"], c["start"], c["end"], c["base"]))
    return rows.withColumn(of, kept).drop(at)


def listed(found_: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found_, lambda c: F.concat_ws(
        ":", F.get(kinds, c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")


def digests(rows: DataFrame, name: str = "spans") -> DataFrame:
    """doc_id, base counts and digest, all spans, n_added."""
    base = F.filter(name, lambda c: c["base"])

    def count_of(kind: int) -> Column:
        return F.size(F.filter(base, lambda c: c["kind"] == kind)).cast("long")

    counts = [count_of(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(name)).alias("spans"),
        F.size(F.filter(name, lambda c: ~c["base"])).cast("long").alias("n_added"))


def masked(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """`docs` with the text's spans replaced by their kind in angle brackets; overlapping ones by the first's."""
    of = fresh(docs, "candidates", "spans")[1]

    @F.pandas_udf("string")
    def mask(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
        out = []
        for whole, own in zip(texts, all_spans):
            if whole is None or not len(own):
                out.append(whole)
                continue
            parts, at = [], 0
            for start, end, kind in sorted((c["start"], c["end"], c["kind"]) for c in own):
                if start >= at:
                    parts += [whole[at:start], f"<{KINDS[kind]}>"]
                at = max(at, end)
            out.append("".join([*parts, whole[at:]]))
        return pd.Series(out)

    rows = spans(docs, text=text)
    masked_ = F.when(F.size(of) > 0, mask(F.col(f"`{text}`"), of)).otherwise(F.col(f"`{text}`"))
    return rows.withColumn(text, masked_).select(*[F.col(f"`{c}`") for c in docs.columns])

"""URL filter: rules for hosts and paths, and a character language model for the rest.

A URL that a rule fits is judged by the longest such rule. These URLs also train two
variable-order Markov models of host and path, one for allowed and one for blocked URLs.
A character is predicted from the ORDER characters before it; counts are smoothed towards
the next shorter context, and a context neither model has seen gives way to the shorter
one. The score is the mean log-likelihood difference per character. One in HELD of the
labelled URLs trains nothing and sets the threshold: the one with the best mean of both
classes' recall over BINS equal steps, the nearest to 0 among equals; without URLs of both
classes it is 0.

Characters are folded to 33 symbols (a-z, one for all digits, `/ . -`, one for the rest, start and
end), so the model has at most 33**4 rows of about 60 bytes however many URLs there are, and is
broadcast. Scores are computed once for each distinct folded URL.

A null URL or one without `://` has empty host and path, no rule and score 0. Rows that
repeat are judged alike. Without any rule match all scores are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import fold_ascii, fresh
from shoreline.session import cut_lineage

ORDER = 3
SMOOTHING = 4.0
HELD = 5
BINS, REACH = 400, 4.0
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/.-_^$"

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return fold_ascii(host), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule that fits, as text, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for own, start, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule = F.when(fits, F.lit(own + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def folded(host: Column, path: Column) -> Column:
    """Host and path in the symbols of the model; empty stays empty."""
    text = F.translate(fold_ascii(F.concat(host, path)), "123456789", "000000000")
    return F.regexp_replace(text, r"[^a-z0/.\-]", "_")


def grams(text: Column, n: int) -> Column:
    """The n symbols that end at each symbol of `text$`, after n - 1 start symbols."""
    padded = F.concat(F.lit("^" * (n - 1)), text, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substr(padded, i, F.lit(n)))


def model(labelled: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING) -> DataFrame:
    """(text, allowed, n) to (gram, ratio, back): the log ratio of the last symbol after the others,
    and what is added to the next shorter gram's ratio where a gram with this start is unknown."""
    every = F.flatten(F.array(*[grams(F.col("text"), k) for k in range(1, order + 2)]))
    counted = labelled.select("allowed", "n", F.explode(every).alias("gram")).groupBy("gram").agg(
        F.sum(F.when(F.col("allowed"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("allowed"), 0).otherwise(F.col("n"))).alias("r"),
    )
    spark = labelled.sparkSession
    base = spark.createDataFrame([(c,) for c in SYMBOLS], "gram string").withColumns({"a": F.lit(0), "r": F.lit(0)})
    counted = counted.unionByName(base).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    counted = cut_lineage(counted.withColumn("k", F.length("gram")))
    starts = counted.groupBy(F.substring("gram", 1, F.col("k") - 1).alias("start"), F.col("k").alias("of")).agg(
        F.sum("a").alias("sa"), F.sum("r").alias("sr"))
    rows = counted.join(starts, (F.substring("gram", 1, F.col("k") - 1) == F.col("start")) & (F.col("k") == F.col("of")))
    levels = []
    for k in range(1, order + 2):
        here = rows.where(F.col("k") == k)
        if k == 1:
            pa = pr = F.lit(1.0 / len(SYMBOLS))
        else:
            below = levels[-1].select(F.col("gram").alias("end"), F.col("pa").alias("qa"), F.col("pr").alias("qr"))
            here = here.join(below, F.substring("gram", 2, k) == F.col("end"))
            pa, pr = F.col("qa"), F.col("qr")
        levels.append(here.select(
            "gram",
            ((F.col("a") + smoothing * pa) / (F.col("sa") + smoothing)).alias("pa"),
            ((F.col("r") + smoothing * pr) / (F.col("sr") + smoothing)).alias("pr"),
        ))
    ratios = levels[0]
    for level in levels[1:]:
        ratios = ratios.unionByName(level)
    back = starts.where(F.col("of") > 1).select(
        F.col("start").alias("gram"), F.log((F.col("sr") + smoothing) / (F.col("sa") + smoothing)).alias("back"))
    return cut_lineage(
        ratios.select("gram", F.log(F.col("pa") / F.col("pr")).alias("ratio")).join(back, "gram", "full")
    )


def scores(texts: DataFrame, table: DataFrame, order: int = ORDER) -> DataFrame:
    """(text, score) for each row of `texts`, which are distinct and not empty."""
    symbols = texts.select("text", F.explode(grams(F.col("text"), order + 1)).alias("gram"))
    ratio, back = F.lit(0.0), F.lit(0.0)
    found = F.lit(False)
    for k in range(order + 1, 0, -1):
        of = table.select(F.col("gram").alias(f"g{k}"), F.col("ratio").alias(f"ratio{k}")).where(F.col(f"ratio{k}").isNotNull())
        symbols = symbols.join(F.broadcast(of), F.substring("gram", order + 2 - k, k) == F.col(f"g{k}"), "left")
        ratio = ratio + F.when(found, 0.0).otherwise(F.coalesce(f"ratio{k}", F.lit(0.0)))
        found = found | F.col(f"ratio{k}").isNotNull()
        if k > 1:
            start = table.select(F.col("gram").alias(f"s{k}"), F.col("back").alias(f"back{k}")).where(F.col(f"back{k}").isNotNull())
            symbols = symbols.join(F.broadcast(start), F.substring("gram", order + 2 - k, k - 1) == F.col(f"s{k}"), "left")
            back = back + F.when(found, 0.0).otherwise(F.coalesce(f"back{k}", F.lit(0.0)))
    return symbols.groupBy("text").agg(F.avg(ratio + back).alias("score"))


def threshold(scored: DataFrame) -> float:
    """(score, allowed) of held-out URLs to the best step."""
    step = F.floor((F.least(F.greatest("score", F.lit(-REACH)), F.lit(REACH)) + REACH) * (BINS / (2 * REACH)))
    bins = scored.groupBy(F.least(step, F.lit(BINS - 1)).cast("int").alias("bin")).agg(
        F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("r"))
    rows = {x.bin: (x.a, x.r) for x in bins.collect()}
    allowed, blocked = sum(a for a, _ in rows.values()), sum(r for _, r in rows.values())
    if not allowed or not blocked:
        return 0.0
    best, below_a, below_r = [], 0, 0
    for b in range(BINS + 1):
        at = b * 2 * REACH / BINS - REACH
        best.append((-((allowed - below_a) / allowed + below_r / blocked), abs(at), at))
        a, r = rows.get(b, (0, 0))
        below_a, below_r = below_a + a, below_r + r
    return min(best)[2]


def judged(pages: DataFrame, *, url: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """`pages` with host, path, rule, verdict and score (null where a rule decides)."""
    host, path, rule, verdict, score, text, said, key = fresh(
        pages, "host", "path", "rule", "verdict", "score", "_text", "_said", "_key")
    h, p = host_and_path(F.col(f"`{url}`"))
    out = pages.withColumns({host: h, path: p})
    r, v = longest_rule(F.col(host), F.col(path), rules)
    out = out.withColumns({rule: r, said: v, text: folded(F.col(host), F.col(path))})
    texts = cut_lineage(out.where(F.col(text) != "").groupBy(F.col(text).alias("text"), F.col(said).alias("said")).agg(
        F.count("*").alias("n")))
    held = F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0
    labelled = texts.where(F.col("said").isNotNull()).select("text", "n", (F.col("said") == "allow").alias("allowed"))
    table = model(labelled.where(~held), order)
    of = cut_lineage(scores(texts.select("text").distinct(), table, order))
    apart = of.join(labelled.where(held), "text").select("score", "allowed")
    at = threshold(apart)
    out = out.join(of.select(F.col("text").alias(key), F.col("score").alias(score)), F.col(text) == F.col(key), "left")
    own = F.coalesce(F.col(score), F.lit(0.0))
    return out.withColumns({
        verdict: F.coalesce(F.col(said), F.when(own >= at, "allow").otherwise("block")), score: own,
    }).drop(text, said, key)

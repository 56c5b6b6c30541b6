"""Licence scans by canonical digest.

A text is folded to lower case, loses copyright lines, gets one spelling for words that have
several and keeps only letters and digits, with one space between words. Its md5 digest is joined
with the digests of known licence texts, which go through the same expression (`license_texts` has whole texts
and notices). A document is looked up whole and line by line, so that a notice within a text is found too,
if it is on one line.

Null, empty and blank texts match nothing. Rows that repeat are reported each; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import license_texts
from shoreline.llm.text import fold_ascii

#: What one spelling stands for.
SPELLINGS = (
    ("licence", "license"),
    ("organisation", "organization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("https", "http"),
)
#: The first part keeps lines of running text that happen to begin with the word.
COPYRIGHT_LINES = (
    r"((?:^|\n)[ \t]*(?:copyright(?:[-.;)]|,[ \t]+(?:patent|and|or)\b|ed\b|able\b|s\b|[ \t]+(?:the[ \t]+(?:software|library|program)|and|are|disclaimer|doctrine|holder|if"
    r"|in|interest|is|law|license|licence|notice|of|on|or|owner|ownership|permission|remains|resulting|statement|terms|to|treaty)s?\b)"
    r"|\(c\)[ \t]+(?:you[ \t]+must|the[ \t]+licenses[ \t]+granted|under[ \t]+patent|representations)\b)[^\n]*)"
    r"|(?:^|\n)[ \t]*(?:copyright|\(c\)|©)[^\n]*"
)
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Licence texts and notices by SPDX name.
KNOWN = (
    *license_texts.known(),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
            "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             'hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
             "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
             "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
             "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
             "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
)


def canonical(text: Column) -> Column:
    out = F.regexp_replace(fold_ascii(F.coalesce(text, F.lit(""))), COPYRIGHT_LINES, "$1")
    for spelling, one in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(one))
    return F.trim(F.regexp_replace(out, NO_WORD, " "))


def digests(spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """digest, license: a row for each known text, the first name in order where several agree."""
    rows = spark.createDataFrame(list(known), "license string, text string")
    return rows.select(F.md5(canonical(F.col("text")).cast("binary")).alias("digest"), "license").groupBy("digest").agg(
        F.min("license").alias("license"))


def licences(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", known: Sequence[tuple[str, str]] = KNOWN
) -> DataFrame:
    """doc_id, license (of the whole text, or null), n_lines (that are licences) and line_licenses (names, sorted)."""
    given = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("text")))
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("text")))
    each = given.select("doc", "key", F.explode(F.concat(whole, lines)).alias("x"))
    each = each.select("doc", "key", "x.whole", F.md5(canonical(F.col("x.text")).cast("binary")).alias("digest"))
    # as many rows as there are known texts
    found = each.join(F.broadcast(digests(docs.sparkSession, known)), "digest", "left")
    of_line = ~F.col("whole") & F.col("license").isNotNull()
    out = found.groupBy("doc", "key").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.count_if(of_line).alias("n_lines"),
        F.array_join(F.array_sort(F.collect_set(F.when(of_line, F.col("license")))), ",").alias("line_licenses"),
        F.count_if("whole").alias("rows"),
    )
    again = out.withColumn("again", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))))
    return again.select(
        F.col("doc").alias("doc_id"), "license", F.try_divide("n_lines", "rows").cast("long").alias("n_lines"), "line_licenses")

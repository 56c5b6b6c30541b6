"""Schema-free handling of JSON payloads with the VARIANT type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mark(text: str) -> Column:
    return F.xxhash64(text)


def parse_document(text: str) -> Column:
    """Text to VARIANT, as the first element of an array that ends in a mark of the text.

    The parser ignores what follows a complete value. Behind the mark nothing of the
    text can follow, so ``is_document`` sees text with a second value in it.
    """
    marked = F.concat(F.lit("["), F.col(text), F.lit(","), _mark(text).cast("string"), F.lit("]"))
    return F.try_parse_json(marked)


def is_document(text: str, document: str) -> Column:
    """True when the text is exactly one JSON value."""
    mark = F.try_variant_get(F.col(document), "$[1]", "bigint")
    return F.coalesce(mark == _mark(text), F.lit(False))


def object_fields(text: str, document: str) -> Column:
    """Top-level keys of a JSON object as a map; NULL for anything else."""
    fields = F.try_variant_get(F.col(document), "$[0]", "map<string,variant>")
    return F.when(is_document(text, document), fields)


def text_field(document: str, key: str) -> Column:
    return F.try_variant_get(F.col(document), f"$[0].{key}", "string")


def reject_reason(text: str, document: str, fields: str) -> Column:
    """Why a raw line is no record; NULL for a usable one."""
    return (
        F.when(F.col(fields).isNotNull(), F.lit(None).cast("string"))
        .when(F.trim(F.coalesce(F.col(text), F.lit(""))) == "", "empty")
        .when(is_document(text, document), "not_an_object")
        .otherwise("malformed_json")
    )


def extend_object(text: str, fields: str, extra: dict[str, Column]) -> Column:
    """JSON text of an object with ``extra`` keys added; they win over payload keys.

    Usually the keys are put in front of the text, which keeps the payload as it was
    sent. Only a payload that already has one of them (or none at all) is written anew.
    The last key must hold a text, so that its JSON ends in a single closing brace.
    """
    names = list(extra)
    added = F.to_json(F.struct(*[column.alias(name) for name, column in extra.items()]))
    one_line = F.btrim(F.translate(F.col(text), "\n\r\t", "   "))
    extended = F.concat(F.rtrim(added, F.lit("}")), F.lit(","), F.substr(one_line, F.lit(2)))

    entries = [part for name in names for part in (F.lit(name), extra[name].cast("variant"))]
    kept = F.map_filter(fields, lambda key, _: ~key.isin(names))
    rewritten = F.to_json(F.map_concat(kept, F.create_map(*entries)))

    taken = F.arrays_overlap(F.map_keys(fields), F.array(*[F.lit(n) for n in names]))
    return F.when((F.size(fields) > 0) & ~taken, extended).otherwise(rewritten)

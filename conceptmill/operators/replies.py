"""Parsing and validation of model replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.functions.text import strip
from conceptmill.operators.writes import direction_uri

# --- fixed values: where JSON is looked for in a reply -------------------------
FENCED_BLOCK = r"(?s)```(?:json)?\s*\n?(.*?)\n?\s*```"
BRACKETED = r"(?s)(\{.*\}|\[.*\])"
ERROR_CHARS = 500

_ASSESSMENT_TEXTS = ("label", "impact_direction", "confidence", "reasoning", "summary")
_ASSESSMENT_LISTS = ("direct_effects", "second_order_effects", "key_uncertainties")


def _candidates(raw: Column) -> list[Column]:
    """The whole text, the first fenced block, the first bracketed span."""
    text = strip(raw)
    return [
        text,
        strip(F.regexp_extract(text, FENCED_BLOCK, 1)),
        F.regexp_extract(text, BRACKETED, 1),
    ]


def _string_list(json: Column, path: str) -> Column:
    """A JSON array of strings, NULL when any element is something else."""
    value = F.try_variant_get(json, path, "variant")
    items = F.try_variant_get(json, path, "array<string>")
    strings = F.schema_of_variant(value).isin("ARRAY<STRING>", "ARRAY<VOID>")
    return F.when(strings & ~F.exists(items, lambda x: x.isNull()), items)


def _string(json: Column, path: str) -> Column:
    value = F.try_variant_get(json, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(json, path, "string"))


def designated_classes(raw: Column, *, accept_bare_list: bool = False) -> Column:
    """The classes of a reply, NULL when no part of it is a valid answer.

    Valid is an object with ``designated_classes``, a list of strings; other
    keys are ignored. ``accept_bare_list`` also takes the list alone.
    """
    found = []
    for candidate in _candidates(raw):
        json = F.try_parse_json(candidate)
        found.append(_string_list(json, "$.designated_classes"))
        if accept_bare_list:
            found.append(_string_list(json, "$"))
    return F.coalesce(*found)


def parse_replies(replies: DataFrame, *, raw: str = "raw", accept_bare_list: bool = False) -> DataFrame:
    """Add ``classes`` and, for replies that cannot be parsed, ``parse_error``."""
    parsed = replies.withColumn("classes", designated_classes(F.col(raw), accept_bare_list=accept_bare_list))
    message = F.concat(
        F.lit("no valid JSON in reply: "), F.substring(strip(F.col(raw)), 1, ERROR_CHARS)
    )
    return parsed.withColumn("parse_error", F.when(F.col("classes").isNull(), message))


def impact_assessment(raw: Column) -> Column:
    """The eight fields of an impact reply as a struct, NULL when one is missing or wrong.

    The reply is the JSON object, a fenced block with it, or a text around it.
    """
    return F.coalesce(*(_assessment(F.try_parse_json(candidate)) for candidate in _candidates(raw)))


def _assessment(json: Column) -> Column:
    texts = {name: _string(json, f"$.{name}") for name in _ASSESSMENT_TEXTS}
    lists = {name: _string_list(json, f"$.{name}") for name in _ASSESSMENT_LISTS}
    valid = texts["impact_direction"].isin(list(v.IMPACT_URIS)) & texts["confidence"].isin(list(v.CONFIDENCE_LEVELS))
    for value in [*texts.values(), *lists.values()]:
        valid = valid & value.isNotNull()
    order = ("label", "impact_direction", "confidence", "reasoning", *_ASSESSMENT_LISTS, "summary")
    return F.when(valid, F.struct(*[{**texts, **lists}[name].alias(name) for name in order]))


def parse_impact(replies: DataFrame, *, raw: str = "raw") -> DataFrame:
    """Add ``assessment`` and ``impact_uri``, both NULL for an invalid reply."""
    parsed = replies.withColumn("assessment", impact_assessment(F.col(raw)))
    return parsed.withColumn("impact_uri", direction_uri(F.col("assessment.impact_direction")))

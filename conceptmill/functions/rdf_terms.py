"""Serialisation of values as RDF terms in SPARQL syntax."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill.functions.text import float_text


def _typed(text: Column, datatype: str) -> Column:
    return F.concat(F.lit('"'), text, F.lit(f'"^^xsd:{datatype}'))


def string_term(value: Column) -> Column:
    return F.concat(F.lit('"""'), F.regexp_replace(value, r"""([\\'"])""", r"\\$1"), F.lit('"""'))


def uri_term(value: Column) -> Column:
    return F.concat(F.lit("<"), F.regexp_replace(value, r"""([\\"<>])""", r"\\$1"), F.lit(">"))


def int_term(value: Column) -> Column:
    return _typed(value.cast("string"), "integer")


def float_term(value: Column) -> Column:
    return _typed(float_text(value.cast("double")), "float")


def bool_term(value: Column) -> Column:
    return _typed(F.when(value, F.lit("true")).when(~value, F.lit("false")), "boolean")


def date_term(value: Column) -> Column:
    return _typed(value.cast("date").cast("string"), "date")


def _parts(value: Column) -> tuple[Column, Column]:
    """Date and time of day as text; a fraction of a second has six digits."""
    plain = value.cast("timestamp_ntz").cast("string")
    fraction = F.substring(plain, 20, 7)
    fraction = F.when(fraction == "", fraction).otherwise(F.rpad(fraction, 7, "0"))
    return F.substring(plain, 1, 10), F.concat(F.substring(plain, 12, 8), fraction)


def time_term(value: Column) -> Column:
    """Time of day of a timestamp."""
    return _typed(_parts(value)[1], "time")


def datetime_text(value: Column, zone: str | None = None) -> Column:
    """ISO text; with a zone, the UTC timestamp shown in that zone with its offset."""
    if zone is None:
        return F.concat_ws("T", *_parts(value))
    utc = value.cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    shift = F.timestamp_diff("MINUTE", utc, local)
    size = F.abs(shift)
    offset = F.concat(
        F.when(shift < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )
    return F.concat(F.concat_ws("T", *_parts(local)), offset)


def datetime_term(value: Column, zone: str | None = None) -> Column:
    return _typed(datetime_text(value, zone), "dateTime")


_BY_TYPE = {
    "string": string_term,
    "boolean": bool_term,
    "tinyint": int_term,
    "smallint": int_term,
    "int": int_term,
    "bigint": int_term,
    "float": float_term,
    "double": float_term,
    "date": date_term,
    "timestamp": datetime_term,
    "timestamp_ntz": datetime_term,
}


def term(df: DataFrame, name: str) -> Column:
    """Serialise a column by its type; types without a rule become strings."""
    serialise = _BY_TYPE.get(dict(df.dtypes)[name])
    return serialise(F.col(name)) if serialise else string_term(F.col(name).cast("string"))


def lexical(obj: Column) -> Column:
    """The text of a term (STR)."""
    return obj["value"]


def language(obj: Column) -> Column:
    """The language tag of a term, empty when it has none (LANG)."""
    return F.coalesce(obj["lang"], F.lit(""))

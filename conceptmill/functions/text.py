"""String functions with Python's text rules, built from JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace is true.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       "
    "         　"
)
_VISIBLE = r"[^\s\x1c-\x1f\x85\xa0  -     　]"
# Characters for which Python's str.isprintable is false.
_UNPRINTABLE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def strip(text: Column) -> Column:
    """Remove leading and trailing blanks, Unicode blanks included."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for NULL and for text without any visible character. Looks no further than the first one."""
    return F.coalesce(~text.rlike(_VISIBLE), F.lit(True))


def _escaped_char(char: Column) -> Column:
    code = F.ascii(char)
    digits = F.lower(F.hex(code))
    return (
        F.when(~char.rlike(_UNPRINTABLE), char)
        .when(char == "\n", F.lit("\\n"))
        .when(char == "\r", F.lit("\\r"))
        .when(char == "\t", F.lit("\\t"))
        .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )


def quoted(text: Column) -> Column:
    """The text as a Python string literal (``repr``)."""
    double = text.contains("'") & ~text.contains('"')
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    body = F.when(double, body).otherwise(F.replace(body, F.lit("'"), F.lit("\\'")))
    chars = F.regexp_extract_all(body, F.lit("(?s)."), F.lit(0))
    body = F.when(
        body.rlike(_UNPRINTABLE), F.array_join(F.transform(chars, _escaped_char), "")
    ).otherwise(body)
    quote = F.when(double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(quote, body, quote)


def float_text(value: Column) -> Column:
    """A double as Python prints it: fixed notation from 1e-4 up to 1e16."""
    plain = value.cast("string")
    size = F.abs(value)
    digits = F.rtrim(plain.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    fixed = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    # Java: 1.0E-5, Python: 1e-05.
    exponent = F.regexp_extract(plain, r"E-?(\d+)$", 1)
    power = F.concat(
        F.regexp_replace(plain, r"(\.0)?E.*$", ""),
        F.when(size < 1, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(exponent) < 2, F.lit("0")).otherwise(F.lit("")),
        exponent,
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(plain == "Infinity", F.lit("inf"))
        .when(plain == "-Infinity", F.lit("-inf"))
        .when(~plain.contains("E"), plain)
        .when((size >= 1e-4) & (size < 1e16), fixed)
        .otherwise(power)
    )


# Text that Python's float() accepts.
_FLOAT = r"(?i)^[+-]?(inf(inity)?|nan|(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?)$"


def parse_float(text: Column) -> Column:
    """A number from text, NULL when Python's float() would refuse it."""
    clean = strip(text)
    return F.when(clean.rlike(_FLOAT), F.replace(clean, F.lit("_")).try_cast("double"))


def name_uuid(*parts: Column) -> Column:
    """UUID-shaped id derived from the parts, so a repeated write gives the same id.

    Each part goes in with its length and NULL as a mark of its own, so different
    parts never read the same.
    """
    marked = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    digest = F.md5(F.concat_ws("|", *marked))
    pieces = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *pieces)

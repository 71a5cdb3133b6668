import math

import pytest
from pyspark.sql import functions as F

from conceptmill.functions import rdf_terms as rdf
from conceptmill.functions import text as tx

BLANKS = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", "　"]


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_blank_list_is_pythons():
    assert all(ch.isspace() for ch in tx.BLANKS)
    assert {chr(i) for i in range(0x3001) if chr(i).isspace()} == set(tx.BLANKS)


def test_strip_and_blank_follow_python(spark):
    values = ["", "a", " a b ", "".join(BLANKS), "x".join(BLANKS), "​x​", "a\n", "\xa0é\xa0"]
    assert one(spark, values, tx.strip) == [x.strip() for x in values]
    assert one(spark, values + [None], tx.is_blank) == [not x.strip() for x in values] + [True]


def test_quoted_is_repr(spark):
    values = ["plain", "it's", 'say "x"', "both ' and \"", "back\\slash", "a\nb\tc\r", "\x00\x7f\x9f", "\xa0\xad", "​ ",
              "é😀中", "\U000e0001", "'\n\""]
    assert one(spark, values, tx.quoted) == [repr(x) for x in values]


def test_float_text_is_repr(spark):
    values = [0.0, -0.0, 1.0, 0.1, 1e-4, 1.5e-4, 9.99e-5, 1e-5, 1.25e-7, 1e7, 12345678.5, 1e15, 1.5e15, 1e16, 1.5e16, 1e22,
              1e100, -2.5e-10, -1234567.25, 5e-324 * 2**40, 0.001, 123456789012345.6]
    got = one(spark, values, tx.float_text, "double")
    assert [float(x) for x in got] == values
    assert got == [repr(x) for x in values]


def test_float_text_of_special_values(spark):
    assert one(spark, [math.inf, -math.inf, math.nan], tx.float_text, "double") == ["inf", "-inf", "nan"]


def test_parse_float_takes_what_python_takes(spark):
    values = ["0.7", " 0.7 ", ".5", "5.", "1e-3", "+2", "1_000", "inf", "-Infinity", "abc", "", "1.0d", "0.5f", "1__0", "0x1", "1e", "\xa03\xa0"]

    def python(x):
        try:
            return float(x)
        except ValueError:
            return None

    assert one(spark, values, tx.parse_float) == [python(x) for x in values]


def test_name_uuid_is_stable(spark):
    got = spark.range(1).select(tx.name_uuid(F.lit("a"), F.lit("b"))).first()[0]
    assert got == spark.range(1).select(tx.name_uuid(F.lit("a"), F.lit("b"))).first()[0]
    assert [len(x) for x in got.split("-")] == [8, 4, 4, 4, 12]


@pytest.mark.parametrize(
    "expression, build, expected",
    [
        ("42", rdf.int_term, '"42"^^xsd:integer'),
        ("CAST(0.5 AS DOUBLE)", rdf.float_term, '"0.5"^^xsd:float'),
        ("true", rdf.bool_term, '"true"^^xsd:boolean'),
        ("false", rdf.bool_term, '"false"^^xsd:boolean'),
        ("date'2024-02-29'", rdf.date_term, '"2024-02-29"^^xsd:date'),
        ("timestamp_ntz'2024-01-02 03:04:05'", rdf.datetime_term, '"2024-01-02T03:04:05"^^xsd:dateTime'),
        ("timestamp_ntz'2024-01-02 03:04:05.5'", rdf.datetime_term, '"2024-01-02T03:04:05.500000"^^xsd:dateTime'),
        ("timestamp_ntz'2024-01-02 03:04:05.25'", rdf.time_term, '"03:04:05.250000"^^xsd:time'),
    ],
)
def test_terms(spark, expression, build, expected):
    assert spark.range(1).select(build(F.expr(expression))).first()[0] == expected


def test_string_and_uri_escapes(spark):
    value = "a\\b'c\"d<e>"
    got = spark.createDataFrame([(value,)], "x string").select(rdf.string_term(F.col("x")), rdf.uri_term(F.col("x"))).first()
    assert got[0] == '"""a\\\\b\\\'c\\"d<e>"""'
    assert got[1] == '<a\\\\b\'c\\"d\\<e\\>>'


def test_zoned_datetime(spark):
    df = spark.range(1).select(
        rdf.datetime_text(F.expr("timestamp_ntz'2024-01-15 10:00:00'"), "Europe/Brussels"),
        rdf.datetime_text(F.expr("timestamp_ntz'2024-07-15 23:30:00'"), "Europe/Brussels"),
        rdf.datetime_text(F.expr("timestamp_ntz'2024-07-15 10:00:00'"), "America/St_Johns"),
    )
    assert tuple(df.first()) == ("2024-01-15T11:00:00+01:00", "2024-07-16T01:30:00+02:00", "2024-07-15T07:30:00-02:30")


def test_term_chooses_by_type(spark):
    df = spark.sql("SELECT true AS b, 3 AS i, 'x' AS s, date'2024-01-01' AS d, CAST(1.5 AS DECIMAL(3,1)) AS other")
    got = df.select(*[rdf.term(df, n).alias(n) for n in df.columns]).first()
    assert got.asDict() == {
        "b": '"true"^^xsd:boolean', "i": '"3"^^xsd:integer', "s": '"""x"""', "d": '"2024-01-01"^^xsd:date', "other": '"""1.5"""',
    }


def test_name_uuid_tells_parts_apart(spark):
    null = F.lit(None).cast("string")
    parts = [("a|b", "c"), ("a", "b|c"), ("a", None, "b"), ("a", "b", None), ("a", "b"), ("", "ab"), ("-",), (None,)]
    ids = spark.range(1).select(*[tx.name_uuid(*(null if x is None else F.lit(x) for x in p)) for p in parts]).first()
    assert len(set(ids)) == len(parts)

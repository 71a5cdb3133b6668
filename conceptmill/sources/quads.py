"""Reading and writing quads: tables and N-Quads text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill.operators import graph as q
from conceptmill.sources.keyed import KeyedTable

PARTITIONS = ("p",)
_KEYS = ["g", "s", "p", "o"]


def read_quads(spark: SparkSession, path: str) -> DataFrame:
    """Quad table. Patterns have constant predicates, so a scan reads their partitions only."""
    return spark.read.schema(q.QUAD_SCHEMA).parquet(path)


def write_quads(quads: DataFrame, path: str, partition_by: Iterable[str] = PARTITIONS) -> None:
    """Write a new quad table. A graph is a set, so equal quads are written once.

    The rebalance puts rare predicates into one file and lets AQE split frequent
    ones into files of the advised size.
    """
    _balanced(quads.select(*_KEYS).distinct(), partition_by).write.mode("error").partitionBy(*partition_by).parquet(path)


def _balanced(quads: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    return quads.hint("rebalance", *partition_by)


def missing_quads(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Quads of ``new`` that ``existing`` lacks.

    Terms are compared null-safe: an untagged literal equals an untagged one.
    """
    # A digest stands for the term, so stored texts stay out of the shuffle.
    key = F.sha2(F.to_json(F.col("o")), 256)
    fresh = new.select(*_KEYS).distinct().withColumn("_o", key)
    # Predicates are a vocabulary, a short list: only their partitions are read.
    predicates = [row["p"] for row in new.select("p").distinct().collect()]
    stored = existing.where(F.col("p").isin(predicates)).select("g", "s", "p", key.alias("_o"))
    on = ["g", "s", "p", "_o"]
    hits = stored.join(fresh.select(*on), on, "left_semi")
    return fresh.join(hits, on, "left_anti").select(*_KEYS)


def quad_table(path: str, partition_by: Iterable[str] = PARTITIONS) -> KeyedTable:
    """The quads at the path as a set, with an index of digests beside them."""
    return KeyedTable(path, q.QUAD_SCHEMA, _KEYS, _KEYS, tuple(partition_by), hashed=True)


def append_quads(new: DataFrame, path: str, partition_by: Iterable[str] = PARTITIONS) -> None:
    """Add quads to a table; those already there are left alone.

    Known quads are found in the index of ``quad_table``; stored terms are read once, when a table
    without an index gets its first append.
    """
    quad_table(path, partition_by).append(new)


def without_graphs(quads: DataFrame, graphs: Iterable[str]) -> DataFrame:
    """The quads that stay when whole graphs are deleted."""
    return quads.where(~F.col("g").isin(list(graphs)))


# --- N-Quads ------------------------------------------------------------------

_IRI = r"<([^>]*)>"
_NODE = r"(?:<[^>]*>|_:\S+)"
# A literal ends at the last quote that a valid rest of the line follows. The
# patterns repeat single characters only, so texts of any length match.
_HEAD = rf"(?s)^\s*({_NODE})\s+({_NODE})\s+(.*)$"
_END = rf"\s*({_NODE})?\s*\.\s*(?:#.*)?$"
_LITERAL_REST = rf'(?s)^"(.*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?{_END}'
_NODE_REST = rf"(?s)^({_NODE}){_END}"


def _unescape(text: Column) -> Column:
    r"""Resolve backslash escapes; \\ first splits the text, so pairs are read from the left."""

    def piece(x: Column) -> Column:
        for mark, char in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\b", "\b"), ("\\f", "\f"), ('\\"', '"'), ("\\'", "'")):
            x = F.replace(x, F.lit(mark), F.lit(char))
        return x

    def coded(x: Column, mark: str, digits: int) -> Column:
        parts = F.split(x, mark)
        done = F.transform(
            F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
            lambda y: F.concat(
                F.decode(F.unhex(F.lpad(F.left(y, F.lit(digits)), 8, "0")), "UTF-32"),
                F.substring(y, F.lit(digits + 1), F.length(y)),
            ),
        )
        return F.concat(F.get(parts, F.lit(0)), F.array_join(done, ""))

    plain = F.array_join(
        F.transform(F.split(text, r"\\\\"), lambda x: piece(coded(coded(x, r"\\U", 8), r"\\u", 4))), "\\"
    )
    return F.when(text.contains("\\"), plain).otherwise(text)


def _node(text: Column) -> Column:
    return F.when(text.startswith("<"), _unescape(F.regexp_extract(text, _IRI, 1))).otherwise(text)


def parse_nquads(lines: DataFrame, line: str = "value", default_graph: str = "") -> DataFrame:
    """Quads from N-Quads lines; blank lines and comments give none.

    A line that is neither is an error, not a lost row.
    """
    text = F.col(line)
    content = lines.where(~text.rlike(r"^\s*(#.*)?$"))
    rest = F.regexp_extract(text, _HEAD, 3)
    literal = rest.startswith('"')
    parts = content.select(
        text.alias("line"),
        F.regexp_extract(text, _HEAD, 1).alias("s"),
        F.regexp_extract(text, _HEAD, 2).alias("p"),
        literal.alias("literal"),
        F.when(literal, rest.rlike(_LITERAL_REST)).otherwise(rest.rlike(_NODE_REST)).alias("valid"),
        F.when(literal, F.regexp_extract(rest, _LITERAL_REST, 1)).otherwise(F.regexp_extract(rest, _NODE_REST, 1)).alias("o"),
        F.when(literal, F.regexp_extract(rest, _LITERAL_REST, 2)).alias("lang"),
        F.when(literal, F.regexp_extract(rest, _LITERAL_REST, 3)).alias("datatype"),
        F.when(literal, F.regexp_extract(rest, _LITERAL_REST, 4)).otherwise(F.regexp_extract(rest, _NODE_REST, 2)).alias("g"),
    )
    refused = F.raise_error(F.concat(F.lit("not an N-Quads line: "), F.col("line"))).cast("boolean")
    # A filter runs whatever columns are read later.
    return parts.where(F.when(F.col("valid"), F.lit(True)).otherwise(refused)).select(
        F.when(F.col("g") == "", F.lit(default_graph)).otherwise(_node(F.col("g"))).alias("g"),
        _node(F.col("s")).alias("s"),
        _node(F.col("p")).alias("p"),
        F.struct(
            F.when(F.col("literal"), _unescape(F.col("o"))).otherwise(_node(F.col("o"))).alias("value"),
            F.when(F.col("literal"), F.lit("literal"))
            .when(F.col("o").startswith("_:"), F.lit("bnode"))
            .otherwise(F.lit("uri"))
            .alias("kind"),
            F.nullif(F.col("lang"), F.lit("")).alias("lang"),
            F.nullif(_unescape(F.col("datatype")), F.lit("")).alias("datatype"),
        ).alias("o"),
    )


def read_nquads(spark: SparkSession, path: str, default_graph: str = "") -> DataFrame:
    return parse_nquads(spark.read.text(path), default_graph=default_graph)


def nquads_lines(quads: DataFrame) -> DataFrame:
    """One N-Quads line per quad."""

    def escaped(text: Column) -> Column:
        for char, mark in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(char), F.lit(mark))
        return text

    def coded(text: Column) -> Column:
        plain = text
        for char in (*(chr(i) for i in range(0x21)), *'"<>^`{|}'):
            plain = F.replace(plain, F.lit(char), F.lit(f"\\u{ord(char):04X}"))
        return plain

    def iri(text: Column) -> Column:
        odd = F.replace(text, F.lit("\\"), F.lit("\\u005C"))
        return F.when(text.rlike(r'[\x00-\x20"<>^`{|}\\]'), coded(odd)).otherwise(text)

    def node(text: Column) -> Column:
        return F.when(text.startswith("_:"), text).otherwise(F.concat(F.lit("<"), iri(text), F.lit(">")))

    tag = F.coalesce(
        F.concat(F.lit("@"), F.col("o.lang")), F.concat(F.lit("^^<"), iri(F.col("o.datatype")), F.lit(">")), F.lit("")
    )
    obj = F.when(F.col("o.kind") == "literal", F.concat(F.lit('"'), escaped(F.col("o.value")), F.lit('"'), tag)).otherwise(
        node(F.col("o.value"))
    )
    graph = F.when(F.col("g") == "", F.lit("")).otherwise(F.concat(F.lit(" "), node(F.col("g"))))
    return quads.select(
        F.concat(node(F.col("s")), F.lit(" "), node(F.col("p")), F.lit(" "), obj, graph, F.lit(" .")).alias("value")
    )


def write_nquads(quads: DataFrame, path: str) -> None:
    nquads_lines(quads).write.mode("error").text(path)

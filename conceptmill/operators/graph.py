"""Relational algebra over quads ``(g, s, p, o)``.

A pattern gives one column per variable; patterns are combined with ordinary
DataFrame joins on the shared column names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill.vocab import TYPE

QUAD_SCHEMA = "g string, s string, p string, o struct<value:string,kind:string,lang:string,datatype:string>"


def term(value: Column, kind: str = "uri", lang: Column | None = None, datatype: str | None = None) -> Column:
    """An RDF term as a struct."""
    text = F.lit(None).cast("string")
    return F.struct(
        value.alias("value"),
        F.lit(kind).alias("kind"),
        (text if lang is None else lang).alias("lang"),
        (text if datatype is None else F.lit(datatype)).alias("datatype"),
    )


def quad(graph: Column | str, subject: Column, predicate: str, obj: Column) -> list[Column]:
    """Column list for ``select`` that turns rows into quads."""
    g = F.lit(graph) if isinstance(graph, str) else graph
    return [g.alias("g"), subject.alias("s"), F.lit(predicate).alias("p"), obj.alias("o")]


def _one_of(column: Column, values: str | Iterable[str]) -> Column:
    return column == values if isinstance(values, str) else column.isin(list(values))


def rows(
    quads: DataFrame,
    p: str | Iterable[str],
    *,
    value: str | Iterable[str] | None = None,
    graphs: str | Iterable[str] | None = None,
) -> DataFrame:
    """Quads with a constant predicate and optionally constant object URIs and graphs.

    Several predicates form a property-path alternation.
    """
    found = quads.where(_one_of(F.col("p"), p))
    if graphs is not None:
        found = found.where(_one_of(F.col("g"), graphs))
    if value is not None:
        found = found.where(_one_of(F.col("o.value"), value) & (F.col("o.kind") == "uri"))
    return found


def pattern(
    quads: DataFrame,
    p: str | Iterable[str],
    s: str,
    o: str | None = None,
    *,
    g: str | None = None,
    value: str | Iterable[str] | None = None,
    graphs: str | Iterable[str] | None = None,
) -> DataFrame:
    """Solutions of one triple pattern as columns ``s``, ``o`` and, if named, ``g``.

    With ``g`` every graph gives its own solution (GRAPH ?g). Without it the
    graphs are merged and equal triples count once; a single constant graph
    needs no merging, because a graph is already a set. Terms that differ only
    in language or datatype stay separate rows.
    """
    found = rows(quads, p, value=value, graphs=graphs)
    keep = [F.col("s").alias(s)]
    if g is not None:
        keep.insert(0, F.col("g").alias(g))
    if o is not None:
        keep.append(F.col("o").alias(o))
    found = found.select(*keep)
    merged = g is None and not isinstance(graphs, str)
    if merged or not isinstance(p, str) or not (value is None or isinstance(value, str)):
        found = found.distinct()
    if o is not None:
        found = found.withColumn(o, F.col(f"{o}.value"))
    return found


def instances(quads: DataFrame, cls: str | Iterable[str], s: str, **where) -> DataFrame:
    """Subjects typed with the class (or one of the classes)."""
    return pattern(quads, TYPE, s, value=cls, **where)


def optional(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """OPTIONAL: keep left rows, unbound right columns become NULL.

    A filter inside the OPTIONAL goes on ``right`` before the call.
    """
    return left.join(right, on, "left")


def exists(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left_semi")


def not_exists(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def first_value(solutions: DataFrame, key: str, column: str) -> DataFrame:
    """One value per key. Solutions have no order, so the smallest one is taken."""
    return solutions.groupBy(key).agg(F.min(column).alias(column))


def ask(solutions: DataFrame) -> bool:
    return not solutions.isEmpty()


def count(solutions: DataFrame, column: str, by: list[str], name: str = "n") -> DataFrame:
    """COUNT(?x) per key: bound values, duplicates included."""
    return solutions.groupBy(*by).agg(F.count(column).alias(name))

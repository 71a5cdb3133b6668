"""Assembly of the text of a decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill.operators import graph as q


def join_nonempty(*names: str, separator: str = "\n") -> Column:
    """Join the columns that are neither NULL nor empty."""
    return F.concat_ws(separator, *[F.nullif(F.col(name), F.lit("")) for name in names])


def path_values(quads: DataFrame, path: str | Sequence[str | Sequence[str]]) -> DataFrame:
    """(g, source, value) along a property path inside one graph.

    ``path`` is a predicate or a list of steps; a step is a predicate or a list
    of alternative predicates, each of which gives its own solution.
    """
    steps = [path] if isinstance(path, str) else list(path)
    found = None
    for step in steps:
        predicates = [step] if isinstance(step, str) else list(step)
        links = q.rows(quads, predicates).select("g", F.col("s").alias("from"), F.col("o.value").alias("to"))
        if found is None:
            found = links.withColumnsRenamed({"from": "source", "to": "value"})
        else:
            found = (
                found.withColumnRenamed("value", "from")
                .join(links, ["g", "from"])
                .select("g", "source", F.col("to").alias("value"))
            )
    return found


def text_by_path(quads: DataFrame, decisions: DataFrame, path: str | Sequence[str | Sequence[str]]) -> DataFrame:
    """(decision, text): all values of the path, once per graph, one per line.

    Values have no order in a graph; they are sorted. No value gives ''.
    """
    values = path_values(quads, path).withColumnRenamed("source", "decision")
    values = values.join(decisions.select("decision"), "decision", "left_semi")
    texts = values.groupBy("decision").agg(
        F.array_join(F.array_sort(F.collect_list("value")), "\n").alias("text")
    )
    return decisions.join(texts, "decision", "left").select(
        "decision", F.coalesce("text", F.lit("")).alias("text")
    )


def text_of_decisions(
    quads: DataFrame, decisions: DataFrame, path: str | Sequence[str | Sequence[str]] | None, default: DataFrame
) -> DataFrame:
    """(decision, text) from the job's property path or, without one, from ``default``."""
    if path is not None:
        return text_by_path(quads, decisions, path)
    return decisions.join(default, "decision", "left").select(
        "decision", F.coalesce("text", F.lit("")).alias("text")
    )

"""Codelists: reading, listing and resolving labels.

A codelist is a DataFrame ``(scheme, uri, label, definition)``. Its entries are
ordered by ``ord`` if that column exists, otherwise by (uri, label).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.functions.rdf_terms import language
from conceptmill.functions.text import quoted, strip
from conceptmill.operators import graph as q
from conceptmill.operators.skew import spread_join, with_ordinal


def _order(codelist: DataFrame) -> Column:
    return F.col("ord") if "ord" in codelist.columns else F.struct("uri", "label")


def codelist_entries(
    quads: DataFrame, scheme: str | None = None, *, languages: Iterable[str] = v.LABEL_LANGUAGES
) -> DataFrame:
    """(scheme, uri, label, definition) of one scheme or of all schemes.

    Only labels and definitions in one of the languages count, ``''`` meaning
    untagged text. Several matching labels or definitions give several rows.
    """
    languages = list(languages)
    members = q.pattern(quads, v.IN_SCHEME, "uri", "scheme", value=scheme)

    def texts(predicate: str, name: str) -> DataFrame:
        wanted = q.rows(quads, predicate).where(language(F.col("o")).isin(languages))
        return wanted.select(F.col("s").alias("uri"), "o").distinct().select("uri", F.col("o.value").alias(name))

    entries = members.join(texts(v.PREF_LABEL, "label"), "uri")
    entries = q.optional(entries, texts(v.DEFINITION, "definition"), ["uri"])
    return entries.select("scheme", "uri", "label", "definition")


def codelist_of_scheme(quads: DataFrame, scheme: str, *, allow_empty: bool = False) -> DataFrame:
    """Entries of a scheme; an empty scheme is an error unless allowed."""
    entries = codelist_entries(quads, scheme)
    if not allow_empty and entries.isEmpty():
        raise RuntimeError(f"no concepts found for concept scheme {scheme}")
    return entries


def with_positions(codelist: DataFrame) -> DataFrame:
    """Add ``ord``, the 0-based position of an entry in its scheme."""
    return with_ordinal(codelist, ["uri", "label", "definition"], "scheme")


def label_variants(codelist: DataFrame) -> DataFrame:
    """(scheme, key, uri): label, lower-case and underscored forms; later entries win."""
    under = F.replace(F.col("label"), F.lit(" "), F.lit("_"))
    keys = F.array_distinct(F.array(F.col("label"), F.lower("label"), under, F.lower(under)))
    return (
        codelist.withColumn("_order", _order(codelist))
        .select("scheme", "uri", "_order", F.explode(keys).alias("key"))
        .groupBy("scheme", "key")
        .agg(F.max_by("uri", "_order").alias("uri"))
    )


def label_prefixes(codelist: DataFrame) -> DataFrame:
    """(scheme, key, uri): every prefix of the lower-case labels; the first entry wins.

    Turns "starts with" into an equality, so the fallback is an equi-join. The
    empty prefix belongs to the first entry.
    """
    lowered = codelist.select("scheme", "uri", _order(codelist).alias("_order"), F.lower("label").alias("low"))
    lengths = F.sequence(F.lit(0), F.length("low"))
    return (
        lowered.select("scheme", "uri", "_order", "low", F.explode(lengths).alias("size"))
        .select("scheme", "uri", "_order", F.substring(F.col("low"), F.lit(1), F.col("size")).alias("key"))
        .groupBy("scheme", "key")
        .agg(F.min_by("uri", "_order").alias("uri"))
    )


def uri_labels(codelist: DataFrame) -> DataFrame:
    """(uri, name): the last label of each concept."""
    return (
        codelist.withColumn("_order", _order(codelist))
        .groupBy("uri")
        .agg(F.max_by("label", "_order").alias("name"))
    )


def resolve_labels(labels: DataFrame, codelist: DataFrame, *, prefix: bool = True) -> DataFrame:
    """(scheme, label, uri) for each distinct (scheme, label), unresolved ones with NULL.

    The label is tried as it is, with spaces for underscores, in lower case and
    both; then, with ``prefix``, as the beginning of a label. Candidates carry
    their rank and meet the codelist in one join.
    """
    spaced = F.replace(F.col("label"), F.lit("_"), F.lit(" "))
    exact = [F.col("label"), spaced, F.lower("label"), F.lower(spaced)]
    tries = [F.struct(F.lit(False).alias("cut"), key.alias("key")) for key in exact]
    known = label_variants(codelist).where(F.col("uri") != "").withColumn("cut", F.lit(False))
    if prefix:
        tries.append(F.struct(F.lit(True).alias("cut"), strip(F.lower(spaced)).alias("key")))
        known = known.unionByName(label_prefixes(codelist).withColumn("cut", F.lit(True)))
    wanted = labels.select("scheme", "label").distinct()
    candidates = wanted.select("scheme", "label", F.posexplode(F.array(*tries)).alias("rank", "try")).select(
        "scheme", "label", "rank", "try.cut", "try.key"
    )
    return (
        candidates.join(known, ["scheme", "cut", "key"], "left")
        .groupBy("scheme", "label")
        .agg(F.min_by("uri", F.when(F.col("uri").isNotNull(), F.col("rank"))).alias("uri"))
    )


def fan_out(replies: DataFrame, codelist: DataFrame) -> DataFrame:
    """(scheme, decision, label, uri): one row per returned class, NULL if unresolved.

    ``replies`` is (scheme, decision, classes). Labels are resolved once per
    distinct value, whatever number of decisions carries them.
    """
    given = replies.select("scheme", "decision", F.explode("classes").alias("label"))
    found = resolve_labels(given, codelist)
    return spread_join(given, found, ["scheme", "label"], "left", spread=["decision"])


def classes_to_labels(labelled: DataFrame, codelist: DataFrame) -> DataFrame:
    """(decision, classes, names): class URIs and their labels; unknown URIs stay.

    One row per distinct (decision, classes); order and repetition are kept.
    """
    pairs = labelled.select("decision", "classes").distinct()
    given = pairs.select("decision", "classes", F.posexplode_outer("classes").alias("place", "uri"))
    named = spread_join(given, uri_labels(codelist), ["uri"], "left", spread=["decision"])
    piece = F.when(F.col("uri").isNotNull(), F.struct("place", F.coalesce("name", "uri").alias("name")))
    return named.groupBy("decision", "classes").agg(
        F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["name"]).alias("names")
    )


def codelist_prompt(codelist: DataFrame) -> DataFrame:
    """(scheme, labels, code_list): the ordered labels and their text for a prompt.

    The text is the label list, followed by a label-to-definition mapping when
    any entry has a definition. Of equal labels the mapping keeps the place of
    the first and the definition of the last. One row holds a whole codelist,
    as one prompt does.
    """
    entries = codelist.withColumn("_order", _order(codelist))
    listed = entries.groupBy("scheme").agg(F.array_sort(F.collect_list(F.struct("_order", "label"))).alias("pairs"))
    listed = listed.select("scheme", F.transform("pairs", lambda x: x["label"]).alias("labels"))
    defined = (
        entries.where(F.coalesce(F.col("definition"), F.lit("")) != "")
        .groupBy("scheme", "label")
        .agg(
            F.min("_order").alias("place"),
            F.max_by("definition", F.struct("_order", "definition")).alias("definition"),
        )
        .groupBy("scheme")
        .agg(F.array_sort(F.collect_list(F.struct("place", "label", "definition"))).alias("definitions"))
    )
    label_list = F.concat(F.lit("["), F.array_join(F.transform("labels", quoted), ", "), F.lit("]"))
    pairs = F.transform("definitions", lambda x: F.concat(quoted(x["label"]), F.lit(": "), quoted(x["definition"])))
    mapping = F.concat(F.lit("\n\nLabel descriptions:\n{"), F.array_join(pairs, ", "), F.lit("}"))
    return listed.join(defined, "scheme", "left").select(
        "scheme", "labels", F.concat(label_list, F.coalesce(mapping, F.lit(""))).alias("code_list")
    )

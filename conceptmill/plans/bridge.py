"""Domain tables derived from the given test tables.

Each rule is SQL text that Spark and DuckDB read alike, so a query and its
check start from the same quads.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators.graph import QUAD_SCHEMA
from conceptmill.session import scratch_path

DECISIONS = "http://ex/graphs/decisions"
MIRROR = "http://ex/graphs/mirror"
JOBS, CONTAINERS = v.GRAPHS["jobs"], v.GRAPHS["data_containers"]
AI, PUBLIC = v.GRAPHS["ai"], v.GRAPHS["public"]
QUALITY = "http://ex/scheme/quality"
TASK = "http://ex/task/quality"
IMPACT_TASK = "http://ex/task/impact"
BAD_TASK = "http://ex/task/bad"
HIGH, LOW, TOXIC, VOID = (f"http://ex/concept/{name}" for name in ("high", "low", "toxic", "void"))

DOC = "concat('http://ex/doc/', doc_id)"
PART = "concat('http://ex/part/', p_partkey)"
BRAND = "concat('http://ex/brand/', replace(p_brand, '#', '-'))"
PART_LABEL = (
    "CASE WHEN p_partkey % 9 = 0 THEN concat(p_name, ' d', chr(39), 'or') "
    "WHEN p_partkey % 10 = 0 THEN concat(p_name, ' ', chr(34), p_type, chr(34)) "
    "ELSE concat(upper(substr(p_name, 1, 1)), substr(p_name, 2)) END"
)
WANTED_LABEL = (
    f"CASE p_partkey % 7 WHEN 0 THEN {PART_LABEL} WHEN 1 THEN replace({PART_LABEL}, ' ', '_') "
    f"WHEN 2 THEN upper({PART_LABEL}) WHEN 3 THEN substr({PART_LABEL}, 1, 4) "
    f"WHEN 4 THEN concat(' ', lower({PART_LABEL}), ' ') WHEN 5 THEN concat(substr({PART_LABEL}, 1, 3), 'zz') "
    "ELSE '' END"
)


@dataclass(frozen=True)
class Rule:
    """One kind of quad: table, graph, subject, predicate and object as SQL text."""

    table: str
    g: str
    s: str
    p: str
    o: str
    kind: str = "uri"
    lang: str = "CAST(NULL AS VARCHAR(32))"
    where: str = "true"
    distinct: bool = False


def _text(value: str) -> str:
    return f"'{value}'"


def _lit(table, g, s, p, o, **more) -> Rule:
    return Rule(table, g, s, p, o, kind="literal", **more)


_QUALITY_BODY = f"CASE WHEN quality = 1 THEN '{HIGH}' ELSE '{LOW}' END"
_FIRST = "r_regionkey = 0"

RULES: dict[str, list[Rule]] = {
    "docs": [
        Rule("documents", DECISIONS, DOC, v.TYPE, _text(v.EXPRESSION)),
        _lit("documents", DECISIONS, DOC, v.CONTENT, "text", lang="lang"),
        Rule("documents", DECISIONS, DOC, v.LANGUAGE, "concat('http://ex/lang/', lang)"),
        Rule("documents", DECISIONS, DOC, v.DCT_LANGUAGE, "concat('http://ex/lang/', lang)"),
        _lit("documents", DECISIONS, DOC, v.TITLE, "CASE WHEN doc_id % 10 = 4 THEN '' ELSE split_part(text, chr(10), 1) END", where="doc_id % 2 = 0"),
        _lit("documents", DECISIONS, DOC, v.DESCRIPTION, "concat('source: ', source)", where="doc_id % 5 = 0"),
        _lit("documents", DECISIONS, DOC, v.DESCRIPTION, "concat('chars: ', n_chars)", lang="'en'", where="doc_id % 15 = 0"),
        _lit("documents", DECISIONS, DOC, v.DECISION_BASIS, "concat('basis ', doc_id % 3)", where="doc_id % 7 = 0"),
        Rule("documents", MIRROR, DOC, v.TYPE, _text(v.EXPRESSION), where="doc_id % 11 = 0"),
        _lit("documents", MIRROR, DOC, v.CONTENT, "text", lang="lang", where="doc_id % 11 = 0"),
        Rule("documents", DECISIONS, "concat('http://ex/work/', source)", v.REALIZED_BY, DOC),
        Rule("documents", DECISIONS, "concat('http://ex/work/', source)", v.TYPE, _text(v.WORK), distinct=True),
    ],
    "anns": [
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/quality')", v.TYPE, _text(v.ANNOTATION)),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/quality')", v.HAS_TARGET, DOC),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/quality')", v.MOTIVATED_BY, f"CASE WHEN doc_id % 13 = 0 THEN '{v.OA}linking' ELSE '{v.CLASSIFYING}' END"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/quality')", v.HAS_BODY, _QUALITY_BODY),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/quality')", v.HAS_BODY, _text(v.IMPACT_URIS["positive"]), where="doc_id % 17 = 0"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/toxic')", v.TYPE, _text(v.ANNOTATION), where="toxic = 1"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/toxic')", v.HAS_TARGET, DOC, where="toxic = 1"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/toxic')", v.MOTIVATED_BY, _text(v.CLASSIFYING), where="toxic = 1"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/toxic')", v.HAS_BODY, _text(TOXIC), where="toxic = 1"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/void')", v.TYPE, _text(v.ANNOTATION), where="doc_id % 19 = 0"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/void')", v.HAS_TARGET, DOC, where="doc_id % 19 = 0"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/void')", v.MOTIVATED_BY, _text(v.CLASSIFYING), where="doc_id % 19 = 0"),
        Rule("labels", AI, "concat('http://ex/ann/', doc_id, '/void')", v.HAS_BODY, _text(VOID), where="doc_id % 19 = 0"),
        Rule("labels", AI, "concat('http://ex/activity/', doc_id)", v.TYPE, _text(v.ACTIVITY), where="doc_id % 3 <> 0"),
        Rule("labels", AI, "concat('http://ex/activity/', doc_id)", v.GENERATED, "concat('http://ex/ann/', doc_id, '/quality')", where="doc_id % 3 <> 0"),
    ],
    "concepts": [
        Rule("labels", PUBLIC, _QUALITY_BODY, v.TYPE, _text(v.CONCEPT), distinct=True),
        Rule("labels", PUBLIC, _QUALITY_BODY, v.IN_SCHEME, _text(QUALITY), distinct=True),
        _lit("labels", PUBLIC, _QUALITY_BODY, v.PREF_LABEL, "CASE WHEN quality = 1 THEN 'High quality' ELSE 'Low quality' END", lang="CASE WHEN quality = 1 THEN 'en' END", distinct=True),
        _lit("labels", PUBLIC, _QUALITY_BODY, v.PREF_LABEL, "CASE WHEN quality = 1 THEN 'Hoge kwaliteit' ELSE 'Lage kwaliteit' END", lang="'nl'", distinct=True),
        _lit("labels", PUBLIC, _QUALITY_BODY, v.DEFINITION, "CASE WHEN quality = 1 THEN 'A text that reads well' ELSE concat('A ', chr(34), 'poor', chr(34), ' text') END", lang="CASE WHEN quality = 1 THEN 'en' END", distinct=True),
        Rule("labels", PUBLIC, _text(TOXIC), v.TYPE, _text(v.CONCEPT), where="toxic = 1", distinct=True),
        Rule("labels", PUBLIC, _text(TOXIC), v.IN_SCHEME, _text(QUALITY), where="toxic = 1", distinct=True),
        _lit("labels", PUBLIC, _text(TOXIC), v.PREF_LABEL, "'Toxic'", lang="'en'", where="toxic = 1", distinct=True),
        _lit("labels", PUBLIC, _text(TOXIC), v.PREF_LABEL, "'toxic'", where="toxic = 1", distinct=True),
        _lit("labels", PUBLIC, _text(TOXIC), v.DEFINITION, "'giftig'", lang="'nl'", where="toxic = 1", distinct=True),
        Rule("labels", PUBLIC, _text(VOID), v.TYPE, _text(v.CONCEPT), where="doc_id % 19 = 0", distinct=True),
        Rule("labels", PUBLIC, _text(VOID), v.IN_SCHEME, _text(QUALITY), where="doc_id % 19 = 0", distinct=True),
        _lit("labels", PUBLIC, _text(VOID), v.PREF_LABEL, "'leeg'", lang="'nl'", where="doc_id % 19 = 0", distinct=True),
        Rule("labels", AI, _text(VOID), v.TYPE, _text(v.NO_MATCH_CLASS), where="doc_id % 19 = 0", distinct=True),
        Rule("labels", AI, _text(HIGH), v.IN_SCHEME, _text(QUALITY), where="quality = 1", distinct=True),
        Rule("labels", AI, _text(HIGH), v.FOR_SCHEME, _text(QUALITY), where="quality = 1", distinct=True),
        Rule("labels", AI, _text(LOW), v.FOR_SCHEME, _text(QUALITY), where="quality = 0", distinct=True),
    ],
    "parts": [
        Rule("part", PUBLIC, PART, v.TYPE, _text(v.CONCEPT)),
        Rule("part", PUBLIC, PART, v.IN_SCHEME, BRAND),
        Rule("part", MIRROR, PART, v.IN_SCHEME, BRAND, where="p_size > 40"),
        _lit("part", PUBLIC, PART, v.PREF_LABEL, PART_LABEL, lang="CASE p_partkey % 5 WHEN 0 THEN 'en' WHEN 2 THEN 'en-GB' WHEN 3 THEN 'nl' WHEN 4 THEN 'en' END"),
        _lit("part", PUBLIC, PART, v.PREF_LABEL, f"concat({PART_LABEL}, ' II')", where="p_partkey % 8 = 0"),
        _lit("part", PUBLIC, PART, v.DEFINITION, "CASE WHEN p_size > 45 THEN '' ELSE concat('A ', p_type, ' part') END", lang="CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 2 THEN 'fr' END", where="p_size > 25"),
    ],
    "nations": [
        Rule("nation", PUBLIC, "concat('http://ex/nation/', n_nationkey)", v.TYPE, _text(v.CONCEPT)),
        Rule("nation", PUBLIC, "concat('http://ex/nation/', n_nationkey)", v.IN_SCHEME, "concat('http://ex/region/', n_regionkey)"),
        _lit("nation", PUBLIC, "concat('http://ex/nation/', n_nationkey)", v.PREF_LABEL, "replace(n_name, '_', ' ')"),
    ],
    "jobs": [
        Rule("customer", JOBS, "concat('http://ex/task/c', c_custkey)", v.PART_OF, "concat('http://ex/job/', c_custkey % 500)"),
        Rule("customer", MIRROR, "concat('http://ex/task/c', c_custkey)", v.PART_OF, "concat('http://ex/job/', c_custkey % 7)", where="c_custkey % 9 = 0"),
        Rule("customer", JOBS, "concat('http://ex/job/', c_custkey % 500)", v.JOB_CODELIST, "concat('http://ex/region/', c_nationkey % 5)", where="c_custkey % 4 <> 0", distinct=True),
        Rule("customer", "http://ex/graphs/other", "concat('http://ex/job/', c_custkey % 500)", v.JOB_TARGET_GRAPH, "concat('http://ex/graphs/', lower(c_mktsegment))", where="c_custkey % 3 <> 0", distinct=True),
        Rule("customer", JOBS, "concat('http://ex/job/', c_custkey % 500)", v.JOB_SHAPE, "concat('http://ex/shape/', c_nationkey)", distinct=True),
        Rule("nation", PUBLIC, "concat('http://ex/shape/', n_nationkey)", v.TARGET_NODE, "concat('http://ex/doc/', n_regionkey)", where="n_nationkey % 2 = 0"),
        Rule("nation", PUBLIC, "concat('http://ex/shape/', n_nationkey)", v.TARGET_CLASS, "concat('http://ex/class/', n_regionkey)", where="n_nationkey % 3 = 0"),
        Rule("customer", JOBS, "concat('http://ex/job/', c_custkey % 500)", v.JOB_TEXT_PATH, f"CASE WHEN c_custkey % 5 = 0 THEN 'javascript:x' ELSE '{v.CONTENT}' END", where="c_custkey % 6 = 0", distinct=True),
        _lit("customer", JOBS, "concat('http://ex/job/', c_custkey % 500)", v.JOB_THRESHOLD, "CASE c_custkey % 6 WHEN 0 THEN ' 0.7 ' WHEN 1 THEN 'abc' WHEN 2 THEN '.25' WHEN 3 THEN '7e-1' WHEN 4 THEN '0.5f' ELSE '' END", where="c_custkey % 2 = 0 OR c_custkey % 3 = 0", distinct=True),
    ],
    "task": [
        Rule("region", JOBS, _text(TASK), v.PART_OF, "'http://ex/job/quality'", where=_FIRST),
        Rule("region", JOBS, "'http://ex/job/quality'", v.JOB_CODELIST, _text(QUALITY), where=_FIRST),
        Rule("region", JOBS, "'http://ex/job/quality'", v.JOB_TARGET_GRAPH, _text(DECISIONS), where=_FIRST),
        _lit("region", JOBS, "'http://ex/job/quality'", v.JOB_THRESHOLD, "' 0.4 '", where=_FIRST),
        Rule("region", JOBS, _text(IMPACT_TASK), v.PART_OF, "'http://ex/job/impact'", where=_FIRST),
        Rule("region", JOBS, "'http://ex/job/impact'", v.JOB_CODELIST, _text(QUALITY), where=_FIRST),
        Rule("region", JOBS, "'http://ex/job/impact'", v.JOB_TARGET_GRAPH, _text(DECISIONS), where=_FIRST),
    ],
    "shapes": [
        Rule("region", JOBS, "'http://ex/job/quality'", v.JOB_SHAPE, "'http://ex/shape/quality'", where=_FIRST),
        Rule("region", PUBLIC, "'http://ex/shape/quality'", v.TARGET_CLASS, _text(v.WORK), where=_FIRST),
        Rule("documents", PUBLIC, "'http://ex/shape/quality'", v.TARGET_NODE, DOC, where="doc_id % 6 = 0"),
        Rule("pages", PUBLIC, "'http://ex/shape/quality'", v.TARGET_NODE, "concat('http://ex/page/', page_id)"),
    ],
    "inputs": [
        Rule("documents", JOBS, _text(IMPACT_TASK), v.INPUT_CONTAINER, "concat('http://ex/container/', doc_id % 10)", where="doc_id % 10 < 7", distinct=True),
        Rule("documents", CONTAINERS, "concat('http://ex/container/', doc_id % 10)", v.HAS_RESOURCE, DOC),
        Rule("documents", JOBS, _text(IMPACT_TASK), v.INPUT_CONTAINER, "'http://ex/container/extra'", where="doc_id = 0"),
        Rule("documents", CONTAINERS, "'http://ex/container/extra'", v.HAS_RESOURCE, DOC, where="doc_id % 20 = 0"),
        Rule("pages", JOBS, _text(BAD_TASK), v.INPUT_CONTAINER, "concat('http://ex/container/p', page_id % 3)", distinct=True),
        Rule("pages", CONTAINERS, "concat('http://ex/container/p', page_id % 3)", v.HAS_RESOURCE, "CASE WHEN page_id % 2 = 0 THEN concat('http://ex/page/', page_id) ELSE concat('http://ex/doc/', page_id) END"),
    ],
}


def _columns(rule: Rule) -> list[str]:
    return [
        f"{_text(rule.g)} AS g", f"{rule.s} AS s", f"{_text(rule.p)} AS p", f"{rule.o} AS value",
        f"{_text(rule.kind)} AS kind", f"{rule.lang} AS lang",
    ]


def _struct(rule: Rule) -> str:
    """The quad of a rule as a Spark SQL struct."""
    return (
        f"named_struct('g', {_text(rule.g)}, 's', {rule.s}, 'p', {_text(rule.p)}, 'o', named_struct("
        f"'value', CAST({rule.o} AS STRING), 'kind', {_text(rule.kind)}, 'lang', CAST({rule.lang} AS STRING), "
        "'datatype', CAST(NULL AS STRING)))"
    )


# Quads that one task may make; it sorts them by predicate to write them.
TASK_QUADS = 500_000


def _dealt(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """The columns that the rules use, over so many tasks that none makes more than TASK_QUADS quads.

    Rows of a small file may be many: a scan cuts tables by bytes and row groups. Only where one of its
    tasks holds too many are the rows dealt by hash.
    """
    text = " ".join(f"{rule.s} {rule.o} {rule.lang} {rule.where}" for rule in rules)
    used = [name for name in rows.columns if re.search(rf"\b{re.escape(name)}\b", text)]
    sizes = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    total, most = sizes.agg(F.sum("n"), F.max("n")).first()
    if not used or (most or 0) * len(rules) <= TASK_QUADS:
        return rows
    return rows.select(*used).repartition(max(rows.rdd.getNumPartitions(), -(-total * len(rules) // TASK_QUADS)), *used)


_STORES: dict[tuple[str, str], str] = {}
_LOADED: set[tuple[str, str]] = set()


def _load(spark: SparkSession, sf_dir: str, group: str, root: str) -> None:
    """Write one group of quads under the root, in a folder per predicate.

    Keys of the given tables are unique, so the rules give each quad once.
    """
    union = None
    for name in dict.fromkeys(rule.table for rule in RULES[group]):
        for distinct in (False, True):
            rules = [rule for rule in RULES[group] if rule.table == name and rule.distinct == distinct]
            if not rules:
                continue
            quads = ", ".join(f"CASE WHEN {rule.where} THEN {_struct(rule)} END" for rule in rules)
            given = table(spark, sf_dir, name)
            given = given if distinct else _dealt(given, rules)
            rows = given.selectExpr(f"explode(array({quads})) AS q").where("q IS NOT NULL")
            rows = rows.distinct() if distinct else rows
            union = rows if union is None else union.unionByName(rows)
    union = union.select("q.*")
    union.write.partitionBy("p").parquet(f"{root}/part={group}")


def quads(spark: SparkSession, sf_dir: str, *groups: str) -> DataFrame:
    """The quads of the groups as a stored table, derived once per session.

    The table is partitioned by predicate, like any quad table of this package,
    so a pattern with a constant predicate reads its own files only.
    """
    session = (spark.sparkContext.applicationId, sf_dir)
    root = _STORES.setdefault(session, scratch_path(spark, "quads"))
    for group in groups:
        if (root, group) not in _LOADED:
            _load(spark, sf_dir, group, root)
            _LOADED.add((root, group))
    paths = [f"{root}/part={group}" for group in groups]
    try:
        stored = spark.read.schema(QUAD_SCHEMA).option("basePath", root).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # The shared folder was cleared in between.
        del _STORES[session]
        return quads(spark, sf_dir, *groups)
    return stored.select("g", "s", "p", "o")


def quads_sql(*groups: str) -> str:
    """The same as a ``quads`` table expression: ``WITH quads AS (..)``."""
    selects = [
        f"SELECT {'DISTINCT ' if rule.distinct else ''}{', '.join(_columns(rule))} FROM {rule.table} WHERE {rule.where}"
        for group in groups
        for rule in RULES[group]
    ]
    return "WITH quads AS MATERIALIZED (" + " UNION ALL ".join(selects) + ")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

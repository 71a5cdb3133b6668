"""SQL that gives the expected result of each named query (DuckDB dialect)."""

from __future__ import annotations

from conceptmill.operators.prompts import impact_format
from conceptmill import vocab as v
from conceptmill.plans import bridge as br
from conceptmill.plans import stubs
from conceptmill.plans.bridge import AI, CONTAINERS, DECISIONS, JOBS, PUBLIC, QUALITY, quads_sql

METRICS = ("accuracy", "precision", "recall", "f1")
_LABELLED = ("docs", "anns", "concepts")
_STAR_ON = "AND".join(f" {x}.g = a.g AND {x}.s = a.s " for x in ("t", "m", "b"))
IN_DECISIONS = f"g = '{DECISIONS}'"

DEFAULT_TARGETS = f"SELECT s FROM quads WHERE p = '{v.TYPE}' AND value = '{v.EXPRESSION}' AND (IN_GRAPH)"
WORK_TARGETS = f"SELECT s FROM quads WHERE p = '{v.TYPE}' AND value = '{v.WORK}' AND (IN_GRAPH)"
CLASS_TARGETS = f"SELECT s FROM quads WHERE p = '{v.TYPE}' AND value IN ('{v.WORK}', '{v.EXPRESSION}') AND (IN_GRAPH)"
NODE_TARGETS = (
    f"SELECT {br.DOC} AS s FROM documents WHERE doc_id % 6 = 0 "
    "UNION SELECT concat('http://ex/page/', page_id) AS s FROM pages"
)


def _annotations(graphs: str) -> str:
    """(g, ann, target, body) of classifying annotations."""
    return f"""SELECT a.g, a.s AS ann, t.value AS target, b.value AS body
      FROM quads a, quads t, quads m, quads b
      WHERE {_STAR_ON} AND a.p = '{v.TYPE}' AND a.value = '{v.ANNOTATION}' AND t.p = '{v.HAS_TARGET}'
        AND m.p = '{v.MOTIVATED_BY}' AND m.value = '{v.CLASSIFYING}' AND b.p = '{v.HAS_BODY}' AND a.g IN {graphs}"""


_IN_PUBLIC = f"SELECT s FROM quads WHERE g = '{PUBLIC}' AND p = '{v.IN_SCHEME}' AND value = '{QUALITY}'"
_BOTH = f"('{DECISIONS}', '{AI}')"


def _inputs(task: str) -> str:
    return f"""SELECT r.value FROM quads c JOIN quads r ON r.s = c.value
      WHERE c.p = '{v.INPUT_CONTAINER}' AND c.s = '{task}' AND r.p = '{v.HAS_RESOURCE}'"""


def unannotated(targets: str, in_graph: str, graphs: str = _BOTH, inputs: str | None = None) -> str:
    groups = _LABELLED + (("inputs",) if inputs else ())
    extra = f" AND s IN ({_inputs(inputs)})" if inputs else ""
    return f"""{quads_sql(*groups)},
    ann AS ({_annotations(graphs)}),
    done AS (SELECT ann.target FROM ann JOIN quads c ON c.g = ann.g AND c.s = ann.body
             WHERE c.p IN ('{v.IN_SCHEME}', '{v.FOR_SCHEME}') AND c.value = '{QUALITY}'),
    targets AS ({targets.replace('IN_GRAPH', in_graph)})
    SELECT DISTINCT s AS decision FROM targets WHERE s NOT IN (SELECT target FROM done){extra}"""


def _props(key: str, graph_key: str = "") -> str:
    joins = ""
    for name, p in v.TEXT_PROPERTIES.items():
        joins += f" LEFT JOIN quads {name} ON {name}.s = {key} AND {name}.p = '{p}' {graph_key.replace('X', name)}"
    return joins


_JOINED_TEXT = (
    "concat_ws(chr(10), " + ", ".join(f"nullif({n}.value, '')" for n in v.TEXT_PROPERTIES) + ")"
)
_OPEN = f"""ann AS ({_annotations(_BOTH)}),
    open AS (SELECT DISTINCT s AS decision FROM quads WHERE g = '{DECISIONS}' AND p = '{v.TYPE}' AND value = '{v.EXPRESSION}'
             AND s NOT IN (SELECT target FROM ann WHERE body IN ({_IN_PUBLIC})))"""


def _joined_values(where: str) -> str:
    places = " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(v.TEXT_PROPERTIES.values()))
    return f"""SELECT s AS decision, string_agg(value, chr(10) ORDER BY place, value) AS text
      FROM (SELECT DISTINCT s, CASE p {places} END AS place, value FROM quads
            WHERE p IN ({', '.join(f"'{p}'" for p in v.TEXT_PROPERTIES.values())}) AND value <> '' AND {where}) GROUP BY s"""


UNANNOTATED_WITH_TEXT = f"""{quads_sql(*_LABELLED)}, {_OPEN}
  SELECT DISTINCT decision, text FROM (SELECT decision, {_JOINED_TEXT} AS text, {', '.join(f'{n}.lang AS l_{n}, {n}.value AS v_{n}' for n in v.TEXT_PROPERTIES)}
  FROM open {_props('decision', f"AND X.g = '{DECISIONS}'")})"""
UNANNOTATED_ONE_TEXT = f"""{quads_sql(*_LABELLED)}, {_OPEN}, texts AS ({_joined_values(IN_DECISIONS)})
  SELECT decision, coalesce(text, '') AS text FROM open LEFT JOIN texts USING (decision)"""
SKIP_REASONS = """SELECT doc_id, CASE WHEN doc_id % 6 < 2 THEN 'blank text' WHEN doc_id % 4 = 0 THEN 'no classes' END AS skip_reason
  FROM documents"""

_CLASSES = f"""ann AS ({_annotations(f"('{AI}')")}),
    concept AS (SELECT DISTINCT s FROM quads WHERE g = '{PUBLIC}' AND p = '{v.TYPE}' AND value = '{v.CONCEPT}' AND s IN ({_IN_PUBLIC})),
    pairs AS (SELECT DISTINCT target AS decision, body FROM ann WHERE body IN (SELECT s FROM concept))"""


def annotated(label: str, order: str, graph: str) -> str:
    return f"""{quads_sql(*_LABELLED)}, {_CLASSES},
    classes AS (SELECT decision, string_agg({label}, '|' ORDER BY {order}) AS classes FROM pairs GROUP BY decision)
    SELECT decision, classes, {_JOINED_TEXT} AS text
    FROM classes JOIN quads e ON e.s = decision AND e.p = '{v.TYPE}' AND e.value = '{v.EXPRESSION}'
    {_props('decision', 'AND X.g = e.g')}
    LEFT JOIN quads lang ON lang.s = decision AND lang.p = '{v.DCT_LANGUAGE}' AND lang.g = e.g"""


def _entries(where: str = "true") -> str:
    """Entries of all schemes as ``entries``."""
    return f"""members AS (SELECT DISTINCT s AS uri, value AS scheme FROM quads WHERE p = '{v.IN_SCHEME}' AND {where}),
    names AS (SELECT DISTINCT s AS uri, value AS label, lang FROM quads WHERE p = '{v.PREF_LABEL}' AND coalesce(lang, '') IN ('en', '')),
    meanings AS (SELECT DISTINCT s AS uri, value AS definition, lang FROM quads WHERE p = '{v.DEFINITION}' AND coalesce(lang, '') IN ('en', '')),
    entries AS (SELECT scheme, uri, label, definition FROM members JOIN names USING (uri) LEFT JOIN meanings USING (uri))"""


_QUALITY_ENTRIES = _entries(f"value = '{QUALITY}'")
_URI_LABELS = "uri_labels AS (SELECT uri, max(label) AS name FROM entries GROUP BY uri)"
ANNOTATED_NAMES = f"""{quads_sql(*_LABELLED)}, {_CLASSES}, {_QUALITY_ENTRIES}, {_URI_LABELS},
  classes AS (SELECT decision, string_agg(coalesce(name, body), '|' ORDER BY body) AS classes
              FROM pairs LEFT JOIN uri_labels ON uri = body GROUP BY decision),
  texts AS ({_joined_values('true')})
  SELECT decision, classes, coalesce(text, '') AS text FROM classes LEFT JOIN texts USING (decision)
  WHERE decision IN (SELECT s FROM quads WHERE p = '{v.TYPE}' AND value = '{v.EXPRESSION}')"""
CLASSES_TO_LABELS = f"""SELECT {br.DOC} AS decision,
  concat('toxic|', CASE WHEN quality = 1 THEN 'High quality' ELSE 'Low quality' END, '|http://ex/unknown') AS names FROM labels"""
_IMPACTS = ", ".join(f"'{uri}'" for uri in v.IMPACT_URIS.values())
_ASSESSED = f"SELECT s FROM quads WHERE g = '{AI}' AND p = '{v.HAS_BODY}' AND value IN ({_IMPACTS})"


def _assessable(task: str) -> str:
    return f"""ann AS ({_annotations(f"('{AI}')")}),
    wanted AS (SELECT DISTINCT target FROM ann WHERE body IN ({_IN_PUBLIC}) AND ann NOT IN ({_ASSESSED})),
    assessable AS (
    SELECT e.s AS expression, l.value AS lang, w.s AS work, string_agg(c.value, '' ORDER BY c.value) AS content
    FROM quads i, quads r, quads e, quads c, quads l, quads w, quads k
    WHERE i.g = '{JOBS}' AND i.p = '{v.INPUT_CONTAINER}' AND i.s = '{task}'
      AND r.g = '{CONTAINERS}' AND r.p = '{v.HAS_RESOURCE}' AND r.s = i.value
      AND e.g = '{DECISIONS}' AND e.p = '{v.TYPE}' AND e.value = '{v.EXPRESSION}' AND e.s = r.value
      AND c.g = e.g AND c.s = e.s AND c.p = '{v.CONTENT}' AND l.g = e.g AND l.s = e.s AND l.p = '{v.LANGUAGE}'
      AND w.g = e.g AND w.p = '{v.REALIZED_BY}' AND w.value = e.s AND k.g = e.g AND k.s = w.s AND k.p = '{v.TYPE}' AND k.value = '{v.WORK}'
      AND e.s IN (SELECT target FROM wanted)
    GROUP BY e.s, l.value, w.s)"""


_POLICY = f"""policy AS (SELECT a.target AS expression, a.ann AS annotation, a.body AS concept, n.value AS label
  FROM ({_annotations(f"('{AI}')")}) a JOIN quads n ON n.s = a.body AND n.p = '{v.PREF_LABEL}' AND n.g = '{PUBLIC}'
  WHERE a.body IN ({_IN_PUBLIC})
    AND a.body IN (SELECT s FROM quads WHERE g = '{PUBLIC}' AND p = '{v.TYPE}' AND value = '{v.CONCEPT}')
    AND a.body NOT IN (SELECT s FROM quads WHERE g = '{AI}' AND p = '{v.TYPE}' AND value = '{v.NO_MATCH_CLASS}'))"""
ASSESSABLE = f"{quads_sql(*_LABELLED, 'inputs')}, {_assessable(br.IMPACT_TASK)} SELECT * FROM assessable"
POLICY_LABELS = f"{quads_sql(*_LABELLED)}, {_POLICY} SELECT * FROM policy"

# --- job options --------------------------------------------------------------


def _option(predicate: str, name: str) -> str:
    return f"""SELECT j.s AS task, min(o.value) AS {name} FROM quads j JOIN quads o ON o.s = j.value
      WHERE j.p = '{v.PART_OF}' AND o.p = '{predicate}' GROUP BY j.s"""


JOB_CODELISTS = f"""{quads_sql('jobs')} SELECT j.s AS task, min(o.value) AS codelist FROM quads j JOIN quads o ON o.s = j.value AND o.g = j.g
  WHERE j.p = '{v.PART_OF}' AND o.p = '{v.JOB_CODELIST}' GROUP BY j.s"""
JOB_TARGET_GRAPHS = f"{quads_sql('jobs')} {_option(v.JOB_TARGET_GRAPH, 'target_graph')}"
JOB_SHAPE_TARGETS = f"""{quads_sql('jobs')} SELECT DISTINCT j.s AS task, CASE t.p WHEN '{v.TARGET_NODE}' THEN 'node' ELSE 'class' END AS kind, t.value AS uri
  FROM quads j JOIN quads h ON h.s = j.value AND h.p = '{v.JOB_SHAPE}' JOIN quads t ON t.s = h.value
  WHERE j.p = '{v.PART_OF}' AND t.p IN ('{v.TARGET_NODE}', '{v.TARGET_CLASS}')"""
JOB_TEXT_PATHS = f"""{quads_sql('jobs')}, o AS ({_option(v.JOB_TEXT_PATH, 'path')})
  SELECT task, path, starts_with(path, 'http') AS valid FROM o"""
JOB_THRESHOLDS = f"""{quads_sql('jobs')}, o AS ({_option(v.JOB_THRESHOLD, 'text')})
  SELECT DISTINCT j.s AS task, CASE trim(o.text) WHEN '0.7' THEN 0.7 WHEN '.25' THEN 0.25 WHEN '7e-1' THEN 0.7 ELSE 0.5 END::DOUBLE AS threshold
  FROM quads j LEFT JOIN o ON o.task = j.s WHERE j.p = '{v.PART_OF}'"""
_TASK_INPUTS = f"""SELECT DISTINCT c.s AS task, r.value AS resource FROM quads c JOIN quads r ON r.s = c.value
  WHERE c.p = '{v.INPUT_CONTAINER}' AND r.p = '{v.HAS_RESOURCE}'"""
TASK_INPUTS = f"{quads_sql('inputs')} {_TASK_INPUTS}"
INPUT_VIOLATIONS = f"""{quads_sql('docs', 'inputs')}, i AS ({_TASK_INPUTS}) SELECT * FROM i
  WHERE resource NOT IN (SELECT s FROM quads WHERE p = '{v.TYPE}' AND value = '{v.EXPRESSION}')"""

# --- codelists ----------------------------------------------------------------

_PARTS = f"{quads_sql('parts')}, {_entries()}"


def _repr(x: str) -> str:
    bs = "chr(92)"
    escaped = f"replace({x}, {bs}, concat({bs}, {bs}))"
    return (
        f"CASE WHEN contains({x}, chr(39)) AND NOT contains({x}, chr(34)) THEN concat(chr(34), {escaped}, chr(34)) "
        f"ELSE concat(chr(39), replace({escaped}, chr(39), concat({bs}, chr(39))), chr(39)) END"
    )


_CODE_LISTS = f"""shown AS (SELECT scheme, concat('[', string_agg({_repr('label')}, ', ' ORDER BY uri, label), ']') AS listed FROM entries GROUP BY scheme),
  meant AS (SELECT scheme, label, min(struct_pack(uri := uri, label := label)) AS place,
              arg_max(definition, struct_pack(uri := uri, definition := definition)) AS definition
            FROM entries WHERE coalesce(definition, '') <> '' GROUP BY scheme, label),
  mapped AS (SELECT scheme, string_agg(concat({_repr('label')}, ': ', {_repr('definition')}), ', ' ORDER BY place) AS pairs FROM meant GROUP BY scheme),
  code_lists AS (SELECT scheme, concat(listed, CASE WHEN pairs IS NULL THEN '' ELSE concat(chr(10), chr(10), 'Label descriptions:', chr(10), '{{', pairs, '}}') END) AS code_list
    FROM shown LEFT JOIN mapped USING (scheme))"""
CODELIST_ENTRIES = f"{quads_sql('parts', 'nations')}, {_entries()} SELECT * FROM entries"
CODELIST_PROMPT_TEXT = f"{_PARTS}, {_CODE_LISTS} SELECT * FROM code_lists"
CODELIST_LABELS = f"""{quads_sql('parts', 'nations')}, {_entries()}
  SELECT scheme, string_agg(label, '|' ORDER BY uri, label) AS labels FROM entries GROUP BY scheme"""
_POSITIONS = "SELECT scheme, uri, label, row_number() OVER (PARTITION BY scheme ORDER BY uri, label, definition) - 1 AS ord FROM entries"
CODELIST_POSITIONS = f"{_PARTS} {_POSITIONS}"
_VARIANTS = """variants AS (SELECT scheme, key, max(uri) AS uri FROM (
    SELECT scheme, uri, label AS key FROM entries UNION ALL SELECT scheme, uri, lower(label) FROM entries
    UNION ALL SELECT scheme, uri, replace(label, ' ', '_') FROM entries
    UNION ALL SELECT scheme, uri, lower(replace(label, ' ', '_')) FROM entries) GROUP BY scheme, key)"""
LABEL_VARIANT_MAP = f"{_PARTS}, {_VARIANTS} SELECT * FROM variants"


def _resolve(prefix: bool) -> str:
    """(scheme, label, uri) for the distinct rows of ``wanted`` as ``resolved``."""
    cut = "coalesce(v1.uri, v2.uri, v3.uri, v4.uri" + (", p.uri)" if prefix else ")")
    join = (
        """LEFT JOIN (SELECT w.scheme, w.label, min(e.uri) AS uri FROM w JOIN entries e ON e.scheme = w.scheme
        AND starts_with(lower(e.label), trim(lower(replace(w.label, '_', ' ')))) GROUP BY w.scheme, w.label) p
        ON p.scheme = w.scheme AND p.label = w.label"""
        if prefix
        else ""
    )
    return f"""{_VARIANTS}, w AS (SELECT DISTINCT scheme, label FROM wanted),
    resolved AS (SELECT w.scheme, w.label, {cut} AS uri FROM w
      LEFT JOIN variants v1 ON v1.scheme = w.scheme AND v1.key = w.label
      LEFT JOIN variants v2 ON v2.scheme = w.scheme AND v2.key = replace(w.label, '_', ' ')
      LEFT JOIN variants v3 ON v3.scheme = w.scheme AND v3.key = lower(w.label)
      LEFT JOIN variants v4 ON v4.scheme = w.scheme AND v4.key = lower(replace(w.label, '_', ' ')) {join})"""


_WANTED = f"wanted AS (SELECT {br.BRAND} AS scheme, {br.WANTED_LABEL} AS label FROM part)"
RESOLVE_EXACT = f"{_PARTS}, {_WANTED}, {_resolve(False)} SELECT * FROM resolved"
RESOLVE_PREFIX = f"{_PARTS}, {_WANTED}, {_resolve(True)} SELECT * FROM resolved"
ANNOTATION_FANOUT = f"""{_PARTS}, {_WANTED}, {_resolve(True)}
  SELECT r.scheme, concat('http://ex/order/', l_orderkey) AS decision, r.label, r.uri
  FROM lineitem JOIN part ON p_partkey = l_partkey
  JOIN resolved r ON r.scheme = {br.BRAND} AND r.label = {br.WANTED_LABEL}"""


def _uuid(*parts: str) -> str:
    marked = ", ".join(f"coalesce(concat(length({p}), ':', {p}), '-')" for p in parts)
    m = f"md5(concat_ws('|', {marked}))"
    return "concat(" + ", '-', ".join(f"substr({m}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"


def _ann_uri(agent: str) -> str:
    return f"concat('{v.ANNOTATION_BASE}', {_uuid('target', 'body', repr(v.CLASSIFYING), repr(agent))})"


def _annotation_rows(source: str, task: str, agent: str) -> str:
    return f"""SELECT {_ann_uri(agent)} AS ann_uri, '{task}' AS task_uri, target, body, '{v.CLASSIFYING}' AS motivated_by,
      '{agent}' AS agent_uri, '{v.AGENT_TYPE}' AS agent_type, '{AI}' AS g FROM ({source})"""


_MODEL_AGENT, _CLASSIFIER_AGENT = v.AGENTS["model_annotator"], v.AGENTS["classifier_annotator"]
_NEW = f"""SELECT {br.DOC} AS target, CASE WHEN doc_id % 3 = 0 THEN '{br.HIGH}' ELSE '{br.LOW}' END AS body FROM documents
  EXCEPT SELECT {br.DOC}, {br._QUALITY_BODY} FROM labels"""
NEW_ANNOTATIONS = _annotation_rows(_NEW, br.TASK, _MODEL_AGENT)
_REPLIES = f"""wanted AS (SELECT '{QUALITY}' AS scheme, {br.DOC} AS decision, unnest(CASE doc_id % 5 WHEN 1 THEN ['High_quality']
  WHEN 2 THEN ['low', 'TOXIC'] WHEN 3 THEN ['nonsense'] WHEN 4 THEN ['toxic', 'Toxic', 'high'] ELSE [] END) AS label FROM documents)"""
_QUALITY_CODES = f"{quads_sql('concepts')}, {_QUALITY_ENTRIES}"
NO_MATCH_ROWS = f"""{_QUALITY_CODES}, {_REPLIES}, {_resolve(True)}
  SELECT DISTINCT decision AS target, uri AS body FROM wanted JOIN resolved USING (scheme, label) WHERE uri IS NOT NULL
  UNION ALL SELECT {br.DOC}, '{v.NO_MATCH}' FROM documents WHERE doc_id % 5 = 0"""


def _container_quads(resources: str, task: str) -> str:
    uid = _uuid(repr(task), "resource")
    uri = f"concat('{v.CONTAINER_BASE}', {uid})"
    return f"""SELECT '{CONTAINERS}' AS g, {uri} AS s, '{v.TYPE}' AS p, '{v.DATA_CONTAINER}' AS o, 'uri' AS kind FROM ({resources})
      UNION ALL SELECT '{CONTAINERS}', {uri}, '{v.UUID}', {uid}, 'literal' FROM ({resources})
      UNION ALL SELECT '{CONTAINERS}', {uri}, '{v.HAS_RESOURCE}', resource, 'uri' FROM ({resources})"""


OUTPUT_CONTAINERS = _container_quads(f"SELECT {br.DOC} AS resource FROM documents WHERE doc_id % 5 <> 0", br.TASK)


def _annotation_quads(rows: str) -> str:
    act = f"concat('{v.ACTIVITY_BASE}', {_uuid('task_uri', 'ann_uri')})"
    parts = [
        ("ann_uri", v.TYPE, f"'{v.ANNOTATION}'"), ("ann_uri", v.HAS_TARGET, "target"),
        ("ann_uri", v.MOTIVATED_BY, "motivated_by"), ("ann_uri", v.HAS_BODY, "body"),
        (act, v.TYPE, f"'{v.ACTIVITY}'"), (act, v.GENERATED, "ann_uri"), (act, v.ASSOCIATED_WITH, "agent_uri"),
        ("agent_uri", v.TYPE, "agent_type"),
    ]
    return f"WITH rows AS ({rows}) " + " UNION ".join(f"SELECT g, {s} AS s, '{p}' AS p, {o} AS o FROM rows" for s, p, o in parts)


ANNOTATION_QUADS = _annotation_quads(
    _annotation_rows(f"SELECT DISTINCT {br.DOC} AS target, {br._QUALITY_BODY} AS body FROM labels", br.TASK, _CLASSIFIER_AGENT)
)

# --- text ---------------------------------------------------------------------

_DESCRIPTIONS = """concat_ws(chr(10), CASE WHEN doc_id % 15 = 0 THEN concat('chars: ', n_chars) END,
  CASE WHEN doc_id % 5 = 0 THEN concat('source: ', source) END)"""
TEXT_BY_PROPERTY = f"SELECT {br.DOC} AS decision, {_DESCRIPTIONS} AS text FROM documents"
TEXT_BY_PATH = f"""WITH vals AS (SELECT doc_id, {br._QUALITY_BODY} AS x FROM labels
    UNION ALL SELECT doc_id, '{v.IMPACT_URIS['positive']}' FROM labels WHERE doc_id % 17 = 0
    UNION ALL SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '{v.OA}linking' ELSE '{v.CLASSIFYING}' END FROM labels)
  SELECT concat('http://ex/activity/', doc_id) AS decision, CASE WHEN doc_id % 3 = 0 THEN '' ELSE string_agg(x, chr(10) ORDER BY x) END AS text
  FROM vals GROUP BY doc_id"""
DECISION_TEXT = f"""SELECT {br.DOC} AS decision, concat_ws(chr(10), CASE WHEN doc_id % 3 <> 0 THEN source END,
  CASE WHEN doc_id % 4 = 0 THEN lang END, CASE WHEN doc_id % 5 = 0 THEN ' ' END, nullif(text, '')) AS text FROM documents"""
TEXT_PATH_OR_DEFAULT = f"""{quads_sql('docs')}, texts AS ({_joined_values('true')})
  SELECT {br.DOC} AS decision, CASE WHEN doc_id % 2 = 1 OR doc_id % 10 = 4 THEN '' ELSE split_part(text, chr(10), 1) END AS text, 'path' AS source FROM documents
  UNION ALL SELECT {br.DOC}, coalesce(t.text, ''), 'default' FROM documents d LEFT JOIN texts t ON t.decision = {br.DOC}"""

# --- learning -----------------------------------------------------------------

_IDS = "ids AS (SELECT scheme, label, max(ord) AS id FROM (" + _POSITIONS + ") GROUP BY scheme, label)"
LABEL_IDS = f"{_PARTS}, {_IDS} SELECT * FROM ids"
_QUALITY_CLASSES = f"""given AS (SELECT {br.DOC} AS decision, CASE WHEN doc_id % 19 = 0 THEN '{br.VOID}' END AS c1,
  CASE WHEN quality = 1 THEN 'High quality' ELSE 'Low quality' END AS c2, CASE WHEN toxic = 1 THEN 'toxic' END AS c3 FROM labels)"""
MULTI_HOT = f"""{_QUALITY_CODES}, {_IDS}, {_QUALITY_CLASSES}
  SELECT decision, string_agg(CASE WHEN label = c2 OR label = c3 THEN '1' ELSE '0' END, '' ORDER BY id) AS target
  FROM given, ids WHERE c1 IS NULL GROUP BY decision"""
SINGLE_LABEL_IDS = f"""{_QUALITY_CODES}, {_IDS}, {_QUALITY_CLASSES}
  SELECT decision, label, id FROM given JOIN ids ON label = coalesce(c1, c2)"""
UNKNOWN_CLASSES = f"WITH {_QUALITY_CLASSES} SELECT decision, c1 AS label FROM given WHERE c1 IS NOT NULL"
PROBLEM_TYPE = f"""SELECT CASE WHEN max(CASE WHEN doc_id % 19 = 0 THEN 1 ELSE 0 END + 1 + toxic) > 1 THEN '{v.MULTI_LABEL}' ELSE '{v.SINGLE_LABEL}' END AS problem_type, 'all' AS rows FROM labels
  UNION ALL SELECT '{v.SINGLE_LABEL}', 'first'"""
_QUOTAS = """counts AS (SELECT id, count(*) AS n FROM d GROUP BY id),
  sizes AS (SELECT sum(n)::BIGINT AS total, (sum(n)::BIGINT + 9) // 10 AS test FROM counts),
  shares AS (SELECT id, n, test * n // total AS down, test * n % total AS remainder, test FROM counts, sizes),
  quotas AS (SELECT id, down + CASE WHEN row_number() OVER (ORDER BY remainder DESC, id) <= test - sum(down) OVER () THEN 1 ELSE 0 END AS quota FROM shares)"""
SPLIT_STRATIFIED = f"""WITH d AS (SELECT concat('http://ex/vec/', vec_id) AS decision, label::BIGINT AS id FROM embeddings), {_QUOTAS},
  ranked AS (SELECT decision, id, row_number() OVER (PARTITION BY id ORDER BY md5(decision), decision) AS rank FROM d)
  SELECT decision, id, CASE WHEN rank <= quota THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas USING (id)"""
SPLIT_GLOBAL = f"""WITH ranked AS (SELECT {br.DOC} AS decision, row_number() OVER (ORDER BY md5({br.DOC})) AS rank, count(*) OVER () AS n FROM documents)
  SELECT decision, CASE WHEN rank <= (n + 9) // 10 THEN 'test' ELSE 'train' END AS split FROM ranked"""

# --- predictions --------------------------------------------------------------

_FOLDED = " + ".join(f"coalesce(embedding[i + {k}]::DOUBLE, 0)" for k in range(0, 64, 10))
_LOGITS = f"""logits AS (SELECT vec_id, label::BIGINT AS id, i - 1 AS place, ({_FOLDED}) * 20 AS x
  FROM embeddings, range(1, 11) r(i))"""
_SOFTMAX = f"""WITH {_LOGITS}, top AS (SELECT vec_id, max(x) AS top FROM logits GROUP BY vec_id),
  e AS (SELECT vec_id, id, place, x, top, exp(x - top) AS e FROM logits JOIN top USING (vec_id)),
  best AS (SELECT vec_id, any_value(id) AS id, min(CASE WHEN x = top THEN place END) AS place, 1 / sum(e) AS p FROM e GROUP BY vec_id)"""
PREDICT_SINGLE = f"""{_SOFTMAX} SELECT vec_id, CASE WHEN p >= 0.4 THEN place END::BIGINT AS label,
  CASE WHEN p >= 0.4 THEN round(p, 6) END AS confidence FROM best"""
PREDICT_MULTI = f"""WITH {_LOGITS} SELECT vec_id, place::BIGINT AS label, round(1 / (1 + exp(-x)), 6) AS confidence
  FROM logits WHERE 1 / (1 + exp(-x)) >= 0.9"""


def _scores(by: str, accuracy: str) -> str:
    """Weighted scores from ``sides(by.., label, tp, fp, fn)``."""
    return f"""per AS (SELECT {by}, label, sum(tp)::DOUBLE AS tp, sum(fp)::DOUBLE AS fp, sum(fn)::DOUBLE AS fn FROM sides GROUP BY {by}, label),
    scored AS (SELECT {by}, tp + fn AS support, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr,
      CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f FROM per),
    scores AS (SELECT {by}, round(accuracy, 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS precision,
      round(sum(re * support) / sum(support), 6) AS recall, round(sum(f * support) / sum(support), 6) AS f1
      FROM scored JOIN ({accuracy}) USING ({by}) GROUP BY {by}, accuracy)"""


_SINGLE_SCORES = f"""{_SOFTMAX}, judged AS (SELECT GROUPS AS model_id, id AS truth, place AS predicted FROM best),
  sides AS (SELECT model_id, truth AS label, (truth = predicted)::INT AS tp, 0 AS fp, (truth <> predicted)::INT AS fn FROM judged
    UNION ALL SELECT model_id, predicted, 0, 1, 0 FROM judged WHERE truth <> predicted),
  {_scores('model_id', 'SELECT model_id, avg((truth = predicted)::INT) AS accuracy FROM judged GROUP BY model_id')}"""
METRICS_SINGLE = _SINGLE_SCORES.replace("GROUPS", "1") + " SELECT accuracy, precision, recall, f1 FROM scores"
METRICS_MULTI = f"""WITH {_LOGITS}, cells AS (SELECT 1 AS one, vec_id, place AS label, (place = id OR place = vec_id % 7) AS t, x > 0 AS p FROM logits),
  sides AS (SELECT one, label, (t AND p)::INT AS tp, (NOT t AND p)::INT AS fp, (t AND NOT p)::INT AS fn FROM cells),
  whole AS (SELECT vec_id, bool_and(t = p) AS same FROM cells GROUP BY vec_id),
  {_scores('one', 'SELECT 1 AS one, avg(same::INT) AS accuracy FROM whole')} SELECT accuracy, precision, recall, f1 FROM scores"""
_MODELS = f"""{_SINGLE_SCORES.replace('GROUPS', "concat('demo/model-', vec_id % 4)")},
  models AS (SELECT *, md5(model_id) AS oid, md5(reverse(model_id)) AS sha, concat('https://hub.example.org/', model_id) AS repo,
    CASE WHEN model_id < 'demo/model-2' THEN '2024-01-15T11:00:00+01:00' ELSE '2024-07-15T12:00:00.250000+02:00' END AS published FROM scores)"""


def _metadata(models: str, metrics: tuple[str, ...], source_url: str, measured: str | None = None) -> str:
    b = v.AIRO

    def uri(kind: str, x: str) -> str:
        return f"concat('{b}/{kind}/', {x})"

    model, version, code = uri("model", "model_id"), uri("version", "oid"), uri("code", "oid")
    files, source, given = uri("modelfiles", "model_id"), uri("sourcecode", "'text-classifier'"), uri("modelinput", "'text'")
    rows = [
        (model, v.TYPE, f"'{b}AIModel'", "uri", ""), (model, v.DCT + "source", "concat(repo, '/tree/main/')", "uri", ""),
        (model, v.DCT + "title", "model_id", "literal", ""), (model, b + "hasInput", given, "uri", ""),
        (model, b + "hasVersion", version, "uri", ""), (model, v.SD + "dataPublished", "published", "literal", v.XSD + "dateTime"),
        (model, v.SD + "hasVersion", code, "uri", ""), (code, v.TYPE, f"'{v.SD}SoftwareVersion'", "uri", ""),
        (code, v.SD + "hasSourceCode", source, "uri", ""), (code, v.SD + "hasVersionId", "sha", "literal", ""),
        (files, v.TYPE, f"'{v.SD}SourceCode'", "uri", ""), (files, v.SCHEMA + "codeRepository", "repo", "uri", ""),
        (given, v.DCT + "type", "'string'", "literal", ""), (source, v.TYPE, f"'{v.SD}SourceCode'", "uri", ""),
        (source, v.SCHEMA + "codeRepository", f"'{source_url}'", "uri", ""),
        (version, v.TYPE, f"'{b}Version'", "uri", ""), (version, v.SD + "hasSourceCode", files, "uri", ""),
        (version, v.SD + "hasVersionId", "oid", "literal", ""),
    ]
    for name in metrics:
        m = uri("qualitymeasurement", _uuid("model_id", f"'eval_{name}'"))
        rows += [
            (model, v.DQV + "QualityMeasurement", m, "uri", ""),
            (m, v.DQV + "isMeasurementOf", f"'{b}/metric/eval_{name}'", "uri", ""),
            (m, v.DQV + "value", measured or f"CAST({name} AS VARCHAR)", "literal", v.XSD + "float"),
        ]
    selects = [
        f"SELECT '{AI}' AS g, {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS kind, '{dt}' AS datatype FROM models"
        for s, p, o, kind, dt in rows
    ]
    return f"{models} " + " UNION ".join(selects)


MODEL_METADATA = _metadata(_MODELS, METRICS, "https://git.example.org/code")
_TRAINED = """WITH models AS (SELECT 'demo/trained' AS model_id, 'c0ffee' AS oid, 'f00d' AS sha, 'http://ex/repo' AS repo,
  '2024-03-01T10:30:00+01:00' AS published)"""
TRAINED_QUADS = f"SELECT g, s, p, o FROM ({_metadata(_TRAINED, ('loss', *METRICS), 'http://ex/code', repr('measured'))})"
TRAINING_FACTS = f"""{quads_sql(*_LABELLED)}, {_CLASSES}, {_QUALITY_ENTRIES}, {_URI_LABELS},
  named AS (SELECT DISTINCT decision, coalesce(name, body) AS label FROM pairs LEFT JOIN uri_labels ON uri = body
    WHERE decision IN (SELECT s FROM quads WHERE p = '{v.TYPE}' AND value = '{v.EXPRESSION}')),
  judged AS (SELECT *, label IN (SELECT label FROM entries) AS known FROM named),
  usable AS (SELECT decision FROM judged GROUP BY decision HAVING bool_and(known)),
  n AS (SELECT count(*) AS n, (count(*) + 9) // 10 AS test FROM usable)
  SELECT 'test' AS name, test AS value FROM n UNION ALL SELECT 'judged', test FROM n UNION ALL SELECT 'train', n - test FROM n
  UNION ALL SELECT 'rejected', count(*) FROM judged WHERE NOT known
  UNION ALL SELECT 'measures from 0 to 1', 4 UNION ALL SELECT 'best epoch kept', 1
  UNION ALL SELECT 'lines of the report', 8 + count(*) FROM entries"""
_METRIC_LINE = "concat(" + ", ' | ', ".join(f"'{n.capitalize()}: ', format('{{:.4f}}', {n})" for n in METRICS) + ")"
MODEL_REPORT = f"""{_MODELS}, named AS (SELECT DISTINCT concat('demo/model-', vec_id % 4) AS model_id, concat('label ', label) AS name FROM embeddings),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY name) AS i FROM named),
  names AS (SELECT model_id, count(*) AS n, string_agg(concat(i, '. ', name), chr(10) ORDER BY i) AS listed FROM numbered GROUP BY model_id)
  SELECT model_id, concat_ws(chr(10), concat('classifier: ', model_id), 'features: base/encoder', concat('revision: ', sha), 'day: 2024-03-01',
    concat('label count: ', n), '[held-out measures]', {_METRIC_LINE}, '[label space]', listed) AS report FROM models JOIN names USING (model_id)"""

# --- prompts and replies ------------------------------------------------------


def _text_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PROMPT_CHOICE = f"""{quads_sql('parts', 'nations')},
  own AS (SELECT DISTINCT {br.BRAND} AS scheme, concat('system for ', p_brand) AS s,
          '{{{{x}}}} {{decision_text}} | {{code_list}} | {{decision_text}}' AS u FROM part WHERE p_partkey % 10 = 3)
  SELECT DISTINCT q.value AS scheme, coalesce(own.s, concat('for ', r_name)) AS system_message, coalesce(own.u, '{{code_list}}: {{decision_text}}') AS user_message
  FROM quads q LEFT JOIN own ON own.scheme = q.value, region WHERE q.p = '{v.IN_SCHEME}' AND r_regionkey = 0"""
_INSTRUCTION = _text_literal(v.REPLY_INSTRUCTION)
PROMPT_RENDERED = f"""{_QUALITY_CODES}, {_CODE_LISTS},
  docs AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('{{code_list}} ', text) ELSE text END AS t FROM documents)
  SELECT {br.DOC} AS decision, concat(CASE WHEN doc_id % 3 = 0 THEN concat('{{', t, '}} from ', code_list, code_list)
    ELSE concat('Codes ', code_list, ' for ', t, '.') END, {_INSTRUCTION}) AS prompt FROM docs, code_lists"""
IMPACT_PROMPT = f"""SELECT doc_id, {_text_literal(v.IMPACT_SYSTEM_MESSAGE)} AS system_message,
  concat('Policy text: ', text, chr(10), 'Label: ', source, chr(10), chr(10), 'Provide a structured impact assessment.') AS user_message FROM documents"""
RANDOM_LABEL = f"""{_PARTS}, lists AS (SELECT scheme, list(label ORDER BY uri, label) AS labels FROM entries GROUP BY scheme)
  SELECT {br.PART} AS decision, labels[1 + ('0x' || substr(md5({br.PART}), 1, 8))::BIGINT % len(labels)] AS label
  FROM part JOIN lists ON scheme = {br.BRAND}"""
_HI = "concat(source, '|say ', chr(34), 'hi', chr(34))"
PARSE_REPLIES = f"""SELECT doc_id, CASE WHEN doc_id % 12 IN (0, 1, 2, 7, 10) THEN {_HI} WHEN doc_id % 12 = 6 THEN '' END AS classes,
  CASE WHEN doc_id % 12 IN (3, 4, 5, 8, 9, 11) THEN concat('no valid JSON in reply: ', substr(trim({stubs.REPLY_SQL}), 1, 500)) END AS parse_error FROM documents"""
PARSE_BARE_LISTS = f"""SELECT doc_id, CASE WHEN doc_id % 12 IN (0, 1, 2, 3, 7, 10) THEN {_HI} WHEN doc_id % 12 = 6 THEN '' END AS classes FROM documents"""
_DIRECTION_URI = f"""CASE doc_id % 5 WHEN 0 THEN '{v.IMPACT_URIS['positive']}' WHEN 1 THEN '{v.IMPACT_URIS['negative']}'
  WHEN 2 THEN '{v.IMPACT_URIS['neutral']}' WHEN 3 THEN '{v.IMPACT_URIS['uncertain']}' END"""


def _if_valid(x: str, name: str) -> str:
    return f"CASE WHEN doc_id % 5 <> 4 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0 THEN {x} END AS {name}"


PARSE_IMPACT = "SELECT doc_id, " + ", ".join(
    _if_valid(x, name)
    for x, name in (
        ("source", "label"), (stubs.DIRECTION_SQL, "impact_direction"), ("CASE doc_id % 7 WHEN 1 THEN 'low' ELSE 'high' END", "confidence"),
        ("lang", "reasoning"), ("concat(lang, '|', source)", "direct_effects"), ("''", "second_order_effects"),
        ("lang", "key_uncertainties"), ("concat('doc ', doc_id)", "summary"), (_DIRECTION_URI, "impact_uri"),
    )
) + " FROM documents"
IMPACT_DIRECTION_URI = f"SELECT doc_id, {_DIRECTION_URI} AS uri FROM documents"
_IMPACT_AGENT = v.AGENTS["impact_annotator"]


def _store(verdicts: str) -> str:
    """Quads stored for ``verdicts(annotation, uri)`` as select."""
    return f"""stored AS (SELECT annotation, uri FROM ({verdicts}) WHERE uri IS NOT NULL
      AND annotation IN (SELECT s FROM quads WHERE g = '{AI}' AND p = '{v.TYPE}' AND value = '{v.ANNOTATION}') AND annotation NOT IN ({_ASSESSED}))
    SELECT '{AI}' AS g, annotation AS s, '{v.HAS_BODY}' AS p, uri AS o FROM stored
    UNION SELECT '{AI}', x.s, '{v.ASSOCIATED_WITH}', '{_IMPACT_AGENT}' FROM stored JOIN quads x ON x.value = annotation
      WHERE x.g = '{AI}' AND x.p = '{v.GENERATED}' AND x.s IN (SELECT s FROM quads WHERE p = '{v.TYPE}' AND value = '{v.ACTIVITY}' AND g = '{AI}')"""


STORE_IMPACT = f"""{quads_sql('anns')}, {_store(f"SELECT concat('http://ex/ann/', doc_id, '/quality') AS annotation, {_DIRECTION_URI} AS uri FROM documents")}"""

# --- RDF terms ----------------------------------------------------------------

_B = "chr(92)"
_F = """concat(chr(34), {x}, chr(34), '^^xsd:{t}')"""
_ISO = "strftime({x}, '%Y-%m-%dT%H:%M:%S')"
RDF_TERMS = f"""SELECT o_orderkey,
  concat(repeat(chr(34), 3), o_orderpriority, {_B}, chr(39), {_B}, chr(34), {_B}, {_B}, repeat(chr(34), 3)) AS text_term,
  concat('<http://ex/', o_orderpriority, {_B}, '<', {_B}, chr(34), {_B}, '>>') AS uri_term,
  {_F.format(x='o_orderkey', t='integer')} AS int_term, {_F.format(x='CAST(o_totalprice AS VARCHAR)', t='float')} AS float_term,
  {_F.format(x="CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END", t='boolean')} AS bool_term,
  {_F.format(x=_ISO.format(x='o_orderdate'), t='dateTime')} AS datetime_term,
  {_F.format(x="strftime(o_orderdate, '%Y-%m-%d')", t='date')} AS date_term FROM orders"""
_MICRO = "CASE WHEN extract('microsecond' FROM ts) % 1000000 = 0 THEN '' ELSE concat('.', strftime(ts, '%f')) END"
RDF_TIMES = f"""SELECT event_id, {_F.format(x=f"concat(strftime(ts, '%H:%M:%S'), {_MICRO})", t='time')} AS time_term,
  {_F.format(x=f"concat({_ISO.format(x='ts')}, {_MICRO})", t='dateTime')} AS datetime_term,
  {_F.format(x='CAST(value * 1e9::DOUBLE AS VARCHAR)', t='float')} AS large_term,
  {_F.format(x='CAST(value / 1048576::DOUBLE AS VARCHAR)', t='float')} AS small_term FROM events"""
TERM_ACCESSORS = f"""{quads_sql('docs')} SELECT g, s, p, value AS text, coalesce(lang, '') AS lang FROM quads
  WHERE p IN ('{v.CONTENT}', '{v.DESCRIPTION}')"""

# --- graph algebra ------------------------------------------------------------

STAR_JOIN = f"{quads_sql('anns')}, ann AS ({_annotations(f'''('{AI}')''')}) SELECT ann, target, body FROM ann"
CHAIN_JOIN = f"""{quads_sql('docs', 'inputs')} SELECT c.s AS task, c.value AS container, r.value AS expression, w.s AS work
  FROM quads c JOIN quads r ON r.s = c.value JOIN quads w ON w.value = r.value
  WHERE c.g = '{JOBS}' AND c.p = '{v.INPUT_CONTAINER}' AND r.g = '{CONTAINERS}' AND r.p = '{v.HAS_RESOURCE}' AND w.g = '{DECISIONS}' AND w.p = '{v.REALIZED_BY}'"""
CROSS_GRAPH_JOIN = f"""{quads_sql(*_LABELLED)} SELECT b.s AS ann, b.value AS concept, n.value AS label FROM quads b JOIN quads n ON n.s = b.value
  WHERE b.g = '{AI}' AND b.p = '{v.HAS_BODY}' AND n.g = '{PUBLIC}' AND n.p = '{v.PREF_LABEL}'"""
ANY_GRAPH_JOIN = f"""{quads_sql('docs')} SELECT e.g, e.s, c.value AS content FROM quads e JOIN quads c ON c.g = e.g AND c.s = e.s
  WHERE e.p = '{v.TYPE}' AND e.value = '{v.EXPRESSION}' AND c.p = '{v.CONTENT}'"""
DEFAULT_GRAPH = f"""{quads_sql('docs', 'parts')} SELECT s, value AS o FROM (SELECT DISTINCT s, value, kind, lang FROM quads
  WHERE p IN ('{v.CONTENT}', '{v.IN_SCHEME}'))"""
OPTIONAL_FILTER = f"""{quads_sql('parts')} SELECT n.s, n.value AS label, d.value AS definition FROM quads n
  LEFT JOIN quads d ON d.s = n.s AND d.p = '{v.DEFINITION}' AND d.lang = 'en' WHERE n.p = '{v.PREF_LABEL}'"""
PATH_ALTERNATION = f"""{quads_sql('concepts', 'parts')} SELECT DISTINCT g, s AS concept, value AS scheme FROM quads
  WHERE p IN ('{v.IN_SCHEME}', '{v.FOR_SCHEME}')"""
ANNOTATION_COUNTS = f"{quads_sql('anns')} SELECT value AS target, count(s) AS n FROM quads WHERE p = '{v.HAS_TARGET}' GROUP BY value"
PREDICATE_COUNTS = f"""{quads_sql('docs', 'anns', 'concepts', 'parts', 'nations', 'jobs', 'inputs', 'task')}
  SELECT g, p, count(value) AS n, count(DISTINCT s) AS subjects FROM quads GROUP BY g, p"""

# --- stored tables ------------------------------------------------------------

ALL_DOC_QUADS = f"{quads_sql('docs', 'concepts')} SELECT g, s, p, value AS o, kind, coalesce(lang, '') AS lang FROM quads"
GRAPH_WIPE = f"""{quads_sql('docs', 'anns')} SELECT g, p, count(*) AS n FROM quads
  WHERE g NOT IN ('{br.MIRROR}', '{AI}') GROUP BY g, p"""
RESULTS_JSON = """SELECT CAST(doc_id AS VARCHAR) AS doc, text, CASE WHEN doc_id % 3 <> 0 THEN source END AS title FROM documents"""

# --- jobs with stub models ----------------------------------------------------

_PROMPT_PARTS = [_text_literal(x) for x in v.DEFAULT_USER_MESSAGE.replace("{decision_text}", "{code_list}").split("{code_list}")]
_NUMBER = "('0x' || substr(md5(prompt), 1, 8))::BIGINT"
_PICK = "[" + ", ".join(f"'{x}'" for x in stubs.LABELS) + "]"


def _label_job(decisions: str, task: str) -> str:
    """``pairs(target, body)`` and ``answered(decision)`` from ``decisions(decision, text)``."""
    return f"""todo AS ({decisions}), {_CODE_LISTS},
    asked AS (SELECT decision, concat({_PROMPT_PARTS[0]}, code_list, {_PROMPT_PARTS[1]}, text, {_PROMPT_PARTS[2]}, {_INSTRUCTION}) AS prompt
      FROM todo, code_lists WHERE trim(replace(text, chr(10), '')) <> ''),
    picked AS (SELECT decision, {_NUMBER} % 6 AS shape, ({_PICK})[1 + {_NUMBER} // 6 % 4] AS label FROM asked),
    answered AS (SELECT * FROM picked WHERE shape <> 5),
    wanted AS (SELECT '{QUALITY}' AS scheme, decision, label FROM answered WHERE shape <> 3
      UNION ALL SELECT '{QUALITY}', decision, 'toxic' FROM answered WHERE shape = 4), {_resolve(True)},
    pairs AS (SELECT DISTINCT decision AS target, uri AS body FROM wanted JOIN resolved USING (scheme, label) WHERE uri IS NOT NULL
      UNION ALL SELECT decision, '{v.NO_MATCH}' FROM answered WHERE shape = 3)"""


_OPEN_SAME = f"""ann AS ({_annotations(_BOTH)}),
    done AS (SELECT ann.target FROM ann JOIN quads c ON c.g = ann.g AND c.s = ann.body
             WHERE c.p IN ('{v.IN_SCHEME}', '{v.FOR_SCHEME}') AND c.value = '{QUALITY}'),
    texts AS ({_joined_values('true')})"""
_OPEN_TEXTS = f"""SELECT DISTINCT q.s AS decision, coalesce(texts.text, '') AS text FROM quads q LEFT JOIN texts ON texts.decision = q.s
    WHERE q.p = '{v.TYPE}' AND q.value = '{v.EXPRESSION}' AND q.g = '{DECISIONS}' AND q.s NOT IN (SELECT target FROM done)"""


def _with_containers(rows: str, resources: str, task: str) -> str:
    quads = _annotation_quads(rows).removeprefix(f"WITH rows AS ({rows}) ")
    containers = _container_quads(resources, task)
    return f", rows AS ({rows}), containers AS ({containers}) {quads} UNION SELECT g, s, p, o FROM containers"


BATCH_MODEL = (
    f"{quads_sql(*_LABELLED)}, {_QUALITY_ENTRIES}, {_OPEN_SAME}, {_label_job(_OPEN_TEXTS, br.TASK)}"
    + _with_containers(
        _annotation_rows("SELECT * FROM pairs", br.TASK, _MODEL_AGENT), "SELECT decision AS resource FROM answered", br.TASK
    )
)
INCREMENTAL = (
    f"{_QUALITY_CODES}, {_label_job(f'SELECT {br.DOC} AS decision, text FROM documents', br.TASK)} "
    + _annotation_rows("SELECT * FROM pairs", br.TASK, _MODEL_AGENT)
)
_LABELLED_DOCUMENTS = f"{_QUALITY_CODES}, {_label_job(f'SELECT {br.DOC} AS decision, text FROM documents', br.TASK)}"
FAILED_REPLIES = f"{_LABELLED_DOCUMENTS} SELECT decision AS id, 'cannot say' AS raw, true AS refused FROM picked WHERE shape = 5"
# Shape 5 is refused in the first two rounds; the third model names its label alone.
THIRD_ROUND = f"""{_QUALITY_CODES}, {_label_job(f'SELECT {br.DOC} AS decision, text FROM documents', br.TASK).replace(
    "UNION ALL SELECT '" + QUALITY + "', decision, 'toxic' FROM answered WHERE shape = 4)",
    "UNION ALL SELECT '" + QUALITY + "', decision, 'toxic' FROM answered WHERE shape = 4 "
    "UNION ALL SELECT '" + QUALITY + "', decision, label FROM picked WHERE shape = 5)")}
  SELECT target, body FROM pairs"""
SEND_SLOTS = f"""SELECT id, number, (number % 7)::INT AS caller, number / 50.0::DOUBLE AS due_seconds
  FROM (SELECT {br.DOC} AS id, row_number() OVER (ORDER BY md5({br.DOC}), {br.DOC}) - 1 AS number FROM documents)"""
NEW_ONLY = f"{_LABELLED_DOCUMENTS} " + _annotation_rows(
    "SELECT * FROM pairs WHERE substr(md5(target), 1, 1) >= '8'", br.TASK, _MODEL_AGENT
)
JOB_REPORT = f"""{_LABELLED_DOCUMENTS}
  SELECT decision, 'skipped' AS kind, 'blank text' AS detail FROM todo WHERE coalesce(trim(replace(text, chr(10), '')), '') = ''
  UNION ALL SELECT decision, 'unresolved', label FROM wanted JOIN resolved USING (scheme, label) WHERE uri IS NULL"""
RANDOM_JOB = (
    f"{quads_sql(*_LABELLED)}, {_QUALITY_ENTRIES}, {_OPEN_SAME}, todo AS ({_OPEN_TEXTS}), "
    "lists AS (SELECT list(label ORDER BY uri, label) AS labels FROM entries), "
    f"wanted AS (SELECT '{QUALITY}' AS scheme, decision, labels[1 + ('0x' || substr(md5(decision), 1, 8))::BIGINT % len(labels)] AS label "
    f"FROM todo, lists WHERE trim(text) <> ''), {_resolve(True)} "
    + _annotation_rows(
        "SELECT DISTINCT decision AS target, uri AS body FROM wanted JOIN resolved USING (scheme, label)", br.TASK, _MODEL_AGENT
    )
)
_DIGITS = ", ".join(f"('0x' || substr(md5(text), {i}, 1))::INT / 2.0 - 4.0" for i in range(1, 5))
SCORED_JOB = (
    f"{quads_sql(*_LABELLED)}, {_QUALITY_ENTRIES}, {_OPEN}, "
    f"todo AS (SELECT decision, {_JOINED_TEXT} AS text FROM open {_props('decision', f'''AND X.g = '{DECISIONS}' ''')}), "
    f"scored AS (SELECT decision, unnest({_PICK}) AS label, unnest([{_DIGITS}]) AS x FROM todo "
    "WHERE trim(text) <> '' AND substr(md5(text), 32, 1) <> '0'), "
    f"wanted AS (SELECT '{QUALITY}' AS scheme, decision, label FROM scored WHERE 1 / (1 + exp(-x)) >= 0.4), {_resolve(True)} "
    + _annotation_rows(
        "SELECT DISTINCT decision AS target, uri AS body FROM wanted JOIN resolved USING (scheme, label) WHERE uri IS NOT NULL",
        br.TASK, _CLASSIFIER_AGENT,
    )
)
_VERDICTS = f"""asked AS (SELECT annotation, concept, label, concat('Policy text: ', content, chr(10), 'Label: ', label, chr(10), chr(10), 'Provide a structured impact assessment.{impact_format()}') AS prompt
    FROM assessable JOIN policy USING (expression)),
  verdicts AS (SELECT annotation, concept, label, ['positive', 'negative', 'neutral', 'uncertain', 'mixed'][1 + {_NUMBER} % 5] AS direction FROM asked),
  firsts AS (SELECT annotation, arg_min(direction, struct_pack(a := concept, b := label, c := direction)) AS direction FROM verdicts WHERE direction <> 'mixed' GROUP BY annotation)"""
_FIRST_URIS = "SELECT annotation, CASE direction " + " ".join(f"WHEN '{k}' THEN '{u}'" for k, u in v.IMPACT_URIS.items()) + " END AS uri FROM firsts"
IMPACT_JOB = (
    f"{quads_sql(*_LABELLED, 'inputs')}, {_assessable(br.IMPACT_TASK)}, {_POLICY}, {_VERDICTS}, "
    f"containers AS ({_container_quads('SELECT annotation AS resource FROM firsts', br.IMPACT_TASK)}), {_store(_FIRST_URIS)} "
    "UNION ALL SELECT g, s, p, o FROM containers"
)
STREAM_DEDUP = _annotation_rows(
    "SELECT DISTINCT concat('http://ex/user/', user_id) AS target, concat('http://ex/event/', event_type) AS body FROM events",
    br.TASK, _MODEL_AGENT,
)

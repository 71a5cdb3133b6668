"""Fixed values of the data model: vocabulary terms, graph roles, prompt texts.

They have to be exactly these, because stored quads and model prompts use them.
"""

from __future__ import annotations

import json

# --- fixed values: namespaces -------------------------------------------------
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
OA = "http://www.w3.org/ns/oa#"
PROV = "http://www.w3.org/ns/prov#"
SH = "http://www.w3.org/ns/shacl#"
DCT = "http://purl.org/dc/terms/"
ELI = "http://data.europa.eu/eli/ontology#"
ELI_DL = "http://data.europa.eu/eli/eli-draft-legislation-ontology#"
EPVOC = "https://data.europarl.europa.eu/def/epvoc#"
NFO = "http://www.semanticdesktop.org/ontologies/2007/03/22/nfo#"
MU = "http://mu.semte.ch/vocabularies/core/"
EXT = "http://mu.semte.ch/vocabularies/ext/"
TASK = "http://redpencil.data.gift/vocabularies/tasks/"
AIRO = "https://w3id.org/airo#"
DQV = "http://www.w3.org/ns/dqv#"
SD = "https://w3id.org/okn/o/sd#"
SCHEMA = "http://schema.org/"

# --- fixed values: classes ----------------------------------------------------
EXPRESSION = ELI + "Expression"
WORK = ELI + "Work"
CONCEPT = SKOS + "Concept"
ANNOTATION = OA + "Annotation"
ACTIVITY = PROV + "Activity"
NO_MATCH_CLASS = EXT + "NoMatchFound"
DATA_CONTAINER = NFO + "DataContainer"

# --- fixed values: predicates -------------------------------------------------
TYPE = RDF + "type"
IN_SCHEME = SKOS + "inScheme"
FOR_SCHEME = EXT + "forConceptScheme"
PREF_LABEL = SKOS + "prefLabel"
DEFINITION = SKOS + "definition"
HAS_TARGET = OA + "hasTarget"
HAS_BODY = OA + "hasBody"
MOTIVATED_BY = OA + "motivatedBy"
CLASSIFYING = OA + "classifying"
TITLE = ELI + "title"
DESCRIPTION = ELI + "description"
DECISION_BASIS = ELI_DL + "decision_basis"
CONTENT = EPVOC + "expressionContent"
LANGUAGE = ELI + "language"
DCT_LANGUAGE = DCT + "language"
REALIZED_BY = ELI + "is_realized_by"
PART_OF = DCT + "isPartOf"
JOB_CODELIST = EXT + "codelist"
JOB_TARGET_GRAPH = EXT + "graphForTargets"
JOB_SHAPE = EXT + "shapeForTargets"
JOB_TEXT_PATH = EXT + "propertyPathForText"
JOB_THRESHOLD = EXT + "confidenceThreshold"
TARGET_NODE = SH + "targetNode"
TARGET_CLASS = SH + "targetClass"
INPUT_CONTAINER = TASK + "inputContainer"
HAS_RESOURCE = TASK + "hasResource"
UUID = MU + "uuid"
GENERATED = PROV + "generated"
ASSOCIATED_WITH = PROV + "wasAssociatedWith"

# --- fixed values: marker resources -------------------------------------------
NO_MATCH = EXT + "no-match-found"
IMPACT_URIS = {
    "positive": EXT + "impact/positive",
    "negative": EXT + "impact/negative",
    "neutral": EXT + "impact/neutral",
    "uncertain": EXT + "impact/unknown",
}
CONFIDENCE_LEVELS = ("low", "medium", "high")
LABEL_LANGUAGES = ("en", "")
DEFAULT_THRESHOLD = 0.5
SINGLE_LABEL = "single_label_classification"
MULTI_LABEL = "multi_label_classification"

# Text properties of an expression in the order in which they are joined.
TEXT_PROPERTIES = {
    "title": TITLE,
    "description": DESCRIPTION,
    "decision_basis": DECISION_BASIS,
    "content": CONTENT,
}

# --- fixed values: prompt texts -----------------------------------------------
DEFAULT_SYSTEM_MESSAGE = (
    "You are a juridical and administrative assistant that must determine "
    "the best matching codes from a list with a given text."
)
DEFAULT_USER_MESSAGE = (
    "Determine the best matching codes from the following list for the given public decision.\n\n"
    '"""CODE LIST:\n{code_list}\n"""\n\n'
    '"""DECISION TEXT:\n{decision_text}\n"""'
    "Provide your answer as a list of strings representing the matching codes. "
    "You MUST only return values that appear EXACTLY in the CODE LIST above, NOT from the label descriptions. "
    "Provide all matching codes (can be a single one), but only those that are truly matching. "
    "If none of the codes match, return an empty list."
)
REPLY_SCHEMA = {
    "properties": {
        "designated_classes": {
            "description": "List of matching class labels copied exactly from the provided CODE LIST. "
            "Each value must be the full label text as it appears in the list. "
            "Return an empty list if none of the classes match.",
            "items": {"type": "string"},
            "title": "Designated Classes",
            "type": "array",
        }
    },
    "required": ["designated_classes"],
    "title": "EntityLinkingTaskOutput",
    "type": "object",
}
REPLY_INSTRUCTION = (
    "\n\nIMPORTANT: You must respond ONLY with valid JSON matching this schema:\n"
    + json.dumps(REPLY_SCHEMA, indent=2)
    + "\nDo not include any text before or after the JSON."
)
IMPACT_SYSTEM_MESSAGE = """
        You are a policy impact analyst specializing in sustainable development and governance.

        You will be given:
        1. A **policy text** — a description of a decision, regulation, or initiative
        2. A **label** — a classification (e.g. an SDG goal, a thematic domain) that has already been assigned to this policy

        Your task is to assess whether the impact of this policy on the given label's domain is **positive**, **negative**, **neutral** or **uncertain**.

        Follow this reasoning process:
        1. Identify the core intent and mechanisms of the policy
        2. Consider the specific scope and targets of the given label
        3. Assess direct effects first, then second-order effects
        4. Weigh both short-term and long-term consequences
        5. Conclude with an overall impact direction and confidence level (**low**, **medium** or **high**)

        Be precise, grounded, and concise. Avoid generic praise or criticism.
        """

# --- settings with defaults (a caller may pass others) ------------------------
GRAPHS = {
    "jobs": "http://example.org/graphs/jobs",
    "data_containers": "http://example.org/graphs/data-containers",
    "expressions": "http://example.org/graphs/public",
    "works": "http://example.org/graphs/public",
    "ai": "http://example.org/graphs/ai",
    "public": "http://example.org/graphs/public",
}
AGENTS = {
    "model_annotator": "http://example.org/agents/model-annotator",
    "classifier_annotator": "http://example.org/agents/classifier-annotator",
    "impact_annotator": "http://example.org/agents/impact-annotator",
}
AGENT_TYPE = AIRO + "AIComponent"
CONTAINER_BASE = "http://example.org/id/data-container/"
ANNOTATION_BASE = "http://example.org/id/annotation/"
ACTIVITY_BASE = "http://example.org/id/activity/"

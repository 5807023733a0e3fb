"""Closed vocabularies. They must equal those of the data's producers."""

from __future__ import annotations

# Fixed values.
SECTION_ORDER = ("problem", "method", "evidence")
SECTION_UNIT_TYPES = {
    "problem": ("Problem",),
    "method": ("Contribution", "Component"),
    "evidence": ("Contribution", "Measure", "ExperimentSetup", "Finding"),
}
PREFERRED_ANCHOR = {"problem": "Problem", "method": "Contribution", "evidence": "Measure"}
TYPED_ARRAY_KEYS = {
    "problems": "Problem",
    "contributions": "Contribution",
    "components": "Component",
    "experiment_setups": "ExperimentSetup",
    "measures": "Measure",
    "findings": "Finding",
}
ID_PREFIX = {
    "Contribution": "con",
    "Component": "cmp",
    "ExperimentSetup": "exp",
    "Measure": "mea",
    "Finding": "fnd",
    "Problem": "prb",
}
ID_ALIASES = {"setting": "exp", "set": "exp", "ent": "exp", "met": "mea", "clm": "fnd", "ctx": "prb"}

# Fixed values.
CONTRIBUTION_KINDS = ("method", "dataset", "benchmark", "finding")
SETUP_KINDS = ("dataset", "benchmark", "task", "data_split", "inference_protocol", "training_config", "ensembling", "population")
DOCUMENT_KINDS = ("research_article", "review", "meta_analysis", "methodology", "benchmark_survey")
FINDING_KINDS = ("descriptive", "mechanistic", "comparative", "modeling", "ablation_finding", "failure_mode", "theorem", "lemma", "bound")
POLARITIES = ("positive", "negative", "neutral", "mixed")
METHOD_KINDS = (
    "algorithm", "model_architecture", "training_strategy", "objective_function", "resource", "taxonomy", "theorem", "lemma",
    "bound", "definition", "assumption",
)
DIRECTIONS = ("higher_is_better", "lower_is_better", "target", "unspecified")
VALUE_KINDS = ("numeric", "symbolic", "asymptotic", "qualitative", "curve")
TABLE_ROLES = ("main_result", "ablation")
KINDS_BY_TYPE = {"Document": DOCUMENT_KINDS, "Contribution": CONTRIBUTION_KINDS, "ExperimentSetup": SETUP_KINDS, "Finding": FINDING_KINDS}
METHOD_FAMILY = ("Contribution", "Component")
EVAL_FRAME_WORDS = ("evaluation", "eval", "dataset", "benchmark", "experiments", "experiment")
ACCEPTED_VERSIONS = ("section-ir-0.12", "section-ir-0.13", "section-ir-0.14", "section-ir-0.15", "section-ir-0.16", "section-ir-0.17")
RECONCILE_VERSIONS = ("section-ir-0.12", "section-ir-0.13", "section-ir-0.14", "section-ir-0.15")
CITATION_ROLES = (
    "compares_with", "uses_component", "builds_on", "inspired_by", "adapts_idea_from", "addresses_limitation_of", "analyzes_property_of",
)
REFERENCE_EDGE_ROLES = ("builds_on", "uses", "compares_to")
_PARTS = ("Contribution", "Component", "ExperimentSetup")
RELATION_MATRIX = {
    "part_of": (("Component", "ExperimentSetup"), _PARTS),
    "builds_on": (_PARTS, _PARTS),
    "uses": (_PARTS, _PARTS),
    "co_contribution": (("Contribution",), ("Contribution",)),
    "compares_to": ((*_PARTS, "Measure"), (*_PARTS, "Measure")),
    "evaluates": (("Measure",), METHOD_FAMILY),
    "about": (("Finding",), (*_PARTS, "Measure")),
    "supports": (("Measure", "Finding", *METHOD_FAMILY), ("Finding",)),
    "motivates": (("Problem",), _PARTS),
    "resolves": (("Finding",), ("Problem",)),
}


def matrix_rows() -> list[tuple[str, str, str]]:
    return [(r, s, t) for r, (sources, targets) in RELATION_MATRIX.items() for s in sources for t in targets]


def section_unit_rows() -> list[tuple[str, str]]:
    return [(s, t) for s, types in SECTION_UNIT_TYPES.items() for t in types]


# What records may hold beside the vocabularies above.
UNIT_TYPES = ("Document", *ID_PREFIX)
RETIRED_TYPES = (
    "RoleBinding", "Relation", "MethodArtifact", "SystemModel", "Proposition", "Category", "Provenance", "Entity", "Setting", "Metric", "Claim", "Method",
)
TOP_KEYS = ("document", "sections", "relations", "extraction_notes")
SECTION_KEYS = ("section_type", "anchor_id", "covers_entries", "units")
NOTE_KEYS = ("ir_version", "sections_used", "uncertain_assignments", "skipped_spans", "input_mode", "uncovered_items", "plan_coverage")
INPUT_MODE = "node_census_pipeline"
FORMULA_ROLES = ("objective",)
OBJECTIVE_CLASSES = ("primary_quality", "cost_efficiency", "fairness", "safety", "robustness")
_ALGORITHM_KEYS = ("inputs", "outputs", "formulas", "implementation_notes", "cite_keys", "ref_ids", "provenance")
UNIT_KEYS = {
    "Document": ("id", "type", "doc_id", "title", "kind", "thesis", "headline_result", "provenance", "topics", "tasks", "domain"),
    "Problem": ("id", "type", "description", "provenance"),
    "Contribution": ("id", "type", "kind", "name", "method_kind", "description", *_ALGORITHM_KEYS),
    "Component": ("id", "type", "name", "method_kind", "description", *_ALGORITHM_KEYS),
    "ExperimentSetup": ("id", "type", "kind", "name", "description", "cite_keys", "ref_ids", "provenance"),
    "Measure": (
        "id", "type", "name", "unit", "scores", "setup_ids", "comparison_direction", "objective_class", "source_table_marker", "caption_marker",
        "table_role", "headline_result", "finding_ids", "has_quantitative_payload", "provenance",
    ),
    "Finding": ("id", "type", "kind", "statement", "polarity", "effect_size", "scope", "provenance"),
}

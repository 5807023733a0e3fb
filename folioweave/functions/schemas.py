"""Schemas of the records and of the model outputs, made from the vocabularies (schema generation, V1)."""

from __future__ import annotations

from pyspark.sql import types as T

from folioweave.functions import vocab

_ID = {"type": "string", "pattern": "^[a-z][a-z0-9_]*:[a-z0-9_]+$"}
_TEXT = {"type": "string"}
_TEXTS = {"type": "array", "items": _TEXT}


def enum(values: tuple[str, ...]) -> dict:
    return {"type": "string", "enum": list(values)}


def closed(properties: dict, optional: tuple[str, ...] = ()) -> dict:
    """An object without further properties whose properties but the optional ones are required."""
    return {"type": "object", "properties": properties, "required": [k for k in properties if k not in optional], "additionalProperties": False}


def score_schema() -> dict:
    texts = {k: _TEXT for k in ("variant", "value", "variance", "system_id", "setup_id")}
    return closed(texts | {"value_kind": enum(vocab.VALUE_KINDS), "opponent_id": _TEXT, "judge_id": _TEXT}, ("value_kind", "opponent_id", "judge_id"))


def unit_schema(kind: str) -> dict:
    """The schema of a unit of one type as a model writes it."""
    base = {"id": _ID | {"pattern": f"^{vocab.ID_PREFIX[kind]}:[a-z0-9_]+$"}, "type": enum((kind,)), "provenance": _TEXTS}
    formula = closed({"name": _TEXT, "expression": _TEXT, "role": enum(("objective",)), "description": _TEXT}, ("role", "description"))
    method = {"name": _TEXT, "description": _TEXT, "method_kind": enum(vocab.METHOD_KINDS), "inputs": _TEXTS, "outputs": _TEXTS, "formulas": {"type": "array", "items": formula}, "implementation_notes": _TEXT}
    loose = ("method_kind", "inputs", "outputs", "formulas", "implementation_notes")
    if kind == "Problem":
        return closed(base | {"description": _TEXT})
    if kind == "Contribution":
        return closed(base | {"kind": enum(vocab.CONTRIBUTION_KINDS)} | method, loose)
    if kind == "Component":
        return closed(base | method, loose)
    if kind == "ExperimentSetup":
        return closed(base | {"kind": enum(vocab.SETUP_KINDS), "name": _TEXT, "description": _TEXT}, ("description",))
    if kind == "Finding":
        return closed(base | {"kind": enum(vocab.FINDING_KINDS), "statement": _TEXT, "polarity": enum(vocab.POLARITIES), "effect_size": _TEXT, "scope": _TEXT}, ("polarity", "effect_size", "scope"))
    measure = {"name": _TEXT, "unit": _TEXT, "setup_ids": _TEXTS, "scores": {"type": "array", "items": score_schema()}, "comparison_direction": enum(vocab.DIRECTIONS),
               "source_table_marker": _TEXT, "caption_marker": _TEXT, "table_role": enum(vocab.TABLE_ROLES), "headline_result": _TEXT, "finding_ids": _TEXTS}
    return closed(base | measure, ("comparison_direction", "source_table_marker", "caption_marker", "table_role", "headline_result", "finding_ids"))


def section_schema(section: str) -> dict:
    """The schema of one section: its typed arrays and its own edges."""
    keys = {t: k for k, t in vocab.TYPED_ARRAY_KEYS.items()}
    arrays = {keys[t]: {"type": "array", "items": unit_schema(t)} for t in vocab.SECTION_UNIT_TYPES[section]}
    relations = {"problem": ("motivates",), "method": (), "evidence": ("about", "supports")}[section]
    edge = closed({"source_id": _ID, "relation": enum(relations), "target_id": _ID, "provenance": _TEXTS})
    extra = {"relations": {"type": "array", "items": edge}} if relations else {}
    return closed({"section_type": enum((section,)), "anchor_id": _ID} | arrays | extra)


def prompt_lines(schema: dict, depth: int = 0) -> str:
    """A schema as indented lines for a prompt."""
    kind = schema.get("type")
    if "enum" in schema:
        return " | ".join(schema["enum"])
    if kind == "array":
        return "list of " + prompt_lines(schema["items"], depth)
    if kind != "object":
        return str(kind)
    pad = "  " * (depth + 1)
    rows = [f"{pad}{k}{'' if k in schema['required'] else '?'}: {prompt_lines(v, depth + 1)}" for k, v in schema["properties"].items()]
    return "{\n" + "\n".join(rows) + "\n" + "  " * depth + "}"


_SPARK = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}


def spark_type(schema: dict) -> T.DataType:
    """The Spark type of a JSON schema; every field nullable, as records are dirty."""
    if schema["type"] == "array":
        return T.ArrayType(spark_type(schema["items"]))
    if schema["type"] == "object":
        return T.StructType([T.StructField(k, spark_type(v)) for k, v in schema["properties"].items()])
    return _SPARK[schema["type"]]

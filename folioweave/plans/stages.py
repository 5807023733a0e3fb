"""The model stages of a paper (L1-L6): the prompt of each, and the tables that its answers become.

A stage is a prompt over columns of a paper, one generic map (``model.run_stage``) and a projection of the
answers by the stage's schema. Section prompts share their first part, byte by byte, so that a provider can
cache it: the paper, its summary, nodes and relations come first, the module of the section last (L9).

Defined results: an answer that is null or no object has no rows; fields that are missing or of another type are
null; entries of lists that are no objects are rows of nulls; an empty table of papers gives empty tables.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.functions.schemas import closed, enum, prompt_lines, section_schema, spark_type
from folioweave.operators.text import body_slice, metadata_slice, references_blob

_TEXT = {"type": "string"}
_TEXTS = {"type": "array", "items": _TEXT}


def _list(properties: dict, optional: tuple[str, ...] = ()) -> dict:
    return {"type": "array", "items": closed(properties, optional)}


_NODE = {"node_id": _TEXT, "type": enum(("Problem", "Contribution", "Component", "ExperimentSetup")), "kind": _TEXT, "name": _TEXT, "description": _TEXT, "provenance": _TEXTS, "cite_keys": _TEXTS}
_SPINE = closed({"central_contribution": _TEXT, "argument_flow": _TEXT, "research_problem": _TEXT, "headline_result": _TEXT, "topics": _TEXTS, "tasks": _TEXTS, "domain": _TEXT}, ("research_problem", "headline_result", "topics", "tasks", "domain"))
_EDGE = {"source_id": _TEXT, "relation": enum(tuple(vocab.RELATION_MATRIX)), "target_id": _TEXT, "provenance": _TEXTS}
SCHEMAS = {
    "census": closed({"spine_summary": _SPINE, "nodes": _list(_NODE, ("kind",))}),
    "relations": closed({"relations": _list(_EDGE)}),
    "metadata": closed({"title": _TEXT, "authors": _list({"name": _TEXT, "affiliations": _TEXTS}), "year": {"type": "integer"}, "venue": _TEXT, "resources": _list({"type": _TEXT, "url": _TEXT})}, ("year", "venue")),
    "citations": closed({"citations": _list({"cite_key": _TEXT, "relations": _list({"role": enum(vocab.CITATION_ROLES), "signal": _TEXT})})}),
    "references": closed({"references": _list({"cite_key": _TEXT, "title": _TEXT, "authors": _TEXTS, "venue": _TEXT, "year": {"type": "integer"}}, ("venue", "year"))}),
} | {f"section:{s}": section_schema(s) for s in vocab.SECTION_ORDER}

#: What each stage asks for, beside its schema.
TASKS = {
    "census": "Summarise the paper and list the things it is about: its problems, contributions, their components, and the data and set-ups it experiments with. Cite the block of each as its provenance.",
    "relations": "State how the listed nodes relate to each other. Use only their ids, and only relations that the text states.",
    "metadata": "Give the title, authors, year, venue and released resources as the paper prints them.",
    "citations": "List the works that the paper relates itself to, with the role of each and the words that show it.",
    "references": "List the works of this bibliography.",
    "section:problem": "Describe the problems that the paper addresses.",
    "section:method": "Describe the contributions and their components, with their formulas.",
    "section:evidence": "List the set-ups, the measures with their scores, and the findings that they support.",
}


@dataclass(frozen=True)
class Inputs:
    """papers(paper_id, text), and for the later stages census(paper_id, spine, nodes) and relations(paper_id, edges), as text."""

    papers: DataFrame
    census: DataFrame | None = None
    relations: DataFrame | None = None


def _asked(stage: str) -> Column:
    return F.lit(f"{TASKS[stage]}\n\nAnswer with one JSON object:\n{prompt_lines(SCHEMAS[stage])}\n")


def shared_part(i: Inputs) -> DataFrame:
    """paper_id and the part of the prompt that all sections of a paper share."""
    body = i.papers.select("paper_id", body_slice(F.col("text")).alias("body"))
    known = body.join(i.census, "paper_id") if i.census is not None else body.withColumns({"spine": F.lit(None).cast("string"), "nodes": F.lit(None).cast("string")})
    known = known.join(i.relations, "paper_id", "left") if i.relations is not None else known.withColumn("edges", F.lit(None).cast("string"))
    part = lambda name, c: F.concat(F.lit(f"{name}\n"), F.coalesce(c, F.lit("none")), F.lit("\n\n"))
    return known.select("paper_id", F.concat(part("PAPER", F.col("body")), part("SUMMARY", F.col("spine")), part("NODES", F.col("nodes")), part("RELATIONS", F.col("edges"))).alias("shared"))


def prompts(stage: str, i: Inputs) -> DataFrame:
    """(paper_id, stage, prompt) of one stage; papers without the input of a stage have no prompt."""
    p = i.papers.where("text is not null")
    if stage == "metadata":
        given = metadata_slice(p, "paper_id").withColumnRenamed("slice", "given")
    elif stage == "references":
        given = p.select("paper_id", references_blob(F.col("text")).alias("given")).where("given <> ''")
    elif stage == "citations":
        given = p.select("paper_id", body_slice(F.col("text")).alias("given"))
    elif stage == "census":
        given = p.select("paper_id", body_slice(F.col("text")).alias("given"))
    else:
        shared = shared_part(Inputs(p, i.census, i.relations if stage != "relations" else None))
        return shared.select("paper_id", F.lit(stage).alias("stage"), F.concat("shared", F.lit("TASK\n"), _asked(stage)).alias("prompt"))
    return given.select("paper_id", F.lit(stage).alias("stage"), F.concat(F.lit("PAPER\n"), "given", F.lit("\n\nTASK\n"), _asked(stage)).alias("prompt"))


def answered(answers: DataFrame, stage: str) -> DataFrame:
    """paper_id and ``a``, the answers of one stage as a column of its schema's type."""
    mine = answers.where((F.col("stage") == stage) & F.col("answer").isNotNull())
    return mine.select("paper_id", F.from_json("answer", spark_type(SCHEMAS[stage]), {"mode": "PERMISSIVE"}).alias("a")).where("a is not null")


def _exploded(answers: DataFrame, stage: str, field: str) -> DataFrame:
    return answered(answers, stage).select("paper_id", F.posexplode(f"a.{field}").alias("ord", "x"))


def census_nodes(answers: DataFrame) -> DataFrame:
    """L1: the planned nodes, as the repair steps read them."""
    n = _exploded(answers, "census", "nodes")
    return n.select("paper_id", F.col("x.node_id").alias("id"), *(f"x.{c}" for c in ("type", "kind", "name", "description", "provenance", "cite_keys")), "ord")


def summaries(answers: DataFrame) -> DataFrame:
    """L1: the summary of every paper."""
    return answered(answers, "census").select("paper_id", "a.spine_summary.*")


def relation_edges(answers: DataFrame) -> DataFrame:
    """L2: the relations between nodes."""
    return _exploded(answers, "relations", "relations").select("paper_id", "x.*", "ord")


def section_units(answers: DataFrame) -> DataFrame:
    """L3: the units of all sections (paper_id, section, type, ord, id, and the unit as JSON text)."""
    out: DataFrame | None = None
    for section, types in vocab.SECTION_UNIT_TYPES.items():
        rows = answered(answers, f"section:{section}")
        for rank, (key, kind) in enumerate(vocab.TYPED_ARRAY_KEYS.items()):
            if kind not in types:
                continue
            one = rows.select("paper_id", F.posexplode(f"a.{key}").alias("pos", "x"))
            one = one.select("paper_id", F.lit(section).alias("section"), F.lit(kind).alias("type"), F.struct(F.lit(rank).alias("rank"), "pos").alias("ord"), F.col("x.id").alias("id"), F.to_json("x").alias("unit"))
            out = one if out is None else out.unionByName(one)
    return out


def section_edges(answers: DataFrame) -> DataFrame:
    """L3: the relations that the sections state themselves."""
    out: DataFrame | None = None
    for section in vocab.SECTION_ORDER:
        if "relations" in SCHEMAS[f"section:{section}"]["properties"]:
            one = _exploded(answers, f"section:{section}", "relations").select("paper_id", F.lit(section).alias("section"), "x.*", "ord")
            out = one if out is None else out.unionByName(one)
    return out


def metadata(answers: DataFrame) -> DataFrame:
    """L4: title, authors, year, venue and resources of every paper, as ``enrich_metadata`` reads them."""
    return answered(answers, "metadata").select("paper_id", "a.title", F.transform("a.authors", lambda x: x["name"]).alias("authors"), "a.venue", F.col("a.year").cast("int").alias("year"), "a.resources")


def citations(answers: DataFrame) -> DataFrame:
    """One row per cited work and role, as the grouping of citations reads them."""
    c = _exploded(answers, "citations", "citations").select("paper_id", "ord", "x.cite_key", F.explode("x.relations").alias("r"))
    return c.select("paper_id", "ord", "cite_key", "r.role", "r.signal")


def references(answers: DataFrame) -> DataFrame:
    """The works of every bibliography."""
    return _exploded(answers, "references", "references").select("paper_id", "ord", "x.cite_key", "x.title", "x.authors", "x.venue", F.col("x.year").cast("int").alias("year"))


def census_input(answers: DataFrame) -> DataFrame:
    """(paper_id, spine, nodes) as text, for the prompts of the later stages."""
    return answered(answers, "census").select("paper_id", F.to_json("a.spine_summary").alias("spine"), F.to_json("a.nodes").alias("nodes"))


def relation_input(answers: DataFrame) -> DataFrame:
    """(paper_id, edges) as text."""
    return answered(answers, "relations").select("paper_id", F.to_json("a.relations").alias("edges"))


def stand_in(stage: str, prompt: str) -> str:
    """An answer of the right form for tests: one entry in every list."""

    def value(schema: dict) -> object:
        if "enum" in schema:
            return schema["enum"][0]
        kind = schema["type"]
        if kind == "object":
            return {k: value(v) for k, v in schema["properties"].items()}
        return [value(schema["items"])] if kind == "array" else {"integer": 2020, "number": 1.5, "boolean": True}.get(kind, "x")

    return json.dumps(value(SCHEMAS[stage]))

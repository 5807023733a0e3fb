"""The whole assembly (R33): the repair steps over the graphs of a corpus, in their order, with a log of what each step did.

Every step is a set operation over all papers. The lineage is cut after each group of steps, as all of them in one plan
would grow beyond what the optimizer can handle. The log has a row (paper_id, step, subject) for each thing that a step
dropped, changed or added.

Defined results: papers without planned nodes, captured tables, headings or a headline go through the steps that need them
unchanged; an empty corpus gives empty tables and an empty log.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.functions.scalar import truthy
from folioweave.operators import assemble as A
from folioweave.operators import graph as G
from folioweave.session import cut


@dataclass(frozen=True)
class Context:
    """What a paper's steps know beside its record: planned nodes, captured tables (paper_id, marker, caption), blocks
    (paper_id, marker), heading labels (paper_id, label, marker) and headlines (paper_id, headline)."""

    nodes: DataFrame
    tables: DataFrame
    blocks: DataFrame
    labels: DataFrame
    headlines: DataFrame


@dataclass(frozen=True)
class Assembled:
    """The repaired graph, the log of the steps, and what is derived from it per paper."""

    graph: G.Graph
    log: DataFrame
    coverage: DataFrame
    documents: DataFrame


def _said(step: str, rows: DataFrame, subject: str) -> DataFrame:
    return rows.select("paper_id", F.lit(step).alias("step"), F.col(subject).cast("string").alias("subject"))


def _gone(step: str, before: DataFrame, after: DataFrame, place: list[str], subject: str) -> DataFrame:
    """Rows of ``before`` that ``after`` has no more."""
    return _said(step, before.join(after.select(*place).dropDuplicates(), place, "left_anti"), subject)


def _changed(step: str, before: DataFrame, after: DataFrame, place: list[str], columns: list[str], subject: str) -> DataFrame:
    """Rows of both whose columns differ."""
    new = after.select(*place, F.struct(*columns).alias("__new"))
    return _said(step, before.join(new, place).where(~F.struct(*columns).eqNullSafe(F.col("__new"))), subject)


UNIT = ["paper_id", "ord"]
SCORE = ["paper_id", "ord", "row_no"]


def assemble(g: G.Graph, x: Context) -> Assembled:
    """The steps R1 to R32 in their order."""
    log: list[DataFrame] = []
    g = g.cut()
    raw = g
    g = G.aliased(G.flattened(g))  # R1, R3; R2 is the order in which the graph's edges were read
    log.append(_gone("R1", raw.units, g.units, UNIT, "id"))
    g = G.stamped(g, x.nodes).cut()  # R4
    log.append(_changed("R4", raw.units, g.units, UNIT, ["kind"], "id"))
    g, remap = G.sanitized(g)  # R5
    g = g.cut()
    log.append(_said("R5", remap, "old_id"))

    units = A.misrouted(g.units.where("id is not null"), x.nodes).select(*g.units.columns)  # R6
    units = units.unionByName(g.units.where("id is null"))
    log += [_gone("R6", g.units, units, UNIT, "id"), _changed("R6", g.units, units, UNIT, ["type"], "id")]
    owned = cut(A.owned(units).select(*g.units.columns))  # R7
    log.append(_gone("R7", units, owned, UNIT, "id"))
    # R8; a statement stands for a description.
    frames = cut(A.eval_frames(owned.withColumn("description", F.concat_ws(" ", "description", "statement")), x.nodes))
    kept = owned.join(frames.select("paper_id", F.col("old_id").alias("id")), A.KEY, "left_anti")
    g = replace(g, units=kept, edges=A.rewrite_edges(g.edges, frames).select(*g.edges.columns))
    log.append(_said("R8", frames, "old_id"))
    twins = cut(A.duplicate_setups(g.units, x.nodes))  # R9
    kept = g.units.join(twins.select("paper_id", F.col("old_id").alias("id")), A.KEY, "left_anti")
    g = G.rewritten(G._with_units(g, kept), twins).cut()  # R10
    log.append(_said("R9", twins, "old_id"))
    first = A.first_units(g.units.where("id is not null"))  # R11
    first = g.units.join(first.select(*UNIT), UNIT, "left_semi")
    log.append(_gone("R11", g.units, first, UNIT, "id"))
    before = g.units
    g = G.without_lost_markers(G._with_units(g, cut(first)), x.tables)  # R12
    log.append(_changed("R12", before, g.units, UNIT, ["source_table_marker", "caption_marker"], "id"))
    g, dropped = G.without_empty_measures(g)  # R13
    dropped = cut(dropped)
    log.append(_said("R13", dropped, "id"))
    repeated = A.duplicate_scores(g.scores)  # R14
    log.append(_said("R14", repeated, "measure_id"))
    filled = A.nonempty_sections(g.sections, g.units)  # R34
    filled = g.sections.join(g.units.select("paper_id", "section_no").dropDuplicates(), ["paper_id", "section_no"], "left_semi")
    log.append(_gone("R34", g.sections, filled, ["paper_id", "section_no"], "section"))
    before = g.units
    listed = lambda df: A.normalize_provenance(df, x.labels).withColumn("provenance_listed", F.lit(True)).select(*df.columns)
    g = replace(g, sections=filled, units=listed(g.units), edges=listed(g.edges)).cut()  # R15
    log.append(_changed("R15", before, g.units, UNIT, ["provenance"], "id"))

    for step, repair, place, columns, table in (
        ("R16", G.backfilled, UNIT, ["provenance", "unit"], "units"),
        ("R17", G.anchored, ["paper_id", "section_no"], ["anchor_id"], "sections"),
        ("R18", G.references_repaired, SCORE, list(G.REFERENCES), "scores"),
        ("R19", G.enums_repaired, UNIT, ["kind", "polarity", "method_kind", "comparison_direction", "table_role", "objective_class"], "units"),
        ("R20", G.formulas_cleaned, UNIT, ["formulas"], "units"),
    ):
        old, g = getattr(g, table), repair(g).cut()
        log.append(_changed(step, old, getattr(g, table), place, columns, {"units": "id", "sections": "section", "scores": "measure_id"}[table]))
    known = F.coalesce(A.mapped_lists(F.col("type"), vocab.UNIT_KEYS), F.array().cast("array<string>"))
    extra = g.units.where(F.size(F.array_except("keys", known)) > 0)  # R35: the tables have no column for other fields
    log.append(_said("R35", extra, "id"))
    g = replace(g, units=g.units.withColumn("keys", F.array_intersect("keys", known)))

    edges = A.first_edges(g.edges).select(*g.edges.columns)  # R36
    anchored = cut(A.anchored_edges(edges, g.units))  # R37
    log += [_gone("R36", g.edges, edges, UNIT, "source_id"), _gone("R37", edges, anchored, UNIT, "source_id")]
    faults = A.edge_faults(anchored, g.units)  # R21
    log.append(_said("R21", faults.where("fault is not null"), "source_id"))
    legal = cut(faults.where("fault is null").drop("fault"))
    more = A.missing_evaluates(g.units, legal, g.scores).withColumn("relation", F.lit("evaluates"))  # R22
    log.append(_said("R22", more, "source_id"))
    late = F.lit((1 << 63) - 2).cast("bigint")
    none = F.array().cast("array<string>")
    made = more.withColumns({"ord": late, "provenance": none, "provenance_listed": F.lit(True)})
    before = legal.unionByName(made.select(*legal.columns))
    g = G.mounted(replace(g, edges=before)).cut()  # R23
    log.append(_gone("R23", before, g.edges, [*UNIT, "source_id"], "source_id"))
    anchors = g.sections.where("section = 'problem'").select("paper_id", "anchor_id")
    texts = g.units.withColumn("description", F.coalesce("statement", "description"))
    closing = cut(A.resolves(texts, g.edges, x.nodes.where("type = 'Contribution'"), x.headlines, anchors))  # R24
    log.append(_said("R24", closing, "source_id"))
    # The provenance of the about edge, else of the Problem, else of the Finding.
    prov = lambda end, c: g.units.where(F.size("provenance") > 0).select("paper_id", F.col("id").alias(end), F.col("provenance").alias(c)).dropDuplicates(["paper_id", end])
    own = g.edges.where("relation = 'about' and size(provenance) > 0").groupBy("paper_id", "source_id").agg(F.min_by("provenance", "ord").alias("e"))
    closing = closing.join(own, ["paper_id", "source_id"], "left").join(prov("target_id", "p"), ["paper_id", "target_id"], "left").join(prov("source_id", "f"), ["paper_id", "source_id"], "left")
    closing = closing.withColumns({"relation": F.lit("resolves"), "ord": late + 1, "provenance": F.coalesce("e", "p", "f", none), "provenance_listed": F.lit(True)})
    edges = A.first_edges(g.edges.unionByName(closing.select(*g.edges.columns))).select(*g.edges.columns)  # R36
    units = A.has_payload(g.units)  # R25
    scores = A.score_numbers(g.scores)
    covers = A.covers(g.units, x.nodes).join(g.units.select("paper_id", "id", "section_no").dropDuplicates(), A.KEY)  # R26
    covers = covers.groupBy("paper_id", "section_no").agg(F.array_sort(F.collect_set("id")).alias("covers"))
    sections = g.sections.drop("covers").join(covers, ["paper_id", "section_no"], "left").withColumn("covers", F.coalesce("covers", none)).select(*g.sections.columns)
    captions = x.tables.where(truthy(F.col("caption"))).groupBy("paper_id", F.col("marker").alias("source_table_marker")).agg(F.min("caption").alias("caption"))
    units = units.join(captions, ["paper_id", "source_table_marker"], "left")  # R30
    keys = F.array(*map(F.lit, vocab.SECTION_KEYS))
    sections = sections.withColumns({"covers_listed": F.lit(True), "keys": keys})
    g = G.Graph(_noted(g.documents, x, g.units), sections, units, scores, edges).cut()
    uncovered = x.nodes.select(*A.KEY).dropDuplicates().join(g.units.select(*A.KEY).dropDuplicates(), A.KEY, "left_anti").join(g.documents.select("paper_id"), "paper_id", "left_semi")
    log.append(_said("R27", uncovered.unionByName(dropped.select(*A.KEY)).dropDuplicates(), "id"))
    return Assembled(g, cut(_union(log)), A.coverage(g.units, x.nodes.join(g.documents.select("paper_id"), "paper_id", "left_semi")), documents(g, x))


def _noted(documents: DataFrame, x: Context, units: DataFrame) -> DataFrame:
    """The record as the assembly writes it: its four parts, its notes and the kind of its document."""
    words = lambda w: F.array(*map(F.lit, w))
    kinds = A.document_kind(units, x.nodes.where("type = 'Contribution'")).withColumnRenamed("document_kind", "__kind")
    d = documents.join(kinds, "paper_id", "left").withColumns({
        "document_kind": F.coalesce("__kind", F.lit("research_article")), "document_type": F.lit("Document"), "keys": words(vocab.TOP_KEYS), "notes_keys": words(vocab.NOTE_KEYS),
        "notes_input_mode": F.lit(vocab.INPUT_MODE), "notes_ir_version": F.lit(vocab.ACCEPTED_VERSIONS[-1]), "edges_listed": F.lit(True), "sections_listed": F.lit(True),
    })
    return d.select(*documents.columns)


def documents(g: G.Graph, x: Context) -> DataFrame:
    """Per paper its sections in use, the kind of its document and the rate of its numeric markers that name a block."""
    used = g.sections.groupBy("paper_id").agg(F.array_sort(F.collect_set("section")).alias("sections_used"))
    kinds = A.document_kind(g.units, x.nodes.where("type = 'Contribution'"))
    marks = g.edges.select("paper_id", "provenance").unionByName(g.units.select("paper_id", "provenance"))
    rate = A.provenance_rate(marks, x.blocks)
    out = g.documents.select("paper_id", "doc_id", "title").join(used, "paper_id", "left").join(kinds, "paper_id", "left").join(rate, "paper_id", "left")
    return out.withColumn("document_kind", F.coalesce("document_kind", F.lit("research_article")))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

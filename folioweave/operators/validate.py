"""Validation of whole records (V1-V10): one table of rules, each a filter over the graph's tables, with messages.

Every fault is a row (paper_id, rule, subject, message). A rule reads its columns and joins at most one table of flags, so the
rules of one table are evaluated in one pass.

Defined results: null counts as absent; faults that occur twice are one row; papers without a record have no rows; an
empty graph has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.functions.scalar import MARKER_GRAMMAR, canon_marker, truthy
from folioweave.operators import assemble as A
from folioweave.operators.graph import REFERENCES, Graph

KEY = ["paper_id", "id"]


def _rows(table: DataFrame, subject: Column, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """The faults of each row: (rule, condition, message) where the condition holds; a null condition is none."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.coalesce(message, F.lit("")).alias("message"))) for rule, when, message in rules)))
    return table.select("paper_id", subject.cast("string").alias("subject"), F.explode(found).alias("f")).select("paper_id", "f.rule", "subject", "f.message")


def _say(text: str, *columns: Column) -> Column:
    return F.concat_ws(" ", F.lit(text), *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns))


def _outside(c: str, words: tuple[str, ...]) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*words)


def record_faults(g: Graph) -> DataFrame:
    """V1, V8: keys of the record, its document and its notes."""
    d = g.documents
    c = F.col
    rules = []
    for k in vocab.TOP_KEYS:
        rules.append(("V1 missing key", ~F.array_contains("keys", k), _say("missing top-level key", F.lit(k))))
    odd = F.array_except("keys", F.array(*map(F.lit, vocab.TOP_KEYS)))
    rules.append(("V1 unexpected key", F.size(odd) > 0, _say("unexpected top-level keys", F.array_join(odd, ", "))))
    rules.append(("V1 retired field", F.array_contains("document_keys", "paradigm_tags"), F.lit("retired field in the document")))
    rules.append(("V2 document type", F.array_contains("keys", "document") & (F.coalesce(c("document_type"), F.lit("")) != "Document"), _say("document has type", c("document_type"))))
    for k in ("doc_id", "title"):
        rules.append(("V4 document field", F.array_contains("keys", "document") & ~truthy(c(k)), _say("document lacks", F.lit(k))))
    rules.append(("V4 document kind", F.coalesce(~c("document_kind").isin(*vocab.DOCUMENT_KINDS), F.lit(True)) & F.array_contains("keys", "document"), _say("document kind", c("document_kind"))))
    rules.append(("V6 relations list", F.array_contains("keys", "relations") & ~c("edges_listed"), F.lit("relations are no list")))
    noted = F.array_contains("keys", "extraction_notes")
    rules.append(("V8 notes", ~noted, F.lit("no notes")))
    for k in vocab.NOTE_KEYS:
        rules.append(("V8 notes key", noted & ~F.array_contains("notes_keys", k), _say("notes lack", F.lit(k))))
    rules.append(("V8 input mode", noted & (F.coalesce(c("notes_input_mode"), F.lit("")) != vocab.INPUT_MODE), _say("input mode", c("notes_input_mode"))))
    version = F.coalesce("notes_ir_version", "document_ir_version")
    rules.append(("V8 version", F.coalesce(~version.isin(*vocab.ACCEPTED_VERSIONS), F.lit(True)), _say("version", version)))
    wrong = F.filter("sections_used", lambda s: ~s.isin(*vocab.SECTION_ORDER))
    rules.append(("V8 sections used", F.size(wrong) > 0, _say("unknown sections in use", F.array_join(wrong, ", "))))
    return _rows(d, c("doc_id"), rules)


def unit_faults(g: Graph) -> DataFrame:
    """V2, V3 and the fields of V4 that a unit's own row decides, and V5's types of a section."""
    c, t = F.col, F.col("type")
    known = F.coalesce(A.mapped_lists(t, vocab.UNIT_KEYS), F.array().cast("array<string>"))
    odd = F.array_except("keys", known)
    bad_marks = F.filter("provenance", lambda m: ~m.rlike(MARKER_GRAMMAR))
    family = t.isin(*vocab.METHOD_FAMILY)
    measure = t == "Measure"
    formulas = lambda test: F.exists("formulas", test)
    allowed = A.allowed_in(c("section"), t)
    rules = [
        ("V2 id", F.coalesce(~c("id").rlike(A.ID_FORMAT), F.lit(True)), _say("invalid id", c("id"))),
        ("V2 type", F.coalesce(~t.isin(*vocab.UNIT_TYPES), F.lit(True)), _say("invalid type", t)),
        ("V2 retired type", t.isin(*vocab.RETIRED_TYPES), _say("retired type", t)),
        ("V2 prefix", F.col("id").isNotNull() & t.isin(*vocab.ID_PREFIX) & (F.substring_index("id", ":", 1) != A.mapped(t, vocab.ID_PREFIX)), _say("prefix does not fit type", t)),
        ("V2 fields", t.isin(*vocab.UNIT_TYPES) & (F.size(odd) > 0), _say("unexpected fields", F.array_join(odd, ", "))),
        ("V2 section type", F.array_contains("keys", "section_type"), F.lit("unit holds a section_type")),
        ("V3 list", ~F.coalesce("provenance_listed", F.lit(False)), F.lit("provenance is no list")),
        ("V3 empty", t.isin("Finding", "Measure") & c("provenance_listed") & (F.size("provenance") == 0), F.lit("provenance is empty")),
        ("V3 marker", F.size(bad_marks) > 0, _say("no location marker", F.array_join(bad_marks, ", "))),
        ("V4 kind missing", t.isin(*vocab.KINDS_BY_TYPE) & ~truthy(c("kind")), F.lit("no kind")),
        ("V4 kind", t.isin(*vocab.KINDS_BY_TYPE) & truthy(c("kind")) & ~A.valid_kind(t, c("kind")), _say("invalid kind", c("kind"))),
        ("V4 name", (family | t.isin("ExperimentSetup", "Measure")) & ~truthy(c("name")), F.lit("no name")),
        ("V4 method kind", family & _outside("method_kind", vocab.METHOD_KINDS), _say("invalid method kind", c("method_kind"))),
        ("V4 expression", family & formulas(lambda f: ~truthy(f["expression"])), F.lit("a formula without an expression")),
        ("V4 formula role", family & formulas(lambda f: f["role"].isNotNull() & ~f["role"].isin(*vocab.FORMULA_ROLES)), F.lit("a formula with an invalid role")),
        ("V4 statement", (t == "Finding") & ~truthy(c("statement")), F.lit("no statement")),
        ("V4 polarity", (t == "Finding") & _outside("polarity", vocab.POLARITIES), _say("invalid polarity", c("polarity"))),
        ("V4 description", (t == "Problem") & ~truthy(c("description")), F.lit("no description")),
        ("V4 unit", measure & ~truthy(c("unit")), F.lit("no unit")),
        ("V4 scores", measure & ~F.coalesce("scores_listed", F.lit(False)), F.lit("scores are no list")),
        ("V4 no scores", measure & c("scores_listed") & (c("n_scores") == 0) & ~truthy(c("source_table_marker")), F.lit("neither scores nor a table marker")),
        ("V4 setups missing", measure & ~F.array_contains("keys", "setup_ids"), F.lit("no setup_ids")),
        ("V4 setups list", measure & F.array_contains("keys", "setup_ids") & ~c("setup_ids_listed"), F.lit("setup_ids are no list")),
        ("V4 direction", measure & _outside("comparison_direction", vocab.DIRECTIONS), _say("invalid direction", c("comparison_direction"))),
        ("V4 objective class", measure & _outside("objective_class", vocab.OBJECTIVE_CLASSES), _say("invalid objective class", c("objective_class"))),
        ("V4 table role", measure & _outside("table_role", vocab.TABLE_ROLES), _say("invalid table role", c("table_role"))),
        ("V4 findings list", measure & F.array_contains("keys", "finding_ids") & ~c("finding_ids_listed"), F.lit("finding_ids are no list")),
        ("V5 type in section", c("section").isin(*vocab.SECTION_ORDER) & ~allowed, _say("type not allowed in section", t, c("section"))),
    ]
    repeated = g.units.where("id is not null").groupBy(*KEY).count().where("count > 1")
    more = repeated.select("paper_id", F.lit("V2 repeated id").alias("rule"), F.col("id").alias("subject"), _say("times", F.col("count")).alias("message"))
    return _rows(g.units, c("id"), rules).unionByName(more)


def _index(g: Graph) -> DataFrame:
    """The first unit of every id, as references see it."""
    return A.first_units(g.units.where("id is not null").select(*KEY, "section_no", "section", "type", "kind", "ord"))


def reference_faults(g: Graph) -> DataFrame:
    """V4: score rows and the lists of Measures against the units they name."""
    c = F.col
    index = _index(g).select("paper_id", F.col("id").alias("ref"), F.col("type").alias("ref_type"), F.col("kind").alias("ref_kind"))
    local = g.units.select("paper_id", "section_no", F.col("id").alias("ref"), F.lit(True).alias("here")).dropDuplicates()
    measures = g.scores.where("unit_type = 'Measure'")
    named = F.explode(F.array(*(F.struct(F.lit(r).alias("field"), F.col(r).alias("ref")) for r in REFERENCES)))
    of_scores = measures.select("paper_id", "section_no", c("measure_id").alias("id"), named.alias("r")).select("paper_id", "section_no", "id", "r.field", "r.ref").where(truthy(c("ref")))
    of_lists = g.units.where("type = 'Measure'").select("paper_id", "section_no", "id", F.explode(F.array(F.struct(F.lit("setup_ids").alias("field"), c("setup_ids").alias("l")), F.struct(F.lit("finding_ids").alias("field"), c("finding_ids").alias("l")))).alias("r"))
    of_lists = of_lists.select("paper_id", "section_no", "id", "r.field", F.explode("r.l").alias("ref"))
    j = of_scores.unionByName(of_lists).dropDuplicates().join(index, ["paper_id", "ref"], "left").join(local, ["paper_id", "section_no", "ref"], "left")
    is_setup = c("field").isin("setup_id", "setup_ids")
    there = c("ref_type").isNotNull()
    host = (c("ref_type") == "ExperimentSetup") | ((c("ref_type") == "Contribution") & c("ref_kind").isin("dataset", "benchmark"))
    right = (
        F.when(c("field").isin("system_id", "opponent_id"), c("ref_type").isin(*vocab.METHOD_FAMILY)).when(c("field") == "judge_id", c("ref_type").isin(*vocab.METHOD_FAMILY, "ExperimentSetup"))
        .when(c("field") == "finding_ids", c("ref_type") == "Finding").otherwise(host)
    )
    what = _say("", c("field"), c("ref"))
    out = _rows(j, c("id"), [
        ("V4 unknown reference", ~there, what), ("V4 reference not local", is_setup & there & c("here").isNull(), what),
        ("V4 reference type", there & ~(is_setup & c("here").isNull()) & ~F.coalesce(right, F.lit(False)), what),
    ])
    own = _rows(measures, c("measure_id"), [
        ("V4 score object", ~c("is_object"), _say("score", c("row_no"))), ("V4 variant", c("is_object") & ~truthy(c("variant")), _say("score", c("row_no"))),
        ("V4 value", c("is_object") & c("value").isNull(), _say("score", c("row_no"))), ("V4 variance", c("is_object") & c("variance").isNull(), _say("score", c("row_no"))),
        ("V4 value kind", _outside("value_kind", vocab.VALUE_KINDS), _say("score", c("row_no"), c("value_kind"))),
    ])
    return out.unionByName(own)


def section_faults(g: Graph) -> DataFrame:
    """V5: fields, type, anchor and covers list of every section."""
    c = F.col
    index = _index(g).select("paper_id", F.col("id").alias("anchor_id"), F.col("type").alias("anchor_type"))
    local = g.units.select("paper_id", "section_no", F.col("id").alias("anchor_id"), F.lit(True).alias("here")).dropDuplicates()
    s = g.sections.join(index, ["paper_id", "anchor_id"], "left").join(local, ["paper_id", "section_no", "anchor_id"], "left")
    odd = F.array_except("keys", F.array(*map(F.lit, vocab.SECTION_KEYS)))
    there = c("anchor_type").isNotNull()
    return _rows(s, c("section_no"), [
        ("V5 fields", F.size(odd) > 0, _say("unexpected fields", F.array_join(odd, ", "))),
        ("V5 section type", F.coalesce(~c("section").isin(*vocab.SECTION_ORDER), F.lit(True)), _say("invalid section type", c("section"))),
        ("V5 anchor missing", c("anchor_id").isNull(), F.lit("no anchor")),
        ("V5 anchor unknown", c("anchor_id").isNotNull() & ~there, _say("undefined anchor", c("anchor_id"))),
        ("V5 anchor not local", there & c("here").isNull(), _say("anchor of another section", c("anchor_id"))),
        ("V5 anchor document", there & c("here").isNotNull() & (c("anchor_type") == "Document"), _say("anchor is the document", c("anchor_id"))),
        ("V5 covers", ~F.coalesce("covers_listed", F.lit(False)), F.lit("covers_entries are no list")),
    ])


def edge_faults(g: Graph) -> DataFrame:
    """V6, V7: every relation by its ends, its name and its pair of types; Findings outside the evidence without support."""
    c = F.col
    index = _index(g)
    e = g.edges
    for end in ("source", "target"):
        e = e.join(index.select("paper_id", F.col("id").alias(f"{end}_id"), F.col("type").alias(f"{end}_type")), ["paper_id", f"{end}_id"], "left")
    bad_marks = F.filter("provenance", lambda m: ~m.rlike(MARKER_GRAMMAR))
    ends = lambda side: A.mapped_lists(c("relation"), {r: m[side] for r, m in vocab.RELATION_MATRIX.items()})
    named = c("relation").isin(*vocab.RELATION_MATRIX)
    out = _rows(e, F.concat_ws(" ", "source_id", "relation", "target_id"), [
        ("V6 source", c("source_type").isNull(), _say("unknown source", c("source_id"))), ("V6 target", c("target_type").isNull(), _say("unknown target", c("target_id"))),
        ("V6 provenance", ~F.coalesce("provenance_listed", F.lit(False)), F.lit("provenance is no list")), ("V6 marker", F.size(bad_marks) > 0, _say("no location marker", F.array_join(bad_marks, ", "))),
        ("V6 relation", F.coalesce(~named, F.lit(True)), _say("unknown relation", c("relation"))),
        ("V6 source type", named & c("source_type").isNotNull() & ~F.array_contains(ends(0), c("source_type")), _say("invalid source type", c("source_type"))),
        ("V6 target type", named & c("target_type").isNotNull() & ~F.array_contains(ends(1), c("target_type")), _say("invalid target type", c("target_type"))),
    ])
    supported = g.edges.where("relation = 'supports'").select("paper_id", F.col("target_id").alias("id")).dropDuplicates()
    bare = index.where((c("type") == "Finding") & (F.coalesce("section", F.lit("")) != "evidence")).join(supported, KEY, "left_anti")
    return out.unionByName(bare.select("paper_id", F.lit("V7 support").alias("rule"), c("id").alias("subject"), F.lit("no supporting relation").alias("message")))


def marker_faults(g: Graph, tables: DataFrame) -> DataFrame:
    """V9: markers of Measures that name no captured table (paper_id, marker)."""
    m = g.units.where((F.col("type") == "Measure") & truthy(F.col("source_table_marker"))).withColumn("marker", canon_marker(F.col("source_table_marker")))
    lost = m.join(tables.select("paper_id", "marker").dropDuplicates(), ["paper_id", "marker"], "left_anti")
    return lost.select("paper_id", F.lit("V9 marker").alias("rule"), F.col("id").alias("subject"), _say("no captured table", F.col("marker")).alias("message"))


def census_faults(g: Graph, nodes: DataFrame) -> DataFrame:
    """Covered entries that are no planned node or no unit, and planned nodes that no section covers."""
    papers = g.documents.select("paper_id").dropDuplicates()
    planned = nodes.select(*KEY).where("id is not null").dropDuplicates().join(papers, "paper_id", "left_semi")
    covered = g.sections.select("paper_id", F.explode("covers").alias("id")).where("id is not null").dropDuplicates()
    row = lambda df, rule, text: df.select("paper_id", F.lit(rule).alias("rule"), F.col("id").alias("subject"), F.lit(text).alias("message"))
    out = row(covered.join(planned, KEY, "left_anti"), "V10 unknown node", "covered entry is no planned node")
    out = out.unionByName(row(covered.join(g.units.select(*KEY), KEY, "left_anti"), "V10 no unit", "covered entry is no unit"))
    return out.unionByName(row(planned.join(covered, KEY, "left_anti"), "V10 not covered", "planned node in no section"))


def issues(g: Graph, nodes: DataFrame, tables: DataFrame) -> DataFrame:
    """All faults of V1-V10; a paper without a row is valid."""
    out = record_faults(g)
    for more in (unit_faults(g), reference_faults(g), section_faults(g), edge_faults(g), marker_faults(g, tables), census_faults(g, nodes)):
        out = out.unionByName(more)
    return out.dropDuplicates()


def census_issues(nodes: DataFrame, papers: DataFrame) -> DataFrame:
    """C4: faults of planned nodes(paper_id, id, type, kind, name, description, provenance, cite_keys), and papers
    (paper_id, central_contribution, topics, tasks, domain) without a summary or a root."""
    c, t = F.col, F.col("type")
    bad_marks = F.filter("provenance", lambda m: ~m.rlike(MARKER_GRAMMAR))
    rules = [
        ("C4 id", F.coalesce(~c("id").rlike(A.ID_FORMAT), F.lit(True)), _say("invalid id", c("id"))),
        ("C4 type", F.coalesce(~t.isin("Problem", "Contribution", "Component", "ExperimentSetup"), F.lit(True)), _say("type is not planned", t)),
        ("C4 prefix", t.isin(*vocab.ID_PREFIX) & (F.substring_index("id", ":", 1) != A.mapped(t, vocab.ID_PREFIX)), _say("prefix does not fit type", t)),
        ("C4 kind", t.isin("Contribution", "ExperimentSetup") & ~A.valid_kind(t, c("kind")), _say("invalid kind", c("kind"))),
        ("C4 name", ~truthy(c("name")), F.lit("no name")),
        ("C4 description", ~truthy(c("description")), F.lit("no description")),
        ("C4 cite keys", F.exists("cite_keys", lambda k: ~truthy(k)), F.lit("a blank citation key")),
        ("C4 marker", F.size(bad_marks) > 0, _say("no location marker", F.array_join(bad_marks, ", "))),
    ]
    out = _rows(nodes, c("id"), rules)
    repeated = nodes.groupBy(*KEY).count().where("count > 1 and id is not null")
    out = out.unionByName(repeated.select("paper_id", F.lit("C4 repeated id").alias("rule"), c("id").alias("subject"), _say("times", c("count")).alias("message")))
    roots = nodes.where("type = 'Contribution'").select("paper_id").dropDuplicates().withColumn("root", F.lit(True))
    p = papers.join(roots, "paper_id", "left")
    blank = lambda k: F.exists(k, lambda v: ~truthy(v))
    return out.unionByName(_rows(p, c("paper_id"), [
        ("C4 summary", ~truthy(c("central_contribution")), F.lit("no central contribution")), ("C4 root", c("root").isNull(), F.lit("no Contribution")),
        ("C4 facets", blank("topics") | blank("tasks"), F.lit("a blank facet")),
    ]))


def node_ids(nodes: DataFrame) -> DataFrame:
    """The distinct ids of the planned nodes."""
    return nodes.where("id is not null").select(*KEY).dropDuplicates()

"""The graph that a record's payload holds as related tables, and the repairs that need all of it.

One record per paper (the one received last) becomes five tables keyed by paper_id:

* documents(doc_id, title, keys, ...) - one row per paper
* sections(section_no, section, anchor_id, covers, ...)
* units(ord, section_no, section, id, type, ..., provenance, setup_ids, finding_ids, formulas) - ``ord`` is section and place
* scores(ord, row_no, measure_id, section_no, variant, value, system_id, setup_id, ...) - ``ord`` is that of the Measure
* edges(ord, source_id, relation, target_id, provenance) - those of the record first, then those of its sections (R2)

Defined results: payloads that are no complete JSON have no rows; of a list of extractions the first counts; texts in the
place of lists count as lists of one; absent lists are null and told apart from empty ones by ``*_listed``; an empty
table gives empty tables; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions import ids, vocab
from folioweave.functions.scalar import MARKER_GRAMMAR, canon_marker, formula_key, sanitize_text, strip, truthy
from folioweave.operators import assemble as A
from folioweave.operators.nested import FORMULA_TEXTS, SCORE_TEXTS, UNIT_TEXTS, canonical_records, latest
from folioweave.session import cut

#: Place of a unit: section_no * SECTION_STEP + unit_no.
SECTION_STEP = 1 << 32
TEXTS = ("kind", "name", "description", "statement", "unit", "comparison_direction", "source_table_marker", *UNIT_TEXTS)
LISTS = ("provenance", "setup_ids", "finding_ids", "cite_keys")
REFERENCES = ("system_id", "setup_id", "opponent_id", "judge_id")
KEY = ["paper_id", "id"]


@dataclass(frozen=True)
class Graph:
    """The tables of a corpus of records."""

    documents: DataFrame
    sections: DataFrame
    units: DataFrame
    scores: DataFrame
    edges: DataFrame

    def cut(self) -> Graph:
        """The same tables, materialised."""
        return Graph(*(cut(t) for t in (self.documents, self.sections, self.units, self.scores, self.edges)))


def graph(records: DataFrame, key: str = "paper_id", payload: str = "payload") -> Graph:
    """The tables of the last record of every paper."""
    last = latest(records.where(F.col(key).isNotNull() & F.col(payload).isNotNull()), key, payload)
    whole = canonical_records(last, key, payload, full=True)
    d = cut(whole.select(F.col("__key").alias("paper_id"), F.get("records", F.lit(0)).alias("r")).where("r is not null"))
    documents = d.select("paper_id", *(F.col(f"r.{c}").alias(c) for c in (
        "doc_id", "title", "keys", "document_keys", "notes_keys", "document_id", "document_type", "document_kind", "document_ir_version", "notes_ir_version", "notes_input_mode",
        "sections_used", "source_tables", "edges_listed", "sections_listed",
    )))
    s = d.select("paper_id", F.posexplode("r.sections").alias("section_no", "s"))
    sections = s.select("paper_id", "section_no", F.col("s.section_type").alias("section"), *(F.col(f"s.{c}").alias(c) for c in ("anchor_id", "covers", "covers_listed", "keys")))
    u = s.select("paper_id", "section_no", F.col("s.section_type").alias("section"), F.posexplode("s.units").alias("unit_no", "u"))
    place = F.col("section_no").cast("bigint") * SECTION_STEP + F.col("unit_no")
    u = u.select("paper_id", "section_no", "section", place.alias("ord"), "u")
    own = ("type", "array_type", *TEXTS, *LISTS, *(f"{c}_listed" for c in LISTS), "formulas", "keys", "scores_listed")
    units = u.select("paper_id", "section_no", "section", "ord", F.col("u.unit_id").alias("id"), *(F.col(f"u.{c}").alias(c) for c in own), F.size("u.scores").alias("n_scores"))
    rows = u.where(F.size("u.scores") > 0).select("paper_id", "section_no", "ord", F.col("u.unit_id").alias("measure_id"), F.col("u.type").alias("unit_type"), F.posexplode(F.arrays_zip("u.scores", "u.more_of_scores")).alias("row_no", "x"))
    fields = ("is_object", "variant", "value", "variance", "system_id", "setup_id", "value_num")
    scores = rows.select(
        "paper_id", "section_no", "ord", "row_no", "measure_id", "unit_type", *(F.col(f"x.scores.{c}").alias(c) for c in fields), *(F.col(f"x.more_of_scores.{c}").alias(c) for c in SCORE_TEXTS)
    )
    edge = ("source_id", "relation", "target_id", "provenance", "provenance_listed")
    top = d.select("paper_id", F.posexplode("r.edges").alias("pos", "e")).select("paper_id", F.col("pos").cast("bigint").alias("ord"), *(f"e.{c}" for c in edge))
    below = s.select("paper_id", "section_no", F.posexplode("s.edges").alias("pos", "e")).select(
        "paper_id", (F.lit(1 << 62) + F.col("section_no").cast("bigint") * SECTION_STEP + F.col("pos")).alias("ord"), *(f"e.{c}" for c in edge)
    )
    return Graph(documents, sections, units, scores, top.unionByName(below))


def flattened(g: Graph) -> Graph:
    """Typed arrays count only in the sections that may hold their type."""
    allowed = F.broadcast(A.section_types(g.units.sparkSession).withColumn("__ok", F.lit(True)).withColumnRenamed("type", "array_type"))
    units = g.units.join(allowed, ["section", "array_type"], "left").where(F.col("array_type").isNull() | F.col("__ok")).drop("__ok")
    return _with_units(g, units.select(*g.units.columns))


def _with_units(g: Graph, units: DataFrame) -> Graph:
    """The graph with fewer units, and without the scores of those that went."""
    kept = units.select("paper_id", "ord", F.col("id").alias("__id"))
    scores = g.scores.join(kept, ["paper_id", "ord"]).withColumn("measure_id", F.col("__id")).drop("__id")
    return replace(g, units=units, scores=scores)


def aliased(g: Graph) -> Graph:
    """Present forms of retired id prefixes, wherever an id stands."""
    return renamed(g, ids.alias_prefix)


def renamed(g: Graph, fn) -> Graph:
    """Every id through a function of a column."""
    lists = lambda c: F.transform(c, fn).alias(c)
    one = lambda c: fn(F.col(c)).alias(c)
    units = g.units.select(*(one(c) if c == "id" else lists(c) if c in ("setup_ids", "finding_ids") else F.col(c) for c in g.units.columns))
    sections = g.sections.select(*(one(c) if c == "anchor_id" else lists(c) if c == "covers" else F.col(c) for c in g.sections.columns))
    scores = g.scores.select(*(one(c) if c in ("measure_id", *REFERENCES) else F.col(c) for c in g.scores.columns))
    edges = g.edges.select(*(one(c) if c in ("source_id", "target_id") else F.col(c) for c in g.edges.columns))
    return replace(g, units=units, sections=sections, scores=scores, edges=edges)


def rewritten(g: Graph, remap: DataFrame, scores: bool = True) -> Graph:
    """References follow a remap table (paper_id, old_id, new_id): endpoints, lists in their order, score references."""
    remap = cut(remap.select("paper_id", "old_id", "new_id").dropDuplicates(["paper_id", "old_id"]))
    units = _rewrite_list(_rewrite_list(g.units, "ord", "setup_ids", remap), "ord", "finding_ids", remap)
    sections = _rewrite_list(g.sections, "section_no", "covers", remap)
    out = g.scores
    for c in REFERENCES if scores else ():
        out = out.join(remap.select("paper_id", F.col("old_id").alias(c), F.col("new_id").alias("__to")), ["paper_id", c], "left").withColumn(c, F.coalesce("__to", c)).drop("__to")
    return replace(g, units=units, sections=sections, scores=out.select(*g.scores.columns), edges=A.rewrite_edges(g.edges, remap).select(*g.edges.columns))


def _rewrite_list(rows: DataFrame, place: str, column: str, remap: DataFrame) -> DataFrame:
    """A list of ids with the remapped ones replaced; only lists that hold one are taken apart."""
    at = rows.where(F.size(column) > 0).select("paper_id", place, F.posexplode(column).alias("pos", "old_id"))
    new = at.join(remap, ["paper_id", "old_id"], "left").groupBy("paper_id", place).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("new_id", "old_id").alias("v")))).alias("l"), F.count("new_id").alias("hits")
    )
    new = new.where("hits > 0").select("paper_id", place, F.transform("l", lambda x: x["v"]).alias("__list"))
    return rows.join(new, ["paper_id", place], "left").withColumn(column, F.coalesce("__list", column)).select(*rows.columns)


def sanitized(g: Graph) -> tuple[Graph, DataFrame]:
    """Clean texts, then clean ids with collisions suffixed and references rewritten; also the remap."""
    units = g.units.select(*(sanitize_text(F.col(c)).alias(c) if c in TEXTS else F.col(c) for c in g.units.columns))
    remap = A.clean_ids(units.where("id is not null").select("paper_id", F.col("id").alias("raw_id"))).where("raw_id <> new_id").select("paper_id", F.col("raw_id").alias("old_id"), "new_id")
    remap = cut(remap)
    to = remap.select("paper_id", F.col("old_id").alias("id"), F.col("new_id").alias("__to"))
    units = units.join(to, KEY, "left").withColumn("id", F.coalesce("__to", "id")).select(*g.units.columns)
    anchors = remap.select("paper_id", F.col("old_id").alias("anchor_id"), F.col("new_id").alias("__to"))
    sections = g.sections.join(anchors, ["paper_id", "anchor_id"], "left").withColumn("anchor_id", F.coalesce("__to", "anchor_id")).select(*g.sections.columns)
    return rewritten(_with_units(replace(g, units=units, sections=sections), units), remap), remap


def stamped(g: Graph, nodes: DataFrame) -> Graph:
    """Kinds and citation keys of the planned nodes; the keys only on types that carry them and where there are any."""
    cited = nodes.where(F.size("cite_keys") > 0).groupBy(*KEY).agg(F.max_by("cite_keys", "ord").alias("__keys"))
    units = A.stamp_kinds(g.units, nodes).join(cited, KEY, "left")
    carries = F.col("type").isin("Contribution", "Component", "ExperimentSetup") & F.col("__keys").isNotNull()
    return replace(g, units=units.withColumn("cite_keys", F.when(carries, F.col("__keys")).otherwise(F.col("cite_keys"))).select(*g.units.columns))


def without_lost_markers(g: Graph, tables: DataFrame) -> Graph:
    """Table and caption markers of Measures whose table (paper_id, marker) was not captured become null."""
    known = tables.select("paper_id", F.col("marker").alias("__m")).dropDuplicates().withColumn("__known", F.lit(True))
    units = g.units.withColumn("__m", F.nullif(canon_marker(F.col("source_table_marker")), F.lit(""))).join(known, ["paper_id", "__m"], "left")
    lost = (F.col("type") == "Measure") & truthy(F.col("source_table_marker")) & F.col("__known").isNull()
    out = {c: F.when(~F.coalesce(lost, F.lit(False)), F.col(c)) for c in ("source_table_marker", "caption_marker")}
    return replace(g, units=units.withColumns(out).select(*g.units.columns))


def without_empty_measures(g: Graph) -> tuple[Graph, DataFrame]:
    """Measures without a score row and without a table marker go; also (paper_id, id) of those."""
    empty = (F.col("type") == "Measure") & (F.col("n_scores") == 0) & ~truthy(F.col("source_table_marker"))
    empty = F.coalesce(empty, F.lit(False))
    return _with_units(g, g.units.where(~empty)), g.units.where(empty).select("paper_id", "id")


def backfilled(g: Graph) -> Graph:
    """A Measure's blank unit is 'unitless'; an empty provenance of a Measure takes its table marker, of a Finding that of
    the first Measure of the section that mounts it; either else takes the first filled provenance of the section."""
    full = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    marker = strip(F.col("source_table_marker"))
    marker = F.when(marker.startswith("§"), marker).otherwise(F.concat(F.lit("§"), marker))
    own_table = F.when(marker.rlike(MARKER_GRAMMAR) & truthy(F.col("source_table_marker")), F.array(marker))
    u = g.units.withColumn("__mark", own_table)
    place = ["paper_id", "section_no"]
    sibling = u.where(full(F.col("provenance"))).groupBy(*place).agg(F.min_by("provenance", "ord").alias("__sibling"))
    mount = F.when(full(F.col("provenance")), F.col("provenance")).otherwise(F.col("__mark"))
    mounts = u.where("type = 'Measure'").withColumn("__mount", mount).where("__mount is not null").select(*place, "ord", "__mount", F.explode("finding_ids").alias("id"))
    mounts = mounts.groupBy(*place, "id").agg(F.min_by("__mount", "ord").alias("__mount"))
    u = u.join(sibling, place, "left").join(mounts, [*place, "id"], "left")
    chosen = F.coalesce(F.when(F.col("type") == "Measure", F.col("__mark")).when(F.col("type") == "Finding", F.col("__mount")), F.col("__sibling"), F.col("provenance"))
    wants = F.col("type").isin("Measure", "Finding") & ~full(F.col("provenance"))
    unitless = (F.col("type") == "Measure") & ~truthy(strip(F.col("unit")))
    out = {"provenance": F.when(wants, chosen).otherwise(F.col("provenance")), "unit": F.when(unitless, "unitless").otherwise(F.col("unit"))}
    return replace(g, units=u.withColumns(out).select(*g.units.columns))


def anchored(g: Graph) -> Graph:
    """An anchor that is no unit of its section becomes the first unit of the preferred type, else the first unit."""
    local = g.units.where("type <> 'Document' and id is not null")
    there = local.select("paper_id", "section_no", F.col("id").alias("anchor_id"), F.lit(True).alias("__there")).dropDuplicates()
    preferred = F.col("type") == A.mapped(F.col("section"), vocab.PREFERRED_ANCHOR)
    first = local.groupBy("paper_id", "section_no").agg(F.min_by("id", F.struct(~F.coalesce(preferred, F.lit(False)), "ord")).alias("__first"))
    s = g.sections.join(there, ["paper_id", "section_no", "anchor_id"], "left").join(first, ["paper_id", "section_no"], "left")
    return replace(g, sections=s.withColumn("anchor_id", F.when(F.col("__there"), F.col("anchor_id")).otherwise(F.coalesce("__first", "anchor_id"))).select(*g.sections.columns))


def _hosts(units: DataFrame) -> DataFrame:
    """Units that scores may be measured under: setups, and Contributions that are data."""
    return units.where((F.col("type") == "ExperimentSetup") | (F.col("type") == "Contribution") & F.col("kind").isin("dataset", "benchmark"))


def _flag(units: DataFrame, column: str, name: str, local: bool = False) -> DataFrame:
    place = ["paper_id", "section_no"] if local else ["paper_id"]
    return units.select(*place, F.col("id").alias(column), F.lit(True).alias(name)).dropDuplicates()


def references_repaired(g: Graph) -> Graph:
    """Systems and opponents are of the method family, setups hosts of the Measure's own section, judges of the family or
    setups; other references become '', other entries of setup_ids go."""
    family = g.units.where(F.col("type").isin(*vocab.METHOD_FAMILY))
    judges = g.units.where(F.col("type").isin(*vocab.METHOD_FAMILY, "ExperimentSetup"))
    hosts = _hosts(g.units)
    s = g.scores
    for c, good, local in (("system_id", family, False), ("opponent_id", family, False), ("setup_id", hosts, True), ("judge_id", judges, False)):
        flag = _flag(good, c, "__ok", local)
        s = s.join(flag, ["paper_id", *(["section_no"] if local else []), c], "left").withColumn(c, F.when(F.col("__ok") | ~truthy(F.col(c)), F.col(c)).otherwise("")).drop("__ok")
    known = _flag(hosts, "v", "__ok", True)
    at = g.units.where(F.size("setup_ids") > 0).select("paper_id", "section_no", "ord", F.posexplode("setup_ids").alias("pos", "v")).join(known, ["paper_id", "section_no", "v"], "left_semi")
    kept = at.groupBy("paper_id", "ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("__kept"))
    none = F.array().cast("array<string>")
    u = g.units.join(kept, ["paper_id", "ord"], "left").withColumn("setup_ids", F.when(F.size("setup_ids") > 0, F.coalesce("__kept", none)).otherwise(F.col("setup_ids")))
    return replace(g, units=u.select(*g.units.columns), scores=s.select(*g.scores.columns))


def enums_repaired(g: Graph) -> Graph:
    """Kinds by ``repair_kinds`` with words that belong to another field moved where it is empty; other values outside their
    vocabulary become null, also the value kinds of scores."""
    u = A.repair_kinds(g.units.withColumnsRenamed({"polarity": "__p", "method_kind": "__k"}))
    ok = lambda c, words: F.when(F.col(c).isin(*words), F.col(c))
    u = u.withColumns({
        "polarity": F.coalesce(ok("__p", vocab.POLARITIES), "polarity"), "method_kind": F.coalesce(ok("__k", vocab.METHOD_KINDS), "method_kind"),
        "comparison_direction": ok("comparison_direction", vocab.DIRECTIONS), "table_role": ok("table_role", vocab.TABLE_ROLES), "objective_class": ok("objective_class", vocab.OBJECTIVE_CLASSES),
    })
    return replace(g, units=u.select(*g.units.columns), scores=g.scores.withColumn("value_kind", ok("value_kind", vocab.VALUE_KINDS)))


def formulas_cleaned(g: Graph) -> Graph:
    """R20 within each unit: blank expressions go, equal ones (N14) merge into the first, only 'objective' is a role and only
    such entries keep a description."""
    fs = F.filter("formulas", lambda f: truthy(formula_key(f["expression"])))
    keys = F.transform(fs, lambda f: formula_key(f["expression"]))
    filled = lambda k, c: F.get(F.filter(F.transform(F.filter(fs, lambda f: formula_key(f["expression"]) == k), lambda f: f[c]), lambda v: truthy(v)), F.lit(0))

    def merged(k: Column) -> Column:
        first = F.get(F.filter(fs, lambda f: formula_key(f["expression"]) == k), F.lit(0))
        role = filled(k, "role")
        role = F.when(role.isin(*vocab.FORMULA_ROLES), role)
        made = {"name": filled(k, "name"), "expression": first["expression"], "role": role, "description": F.when(role.isNotNull(), filled(k, "description"))}
        return F.struct(*(made[c].alias(c) for c in FORMULA_TEXTS))

    return replace(g, units=g.units.withColumn("formulas", F.transform(F.array_distinct(keys), merged)))


def mounted(g: Graph) -> Graph:
    """Measure-supports-Finding and Finding-about-Measure edges become entries of finding_ids, after those already there;
    entries that name no Finding go; markers of Measures are canonical."""
    pairs = cut(A.mounted_findings(g.edges, g.units, ordered=True))
    gone = pairs.select("paper_id", "ord")
    edges = g.edges.join(gone, ["paper_id", "ord"], "left_anti")
    more = pairs.select("paper_id", F.col("measure_id").alias("id"), F.struct("ord", "finding_id").alias("x")).groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["finding_id"]).alias("__more"))
    none = F.array().cast("array<string>")
    u = g.units.join(more, KEY, "left")
    listed = F.when(F.col("type") == "Measure", F.array_distinct(F.concat(F.coalesce("finding_ids", none), F.coalesce("__more", none)))).otherwise(F.col("finding_ids"))
    u = u.withColumn("finding_ids", F.when(F.col("finding_ids").isNotNull() | F.col("__more").isNotNull(), listed))
    found = g.units.where("type = 'Finding'").select("paper_id", F.col("id").alias("v")).dropDuplicates()
    at = u.where(F.size("finding_ids") > 0).select("paper_id", "ord", F.posexplode("finding_ids").alias("pos", "v")).join(found, ["paper_id", "v"], "left_semi")
    kept = at.groupBy("paper_id", "ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("__kept"))
    u = u.join(kept, ["paper_id", "ord"], "left").withColumn("finding_ids", F.when((F.col("type") == "Measure") & F.col("finding_ids").isNotNull(), F.coalesce("__kept", none)).otherwise(F.col("finding_ids")))
    mark = lambda c: F.when((F.col("type") == "Measure") & truthy(F.col(c)), canon_marker(F.col(c))).otherwise(F.col(c))
    u = u.withColumns({c: mark(c) for c in ("source_table_marker", "caption_marker")})
    return replace(g, units=u.select(*g.units.columns), edges=edges)


def key_counts(g: Graph) -> DataFrame:
    """(paper_id, key, n): edges by relation, references held in fields, and all of both as relations_total."""
    named = g.edges.where(truthy(F.col("relation")))
    rel = named.groupBy("paper_id", F.concat(F.lit("rel:"), "relation").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    held = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("l")) for c in ("setup_ids", "finding_ids"))))
    fields = g.units.select("paper_id", held.alias("f")).select("paper_id", "f.c", F.explode("f.l").alias("v")).where(truthy(F.col("v")))
    field = fields.groupBy("paper_id", F.concat(F.lit("edge:"), "c").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    both = rel.unionByName(field)
    return both.unionByName(both.groupBy("paper_id", F.lit("relations_total").alias("key")).agg(F.sum("n").alias("n")))

"""Repair steps of the graph assembly as set operations on normalised tables (R-operators).

Tables, all keyed by the paper:

* units(paper_id, id, section, type, kind, name, description, ord) - one or several rows per id
* nodes(paper_id, id, type, kind, name, description, ord) - the planned nodes of a paper
* edges(paper_id, source_id, relation, target_id, provenance, ord)
* scores(paper_id, measure_id, system_id, setup_id, variant, value, ord)

``ord`` is any orderable column; where the order of rows decides ("first wins"), ``min_by`` over
``ord`` takes the place of a window, so one large paper is never sorted in one task. Where the
source leaves a choice to the order of a set, the lowest ``ord`` is taken.

Defined results: null ids join nothing and their rows are kept unless a step says otherwise; null
names, kinds and descriptions count as blank; repeated rows are one row wherever a step makes
ids or edges unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.functions import ids, vocab
from folioweave.functions.scalar import MARKER_GRAMMAR, formula_key, mapped, normalize_name, parse_value_num, strip, truthy
from folioweave.session import cut

KEY = ["paper_id", "id"]
ID_FORMAT = r"^[a-z][a-z0-9_]*:[a-z0-9_]+\z"


def relation_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vocab.matrix_rows(), "relation string, source_type string, target_type string")


def section_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vocab.section_unit_rows(), "section string, type string")


def prefix_type(id_: Column) -> Column:
    """The type that an id's prefix denotes, or null."""
    return mapped(F.substring_index(id_, ":", 1), {p: t for t, p in vocab.ID_PREFIX.items()})


def valid_kind(type_: Column, kind: Column) -> Column:
    out = F.lit(False)
    for t, kinds in vocab.KINDS_BY_TYPE.items():
        out = F.when(type_ == t, kind.isin(*kinds)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def mapped_lists(c: Column, values: dict[str, tuple[str, ...]]) -> Column:
    """The list of words that belongs to a word, or null."""
    return F.element_at(F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), c)


def allowed_in(section: Column, type_: Column) -> Column:
    """Whether a section may hold a type; false where either is unknown."""
    return F.coalesce(F.array_contains(mapped_lists(section, vocab.SECTION_UNIT_TYPES), type_), F.lit(False))


def stamp_kinds(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """The node's kind where it is valid for the unit's type; the last node of an id counts."""
    last = nodes.groupBy(*KEY).agg(F.max_by("kind", "ord").alias("node_kind"))
    kind = F.when(valid_kind(F.col("type"), F.col("node_kind")), F.col("node_kind")).otherwise(F.col("kind"))
    return units.join(last, KEY, "left").withColumn("kind", kind).drop("node_kind")


def suffix_duplicates(rows: DataFrame, order: str = "ord", group: str = "paper_id") -> DataFrame:
    """Later rows of an id get the first free of ``_2, _3, ...``, in order of ``ord``. Adds ``new_id``.

    Every row proposes a name, the r-th row of an id its r-th; of the rows that propose one name the earliest keeps it and
    the others propose their next. Names prefer earlier rows, so the rounds end where serving one row after the other ends. Rounds
    beyond the first are as many as the longest chain of ids that look like suffixed ones.
    """
    ranked = rows.select(group, F.col(order).alias("o"), "id", F.row_number().over(Window.partitionBy(group, "id").orderBy(order)).alias("k"))
    state = cut(ranked)
    while True:
        state = state.withColumn("new_id", F.when(F.col("k") == 1, F.col("id")).otherwise(F.concat("id", F.lit("_"), F.col("k").cast("string"))))
        met = state.groupBy(group, "new_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("o", "id")).alias("first")).where("n > 1")
        met = cut(met.select(group, "new_id", F.col("first.o").alias("o"), F.col("first.id").alias("id"), F.lit(True).alias("wins")))
        if met.isEmpty():
            return state.select(group, F.col("o").alias(order), "id", "new_id")
        asked = met.select(group, "new_id", F.lit(True).alias("asked"))
        wins = met.select(group, "new_id", "o", "id", "wins")
        lost = F.col("asked") & F.col("wins").isNull()
        state = cut(state.join(asked, [group, "new_id"], "left").join(wins, [group, "new_id", "o", "id"], "left").select(group, "o", "id", (F.col("k") + F.coalesce(lost.cast("int"), F.lit(0))).alias("k")))


def clean_ids(raw: DataFrame) -> DataFrame:
    """(paper_id, raw_id, new_id): ids in canonical spelling, collisions of different spellings suffixed."""
    distinct = raw.select("paper_id", "raw_id").dropDuplicates().withColumn("id", ids.canonical(F.col("raw_id")))
    dirty = (F.col("raw_id") != F.col("id")).alias("dirty")  # ids that are clean already are served first
    got = suffix_duplicates(distinct.select("paper_id", "id", F.struct(dirty, "raw_id").alias("ord")))
    return got.select("paper_id", F.col("ord.raw_id").alias("raw_id"), "new_id")


def misrouted(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """Units whose type disagrees with their prefix: dropped beside a right twin of the section, else retyped."""
    node = nodes.groupBy(*KEY).agg(F.max_by("type", "ord").alias("node_type"))
    right = prefix_type(F.col("id"))
    twins = units.where(F.col("type") == right).select("paper_id", "section", "id").dropDuplicates().withColumn("twin", F.lit(True))
    u = units.join(node, KEY, "left").join(twins, ["paper_id", "section", "id"], "left").withColumn("right", right)
    wrong = F.coalesce((F.col("type") != F.col("right")) & (F.col("node_type").isNull() | (F.col("node_type") == F.col("right"))), F.lit(False))
    kept = u.where(~(wrong & F.coalesce("twin", F.lit(False))))
    return kept.withColumn("type", F.when(wrong, F.col("right")).otherwise(F.col("type"))).drop("node_type", "twin", "right")


def owned(units: DataFrame) -> DataFrame:
    """Units whose type belongs to their section."""
    return units.join(F.broadcast(section_types(units.sparkSession)), ["section", "type"], "left_semi")


def eval_frames(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(paper_id, old_id, new_id) of bare dataset or benchmark Contributions that repeat a planned setup by name."""
    setups = nodes.where("type = 'ExperimentSetup'").withColumn("norm", normalize_name(F.col("name"))).where("norm <> ''")
    setups = setups.groupBy("paper_id", "norm").agg(F.min_by("id", "ord").alias("new_id"))
    bare = units.where((F.col("type") == "Contribution") & F.col("kind").isin("dataset", "benchmark") & ~truthy(strip(F.col("description"))))
    norm = normalize_name(F.col("name"))
    bare_norm = F.regexp_replace(norm, rf"( ?\b(?:{'|'.join(vocab.EVAL_FRAME_WORDS)}))+$", "")
    named = bare.select("paper_id", F.col("id").alias("old_id"), F.posexplode(F.array(norm, bare_norm)).alias("pos", "norm"))
    hit = named.join(setups, ["paper_id", "norm"]).groupBy("paper_id", "old_id").agg(F.min_by("new_id", "pos").alias("new_id"))
    return hit.where("old_id <> new_id")


def duplicate_setups(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(paper_id, old_id, new_id) of later ExperimentSetups of a section with the same name that no plan protects."""
    setups = units.where((F.col("type") == "ExperimentSetup") & truthy(F.col("name")))
    first = setups.groupBy("paper_id", "section", "name").agg(F.min_by("id", "ord").alias("new_id"))
    planned = nodes.select(*KEY).dropDuplicates()
    later = setups.join(first, ["paper_id", "section", "name"]).where("id <> new_id").join(planned, KEY, "left_anti")
    return later.select("paper_id", F.col("id").alias("old_id"), "new_id").dropDuplicates()


def rewrite_edges(edges: DataFrame, remap: DataFrame) -> DataFrame:
    """Endpoints follow a remap table (paper_id, old_id, new_id)."""
    for end in ("source_id", "target_id"):
        m = remap.select("paper_id", F.col("old_id").alias(end), F.col("new_id").alias("__to"))
        edges = edges.join(m, ["paper_id", end], "left").withColumn(end, F.coalesce("__to", end)).drop("__to")
    return edges


def first_units(units: DataFrame) -> DataFrame:
    """The first row of every id."""
    rest = [c for c in units.columns if c not in KEY]
    return units.groupBy(*KEY).agg(F.min_by(F.struct(*rest), "ord").alias("u")).select(*KEY, *(f"u.{c}" for c in rest))


def dangling_markers(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Table markers without a captured table (paper_id, marker) become null."""
    known = tables.select("paper_id", "marker").dropDuplicates().withColumn("known", F.lit(True))
    marker = F.when(F.col("known"), F.col("marker"))
    return rows.join(known, ["paper_id", "marker"], "left").withColumn("marker", marker).drop("known")


def empty_measures(units: DataFrame, scores: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """Measures that no score row names and that are not among ``marked`` (paper_id, id), those with a table marker."""
    scored = scores.select("paper_id", F.col("measure_id").alias("id")).dropDuplicates()
    out = units.where("type = 'Measure'").join(scored, KEY, "left_anti")
    return out if marked is None else out.join(marked.select(*KEY).dropDuplicates(), KEY, "left_anti")


def duplicate_scores(scores: DataFrame) -> DataFrame:
    """Per Measure the number of rows beyond the first of each (variant, setup)."""
    g = scores.groupBy("paper_id", "measure_id", F.coalesce("variant", F.lit("")).alias("v"), F.coalesce("setup_id", F.lit("")).alias("s")).count()
    return g.where("count > 1").groupBy("paper_id", "measure_id").agg(F.sum(F.col("count") - 1).alias("n_repeated"))


def normalize_marker(marker: Column, labels: Column) -> Column:
    """One provenance marker by the cascade: glued float word, appendix in words, glued appendix, subsection
    by its heading else its parent, bare appendix letter, named heading. ``labels``: map label -> marker."""
    m = strip(marker)
    label = F.lower(strip(F.substr(m, F.lit(2))))
    parent = F.concat(F.lit("§"), F.regexp_extract(m, r"^§([0-9]+|[A-Z]+)[.\-]", 1))
    by_heading = F.coalesce(F.element_at(labels, label), F.when(label.contains("-"), F.element_at(labels, F.substring_index(label, "-", 1))), parent)
    # "App. B", "Appendix B": the word, its short form, a letter of its own.
    spelled = r"^App(?:endix)?\.?\s+([A-Za-z])(?![A-Za-z])"
    is_section = m.startswith("§")
    return (
        F.when(is_section & strip(F.substr(m, F.lit(2))).rlike(MARKER_GRAMMAR), strip(F.substr(m, F.lit(2))))
        .when(m.rlike(spelled), F.concat(F.lit("§"), F.upper(F.regexp_extract(m, spelled, 1))))
        .when(m.rlike(r"^§[A-Za-z]+\d"), F.concat(F.lit("§"), F.regexp_extract(m, r"^§([A-Za-z]+)\d", 1)))
        .when(m.rlike(r"^§([0-9]+|[A-Z]+)[.\-]"), by_heading)
        .when(~is_section & m.rlike(r"^[A-Za-z](?:[.\-]\w+)*$"), F.concat(F.lit("§"), F.upper(F.left(m, F.lit(1)))))
        .when(~is_section & ~m.rlike(MARKER_GRAMMAR) & F.element_at(labels, normalize_name(m)).isNotNull(), F.element_at(labels, normalize_name(m)))
        .otherwise(marker)
    )


def normalize_provenance(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Provenance lists of rows; null becomes []. ``labels``: (paper_id, label, marker)."""
    maps = labels.groupBy("paper_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("label", "marker")))).alias("labels"))
    empty = F.create_map().cast("map<string,string>")
    out = rows.join(maps, "paper_id", "left").withColumn("labels", F.coalesce("labels", empty))
    fixed = F.transform(F.coalesce("provenance", F.array().cast("array<string>")), lambda m: normalize_marker(m, F.col("labels")))
    return out.withColumn("provenance", fixed).drop("labels")


def backfill_provenance(units: DataFrame) -> DataFrame:
    """An empty provenance takes the first filled one of its section; a missing unit word is 'unitless'."""
    filled = units.where(truthy(F.col("provenance"), "array"))
    sibling = filled.groupBy("paper_id", "section").agg(F.min_by("provenance", "ord").alias("__p"))
    own = F.when(truthy(F.col("provenance"), "array"), F.col("provenance"))
    return units.join(sibling, ["paper_id", "section"], "left").withColumn("provenance", F.coalesce(own, "__p", F.array().cast("array<string>"))).drop("__p")


def anchors(units: DataFrame) -> DataFrame:
    """Per section the first unit of the preferred type, else the first unit."""
    preferred = F.col("type") == mapped(F.col("section"), vocab.PREFERRED_ANCHOR)
    key = F.struct(~F.coalesce(preferred, F.lit(False)), "ord")
    return units.where("type <> 'Document'").groupBy("paper_id", "section").agg(F.min_by("id", key).alias("anchor_id"))


def repair_score_refs(scores: DataFrame, units: DataFrame) -> DataFrame:
    """System ids that are no method and setup ids that are no setup (nor a dataset Contribution) become ''."""
    methods = units.where(F.col("type").isin(*vocab.METHOD_FAMILY)).select("paper_id", F.col("id").alias("system_id")).dropDuplicates().withColumn("__s", F.lit(True))
    is_setup = (F.col("type") == "ExperimentSetup") | (F.col("type") == "Contribution") & F.col("kind").isin("dataset", "benchmark")
    setups = units.where(is_setup).select("paper_id", F.col("id").alias("setup_id")).dropDuplicates().withColumn("__t", F.lit(True))
    out = scores.join(methods, ["paper_id", "system_id"], "left").join(setups, ["paper_id", "setup_id"], "left")
    blank = lambda flag, c: F.when(F.col(flag), F.col(c)).otherwise("").alias(c)
    return out.select(*(blank("__s", c) if c == "system_id" else blank("__t", c) if c == "setup_id" else F.col(c) for c in scores.columns))


def repair_kinds(units: DataFrame) -> DataFrame:
    """Invalid kinds: a Finding becomes descriptive (a polarity word moves), a Contribution becomes a method
    (a method word moves), other types lose theirs."""
    t, k = F.col("type"), F.col("kind")
    bad = ~valid_kind(t, k)
    polarity = F.when((t == "Finding") & bad & k.isin(*vocab.POLARITIES), k)
    method = F.when((t == "Contribution") & bad & k.isin(*vocab.METHOD_KINDS), k)
    kind = F.when(~bad, k).when(t == "Finding", "descriptive").when(t == "Contribution", "method")
    return units.withColumns({"polarity": polarity, "method_kind": method, "kind": kind})


def clean_formulas(formulas: DataFrame) -> DataFrame:
    """(paper_id, id, expression, name, role, description, ord): blank ones dropped, equal ones (N14) merged into
    the first with the first filled role, description and name; only 'objective' is a role and keeps a description."""
    f = formulas.withColumn("fkey", formula_key(F.col("expression"))).where("fkey <> ''")
    first = lambda c: F.min_by(c, F.when(truthy(F.col(c)), F.col("ord"))).alias(c)
    g = f.groupBy("paper_id", "id", "fkey").agg(F.min_by("expression", "ord").alias("expression"), F.min("ord").alias("ord"), first("name"), first("role"), first("description"))
    role = F.when(F.col("role") == "objective", F.col("role"))
    return g.withColumns({"role": role, "description": F.when(role.isNotNull(), F.col("description"))}).drop("fkey")


def first_edges(edges: DataFrame) -> DataFrame:
    """The first row of every (source, relation, target)."""
    key = ["paper_id", "source_id", "relation", "target_id"]
    rest = [c for c in edges.columns if c not in key]
    return edges.groupBy(*key).agg(F.min_by(F.struct(*rest), "ord").alias("e")).select(*key, *(f"e.{c}" for c in rest))


def _typed(edges: DataFrame, units: DataFrame) -> DataFrame:
    for end in ("source", "target"):
        u = units.select("paper_id", F.col("id").alias(f"{end}_id"), F.col("type").alias(f"{end}_type")).dropDuplicates(["paper_id", f"{end}_id"])
        edges = edges.join(u, ["paper_id", f"{end}_id"], "left")
    return edges


def anchored_edges(edges: DataFrame, units: DataFrame) -> DataFrame:
    """Edges whose both ends are units."""
    for end in ("source_id", "target_id"):
        edges = edges.join(units.select("paper_id", F.col("id").alias(end)).dropDuplicates(), ["paper_id", end], "left_semi")
    return edges


def edge_faults(edges: DataFrame, units: DataFrame) -> DataFrame:
    """Every edge with its fault, or null: self_loop, unknown_relation, type_pair - the first that holds."""
    typed = _typed(edges, units)
    legal = F.broadcast(relation_matrix(edges.sparkSession).withColumn("__ok", F.lit(True)))
    out = typed.join(legal, ["relation", "source_type", "target_type"], "left")
    fault = (
        F.when(F.col("source_id") == F.col("target_id"), "self_loop")
        .when(~F.col("relation").isin(*vocab.RELATION_MATRIX), "unknown_relation")
        .when(F.col("__ok").isNull(), "type_pair")
    )
    return out.withColumn("fault", fault).select(*edges.columns, "fault")


def missing_evaluates(units: DataFrame, edges: DataFrame, scores: DataFrame) -> DataFrame:
    """(paper_id, source_id, target_id): the subject of a Measure without an evaluates edge, from its score rows:
    the only own method, or the only Contribution among several."""
    covered = edges.where("relation = 'evaluates'").select("paper_id", F.col("source_id").alias("id")).dropDuplicates()
    open_ = units.where("type = 'Measure'").select(*KEY).dropDuplicates().join(covered, KEY, "left_anti")
    methods = units.where(F.col("type").isin(*vocab.METHOD_FAMILY)).select("paper_id", F.col("id").alias("system_id"), "type").dropDuplicates(["paper_id", "system_id"])
    pairs = scores.select("paper_id", F.col("measure_id").alias("id"), "system_id").dropDuplicates().join(open_, KEY, "left_semi").join(methods, ["paper_id", "system_id"])
    g = pairs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("type") == "Contribution").alias("c"), F.min("system_id").alias("any"), F.min(F.when(F.col("type") == "Contribution", F.col("system_id"))).alias("root"))
    return g.where("n = 1 or c = 1").select("paper_id", F.col("id").alias("source_id"), F.when(F.col("n") == 1, F.col("any")).otherwise(F.col("root")).alias("target_id"))


def mounted_findings(edges: DataFrame, units: DataFrame, ordered: bool = False) -> DataFrame:
    """(paper_id, measure_id, finding_id) carried by Measure-supports-Finding and Finding-about-Measure edges; with
    ``ordered`` one row per edge with its ``ord``."""
    t = _typed(edges, units)
    a = t.where("relation = 'supports' and source_type = 'Measure' and target_type = 'Finding'").select("paper_id", F.col("source_id").alias("measure_id"), F.col("target_id").alias("finding_id"), "ord")
    b = t.where("relation = 'about' and source_type = 'Finding' and target_type = 'Measure'").select("paper_id", F.col("target_id").alias("measure_id"), F.col("source_id").alias("finding_id"), "ord")
    both = a.unionByName(b)
    return both if ordered else both.drop("ord").dropDuplicates()


def covers(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(paper_id, section, id): the planned nodes that a section materialises."""
    return units.select("paper_id", "section", "id").dropDuplicates().join(nodes.select(*KEY).dropDuplicates(), KEY, "left_semi")


def coverage(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """Planned, covered and missing nodes of every paper."""
    there = units.select(*KEY).dropDuplicates().withColumn("there", F.lit(1))
    n = nodes.select(*KEY).dropDuplicates().join(there, KEY, "left")
    return n.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_planned"), F.count("there").alias("n_covered"), F.count_if(F.col("there").isNull()).alias("n_missing"))


def document_kind(units: DataFrame, roots: DataFrame) -> DataFrame:
    """The document kind from the first materialised root of a paper: data make a survey of benchmarks, a taxonomy as
    the ``method_kind`` of the method family a review."""
    first = units.join(roots.select(*KEY).dropDuplicates(), KEY, "left_semi").groupBy("paper_id").agg(F.min_by(F.struct("type", "kind", "method_kind"), "ord").alias("u"))
    is_data = (F.col("u.type") == "Contribution") & F.col("u.kind").isin("dataset", "benchmark")
    is_review = F.col("u.type").isin(*vocab.METHOD_FAMILY) & (F.col("u.method_kind") == "taxonomy")
    return first.select("paper_id", F.when(is_data, "benchmark_survey").when(is_review, "review").otherwise("research_article").alias("document_kind"))


def provenance_rate(edges: DataFrame, blocks: DataFrame) -> DataFrame:
    """Numeric markers of a paper, how many of them name a block, and the rate (null without any)."""
    m = edges.select("paper_id", F.explode("provenance").alias("marker")).where(F.col("marker").rlike(r"^§[0-9]+$"))
    known = blocks.select("paper_id", "marker").dropDuplicates().withColumn("known", F.lit(1))
    g = m.join(known, ["paper_id", "marker"], "left").groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_markers"), F.count("known").alias("n_resolved"))
    return g.withColumn("rate", F.col("n_resolved") / F.col("n_markers"))


def score_numbers(scores: DataFrame) -> DataFrame:
    """value_num of every score."""
    return scores.withColumn("value_num", parse_value_num(F.col("value")))


def has_payload(units: DataFrame) -> DataFrame:
    """Measures with a score row (``n_scores``) or a filled headline have a quantitative payload; null for other types."""
    return units.withColumn("has_quantitative_payload", F.when(F.col("type") == "Measure", (F.col("n_scores") > 0) | truthy(strip(F.col("headline_result")))))


def nonempty_sections(sections: DataFrame, units: DataFrame) -> DataFrame:
    """R34."""
    return sections.join(units.select("paper_id", "section").dropDuplicates(), ["paper_id", "section"], "left_semi")


def order_edges(stage_edges: DataFrame, section_edges: DataFrame) -> DataFrame:
    """R2: both sources of edges with one order: those of the relation stage first, then those of the sections."""
    tag = lambda df, k: df.withColumn("ord", F.struct(F.lit(k).alias("source"), F.col("ord").alias("at")))
    return tag(stage_edges, 0).unionByName(tag(section_edges, 1))


def root_backfill(nodes: DataFrame) -> DataFrame:
    """In a paper without a Contribution the first Component becomes one of kind method, else the first
    ExperimentSetup of kind dataset unless it is a benchmark."""
    rank = F.when(F.col("type") == "Component", 0).when(F.col("type") == "ExperimentSetup", 1)
    g = nodes.groupBy("paper_id").agg(
        F.count_if(F.col("type") == "Contribution").alias("roots"), F.min_by("id", F.when(rank.isNotNull(), F.struct(rank, "ord"))).alias("pick")
    )
    n = nodes.join(g, "paper_id")
    chosen = F.coalesce((F.col("roots") == 0) & (F.col("id") == F.col("pick")), F.lit(False))
    kind = F.when(F.col("type") == "Component", "method").when(F.col("kind").isin("dataset", "benchmark"), F.col("kind")).otherwise("dataset")
    return n.withColumn("kind", F.when(chosen, kind).otherwise(F.col("kind"))).withColumn("type", F.when(chosen, "Contribution").otherwise(F.col("type"))).drop("roots", "pick")


def reprefix(nodes: DataFrame) -> DataFrame:
    """Ids rebuilt from type and slug where that makes a well-formed id."""
    rest = F.when(F.col("id").contains(":"), F.substr("id", F.length(F.substring_index("id", ":", 1)) + 2)).otherwise(F.col("id"))
    made = F.concat(mapped(F.col("type"), vocab.ID_PREFIX), F.lit(":"), ids.slug(rest))
    return nodes.withColumn("id", F.when(made.rlike(ID_FORMAT), made).otherwise(F.col("id")))


def node_registry(nodes: DataFrame) -> DataFrame:
    """The public columns of the planned nodes, kind only where filled."""
    cluster = F.when(F.col("type").isin(*vocab.METHOD_FAMILY), "method").when(F.col("type") == "ExperimentSetup", "setup").otherwise(F.lower("type"))
    return nodes.select("paper_id", "id", "type", cluster.alias("cluster"), F.nullif(F.col("kind"), F.lit("")).alias("kind"), "name")


def undirected_closure(roots: DataFrame, links: DataFrame, rounds: int | None = None) -> DataFrame:
    """G1: (paper_id, id) reached from the roots over undirected links, by semi-naive rounds until nothing is new."""
    both = links.select("paper_id", F.col("source_id").alias("a"), F.col("target_id").alias("b")).where("a is not null and b is not null")
    both = cut(both.unionByName(both.select("paper_id", F.col("b").alias("a"), F.col("a").alias("b"))).dropDuplicates())
    reached = cut(roots.select(*KEY).dropDuplicates())
    front, n = reached, 0
    while rounds is None or n < rounds:
        step = front.select("paper_id", F.col("id").alias("a")).join(both, ["paper_id", "a"]).select("paper_id", F.col("b").alias("id")).dropDuplicates()
        front = cut(step.join(reached, KEY, "left_anti"))
        if front.isEmpty():
            break
        reached, n = cut(reached.unionByName(front)), n + 1
    return reached


def resolves(units: DataFrame, edges: DataFrame, roots: DataFrame, headlines: DataFrame, problem_anchors: DataFrame | None = None) -> DataFrame:
    """(paper_id, source_id, target_id): the Finding that closes each root's arc and the paper's Problem.

    The Problem is the first that motivates a root, else the anchor (paper_id, anchor_id) of the problem section where it is
    a Problem, else the paper's only one. Of the Findings about a root the
    one that shares most long words with the headline wins, ties by ``ord``; a Finding resolves once.
    """
    from folioweave.functions.scalar import headline_overlap

    units, edges = cut(units), cut(edges)
    closed = undirected_closure(roots, edges.where("relation = 'co_contribution'"))
    t = _typed(edges, units)
    to_root = closed.select("paper_id", F.col("id").alias("target_id"))
    first = t.where("relation = 'motivates' and source_type = 'Problem'").join(to_root, ["paper_id", "target_id"], "left_semi").groupBy("paper_id").agg(F.min_by("source_id", "ord").alias("m"))
    sole = units.where("type = 'Problem'").groupBy("paper_id").agg(F.countDistinct("id").alias("n"), F.min("id").alias("one"))
    if problem_anchors is not None:
        problems = units.where("type = 'Problem'").select("paper_id", F.col("id").alias("anchor_id")).dropDuplicates()
        held = problem_anchors.join(problems, ["paper_id", "anchor_id"], "left_semi").groupBy("paper_id").agg(F.min("anchor_id").alias("held"))
        first = first.join(held, "paper_id", "full").select("paper_id", F.coalesce("m", "held").alias("m"))
    problem = first.join(sole, "paper_id", "full").select("paper_id", F.coalesce("m", F.when(F.col("n") == 1, F.col("one"))).alias("problem_id")).where("problem_id is not null")
    texts = units.groupBy(*KEY).agg(F.min_by(F.coalesce("description", F.lit("")), "ord").alias("text"))
    about = t.where("relation = 'about' and source_type = 'Finding'").join(to_root, ["paper_id", "target_id"], "left_semi")
    about = about.join(texts.withColumnRenamed("id", "source_id"), ["paper_id", "source_id"]).join(headlines, "paper_id", "left")
    score = F.coalesce(headline_overlap(F.coalesce("headline", F.lit("")), F.col("text")), F.lit(0))
    best = about.withColumn("score", score).groupBy("paper_id", "target_id").agg(F.min_by("source_id", F.struct(-F.col("score"), "ord", "source_id")).alias("source_id"))
    return best.select("paper_id", "source_id").dropDuplicates().join(problem, "paper_id").select("paper_id", "source_id", F.col("problem_id").alias("target_id"))


def adjacency(edges: DataFrame, units: DataFrame) -> DataFrame:
    """Per unit the numbers of distinct outgoing and incoming edges and of neighbours that are units."""
    e = first_edges(edges.select("paper_id", "source_id", "relation", "target_id", "ord"))
    ends = e.select("paper_id", F.col("source_id").alias("id"), F.col("target_id").alias("other"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        e.select("paper_id", F.col("target_id").alias("id"), F.col("source_id").alias("other"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    )
    known = units.select("paper_id", F.col("id").alias("other")).dropDuplicates().withColumn("k", F.lit(True))
    ends = ends.join(units.select(*KEY).dropDuplicates(), KEY, "left_semi").join(known, ["paper_id", "other"], "left")
    return ends.groupBy(*KEY).agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"), F.countDistinct(F.when(F.col("k"), F.col("other"))).alias("n_neighbours"))


def display_roles(units: DataFrame, edges: DataFrame) -> DataFrame:
    """Contribution, compared_against, component or method of every unit of the method family."""
    compared = edges.where("relation = 'compares_to'").select("paper_id", F.explode(F.array("source_id", "target_id")).alias("id")).dropDuplicates().withColumn("c", F.lit(True))
    parts = edges.where("relation = 'part_of'").select("paper_id", F.col("source_id").alias("id")).dropDuplicates().withColumn("p", F.lit(True))
    m = units.where(F.col("type").isin(*vocab.METHOD_FAMILY)).select("paper_id", "id", "type").dropDuplicates(KEY)
    role = F.when(F.col("type") == "Contribution", "contribution").when(F.col("c"), "compared_against").when(F.col("p") | (F.col("type") == "Component"), "component").otherwise("method")
    return m.join(compared, KEY, "left").join(parts, KEY, "left").select("paper_id", "id", role.alias("role"))


def discovery_arc(units: DataFrame, edges: DataFrame) -> DataFrame:
    """(paper_id, problem_id, root_id, finding_id): the first Problem of the problem section, else the target of the first
    resolves edge; the first Contribution; the source of the first resolves edge, else the first Finding about that Contribution."""
    problem = units.where("type = 'Problem' and section = 'problem'").groupBy("paper_id").agg(F.min_by("id", "ord").alias("p"))
    root = units.where("type = 'Contribution'").groupBy("paper_id").agg(F.min_by("id", "ord").alias("root_id"))
    end = edges.where("relation = 'resolves'").groupBy("paper_id").agg(F.min_by(F.struct("source_id", "target_id"), "ord").alias("r"))
    findings = units.where("type = 'Finding'").select("paper_id", F.col("id").alias("source_id")).dropDuplicates()
    about = edges.where("relation = 'about'").join(root.withColumnRenamed("root_id", "target_id"), ["paper_id", "target_id"], "left_semi").join(findings, ["paper_id", "source_id"], "left_semi")
    about = about.groupBy("paper_id").agg(F.min_by("source_id", "ord").alias("a"))
    j = problem.join(root, "paper_id", "full").join(end, "paper_id", "left").join(about, "paper_id", "left")
    return j.select("paper_id", F.coalesce("p", "r.target_id").alias("problem_id"), "root_id", F.coalesce("r.source_id", "a").alias("finding_id"))


def unit_sections(units: DataFrame) -> DataFrame:
    """The section of every unit (the last row of an id) and the first."""
    return units.groupBy(*KEY).agg(F.max_by("section", "ord").alias("last_section"), F.min_by("section", "ord").alias("first_section"))


def issues(units: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(paper_id, rule, subject) of the violations of V2, V3, V5, V6, V7 and V10 that the SQL of v_issues holds; the other
    ones are in ``further_issues``, and only a paper without rows in both is valid (V11)."""
    units, edges, nodes = cut(units), cut(edges), cut(nodes.select(*KEY))  # each is read several times
    u = units.withColumn("rule", F.explode(F.array_compact(F.array(
        F.when(~F.coalesce(F.col("id").rlike(ID_FORMAT), F.lit(False)), "id_format"),
        F.when(~F.coalesce(F.col("type").isin(*vocab.ID_PREFIX), F.lit(False)), "unknown_type"),
        F.when(prefix_type(F.col("id")) != F.col("type"), "prefix"),
        F.when(F.col("kind").isNotNull() & ~valid_kind(F.col("type"), F.col("kind")), "kind"),
        F.when(~truthy(strip(F.col("name"))), "name"),
    ))))
    out = u.select("paper_id", "rule", F.col("id").alias("subject"))
    wrong_section = units.join(F.broadcast(section_types(units.sparkSession)), ["section", "type"], "left_anti").where("section is not null")
    out = out.unionByName(wrong_section.select("paper_id", F.lit("section_type").alias("rule"), F.col("id").alias("subject")))
    for end in ("source_id", "target_id"):
        lost = edges.join(units.select("paper_id", F.col("id").alias(end)).dropDuplicates(), ["paper_id", end], "left_anti")
        out = out.unionByName(lost.select("paper_id", F.lit(f"dangling_{end}").alias("rule"), F.col(end).alias("subject")))
    faults = edge_faults(anchored_edges(edges, units), units).where("fault is not null")
    out = out.unionByName(faults.select("paper_id", F.concat(F.lit("edge_"), "fault").alias("rule"), F.col("source_id").alias("subject")))
    bad_marker = edges.select("paper_id", "source_id", F.explode("provenance").alias("m")).where(~F.col("m").rlike(r"^§(?:[0-9]+|[A-Za-z]+)$"))
    out = out.unionByName(bad_marker.select("paper_id", F.lit("marker").alias("rule"), F.col("source_id").alias("subject")))
    supported = edges.where("relation = 'supports'").select("paper_id", F.col("target_id").alias("id")).dropDuplicates()
    bare = units.where("type = 'Finding' and section <> 'evidence'").join(supported, KEY, "left_anti")
    out = out.unionByName(bare.select("paper_id", F.lit("unsupported").alias("rule"), F.col("id").alias("subject")))
    missing = nodes.join(units.select(*KEY).dropDuplicates(), KEY, "left_anti")
    return out.unionByName(missing.select("paper_id", F.lit("not_materialised").alias("rule"), F.col("id").alias("subject"))).dropDuplicates()


def further_issues(units: DataFrame, edges: DataFrame, scores: DataFrame, marked: DataFrame, tables: DataFrame, versions: DataFrame) -> DataFrame:
    """V4, V6, V8, V9: (paper_id, rule, subject) of the violations that ``issues`` leaves out.

    scores(paper_id, measure_id, system_id, setup_id, variant, value, unit, direction, table_role) holds the rows of the
    Measures, marked(paper_id, marker) the table markers of all result rows, tables(paper_id, marker) the captured tables, versions(paper_id, ir_version) one row per paper. A null
    section is unknown and not taken for another one; a null direction or role is absent; a null version is a fault.
    """
    units, edges, scores = cut(units), cut(edges), cut(scores)
    empty = lambda c: ~truthy(F.col(c))
    u = units.withColumn("rule", F.explode(F.array_compact(F.array(
        F.when(F.col("type").isin(*vocab.KINDS_BY_TYPE) & empty("kind"), "kind_missing"),
        F.when(F.col("type").isin("Finding", "Problem") & empty("description"), "text_missing"),
    ))))
    out = u.select("paper_id", "rule", F.col("id").alias("subject"))
    out = out.unionByName(empty_measures(units, scores).select("paper_id", F.lit("no_scores").alias("rule"), F.col("id").alias("subject")))
    known = units.dropDuplicates(KEY)
    measures = known.where("type = 'Measure'").select("paper_id", F.col("id").alias("measure_id"), F.col("section").alias("m_section"))
    s = scores.join(measures, ["paper_id", "measure_id"])
    for end in ("system", "setup"):
        ends = known.select("paper_id", F.col("id").alias(f"{end}_id"), F.lit(True).alias(f"{end}_there"), *(F.col(c).alias(f"{end}_{c}") for c in ("type", "kind", "section")))
        s = s.join(ends, ["paper_id", f"{end}_id"], "left")
    is_setup = (F.col("setup_type") == "ExperimentSetup") | (F.col("setup_type") == "Contribution") & F.col("setup_kind").isin("dataset", "benchmark")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    s = s.withColumn("rule", F.explode(F.array_compact(F.array(
        F.when(empty("unit"), "unit_missing"),
        F.when(empty("variant"), "variant_missing"),
        F.when(F.col("value").isNull(), "value_missing"),
        F.when(~empty("system_id") & F.col("system_there").isNull(), "unknown_system"),
        F.when(F.col("system_there") & no(F.col("system_type").isin(*vocab.METHOD_FAMILY)), "system_type"),
        F.when(~empty("setup_id") & F.col("setup_there").isNull(), "unknown_setup"),
        F.when(F.col("setup_there") & (F.col("setup_section") != F.col("m_section")), "setup_section"),
        F.when(F.col("setup_there") & no(is_setup), "setup_type"),
        F.when(F.col("direction").isNotNull() & ~F.col("direction").isin(*vocab.DIRECTIONS), "direction"),
        F.when(F.col("table_role").isNotNull() & ~F.col("table_role").isin(*vocab.TABLE_ROLES), "table_role"),
    ))))
    out = out.unionByName(s.select("paper_id", "rule", F.col("measure_id").alias("subject")))
    lost = marked.where(truthy(F.col("marker"))).join(tables.select("paper_id", "marker").dropDuplicates(), ["paper_id", "marker"], "left_anti")
    out = out.unionByName(lost.select("paper_id", F.lit("table_marker").alias("rule"), F.col("marker").alias("subject")))
    bare = edges.where("provenance is null")
    out = out.unionByName(bare.select("paper_id", F.lit("edge_provenance").alias("rule"), F.col("source_id").alias("subject")))
    version = versions.where(no(F.col("ir_version").isin(*vocab.ACCEPTED_VERSIONS)))
    return out.unionByName(version.select("paper_id", F.lit("ir_version").alias("rule"), F.col("ir_version").alias("subject"))).dropDuplicates()


def share_of(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """The share of a value in the total; ``df`` is an aggregate of a few rows."""
    return df.withColumn("share", F.col(value) / F.sum(value).over(Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))))

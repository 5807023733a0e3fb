"""Queries of the assembly, graph and validation operators over the graph tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.functions.scalar import parse_value_num
from folioweave.operators import assemble as A
from folioweave.plans import views as V
from folioweave.queries.problems import canon_sql
from folioweave.queries.scalars import VALUE_NUM_SQL, norm_sql
from folioweave.session import table

C = F.col


def _n():
    return F.count(F.lit(1)).alias("n")


def _ctx(fn):
    """fn(units, nodes, edges, scores) as a query."""
    return lambda s, d: fn(V.units(s, d), V.nodes(s, d), V.edges(s, d), V.scores(s, d))


def r12(s, d):
    marks = V.paper_blocks(s, d).where("text rlike '(?i)<table'").select("paper_id", "marker")
    return A.dangling_markers(V.scores(s, d), marks).groupBy("paper_id").agg(F.count("marker").alias("n_kept"), _n())


def r5(s, d):
    return A.clean_ids(table(s, d, "graph_units").select("paper_id", C("unit_id").alias("raw_id")))


def c3(s, d):
    n = table(s, d, "graph_units").select("paper_id", "type", C("unit_id").alias("id"), F.struct("changed_at", "unit_id", "op").alias("ord")).where("op = 'upsert'")
    return A.suffix_duplicates(n.dropDuplicates(["paper_id", "id", "ord"])).select("paper_id", "id", "new_id")


def labels(s, d):
    from folioweave.operators import text as T

    docs = table(s, d, "documents").select("doc_id", "paper_id", "text")
    h = T.heading_map(docs).join(docs.select("doc_id", "paper_id"), "doc_id")
    return h.groupBy("paper_id", "label").agg(F.min_by("marker", "doc_id").alias("marker"))


def r15(s, d):
    odd = V.edges(s, d).withColumn("provenance", F.transform("provenance", lambda m: F.when(F.length(m) % 2 == 0, F.concat(m, F.lit(".1"))).otherwise(m)))
    out = A.normalize_provenance(odd, labels(s, d))
    return out.select("paper_id", C("ord").alias("relation_no"), F.array_join("provenance", ",").alias("markers"))


def r16(s, d):
    first = V.edges(s, d).where("size(provenance) > 0").groupBy("paper_id", C("source_id").alias("id")).agg(F.min_by("provenance", "ord").alias("provenance"))
    u = V.units(s, d).join(first, A.KEY, "left")
    return A.backfill_provenance(u).select("paper_id", "id", F.array_join("provenance", ",").alias("markers"))


def r23(units, nodes, edges, scores):
    """About edges that point to the first Measure of their paper, every other one turned into a support."""
    first = units.where("type = 'Measure'").groupBy("paper_id").agg(F.min("id").alias("m"))
    about = edges.where("relation = 'about'").join(first, "paper_id")
    turned = C("ord") % 2 == 0
    return A.mounted_findings(about.select(
        "paper_id", F.when(turned, C("m")).otherwise(C("source_id")).alias("source_id"), F.when(turned, "supports").otherwise("about").alias("relation"),
        F.when(turned, C("source_id")).otherwise(C("m")).alias("target_id"), "ord",
    ), units)


def r24(units, nodes, edges, scores):
    heads = units.where("type = 'Contribution'").groupBy("paper_id").agg(F.min_by("description", "ord").alias("headline"))
    anchors = A.anchors(units).where("section = 'problem'").select("paper_id", "anchor_id")
    return A.resolves(units, edges, nodes.where("type = 'Contribution'"), heads, anchors)


def r29(s, d):
    return A.provenance_rate(V.edges(s, d), V.paper_blocks(s, d)).select("paper_id", "n_markers", "n_resolved")


def _flat(units):
    return units.drop("ord", "cite_keys")


def further_issues(s, d):
    r = table(s, d, "result_rows").where("source = 'transcribed'").dropDuplicates(["row_no"]).select(C("row_no").alias("ord"), "direction", "table_role")
    marked = table(s, d, "result_rows").select("paper_id", C("table_marker").alias("marker")).where("paper_id is not null").dropDuplicates()
    captured = V.paper_blocks(s, d).where("text rlike '(?i)<table'").select("paper_id", "marker")
    last = F.max_by(F.struct("ir_version"), F.struct("received_at", "record_no")).alias("e")
    versions = table(s, d, "extractions").groupBy("paper_id").agg(last).select("paper_id", "e.ir_version").where("paper_id is not null")
    return A.further_issues(V.units(s, d), V.edges(s, d), V.scores(s, d).join(r, "ord"), marked, captured, versions)


def valid_all(s, d):
    """V11 over the issues of both lists."""
    both = A.issues(V.units(s, d), V.edges(s, d), V.nodes(s, d)).unionByName(further_issues(s, d))
    n = both.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_issues"))
    return table(s, d, "paper_catalog").select("paper_id").dropDuplicates().join(n, "paper_id", "left").select(
        "paper_id", F.coalesce("n_issues", F.lit(0).cast("bigint")).alias("n_issues"), C("n_issues").isNull().alias("valid")
    )


QUERIES = {
    "c1_root_backfill": _ctx(lambda u, n, e, s: A.root_backfill(n.where("type <> 'Contribution' or kind = 'method'")).groupBy("paper_id", "type", "kind").agg(_n())),
    "c2_reprefix": _ctx(lambda u, n, e, s: A.reprefix(n).select("paper_id", "id", "type")),
    "c3_dup_suffix": c3,
    "c5_registry": _ctx(lambda u, n, e, s: A.node_registry(n)),
    "r4_stamp_kind": _ctx(lambda u, n, e, s: _flat(A.stamp_kinds(u, n)).select("paper_id", "id", "kind")),
    "r5_clean_ids": r5,
    "r6_misrouted": _ctx(lambda u, n, e, s: A.misrouted(u, n).groupBy("paper_id", "type").agg(_n())),
    "r7_owned": _ctx(lambda u, n, e, s: A.owned(u).select("paper_id", "id")),
    "r8_eval_frames": _ctx(lambda u, n, e, s: A.eval_frames(u.withColumn("description", F.lit(None).cast("string")), n.withColumn("type", F.when(C("kind").isin("dataset", "benchmark"), "ExperimentSetup").otherwise(C("type"))).withColumn("id", F.regexp_replace("id", "^con:", "exp:")))),
    "r9_dedup_setups": _ctx(lambda u, n, e, s: A.duplicate_setups(u.withColumn("name", C("kind")), n.where("type <> 'ExperimentSetup'"))),
    "r10_rewrite": _ctx(lambda u, n, e, s: A.rewrite_edges(e, A.duplicate_setups(u.withColumn("name", C("kind")), n.where("type <> 'ExperimentSetup'"))).select("paper_id", C("ord").alias("relation_no"), "source_id", "target_id")),
    "r11_first_units": lambda s, d: A.first_units(table(s, d, "graph_units").where("op = 'upsert'").select("paper_id", C("unit_id").alias("id"), "section", "type", "kind", "name", C("changed_at").alias("ord"))).select("paper_id", "id", "type", "kind"),
    "r12_markers": r12,
    "r13_empty_measures": _ctx(lambda u, n, e, s: A.empty_measures(u, s.where("marker is null and ord % 2 = 0"), s.where("marker like '%7%'").select("paper_id", C("measure_id").alias("id"))).select("paper_id", "id")),
    "r14_dup_scores": _ctx(lambda u, n, e, s: A.duplicate_scores(s)),
    "r15_provenance": r15,
    "r16_backfill": r16,
    "r17_anchors": _ctx(lambda u, n, e, s: A.anchors(u)),
    "r18_score_refs": _ctx(lambda u, n, e, s: A.repair_score_refs(s, u).select(C("ord").alias("row_no"), "system_id", "setup_id")),
    "r19_kinds": _ctx(lambda u, n, e, s: A.repair_kinds(u).select("paper_id", "id", "kind", "method_kind", "polarity")),
    "r21_edge_faults": _ctx(lambda u, n, e, s: A.edge_faults(e, u).select("paper_id", C("ord").alias("relation_no"), "fault")),
    "r22_evaluates": _ctx(lambda u, n, e, s: A.missing_evaluates(u, e.where("relation <> 'evaluates'"), s)),
    "r23_mounted": _ctx(r23),
    "r24_resolves": _ctx(r24),
    "r25_value_num": lambda s, d: table(s, d, "result_rows").select("row_no", "value_num", parse_value_num(C("value_raw")).alias("parsed")).groupBy(C("parsed").isNull().alias("unparsed")).agg(_n()),
    "r26_covers": _ctx(lambda u, n, e, s: A.covers(u, n)),
    "r27_coverage": _ctx(lambda u, n, e, s: A.coverage(u, n)),
    "r28_document_kind": _ctx(lambda u, n, e, s: A.document_kind(A.repair_kinds(u), n.where("type = 'Contribution'"))),
    "r29_provenance_rate": r29,
    "r34_sections": _ctx(lambda u, n, e, s: A.nonempty_sections(n.select("paper_id", "section").dropDuplicates(), u)),
    "r36_first_edges": _ctx(lambda u, n, e, s: A.first_edges(e.select("paper_id", "source_id", "relation", "target_id", "ord")).select("paper_id", "source_id", "relation", "target_id", C("ord").alias("relation_no"))),
    "r37_anchored": _ctx(lambda u, n, e, s: A.anchored_edges(e, u).select("paper_id", C("ord").alias("relation_no"))),
    "g1_closure": _ctx(lambda u, n, e, s: A.undirected_closure(n.where("type = 'Contribution'"), e.where("relation = 'co_contribution'"))),
    "g2_adjacency": _ctx(lambda u, n, e, s: A.adjacency(e, u)),
    "g3_roles": _ctx(lambda u, n, e, s: A.display_roles(u, e)),
    "g4_arc": _ctx(lambda u, n, e, s: A.discovery_arc(u, e)),
    "g5_sections": lambda s, d: A.unit_sections(table(s, d, "graph_units").select("paper_id", C("unit_id").alias("id"), "section", C("changed_at").alias("ord")).where("section is not null")),
    "v_issues": _ctx(lambda u, n, e, s: A.issues(u, e, n)),
    "v4_issues": further_issues,
    "v11_valid_all": valid_all,
    "v11_valid": lambda s, d: table(s, d, "paper_catalog").select("paper_id").dropDuplicates().join(
        A.issues(V.units(s, d), V.edges(s, d), V.nodes(s, d)).groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_issues")), "paper_id", "left"
    ).select("paper_id", F.coalesce("n_issues", F.lit(0).cast("bigint")).alias("n_issues"), C("n_issues").isNull().alias("valid")),
}

_CHG = f"chg AS (SELECT *, {canon_sql('unit_id')} AS id FROM graph_units)"
_U = f"""{_CHG}, u AS (SELECT paper_id, id, section, type, kind, name, description, changed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY paper_id, id ORDER BY changed_at DESC, op = 'delete' DESC) AS rn FROM chg) WHERE rn = 1 AND op <> 'delete')"""
_N = """n AS (SELECT paper_id, id, section, type, kind, name, description, changed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY paper_id, id ORDER BY changed_at) AS rn FROM chg WHERE op <> 'delete' AND type <> 'Finding') WHERE rn = 1)"""
_E = f"""e AS (SELECT DISTINCT paper_id, {canon_sql('source_id')} AS source_id, relation, {canon_sql('target_id')} AS target_id, relation_no FROM relations)"""
_S = f"""s AS (SELECT DISTINCT paper_id, {canon_sql('measure_id')} AS measure_id, {canon_sql('system_id')} AS system_id, {canon_sql('setup_id')} AS setup_id, variant, value_raw, table_marker, row_no
  FROM result_rows WHERE source = 'transcribed')"""


def _with(*parts, body):
    return "WITH " + ", ".join(parts) + " " + body


def _in(xs):
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


_VALID = " OR ".join(f"(type = '{t}' AND {{k}} IN {_in(k)})" for t, k in vocab.KINDS_BY_TYPE.items())
_OWN = " OR ".join(f"(section = '{s}' AND type IN {_in(t)})" for s, t in vocab.SECTION_UNIT_TYPES.items())
_PT = "CASE split_part(id, ':', 1) " + " ".join(f"WHEN '{p}' THEN '{t}'" for t, p in vocab.ID_PREFIX.items()) + " END"
_MATRIX = "m AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in vocab.matrix_rows()) + ") AS t(relation, st, tt))"
_TE = "te AS (SELECT e.*, a.type AS st, b.type AS tt FROM e LEFT JOIN u a ON a.paper_id = e.paper_id AND a.id = e.source_id LEFT JOIN u b ON b.paper_id = e.paper_id AND b.id = e.target_id)"
_DUPS = """dup AS (WITH st AS (SELECT * FROM u WHERE type = 'ExperimentSetup' AND kind <> ''),
  f AS (SELECT paper_id, section, kind, arg_min(id, (changed_at, id)) AS new_id FROM st GROUP BY ALL)
  SELECT DISTINCT st.paper_id, st.id AS old_id, new_id FROM st JOIN f ON f.paper_id = st.paper_id AND f.section = st.section AND f.kind = st.kind
  WHERE st.id <> new_id AND NOT EXISTS (SELECT 1 FROM n WHERE n.type <> 'ExperimentSetup' AND n.paper_id = st.paper_id AND n.id = st.id))"""

_CLOSURE = """link AS (SELECT paper_id, source_id AS a, target_id AS b FROM e WHERE relation = 'co_contribution' AND source_id IS NOT NULL AND target_id IS NOT NULL
  UNION SELECT paper_id, target_id, source_id FROM e WHERE relation = 'co_contribution' AND source_id IS NOT NULL AND target_id IS NOT NULL),
reach AS (SELECT paper_id, id FROM n WHERE type = 'Contribution' UNION SELECT l.paper_id, l.b FROM reach r JOIN link l ON l.paper_id = r.paper_id AND l.a = r.id)"""

_TOK = lambda x: f"list_distinct(list_filter(string_split({norm_sql(x)}, ' '), lambda w: length(w) > 3))"

_ISSUES = f"""i AS (
SELECT paper_id, 'id_format' AS rule, id AS subject FROM u WHERE NOT regexp_full_match(id, '[a-z][a-z0-9_]*:[a-z0-9_]+')
UNION SELECT paper_id, 'unknown_type', id FROM u WHERE coalesce(type NOT IN {_in(vocab.ID_PREFIX)}, true)
UNION SELECT paper_id, 'prefix', id FROM u WHERE {_PT} <> type
UNION SELECT paper_id, 'kind', id FROM u WHERE kind IS NOT NULL AND NOT coalesce({_VALID.format(k='kind')}, false)
UNION SELECT paper_id, 'name', id FROM u WHERE coalesce(trim(name), '') = ''
UNION SELECT paper_id, 'section_type', id FROM u WHERE section IS NOT NULL AND NOT coalesce({_OWN}, false)
UNION SELECT paper_id, 'dangling_source_id', source_id FROM te WHERE st IS NULL
UNION SELECT paper_id, 'dangling_target_id', target_id FROM te WHERE tt IS NULL
UNION SELECT paper_id, 'edge_' || fault, source_id FROM (SELECT te.*, CASE WHEN source_id = target_id THEN 'self_loop' WHEN te.relation NOT IN {_in(vocab.RELATION_MATRIX)} THEN 'unknown_relation'
   WHEN m.relation IS NULL THEN 'type_pair' END AS fault FROM te LEFT JOIN m ON m.relation = te.relation AND m.st = te.st AND m.tt = te.tt WHERE te.st IS NOT NULL AND te.tt IS NOT NULL) WHERE fault IS NOT NULL
UNION SELECT paper_id, 'marker', source_id FROM (SELECT paper_id, {canon_sql('source_id')} AS source_id, unnest(provenance) AS mk FROM relations) WHERE NOT regexp_full_match(mk, '§([0-9]+|[A-Za-z]+)')
UNION SELECT paper_id, 'unsupported', id FROM u WHERE type = 'Finding' AND section <> 'evidence' AND NOT EXISTS (SELECT 1 FROM e WHERE relation = 'supports' AND e.paper_id = u.paper_id AND e.target_id = u.id)
UNION SELECT paper_id, 'not_materialised', id FROM n WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.paper_id = n.paper_id AND u.id = n.id))"""

ORACLE = {
    "c1_root_backfill": _with(_CHG, _N, body="""SELECT paper_id, type, kind, count(*) AS n FROM (
SELECT x.paper_id, CASE WHEN c THEN 'Contribution' ELSE x.type END AS type, CASE WHEN c THEN CASE WHEN x.type = 'Component' THEN 'method' WHEN x.kind IN ('dataset', 'benchmark') THEN x.kind ELSE 'dataset' END ELSE x.kind END AS kind
FROM (SELECT *, coalesce(count(*) FILTER (WHERE type = 'Contribution') OVER (PARTITION BY paper_id) = 0 AND type IN ('Component', 'ExperimentSetup')
   AND row_number() OVER (PARTITION BY paper_id ORDER BY CASE type WHEN 'Component' THEN 0 WHEN 'ExperimentSetup' THEN 1 ELSE 2 END, changed_at, id) = 1, false) AS c
   FROM n WHERE type <> 'Contribution' OR kind = 'method') x) GROUP BY ALL"""),
    "c2_reprefix": _with(_CHG, _N, body=f"""SELECT paper_id, type, CASE WHEN regexp_full_match(x, '[a-z][a-z0-9_]*:[a-z0-9_]+') THEN x ELSE id END AS id FROM (
SELECT *, CASE type {' '.join(f"WHEN '{t}' THEN '{p}'" for t, p in vocab.ID_PREFIX.items())} END || ':' || regexp_replace(regexp_replace(lower(CASE WHEN strpos(id, ':') > 0 THEN substr(id, strpos(id, ':') + 1) ELSE id END), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS x FROM n)"""),
    "c5_registry": _with(_CHG, _N, body="SELECT paper_id, id, type, CASE WHEN type IN ('Contribution', 'Component') THEN 'method' WHEN type = 'ExperimentSetup' THEN 'setup' ELSE lower(type) END AS cluster, nullif(kind, '') AS kind, name FROM n"),
    "r4_stamp_kind": _with(_U, _N, body=f"""SELECT u.paper_id, u.id, CASE WHEN {_VALID.format(k='n.kind').replace('type =', 'u.type =')} THEN n.kind ELSE u.kind END AS kind FROM u LEFT JOIN n ON n.paper_id = u.paper_id AND n.id = u.id"""),
    "r6_misrouted": _with(_U, _N, body=f"""SELECT paper_id, CASE WHEN wrong THEN pt ELSE type END AS type, count(*) AS n FROM (
SELECT *, coalesce(type <> pt AND (nt IS NULL OR nt = pt), false) AS wrong FROM (SELECT u.*, {_PT.replace('(id', '(u.id')} AS pt, n.type AS nt FROM u LEFT JOIN n ON n.paper_id = u.paper_id AND n.id = u.id)) GROUP BY ALL"""),
    "r7_owned": _with(_U, body=f"SELECT paper_id, id FROM u WHERE {_OWN}"),
    "r8_eval_frames": _with(_U, _N, body=f"""SELECT paper_id, old_id, new_id FROM (SELECT b.paper_id, b.id AS old_id, arg_min(x.new_id, pos) AS new_id FROM (
  SELECT paper_id, id, 0 AS pos, {norm_sql('name')} AS nm FROM u WHERE type = 'Contribution' AND kind IN ('dataset', 'benchmark')
  UNION ALL SELECT paper_id, id, 1, regexp_replace({norm_sql('name')}, '( ?\\b({'|'.join(vocab.EVAL_FRAME_WORDS)}))+$', '') FROM u WHERE type = 'Contribution' AND kind IN ('dataset', 'benchmark')) b
JOIN (SELECT paper_id, {norm_sql('name')} AS nm, arg_min(regexp_replace(id, '^con:', 'exp:'), (changed_at, id)) AS new_id FROM n WHERE (type = 'ExperimentSetup' OR kind IN ('dataset', 'benchmark')) AND {norm_sql('name')} <> '' GROUP BY ALL) x
ON x.paper_id = b.paper_id AND x.nm = b.nm GROUP BY ALL) WHERE old_id <> new_id"""),
    "r9_dedup_setups": _with(_U, _N, _DUPS, body="SELECT paper_id, old_id, new_id FROM dup"),
    "r10_rewrite": _with(_U, _N, _DUPS, _E, body="""SELECT e.paper_id, relation_no, coalesce(a.new_id, source_id) AS source_id, coalesce(b.new_id, target_id) AS target_id FROM e
LEFT JOIN dup a ON a.paper_id = e.paper_id AND a.old_id = source_id LEFT JOIN dup b ON b.paper_id = e.paper_id AND b.old_id = target_id"""),
    "r11_first_units": "SELECT paper_id, id, type, kind FROM (SELECT paper_id, unit_id AS id, type, kind, row_number() OVER (PARTITION BY paper_id, unit_id ORDER BY changed_at) AS rn FROM graph_units WHERE op = 'upsert') WHERE rn = 1",
    "r13_empty_measures": _with(_U, _S, body="SELECT paper_id, id FROM u WHERE type = 'Measure' AND NOT EXISTS (SELECT 1 FROM s WHERE s.paper_id = u.paper_id AND s.measure_id = u.id AND (table_marker IS NULL AND row_no % 2 = 0 OR table_marker LIKE '%7%'))"),
    "r14_dup_scores": _with(_S, body="SELECT paper_id, measure_id, CAST(sum(c - 1) AS BIGINT) AS n_repeated FROM (SELECT paper_id, measure_id, coalesce(variant, '') AS v, coalesce(setup_id, '') AS t, count(*) AS c FROM s GROUP BY ALL) WHERE c > 1 GROUP BY ALL"),
    "r17_anchors": _with(_U, body="""SELECT paper_id, section, arg_min(id, (NOT coalesce(type = CASE section WHEN 'problem' THEN 'Problem' WHEN 'method' THEN 'Contribution' WHEN 'evidence' THEN 'Measure' END, false), changed_at, id)) AS anchor_id
FROM u WHERE type <> 'Document' GROUP BY ALL"""),
    "r18_score_refs": _with(_U, _S, body="""SELECT row_no, CASE WHEN EXISTS (SELECT 1 FROM u WHERE u.paper_id = s.paper_id AND u.id = s.system_id AND type IN ('Contribution', 'Component')) THEN system_id ELSE '' END AS system_id,
CASE WHEN EXISTS (SELECT 1 FROM u WHERE u.paper_id = s.paper_id AND u.id = s.setup_id AND (type = 'ExperimentSetup' OR type = 'Contribution' AND kind IN ('dataset', 'benchmark'))) THEN setup_id ELSE '' END AS setup_id FROM s"""),
    "r19_kinds": _with(_U, body=f"""SELECT paper_id, id, CASE WHEN NOT bad THEN kind WHEN type = 'Finding' THEN 'descriptive' WHEN type = 'Contribution' THEN 'method' END AS kind,
CASE WHEN type = 'Contribution' AND bad AND kind IN {_in(vocab.METHOD_KINDS)} THEN kind END AS method_kind, CASE WHEN type = 'Finding' AND bad AND kind IN {_in(vocab.POLARITIES)} THEN kind END AS polarity
FROM (SELECT *, NOT coalesce({_VALID.format(k='kind')}, false) AS bad FROM u)"""),
    "r21_edge_faults": _with(_U, _E, _MATRIX, _TE, body=f"""SELECT te.paper_id, relation_no, CASE WHEN source_id = target_id THEN 'self_loop' WHEN te.relation NOT IN {_in(vocab.RELATION_MATRIX)} THEN 'unknown_relation'
WHEN m.relation IS NULL THEN 'type_pair' END AS fault FROM te LEFT JOIN m ON m.relation = te.relation AND m.st = te.st AND m.tt = te.tt"""),
    "r22_evaluates": _with(_U, _E, _S, body="""SELECT paper_id, source_id, CASE WHEN n = 1 THEN a ELSE r END AS target_id FROM (
SELECT s.paper_id, s.measure_id AS source_id, count(DISTINCT s.system_id) AS n, count(DISTINCT s.system_id) FILTER (WHERE y.type = 'Contribution') AS c, min(s.system_id) AS a, min(s.system_id) FILTER (WHERE y.type = 'Contribution') AS r
FROM s JOIN u x ON x.paper_id = s.paper_id AND x.id = s.measure_id AND x.type = 'Measure' JOIN u y ON y.paper_id = s.paper_id AND y.id = s.system_id AND y.type IN ('Contribution', 'Component')
GROUP BY ALL) WHERE n = 1 OR c = 1"""),
    "r23_mounted": _with(_U, _E, body="""SELECT DISTINCT e.paper_id, m.id AS measure_id, e.source_id AS finding_id FROM e JOIN (SELECT paper_id, min(id) AS id FROM u WHERE type = 'Measure' GROUP BY ALL) m ON m.paper_id = e.paper_id
JOIN u f ON f.paper_id = e.paper_id AND f.id = e.source_id AND f.type = 'Finding' WHERE relation = 'about'"""),
    "r24_resolves": "WITH RECURSIVE " + ", ".join([_U, _N, _E, _TE, _CLOSURE, f"""
head AS (SELECT paper_id, arg_min(description, (changed_at, id)) AS h FROM u WHERE type = 'Contribution' GROUP BY ALL),
mot AS (SELECT te.paper_id, arg_min(source_id, relation_no) AS p FROM te JOIN reach r ON r.paper_id = te.paper_id AND r.id = te.target_id WHERE relation = 'motivates' AND st = 'Problem' GROUP BY ALL),
sole AS (SELECT paper_id, min(id) AS p FROM u WHERE type = 'Problem' GROUP BY ALL HAVING count(*) = 1),
held AS (SELECT paper_id, arg_min(id, (changed_at, id)) AS p FROM u WHERE section = 'problem' AND type = 'Problem' GROUP BY ALL),
prob AS (SELECT paper_id, coalesce(any_value(a), any_value(b), any_value(c)) AS p FROM (SELECT paper_id, p AS a, NULL AS b, NULL AS c FROM mot UNION ALL SELECT paper_id, NULL, p, NULL FROM held UNION ALL SELECT paper_id, NULL, NULL, p FROM sole) GROUP BY ALL),
ab AS (SELECT te.paper_id, te.target_id, te.source_id, relation_no, coalesce(len(list_intersect({_TOK("coalesce(h, '')")}, {_TOK("coalesce(f.description, '')")})), 0) AS sc
  FROM te JOIN reach r ON r.paper_id = te.paper_id AND r.id = te.target_id JOIN u f ON f.paper_id = te.paper_id AND f.id = te.source_id LEFT JOIN head ON head.paper_id = te.paper_id WHERE relation = 'about' AND st = 'Finding'),
best AS (SELECT paper_id, target_id, arg_min(source_id, (-sc, relation_no, source_id)) AS source_id FROM ab GROUP BY ALL)"""]) + " SELECT DISTINCT b.paper_id, b.source_id, p AS target_id FROM best b JOIN prob ON prob.paper_id = b.paper_id",
    "r25_value_num": f"SELECT parsed IS NULL AS unparsed, count(*) AS n FROM (SELECT {VALUE_NUM_SQL} AS parsed FROM (SELECT ltrim(replace(replace(trim(value_raw), '−', '-'), '–', '-'), '≈~<>≤≥±$ ' || chr(9)) AS t FROM result_rows)) GROUP BY ALL",
    "r26_covers": _with(_U, _N, body="SELECT u.paper_id, u.section, u.id FROM u SEMI JOIN n ON n.paper_id = u.paper_id AND n.id = u.id"),
    "r27_coverage": _with(_U, _N, body="SELECT n.paper_id, count(*) AS n_planned, count(u.id) AS n_covered, count(*) FILTER (WHERE u.id IS NULL) AS n_missing FROM n LEFT JOIN u ON u.paper_id = n.paper_id AND u.id = n.id GROUP BY ALL"),
    "r28_document_kind": _with(_U, _N, body=f"""SELECT paper_id, CASE WHEN t = 'Contribution' AND k IN ('dataset', 'benchmark') THEN 'benchmark_survey' WHEN t IN ('Contribution', 'Component') AND mk = 'taxonomy' THEN 'review' ELSE 'research_article' END AS document_kind FROM (
SELECT x.paper_id, arg_min(x.type, (x.changed_at, x.id)) AS t, arg_min(CASE WHEN bad THEN 'method' ELSE kind END, (x.changed_at, x.id)) AS k,
  arg_min(coalesce(CASE WHEN bad AND type = 'Contribution' THEN kind END, ''), (x.changed_at, x.id)) AS mk
FROM (SELECT *, NOT coalesce({_VALID.format(k='kind')}, false) AS bad FROM u) x SEMI JOIN (SELECT * FROM n WHERE type = 'Contribution') c ON c.paper_id = x.paper_id AND c.id = x.id GROUP BY ALL)"""),
    "r34_sections": _with(_U, _N, body="SELECT DISTINCT n.paper_id, n.section FROM n SEMI JOIN u ON u.paper_id = n.paper_id AND u.section = n.section"),
    "r36_first_edges": _with(_E, body="SELECT paper_id, source_id, relation, target_id, min(relation_no) AS relation_no FROM e GROUP BY ALL"),
    "r37_anchored": _with(_U, _E, _TE, body="SELECT paper_id, relation_no FROM te WHERE st IS NOT NULL AND tt IS NOT NULL"),
    "g1_closure": "WITH RECURSIVE " + ", ".join([_U, _N, _E, _CLOSURE]) + " SELECT DISTINCT paper_id, id FROM reach",
    "g2_adjacency": _with(_U, _E, body="""SELECT x.paper_id, x.id, sum(o) AS n_out, sum(i) AS n_in, count(DISTINCT v.id) AS n_neighbours FROM (
SELECT DISTINCT paper_id, source_id AS id, target_id AS other, relation, 1 AS o, 0 AS i FROM e UNION ALL SELECT DISTINCT paper_id, target_id, source_id, relation, 0, 1 FROM e) x
SEMI JOIN u ON u.paper_id = x.paper_id AND u.id = x.id LEFT JOIN u v ON v.paper_id = x.paper_id AND v.id = x.other GROUP BY ALL"""),
    "g3_roles": _with(_U, _E, body="""SELECT paper_id, id, CASE WHEN type = 'Contribution' THEN 'contribution' WHEN EXISTS (SELECT 1 FROM e WHERE e.paper_id = u.paper_id AND relation = 'compares_to' AND (source_id = u.id OR target_id = u.id)) THEN 'compared_against'
ELSE 'component' END AS role FROM u WHERE type IN ('Contribution', 'Component')"""),
    "g4_arc": _with(_U, _E, body="""SELECT coalesce(p.paper_id, c.paper_id) AS paper_id, coalesce(p.id, r.t) AS problem_id, c.id AS root_id, coalesce(r.s, a.s) AS finding_id
FROM (SELECT paper_id, arg_min(id, (changed_at, id)) AS id FROM u WHERE type = 'Problem' AND section = 'problem' GROUP BY ALL) p
FULL JOIN (SELECT paper_id, arg_min(id, (changed_at, id)) AS id FROM u WHERE type = 'Contribution' GROUP BY ALL) c ON c.paper_id = p.paper_id
LEFT JOIN (SELECT paper_id, source_id AS s, target_id AS t FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY relation_no) AS k FROM e WHERE relation = 'resolves') WHERE k = 1) r ON r.paper_id = coalesce(p.paper_id, c.paper_id)
LEFT JOIN (SELECT e.paper_id, e.target_id, arg_min(e.source_id, relation_no) AS s FROM e JOIN u f ON f.paper_id = e.paper_id AND f.id = e.source_id AND f.type = 'Finding' WHERE relation = 'about' GROUP BY ALL) a ON a.paper_id = c.paper_id AND a.target_id = c.id"""),
    "g5_sections": "SELECT paper_id, unit_id AS id, arg_max(section, changed_at) AS last_section, arg_min(section, changed_at) AS first_section FROM graph_units WHERE section IS NOT NULL GROUP BY ALL",
    "v_issues": _with(_U, _N, _E, _MATRIX, _TE, _ISSUES, body="SELECT paper_id, rule, subject FROM i"),
    "v11_valid": _with(_U, _N, _E, _MATRIX, _TE, _ISSUES, body="SELECT c.paper_id, coalesce(k, 0) AS n_issues, k IS NULL AS valid FROM (SELECT DISTINCT paper_id FROM paper_catalog) c LEFT JOIN (SELECT paper_id, count(*) AS k FROM i GROUP BY ALL) x ON x.paper_id = c.paper_id"),
}

from folioweave.queries.texts import _BLOCKS  # noqa: E402

ORACLE |= {
    "r12_markers": _with(_S, _BLOCKS, body="""SELECT s.paper_id, count(*) FILTER (WHERE k.marker IS NOT NULL) AS n_kept, count(*) AS n FROM s
LEFT JOIN (SELECT DISTINCT paper_id, marker FROM blocks WHERE strpos(lower(b), '<table') > 0) k ON k.paper_id = s.paper_id AND k.marker = s.table_marker GROUP BY ALL"""),
    "r29_provenance_rate": _with(_BLOCKS, body="""SELECT e.paper_id, count(*) AS n_markers, count(k.marker) AS n_resolved FROM (SELECT paper_id, unnest(provenance) AS marker FROM (SELECT DISTINCT relation_no, paper_id, provenance FROM relations)) e
LEFT JOIN (SELECT DISTINCT paper_id, marker FROM blocks) k ON k.paper_id = e.paper_id AND k.marker = e.marker WHERE regexp_full_match(e.marker, '§[0-9]+') GROUP BY ALL"""),
    "r16_backfill": _with(_U, f"ep AS (SELECT DISTINCT relation_no, paper_id, {canon_sql('source_id')} AS source_id, provenance FROM relations)", body="""SELECT paper_id, id, coalesce(array_to_string(coalesce(own, CASE WHEN section IS NOT NULL THEN sib END), ','), '') AS markers FROM (
SELECT u.paper_id, u.id, u.section, f.pv AS own, arg_min(f.pv, (changed_at, u.id)) FILTER (WHERE f.pv IS NOT NULL) OVER (PARTITION BY u.paper_id, u.section) AS sib FROM u
LEFT JOIN (SELECT paper_id, source_id, arg_min(provenance, relation_no) AS pv FROM ep WHERE len(provenance) > 0 GROUP BY ALL) f ON f.paper_id = u.paper_id AND f.source_id = u.id)"""),
}

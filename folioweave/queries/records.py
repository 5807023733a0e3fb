"""Queries over the graphs that the payloads of extractions hold: repair steps, the whole assembly, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.operators import assemble as A
from folioweave.operators import graph as G
from folioweave.operators import text as T
from folioweave.operators import validate
from folioweave.plans import assembly, sample
from folioweave.plans import views as V
from folioweave.queries.assembly import labels
from folioweave.queries.problems import _JD, _JL, canon_sql
from folioweave.session import cut, table

C = F.col


def graph(s, d):
    """The graphs as received."""
    return G.graph(table(s, d, "extractions"))


def captured(s, d):
    """(paper_id, marker, caption) of the captured tables."""
    docs = table(s, d, "documents").select("doc_id", "paper_id", "text")
    tabs = T.source_tables(docs).join(docs.select("doc_id", "paper_id").dropDuplicates(["doc_id"]), "doc_id")
    return tabs.groupBy("paper_id", "marker").agg(F.min_by("caption", "doc_id").alias("caption"))


def context(s, d):
    """What the steps know beside the records; every table is read by several steps."""
    blocks = V.paper_blocks(s, d).select("paper_id", "marker").dropDuplicates()
    heads = table(s, d, "paper_catalog").groupBy("paper_id").agg(F.max("headline_result").alias("headline"))
    return assembly.Context(*(cut(t) for t in (V.nodes(s, d), captured(s, d), blocks, labels(s, d), heads)))


def assembled(s, d):
    return assembly.assemble(graph(s, d), context(s, d))


def _joined(c):
    return F.coalesce(F.array_join(c, ","), F.lit(""))


def r16(s, d):
    g = G.backfilled(G.flattened(graph(s, d)))
    return g.units.where("type in ('Measure', 'Finding')").select("paper_id", "id", "unit", _joined("provenance").alias("markers")).dropDuplicates()


def r18(s, d):
    g = G.references_repaired(graph(s, d))
    return g.scores.where("unit_type = 'Measure'").select("paper_id", "measure_id", "row_no", *(F.coalesce(c, F.lit("")).alias(c) for c in G.REFERENCES)).dropDuplicates()


def r18_lists(s, d):
    g = G.references_repaired(graph(s, d))
    return g.units.where("type = 'Measure' and setup_ids_listed").select("paper_id", "id", _joined("setup_ids").alias("setups")).dropDuplicates()


def r20(s, d):
    u = G.formulas_cleaned(graph(s, d)).units.where("size(formulas) > 0")
    return u.select("paper_id", "id", F.size("formulas").alias("n"), F.array_join(F.transform("formulas", lambda f: f["expression"]), " ; ").alias("expressions")).dropDuplicates()


def r25(s, d):
    return A.has_payload(graph(s, d).units).where("type = 'Measure'").select("paper_id", "id", "has_quantitative_payload").dropDuplicates()


def r33_log(s, d):
    return assembled(s, d).log.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("paper_id").alias("n_papers"))


def r33_units(s, d):
    return assembled(s, d).graph.units.select("paper_id", "id", "section", "type", "kind", _joined("provenance").alias("markers"), "has_quantitative_payload", "caption")


def r33_edges(s, d):
    return assembled(s, d).graph.edges.select("paper_id", "source_id", "relation", "target_id", _joined("provenance").alias("markers"))


def _sides(s, d):
    """The graphs as received and as assembled, each with its faults."""
    x, raw = context(s, d), graph(s, d).cut()
    new = assembly.assemble(raw, x).graph
    return [(g, cut(validate.issues(g, x.nodes, x.tables))) for g in (raw, new)]


def x6(s, d):
    """Per paper the differences of units, edges and faults between the records as received and as assembled."""
    (raw, before), (new, after) = _sides(s, d)
    out = None
    for t, b, a in (("units", raw.units, new.units), ("edges", raw.edges, new.edges), ("issues", before, after)):
        b, a = (x.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n")) for x in (b, a))
        j = b.withColumnRenamed("n", "b").join(a.withColumnRenamed("n", "a"), "paper_id", "full")
        j = j.select("paper_id", (F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias(f"d_{t}"))
        out = j if out is None else out.join(j, "paper_id", "full")
    return out.fillna(0)


def x9(s, d):
    """What the assembly made of every fault: fixed, still there, or new."""
    key = ["paper_id", "rule", "subject"]
    before, after = (i.select(*key).dropDuplicates() for _, i in _sides(s, d))
    j = before.withColumn("b", F.lit(True)).join(after.withColumn("a", F.lit(True)), key, "full")
    return sample.outcome_tally(j.select(F.when(C("a").isNull(), "fixed").when(C("b").isNull(), "regression").otherwise("still").alias("outcome")))


def c4(s, d):
    first = V.edges(s, d).where("size(provenance) > 0").groupBy("paper_id", C("source_id").alias("id")).agg(F.min_by("provenance", "ord").alias("provenance"))
    papers = table(s, d, "paper_catalog").groupBy("paper_id").agg(*(F.max_by(c, "exported_at").alias(c) for c in ("central_contribution", "topics", "tasks", "domain")))
    return validate.census_issues(V.nodes(s, d).join(first, A.KEY, "left"), papers).select("paper_id", "rule", "subject")


QUERIES = {
    "a6_key_counts": lambda s, d: G.key_counts(graph(s, d)),
    "r1_units": lambda s, d: G.flattened(graph(s, d)).units.select("paper_id", "section", "id", "type").dropDuplicates(),
    "r3_aliases": lambda s, d: G.renamed(graph(s, d), lambda c: F.regexp_replace(c, "^cmp:", "met:")).edges.select("paper_id", "source_id", "target_id").dropDuplicates(),
    "r13_no_scores": lambda s, d: G.without_empty_measures(graph(s, d))[1].dropDuplicates(),
    "r16_backfill_records": r16,
    "r17_local_anchors": lambda s, d: G.anchored(graph(s, d)).sections.where("anchor_id is not null").select("paper_id", "section", "anchor_id").dropDuplicates(),
    "r18_local_refs": r18,
    "r18_setup_lists": r18_lists,
    "r20_formulas": r20,
    "r25_payload": r25,
    "r33_log": r33_log,
    "r33_units": r33_units,
    "r33_edges": r33_edges,
    "c4_census": c4,
    "c6_node_ids": lambda s, d: validate.node_ids(V.nodes(s, d)),
    "x6_replay": x6,
    "x9_outcomes": x9,
}


def _JO(j):  # noqa: N802
    """As _JM, the members of an object in the order of their keys."""
    return f"CASE WHEN json_type({j}) = 'ARRAY' THEN CAST({j} AS JSON[]) WHEN json_type({j}) = 'OBJECT' THEN list_transform(list_sort(json_keys({j})), lambda k: json_extract({j}, '$.\"' || k || '\"')) ELSE [] END"


def _first(j: str) -> str:
    return f"list_filter(list_transform({_JL(j)}, lambda x: {_JD('x')}), lambda x: json_type(x) = 'OBJECT')[1]"


_UNWRAP = "CASE WHEN (j->'sections') IS NULL THEN coalesce({w}, j) ELSE j END".format(w=_JD("coalesce(j->'06_extraction', j->'extraction', j->'result')"))
_ARRAYS = [("units", None), *vocab.TYPED_ARRAY_KEYS.items()]
#: The graphs of the payloads in DuckDB SQL: documents, sections, units in order, scores, edges.
PAY = f"""x0 AS (SELECT paper_id, arg_max(payload, (received_at, payload)) AS payload FROM extractions WHERE paper_id IS NOT NULL AND payload IS NOT NULL GROUP BY ALL),
x1 AS (SELECT paper_id, {_JD("j")} AS j FROM (SELECT paper_id, CAST(payload AS JSON) AS j FROM x0 WHERE json_valid(payload))),
x2 AS (SELECT paper_id, {_first("j")} AS j FROM x1), x3 AS (SELECT paper_id, {_UNWRAP} AS j FROM x2), x4 AS (SELECT paper_id, {_first("j")} AS j FROM x3),
x5 AS (SELECT paper_id, {_UNWRAP} AS j FROM x4), pd AS (SELECT paper_id, {_first("j")} AS j FROM x5 WHERE j IS NOT NULL),
s0 AS (SELECT paper_id, {_JD("x")} AS j, i FROM (SELECT paper_id, unnest({_JO(_JD("j->'sections'"))}) AS x, generate_subscripts({_JO(_JD("j->'sections'"))}, 1) AS i FROM pd)
  UNION ALL SELECT paper_id, j, 1000000 FROM pd),
s1 AS (SELECT paper_id, i, CASE WHEN i < 1000000 AND json_type({_JD("j->'section'")}) = 'OBJECT' THEN {_JD("j->'section'")} ELSE j END AS j FROM s0 WHERE json_type(j) = 'OBJECT'),
u0 AS ({" UNION ALL ".join(f'''SELECT paper_id, i, j->>'section_type' AS section, {k} * 1000000 + generate_subscripts({_JO(_JD(f"j->'{a}'"))}, 1) AS o, unnest({_JO(_JD(f"j->'{a}'"))}) AS x, {f"'{t}'" if t else "CAST(NULL AS VARCHAR)"} AS t FROM s1''' for k, (a, t) in enumerate(_ARRAYS))}),
pu AS (SELECT paper_id, i, section, i * 10000000 + o AS o, u, u->>'id' AS id, coalesce(u->>'type', t) AS type, t, u->>'kind' AS kind FROM (SELECT * EXCLUDE (x), {_JD("x")} AS u FROM u0) WHERE json_type(u) = 'OBJECT'),
ps AS (SELECT paper_id, i, j->>'section_type' AS section, j->>'anchor_id' AS anchor_id FROM s1 s WHERE j->>'section_type' IS NOT NULL OR j->>'anchor_id' IS NOT NULL OR EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = s.paper_id AND pu.i = s.i)),
pc0 AS (SELECT paper_id, i, o, id AS measure_id, type, {_JD("u->'scores'")} AS sc FROM pu),
pc AS (SELECT paper_id, i, measure_id, type, {_JD("x")} AS x, CAST(n - 1 AS INTEGER) AS row_no FROM (SELECT paper_id, i, measure_id, type, unnest({_JL("sc")}) AS x, generate_subscripts({_JL("sc")}, 1) AS n FROM pc0 WHERE json_type(sc) IN ('ARRAY', 'OBJECT'))),
pe AS (SELECT paper_id, x->>'source_id' AS source_id, x->>'relation' AS relation, x->>'target_id' AS target_id FROM (SELECT paper_id, unnest(CASE WHEN json_type({_JD("j->'relations'")}) = 'ARRAY' THEN CAST({_JD("j->'relations'")} AS JSON[]) ELSE [] END) AS x FROM pd) WHERE json_type(x) = 'OBJECT')"""


def _list(key: str) -> str:
    """The texts of a list, or of one text; null without either."""
    return f"CASE WHEN json_type(u->'{key}') = 'ARRAY' THEN list_transform(CAST(u->'{key}' AS JSON[]), lambda e: e->>'$') WHEN json_type(u->'{key}') NOT IN ('OBJECT', 'NULL') THEN [u->>'{key}'] END"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_OWN = " OR ".join(f"(section = '{s}' AND t IN {_in(t)})" for s, t in vocab.SECTION_UNIT_TYPES.items())
_R1 = f"r1 AS (SELECT * FROM pu WHERE t IS NULL OR {_OWN})"
_HOST = "(type = 'ExperimentSetup' OR type = 'Contribution' AND kind IN ('dataset', 'benchmark'))"
_NSC = f"(SELECT count(*) FROM (SELECT unnest({_JL(_JD("u->'scores'"))}) AS e) WHERE json_type({_JD("u->'scores'")}) IN ('ARRAY', 'OBJECT'))"
_MARK = "CASE WHEN trim(u->>'source_table_marker') <> '' THEN CASE WHEN starts_with(trim(u->>'source_table_marker'), '§') THEN trim(u->>'source_table_marker') ELSE '§' || trim(u->>'source_table_marker') END END"
_MARK_OK = f"CASE WHEN regexp_full_match({_MARK}, '§([0-9]+|[A-Za-z]+)') THEN [{_MARK}] END"
_PT = "CASE split_part(id, ':', 1) " + " ".join(f"WHEN '{p}' THEN '{t}'" for t, p in vocab.ID_PREFIX.items()) + " END"

ORACLE = {
    "a6_key_counts": f"""WITH {PAY}, k AS (SELECT paper_id, 'rel:' || relation AS key FROM pe WHERE relation <> ''
UNION ALL SELECT paper_id, 'edge:setup_ids' FROM (SELECT paper_id, unnest({_list('setup_ids')}) AS v FROM pu) WHERE v <> '' UNION ALL SELECT paper_id, 'edge:finding_ids' FROM (SELECT paper_id, unnest({_list('finding_ids')}) AS v FROM pu) WHERE v <> '')
SELECT paper_id, key, count(*) AS n FROM k GROUP BY ALL UNION ALL SELECT paper_id, 'relations_total', count(*) FROM k GROUP BY ALL""",
    "r1_units": f"WITH {PAY}, {_R1} SELECT DISTINCT paper_id, section, id, type FROM r1",
    "r3_aliases": f"WITH {PAY} SELECT DISTINCT paper_id, regexp_replace(source_id, '^cmp:', 'met:') AS source_id, regexp_replace(target_id, '^cmp:', 'met:') AS target_id FROM pe",
    "r13_no_scores": f"WITH {PAY} SELECT DISTINCT paper_id, id FROM pu WHERE type = 'Measure' AND {_NSC} = 0 AND coalesce(u->>'source_table_marker', '') = ''",
    "r16_backfill_records": f"""WITH {PAY}, {_R1}, b AS (SELECT *, CASE WHEN len(p0) > 0 THEN p0 END AS p, {_MARK_OK} AS m FROM (SELECT *, {_list('provenance')} AS p0 FROM r1)),
sib AS (SELECT paper_id, i, arg_min(p, o) AS sp FROM b WHERE p IS NOT NULL GROUP BY ALL),
mo AS (SELECT paper_id, i, f, arg_min(coalesce(p, m), o) AS mp FROM (SELECT paper_id, i, o, p, m, unnest({_list('finding_ids')}) AS f FROM b WHERE type = 'Measure' AND coalesce(p, m) IS NOT NULL) GROUP BY ALL)
SELECT DISTINCT b.paper_id, b.id, CASE WHEN type = 'Measure' AND coalesce(trim(u->>'unit'), '') = '' THEN 'unitless' ELSE u->>'unit' END AS unit,
coalesce(array_to_string(coalesce(p, CASE WHEN type = 'Measure' THEN m ELSE mp END, sp, p0), ','), '') AS markers FROM b LEFT JOIN sib ON sib.paper_id = b.paper_id AND sib.i = b.i
LEFT JOIN mo ON mo.paper_id = b.paper_id AND mo.i = b.i AND mo.f = b.id WHERE type IN ('Measure', 'Finding')""",
    "r17_local_anchors": f"""WITH {PAY}, f AS (SELECT paper_id, i, arg_min(id, (NOT coalesce(type = CASE section WHEN 'problem' THEN 'Problem' WHEN 'method' THEN 'Contribution' WHEN 'evidence' THEN 'Measure' END, false), o)) AS id FROM pu WHERE type <> 'Document' AND id IS NOT NULL GROUP BY ALL)
SELECT DISTINCT * FROM (SELECT ps.paper_id, section, CASE WHEN EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = ps.paper_id AND pu.i = ps.i AND pu.id = ps.anchor_id AND type <> 'Document') THEN anchor_id ELSE coalesce(f.id, anchor_id) END AS anchor_id
FROM ps LEFT JOIN f ON f.paper_id = ps.paper_id AND f.i = ps.i) WHERE anchor_id IS NOT NULL""",
    "r18_local_refs": f"""WITH {PAY} SELECT DISTINCT paper_id, measure_id, row_no,
CASE WHEN EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = pc.paper_id AND pu.id = x->>'system_id' AND pu.type IN ('Contribution', 'Component')) THEN x->>'system_id' ELSE '' END AS system_id,
CASE WHEN EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = pc.paper_id AND pu.id = x->>'opponent_id' AND pu.type IN ('Contribution', 'Component')) THEN x->>'opponent_id' ELSE '' END AS opponent_id,
CASE WHEN EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = pc.paper_id AND pu.i = pc.i AND pu.id = x->>'setup_id' AND {_HOST.replace('type', 'pu.type').replace('kind', 'pu.kind')}) THEN x->>'setup_id' ELSE '' END AS setup_id,
CASE WHEN EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = pc.paper_id AND pu.id = x->>'judge_id' AND pu.type IN ('Contribution', 'Component', 'ExperimentSetup')) THEN x->>'judge_id' ELSE '' END AS judge_id
FROM pc WHERE type = 'Measure'""",
    "r18_setup_lists": f"""WITH {PAY}, l AS (SELECT paper_id, i, o, id, unnest(list_transform(CAST(u->'setup_ids' AS JSON[]), lambda e: e->>'$')) AS v, generate_subscripts(CAST(u->'setup_ids' AS JSON[]), 1) AS n FROM pu WHERE type = 'Measure' AND json_type(u->'setup_ids') = 'ARRAY'),
k AS (SELECT paper_id, o, string_agg(v, ',' ORDER BY n) AS setups FROM l WHERE EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = l.paper_id AND pu.i = l.i AND pu.id = l.v AND {_HOST.replace('type', 'pu.type').replace('kind', 'pu.kind')}) GROUP BY ALL)
SELECT DISTINCT pu.paper_id, pu.id, coalesce(k.setups, '') AS setups FROM pu LEFT JOIN k ON k.paper_id = pu.paper_id AND k.o = pu.o WHERE type = 'Measure' AND json_type(u->'setup_ids') = 'ARRAY'""",
    "r20_formulas": f"""WITH {PAY}, f AS (SELECT paper_id, o, id, x->>'expression' AS e, n FROM (SELECT paper_id, o, id, unnest({_JL(_JD("u->'formulas'"))}) AS x, generate_subscripts({_JL(_JD("u->'formulas'"))}, 1) AS n FROM pu WHERE json_type({_JD("u->'formulas'")}) IN ('ARRAY', 'OBJECT'))),
k AS (SELECT paper_id, o, id, arg_min(e, n) AS e, min(n) AS n FROM f WHERE regexp_replace(coalesce(e, ''), '\\s+', '', 'g') <> '' GROUP BY paper_id, o, id, regexp_replace(e, '\\s+', '', 'g'))
SELECT DISTINCT paper_id, id, CAST(n AS INTEGER) AS n, expressions FROM (SELECT paper_id, o, id, count(*) AS n, string_agg(e, ' ; ' ORDER BY n) AS expressions FROM k GROUP BY ALL)""",
    "r25_payload": f"WITH {PAY} SELECT DISTINCT paper_id, id, {_NSC} > 0 OR coalesce(trim(u->>'headline_result'), '') <> '' AS has_quantitative_payload FROM pu WHERE type = 'Measure'",
    "c6_node_ids": f"SELECT DISTINCT paper_id, {canon_sql('unit_id')} AS id FROM graph_units WHERE op <> 'delete' AND type <> 'Finding' AND unit_id IS NOT NULL",
}

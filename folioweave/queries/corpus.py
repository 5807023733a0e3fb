"""Queries of the corpus tables, the questions, citations, telemetry and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions.scalar import RATES_PER_MILLION, normalize_name
from folioweave.operators import citations as M
from folioweave.plans import ask, corpus, sample, telemetry
from folioweave.plans import views as V
from folioweave.queries.assembly import _E, _N, _S, _U, _with
from folioweave.queries.scalars import VALUE_NUM_SQL, norm_sql
from folioweave.session import table

C = F.col
ROLES = ("builds_on", "uses", "compares_to", "background")
QUESTIONS = [
    {"id": "q01", "task": "leaderboard", "dataset": "luxombovi", "metric": "acc", "direction": "max"},
    {"id": "q02", "task": "sweep", "keywords": ["robot grasping", "Code-Repair"]},
    {"id": "q03", "task": "facet", "venue": "trail", "year_min": 2015, "year_max": 2024},
    {"id": "q04", "task": "facet", "has_code": True},
    {"id": "q05", "task": "lookup", "paper_substr": "learning"},
    {"id": "q06", "task": "join", "entity_substr": "Graph Routing", "min_papers": 2},
    {"id": "q07", "task": "compare", "min_pairs": 3},
]


def papers(s, d):
    """One row per paper_id of the catalog, the last export."""
    p = table(s, d, "paper_catalog")
    rest = [c for c in p.columns if c not in ("paper_id",)]
    return p.groupBy("paper_id").agg(F.max_by(F.struct(*rest), F.struct("exported_at", "cat_no")).alias("p")).select("paper_id", "p.*")


def refs(s, d):
    r = table(s, d, "cited_refs")
    rest = [c for c in r.columns if c not in ("ref_no", "loaded_at")]
    return r.groupBy("ref_no").agg(F.min_by(F.struct(*rest), "loaded_at").alias("r")).select("ref_no", "r.*")


def rows(s, d):
    r = table(s, d, "result_rows")
    rest = [c for c in r.columns if c not in ("row_no", "loaded_at")]
    return r.groupBy("row_no").agg(F.min_by(F.struct(*rest), "loaded_at").alias("r")).select("row_no", "r.*")


def _entity_rows(s, d):
    return refs(s, d).select("paper_id", "ref_id", "title", "year", "venue", C("ref_no").alias("ord"))


def entities(s, d):
    return corpus.entities(_entity_rows(s, d))


def cards(s, d):
    return corpus.cards(V.units(s, d), V.nodes(s, d), papers(s, d))


def catalog(s, d):
    p = papers(s, d).select("paper_id", "title", "venue", "year", "has_code", "central_contribution", "headline_result")
    return corpus.catalog(p, V.units(s, d), V.edges(s, d))


def citation_rows(s, d):
    return refs(s, d).select("paper_id", "cite_key", F.explode("roles").alias("role"), C("stance").alias("signal"), C("ref_no").alias("ord"))


def ref_meta(s, d):
    return refs(s, d).select("paper_id", "cite_key", "title", "authors", "venue", "year", C("ref_no").alias("ord"))


def works(s, d):
    return M.merged_citations(citation_rows(s, d), ROLES)


def linked(s, d):
    r = refs(s, d).select("paper_id", "ref_no", "cite_key", "title")
    return M.link_units(r.select("paper_id", C("ref_no").alias("ref_id"), "cite_key", "title"), V.units(s, d))


def g6(s, d):
    r = refs(s, d).select("paper_id", C("ref_no").alias("ref_id"), "roles")
    return M.reference_edges(r, linked(s, d), V.units(s, d), V.edges(s, d))


def m2(s, d):
    p = papers(s, d)
    res = F.transform("resource_urls", lambda u: F.struct(F.lit("page").alias("type"), u.alias("url")))
    return M.enrich_metadata(p.select("paper_id", "venue", "year", res.alias("resources")), "unknown venue")


def usage(s, d):
    e = table(s, d, "events")
    fl = lambda k: F.floor(C("value") * k).cast("bigint")
    return e.select(C("user_id").cast("string").alias("paper_id"), C("event_type").alias("stage"), fl(100).alias("prompt"), fl(30).alias("cached"), fl(10).alias("completion"), (C("value") > 60).alias("truncated"))


def q8(s, d):
    return ask.answers(QUESTIONS, catalog(s, d), cards(s, d), rows(s, d), entities(s, d))


def a5(s, d):
    """A5: transcribed values of a Measure that the lifted cells of the same paper and table hold."""
    r = rows(s, d).where("value_num is not null")
    face = r.where("source = 'table_blob'").select("paper_id", "value_num").dropDuplicates().withColumn("located", F.lit(1))
    t = r.where("source = 'transcribed'").select("paper_id", "measure_id", "value_num").join(face, ["paper_id", "value_num"], "left")
    return t.groupBy("paper_id", "measure_id").agg(F.count(F.lit(1)).alias("n_values"), F.count("located").alias("n_located"))


def a5_recall(s, d):
    """A5 backwards: distinct decimal cells of a paper and how many of them were transcribed."""
    r = rows(s, d).where("value_num is not null")
    cells = r.where("source = 'table_blob' and value_num <> floor(value_num)").select("paper_id", "value_num").dropDuplicates()
    said = r.where("source = 'transcribed'").select("paper_id", "value_num").dropDuplicates().withColumn("said", F.lit(1))
    return cells.join(said, ["paper_id", "value_num"], "left").groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_cells"), F.count("said").alias("n_transcribed"))


def x1(s, d):
    docs = table(s, d, "documents").join(papers(s, d).select("paper_id", "title"), "paper_id")
    return docs.where("text is not null").select("doc_id", F.round(sample.faithfulness(C("title"), C("text")), 6).alias("score"), sample.coherent(C("text")).alias("coherent"))


def x4(s, d):
    p = papers(s, d).where("venue is not null").select("paper_id", "venue", "year")
    return sample.sample_report(sample.stratified(p, 10, 3, 2020))


def x5(s, d):
    before = V.nodes(s, d).groupBy("paper_id").agg(F.count(F.lit(1)).alias("n"))
    after = V.units(s, d).groupBy("paper_id").agg(F.count(F.lit(1)).alias("n"))
    return sample.run_difference(before, after, ["paper_id"], ["n"])


def a17(s, d):
    r = rows(s, d).select("source", C("direction"))
    return sample.tally(r, ["source", "direction"])


def x7(s, d):
    claims = refs(s, d).select("paper_id", C("ref_no").alias("idx"), C("stance").alias("attribution"))
    verdicts = refs(s, d).where("salience is not null").select("paper_id", C("ref_no").alias("idx"), F.when(C("year") < 2015, "refuted").otherwise("confirmed").alias("verdict"), C("venue").alias("corrected"))
    return sample.kept_defects(claims, verdicts).groupBy("attribution").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "k1_catalog": lambda s, d: catalog(s, d).select("paper_id", "title", "venue", "year", F.array_join("datasets", "|").alias("datasets"), F.array_join("metrics", "|").alias("metrics"), F.array_join("contribution_names", "|").alias("contributions"), "problem_description", "n_units", "n_relations"),
    "k2_cards": lambda s, d: cards(s, d).select("paper_id", "unit_id", "section", "type", "kind", "name", "text", "embed_text"),
    "k3_entities": entities,
    "k3_members": lambda s, d: corpus.members(_entity_rows(s, d)).select("canonical_key", "paper_id", "ref_id"),
    "k3_skipped": lambda s, d: corpus.skipped_references(_entity_rows(s, d)),
    "k4_result_rows": lambda s, d: corpus.result_rows(V.scores(s, d), V.units(s, d)).select(C("ord").alias("row_no"), "metric_norm", "dataset", "setup", "system", "system_role", "is_paper_contribution", "value_num"),
    "k7_versions": lambda s, d: corpus.version_census(table(s, d, "extractions").select("record_no", "ir_version").dropDuplicates()),
    "a4_type_counts": lambda s, d: corpus.type_counts(V.units(s, d)),
    "a4_relation_means": lambda s, d: corpus.relation_means(V.edges(s, d), papers(s, d)),
    "a5_fidelity": a5,
    "a5_recall": a5_recall,
    "q1_facet": lambda s, d: ask.facet(papers(s, d), "trail", 2015, 2024).select("paper_id", "title", "year"),
    "q1_has_code": lambda s, d: ask.facet(papers(s, d), has_code=True).select("paper_id"),
    "q2_lookup": lambda s, d: ask.lookup(papers(s, d), "learning").select("paper_id", F.left("central_contribution", F.lit(120)).alias("central_contribution")),
    "q3_sweep": lambda s, d: ask.sweep(cards(s, d), catalog(s, d), ["robot grasping", "Code-Repair"]),
    "q4_leaderboard": lambda s, d: ask.leaderboard(rows(s, d), "luxombovi", "acc"),
    "q4_leaderboards": lambda s, d: ask.leaderboards(rows(s, d)),
    "q5_compare": lambda s, d: ask.compare(rows(s, d), None),
    "q5_compare_top": lambda s, d: ask.compare(rows(s, d), 5),
    "q6_cited": lambda s, d: ask.cited(entities(s, d), "Graph Routing", 2).select("canonical_key", "title", "n_papers"),
    "q7_answers": q8,
    "q7_by_task": lambda s, d: ask.by_task(q8(s, d)),
    "a2_citations": lambda s, d: works(s, d).select("paper_id", "work", "cite_key", F.array_join("roles", "|").alias("roles"), F.array_join(F.transform("roles", lambda r: F.element_at("signals", r)), "|").alias("signals")),
    "a3_cite_keys": lambda s, d: M.cite_keys(citation_rows(s, d)),
    "j3_join_metadata": lambda s, d: M.join_metadata(works(s, d), ref_meta(s, d)).select("paper_id", "work", "title", "venue", "year"),
    "j4_link_units": linked,
    "j5_unit_references": lambda s, d: M.unit_references(linked(s, d)).select("paper_id", "unit_id", F.array_join("ref_ids", ",").alias("ref_ids")),
    "g6_reference_edges": g6,
    "m2_metadata": lambda s, d: m2(s, d).select("paper_id", "venue", "year", "venue_source", "year_source", "has_code", "has_data"),
    "a7_stage_totals": lambda s, d: telemetry.stage_totals(usage(s, d)),
    "a8_cost_report": lambda s, d: telemetry.cost_report(usage(s, d)),
    "a9_cache": lambda s, d: telemetry.cache_diagnosis(usage(s, d), ("click", "view", "purchase")),
    "a9_cache_summary": lambda s, d: telemetry.cache_summary(telemetry.cache_diagnosis(usage(s, d), ("click", "view", "purchase"))),
    "a10_paper_usage": lambda s, d: telemetry.paper_usage(usage(s, d)),
    "a15_run_totals": lambda s, d: telemetry.run_totals(usage(s, d)),
    "a17_cube": a17,
    "x1_faithfulness": x1,
    "x4_stratified": x4,
    "x5_difference": x5,
    "x7_defects": x7,
}

_P = "p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY exported_at DESC, cat_no DESC) AS rn FROM paper_catalog) WHERE rn = 1)"
_R = "r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ref_no ORDER BY loaded_at) AS rn FROM cited_refs) WHERE rn = 1)"
_W = "w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY loaded_at) AS rn FROM result_rows) WHERE rn = 1)"
_ENT = f"""ent AS (SELECT {norm_sql('title')} AS canonical_key, arg_min(title, ref_no) AS title, CAST(arg_min_null(year, ref_no) AS INTEGER) AS year, arg_min_null(venue, ref_no) AS venue,
  count(*) AS n_references, count(DISTINCT paper_id) AS n_papers, count(DISTINCT title) AS n_titles FROM r WHERE {norm_sql('title')} <> '' GROUP BY 1)"""
_NAMES = lambda cond, a: f"(SELECT paper_id, string_agg(name, '|' ORDER BY o) AS {a} FROM (SELECT paper_id, name, min((changed_at, id)) AS o FROM u WHERE {cond} AND name <> '' GROUP BY ALL) GROUP BY ALL)"
_CARD = """card AS (SELECT paper_id, unit_id, section, type, kind, name, text, coalesce(nullif(title, ''), paper_id) || ' | ' || CASE WHEN kind <> '' THEN type || '/' || kind ELSE type END || ': ' || name
  || CASE WHEN text <> '' THEN ' — ' || text ELSE '' END AS embed_text FROM (
  SELECT u.paper_id, u.id AS unit_id, u.section, u.type, coalesce(nullif(u.kind, ''), n.kind) AS kind, coalesce(nullif(u.name, ''), nullif(n.name, ''), u.id) AS name, p.title,
   CASE WHEN u.type = 'Finding' THEN coalesce(u.description, '') ELSE coalesce(nullif(u.description, ''), nullif(n.description, ''), '') END AS text
  FROM u LEFT JOIN n ON n.paper_id = u.paper_id AND n.id = u.id LEFT JOIN p ON p.paper_id = u.paper_id))"""
_CIT = f"""c AS (SELECT paper_id, trim(coalesce(cite_key, '')) AS key, role, stance AS signal, ref_no FROM (SELECT paper_id, cite_key, stance, ref_no, unnest(roles) AS role FROM r) WHERE role IN {ROLES}),
pr AS (SELECT paper_id, CASE WHEN key <> '' THEN 'key:' || key ELSE 'row:' || ref_no END AS work, key AS cite_key, role, min(ref_no) AS f, coalesce(arg_max(signal, ref_no) FILTER (WHERE trim(signal) <> ''), '') AS sg FROM c GROUP BY ALL)"""
_CN = """CASE WHEN regexp_full_match(s, '\\[?\\s*[0-9]+\\s*\\]?') THEN b WHEN regexp_matches(s, '(1[89][0-9][0-9]|20[0-9][0-9])([a-z])?') AND length(au) > 0
 THEN au || regexp_extract(s, '(1[89][0-9][0-9]|20[0-9][0-9])([a-z])?', 1) || regexp_extract(s, '(1[89][0-9][0-9]|20[0-9][0-9])([a-z])?', 2) ELSE b END"""
_CITE = lambda x: _CN.replace("s,", f"trim({x}),").replace(" b ", f" lower(regexp_replace({x}, '[\\[\\]\\s]+', '', 'g')) ").replace("ELSE b END", f"ELSE lower(regexp_replace({x}, '[\\[\\]\\s]+', '', 'g')) END").replace(
    "au", f"regexp_replace(lower(list_filter(regexp_extract_all(regexp_extract(trim({x}), '(?s)^(.*?)(1[89][0-9][0-9]|20[0-9][0-9])([a-z])?', 1), '[A-Za-z][A-Za-z\\-]*'), lambda z: lower(z) NOT IN ('et', 'al', 'and', 'the'))[1]), '[^a-z0-9]', '', 'g')"
)
_US = "us AS (SELECT CAST(user_id AS VARCHAR) AS paper_id, event_type AS stage, CAST(floor(value * 100) AS BIGINT) AS prompt, CAST(floor(value * 30) AS BIGINT) AS cached, CAST(floor(value * 10) AS BIGINT) AS completion, value > 60 AS truncated FROM events)"
_CD = """cd AS (SELECT paper_id, count(*) AS n_stages, count(DISTINCT cached) = 1 AS same_prefix, min(cached) AS prefix, CAST(sum(unc) FILTER (WHERE rn > 1) AS BIGINT) AS redundant,
  CAST(sum(greatest(0, unc - spread)) FILTER (WHERE rn > 1) AS BIGINT) AS saving FROM (SELECT *, max(unc) OVER (PARTITION BY paper_id) - min(unc) OVER (PARTITION BY paper_id) AS spread,
  row_number() OVER (PARTITION BY paper_id ORDER BY completion DESC, stage) AS rn FROM (SELECT paper_id, stage, CAST(sum(cached) AS BIGINT) AS cached, CAST(sum(completion) AS BIGINT) AS completion, CAST(sum(prompt) - sum(cached) AS BIGINT) AS unc
  FROM us WHERE stage IN ('click', 'view', 'purchase') GROUP BY ALL)) GROUP BY ALL HAVING count(*) >= 2)"""

ORACLE = {
    "k1_catalog": _with(_P, _U, _E, body=f"""SELECT p.paper_id, p.title, p.venue, CAST(p.year AS INTEGER) AS year, coalesce(a.datasets, '') AS datasets, coalesce(b.metrics, '') AS metrics, coalesce(contributions, '') AS contributions, pd AS problem_description, coalesce(nu, 0) AS n_units, coalesce(ne, 0) AS n_relations
FROM p LEFT JOIN {_NAMES("type = 'ExperimentSetup' AND kind IN ('dataset', 'benchmark')", 'datasets')} a USING (paper_id) LEFT JOIN {_NAMES("type = 'Measure'", 'metrics')} b USING (paper_id) LEFT JOIN {_NAMES("type = 'Contribution'", 'contributions')} USING (paper_id)
LEFT JOIN (SELECT paper_id, arg_min_null(description, (changed_at, id)) AS pd FROM u WHERE type = 'Problem' GROUP BY ALL) USING (paper_id)
LEFT JOIN (SELECT paper_id, count(*) AS nu FROM u GROUP BY ALL) USING (paper_id) LEFT JOIN (SELECT paper_id, count(*) AS ne FROM e GROUP BY ALL) USING (paper_id)"""),
    "k2_cards": _with(_P, _U, _N, _CARD, body="SELECT * FROM card"),
    "k3_entities": _with(_R, _ENT, body="SELECT * FROM ent"),
    "k3_members": _with(_R, body=f"SELECT {norm_sql('title')} AS canonical_key, paper_id, ref_id FROM r WHERE {norm_sql('title')} <> ''"),
    "k3_skipped": _with(_R, body=f"SELECT count(*) FILTER (WHERE {norm_sql('title')} = '') AS n_skipped, count(*) AS n FROM r"),
    "k4_result_rows": _with(_U, _S, body=f"""SELECT s.row_no, {norm_sql('q.metric')} AS metric_norm, CASE WHEN b.kind IN ('dataset', 'benchmark') THEN b.name END AS dataset, b.name AS setup, coalesce(nullif(a.name, ''), s.variant) AS system,
a.type AS system_role, coalesce(a.type = 'Contribution', false) AS is_paper_contribution, v.parsed AS value_num FROM s JOIN (SELECT DISTINCT row_no, metric FROM result_rows) q ON q.row_no = s.row_no
JOIN (SELECT row_no, {VALUE_NUM_SQL} AS parsed FROM (SELECT DISTINCT row_no, ltrim(replace(replace(trim(value_raw), '−', '-'), '–', '-'), '≈~<>≤≥±$ ' || chr(9)) AS t FROM result_rows)) v ON v.row_no = s.row_no
LEFT JOIN u a ON a.paper_id = s.paper_id AND a.id = s.system_id LEFT JOIN u b ON b.paper_id = s.paper_id AND b.id = s.setup_id"""),
    "k7_versions": """WITH g AS (SELECT coalesce(ir_version, 'unknown') AS version, count(*) AS n FROM (SELECT DISTINCT record_no, ir_version FROM extractions) GROUP BY ALL)
SELECT version, n, CASE WHEN (SELECT count(*) FROM g) > 1 THEN 'mixed' WHEN version = 'unknown' THEN 'unknown' ELSE 'uniform' END AS state FROM g""",
    "a4_type_counts": _with(_U, body="""SELECT paper_id, count(*) FILTER (WHERE type = 'Component') AS "Component", count(*) FILTER (WHERE type = 'Contribution') AS "Contribution", count(*) FILTER (WHERE type = 'ExperimentSetup') AS "ExperimentSetup",
count(*) FILTER (WHERE type = 'Finding') AS "Finding", count(*) FILTER (WHERE type = 'Measure') AS "Measure", count(*) FILTER (WHERE type = 'Problem') AS "Problem" FROM u GROUP BY ALL"""),
    "a4_relation_means": _with(_P, _E, body="SELECT relation, count(*) AS n_edges, count(*) / (SELECT count(*) FROM p) AS per_paper FROM e GROUP BY ALL"),
    "a5_fidelity": _with(_W, body="""SELECT paper_id, measure_id, count(*) AS n_values, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM w f WHERE f.source = 'table_blob' AND f.paper_id = w.paper_id AND f.value_num = w.value_num)) AS n_located
FROM w WHERE value_num IS NOT NULL AND source = 'transcribed' GROUP BY ALL"""),
    "a5_recall": _with(_W, body="""SELECT paper_id, count(*) AS n_cells, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM w t WHERE t.source = 'transcribed' AND t.paper_id = x.paper_id AND t.value_num = x.value_num)) AS n_transcribed
FROM (SELECT DISTINCT paper_id, value_num FROM w WHERE source = 'table_blob' AND value_num <> floor(value_num)) x GROUP BY ALL"""),
    "q1_facet": _with(_P, body=f"SELECT paper_id, title, CAST(year AS INTEGER) AS year FROM p WHERE {norm_sql('venue')} = 'trail' AND year BETWEEN 2015 AND 2024"),
    "q1_has_code": _with(_P, body="SELECT paper_id FROM p WHERE has_code"),
    "q2_lookup": _with(_P, body=f"SELECT paper_id, left(central_contribution, 120) AS central_contribution FROM p WHERE (strpos({norm_sql('title')}, 'learning') > 0 OR strpos({norm_sql('paper_id')}, 'learning') > 0) AND central_contribution <> ''"),
    "q3_sweep": _with(_P, _U, _N, _CARD, body=f"""SELECT paper_id, CAST(sum(k) AS BIGINT) AS n_cards FROM (SELECT paper_id, 1 AS k FROM card WHERE regexp_matches({norm_sql('embed_text')}, 'robot grasping|code repair')
UNION ALL SELECT p.paper_id, 0 FROM p LEFT JOIN (SELECT paper_id, arg_min_null(description, (changed_at, id)) AS pd FROM u WHERE type = 'Problem' GROUP BY ALL) x ON x.paper_id = p.paper_id
WHERE regexp_matches({norm_sql("coalesce(title, '') || ' ' || coalesce(pd, '') || ' ' || coalesce(central_contribution, '')")}, 'robot grasping|code repair')) GROUP BY ALL"""),
    "q4_leaderboard": _with(_W, body=f"""SELECT count(*) AS n_hits, count(DISTINCT nullif(system, '')) AS n_systems, count(DISTINCT paper_id) AS n_papers, arg_min(system, (-value_num, row_no)) AS system, arg_min(value_raw, (-value_num, row_no)) AS value_raw, arg_min(paper_id, (-value_num, row_no)) AS paper_id
FROM w WHERE value_num IS NOT NULL AND (strpos({norm_sql('dataset')}, 'luxombovi') > 0 OR source = 'table_blob' AND (strpos({norm_sql('table_caption')}, 'luxombovi') > 0 OR strpos({norm_sql('metric')}, 'luxombovi') > 0))
AND (strpos({norm_sql('metric')}, 'acc') > 0 OR strpos({norm_sql('unit')}, 'acc') > 0)"""),
    "q4_leaderboards": _with(_W, body="""SELECT dataset_norm, metric_norm, count(*) AS n_rows, count(DISTINCT system) AS n_systems, count(DISTINCT paper_id) AS n_papers, arg_min_null(system, k) AS best_system, arg_min_null(value_raw, k) AS best_value, arg_min_null(paper_id, k) AS best_paper
FROM (SELECT *, (CASE WHEN direction = 'lower_is_better' THEN value_num ELSE -value_num END, row_no) AS k FROM w WHERE value_num IS NOT NULL AND dataset_norm <> '' AND metric_norm <> '') GROUP BY ALL"""),
    "q5_compare": _with(_W, body="SELECT dataset_norm, metric_norm, count(DISTINCT paper_id) AS n_papers FROM w WHERE value_num IS NOT NULL AND source = 'transcribed' AND dataset_norm <> '' AND metric_norm <> '' GROUP BY ALL HAVING count(DISTINCT paper_id) > 1"),
    "q5_compare_top": _with(_W, body="SELECT dataset_norm, metric_norm, count(DISTINCT paper_id) AS n_papers FROM w WHERE value_num IS NOT NULL AND source = 'transcribed' AND dataset_norm <> '' AND metric_norm <> '' GROUP BY ALL HAVING count(DISTINCT paper_id) > 1 ORDER BY n_papers DESC, dataset_norm, metric_norm LIMIT 5"),
    "q6_cited": _with(_R, _ENT, body="SELECT canonical_key, title, n_papers FROM ent WHERE strpos(canonical_key, 'graph routing') > 0 AND n_papers >= 2"),
    "a2_citations": _with(_R, _CIT, body="SELECT paper_id, work, cite_key, string_agg(role, '|' ORDER BY f, role, sg) AS roles, string_agg(sg, '|' ORDER BY f, role, sg) AS signals FROM pr GROUP BY ALL"),
    "a3_cite_keys": _with(_R, _CIT, body="SELECT paper_id, cite_key, min(ref_no) AS first FROM (SELECT paper_id, trim(cite_key) AS cite_key, ref_no, unnest(roles) FROM r) WHERE cite_key <> '' GROUP BY ALL"),
    "j3_join_metadata": _with(_R, _CIT, body=f"""SELECT k.paper_id, work, coalesce(x.title, y.title) AS title, CASE WHEN x.paper_id IS NOT NULL THEN x.venue ELSE y.venue END AS venue, CAST(CASE WHEN x.paper_id IS NOT NULL THEN x.year ELSE y.year END AS INTEGER) AS year
FROM (SELECT DISTINCT paper_id, work, cite_key FROM pr) k LEFT JOIN (SELECT paper_id, trim(cite_key) AS ck, arg_min_null(title, ref_no) AS title, arg_min_null(venue, ref_no) AS venue, arg_min_null(year, ref_no) AS year FROM r WHERE trim(cite_key) <> '' GROUP BY ALL) x ON x.paper_id = k.paper_id AND x.ck = k.cite_key
LEFT JOIN (SELECT paper_id, {_CITE('cite_key')} AS cn, arg_min_null(title, ref_no) AS title, arg_min_null(venue, ref_no) AS venue, arg_min_null(year, ref_no) AS year FROM r WHERE trim(cite_key) <> '' GROUP BY ALL) y ON x.paper_id IS NULL AND y.paper_id = k.paper_id AND k.cite_key <> '' AND y.cn = {_CITE('k.cite_key')}"""),
    "m2_metadata": _with(_P, body="""SELECT paper_id, coalesce(nullif(venue, ''), dv, 'unknown venue') AS venue, CAST(coalesce(year, dy) AS INTEGER) AS year, CASE WHEN coalesce(venue, '') = '' THEN CASE WHEN dv IS NOT NULL THEN 'dirname' ELSE 'corpus_default' END END AS venue_source,
CASE WHEN year IS NULL AND dy IS NOT NULL THEN 'dirname' END AS year_source, CASE WHEN len(list_filter(hs, lambda h: regexp_matches(h, '(^|\\.)(github\\.com|gitlab\\.com|bitbucket\\.org|4open\\.science|codeberg\\.org)$'))) > 0 THEN true END AS has_code,
CASE WHEN len(list_filter(hs, lambda h: regexp_matches(h, '(^|\\.)(zenodo\\.org|figshare\\.com|kaggle\\.com)$'))) > 0 THEN true END AS has_data FROM (
SELECT *, nullif(regexp_extract(paper_id, '^(?:[0-9]+_)?(?:([A-Za-z][A-Za-z0-9-]*)_)?((?:19|20)[0-9]{2})(?:[_-]|$)', 1), '') AS dv, try_cast(nullif(regexp_extract(paper_id, '^(?:[0-9]+_)?(?:([A-Za-z][A-Za-z0-9-]*)_)?((?:19|20)[0-9]{2})(?:[_-]|$)', 2), '') AS INTEGER) AS dy,
list_transform(resource_urls, lambda x: regexp_replace(lower(regexp_extract(CASE WHEN strpos(x, '://') > 0 THEN trim(x) ELSE 'https://' || trim(x) END, '^[^:/?#]+://([^/?#]*)', 1)), '^www\\.', '')) AS hs FROM p)"""),
    "a7_stage_totals": _with(_US, body="SELECT stage, count(*) AS calls, CAST(sum(prompt) AS BIGINT) AS prompt, CAST(sum(cached) AS BIGINT) AS cached, CAST(sum(completion) AS BIGINT) AS completion FROM us GROUP BY ALL"),
    "a8_cost_report": _with(_US, body=f"""SELECT *, effective / max(CASE WHEN stage = 'TOTAL' THEN effective END) OVER () AS share FROM (SELECT coalesce(stage, 'TOTAL') AS stage, count(*) AS calls, CAST(sum(prompt) - sum(cached) AS BIGINT) AS uncached,
CAST(sum(prompt) - sum(cached) + 4 * sum(completion) AS BIGINT) AS effective, sum(cached) / sum(prompt) AS hit_rate,
CAST(((CAST(sum(prompt) AS BIGINT) - CAST(sum(cached) AS BIGINT)) * CAST({RATES_PER_MILLION['uncached']} AS DOUBLE) + CAST(sum(cached) AS BIGINT) * CAST({RATES_PER_MILLION['cached']} AS DOUBLE) + CAST(sum(completion) AS BIGINT) * CAST({RATES_PER_MILLION['completion']} AS DOUBLE)) / 1e6 AS DOUBLE) AS usd
FROM us GROUP BY ROLLUP (stage))"""),
    "a9_cache": _with(_US, _CD, body="SELECT * FROM cd"),
    "a9_cache_summary": _with(_US, _CD, body="SELECT count(*) AS n_papers, count(*) FILTER (WHERE same_prefix) AS n_same, quantile_disc(prefix, 0.5 ORDER BY prefix DESC) AS median_prefix, CAST(sum(redundant) AS BIGINT) AS redundant, CAST(sum(saving) AS BIGINT) AS saving FROM cd"),
    "a10_paper_usage": _with(_US, body="SELECT paper_id, CAST(sum(prompt + completion) AS BIGINT) AS tokens, bool_or(truncated) AS truncated FROM us GROUP BY ALL"),
    "a15_run_totals": _with(_US, body="SELECT CAST(sum(tokens) AS BIGINT) AS tokens, count(*) FILTER (WHERE truncated) AS n_truncated, count(*) AS n_papers FROM (SELECT paper_id, sum(prompt + completion) AS tokens, bool_or(truncated) AS truncated FROM us GROUP BY ALL)"),
    "a17_cube": _with(_W, body="SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE coalesce(source, 'none') END AS source, CASE WHEN grouping(direction) = 1 THEN 'all' ELSE coalesce(direction, 'none') END AS direction, count(*) AS n FROM w GROUP BY CUBE (source, direction)"),
    "x5_difference": _with(_U, _N, body="SELECT a.paper_id, a.n - b.n AS d_n FROM (SELECT paper_id, count(*) AS n FROM u GROUP BY ALL) a JOIN (SELECT paper_id, count(*) AS n FROM n GROUP BY ALL) b ON a.paper_id = b.paper_id"),
    "x7_defects": _with(_R, body="SELECT CASE WHEN salience IS NOT NULL THEN coalesce(nullif(venue, ''), stance) ELSE stance END AS attribution, count(*) AS n FROM r WHERE NOT (salience IS NOT NULL AND coalesce(year < 2015, false)) GROUP BY ALL"),
}

_LINK = f"""uk AS (SELECT DISTINCT paper_id, id, {_CITE('k')} AS norm FROM (SELECT u.paper_id, u.id, unnest(x.cite_keys) AS k FROM u JOIN chg x ON x.paper_id = u.paper_id AND x.id = u.id AND x.changed_at = u.changed_at AND x.op <> 'delete') WHERE {_CITE('k')} <> ''),
un AS (SELECT paper_id, {norm_sql('name')} AS nm, min(id) AS id FROM u WHERE {norm_sql('name')} <> '' GROUP BY ALL HAVING count(DISTINCT id) = 1),
lk AS (SELECT DISTINCT r.paper_id, r.ref_no AS ref_id, uk.id AS unit_id FROM r JOIN uk ON uk.paper_id = r.paper_id AND uk.norm = {_CITE('r.cite_key')}),
al AS (SELECT * FROM lk UNION SELECT r.paper_id, r.ref_no, un.id FROM r JOIN un ON un.paper_id = r.paper_id AND un.nm = {norm_sql('r.title')} WHERE NOT EXISTS (SELECT 1 FROM lk WHERE lk.paper_id = r.paper_id AND lk.ref_id = r.ref_no))"""
ORACLE |= {
    "j4_link_units": _with(_U, _R, _LINK, body="SELECT paper_id, ref_id, unit_id FROM al"),
    "j5_unit_references": _with(_U, _R, _LINK, body="SELECT paper_id, unit_id, string_agg(CAST(ref_id AS VARCHAR), ',' ORDER BY ref_id) AS ref_ids FROM al GROUP BY ALL"),
}

"""Queries of the as-of join, the assembly as a whole, lifted rows, the retrofit and further reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.functions.scalar import canon_marker, numeric_values
from folioweave.operators import asof, nested
from folioweave.operators import tables as H
from folioweave.operators import text as T
from folioweave.plans import corpus, pipeline, sample
from folioweave.plans import views as V
from folioweave.queries.assembly import _E, _U, _with
from folioweave.queries.corpus import _P, _R, _W, papers, refs, rows
from folioweave.session import table

C = F.col


def j11(s, d, forward=False):
    e = table(s, d, "events")
    views = e.where("event_type = 'view'").select("user_id", "ts", C("event_id").alias("view_id"))
    return asof.asof(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, ["user_id"], "ts", "view_id", forward=forward).select("event_id", "view_id")


def k5_lifted(s, d):
    """K5 with the flag of values that a transcribed row of the same paper holds too."""
    docs = table(s, d, "documents").select("doc_id", "paper_id", "text")
    cells = H.grid_rows(T.source_tables(docs), ["doc_id", "marker"]).join(docs.select("doc_id", "paper_id"), "doc_id")
    said = rows(s, d).where("source = 'transcribed'").select("paper_id", F.explode(numeric_values(C("value_raw"))).alias("value_num")).dropDuplicates().withColumn("said", F.lit(True))
    j = cells.join(said, ["paper_id", "value_num"], "left")
    return j.groupBy("doc_id", "marker").agg(F.count(F.lit(1)).alias("n_cells"), F.count("said").alias("n_in_transcribed"))


def r30(s, d):
    """The caption of the table that a row's marker names in its paper, if any document of it holds one."""
    docs = table(s, d, "documents").select("doc_id", "paper_id", "text")
    tabs = T.source_tables(docs).where("caption <> ''").join(docs.select("doc_id", "paper_id"), "doc_id")
    one = tabs.groupBy("paper_id", "marker").agg(F.min_by("caption", "doc_id").alias("captured"))
    r = rows(s, d).select("row_no", "paper_id", canon_marker(C("table_marker")).alias("marker"))
    return r.join(one, ["paper_id", "marker"], "left").groupBy(C("captured").isNotNull().alias("has_caption")).agg(F.count(F.lit(1)).alias("n"))


def v8(s, d):
    e = table(s, d, "extractions").select("record_no", "ir_version").dropDuplicates()
    fault = F.when(C("ir_version").isNull(), "missing").when(~C("ir_version").isin(*vocab.ACCEPTED_VERSIONS), "unknown").otherwise("accepted")
    return e.groupBy(fault.alias("version_state")).agg(F.count(F.lit(1)).alias("n"))


def v9(s, d):
    marked = rows(s, d).where("table_marker is not null").select("row_no", "paper_id", C("table_marker").alias("marker"))
    known = V.paper_blocks(s, d).where("text rlike '(?i)<table'").select("paper_id", "marker").dropDuplicates()
    return marked.join(known, ["paper_id", "marker"], "left_anti").select("row_no")


def a13(s, d):
    u, e = V.units(s, d), V.edges(s, d)
    per = u.groupBy("paper_id").agg(F.count(F.lit(1)).alias("u")).join(e.groupBy("paper_id").agg(F.count(F.lit(1)).alias("e")), "paper_id", "left")
    return per.agg(F.count(F.lit(1)).alias("n_papers"), F.sum("u").alias("n_units"), F.sum("e").alias("n_edges"), F.max("u").alias("most_units"))


def a16(s, d):
    return papers(s, d).groupBy(F.coalesce("valid", F.lit(False)).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))


def a18(s, d):
    """The systems measured by every metric and the datasets it is measured on."""
    r = rows(s, d).where("metric_norm <> ''")
    return r.groupBy("metric_norm").agg(F.countDistinct("system").alias("n_systems"), F.countDistinct("dataset_norm").alias("n_datasets"), F.count(F.lit(1)).alias("n"))


def r1(s, d):
    """The units of the typed arrays and unit lists of the extractions, by section and type."""
    e = table(s, d, "extractions")
    at = ["record_key", "extraction_no", "section_no"]
    u = nested.flatten_level(e, "units").join(nested.flatten_level(e, "sections").select(*at, "section_type"), at)
    return u.groupBy(F.coalesce("section_type", F.lit("none")).alias("section_type"), "type").agg(F.count(F.lit(1)).alias("n"))


def n29(s, d):
    e = table(s, d, "extractions").dropDuplicates(["record_no"])
    return e.select("record_no", pipeline.legacy_marks(C("payload")).alias("legacy"))


def k6(s, d):
    return pipeline.gated(table(s, d, "extractions").select("record_no", "ir_version").dropDuplicates())


def k9(s, d):
    """K9: the sizes of the corpus tables."""
    n = lambda name, df: df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
    parts = [n("catalog", papers(s, d)), n("cards", V.units(s, d)), n("result_rows", rows(s, d)), n("references", refs(s, d)), n("relations", V.edges(s, d))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def x3(s, d):
    docs = table(s, d, "documents").where("text is not null").select("doc_id", "text", C("source").alias("title"))
    return sample.usable(docs, min_chars=1000, denied="review").select("doc_id")


def a1(s, d):
    names = corpus.ordered_names(V.units(s, d), C("type") == "Measure", "metrics")
    return names.select("paper_id", F.array_join("metrics", "|").alias("metrics"))


QUERIES = {
    "j11_asof": j11,
    "j11_asof_forward": lambda s, d: j11(s, d, True),
    "r1_flatten": r1,
    "r30_captions": r30,
    "k5_lifted": k5_lifted,
    "k6_gated": k6,
    "k9_counters": k9,
    "v8_versions": v8,
    "v9_markers": v9,
    "a1_names": a1,
    "a13_totals": a13,
    "a16_validity": a16,
    "a18_metric_index": a18,
    "n29_legacy": n29,
    "x3_usable": x3,
}

_ACC = "(" + ", ".join(f"'{v}'" for v in vocab.ACCEPTED_VERSIONS) + ")"
_ASOF = "SELECT p.event_id, v.view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY ALL) v ON p.user_id = v.user_id AND p.ts {} v.ts"
ORACLE = {
    "j11_asof": _ASOF.format(">="),
    "j11_asof_forward": _ASOF.format("<="),
    "k6_gated": f"SELECT DISTINCT record_no, ir_version FROM extractions WHERE ir_version IN {_ACC}",
    "k9_counters": _with(_P, _U, _E, _W, _R, body="""SELECT 'catalog' AS table_name, count(*) AS n FROM p UNION ALL SELECT 'cards', count(*) FROM u UNION ALL SELECT 'result_rows', count(*) FROM w
UNION ALL SELECT 'references', count(*) FROM r UNION ALL SELECT 'relations', count(*) FROM e"""),
    "v8_versions": f"SELECT CASE WHEN ir_version IS NULL THEN 'missing' WHEN ir_version NOT IN {_ACC} THEN 'unknown' ELSE 'accepted' END AS version_state, count(*) AS n FROM (SELECT DISTINCT record_no, ir_version FROM extractions) GROUP BY ALL",
    "a1_names": _with(_U, body="SELECT paper_id, string_agg(name, '|' ORDER BY o) AS metrics FROM (SELECT paper_id, name, min((changed_at, id)) AS o FROM u WHERE type = 'Measure' AND name <> '' GROUP BY ALL) GROUP BY ALL"),
    "a13_totals": _with(_U, _E, body="""SELECT count(*) AS n_papers, CAST(sum(x) AS BIGINT) AS n_units, CAST(sum(y) AS BIGINT) AS n_edges, max(x) AS most_units FROM (SELECT paper_id, count(*) AS x FROM u GROUP BY ALL) a
LEFT JOIN (SELECT paper_id, count(*) AS y FROM e GROUP BY ALL) b USING (paper_id)"""),
    "a16_validity": _with(_P, body="SELECT coalesce(valid, false) AS is_valid, count(*) AS n FROM p GROUP BY ALL"),
    "a18_metric_index": _with(_W, body="SELECT metric_norm, count(DISTINCT system) AS n_systems, count(DISTINCT dataset_norm) AS n_datasets, count(*) AS n FROM w WHERE metric_norm <> '' GROUP BY ALL"),
    "x3_usable": "SELECT doc_id FROM documents WHERE length(text) >= 1000 AND NOT coalesce(regexp_matches(source, 'review'), false)",
}

from folioweave.queries.texts import _BLOCKS  # noqa: E402

ORACLE |= {
    "v9_markers": _with(_W, _BLOCKS, body="""SELECT row_no FROM w WHERE table_marker IS NOT NULL AND NOT EXISTS (SELECT 1 FROM blocks k WHERE k.paper_id = w.paper_id AND k.marker = w.table_marker AND strpos(lower(b), '<table') > 0)"""),
}

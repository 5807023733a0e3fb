"""Queries of the text and table operators over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.operators import tables as H
from folioweave.operators import text as T
from folioweave.session import table

C = F.col


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "paper_id", "text")


def _md5(c):
    return F.md5(c).alias("digest")


def p1_blocks(spark, d):
    b = T.blocks(_docs(spark, d))
    return T.block_map(b).select("doc_id", "marker", _md5(C("text")), F.length("text").alias("n_chars"))


def p7_numbering(spark, d):
    """Paragraphs outside the bibliography numbered in order; P3's state is whether a reference heading came last."""
    from pyspark.sql.window import Window

    lines = _docs(spark, d).select("doc_id", F.posexplode(F.split("text", "\n\n+")).alias("ord", "piece")).where("piece rlike '[^ ]'")
    heading = C("piece").rlike(r"^#{1,6} ")
    is_ref = F.when(heading, C("piece").rlike(r"(?i)^#{1,6} *references?\b"))
    w = Window.partitionBy("doc_id").orderBy("ord")
    state = lines.withColumn("in_refs", F.coalesce(F.last(is_ref, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(False)))
    marked = state.where(~C("in_refs") & ~heading)
    return marked.select("doc_id", "ord", F.row_number().over(w).alias("marker_no"))


def _referenced(spark, d):
    rel = table(spark, d, "relations").select("paper_id", F.explode("provenance").alias("marker"))
    rows = table(spark, d, "result_rows").select("paper_id", C("table_marker").alias("marker"))
    return rel.unionByName(rows).where("marker is not null").dropDuplicates()


def p12_span_index(spark, d):
    docs = _docs(spark, d)
    wanted = docs.select("doc_id", "paper_id").join(_referenced(spark, d), "paper_id").select("doc_id", "marker")
    return T.span_index(T.blocks(docs), wanted).select("doc_id", "marker", _md5(C("text")), "truncated")


def p13_bibliography(spark, d):
    b = _docs(spark, d).select("doc_id", T.bibliography(C("text")).alias("b")).where("b is not null")
    return b.select("doc_id", F.length("b.before").alias("starts_at"), C("b.score").alias("score"), F.length("b.span").alias("n_chars"))


def p14_references(spark, d):
    return _docs(spark, d).select("doc_id", F.length(T.references_blob(C("text"))).alias("n_blob"))


def p15_body(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.body_slice(C("text"))).alias("digest"))


def p16_tables(spark, d):
    return T.source_tables(_docs(spark, d)).select("doc_id", "marker", "caption", "n_tables", F.length("html").alias("n_html"))


def p17_warnings(spark, d):
    w = _docs(spark, d).select("doc_id", F.explode(T.capture_warnings(C("text"))).alias("warning"))
    return w


def p18_table_index(spark, d):
    t = T.source_tables(_docs(spark, d))
    return T.table_index(t, t.select("doc_id", "marker", H.cells_udf("html").alias("cells")))


def p19_slice(spark, d):
    return T.metadata_slice(_docs(spark, d)).select("doc_id", F.length("slice").alias("n_slice"))


def p19_url_lines(spark, d):
    return T.url_lines(_docs(spark, d)).select("doc_id", "line_no", _md5(C("line")))


def p20_headings(spark, d):
    return T.heading_map(_docs(spark, d))


def p21_title(spark, d):
    title = T.document_title(C("text"))
    return _docs(spark, d).where("text is not null").select("doc_id", F.md5(title).alias("digest"), T.document_slug(title).alias("slug"))


def n21_cells(spark, d):
    t = T.source_tables(_docs(spark, d))
    cells = t.select("doc_id", F.explode(H.cells_udf("html")).alias("cell"))
    return cells.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_cells"), F.countDistinct("cell").alias("n_distinct"))


def k5_grid_rows(spark, d):
    t = T.source_tables(_docs(spark, d))
    return H.grid_rows(t, ["doc_id", "marker", "caption"]).select("doc_id", "marker", "grid", "row", "col", "system", "metric", "value_raw", "value_num")


def h1_safe(spark, d):
    t = T.source_tables(_docs(spark, d))
    return t.select("doc_id", "marker", H.is_safe_udf("html").alias("safe"))


QUERIES = {
    "block_p1_blocks": p1_blocks,
    "block_p7_numbering": p7_numbering,
    "block_p12_span_index": p12_span_index,
    "block_p13_bibliography": p13_bibliography,
    "block_p14_references": p14_references,
    "block_p15_body": p15_body,
    "block_p16_tables": p16_tables,
    "block_p17_warnings": p17_warnings,
    "block_p18_table_index": p18_table_index,
    "block_p19_slice": p19_slice,
    "block_p19_url_lines": p19_url_lines,
    "block_p20_headings": p20_headings,
    "block_p21_title": p21_title,
    "n21_cells": n21_cells,
    "k5_grid_rows": k5_grid_rows,
    "h1_safe": h1_safe,
}

_PARTS = "string_split(regexp_replace(text, '(?m)^(\\[§[0-9]+\\])', chr(30) || chr(2) || '\\1', 'g'), chr(30) || chr(2))"
_BLOCKS = f"""blocks AS (SELECT doc_id, paper_id, ord, '§' || regexp_extract(b, '^\\[§([0-9]+)\\]', 1) AS marker, b FROM (
SELECT doc_id, paper_id, unnest({_PARTS}) AS b, generate_subscripts({_PARTS}, 1) AS ord FROM documents) WHERE regexp_matches(b, '^\\[§[0-9]+\\]'))"""

ORACLE = {
    "block_p1_blocks": f"WITH {_BLOCKS} SELECT doc_id, marker, md5(arg_max(b, ord)) AS digest, CAST(length(arg_max(b, ord)) AS INTEGER) AS n_chars FROM blocks GROUP BY doc_id, marker",
    "block_p19_url_lines": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, md5(line) AS digest FROM (SELECT *, max(CASE WHEN regexp_matches(line, '(?i)https?://|www\\.|doi\\.org|github') THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM l) WHERE near = 1""",
    "block_p7_numbering": """WITH l AS (SELECT doc_id, CAST(o - 1 AS INTEGER) AS ord, piece FROM (
  SELECT doc_id, unnest(string_split_regex(text, '\\n\\n+')) AS piece, generate_subscripts(string_split_regex(text, '\\n\\n+'), 1) AS o FROM documents) WHERE regexp_matches(piece, '[^ ]')),
h AS (SELECT *, regexp_matches(piece, '^#{1,6} ') AS heading, CASE WHEN regexp_matches(piece, '^#{1,6} ') THEN regexp_matches(piece, '(?i)^#{1,6} *references?\\b') END AS r FROM l),
s AS (SELECT *, coalesce(last_value(r IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING), false) AS in_refs FROM h)
SELECT doc_id, ord, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS INTEGER) AS marker_no FROM s WHERE NOT in_refs AND NOT heading""",
}

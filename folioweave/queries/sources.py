"""Queries of the block converter, the bibliography splitter, run control, the model stage and the pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.operators import bibliography as B
from folioweave.operators import blocks as K
from folioweave.operators import text as T
from folioweave.plans import model, render
from folioweave.plans import views as V
from folioweave.queries.assembly import _E, _U, _with
from folioweave.queries.corpus import _P, papers
from folioweave.session import table
from folioweave.sources import files

C = F.col


def _blocks(s, d):
    """Paragraphs of the documents as parsed blocks: headings by their marks, tables by their tag."""
    parts = table(s, d, "documents").select(C("doc_id").alias("doc"), F.posexplode(F.split("text", r"\n\s*\n")).alias("ord", "p"))
    level = F.length(F.regexp_extract("p", r"^(#{1,6}) ", 1))
    is_table = C("p").rlike("(?i)^<table")
    text = F.regexp_replace("p", r"^#{1,6} ", "")
    block = F.struct(
        F.when(is_table, "table").otherwise("text").alias("type"), F.when(~is_table, text).alias("text"), F.when(level > 0, level).alias("text_level"), F.when(is_table, C("p")).alias("table_body")
    )
    return parts.select("doc", "ord", F.to_json(block).alias("block"))


def b_entries(s, d):
    docs = table(s, d, "documents").select("doc_id", T.references_blob(C("text")).alias("blob")).where("blob <> ''")
    return docs.select("doc_id", B.split_udf("blob").alias("b")).select("doc_id", C("b.regime").alias("regime"), F.size(F.coalesce("b.entries", F.array().cast("array<struct<marker:string,body:string>>"))).alias("n_entries"))


def p2_pieces(s, d):
    return K.number_pieces(_blocks(s, d)).groupBy("kind", "in_refs").agg(F.count(F.lit(1)).alias("n"), F.count("marker_no").alias("n_marked"))


def p2_markdown(s, d):
    return K.to_markdown(_blocks(s, d)).select("doc", F.md5("markdown").alias("digest"), F.regexp_count("markdown", F.lit(r"(?m)^\[§[0-9]+\]")).alias("n_marks"))


def p9_stems(s, d):
    docs = table(s, d, "documents").where("text is not null")
    none = F.lit(None).cast("string")
    return docs.select("doc_id", K.file_stem(C("paper_id"), T.document_title(C("text")), C("doc_id").cast("string"), F.sha2("text", 256), none).alias("stem"))


def s11_changed(s, d):
    keys = ["paper_id", "id"]
    return files.changed_rows(V.units(s, d).drop("ord", "cite_keys"), V.nodes(s, d).drop("ord", "cite_keys"), keys).select(*keys)


def s12_unfinished(s, d):
    done = table(s, d, "extractions").where("payload is not null").select("paper_id", F.lit("completed").alias("status"))
    return files.unfinished(papers(s, d).select("paper_id"), done)


def s17_pages(s, d):
    html = render.pages(papers(s, d), V.units(s, d), V.edges(s, d))
    return html.select("paper_id", F.regexp_count("html", F.lit("<article")).alias("n_cards"), F.regexp_count("html", F.lit('class="rel"')).alias("n_pills"))


def l_stage(s, d):
    """The census stage with a stand-in provider that answers with a fenced object."""
    p = papers(s, d).select("paper_id", F.lit("census").alias("stage"), F.concat(F.lit("List the nodes of: "), "title").alias("prompt"))
    provider = model.Fake(lambda stage, prompt: '```json\n{"nodes": [], "stage": "' + stage + '"}\n```')
    return model.run_stage(p, provider).select("paper_id", "answer", "error", "calls")


QUERIES = {
    "b1_entries": b_entries,
    "block_p2_pieces": p2_pieces,
    "block_p2_markdown": p2_markdown,
    "block_p9_stems": p9_stems,
    "s11_changed": s11_changed,
    "s12_unfinished": s12_unfinished,
    "s17_pages": s17_pages,
    "l1_stage": l_stage,
}

ORACLE = {
    "s12_unfinished": _with(_P, body="SELECT paper_id FROM p WHERE NOT EXISTS (SELECT 1 FROM extractions x WHERE x.paper_id = p.paper_id AND payload IS NOT NULL)"),
    "s17_pages": _with(_P, _U, _E, body="""SELECT p.paper_id, CAST(coalesce(n, 0) AS INTEGER) AS n_cards, CAST(coalesce(k, 0) AS INTEGER) AS n_pills FROM p LEFT JOIN (SELECT paper_id, count(*) AS n FROM u GROUP BY ALL) USING (paper_id)
LEFT JOIN (SELECT e.paper_id, count(DISTINCT (e.source_id, e.relation, e.target_id)) AS k FROM e SEMI JOIN u ON u.paper_id = e.paper_id AND u.id = e.source_id GROUP BY ALL) USING (paper_id)"""),
    "l1_stage": _with(_P, body="""SELECT paper_id, '{"nodes": [], "stage": "census"}' AS answer, CAST(NULL AS VARCHAR) AS error, 1 AS calls FROM p"""),
}

"""Papers as HTML pages (section 2.19 of the inventory), built in the plan with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions.scalar import unit_label


def escape(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.regexp_replace(c, raw, safe)
    return F.coalesce(c, F.lit(""))


def unit_card(type_: Column, kind: Column, id_: Column, name: Column, description: Column) -> Column:
    label = unit_label(name, F.lit(None).cast("string"), description, id_)
    badge = F.when(kind.isNotNull(), F.concat_ws("/", type_, kind)).otherwise(type_)
    return F.concat(
        F.lit('<article class="unit"><h3>'), escape(label), F.lit('</h3><span class="badge">'), escape(badge), F.lit("</span><p>"), escape(description), F.lit("</p></article>")
    )


def relation_pills(edges: DataFrame) -> DataFrame:
    """The edges of a unit as one line, in order of relation and target."""
    pill = F.concat(F.lit('<span class="rel">'), escape(F.col("relation")), F.lit(" "), escape(F.col("target_id")), F.lit("</span>"))
    ordered = F.array_sort(F.collect_set(F.struct("relation", "target_id", pill.alias("h"))))
    return edges.groupBy("paper_id", F.col("source_id").alias("id")).agg(F.array_join(F.transform(ordered, lambda s: s["h"]), " ").alias("pills"))


def pages(papers: DataFrame, units: DataFrame, edges: DataFrame) -> DataFrame:
    """(paper_id, html): title, sections in their order and the cards of their units. A page is one paper's."""
    u = units.join(relation_pills(edges), ["paper_id", "id"], "left")
    card = F.concat(unit_card(F.col("type"), F.col("kind"), F.col("id"), F.col("name"), F.col("description")), F.coalesce("pills", F.lit("")))
    rank = F.array_position(F.array(*map(F.lit, ("problem", "method", "evidence"))), F.col("section"))
    ordered = F.array_sort(F.collect_list(F.struct(rank.alias("r"), "ord", card.alias("h"))))
    body = u.groupBy("paper_id").agg(F.array_join(F.transform(ordered, lambda s: s["h"]), "\n").alias("body"))
    head = F.concat(F.lit("<!doctype html><meta charset=utf-8><title>"), escape(F.col("title")), F.lit("</title><h1>"), escape(F.col("title")), F.lit("</h1>\n"))
    return papers.select("paper_id", "title").join(body, "paper_id", "left").select("paper_id", F.concat(head, F.coalesce("body", F.lit(""))).alias("html"))

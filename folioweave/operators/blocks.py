"""Parsed blocks to marked Markdown.

Input: one row per block (doc, ord, block JSON). A block becomes pieces by its type, the pieces of
a document are numbered by window functions: whether a piece lies in the references is the last
heading's state, the number of a marked piece its rank among the marked ones outside them.

Defined results: blocks without content give no piece; unknown types give their JSON; headers,
footers and page numbers are skipped; broken JSON of a block gives no piece.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioweave.operators.text import normalize_text

FIELDS = (
    "type", "text", "text_format", "img_path", "table_body", "sub_type", "code_body",
)
LISTS = ("image_caption", "img_caption", "image_footnote", "img_footnote", "table_caption", "table_footnote", "list_items", "code_caption")
SKIPPED = ("header", "footer", "page_number")
TEXT_TYPES = ("text", "aside_text", "page_footnote", "ref_text")
REFERENCE_HEADING = r"(?i)^(references?|bibliography|references and notes|literature cited)\b[.:]?\s*"
_PIECE = "array<struct<kind:string,text:string>>"


def read_records(text: Column) -> Column:
    """The array of blocks of a record: a list, or an object with ``content_list`` as list or as JSON text."""
    v = F.try_parse_json(text)
    listed = F.try_variant_get(v, "$", "array<variant>")
    inner = F.try_variant_get(v, "$.content_list", "array<variant>")
    nested = F.try_variant_get(F.try_parse_json(F.try_variant_get(v, "$.content_list", "string")), "$", "array<variant>")
    return F.transform(F.coalesce(listed, inner, nested), lambda b: b.cast("string"))


def explode_records(records: DataFrame, key: str = "doc", payload: str = "payload") -> DataFrame:
    return records.select(key, F.posexplode(read_records(F.col(payload))).alias("ord", "block"))


def _fields(block: Column) -> dict[str, Column]:
    v = F.try_parse_json(block)
    get = lambda k: normalize_text(F.coalesce(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")))
    as_list = lambda k: F.coalesce(F.try_variant_get(v, f"$.{k}", "array<string>"), F.array_compact(F.array(F.try_variant_get(v, f"$.{k}", "string"))))
    out = {k: get(k) for k in FIELDS}
    out |= {k: F.filter(F.transform(as_list(k), normalize_text), lambda x: x != "") for k in LISTS}
    return out | {"text_level": F.try_variant_get(v, "$.text_level", "double"), "json": F.to_json(v)}


def _pieces(kind: str, text: Column) -> Column:
    return F.when(text != "", F.array(F.struct(F.lit(kind).alias("kind"), text.alias("text")))).otherwise(F.array().cast(_PIECE))


def _each(kind: str, texts: Column) -> Column:
    return F.transform(texts, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("text")))


def _paragraphs(text: Column) -> Column:
    parts = F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda p: F.trim(p)), lambda p: p != "")
    return _each("para", parts)


def _image(path: Column, caption: Column) -> Column:
    alt = F.translate(caption, "[]", "()")
    return F.when(path != "", F.concat(F.lit("!["), alt, F.lit("](<"), path, F.lit(">)"))).otherwise("")


def _fenced(code: Column) -> Column:
    """A fence longer than every run of backticks in the code."""
    runs = F.transform(F.regexp_extract_all(code, F.lit("(`+)"), F.lit(1)), F.length)
    fence = F.repeat(F.lit("`"), F.greatest(F.lit(3), F.coalesce(F.array_max(runs), F.lit(0)) + 1))
    return F.concat(fence, F.lit("\n"), code, F.lit("\n"), fence)


_LATEX_HEADING = re.compile(r"\\((?:sub){0,2})section\*?\{([^{}\n]*)\}")
_HEADING_LINE = re.compile(r"\s*(#{1,6})[ \t]+(\S.*?)[ \t]*#*\s*$")


def markdown_pieces(text: str | None) -> list[dict[str, str]]:
    """The pieces of a block that is plain text: an outer fence is taken off, LaTeX headings become Markdown ones, blank
    lines outside fences separate paragraphs, and a heading at the beginning of a paragraph is a piece of its own."""
    body = (text or "").strip()
    lines = body.splitlines()
    if len(lines) > 1 and lines[0].startswith("```") and lines[-1].strip() == "```":
        body = "\n".join(lines[1:-1])
    body = _LATEX_HEADING.sub(lambda m: "#" * (1 + len(m[1]) // 3) + " " + m[2].strip(), body)
    out: list[dict[str, str]] = []
    held: list[str] = []

    def close() -> None:
        text = "\n".join(held).strip()
        held.clear()
        if text:
            title = re.match(REFERENCE_HEADING, text)
            if title and (title.end() == len(text) or text[title.end() - 1] == "\n"):
                out.append({"kind": "ref_heading", "text": "# " + title[1]})
                text = text[title.end() :].strip()
            if text:
                out.append({"kind": "para", "text": text})

    fenced = False
    for line in body.splitlines():
        opens = line.lstrip().startswith("```")
        heading = None if fenced or opens or held else _HEADING_LINE.match(line)
        if heading:
            title = re.match(REFERENCE_HEADING, heading[2])
            is_ref = bool(title and title.end() == len(heading[2]))
            out.append({"kind": "ref_heading" if is_ref else "heading", "text": f"{heading[1]} {title[1] if is_ref else heading[2]}"})
        elif fenced or opens or line.strip():
            held.append(line)
        else:
            close()
        fenced ^= opens
    close()
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())])))
def markdown_pieces_udf(text: pd.Series) -> pd.Series:
    return text.map(markdown_pieces)


#: Fields of a record's header, in order.
HEADER_FIELDS = ("sha256", "id", "origin_path", "model_name", "model_version", "content_process_path", "doc_loc")


def metadata_comment(source: Column, record: Column) -> Column:
    """P10: a comment with the source and the filled header fields of a record (JSON text); '' where it is no object."""
    v = F.try_parse_json(record)
    value = lambda k: normalize_text(F.try_variant_get(v, f"$.{k}", "string"))
    lines = F.array_compact(F.array(F.concat(F.lit("source: "), source), *(F.when(value(k) != "", F.concat(F.lit(f"{k}: "), value(k))) for k in HEADER_FIELDS)))
    is_object = F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
    return F.when(is_object, F.concat(F.lit("<!--\n"), F.array_join(lines, "\n"), F.lit("\n-->"))).otherwise("")


def pieces_of(block: Column) -> Column:
    """array<struct<kind, text>> of a block; kinds: ref_heading, heading, para, block, list."""
    f = _fields(block)
    ref = f["text"].rlike(REFERENCE_HEADING + r"($|\n)") | (f["text_level"].isNotNull() & f["text"].rlike(REFERENCE_HEADING + "$"))
    title = F.regexp_extract(f["text"], REFERENCE_HEADING, 1)
    rest = F.regexp_replace(f["text"], REFERENCE_HEADING, "")
    level = F.least(F.greatest(F.coalesce(f["text_level"], F.lit(1.0)).cast("int"), F.lit(1)), F.lit(6))
    head = lambda t: F.concat(F.repeat(F.lit("#"), level), F.lit(" "), t)
    text = (
        F.when(ref, F.concat(_pieces("ref_heading", head(title)), _pieces("para", rest)))
        .when(f["text_level"].isNotNull(), _pieces("heading", F.when(f["text"] != "", head(f["text"])).otherwise("")))
        .otherwise(_paragraphs(f["text"]))
    )
    bold = lambda ws: F.when(F.size(ws) > 0, F.concat(F.lit("**"), F.array_join(ws, " "), F.lit("**"))).otherwise("")
    i_cap = F.when(F.size(f["image_caption"]) > 0, f["image_caption"]).otherwise(f["img_caption"])
    i_foot = F.when(F.size(f["image_footnote"]) > 0, f["image_footnote"]).otherwise(f["img_footnote"])
    image = F.concat(_pieces("para", _image(f["img_path"], F.array_join(i_cap, " "))), _pieces("para", bold(i_cap)), _each("para", i_foot))
    t_alt = F.when(F.size(f["table_caption"]) > 0, F.array_join(f["table_caption"], " ")).otherwise("table image")
    table = F.concat(_pieces("para", _image(f["img_path"], t_alt)), _pieces("para", bold(f["table_caption"])), _pieces("block", f["table_body"]), _each("para", f["table_footnote"]))
    equation = _pieces("block", F.when(f["text"] != "", f["text"]).otherwise(f["text_format"]))
    items = f["list_items"]
    is_refs = f["sub_type"] == "ref_text"
    list_ = F.when(is_refs, _each("plain", items)).otherwise(_pieces("list", F.array_join(items, "\n")))
    code_text = F.when(f["code_body"] != "", f["code_body"]).otherwise(f["text"])
    code = F.concat(_pieces("para", bold(f["code_caption"])), _pieces("block", F.when(code_text != "", _fenced(code_text)).otherwise("")))
    t = f["type"]
    return (
        F.when(t.isin(*SKIPPED), F.array().cast(_PIECE)).when(t.isin(*TEXT_TYPES), text).when(t == "image", image).when(t == "table", table)
        .when(t == "equation", equation).when(t == "list", list_).when(t == "code", code).otherwise(_pieces("block", F.coalesce(f["json"], F.lit(""))))
    )


def _all_pieces(blocks: DataFrame, key: str) -> DataFrame:
    """(doc, ord, sub, kind, text): pieces of objects by their type, of plain texts by their Markdown."""
    plain = F.try_variant_get(F.try_parse_json("block"), "$", "map<string,variant>").isNull()
    cols = [key, "ord"]
    objects = blocks.where(~plain).select(*cols, F.posexplode(pieces_of(F.col("block"))).alias("sub", "p"))
    text = F.coalesce(F.try_variant_get(F.try_parse_json("block"), "$", "string"), F.lit(None).cast("string"))
    texts = blocks.where(plain).select(*cols, markdown_pieces_udf(text).alias("ps")).select(*cols, F.posexplode("ps").alias("sub", "p"))
    return objects.unionByName(texts).select(*cols, "sub", "p.kind", "p.text")


def number_pieces(blocks: DataFrame, key: str = "doc") -> DataFrame:
    """(doc, ord, sub, kind, text, in_refs, marker_no) of all pieces; marker_no is null where none is set."""
    p = _all_pieces(blocks, key)
    w = Window.partitionBy(key).orderBy("ord", "sub")  # one document is one author's text
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.when(F.col("kind") == "ref_heading", True).when(F.col("kind") == "heading", False)
    p = p.withColumn("in_refs", F.coalesce(F.last(state, ignorenulls=True).over(upto), F.lit(False)))
    marked = F.col("kind").isin("para", "block", "list") & ~F.col("in_refs")
    n = F.sum(marked.cast("int")).over(upto)
    return p.withColumn("marker_no", F.when(marked, n))


def render_piece(kind: Column, text: Column, in_refs: Column, marker_no: Column) -> Column:
    mark = F.concat(F.lit("[§"), marker_no.cast("string"), F.lit("]"))
    listed = F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit("- "), x)), "\n")
    return (
        F.when(marker_no.isNotNull() & (kind == "para"), F.concat(mark, F.lit(" "), text))
        .when(marker_no.isNotNull() & (kind == "list"), F.concat(mark, F.lit("\n"), listed))
        .when(marker_no.isNotNull(), F.concat(mark, F.lit("\n"), text))
        .when(in_refs & (kind == "list"), F.regexp_replace(text, "\n", "\n\n"))
        .otherwise(text)
    )


def to_markdown(blocks: DataFrame, key: str = "doc") -> DataFrame:
    """(doc, markdown): the pieces of each document in order."""
    p = number_pieces(blocks, key).withColumn("out", render_piece(F.col("kind"), F.col("text"), F.col("in_refs"), F.col("marker_no")))
    ordered = F.array_sort(F.collect_list(F.struct("ord", "sub", "out")))
    return p.groupBy(key).agg(F.concat(F.array_join(F.transform(ordered, lambda s: s["out"]), "\n\n"), F.lit("\n")).alias("markdown"))


def combined(documents: DataFrame, key: str = "doc") -> DataFrame:
    """Rows (name, line) of one file with all documents, in order, with rules between; written by one ordered sink."""
    return documents.select(key, F.concat(F.col("markdown"), F.lit("\n---\n")).alias("line")).repartitionByRange(key).sortWithinPartitions(key)


def file_stem(origin: Column, heading: Column, id_: Column, digest: Column, source: Column) -> Column:
    """The first filled of five names, safe for a file, at most 120 characters, with a short id."""
    clean = lambda c: F.nullif(F.regexp_replace(F.regexp_replace(F.left(c, F.lit(120)), r"[^\w.\-]+", "_"), r"^[_.]+|[_.]+$", ""), F.lit(""))
    stem = F.coalesce(*(clean(c) for c in (F.regexp_extract(origin, r"([^/\\]+?)(?:\.[^.]+)?$", 1), heading, id_, F.left(digest, F.lit(16)), source)), F.lit("document"))
    short = F.nullif(F.left(F.regexp_replace(F.coalesce(id_, digest, F.lit("")), "[^A-Za-z0-9]", ""), F.lit(8)), F.lit(""))
    return F.when(short.isNotNull() & (stem != clean(id_)), F.concat_ws("_", stem, short)).otherwise(stem)


def unique_names(names: DataFrame, order: str = "ord") -> DataFrame:
    """Repeated names of a run get the first free number; see suffix_duplicates."""
    from folioweave.operators.assemble import suffix_duplicates

    got = suffix_duplicates(names.select(F.lit("run").alias("paper_id"), F.col("name").alias("id"), F.col(order).alias("ord")))
    return got.select(F.col("ord").alias(order), F.col("id").alias("name"), F.col("new_id").alias("unique_name"))

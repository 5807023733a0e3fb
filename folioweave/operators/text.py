r"""Marked papers as text: blocks, spans, bibliography, tables and headings (P-operators).

A paper is one text with ``[§N]`` markers at line starts. All operators work in the row: a text
is cut with regular expressions and higher-order functions where it lies, so nothing is
shuffled until the caller groups or joins the pieces.

Defined results: null and empty texts have no pieces; text before the first marker belongs to
no block; other white-space or marker oddities follow the expressions stated per function.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.functions.scalar import canon_marker, normalize_name, strip, truthy

MARKER = r"^\[§([0-9]+)\]"
SPAN_CHARS = 240
HEAD_CHARS = 12_000
LABEL_CHARS = 180
PREVIEW_CELLS = 8

# Headings of bibliographies, bold headings of what follows them, words with a caption, marks of links.
REFERENCE_HEADINGS = ("reference", "references", "bibliography", "references and notes", "literature cited")
CLOSING_HEADINGS = (
    "appendix", "appendices", "supplement", "supplementary", "supplemental", "acknowledgment", "acknowledgments", "acknowledgement",
    "acknowledgements", "author contribution", "author contributions", "funding", "ethics", "conflict of interest", "conflicts of interest", "data availability",
)
TABLE_WORDS = ("Table", "Tab.", "Tab")
LINK_SIGNS = ("http://", "https://", "www.", "doi.org", "github")


def any_of(words: tuple[str, ...]) -> str:
    """A pattern of literal words, longer ones first; a blank stands for any white space within the line or the next."""
    longest = sorted(words, key=lambda w: (-len(w), w))
    return "(?:" + "|".join(r"\s+".join(re.escape(part) for part in w.split(" ")) for w in longest) + ")"


# Markdown as the converter writes it: a heading line of one to six '#', a bold line, a number such as 3.1, B.2 or IV before a heading.
_HASHES = r"#{1,6}[ \t]"
_DOTTED_NUMBER = r"(?:[0-9]+|[A-Z])(?:\.[0-9]+)*"
_HEADING_NUMBER = r"(?:(?:[0-9]+(?:\.[0-9]+)*|[IVXLCDM]+)\.?[ \t]*|\.[ \t]*)?"
_LINE_REST = r"[ \t]*$"


def _heading_line(words: str) -> str:
    """A line that holds nothing but the words: as a heading that may be numbered, in bold, or plain."""
    heading = rf"{_HASHES}*{_HEADING_NUMBER}{words}[.:]?"
    bold = rf"\*\*[ \t]*{words}[ \t]*\*\*"
    return rf"^(?:{heading}|{bold}|{words}){_LINE_REST}"


REFERENCES_HEADER = "(?im)" + _heading_line(any_of(REFERENCE_HEADINGS))
SECTION_END = rf"(?im)^{_HASHES}+\S|^\*\*[ \t]*{any_of(CLOSING_HEADINGS)}\b[^*\n]{{0,60}}\*\*{_LINE_REST}"
TABLE = r"(?is)<table\b.*?</table>"
CAPTION = rf"(?i)\*\*\s*{any_of(TABLE_WORDS)}[^*\n]*\*\*"
PIPE_TABLE = r"(?m)^\s*\|?(?:\s*:?-{3,}:?\s*\|)+\s*:?-{0,}\s*\|?\s*$"
_OPENING = rf"^(?:{_HASHES}+|\*\*[ \t]*)"
HEADING_LABEL = rf"(?m){_OPENING}({_DOTTED_NUMBER})(?=[ \t.)]|\*\*|$)"
HEADING_NAME = rf"(?m){_OPENING}(?:{_DOTTED_NUMBER}[ \t.]+)?([A-Za-z][A-Za-z0-9 \t\-/&]*?)[ \t]*(?:\*\*)?{_LINE_REST}"
_URL = "(?i)" + any_of(LINK_SIGNS)


def pieces(text: Column, boundary: str) -> Column:
    """A text cut before every match of ``boundary`` (a pattern without flags of its own beside (?m))."""
    return F.split(text, rf"(?m)(?={boundary})")


def blocks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ord, marker, text) of each block; a block keeps its marker."""
    cut = df.select(key, F.posexplode(pieces(F.col(text), MARKER)).alias("ord", "text"))
    return cut.where(F.col("text").rlike(r"^\[§[0-9]+\]")).select(
        key, "ord", F.concat(F.lit("§"), F.regexp_extract("text", MARKER, 1)).alias("marker"), "text"
    )


def block_map(blocks_: DataFrame, key: str = "doc_id", last: bool = True) -> DataFrame:
    """One block per marker: the last of several (P1), or the first (P12, anchors)."""
    order = F.col("ord") if last else -F.col("ord")
    return blocks_.groupBy(key, "marker").agg(F.max_by("text", order).alias("text"))


def block_body(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"^\[§[0-9]+\]\s*", ""))


def span_prefix(body: Column, width: int = SPAN_CHARS) -> Column:
    """At most ``width`` characters, cut at the last blank where that lies past the middle."""
    head = F.left(body, F.lit(width))
    at = F.length(F.regexp_extract(head, r"(?s)^(.*) ", 1))
    return F.when(F.length(body) <= width, body).when(at > width // 2, F.left(body, at)).otherwise(head)


def span_index(blocks_: DataFrame, referenced: DataFrame, key: str = "doc_id") -> DataFrame:
    """Prefixes of the blocks whose marker (key, marker) is referenced; the first block of a marker."""
    wanted = referenced.select(key, canon_marker(F.col("marker")).alias("marker")).where("marker <> ''").dropDuplicates()
    filled = blocks_.withColumn("body", block_body(F.col("text"))).where("body <> ''")
    first = filled.groupBy(key, "marker").agg(F.min_by("body", "ord").alias("body"))
    out = first.join(wanted, [key, "marker"], "left_semi")
    return out.select(key, "marker", span_prefix(F.col("body")).alias("text"), (F.length("body") > SPAN_CHARS).alias("truncated"))


def reference_density(text: Column) -> Column:
    """The larger of the numbers of years and of [N] marks."""
    return F.greatest(F.regexp_count(text, F.lit(r"\b(?:19|20)\d{2}\b")), F.regexp_count(text, F.lit(r"\[\d{1,4}\]")))


def bibliography(text: Column) -> Column:
    """struct<before, span, score> around the densest bibliography, null below 3 signals; ties keep the first.

    The text is cut before every header candidate; a candidate's span ends at the next section header.
    """
    cut = F.split(text, rf"(?im)(?={REFERENCES_HEADER[5:]})")

    def candidate(piece: Column, i: Column) -> Column:
        header = F.regexp_extract(piece, rf"(?s){REFERENCES_HEADER}", 0)
        rest = F.substr(piece, F.length(header) + 1)
        body = F.element_at(F.split(rest, rf"(?im)(?={SECTION_END[5:]})", 2), 1)
        return F.struct(reference_density(body).alias("score"), (-i).alias("at"), F.concat(header, body).alias("span"), i.alias("i"))

    heads = F.filter(F.transform(cut, candidate), lambda c: F.get(cut, c["i"]).rlike(rf"\A{REFERENCES_HEADER}") & (c["score"] >= 3))
    best = F.array_max(F.transform(heads, lambda c: F.struct(c["score"], c["at"], c["span"])))
    before = F.array_join(F.slice(cut, 1, F.greatest(-best["at"], F.lit(0))), "")
    return F.when(F.size(heads) > 0, F.struct(before.alias("before"), best["span"].alias("span"), best["score"].alias("score")))


def references_blob(text: Column) -> Column:
    """The bibliography without image marks; '' without one."""
    return F.coalesce(strip(F.regexp_replace(bibliography(text)["span"], r"!\[[^\]]*\]\([^)]*\)", "")), F.lit(""))


def body_slice(text: Column) -> Column:
    """The text before its bibliography; all of it without one."""
    before = bibliography(text)["before"]
    return F.when(before.isNotNull(), F.concat(F.regexp_replace(before, r"(?U)\s+$", ""), F.lit("\n"))).otherwise(text)


def source_tables(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, marker, caption, html, n_tables); the owner is the last marker before a table ('' without one),
    the caption the last bold one since the previous table; tables of one owner are joined, the first caption wins."""
    whole = F.split(F.col(text), r"(?is)(?=<table\b.*?</table>)|(?<=</table>)")
    rows = df.where(F.col(text).rlike("(?i)<table")).select(key, F.posexplode(whole).alias("t_ord", "piece"))
    is_table = F.col("piece").rlike(r"(?is)\A<table\b.*</table>\z")
    marks = F.regexp_extract_all("piece", F.lit(r"(?m)^\[§([0-9]+)\]"), F.lit(1))
    captions = F.regexp_extract_all("piece", F.lit(rf"({CAPTION})"), F.lit(1))
    # A table ends the caption before it; pieces keep no text but that of tables.
    said = F.when(is_table, F.lit("")).when(F.size(captions) > 0, F.element_at(captions, -1))
    rows = rows.select(
        key, "t_ord", F.when(is_table, F.col("piece")).alias("html"), F.when(~is_table & (F.size(marks) > 0), F.concat(F.lit("§"), F.element_at(marks, -1))).alias("mark"), said.alias("said"),
    )
    before = Window.partitionBy(key).orderBy("t_ord").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.lit(""))
    one = rows.withColumns({"marker": last("mark"), "caption": strip(F.regexp_replace(last("said"), r"^[* ]+|[* ]+$", ""))}).where("html is not null")
    ordered = F.array_sort(F.collect_list(F.struct("t_ord", "caption", "html")))
    g = one.groupBy(key, "marker").agg(ordered.alias("ts"))
    captions = F.filter(F.transform("ts", lambda t: t["caption"]), lambda c: c != "")
    return g.select(
        key, "marker", F.coalesce(F.get(captions, F.lit(0)), F.lit("")).alias("caption"), F.array_join(F.transform("ts", lambda t: t["html"]), "\n").alias("html"), F.size("ts").alias("n_tables")
    )


def capture_warnings(text: Column) -> Column:
    """The blind spots of the table capture as a list of rule names."""
    low = F.lower(text)
    opens, closes = F.regexp_count(low, F.lit("<table")), F.regexp_count(low, F.lit("</table>"))
    nested = F.exists(F.regexp_extract_all(low, F.lit(r"(?s)(<table\b.*?</table>)"), F.lit(1)), lambda t: F.regexp_count(t, F.lit("<table")) > 1)
    pipe = ~low.rlike(TABLE) & text.rlike(PIPE_TABLE)
    return F.array_compact(F.array(F.when(opens != closes, "unbalanced"), F.when(nested, "nested"), F.when(pipe, "pipe_tables")))


def table_index(tables: DataFrame, previews: DataFrame, key: str = "doc_id") -> DataFrame:
    """One line per addressable table: its caption, else its first cells; ``previews`` has (key, marker, cells)."""
    t = tables.where("marker <> ''").join(previews, [key, "marker"], "left")
    cells = F.array_join(F.slice("cells", 1, PREVIEW_CELLS), " | ")
    label = F.when(truthy(F.col("caption")), F.col("caption")).when(truthy(cells), F.concat(F.lit("columns: "), cells)).otherwise("(no caption)")
    return t.select(key, "marker", F.concat(F.lit("- `"), "marker", F.lit("` — "), F.left(label, F.lit(LABEL_CHARS))).alias("line"))


def metadata_slice(df: DataFrame, key: str = "doc_id", text: str = "text", head: int = HEAD_CHARS) -> DataFrame:
    """The head of a long text, to the end of its line, and the later lines with a URL and their neighbours."""
    t = F.col(text)
    cut = F.locate("\n", t, head + 1)
    long_ = df.where((F.length(t) > head) & (cut > 0)).select(key, t.alias("t"), cut.alias("cut"))
    lines = F.split(F.substr("t", F.col("cut") + 1), r"\r\n|[\n\r]")
    near = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda s: F.exists(F.slice(lines, F.greatest(s["i"], F.lit(1)), F.when(s["i"] == 0, 2).otherwise(3)), lambda x: x.rlike(_URL)),
    )
    tail = F.array_join(F.transform(near, lambda s: s["x"]), "\n")
    made = F.when(F.size(near) > 0, F.concat(F.expr("left(t, cut - 1)"), F.lit("\n\n[... later lines with URLs ...]\n"), tail)).otherwise(F.expr("left(t, cut - 1)"))
    short = df.where(~((F.length(t) > head) & (cut > 0)) | t.isNull()).select(key, t.alias("slice"))
    return short.unionByName(long_.select(key, made.alias("slice")))


def url_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """P19 over whole texts: (key, line_no, line) of the lines with a URL and their neighbours."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(-1, 1)
    return lines.withColumn("near", F.max(F.col("line").rlike(_URL)).over(w)).where("near").drop("near")


def heading_map(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """P20: (key, label, marker): numbered headings, then named ones of four letters or more, to the next block marker.

    Forward as-of join: the text is cut at heading lines, a heading's marker is the first at or after its end, found in one
    pass over the pieces of a text. The first heading of a label wins, numbered labels before names.
    """
    heads = F.split(F.col(text), r"(?m)(?=^(?:#{1,6}[ \t]+|\*\*[ \t]*)[A-Za-z0-9])")
    found = F.transform(
        heads,
        lambda h: F.struct(
            F.lower(F.regexp_extract(h, rf"\A{HEADING_LABEL[4:]}", 1)).alias("label"),
            normalize_name(F.regexp_extract(F.element_at(F.split(h, "\n", 2), 1), HEADING_NAME, 1)).alias("name"),
            F.nullif(F.regexp_extract(h, r"(?m)^\[§([0-9]+)\]", 1), F.lit("")).alias("mark"),
            h.rlike(r"\A(?:#|\*\*)").alias("is_heading"),
        ),
    )
    rows = df.select(key, F.posexplode(found).alias("i", "h")).select(key, "i", "h.*")
    later = Window.partitionBy(key).orderBy("i").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("n", F.first("mark", ignorenulls=True).over(later))
    one = rows.where("is_heading and n is not null")
    keyed = one.where("label <> ''").select(key, F.lit(0).alias("kind"), "i", "label", "n").unionByName(
        one.where(F.length("name") >= 4).select(key, F.lit(1).alias("kind"), "i", F.col("name").alias("label"), "n")
    )
    return keyed.groupBy(key, "label").agg(F.concat(F.lit("§"), F.min_by("n", F.struct("kind", "i"))).alias("marker"))


def document_title(text: Column) -> Column:
    """The first ``# `` line before the first marker, else the first filled line, else 'Untitled'."""
    at = F.locate("[§", text)
    preamble = F.when(at > 0, F.substr(text, F.lit(1), at - 1)).otherwise(F.left(text, F.lit(500)))
    line = strip(F.regexp_extract(preamble, r"(?m)^#\s+(.+)", 1))
    filled = F.get(F.filter(F.transform(F.split(preamble, r"\r\n|[\n\r]"), strip), lambda x: x != ""), F.lit(0))
    return F.coalesce(F.nullif(line, F.lit("")), filled, F.lit("Untitled"))


def document_slug(title: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.regexp_replace(F.left(s, F.lit(30)), "^_+|_+$", ""), F.lit("")), F.lit("paper"))


def normalize_text(text: Column) -> Column:
    """Unified line ends and no outer white space."""
    return strip(F.regexp_replace(text, r"\r\n?", "\n"))

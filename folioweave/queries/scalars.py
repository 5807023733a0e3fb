"""Queries of the scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import ids
from folioweave.functions import scalar as S
from folioweave.session import table

C = F.col
WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(32) || chr(133) || chr(160) || chr(8232) || chr(8233) || chr(12288)"


def norm_sql(x: str) -> str:
    return f"coalesce(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), '')"


def _of(name, cols):
    """A projection of a table; the columns are made when the query runs, as they need a session."""
    return lambda spark, d: table(spark, d, name).select(*cols())


_CITE_BARE = "lower(regexp_replace(s, '[\\[\\]\\s]+', '', 'g'))"
_YEAR = "(1[89][0-9][0-9]|20[0-9][0-9])([a-z])?"
NUM_T = "ltrim(replace(replace(trim(value_raw), '−', '-'), '–', '-'), '≈~<>≤≥±$ ' || chr(9))"
_SCI = "^([+-]?[0-9]+(?:\\.[0-9]+)?)\\s*[x×*]\\s*10\\s*(?:\\^|\\*\\*)?\\s*\\(?([+-]?[0-9]+)\\)?"
_LEAD = "^([+-]?(?:[0-9][0-9,]*(?:\\.[0-9]+)?|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
VALUE_NUM_SQL = f"""CASE WHEN regexp_matches(t, '{_SCI}') THEN try_cast(regexp_extract(t, '{_SCI}', 1) || 'e' || regexp_extract(t, '{_SCI}', 2) AS DOUBLE)
  ELSE try_cast(nullif(replace(regexp_extract(t, '{_LEAD}', 1), ',', ''), '') AS DOUBLE) END"""
_DIR = "^(?:[0-9]+_)?(?:([A-Za-z][A-Za-z0-9-]*)_)?((?:19|20)[0-9]{2})(?:[_-]|$)"
_HOST = "regexp_replace(lower(regexp_extract(u, '^[^:/?#]+://([^/?#]*)', 1)), '^www\\.', '')"


def n7(spark, d):
    v = table(spark, d, "result_rows").select("row_no", F.explode(S.numeric_values(C("value_raw"))).alias("v"))
    return v.groupBy("row_no").agg(F.count("v").alias("n_numbers"), F.max("v").alias("largest")).where("row_no is not null")


def hosts(spark, d):
    urls = table(spark, d, "paper_catalog").select(F.explode("resource_urls").alias("url")).select(S.url_host(C("url")).alias("host"))
    return urls.select("host", S.is_release_host(C("host"), S.CODE_HOSTS).alias("is_code"), S.is_release_host(C("host"), S.DATA_HOSTS).alias("is_data"))


def _or_hosts(hosts_):
    return " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in hosts_)


def n16(spark, d):
    p = table(spark, d, "paper_catalog").where("title is not null and central_contribution is not null")
    return p.select("cat_no", S.headline_overlap(C("title"), C("central_contribution")).alias("overlap"))


def n17(spark, d):
    g = table(spark, d, "graph_units").where("op = 'upsert'")
    none = F.lit(None).cast("string")
    text = S.card_text(C("type"), C("description"), C("description"), none, C("description"), none, C("name"))
    name = F.coalesce(C("name"), C("unit_id"))
    return g.select("paper_id", "unit_id", S.embed_text(none, C("paper_id"), C("type"), C("kind"), name, text).alias("embed_text")).dropDuplicates()


QUERIES = {
    "n1_normalize_name": _of("cited_refs", lambda: ("ref_no", S.normalize_name(C("title")).alias("norm"))),
    "n2_cite_key": _of("cited_refs", lambda: ("ref_no", S.normalize_cite_key(C("cite_key")).alias("cite_norm"))),
    "n3_slug": _of("graph_units", lambda: ("unit_id", ids.slug(C("unit_id")).alias("slug"))),
    "n4_alias_prefix": _of("graph_units", lambda: ("unit_id", ids.alias_prefix(C("unit_id")).alias("aliased"))),
    "n5_canon_marker": _of("result_rows", lambda: ("row_no", S.canon_marker(C("table_marker")).alias("marker"))),
    "n6_value_num": _of("result_rows", lambda: ("row_no", S.parse_value_num(C("value_raw")).alias("parsed"))),
    "n7_numeric_keys": n7,
    "n8_coerce_year": _of("cited_refs", lambda: ("ref_no", S.coerce_year(C("cite_key")).alias("key_year"))),
    "n9_dirname": _of("paper_catalog", lambda: ("cat_no", S.dirname_venue(C("paper_id")).alias("dir_venue"), S.dirname_year(C("paper_id")).alias("dir_year"))),
    "n10_url_host": lambda spark, d: hosts(spark, d).groupBy("host").agg(F.count(F.lit(1)).alias("n")),
    "n11_release_host": lambda spark, d: hosts(spark, d).groupBy("is_code", "is_data").agg(F.count(F.lit(1)).alias("n")),
    "n12_alias": _of("paper_catalog", lambda: ("cat_no", F.size(S.derive_aliases(F.concat("title", F.lit(" ("), F.coalesce("venue", F.lit("none")), F.lit(")")))).alias("n_aliases"))),
    "n13_sanitize": _of("documents", lambda: ("doc_id", F.md5(S.sanitize_text(C("text"))).alias("digest"), F.length(S.sanitize_text(C("text"))).alias("n_clean"))),
    "n14_formula_key": _of("graph_units", lambda: ("unit_id", F.regexp_replace(S.formula_key(C("description")), "^$", "").alias("formula_key"))),
    "n15_cache_key": _of("documents", lambda: ("doc_id", S.cache_key(F.lit("model/x 1"), C("text")).alias("cache_key"))),
    "n16_headline_overlap": n16,
    "n17_embed_text": n17,
    "n18_unit_label": _of("graph_units", lambda: ("unit_id", S.unit_label(C("name"), F.lit(None).cast("string"), C("description"), C("unit_id"), 30).alias("label"))),
    "n19_alnum": _of("paper_catalog", lambda: ("cat_no", S.alnum_only(C("title")).alias("alnum"))),
    "n22_marker_grammar": lambda spark, d: table(spark, d, "relations").select("relation_no", F.explode("provenance").alias("marker")).select("relation_no", "marker", S.is_marker(C("marker")).alias("is_marker")),
    "n23_feedback": _of("documents", lambda: ("doc_id", F.length(S.feedback_suffix(C("text"))).alias("n_feedback"))),
    "n24_paper_key": lambda spark, d: table(spark, d, "paper_catalog").select("cat_no", S.paper_key(F.concat(F.lit("out/"), "paper_id", F.lit("/06_extraction.json"))).alias("key_by_dir"), S.paper_key(F.concat(F.lit("out/"), "paper_id", F.lit(".json"))).alias("key_by_stem")),
    "n25_title_prefixes": _of("paper_catalog", lambda: ("cat_no", F.array_join(F.array_sort(S.title_prefixes(C("title"))), " ").alias("prefixes"))),
    "n26_cost": _of("events", lambda: ("event_id", S.effective_cost(F.floor(C("value") * 100), F.floor(C("value") * 30), F.floor(C("value") * 10)).cast("bigint").alias("effective"))),
    "n28_marker_order": _of("result_rows", lambda: ("row_no", S.marker_order(C("table_marker")).alias("marker_no"))),
}

ORACLE = {
    "n1_normalize_name": f"SELECT ref_no, {norm_sql('title')} AS norm FROM cited_refs",
    "n2_cite_key": f"""WITH k AS (SELECT ref_no, trim(cite_key, {WS}) AS s FROM cited_refs),
a AS (SELECT ref_no, s, list_filter(regexp_extract_all(regexp_extract(s, '(?s)^(.*?){_YEAR}', 1), '[A-Za-z][A-Za-z\\-]*'), lambda x: lower(x) NOT IN ('et', 'al', 'and', 'the')) AS names FROM k),
f AS (SELECT *, regexp_replace(lower(names[1]), '[^a-z0-9]', '', 'g') AS author FROM a)
SELECT ref_no, coalesce(CASE WHEN regexp_full_match(s, '\\[?\\s*[0-9]+\\s*\\]?') THEN {_CITE_BARE}
  WHEN regexp_matches(s, '{_YEAR}') AND length(author) > 0 THEN author || regexp_extract(s, '{_YEAR}', 1) || regexp_extract(s, '{_YEAR}', 2)
  ELSE {_CITE_BARE} END, '') AS cite_norm FROM f""",
    "n3_slug": "SELECT unit_id, regexp_replace(regexp_replace(lower(unit_id), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM graph_units",
    "n4_alias_prefix": """SELECT unit_id, CASE WHEN strpos(unit_id, ':') > 0 AND a IS NOT NULL THEN a || substr(unit_id, strpos(unit_id, ':')) ELSE unit_id END AS aliased
FROM (SELECT unit_id, CASE split_part(unit_id, ':', 1) WHEN 'setting' THEN 'exp' WHEN 'set' THEN 'exp' WHEN 'ent' THEN 'exp' WHEN 'met' THEN 'mea' WHEN 'clm' THEN 'fnd' WHEN 'ctx' THEN 'prb' END AS a FROM graph_units)""",
    "n5_canon_marker": """SELECT row_no, CASE WHEN m <> '' THEN '§' || m ELSE '' END AS marker FROM (
SELECT row_no, coalesce(trim(ltrim(CASE WHEN t[1] = '[' AND t[-1] = ']' THEN trim(substr(t, 2, length(t) - 2)) ELSE t END, '§')), '') AS m
FROM (SELECT row_no, trim(table_marker) AS t FROM result_rows))""",
    "n6_value_num": f"SELECT row_no, {VALUE_NUM_SQL} AS parsed FROM (SELECT row_no, {NUM_T} AS t FROM result_rows)",
    "n7_numeric_keys": """SELECT row_no, count(v) AS n_numbers, max(v) AS largest FROM (
SELECT row_no, try_cast(rtrim(replace(x, ',', ''), '.') AS DOUBLE) AS v FROM (
SELECT row_no, unnest(regexp_extract_all(replace(replace(replace(value_raw, '−', '-'), '–', '-'), '—', '-'), '[-+]?(?:[0-9][0-9,]*\\.?[0-9]*|\\.[0-9]+)')) AS x FROM result_rows))
WHERE v IS NOT NULL AND row_no IS NOT NULL GROUP BY row_no""",
    "n8_coerce_year": "SELECT ref_no, try_cast(nullif(regexp_extract(cite_key, '(1[89][0-9][0-9]|20[0-9][0-9])', 1), '') AS INTEGER) AS key_year FROM cited_refs",
    "n9_dirname": f"SELECT cat_no, nullif(regexp_extract(paper_id, '{_DIR}', 1), '') AS dir_venue, try_cast(nullif(regexp_extract(paper_id, '{_DIR}', 2), '') AS INTEGER) AS dir_year FROM paper_catalog",
    "n10_url_host": f"SELECT host, count(*) AS n FROM (SELECT {_HOST} AS host FROM (SELECT CASE WHEN strpos(x, '://') > 0 THEN x ELSE 'https://' || x END AS u FROM (SELECT trim(unnest(resource_urls)) AS x FROM paper_catalog))) GROUP BY host",
    "n11_release_host": f"SELECT ({_or_hosts(S.CODE_HOSTS)}) AS is_code, ({_or_hosts(S.DATA_HOSTS)}) AS is_data, count(*) AS n FROM (SELECT {_HOST} AS host FROM (SELECT CASE WHEN strpos(x, '://') > 0 THEN x ELSE 'https://' || x END AS u FROM (SELECT trim(unnest(resource_urls)) AS x FROM paper_catalog))) GROUP BY ALL",
    "n12_alias": """SELECT cat_no, CAST(CASE WHEN len(string_split_regex(short, '\\s+')) <= 3 AND length(short) <= 40 AND strpos(title, '(') = 0 AND regexp_matches(short, '[A-Z0-9]') THEN 2 ELSE 0 END AS INTEGER) AS n_aliases
FROM (SELECT cat_no, title, coalesce(venue, 'none') AS short FROM paper_catalog)""",
    "n15_cache_key": "SELECT doc_id, 'model-x-1:' || substr(sha256(text), 1, 16) AS cache_key FROM documents",
    "n16_headline_overlap": f"""SELECT cat_no, CAST(len(list_intersect(list_distinct(list_filter(string_split({norm_sql('title')}, ' '), lambda w: length(w) > 3)),
  list_distinct(list_filter(string_split({norm_sql('central_contribution')}, ' '), lambda w: length(w) > 3)))) AS INTEGER) AS overlap FROM paper_catalog WHERE title IS NOT NULL AND central_contribution IS NOT NULL""",
    "n17_embed_text": """SELECT DISTINCT paper_id, unit_id, paper_id || ' | ' || CASE WHEN kind <> '' THEN type || '/' || kind ELSE type END || ': ' || coalesce(name, unit_id)
  || CASE WHEN t <> '' THEN ' — ' || t ELSE '' END AS embed_text FROM (
SELECT *, CASE WHEN type = 'Finding' THEN coalesce(description, '') ELSE coalesce(nullif(description, ''), nullif(name, ''), '') END AS t FROM graph_units WHERE op = 'upsert')""",
    "n18_unit_label": """SELECT unit_id, CASE WHEN length(x) > 30 THEN left(x, 30) || '…' ELSE x END AS label FROM (
SELECT unit_id, coalesce(nullif(name, ''), nullif(description, ''), unit_id) AS x FROM graph_units)""",
    "n19_alnum": "SELECT cat_no, coalesce(lower(regexp_replace(title, '[^\\p{L}\\p{N}]', '', 'g')), '') AS alnum FROM paper_catalog",
    "n22_marker_grammar": "SELECT relation_no, marker, regexp_full_match(marker, '§([0-9]+|[A-Za-z]+)') AS is_marker FROM (SELECT relation_no, unnest(provenance) AS marker FROM relations)",
    "n24_paper_key": "SELECT cat_no, '06_extraction' AS stem, paper_id AS key_by_dir, paper_id AS key_by_stem FROM paper_catalog",
    "n25_title_prefixes": """SELECT cat_no, coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'),
  lambda x: length(x) >= 4 AND x NOT IN ('with', 'from', 'that', 'this', 'using', 'based', 'towards', 'learning')), lambda x: left(x, 5)))), ' '), '') AS prefixes FROM paper_catalog""",
    "n26_cost": "SELECT event_id, CAST(floor(value * 100) - floor(value * 30) + 4 * floor(value * 10) AS BIGINT) AS effective FROM events",
    "n28_marker_order": "SELECT row_no, coalesce(try_cast(nullif(regexp_extract(table_marker, '([0-9]+)', 1), '') AS BIGINT), 1000000000) AS marker_no FROM result_rows",
}
ORACLE["n24_paper_key"] = "SELECT cat_no, paper_id AS key_by_dir, paper_id AS key_by_stem FROM paper_catalog"
ORACLE |= {
    "n14_formula_key": f"SELECT unit_id, regexp_replace(description, '\\s+', '', 'g') AS formula_key FROM graph_units",
}

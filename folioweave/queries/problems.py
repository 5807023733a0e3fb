"""Queries of the general data-processing problems 1, 2, 4 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.functions import ids
from folioweave.operators import hierarchy, nested, orphans, quantities
from folioweave.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.measure_scores(table(spark, sf_dir, "extractions"))


def _p1_level(level: str):
    return lambda spark, sf_dir: nested.flatten_level(table(spark, sf_dir, "extractions"), level)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    return quantities.other_units(t("result_rows"), t("unit_refs"), t("metric_refs"), "row_no")


def p2_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number of result_rows in the common unit of its quantity."""
    t = lambda name: table(spark, sf_dir, name)
    return quantities.convert(t("result_rows"), t("unit_refs"), t("metric_refs"), ["row_no"]).dropDuplicates()


def p2_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number in the scores of the Measures of extractions in the common unit of its quantity."""
    t = lambda name: table(spark, sf_dir, name)
    scores = nested.flatten_level(t("extractions"), "scores").where((F.col("type") == "Measure") & F.col("is_object"))
    key = ["record_key", "extraction_no", "section_no", "unit_no", "unit_id", "score_no"]
    return quantities.convert(scores, t("unit_refs"), t("metric_refs"), key, value="value", metric="name", metric_norm=None, caption=None)


def _endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per endpoint of a relation with its canonical key; blank endpoints are left out."""
    rel = table(spark, sf_dir, "relations").select("relation_no", "paper_id", "source_id", "target_id", "recorded_at")
    ends = rel.select(
        "relation_no",
        "paper_id",
        "recorded_at",
        F.explode(F.create_map(F.lit("source"), "source_id", F.lit("target"), "target_id")).alias("endpoint", "id"),
    )
    return ends.where(~ids.is_blank(F.col("id"))).select(
        F.col("relation_no").alias("ref_id"),
        F.col("endpoint").alias("which"),
        F.struct("paper_id", ids.canonical(F.col("id")).alias("unit_id")).alias("key"),
        F.col("recorded_at").alias("at"),
    )


def _p4_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "graph_units")
    changes = units.select(
        F.struct("paper_id", ids.canonical(F.col("unit_id")).alias("unit_id")).alias("key"),
        F.col("changed_at").alias("at"),
        (F.col("op") != "delete").alias("up"),
    )
    return orphans.orphan_references(_endpoints(spark, sf_dir), changes)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _p4_orphans(spark, sf_dir)
    return found.select(F.col("ref_id").alias("relation_no"), F.col("which").alias("endpoint")).dropDuplicates()


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan endpoints and all endpoints per table, endpoint and month of recorded_at."""
    month = F.date_format(F.col("at"), "yyyy-MM").alias("month")
    every = _endpoints(spark, sf_dir).dropDuplicates(["ref_id", "which"]).groupBy("which", month).agg(F.count(F.lit(1)).alias("n_endpoints"))
    lost = _p4_orphans(spark, sf_dir).dropDuplicates(["ref_id", "which"]).groupBy("which", month).agg(F.count(F.lit(1)).alias("n_orphans"))
    return every.join(lost, ["which", "month"], "left").select(
        F.lit("relations").alias("table_name"),
        F.col("which").alias("endpoint"),
        "month",
        "n_endpoints",
        F.coalesce("n_orphans", F.lit(0).cast("bigint")).alias("n_orphans"),
    )


def _part_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = table(spark, sf_dir, "relations").where(F.col("relation") == "part_of")
    return rel.where(~ids.is_blank(F.col("source_id")) & ~ids.is_blank(F.col("target_id"))).select(
        F.col("paper_id").alias("group_id"),
        ids.canonical(F.col("source_id")).alias("child"),
        ids.canonical(F.col("target_id")).alias("parent"),
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.hierarchy(_part_of(spark, sf_dir), all_nodes=True).select(
        F.col("group_id").alias("paper_id"), F.col("node").alias("unit_id"), F.col("root").alias("root_id"), "depth"
    )


def p5_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hierarchy.paths(_part_of(spark, sf_dir), all_nodes=True)
    return h.select(
        F.col("group_id").alias("paper_id"),
        F.col("node").alias("unit_id"),
        F.col("parent").alias("parent_id"),
        F.col("root").alias("root_id"),
        "depth",
        F.array_join("path", " / ").alias("path"),
        "n_descendants",
        "on_cycle",
    )


def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = hierarchy.descendant_pairs(_part_of(spark, sf_dir))
    return pairs.select(F.col("group_id").alias("paper_id"), F.col("ancestor").alias("ancestor_id"), F.col("descendant").alias("descendant_id"), "distance")


QUERIES = {
    "p1_found": p1_found,
    "p1_records": _p1_level("records"),
    "p1_sections": _p1_level("sections"),
    "p1_units": _p1_level("units"),
    "p1_scores": _p1_level("scores"),
    "p2_found": p2_found,
    "p2_values": p2_values,
    "p2_measures": p2_measures,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p5_found": p5_found,
    "p5_paths": p5_paths,
    "p5_descendants": p5_descendants,
}




def _JD(j):  # noqa: N802
    """``j``, or the JSON inside it where it is a string that holds some."""
    return f"CASE WHEN json_type({j}) = 'VARCHAR' AND json_valid({j}->>'$') THEN CAST({j}->>'$' AS JSON) ELSE {j} END"


def _JL(j):  # noqa: N802
    """A list as it is, anything else as a list of one."""
    return f"CASE WHEN json_type({j}) = 'ARRAY' THEN CAST({j} AS JSON[]) ELSE [{j}] END"


def _JM(j):  # noqa: N802
    """The elements of a list or the values of an object."""
    return f"CASE WHEN json_type({j}) = 'ARRAY' THEN CAST({j} AS JSON[]) WHEN json_type({j}) = 'OBJECT' THEN json_extract({j}, '$.*') ELSE [] END"


_ALIAS = "CASE WHEN p IN ('setting', 'set', 'ent') THEN 'exp' WHEN p = 'met' THEN 'mea' WHEN p = 'clm' THEN 'fnd' WHEN p = 'ctx' THEN 'prb' ELSE p END"


def canon_sql(col: str) -> str:
    """The canonical id of ``col`` in DuckDB SQL."""
    head, rest = f"split_part({col}, ':', 1)", f"substr({col}, strpos({col}, ':') + 1)"
    slug = f"regexp_replace(regexp_replace(lower({rest}), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g')"
    alias = _ALIAS.replace("CASE WHEN p ", f"CASE WHEN {head} ").replace("WHEN p = ", f"WHEN {head} = ").replace("ELSE p ", f"ELSE {head} ")
    return f"CASE WHEN strpos({col}, ':') > 0 THEN {alias} || ':' || coalesce(nullif({slug}, ''), {rest}) ELSE {col} END"


_ENDS = f"""ends AS (
  SELECT DISTINCT relation_no, endpoint, paper_id, recorded_at, {canon_sql("id")} AS unit_id FROM (
    SELECT relation_no, paper_id, recorded_at, 'source' AS endpoint, source_id AS id FROM relations
    UNION ALL SELECT relation_no, paper_id, recorded_at, 'target', target_id FROM relations)
  WHERE trim(id, ' \t\n\r\f\v' || chr(160)) <> ''),
moves AS (
  SELECT paper_id, {canon_sql("unit_id")} AS unit_id, changed_at, bool_or(op = 'delete') AS gone FROM graph_units GROUP BY ALL),
state AS (
  SELECT e.*, coalesce(m.gone, true) AS orphan FROM ends e ASOF LEFT JOIN moves m
  ON e.paper_id = m.paper_id AND e.unit_id = m.unit_id AND e.recorded_at >= m.changed_at)"""

_TREE = f"""links AS (
  SELECT paper_id, child, min(parent) AS parent FROM (
    SELECT paper_id, {canon_sql("source_id")} AS child, {canon_sql("target_id")} AS parent FROM relations
    WHERE relation = 'part_of' AND trim(source_id, ' \t\n\r\f\v' || chr(160)) <> '' AND trim(target_id, ' \t\n\r\f\v' || chr(160)) <> '')
  GROUP BY ALL),
nodes AS (SELECT paper_id, child AS node FROM links UNION SELECT paper_id, parent FROM links),
tree AS (
  SELECT paper_id, node, node AS root, 0 AS depth, node AS path FROM nodes n
  WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.paper_id = n.paper_id AND l.child = n.node)
  UNION ALL
  SELECT l.paper_id, l.child, t.root, t.depth + 1, t.path || ' / ' || l.child FROM tree t JOIN links l ON l.paper_id = t.paper_id AND l.parent = t.node)"""

_BELOW = """up AS (SELECT paper_id, child AS d, parent AS a FROM links UNION SELECT x.paper_id, x.d, l.parent FROM up x JOIN links l ON l.paper_id = x.paper_id AND l.child = x.a),
cyc AS (SELECT paper_id, d AS node FROM up WHERE d = a),
own AS (SELECT * FROM links l WHERE NOT EXISTS (SELECT 1 FROM cyc c WHERE c.paper_id = l.paper_id AND c.node = l.child)),
anc AS (SELECT paper_id, child AS d, parent AS a, 1 AS k FROM own UNION SELECT x.paper_id, x.d, l.parent, k + 1 FROM anc x JOIN own l ON l.paper_id = x.paper_id AND l.child = x.a)"""

ORACLE: dict[str, str] = {
    "p4_found": f"WITH {_ENDS} SELECT relation_no, endpoint FROM state WHERE orphan",
    "p4_report": f"""WITH {_ENDS} SELECT 'relations' AS table_name, endpoint, strftime(recorded_at, '%Y-%m') AS month,
  count(*) AS n_endpoints, count(*) FILTER (WHERE orphan) AS n_orphans FROM state GROUP BY ALL""",
    "p5_found": f"""WITH RECURSIVE {_TREE} SELECT n.paper_id, n.node AS unit_id, coalesce(t.root, '') AS root_id,
  CAST(coalesce(t.depth, -1) AS INTEGER) AS depth FROM nodes n LEFT JOIN tree t ON t.paper_id = n.paper_id AND t.node = n.node""",
    "p5_paths": f"""WITH RECURSIVE {_TREE}, {_BELOW}, cnt AS (SELECT paper_id, a AS node, count(DISTINCT d) AS n FROM anc GROUP BY ALL)
SELECT n.paper_id, n.node AS unit_id, l.parent AS parent_id, coalesce(t.root, '') AS root_id, CAST(coalesce(t.depth, -1) AS INTEGER) AS depth, coalesce(t.path, '') AS path,
coalesce(b.n, 0) AS n_descendants, c.node IS NOT NULL AS on_cycle
FROM nodes n LEFT JOIN tree t ON t.paper_id = n.paper_id AND t.node = n.node LEFT JOIN links l ON l.paper_id = n.paper_id AND l.child = n.node
LEFT JOIN cyc c ON c.paper_id = n.paper_id AND c.node = n.node LEFT JOIN cnt b ON b.paper_id = n.paper_id AND b.node = n.node""",
    "p1_found": f"""WITH d0 AS (SELECT DISTINCT record_no, CAST(payload AS JSON) AS j FROM extractions WHERE json_valid(payload)),
d1 AS (SELECT record_no, {_JD("j")} AS j FROM d0), d2 AS (SELECT record_no, unnest({_JL("j")}) AS j FROM d1), d3 AS (SELECT record_no, {_JD("j")} AS j FROM d2),
d4 AS (SELECT record_no, CASE WHEN (j->'sections') IS NULL THEN {_JD("coalesce(j->'06_extraction', j->'extraction', j->'result', j)")} ELSE j END AS j FROM d3), d5 AS (SELECT record_no, unnest({_JL("j")}) AS j FROM d4),
s0 AS (SELECT record_no, j FROM d5 UNION ALL SELECT record_no, {_JD("x")} FROM (SELECT record_no, unnest({_JM(_JD("j->'sections'"))}) AS x FROM d5)),
s1 AS (SELECT record_no, CASE WHEN json_type(j->'section') = 'OBJECT' THEN j->'section' ELSE j END AS j FROM s0 WHERE json_type(j) = 'OBJECT'),
u0 AS (SELECT record_no, {_JD("x")} AS u, t FROM (SELECT record_no, unnest({_JM(_JD("j->'units'"))}) AS x, NULL AS t FROM s1
  UNION ALL SELECT record_no, unnest({_JM(_JD("j->'measures'"))}), 'Measure' FROM s1)),
u1 AS (SELECT record_no, u->>'id' AS unit_id, {_JD("u->'scores'")} AS sc FROM u0 WHERE json_type(u) = 'OBJECT' AND coalesce(u->>'type', t) = 'Measure'),
sc AS (SELECT record_no, unit_id, unnest({_JL("sc")}) AS e, generate_subscripts({_JL("sc")}, 1) - 1 AS score_no FROM u1 WHERE json_type(sc) IN ('ARRAY', 'OBJECT'))
SELECT DISTINCT record_no, unit_id, CAST(score_no AS INTEGER) AS score_no FROM sc WHERE json_type({_JD("e")}) = 'OBJECT'""",
    "p5_descendants": f"WITH RECURSIVE {_TREE}, {_BELOW} SELECT paper_id, a AS ancestor_id, d AS descendant_id, CAST(k AS INTEGER) AS distance FROM anc",
}


def _quantities_sql() -> str:
    """The conversion of result_rows in DuckDB SQL, with the same fixed tables."""
    q = quantities
    lit = lambda x: "'" + x.replace("'", "''") + "'"
    aliases = "al AS (SELECT * FROM (VALUES " + ", ".join(f"({lit(a)}, {lit(b)}, {lit(c)})" for a, b, c in q.alias_rows()) + ") AS t(quantity, alias, unit_code))"

    def clean(x: str) -> str:
        x = f"regexp_replace(lower({x}), '[*†‡]+', ' ', 'g')"
        x = f"regexp_replace({x}, {lit(r'^\s*(?:unit\s*:)?[\s(\[-]*(?:(?:on|as|in)\s+(?:an?\s+)?)?')}, '')"
        x = f"regexp_replace({x}, {lit(r'\s*\(0\s*(?:\.\.|-)\s*1\)\s*$')}, '')"
        return f"regexp_replace(regexp_replace({x}, {lit(r'[\s)\]]+$')}, ''), {lit(r'\s+')}, ' ', 'g')"

    cases = []
    for name, topic in q.CAPTION_TOPICS.items():
        units = q._alias_pattern(name)
        after = rf"(?:^|[^\p{{L}}0-9])(?:{topic})(?:[^\p{{L}}0-9;,][^;,]*?)??[\s(\[]({units})(?:[^\p{{L}}0-9/]|$)"
        found = f"nullif(regexp_extract(cap, {lit(after)}, 1), '')"
        if name == "share":
            found = f"coalesce(nullif(regexp_extract(cap, {lit(rf'(?:^|[\s(\[])({units})\s+throughout\b')}, 1), ''), {found})"
        cases.append(f"WHEN {lit(name)} THEN {found}")
    number = lambda k: f"regexp_replace(regexp_extract(value_raw, {lit(q.NUMBER)}, {k}), '[−–]', '-', 'g')"
    value = f"try_cast(replace({number(1)}, ',', '') || 'e' || coalesce(nullif({number(2)}, ''), nullif({number(3)}, ''), '0') AS DOUBLE)"
    joins = " ".join(f"LEFT JOIN al a{k} ON a{k}.quantity = w.quantity AND a{k}.alias = w.w{k}" for k in range(1, 5))
    return f"""WITH {aliases},
mn AS (SELECT string_agg(metric_norm, '|' ORDER BY length(metric_norm) DESC) AS rx FROM (SELECT DISTINCT metric_norm FROM metric_refs WHERE metric_norm IS NOT NULL)),
x AS (SELECT DISTINCT row_no, value_raw, metric, lower(table_caption) AS cap, unit, {value} AS value,
  regexp_extract(' ' || trim(regexp_replace(lower(coalesce(metric_norm, metric)), '[^a-z0-9]+', ' ', 'g')) || ' ', ' (' || (SELECT rx FROM mn) || ') ', 1) AS name FROM result_rows),
b AS (SELECT x.*, m.quantity FROM x JOIN (SELECT DISTINCT metric_norm, quantity FROM metric_refs WHERE quantity IS NOT NULL) m ON m.metric_norm = x.name WHERE value IS NOT NULL),
w AS (SELECT *, {clean(f"regexp_extract(value_raw, {lit(q._AFTER)}, 6)")} AS w1, {clean(f"regexp_extract(metric, {lit(q._METRIC_TAIL)}, 1)")} AS w2,
  regexp_replace(CASE quantity {' '.join(cases)} END, {lit(r'\s+')}, ' ', 'g') AS w3, {clean('unit')} AS w4 FROM b),
s AS (SELECT w.row_no, w.quantity, w.value, coalesce(a1.unit_code, a2.unit_code, a3.unit_code, a4.unit_code, CASE WHEN w.quantity = 'share' AND w.value <= 1 THEN 'frac' ELSE c.unit_code END) AS unit_code,
  CASE WHEN a1.unit_code IS NOT NULL THEN 'value' WHEN a2.unit_code IS NOT NULL THEN 'metric' WHEN a3.unit_code IS NOT NULL THEN 'caption' WHEN a4.unit_code IS NOT NULL THEN 'unit' ELSE 'default' END AS stated_by, c.unit_code AS common_unit
  FROM w {joins} JOIN (SELECT quantity, unit_code FROM unit_refs WHERE is_common) c ON c.quantity = w.quantity)"""


_QUANTITIES = _quantities_sql()
ORACLE |= {
    "p2_found": f"{_QUANTITIES} SELECT DISTINCT row_no, unit_code FROM s WHERE unit_code <> common_unit",
    "p2_values": f"{_QUANTITIES} SELECT DISTINCT s.row_no, s.quantity, s.value, s.unit_code, stated_by, common_unit, s.value * u.factor + u.shift AS common_value FROM s JOIN unit_refs u ON u.quantity = s.quantity AND u.unit_code = s.unit_code",
}

"""The rule groups of the validation as queries, and SQL for them and for other whole-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import vocab
from folioweave.functions.scalar import MARKER_GRAMMAR, TITLE_STOPWORDS
from folioweave.operators import validate
from folioweave.plans import views as V
from folioweave.queries.assembly import _E, _N, _S, _U, _VALID, _in, _with
from folioweave.queries.corpus import _P
from folioweave.queries.problems import _JD, _JL, canon_sql
from folioweave.queries.records import _ARRAYS, _HOST, _JO, _PT, PAY, graph
from folioweave.queries.texts import _BLOCKS


def _captured(s, d):
    """(paper_id, marker) of the blocks that hold a table."""
    return V.paper_blocks(s, d).where("text rlike '(?i)<table'").select("paper_id", "marker")


def _faults(fn):
    return lambda s, d: fn(graph(s, d), s, d).select("paper_id", "rule", "subject").dropDuplicates()


QUERIES = {
    "v1_records": _faults(lambda g, s, d: validate.record_faults(g)),
    "v2_units": _faults(lambda g, s, d: validate.unit_faults(g)),
    "v4_references": _faults(lambda g, s, d: validate.reference_faults(g)),
    "v5_sections": _faults(lambda g, s, d: validate.section_faults(g)),
    "v6_edges": _faults(lambda g, s, d: validate.edge_faults(g)),
    "v9_record_markers": _faults(lambda g, s, d: validate.marker_faults(g, _captured(s, d))),
    "v10_census": _faults(lambda g, s, d: validate.census_faults(g, V.nodes(s, d))),
    "v_record_issues": _faults(lambda g, s, d: validate.issues(g, V.nodes(s, d), _captured(s, d))),
}

_GRAMMAR = MARKER_GRAMMAR.replace("'", "''")
_W = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
_BLANK = lambda x: f"coalesce({x}, '') = ''"
_OUT = lambda x, words: f"({x} IS NOT NULL AND {x} NOT IN {_in(words)})"
_UNLISTED = lambda v, k: f"coalesce(json_type({v}->'{k}'), '') <> 'ARRAY'"
_TEXTS = lambda v, k: f"CASE WHEN json_type({v}->'{k}') = 'ARRAY' THEN list_transform(CAST({v}->'{k}' AS JSON[]), lambda e: e->>'$') WHEN json_type({v}->'{k}') NOT IN ('OBJECT', 'NULL') THEN [{v}->>'{k}'] ELSE [] END"
_BAD_MARKS = lambda v: f"len(list_filter({_TEXTS(v, 'provenance')}, lambda m: NOT regexp_matches(m, '{_GRAMMAR}'))) > 0"


def _rules(source: str, subject: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ".join(f"SELECT paper_id, '{rule}' AS rule, CAST({subject} AS VARCHAR) AS subject FROM {source} WHERE coalesce({when}, false)" for rule, when in rules)


_HAS = lambda k: f"list_contains(ks, '{k}')"
_D = """d AS (SELECT paper_id, j, coalesce(json_keys(j), []) AS ks, CASE WHEN json_type(j->'document') = 'OBJECT' THEN json_keys(j->'document') ELSE [] END AS dk, coalesce(j->'document'->>'doc_id', j->>'doc_id') AS doc_id,
  j->'document'->>'title' AS title, j->'document'->>'type' AS dt, j->'document'->>'kind' AS dkind, CASE WHEN json_type(j->'extraction_notes') = 'OBJECT' THEN json_keys(j->'extraction_notes') ELSE [] END AS nk,
  coalesce(j->'extraction_notes'->>'ir_version', j->'document'->>'ir_version') AS ver, j->'extraction_notes'->>'input_mode' AS im, j->'extraction_notes' AS nt FROM pd)"""
_UK = "CASE type " + " ".join(f"WHEN '{t}' THEN {_W(k)}" for t, k in vocab.UNIT_KEYS.items()) + " ELSE [] END"
_ALLOWED = " OR ".join(f"(section = '{s}' AND type IN {_in(t)})" for s, t in vocab.SECTION_UNIT_TYPES.items())
_FORMULA = lambda test: f"(json_type({_JD('u->' + chr(39) + 'formulas' + chr(39))}) IN ('ARRAY', 'OBJECT') AND len(list_filter({_JL(_JD('u->' + chr(39) + 'formulas' + chr(39)))}, lambda f: json_type(f) = 'OBJECT' AND {test})) > 0)"
_FAM, _MEA = "type IN ('Contribution', 'Component')", "type = 'Measure'"
_UT = _in(vocab.UNIT_TYPES)

_UNIT_RULES = [
    ("V2 id", "NOT coalesce(regexp_full_match(id, '[a-z][a-z0-9_]*:[a-z0-9_]+'), false)"), ("V2 type", f"type IS NULL OR type NOT IN {_UT}"), ("V2 retired type", f"type IN {_in(vocab.RETIRED_TYPES)}"),
    ("V2 prefix", f"type IN {_in(vocab.ID_PREFIX)} AND split_part(id, ':', 1) <> CASE type {' '.join(f'WHEN {chr(39)}{t}{chr(39)} THEN {chr(39)}{p}{chr(39)}' for t, p in vocab.ID_PREFIX.items())} END"),
    ("V2 fields", f"type IN {_UT} AND len(list_filter(json_keys(u), lambda k: NOT list_contains({_UK}, k))) > 0"), ("V2 section type", "list_contains(json_keys(u), 'section_type')"),
    ("V3 list", _UNLISTED("u", "provenance")), ("V3 empty", "type IN ('Finding', 'Measure') AND json_type(u->'provenance') = 'ARRAY' AND json_array_length(u->'provenance') = 0"), ("V3 marker", _BAD_MARKS("u")),
    ("V4 kind missing", f"type IN {_in(vocab.KINDS_BY_TYPE)} AND {_BLANK('kind')}"), ("V4 kind", f"type IN {_in(vocab.KINDS_BY_TYPE)} AND kind <> '' AND NOT coalesce({_VALID.format(k='kind')}, false)"),
    ("V4 name", f"type IN ('Contribution', 'Component', 'ExperimentSetup', 'Measure') AND {_BLANK('u->>' + chr(39) + 'name' + chr(39))}"), ("V4 method kind", f"{_FAM} AND {_OUT('u->>' + chr(39) + 'method_kind' + chr(39), vocab.METHOD_KINDS)}"),
    ("V4 expression", f"{_FAM} AND {_FORMULA(_BLANK('f->>' + chr(39) + 'expression' + chr(39)))}"), ("V4 formula role", f"{_FAM} AND {_FORMULA(_OUT('f->>' + chr(39) + 'role' + chr(39), vocab.FORMULA_ROLES))}"),
    ("V4 statement", "type = 'Finding' AND coalesce(u->>'statement', '') = ''"), ("V4 polarity", f"type = 'Finding' AND {_OUT('u->>' + chr(39) + 'polarity' + chr(39), vocab.POLARITIES)}"),
    ("V4 description", "type = 'Problem' AND coalesce(u->>'description', '') = ''"), ("V4 unit", f"{_MEA} AND coalesce(u->>'unit', '') = ''"), ("V4 scores", f"{_MEA} AND {_UNLISTED('u', 'scores')}"),
    ("V4 no scores", f"{_MEA} AND json_type(u->'scores') = 'ARRAY' AND json_array_length(u->'scores') = 0 AND coalesce(u->>'source_table_marker', '') = ''"),
    ("V4 setups missing", f"{_MEA} AND NOT list_contains(json_keys(u), 'setup_ids')"), ("V4 setups list", f"{_MEA} AND list_contains(json_keys(u), 'setup_ids') AND {_UNLISTED('u', 'setup_ids')}"),
    ("V4 direction", f"{_MEA} AND {_OUT('u->>' + chr(39) + 'comparison_direction' + chr(39), vocab.DIRECTIONS)}"), ("V4 objective class", f"{_MEA} AND {_OUT('u->>' + chr(39) + 'objective_class' + chr(39), vocab.OBJECTIVE_CLASSES)}"),
    ("V4 table role", f"{_MEA} AND {_OUT('u->>' + chr(39) + 'table_role' + chr(39), vocab.TABLE_ROLES)}"), ("V4 findings list", f"{_MEA} AND list_contains(json_keys(u), 'finding_ids') AND {_UNLISTED('u', 'finding_ids')}"),
    ("V5 type in section", f"section IN {_in(vocab.SECTION_ORDER)} AND NOT coalesce({_ALLOWED}, false)"),
]
_IX = "ix AS (SELECT * FROM (SELECT paper_id, id, type, kind, i, section, row_number() OVER (PARTITION BY paper_id, id ORDER BY o) AS k FROM pu WHERE id IS NOT NULL) WHERE k = 1)"
_REFS = " UNION ALL ".join(f"SELECT paper_id, i, measure_id AS id, '{f}' AS field, x->>'{f}' AS ref FROM pc WHERE type = 'Measure' AND x->>'{f}' <> ''" for f in ("system_id", "setup_id", "opponent_id", "judge_id"))
_REFS += " UNION ALL " + " UNION ALL ".join(f"SELECT paper_id, i, id, '{f}', unnest({_TEXTS('u', f)}) FROM pu WHERE type = 'Measure'" for f in ("setup_ids", "finding_ids"))
_RJ = f"""rj AS (SELECT r.paper_id, r.id, field, ref, ix.type AS type, ix.kind AS kind, EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = r.paper_id AND pu.i = r.i AND pu.id = r.ref) AS here FROM ({_REFS}) r LEFT JOIN ix ON ix.paper_id = r.paper_id AND ix.id = r.ref)"""
_SETUP = "field IN ('setup_id', 'setup_ids')"
_RIGHT = f"CASE WHEN field IN ('system_id', 'opponent_id') THEN {_FAM} WHEN field = 'judge_id' THEN type IN ('Contribution', 'Component', 'ExperimentSetup') WHEN field = 'finding_ids' THEN type = 'Finding' ELSE {_HOST} END"
_SOURCES, _TARGETS = (" OR ".join(f"(relation = '{r}' AND {c} IN {_in(m[k])})" for r, m in vocab.RELATION_MATRIX.items()) for k, c in ((0, "st"), (1, "tt")))
_PE = f"""pj AS (SELECT paper_id, x FROM (SELECT paper_id, unnest(CASE WHEN json_type({_JD("j->'relations'")}) = 'ARRAY' THEN CAST({_JD("j->'relations'")} AS JSON[]) ELSE [] END) AS x FROM pd) WHERE json_type(x) = 'OBJECT'),
pe2 AS (SELECT p.paper_id, x, x->>'source_id' AS source_id, x->>'relation' AS relation, x->>'target_id' AS target_id, a.type AS st, b.type AS tt FROM pj p LEFT JOIN ix a ON a.paper_id = p.paper_id AND a.id = x->>'source_id' LEFT JOIN ix b ON b.paper_id = p.paper_id AND b.id = x->>'target_id')"""
_COV = "cv AS (SELECT DISTINCT paper_id, v AS id FROM (SELECT s.paper_id, unnest(" + _TEXTS("j", "covers_entries") + ") AS v FROM s1 s SEMI JOIN ps ON ps.paper_id = s.paper_id AND ps.i = s.i) WHERE v IS NOT NULL)"

ORACLE = {
    "v1_records": f"WITH {PAY}, {_D} " + _rules("d", "doc_id", [
        *(("V1 missing key", f"NOT {_HAS(k)}") for k in vocab.TOP_KEYS), ("V1 unexpected key", f"len(list_filter(ks, lambda k: NOT list_contains({_W(vocab.TOP_KEYS)}, k))) > 0"), ("V1 retired field", "list_contains(dk, 'paradigm_tags')"),
        ("V2 document type", f"{_HAS('document')} AND coalesce(dt, '') <> 'Document'"), ("V4 document field", f"{_HAS('document')} AND ({_BLANK('doc_id')} OR {_BLANK('title')})"),
        ("V4 document kind", f"{_HAS('document')} AND (dkind IS NULL OR dkind NOT IN {_in(vocab.DOCUMENT_KINDS)})"), ("V6 relations list", f"{_HAS('relations')} AND {_UNLISTED('j', 'relations')}"), ("V8 notes", f"NOT {_HAS('extraction_notes')}"),
        ("V8 notes key", f"{_HAS('extraction_notes')} AND len(list_filter({_W(vocab.NOTE_KEYS)}, lambda k: NOT list_contains(nk, k))) > 0"), ("V8 input mode", f"{_HAS('extraction_notes')} AND coalesce(im, '') <> '{vocab.INPUT_MODE}'"),
        ("V8 version", f"ver IS NULL OR ver NOT IN {_in(vocab.ACCEPTED_VERSIONS)}"), ("V8 sections used", f"len(list_filter({_TEXTS('nt', 'sections_used')}, lambda k: NOT list_contains({_W(vocab.SECTION_ORDER)}, k))) > 0"),
    ]),
    "v2_units": f"WITH {PAY} " + _rules("pu", "id", _UNIT_RULES) + " UNION SELECT paper_id, 'V2 repeated id', id FROM pu WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "v4_references": f"WITH {PAY}, {_IX}, {_RJ} " + _rules("rj", "id", [
        ("V4 unknown reference", "type IS NULL"), ("V4 reference not local", f"{_SETUP} AND type IS NOT NULL AND NOT here"), ("V4 reference type", f"type IS NOT NULL AND NOT ({_SETUP} AND NOT here) AND NOT coalesce({_RIGHT}, false)"),
    ]) + " UNION " + _rules("(SELECT *, json_type(x) = 'OBJECT' AS ob FROM pc) z", "measure_id", [
        ("V4 score object", f"{_MEA} AND NOT coalesce(ob, false)"), ("V4 variant", f"{_MEA} AND ob AND coalesce(x->>'variant', '') = ''"), ("V4 value", f"{_MEA} AND ob AND x->>'value' IS NULL"),
        ("V4 variance", f"{_MEA} AND ob AND x->>'variance' IS NULL"), ("V4 value kind", f"{_MEA} AND ob AND {_OUT('x->>' + chr(39) + 'value_kind' + chr(39), vocab.VALUE_KINDS)}"),
    ]),
    "v5_sections": f"""WITH {PAY}, {_IX}, sx AS (SELECT ps.*, s1.j, row_number() OVER (PARTITION BY ps.paper_id ORDER BY ps.i) - 1 AS section_no, ix.type AS aty, EXISTS (SELECT 1 FROM pu WHERE pu.paper_id = ps.paper_id AND pu.i = ps.i AND pu.id = ps.anchor_id) AS here
FROM ps JOIN s1 ON s1.paper_id = ps.paper_id AND s1.i = ps.i LEFT JOIN ix ON ix.paper_id = ps.paper_id AND ix.id = ps.anchor_id) """ + _rules("sx", "section_no", [
        ("V5 fields", f"len(list_filter(json_keys(j), lambda k: NOT list_contains({_W(vocab.SECTION_KEYS)}, k))) > 0"), ("V5 section type", f"section IS NULL OR section NOT IN {_in(vocab.SECTION_ORDER)}"), ("V5 anchor missing", "anchor_id IS NULL"),
        ("V5 anchor unknown", "anchor_id IS NOT NULL AND aty IS NULL"), ("V5 anchor not local", "aty IS NOT NULL AND NOT here"), ("V5 anchor document", "aty IS NOT NULL AND here AND aty = 'Document'"), ("V5 covers", _UNLISTED("j", "covers_entries")),
    ]),
    "v6_edges": f"WITH {PAY}, {_IX}, {_PE} " + _rules("pe2", "concat_ws(' ', source_id, relation, target_id)", [
        ("V6 source", "st IS NULL"), ("V6 target", "tt IS NULL"), ("V6 provenance", _UNLISTED("x", "provenance")), ("V6 marker", _BAD_MARKS("x")), ("V6 relation", f"relation IS NULL OR relation NOT IN {_in(vocab.RELATION_MATRIX)}"),
        ("V6 source type", f"relation IN {_in(vocab.RELATION_MATRIX)} AND st IS NOT NULL AND NOT coalesce({_SOURCES}, false)"), ("V6 target type", f"relation IN {_in(vocab.RELATION_MATRIX)} AND tt IS NOT NULL AND NOT coalesce({_TARGETS}, false)"),
    ]) + " UNION SELECT paper_id, 'V7 support', id FROM ix WHERE type = 'Finding' AND coalesce(section, '') <> 'evidence' AND NOT EXISTS (SELECT 1 FROM pe2 WHERE relation = 'supports' AND pe2.paper_id = ix.paper_id AND pe2.target_id = ix.id)",
    "v10_census": f"WITH {PAY}, chg AS (SELECT *, {canon_sql('unit_id')} AS id FROM graph_units), {_N}, {_COV}, pl AS (SELECT DISTINCT paper_id, id FROM n WHERE id IS NOT NULL AND paper_id IN (SELECT paper_id FROM pd)) "
    "SELECT paper_id, 'V10 unknown node' AS rule, id AS subject FROM cv ANTI JOIN pl USING (paper_id, id) UNION SELECT paper_id, 'V10 no unit', id FROM cv ANTI JOIN pu USING (paper_id, id) UNION SELECT paper_id, 'V10 not covered', id FROM pl ANTI JOIN cv USING (paper_id, id)",
}

_CANON_MARK = "CASE WHEN trim(trim(m), '§') <> '' THEN '§' || trim(regexp_replace(trim(m), '^§+', '')) ELSE '' END"
ORACLE["v9_record_markers"] = f"""WITH {PAY}, {_BLOCKS} SELECT DISTINCT paper_id, 'V9 marker' AS rule, id AS subject FROM (SELECT paper_id, id, u->>'source_table_marker' AS m FROM pu WHERE type = 'Measure' AND u->>'source_table_marker' <> '') q
WHERE NOT EXISTS (SELECT 1 FROM blocks k WHERE k.paper_id = q.paper_id AND k.marker = {_CANON_MARK} AND strpos(lower(b), '<table') > 0)"""
ORACLE["v_record_issues"] = " UNION ".join(f"SELECT paper_id, rule, CAST(subject AS VARCHAR) AS subject FROM ({ORACLE[k]})" for k in ("v1_records", "v2_units", "v4_references", "v5_sections", "v6_edges", "v9_record_markers", "v10_census"))

# --- texts ----------------------------------------------------------------------------------

_CLEAN = r"trim(regexp_replace(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g'), '[ \t]{2,}', ' ', 'g'), w)"
_SPACES = "(SELECT ' \t\n\r' || chr(11) || chr(12) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288) AS w)"
_TAB = "(?is)<table\\b.*?</table>"
ORACLE |= {
    "n23_feedback": f"SELECT doc_id, CASE WHEN text IS NOT NULL THEN CAST(least(200, length(regexp_replace(trim(text, w), '[' || w || ']+', ' ', 'g'))) AS INTEGER) END AS n_feedback FROM documents, {_SPACES}",
    "n13_sanitize": f"SELECT doc_id, md5(c) AS digest, CAST(length(c) AS INTEGER) AS n_clean FROM (SELECT doc_id, {_CLEAN} AS c FROM documents, {_SPACES})",
    "block_p17_warnings": f"""WITH t AS (SELECT doc_id, text, lower(text) AS low, len(regexp_extract_all(lower(text), '<table')) AS a, len(regexp_extract_all(lower(text), '</table>')) AS b, regexp_extract_all(lower(text), '{_TAB}') AS ts FROM documents)
SELECT doc_id, 'unbalanced' AS warning FROM t WHERE a <> b UNION ALL SELECT doc_id, 'nested' FROM t WHERE len(list_filter(ts, lambda x: len(regexp_extract_all(x, '<table')) > 1)) > 0
UNION ALL SELECT doc_id, 'pipe_tables' FROM t WHERE len(ts) = 0 AND regexp_matches(text, '(?m)^\\s*\\|?(?:\\s*:?-{{3,}}:?\\s*\\|)+\\s*:?-*\\s*\\|?\\s*$')""",
    "n29_legacy": f"""SELECT DISTINCT record_no, coalesce(CASE WHEN json_valid(payload) THEN regexp_matches(CAST(json(payload) AS VARCHAR), '(^|[^\\\\])"paradigm_tags":|(^|[^\\\\])"(type|unit_type|node_type)":"({"|".join(vocab.RETIRED_TYPES)})"') END, false) AS legacy FROM extractions""",
    "s11_changed": _with(_U, _N, body="""SELECT u.paper_id, u.id FROM u LEFT JOIN n ON n.paper_id = u.paper_id AND n.id = u.id
WHERE n.id IS NULL OR u.section IS DISTINCT FROM n.section OR u.type IS DISTINCT FROM n.type OR u.kind IS DISTINCT FROM n.kind OR u.name IS DISTINCT FROM n.name OR u.description IS DISTINCT FROM n.description"""),
}

# --- issues of the flat tables ------------------------------------------------------------

_S2 = f"""s2 AS (SELECT DISTINCT paper_id, {canon_sql('measure_id')} AS measure_id, {canon_sql('system_id')} AS system_id, {canon_sql('setup_id')} AS setup_id, variant, value_raw, unit, direction, table_role, row_no FROM result_rows WHERE source = 'transcribed'),
sj AS (SELECT s2.*, m.section AS ms, y.id AS yid, y.type AS yt, z.id AS zid, z.type AS zt, z.kind AS zk, z.section AS zs FROM s2 JOIN u m ON m.paper_id = s2.paper_id AND m.id = s2.measure_id AND m.type = 'Measure'
  LEFT JOIN u y ON y.paper_id = s2.paper_id AND y.id = s2.system_id LEFT JOIN u z ON z.paper_id = s2.paper_id AND z.id = s2.setup_id)"""
_FURTHER = " UNION ".join([
    _rules("u", "id", [("kind_missing", f"type IN {_in(vocab.KINDS_BY_TYPE)} AND {_BLANK('kind')}"), ("text_missing", f"type IN ('Finding', 'Problem') AND {_BLANK('description')}"),
        ("no_scores", "type = 'Measure' AND NOT EXISTS (SELECT 1 FROM s2 WHERE s2.paper_id = u.paper_id AND s2.measure_id = u.id)")]),
    _rules("sj", "measure_id", [("unit_missing", _BLANK("unit")), ("variant_missing", _BLANK("variant")), ("value_missing", "value_raw IS NULL"), ("unknown_system", "system_id <> '' AND yid IS NULL"),
        ("system_type", "yid IS NOT NULL AND coalesce(yt NOT IN ('Contribution', 'Component'), true)"), ("unknown_setup", "setup_id <> '' AND zid IS NULL"), ("setup_section", "zid IS NOT NULL AND zs <> ms"),
        ("setup_type", "zid IS NOT NULL AND NOT coalesce(zt = 'ExperimentSetup' OR zt = 'Contribution' AND zk IN ('dataset', 'benchmark'), false)"), ("direction", _OUT("direction", vocab.DIRECTIONS)), ("table_role", _OUT("table_role", vocab.TABLE_ROLES))]),
    """SELECT DISTINCT paper_id, 'table_marker', table_marker FROM result_rows r WHERE paper_id IS NOT NULL AND table_marker <> '' AND NOT EXISTS (SELECT 1 FROM blocks k WHERE k.paper_id = r.paper_id AND k.marker = r.table_marker AND strpos(lower(b), '<table') > 0)""",
    f"SELECT paper_id, 'edge_provenance', {canon_sql('source_id')} FROM relations WHERE provenance IS NULL",
    f"SELECT paper_id, 'ir_version', v FROM (SELECT paper_id, arg_max(struct_pack(v := ir_version), (received_at, record_no)).v AS v FROM extractions WHERE paper_id IS NOT NULL GROUP BY ALL) WHERE v IS NULL OR v NOT IN {_in(vocab.ACCEPTED_VERSIONS)}",
])
from folioweave.queries.assembly import _ISSUES, _MATRIX, _TE  # noqa: E402

ORACLE |= {
    "v4_issues": _with(_U, _S2, _BLOCKS, body=_FURTHER),
    "v11_valid_all": _with(_U, _N, _E, _MATRIX, _TE, _ISSUES, _S2, _BLOCKS, f"f AS ({_FURTHER})", body="""SELECT c.paper_id, coalesce(k, 0) AS n_issues, k IS NULL AS valid FROM (SELECT DISTINCT paper_id FROM paper_catalog) c
LEFT JOIN (SELECT paper_id, count(*) AS k FROM (SELECT paper_id, rule, subject FROM i UNION ALL SELECT paper_id, rule, subject FROM f) GROUP BY ALL) x ON x.paper_id = c.paper_id"""),
    "c4_census": _with(f"chg AS (SELECT *, {canon_sql('unit_id')} AS id FROM graph_units)", """n AS (SELECT paper_id, id, section, type, kind, name, description, cite_keys, changed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY paper_id, id ORDER BY changed_at) AS rn FROM chg WHERE op <> 'delete' AND type <> 'Finding') WHERE rn = 1)""",
        f"pv AS (SELECT paper_id, s AS id, arg_min(provenance, relation_no) AS pr FROM (SELECT DISTINCT relation_no, paper_id, {canon_sql('source_id')} AS s, provenance FROM relations WHERE len(provenance) > 0) GROUP BY ALL)",
        "x AS (SELECT n.*, pr FROM n LEFT JOIN pv ON pv.paper_id = n.paper_id AND pv.id = n.id)",
        "c AS (SELECT paper_id, arg_max(struct_pack(v := central_contribution), exported_at).v AS cc, arg_max(topics, exported_at) AS topics, arg_max(tasks, exported_at) AS tasks FROM paper_catalog GROUP BY ALL)",
        body=_rules("x", "id", [("C4 id", "NOT coalesce(regexp_full_match(id, '[a-z][a-z0-9_]*:[a-z0-9_]+'), false)"), ("C4 type", "coalesce(type NOT IN ('Problem', 'Contribution', 'Component', 'ExperimentSetup'), true)"),
            ("C4 prefix", f"type IN {_in(vocab.ID_PREFIX)} AND split_part(id, ':', 1) <> CASE type {' '.join(f'WHEN {chr(39)}{t}{chr(39)} THEN {chr(39)}{p}{chr(39)}' for t, p in vocab.ID_PREFIX.items())} END"),
            ("C4 kind", f"type IN ('Contribution', 'ExperimentSetup') AND NOT coalesce({_VALID.format(k='kind')}, false)"), ("C4 name", _BLANK("name")), ("C4 description", _BLANK("description")),
            ("C4 cite keys", "len(list_filter(cite_keys, lambda k: coalesce(k, '') = '')) > 0"), ("C4 marker", f"len(list_filter(pr, lambda m: NOT regexp_matches(m, '{_GRAMMAR}'))) > 0")])
        + " UNION " + _rules("c", "paper_id", [("C4 summary", _BLANK("cc")), ("C4 root", "NOT EXISTS (SELECT 1 FROM n WHERE n.paper_id = c.paper_id AND n.type = 'Contribution')"),
            ("C4 facets", "len(list_filter(topics, lambda k: coalesce(k, '') = '')) > 0 OR len(list_filter(tasks, lambda k: coalesce(k, '') = '')) > 0")])),
}

# --- flattened records ------------------------------------------------------------------------

_WRAP = "CASE WHEN (j->'sections') IS NULL THEN coalesce({w}, j) ELSE j END".format(w=_JD("coalesce(j->'06_extraction', j->'extraction', j->'result')"))


def _spread(src: str, to: str, expr: str) -> str:
    """The objects of a list, each with its place."""
    return f"{to} AS (SELECT record_no, {_JD('x')} AS j, n * 1000 + k AS n FROM (SELECT record_no, n, unnest({_JL(expr)}) AS x, generate_subscripts({_JL(expr)}, 1) AS k FROM {src}) WHERE json_type({_JD('x')}) = 'OBJECT')"


_FLAT = f"""y0 AS (SELECT record_no, arg_max(payload, (received_at, payload)) AS payload FROM extractions WHERE record_no IS NOT NULL AND payload IS NOT NULL GROUP BY ALL),
y1 AS (SELECT record_no, {_JD("j")} AS j, 0 AS n FROM (SELECT record_no, CAST(payload AS JSON) AS j FROM y0 WHERE json_valid(payload))), {_spread("y1", "y2", "j")}, {_spread("y2", "y3", _WRAP)}, {_spread("y3", "y4", _WRAP)},
fd AS (SELECT record_no, j, CAST(row_number() OVER (PARTITION BY record_no ORDER BY n) - 1 AS INTEGER) AS extraction_no FROM y4),
t0 AS (SELECT record_no, extraction_no, {_JD("x")} AS j, i FROM (SELECT record_no, extraction_no, unnest({_JO(_JD("j->'sections'"))}) AS x, generate_subscripts({_JO(_JD("j->'sections'"))}, 1) AS i FROM fd) UNION ALL SELECT record_no, extraction_no, j, 1000000 FROM fd),
t1 AS (SELECT record_no, extraction_no, i, CASE WHEN i < 1000000 AND json_type({_JD("j->'section'")}) = 'OBJECT' THEN {_JD("j->'section'")} ELSE j END AS j FROM t0 WHERE json_type(j) = 'OBJECT'),
v0 AS ({" UNION ALL ".join(f'''SELECT record_no, extraction_no, i, {k} * 1000000 + generate_subscripts({_JO(_JD(f"j->'{a}'"))}, 1) AS o, unnest({_JO(_JD(f"j->'{a}'"))}) AS x, {f"'{t}'" if t else "CAST(NULL AS VARCHAR)"} AS t FROM t1''' for k, (a, t) in enumerate(_ARRAYS))}),
v1 AS (SELECT record_no, extraction_no, i, o, u, t FROM (SELECT * EXCLUDE (x), {_JD("x")} AS u FROM v0) WHERE json_type(u) = 'OBJECT'),
fs AS (SELECT record_no, extraction_no, i, j, (SELECT count(*) FROM v1 WHERE v1.record_no = t1.record_no AND v1.extraction_no = t1.extraction_no AND v1.i = t1.i) AS nu FROM t1),
fsn AS (SELECT *, CAST(row_number() OVER (PARTITION BY record_no, extraction_no ORDER BY i) - 1 AS INTEGER) AS section_no FROM fs WHERE j->>'section_type' IS NOT NULL OR j->>'anchor_id' IS NOT NULL OR nu > 0),
fu AS (SELECT v1.*, section_no, CAST(row_number() OVER (PARTITION BY v1.record_no, v1.extraction_no, v1.i ORDER BY o) - 1 AS INTEGER) AS unit_no, u->>'id' AS unit_id, coalesce(u->>'type', t) AS type, {_JD("u->'scores'")} AS sc
  FROM v1 JOIN fsn ON fsn.record_no = v1.record_no AND fsn.extraction_no = v1.extraction_no AND fsn.i = v1.i)"""
ORACLE |= {
    "r1_flatten": f"WITH {_FLAT} SELECT coalesce(s.j->>'section_type', 'none') AS section_type, type, count(*) AS n FROM fu JOIN fsn s ON s.record_no = fu.record_no AND s.extraction_no = fu.extraction_no AND s.section_no = fu.section_no GROUP BY ALL",
    "p1_records": f"WITH {_FLAT} SELECT record_no AS record_key, extraction_no, coalesce(j->'document'->>'doc_id', j->>'doc_id') AS doc_id, j->'document'->>'title' AS title, CAST((SELECT count(*) FROM fsn WHERE fsn.record_no = fd.record_no AND fsn.extraction_no = fd.extraction_no) AS INTEGER) AS n_sections FROM fd",
    "p1_sections": f"WITH {_FLAT} SELECT record_no AS record_key, extraction_no, section_no, j->>'section_type' AS section_type, j->>'anchor_id' AS anchor_id, CAST(nu AS INTEGER) AS n_units FROM fsn",
    "p1_units": f"""WITH {_FLAT} SELECT record_no AS record_key, extraction_no, section_no, unit_no, unit_id, type, {", ".join(f"u->>'{k}' AS {k}" for k in ("kind", "name", "description", "statement", "unit", "comparison_direction", "source_table_marker"))},
CAST(CASE json_type(sc) WHEN 'ARRAY' THEN json_array_length(sc) WHEN 'OBJECT' THEN 1 ELSE 0 END AS INTEGER) AS n_scores FROM fu""",
    "p1_scores": f"""WITH {_FLAT}, z AS (SELECT * EXCLUDE (x0), {_JD("x0")} AS x FROM (SELECT record_no, extraction_no, section_no, unit_no, unit_id, type, u, unnest({_JL("sc")}) AS x0, generate_subscripts({_JL("sc")}, 1) - 1 AS score_no FROM fu WHERE json_type(sc) IN ('ARRAY', 'OBJECT')))
SELECT record_no AS record_key, extraction_no, section_no, unit_no, unit_id, type, u->>'name' AS name, u->>'unit' AS unit, CAST(score_no AS INTEGER) AS score_no, coalesce(json_type(x) = 'OBJECT', false) AS is_object,
{", ".join(f"x->>'{k}' AS {k}" for k in ("variant", "value", "variance", "system_id", "setup_id"))}, TRY_CAST(x->>'value_num' AS DOUBLE) AS value_num FROM z""",
}

# --- citations, faithfulness ---------------------------------------------------------------------
from folioweave.operators.citations import ROLE_PRECEDENCE  # noqa: E402
from folioweave.queries import corpus as _corpus  # noqa: E402

_PREFIXES = lambda x: "list_distinct(list_transform(list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: length(w) >= 4 AND w NOT IN {s}), lambda w: left(w, 5)))".format(x=x, s=_in(TITLE_STOPWORDS))
_COVER = lambda part: f"len(list_intersect(want, {_PREFIXES(part)})) / len(want)"
_HEADLINE = "(?im)^(?:#{1,6} *|\\*\\*)?[0-9. ]*(?:%s)\\b"
ORACLE |= {
    "x1_faithfulness": _with(_P, body=f"""SELECT doc_id, round(CASE WHEN len(want) > 0 THEN greatest({_COVER("regexp_extract(text, '^([^' || chr(10) || ']*)', 1)")}, {_COVER("left(text, 3000)")}) ELSE 0.0 END, 6) AS score,
regexp_matches(text, '{_HEADLINE % 'abstract|introduction'}') AND regexp_matches(text, '{_HEADLINE % 'references|bibliography'}') AS coherent FROM (SELECT doc_id, text, {_PREFIXES('title')} AS want FROM documents JOIN p USING (paper_id) WHERE text IS NOT NULL)"""),
}
if "j4_link_units" in _corpus.ORACLE:
    ORACLE["g6_reference_edges"] = f"""WITH {_U}, {_E}, lk AS ({_corpus.ORACLE["j4_link_units"]}), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ref_no ORDER BY loaded_at) AS rn FROM cited_refs) WHERE rn = 1),
root AS (SELECT paper_id, arg_min(id, (changed_at, id)) AS source_id FROM u WHERE type = 'Contribution' GROUP BY ALL),
rr AS (SELECT paper_id, ref_no AS ref_id, role, list_position({_W(ROLE_PRECEDENCE)}, role) AS k FROM (SELECT paper_id, ref_no, unnest(roles) AS role FROM r) WHERE role IN {_in(ROLE_PRECEDENCE)}),
best AS (SELECT rr.paper_id, source_id, unit_id AS target_id, arg_min(role, k) AS relation FROM rr JOIN lk ON lk.paper_id = rr.paper_id AND lk.ref_id = rr.ref_id JOIN root ON root.paper_id = rr.paper_id WHERE unit_id <> source_id GROUP BY ALL)
SELECT b.paper_id, source_id, relation, target_id, 'reference' AS origin FROM best b JOIN u ON u.paper_id = b.paper_id AND u.id = b.target_id AND u.type IN ('Contribution', 'Component', 'ExperimentSetup')
WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.relation = 'part_of' AND e.paper_id = b.paper_id AND e.source_id = b.target_id) AND NOT (relation = 'compares_to' AND u.type = 'Contribution')
AND NOT EXISTS (SELECT 1 FROM e WHERE e.relation IN {_in(ROLE_PRECEDENCE)} AND e.paper_id = b.paper_id AND e.source_id = b.source_id AND e.target_id = b.target_id)"""

# --- questions, quantities of records -------------------------------------------------------------
from folioweave.queries.problems import _QUANTITIES  # noqa: E402

_ANSWERS = " UNION ALL ".join(
    f"SELECT '{q['id']}' AS id, '{q['task']}' AS task, {n} AS n_hits, {n} >= {q.get('min_hits', q.get('min_pairs', 1))} AS answered FROM ({_corpus.ORACLE[of]})"
    for q, of, n in zip(_corpus.QUESTIONS, ("q4_leaderboard", "q3_sweep", "q1_facet", "q1_has_code", "q2_lookup", "q6_cited", "q5_compare"), ("max(n_hits)", *["count(*)"] * 6))
)
_KEYS = ("record_key", "extraction_no", "section_no", "unit_no", "unit_id", "score_no")
_OF_RECORDS = _QUANTITIES.replace(
    "FROM result_rows", f"""FROM (SELECT struct_pack({", ".join(f"{k} := {k}" for k in _KEYS)}) AS row_no, value AS value_raw, name AS metric, CAST(NULL AS VARCHAR) AS metric_norm, CAST(NULL AS VARCHAR) AS table_caption, unit
FROM ({ORACLE["p1_scores"]}) WHERE type = 'Measure' AND is_object)"""
)
ORACLE |= {
    "q7_answers": _ANSWERS,
    "q7_by_task": f"SELECT task, count(*) FILTER (WHERE answered) AS n_answered, count(*) AS n_questions FROM ({_ANSWERS}) GROUP BY ALL",
    "p2_measures": f"""{_OF_RECORDS} SELECT {", ".join(f"row_no.{k} AS {k}" for k in _KEYS)}, s.quantity, s.value, s.unit_code, stated_by, common_unit, s.value * u.factor + u.shift AS common_value
FROM s JOIN unit_refs u ON u.quantity = s.quantity AND u.unit_code = s.unit_code""",
}
del _PT, _S, F

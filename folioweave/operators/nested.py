"""Deeply nested records to flat tables with parent keys (problem 1).

Two steps. The JVM first brings every accepted written form of a record (text inside
text, wrappers, one-element lists, sections as list or object, typed arrays, scores as
list, object or text) into ONE nested column with a fixed type, using VARIANT. The
children are then cut out of the Arrow buffers of that column: list offsets give the
parent index of each child and keys follow by a vectorised ``take``. No row is visited
in Python.

Defined results: a null, blank or incomplete payload and JSON that is no object has no
rows; a repeated record (same key) gives the rows of the version received last; extra input columns are
ignored; an empty table gives an empty table; texts of any length pass unchanged (one
record must fit a task). Keys equal to ``record_no`` may be null: such rows are kept
under the null key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions.vocab import TYPED_ARRAY_KEYS

#: Objects that only wrap an extraction.
WRAPPERS = ("06_extraction", "extraction", "result")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _get(v: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$['{key}']", kind)


def _parse(text: Column) -> Column:
    """The only JSON value that ``text`` holds from end to end, else null.

    Parsing it as the one element of a list rejects trailing rubbish as well as cut text.
    """
    return _let(
        F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>"),
        lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))),
    )


def _list_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _map_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _is_object(v: Column) -> Column:
    return _map_of(v).isNotNull()


def _decoded(v: Column) -> Column:
    """``v``, or the JSON inside it where it is a string."""
    return _let(v, lambda x: F.when(_list_of(x).isNotNull() | _is_object(x), x).otherwise(_parse(x.cast("string"))))


def _no_variants() -> Column:
    return F.array().cast("array<variant>")


def _members(v: Column) -> Column:
    """The elements of a list or the values of an object, decoded; else an empty array."""
    return F.transform(_let(v, lambda x: F.coalesce(_list_of(x), F.map_values(_map_of(x)), _no_variants())), _decoded)


def _objects(a: Column) -> Column:
    return F.filter(a, _is_object)


def _as_list(v: Column) -> Column:
    """A list as it is, an object as a list of one, else an empty array; members decoded."""
    return F.transform(
        F.coalesce(_list_of(v), F.when(_is_object(v), F.array(v)), _no_variants()), _decoded
    )


def _unwrapped(docs: Column) -> Column:
    def one(d: Column) -> Column:
        return _let(
            F.when(_get(d, "sections").isNull(), _decoded(F.coalesce(*(_get(d, k) for k in WRAPPERS)))),
            lambda inner: F.when(inner.isNull(), F.array(d)).otherwise(_as_list(inner)),
        )

    return F.flatten(F.transform(_objects(docs), one))


def _text(v: Column, key: str) -> Column:
    return _get(v, key).cast("string")


def _score(s: Column) -> Column:
    return F.struct(
        _is_object(s).alias("is_object"),
        *(_text(s, k).alias(k) for k in ("variant", "value", "variance", "system_id", "setup_id")),
        _get(s, "value_num", "double").alias("value_num"),
    )


def _texts(v: Column) -> Column:
    """The texts of a list, one text as a list of one, null where there is neither."""
    return _let(v, lambda x: F.coalesce(F.transform(_list_of(x), lambda e: e.cast("string")), F.when(x.isNotNull() & ~_is_object(x), F.array_compact(F.array(x.cast("string"))))))


def _names(v: Column) -> Column:
    """The keys of an object in order; empty for anything else."""
    return F.coalesce(F.array_sort(F.map_keys(_map_of(v))), F.array().cast("array<string>"))


#: Text fields of units, section and document that only the whole graph needs.
UNIT_TEXTS = ("method_kind", "polarity", "objective_class", "caption_marker", "table_role", "headline_result")
SCORE_TEXTS = ("value_kind", "opponent_id", "judge_id")
FORMULA_TEXTS = ("name", "expression", "role", "description")


def _listed(v: Column) -> Column:
    return _list_of(v).isNotNull()


def _edge(e: Column) -> Column:
    return F.struct(*(_text(e, k).alias(k) for k in ("source_id", "relation", "target_id")), _texts(_get(e, "provenance")).alias("provenance"), _listed(_get(e, "provenance")).alias("provenance_listed"))


def _edges(v: Column) -> Column:
    return F.transform(_objects(_let(_decoded(v), lambda x: F.coalesce(_list_of(x), _no_variants()))), _edge)


def _more_of_unit(u: Column) -> list[Column]:
    """The fields of a unit that only the whole graph needs."""
    formulas = F.transform(_objects(_as_list(_decoded(_get(u, "formulas")))), lambda f: F.struct(*(_text(f, k).alias(k) for k in FORMULA_TEXTS)))
    lists = [x for k in ("provenance", "setup_ids", "finding_ids", "cite_keys") for x in (_texts(_get(u, k)).alias(k), _listed(_get(u, k)).alias(f"{k}_listed"))]
    extra = F.transform(_objects(_let(_decoded(_get(u, "scores")), _as_list)), lambda s: F.struct(*(_text(s, k).alias(k) for k in SCORE_TEXTS), _names(s).alias("keys")))
    return [*(_text(u, k).alias(k) for k in UNIT_TEXTS), *lists, formulas.alias("formulas"), extra.alias("more_of_scores"), _names(u).alias("keys"), _listed(_get(u, "scores")).alias("scores_listed")]


def _unit(entry: Column, full: bool = False) -> Column:
    """The unit of an entry struct<v, t> with the type t where it has none of its own."""
    u = entry["v"]
    return F.struct(
        _text(u, "id").alias("unit_id"),
        F.coalesce(_text(u, "type"), entry["t"]).alias("type"),
        *(_text(u, k).alias(k) for k in ("kind", "name", "description", "statement", "unit", "comparison_direction", "source_table_marker")),
        F.transform(_let(_decoded(_get(u, "scores")), _as_list), _score).alias("scores"),
        *([*_more_of_unit(u), entry["t"].alias("array_type")] if full else []),
    )


def _section(s: Column, full: bool = False) -> Column:
    """A section with its units: those of the unit list, then those of the typed arrays, each read once."""
    arrays = F.array(*(F.struct(_get(s, key).alias("a"), F.lit(kind).cast("string").alias("t")) for key, kind in (("units", None), *TYPED_ARRAY_KEYS.items())))
    filled = F.filter(arrays, lambda x: x["a"].isNotNull())
    entries = F.flatten(F.transform(filled, lambda x: F.transform(_members(_decoded(x["a"])), lambda u: F.struct(u.alias("v"), x["t"].alias("t")))))
    return F.struct(
        _text(s, "section_type").alias("section_type"),
        _text(s, "anchor_id").alias("anchor_id"),
        F.transform(F.filter(entries, lambda x: _is_object(x["v"])), lambda x: _unit(x, full)).alias("units"),
        *([_texts(_get(s, "covers_entries")).alias("covers"), _listed(_get(s, "covers_entries")).alias("covers_listed"), _names(s).alias("keys"), F.when(_get(s, "sections").isNull(), _edges(_get(s, "relations"))).alias("edges")] if full else []),
    )


def canonical_records(df: DataFrame, key: str = "record_no", payload: str = "payload", full: bool = False) -> DataFrame:
    """``key`` and ``records``: array<struct<doc_id, title, sections: array<...>>> of each row; ``full`` adds what the whole
    graph needs: provenance, lists of references, formulas, the relations, the notes and the keys of every object."""
    docs = df.select(F.col(key).alias("__key"), _decoded(_parse(F.col(payload))).alias("v")).where(F.col("v").isNotNull())
    # A wrapper may hold text, a list or another wrapper.
    docs = docs.select("__key", _unwrapped(_unwrapped(_as_list(F.col("v")))).alias("a"))

    def record(d: Column) -> Column:
        def unwrapped(s: Column) -> Column:
            return _let(_decoded(_get(s, "section")), lambda inner: F.when(_is_object(inner), inner).otherwise(s))

        listed = _let(
            _decoded(_get(d, "sections")),
            lambda v: F.when(_get(v, "section_type").isNotNull(), F.array(v)).otherwise(_members(v)),
        )
        # Units beside the sections form a section of their own, the last.
        every = F.concat(F.transform(_objects(listed), unwrapped), F.array(d))
        return F.struct(
            F.coalesce(_get(_get(d, "document"), "doc_id", "string"), _text(d, "doc_id")).alias("doc_id"),
            _get(_get(d, "document"), "title", "string").alias("title"),
            F.filter(
                F.transform(every, lambda x: _section(x, full)), lambda s: s["section_type"].isNotNull() | s["anchor_id"].isNotNull() | (F.size(s["units"]) > 0)
            ).alias("sections"),
            *(whole(d) if full else []),
        )

    def whole(d: Column) -> list[Column]:
        document, notes = _get(d, "document"), _get(d, "extraction_notes")
        return [
            _names(d).alias("keys"), _names(document).alias("document_keys"), _names(notes).alias("notes_keys"), _edges(_get(d, "relations")).alias("edges"),
            *(_text(document, k).alias(f"document_{k}") for k in ("id", "type", "kind", "ir_version")),
            *(_text(notes, k).alias(f"notes_{k}") for k in ("ir_version", "input_mode")),
            _texts(_get(notes, "sections_used")).alias("sections_used"), _names(_get(notes, "source_tables")).alias("source_tables"),
            _listed(_get(d, "relations")).alias("edges_listed"), _listed(_get(d, "sections")).alias("sections_listed"),
        ]

    return docs.select(F.col("__key"), F.transform(F.col("a"), record).alias("records"))


# --- Arrow side ---------------------------------------------------------------------------


def _plain_list(a: pa.Array) -> pa.ListArray:
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def _children(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The flattened children, the parent index of each and its ordinal within the parent."""
    lists = _plain_list(lists)
    parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.bincount(parent, minlength=len(lists))
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return pc.list_flatten(lists), parent, np.arange(len(parent), dtype=np.int64) - first[parent]


def _int32(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32))


RECORD_SCHEMA = "record_key bigint, extraction_no int, doc_id string, title string, n_sections int"
SECTION_SCHEMA = "record_key bigint, extraction_no int, section_no int, section_type string, anchor_id string, n_units int"
UNIT_SCHEMA = (
    "record_key bigint, extraction_no int, section_no int, unit_no int, unit_id string, type string, kind string, name string, "
    "description string, statement string, unit string, comparison_direction string, source_table_marker string, n_scores int"
)
SCORE_SCHEMA = (
    "record_key bigint, extraction_no int, section_no int, unit_no int, unit_id string, type string, name string, unit string, "
    "score_no int, is_object boolean, variant string, value string, variance string, system_id string, setup_id string, value_num double"
)
LEVELS = {"records": RECORD_SCHEMA, "sections": SECTION_SCHEMA, "units": UNIT_SCHEMA, "scores": SCORE_SCHEMA}


def _flatten_batch(batch: pa.RecordBatch, level: str) -> pa.Table:
    key = batch.column("__key")
    records, parent, n0 = _children(batch.column("records"))
    cols = {"record_key": key.take(pa.array(parent)), "extraction_no": _int32(n0)}
    sections = records.field("sections")
    if level == "records":
        return pa.table(cols | {"doc_id": records.field("doc_id"), "title": records.field("title"), "n_sections": pc.list_value_length(sections)})
    sec, parent, n1 = _children(sections)
    cols = {k: v.take(pa.array(parent)) for k, v in cols.items()} | {"section_no": _int32(n1)}
    units = sec.field("units")
    if level == "sections":
        return pa.table(cols | {k: sec.field(k) for k in ("section_type", "anchor_id")} | {"n_units": pc.list_value_length(units)})
    unit, parent, n2 = _children(units)
    cols = {k: v.take(pa.array(parent)) for k, v in cols.items()} | {"unit_no": _int32(n2)}
    scores = unit.field("scores")
    if level == "units":
        own = ("unit_id", "type", "kind", "name", "description", "statement", "unit", "comparison_direction", "source_table_marker")
        return pa.table(cols | {k: unit.field(k) for k in own} | {"n_scores": pc.list_value_length(scores)})
    cols |= {k: unit.field(k) for k in ("unit_id", "type", "name", "unit")}
    score, parent, n3 = _children(scores)
    cols = {k: v.take(pa.array(parent)) for k, v in cols.items()} | {"score_no": _int32(n3)}
    own = ("is_object", "variant", "value", "variance", "system_id", "setup_id", "value_num")
    return pa.table(cols | {k: score.field(k) for k in own})


def _flattener(level: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _flatten_batch(batch, level).to_batches()

    return run


def latest(df: DataFrame, key: str = "record_no", payload: str = "payload", order: str = "received_at") -> DataFrame:
    """One row per record, the one received last (ties: the greatest payload); rows without a key stay one per payload."""
    by = F.struct(order, payload) if order in df.columns else F.col(payload)
    unkeyed = F.when(F.col(key).isNull(), F.xxhash64(payload))
    return df.groupBy(key, unkeyed.alias("__unkeyed")).agg(F.max_by(payload, by).alias(payload)).drop("__unkeyed")


def flatten_level(df: DataFrame, level: str, key: str = "record_no", payload: str = "payload", dedupe: bool = True) -> DataFrame:
    """One flat table of ``records``, ``sections``, ``units`` or ``scores``.

    ``record_key`` and the ordinals above a row are its parent keys. ``key`` must be a bigint. With ``dedupe`` a
    record that was loaded several times gives the rows of its last version; nothing is shuffled after that.
    """
    rows = latest(df, key, payload) if dedupe else df
    return canonical_records(rows, key, payload).mapInArrow(_flattener(level), LEVELS[level])


def flatten_records(df: DataFrame, key: str = "record_no", payload: str = "payload") -> dict[str, DataFrame]:
    """All four flat tables."""
    return {level: flatten_level(df, level, key, payload) for level in LEVELS}


def measure_scores(df: DataFrame, key: str = "record_no", payload: str = "payload") -> DataFrame:
    """(record_no, unit_id, score_no) of each score object of a unit of type Measure."""
    return (
        flatten_level(df, "scores", key, payload, dedupe=False)
        .where((F.col("type") == "Measure") & F.col("is_object"))
        .select(F.col("record_key").alias("record_no"), "unit_id", "score_no")
        .dropDuplicates()
    )

"""Nested records, quantities, orphans and hierarchies on small cases and against brute force."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioweave.operators import hierarchy as H
from folioweave.operators import nested as N
from folioweave.operators import orphans as O
from folioweave.operators import quantities as Q

UNIT = {"id": "mea:a", "type": "Measure", "name": "F1", "scores": [{"variant": "x", "value": "1"}, None, "t", {"value": "2"}]}
PLAIN = {"document": {"doc_id": "d"}, "sections": [{"section_type": "evidence", "units": [UNIT]}]}


def scores(spark, payloads, extra=False):
    rows = [(i, p) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "record_no bigint, payload string")
    if extra:
        df = df.withColumn("records", F.lit("clash")).withColumn("unit_id", F.lit(1)).withColumn("v", F.lit(2))
    return sorted((r.record_no, r.unit_id, r.score_no) for r in N.measure_scores(df).collect())


WANT = [("mea:a", 0), ("mea:a", 3)]


@pytest.mark.parametrize(
    "payload",
    [
        json.dumps(PLAIN),
        json.dumps(json.dumps(PLAIN)),
        json.dumps([PLAIN]),
        json.dumps({"06_extraction": PLAIN}),
        json.dumps({"result": json.dumps(PLAIN)}),
        json.dumps(PLAIN | {"sections": {"evidence": PLAIN["sections"][0]}}),
        json.dumps(PLAIN | {"sections": [{"section": PLAIN["sections"][0]}]}),
        json.dumps(PLAIN | {"sections": json.dumps(PLAIN["sections"])}),
        json.dumps({"sections": [], "units": [UNIT]}),
        json.dumps({"sections": [{"measures": [{k: v for k, v in UNIT.items() if k != "type"}]}]}),
        json.dumps({"sections": [{"units": [UNIT | {"scores": json.dumps(UNIT["scores"])}]}]}),
    ],
)
def test_forms_of_a_record(spark, payload):
    assert scores(spark, [payload]) == [(0, *w) for w in WANT]


def test_single_score_has_number_0(spark):
    one = {"sections": [{"units": [UNIT | {"scores": {"value": "1"}}, UNIT | {"id": "mea:b", "scores": '{"value": 2}'}, UNIT | {"id": "mea:c", "scores": "n/a"}, UNIT | {"id": "mea:d", "scores": ""}]}]}
    assert scores(spark, [json.dumps(one)]) == [(0, "mea:a", 0), (0, "mea:b", 0)]


def test_unusable_payloads(spark):
    full = json.dumps(PLAIN)
    assert scores(spark, [None, "", "  ", full[:-1], full + "}", "null", "17", '"x"', "[]", "{}", full[: len(full) // 2]]) == []


def test_repeated_records_extra_columns_and_empty_tables(spark):
    assert scores(spark, [json.dumps(PLAIN)], extra=True) == [(0, *w) for w in WANT]
    df = spark.createDataFrame([(1, json.dumps(PLAIN))] * 3, "record_no bigint, payload string")
    assert N.measure_scores(df).count() == 2
    for level in N.LEVELS:
        assert N.flatten_level(df, level).count() == {"records": 1, "sections": 1, "units": 1, "scores": 4}[level]
        assert N.flatten_level(df.limit(0), level).count() == 0


def test_other_types_are_no_cases(spark):
    rec = {"sections": [{"findings": [{"id": "f", "scores": [{"value": 1}]}], "measures": [UNIT | {"type": "Finding"}], "units": [{"id": "u", "scores": [{"value": 1}]}]}]}
    assert scores(spark, [json.dumps(rec)]) == []


def test_long_payload(spark):
    many = {"sections": [{"units": [UNIT | {"id": f"mea:{i}", "name": "n" * 2000} for i in range(500)]}]}
    assert len(scores(spark, [json.dumps(many)])) == 1000


# --- quantities ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def refs(spark):
    d = "/root/testdata/sf0.001"
    return spark.read.parquet(f"{d}/unit_refs.parquet"), spark.read.parquet(f"{d}/metric_refs.parquet")


QUANTITIES = [
    # value, metric, caption, unit -> unit code, common value
    ("0.5", "Accuracy", None, None, "frac", 50.0),
    ("50.5", "Accuracy", None, None, "pct", 50.5),
    ("1", "Accuracy", None, "%", "pct", 1.0),
    ("0.351 (fraction)", "Acc. (%)", None, "%", "frac", 35.1),
    ("7749 bp", "EM", None, None, "bp", 77.49),
    ("136.6 ± 2.7-per 1000", "F1", None, None, "permille", 13.66),
    ("1.22e7K", "Parameters", None, None, "K", 12200.0),
    ("300 K", "Chip temperature", None, None, "K", 26.85),
    ("≈ 5.7 x 10^(-4)", "Latency", "Table 1: Results (times in h)", "s", "h", 2.052),
    ("5", "Latency", "Table 1: Cost. memory in GiB; durations (min)", None, "min", 300.0),
    ("2", "Peak memory / GiB", "Table: memory in MB", "TB", "GiB", 2.147483648),
    ("3", "Training time, hours", None, "unitless", "h", 10800.0),
    ("3", "Training time", None, "unit: MINS", "min", 180.0),
    ("4.4-gigabytes", "Memory footprint", None, None, "GB", 4.4),
    ("12 in.", "Localization error", None, None, "inch", 304.8),
    ("2 thousand tokens/s", "Throughput", None, None, "ktok_s", 2000.0),
    ("1,234", "Inference FLOPs", None, "mixed", "GFLOP", 1234.0),
]


@pytest.mark.parametrize("value,metric,caption,unit,code,common", QUANTITIES)
def test_quantity(spark, refs, value, metric, caption, unit, code, common):
    df = spark.createDataFrame([(1, value, metric, caption, unit)], "row_no int, value_raw string, metric string, table_caption string, unit string")
    (r,) = Q.convert(df, *refs, ["row_no"], metric_norm=None).collect()
    assert r.unit_code == code
    assert r.common_value == pytest.approx(common, rel=1e-6)


def test_values_without_a_number(spark, refs):
    rows = [(i, v, m, None, None) for i, (v, m) in enumerate([(None, "F1"), ("", "F1"), ("best", "F1"), ("O(n log n)", "F1"), ("3", "BLEU"), ("3", None), ("3", "unknown")])]
    df = spark.createDataFrame(rows, "row_no int, value_raw string, metric string, table_caption string, unit string")
    assert Q.convert(df, *refs, ["row_no"], metric_norm=None).count() == 0
    assert Q.convert(df.limit(0), *refs, ["row_no"], metric_norm=None).count() == 0


def test_alias_table_is_consistent():
    rows = Q.alias_rows()
    assert len({(q, a) for q, a, _ in rows}) == len(rows)
    assert all(a == a.lower() for _, a, _ in rows)


# --- orphans ------------------------------------------------------------------------------


def brute_orphans(refs, changes):
    out = set()
    for no, which, key, at in refs:
        if key is None or at is None:
            continue
        past = [(t, not up) for k, t, up in changes if k == key and t <= at]
        if not past or max(past)[1]:
            out.add((no, which))
    return out


@pytest.mark.parametrize("seed,bits,kind", [(1, 8, "timestamp"), (2, 32768, "timestamp_ntz"), (3, 1, "timestamp_ntz")])
def test_orphans_against_brute_force(spark, monkeypatch, seed, bits, kind):
    """Several ranges in a task, one, and one per key; hot keys are salted."""
    monkeypatch.setattr(O, "RANGE_BITS", max(8, bits))
    monkeypatch.setattr(O, "HOT_ROWS", 3 if seed == 1 else 100_000)
    rng = random.Random(seed)
    day = lambda: datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 24 * 120))
    keys = [f"k{i}" for i in range(25)]
    pick = lambda: "k0" if rng.random() < 0.4 else rng.choice(keys)
    refs = [(i, rng.choice(["source", "target"]), rng.choice([pick(), pick(), pick(), None]), day()) for i in range(400)]
    changes = [(pick(), day(), rng.random() < 0.6) for _ in range(150)]
    changes += [(k, t, not up) for k, t, up in changes[:20]]  # equal times: the delete wins
    r = spark.createDataFrame(refs, f"ref_id bigint, which string, key string, at {kind}").withColumn("salt", F.lit("x"))
    c = spark.createDataFrame(changes, f"key string, at {kind}, up boolean").withColumn("month_no", F.lit("x"))
    got = {(x.ref_id, x.which) for x in O.orphan_references(r, c).collect()}
    assert got == brute_orphans(refs, changes)


def test_orphans_of_empty_tables(spark):
    r = spark.createDataFrame([(1, "source", "k", datetime(2024, 1, 1))], "ref_id bigint, which string, key string, at timestamp")
    c = spark.createDataFrame([], "key string, at timestamp, up boolean")
    assert O.orphan_references(r, c).count() == 1
    assert O.orphan_references(r.limit(0), c).count() == 0


def test_membership_filter(spark):
    from folioweave.operators import membership as B

    keys = spark.range(0, 5000, 2).select(F.xxhash64("id").alias("k"))
    bitmap = B.key_filter(keys, 2500)
    rows = spark.range(5000).unionByName(spark.sql("select cast(null as bigint) id"))
    kept = {r.id for r in B.may_be_in(rows, bitmap, F.when(F.col("id").isNotNull(), F.xxhash64("id"))).collect()}
    assert kept >= set(range(0, 5000, 2)) and None not in kept and len(kept) < 2600
    assert B.may_be_in(rows, B.key_filter(keys.limit(0), 0), F.xxhash64("id")).count() == 0


@given(st.sets(st.integers(0, O.RANGE_BITS - 1), max_size=5000))
@settings(max_examples=30, deadline=None)
def test_bitmap_round_trip(bits):
    b = np.array(sorted(bits), dtype=np.int64)
    assert O.decode(O.expand(O.compress(b))).tolist() == b.tolist()


# --- hierarchies --------------------------------------------------------------------------


def brute_tree(parent):
    out = {}
    for n in set(parent) | set(parent.values()):
        path, cur = [n], n
        while cur in parent and len(path) <= len(parent) + 1:
            cur = parent[cur]
            path.append(cur)
        out[n] = ("", -1) if cur in parent else (cur, len(path) - 1)
    return out


@st.composite
def forests(draw):
    n = draw(st.integers(1, 30))
    return {i: draw(st.integers(0, n)) for i in draw(st.sets(st.integers(0, n), min_size=1))}


@given(forests())
@settings(max_examples=150, deadline=None)
def test_peeling_against_brute_force(parent):
    import pandas as pd

    numbered = H.Links(pd.DataFrame({"group_id": "g", "node": [str(k) for k in parent], "parent": [str(v) for v in parent.values()]}))
    rows = [r for b in numbered.states() for r in b.to_pylist()]
    want = brute_tree({str(k): str(v) for k, v in parent.items()})
    assert {r["node"]: (r["root"], r["depth"]) for r in rows} == want
    above = {r["node"]: r["above"] for b in numbered.lists() for r in b.to_pylist()}
    pairs = {(p["ancestor"], p["descendant"]): p["distance"] for b in numbered.pairs() for p in b.to_pylist()}
    assert pairs == {(a, n): k + 1 for n, up in above.items() for k, a in enumerate(up)}
    for r in rows:
        if r["depth"] >= 0:
            assert len(above[r["node"]]) == r["depth"] and [r["node"], *above[r["node"]]][-1] == r["root"]
        assert r["n_descendants"] == sum(a == r["node"] for a, _ in pairs)


def _random_edges(spark, seed=5, n=400):
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        size = n if g == 0 else 12
        rows += [(f"g{g}", f"n{i}", f"n{rng.randint(0, i) if rng.random() < 0.95 else rng.randint(0, size)}") for i in range(1, size)]
    return spark.createDataFrame(rows + rows[:9], "group_id string, child string, parent string")


@pytest.mark.parametrize("seed", [5, 6])
def test_rounds_of_joins_give_the_same_rows(spark, seed):
    edges = _random_edges(spark, seed, 150)
    key = lambda r: str(r)
    cols = ["group_id", "node", "parent", "root", "depth", "path", "n_descendants", "on_cycle", "n_parents"]
    a, b = (sorted(H.paths(edges, k).select(*cols).collect(), key=key) for k in (100_000, 8))
    assert a == b and len(a) > 150
    p, q = (sorted(H.descendant_pairs(edges, k).collect(), key=key) for k in (100_000, 8))
    assert p == q


def test_chains_and_cycles_by_rounds(spark):
    """A long chain, a ring with a tail, and a star are contracted in few rounds."""
    n = 60
    rows = [("chain", f"{i}", f"{i + 1}") for i in range(n)] + [("ring", f"{i}", f"{(i + 1) % 20}") for i in range(20)]
    rows += [("ring", "a", "3"), ("ring", "b", "a"), ("ring", "c", "b")] + [("star", f"{i}", "hub") for i in range(50)]
    df = spark.createDataFrame(rows, "group_id string, child string, parent string")
    got = {(r.group_id, r.node): r for r in H.hierarchy(df, 3).collect()}
    assert all((got["chain", f"{i}"].depth, got["chain", f"{i}"].root, got["chain", f"{i}"].n_descendants) == (n - i, f"{n}", i) for i in range(n + 1))
    assert all((got["ring", f"{i}"].depth, got["ring", f"{i}"].on_cycle, got["ring", f"{i}"].n_descendants) == (-1, True, 3 if i == 3 else 0) for i in range(20))
    assert [(got["ring", k].depth, got["ring", k].on_cycle, got["ring", k].n_descendants) for k in "abc"] == [(-1, False, 2), (-1, False, 1), (-1, False, 0)]
    assert got["star", "hub"].n_descendants == 50 and got["star", "7"].depth == 1


def test_a_deep_chain_and_a_wide_star(spark):
    chain = spark.range(100_000).select(F.lit("c").alias("group_id"), F.col("id").cast("string").alias("child"), (F.col("id") + 1).cast("string").alias("parent"))
    star = spark.range(1_000_000).select(F.lit("s").alias("group_id"), F.col("id").cast("string").alias("child"), F.lit("hub").alias("parent"))
    got = H.hierarchy(chain.unionByName(star)).groupBy("group_id").agg(F.max("depth").alias("d"), F.countDistinct("root").alias("r"), F.count(F.lit(1)).alias("n"), F.max("n_descendants").alias("m"))
    assert {tuple(r) for r in got.collect()} == {("c", 100_000, 1, 100_001, 100_000), ("s", 1, 1, 1_000_001, 1_000_000)}


def test_hierarchy_edge_cases(spark):
    rows = [("g", "a", "b"), ("g", "a", "b"), ("g", "a", "c"), ("g", "s", "s"), (None, "x", "y"), ("g", None, "y"), ("h", "a", "b")]
    df = spark.createDataFrame(rows, "group_id string, child string, parent string").withColumn("depth", F.lit(9))
    got = {(r.group_id, r.node): (r.root, r.depth, r.n_parents, r.on_cycle) for r in H.paths(df).collect()}
    assert got == {("g", "a"): ("b", 1, 2, False), ("g", "b"): ("b", 0, 0, False), ("g", "s"): ("", -1, 1, True), ("h", "a"): ("b", 1, 1, False), ("h", "b"): ("b", 0, 0, False)}
    assert H.hierarchy(df.limit(0)).count() == 0 and H.descendant_pairs(df.limit(0)).count() == 0


def test_parents_that_are_not_followed_stay_nodes(spark, tmp_path):
    from folioweave.queries import problems

    rows = [(1, "p", "cmp:a", "con:b"), (2, "p", "cmp:a", "con:c"), (3, "p", "cmp:a", "cmp:d"), (4, "p", "cmp:d", "con:b"), (5, "q", "cmp:a", "con:b")]
    rel = spark.createDataFrame(rows, "relation_no bigint, paper_id string, source_id string, target_id string").withColumn("relation", F.lit("part_of"))
    rel.write.parquet(str(tmp_path / "relations.parquet"))
    want = {("p", "cmp:a"): ("con:b", 2), ("p", "cmp:d"): ("con:b", 1), ("p", "con:b"): ("con:b", 0), ("p", "con:c"): ("con:c", 0), ("q", "cmp:a"): ("con:b", 1), ("q", "con:b"): ("con:b", 0)}
    for name in ("p5_found", "p5_paths"):
        got = [tuple(r) for r in problems.QUERIES[name](spark, str(tmp_path)).select("paper_id", "unit_id", "root_id", "depth").collect()]
        assert len(got) == len(want) and {r[:2]: r[2:] for r in got} == want


def test_last_version_of_a_record(spark):
    from datetime import datetime as T

    old, new = '{"doc_id": "a", "sections": []}', '{"doc_id": "b", "sections": []}'
    rows = [(1, old, T(2024, 1, 1)), (1, new, T(2024, 1, 2)), (1, new, T(2024, 1, 2)), (None, old, T(2024, 1, 1)), (None, new, T(2024, 1, 1)), (2, None, T(2024, 1, 1)), (2, old, None)]
    df = spark.createDataFrame(rows, "record_no bigint, payload string, received_at timestamp")
    got = sorted((str(r.record_key), r.doc_id) for r in N.flatten_level(df, "records").collect())
    assert got in ([("1", "b"), ("2", "a"), ("None", "a"), ("None", "b")], [("1", "b"), ("None", "a"), ("None", "b")])


def test_unit_far_from_its_topic_in_a_caption(spark):
    refs = [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("unit_refs", "metric_refs")]
    cap = "Latency of all the systems measured over the held-out test split in ms"
    df = spark.createDataFrame([(1, "12.5", "latency", "latency", cap, None)], "row_no bigint, value_raw string, metric string, metric_norm string, table_caption string, unit string")
    assert [r.unit_code for r in Q.convert(df, *refs, ["row_no"]).collect()] == ["ms"]

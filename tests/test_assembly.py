"""The whole assembly and the validation on one written paper, step by step."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioweave.operators import graph as G
from folioweave.operators import validate
from folioweave.plans import assembly as P

RECORD = {
    "document": {"id": "doc:x", "type": "Document", "title": "X", "doc_id": "p1", "ir_version": "section-ir-0.17"},
    "sections": [
        {"section_type": "problem", "anchor_id": "ctx:gap", "covers_entries": ["ctx:gap"], "problems": [{"id": "ctx:gap", "type": "Problem", "description": "A gap.", "provenance": "§1"}]},
        {
            "section_type": "method", "anchor_id": "con:nowhere",
            "contributions": [{"id": "con:net", "kind": "method", "name": "Net", "method_kind": "taxonomy", "description": "A net.", "provenance": ["§2"],
                               "formulas": [{"expression": "a = b", "role": "objective"}, {"expression": "a=b", "description": "kept"}, {"expression": " "}, {"expression": "c", "role": "odd", "description": "gone"}]}],
            "components": [{"id": "cmp:Part One", "name": "part", "description": "A part.", "provenance": ["§2"]}, {"id": "cmp:part_one", "name": "other", "description": "d", "provenance": ["§2"]}],
            "measures": [{"id": "mea:lost", "name": "typed array of another section"}],
        },
        {
            "section_type": "evidence", "anchor_id": "mea:acc",
            "units": [
                {"id": "exp:data", "type": "ExperimentSetup", "kind": "dataset", "name": "Data", "provenance": ["§3"]},
                {"id": "exp:twin", "type": "ExperimentSetup", "kind": "dataset", "name": "Data", "provenance": ["§3"]},
                {"id": "mea:acc", "type": "Measure", "name": "acc", "setup_ids": ["exp:twin", "exp:none"], "source_table_marker": "9", "provenance": [],
                 "scores": [{"variant": "net", "value": "95.2 %", "variance": "", "system_id": "con:net", "setup_id": "exp:twin"}, {"variant": "b", "value": "n/a", "system_id": "cmp:none", "setup_id": "prb:gap"}]},
                {"id": "mea:empty", "type": "Measure", "name": "empty", "scores": []},
                {"id": "fnd:gain", "type": "Finding", "kind": "positive", "statement": "The headline gain holds.", "provenance": []},
                {"id": "prb:stray", "type": "Problem", "description": "in the wrong section"},
                "no object",
            ],
        },
        {"section_type": "evidence", "anchor_id": "x"},
    ],
    "relations": [
        {"source_id": "prb:gap", "relation": "motivates", "target_id": "con:net", "provenance": ["§1"]},
        {"source_id": "prb:gap", "relation": "motivates", "target_id": "con:net", "provenance": ["§2"]},
        {"source_id": "fnd:gain", "relation": "about", "target_id": "mea:acc", "provenance": []},
        {"source_id": "fnd:gain", "relation": "about", "target_id": "con:net", "provenance": ["§4"]},
        {"source_id": "con:net", "relation": "uses", "target_id": "con:net", "provenance": []},
        {"source_id": "con:net", "relation": "likes", "target_id": "exp:data", "provenance": []},
        {"source_id": "con:net", "relation": "uses", "target_id": "exp:gone", "provenance": []},
    ],
    "extra": 1,
}


@pytest.fixture(scope="module")
def context(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    nodes = df([("p1", "prb:gap", "Problem", None, "gap", "d", None, 1), ("p1", "con:net", "Contribution", "method", "Net", "d", ["[3]"], 2), ("p1", "cmp:planned", "Component", None, "n", "d", None, 3)],
               "paper_id string, id string, type string, kind string, name string, description string, cite_keys array<string>, ord int")
    tables = df([("p1", "§7", "Table 1")], "paper_id string, marker string, caption string")
    blocks = df([("p1", "§1"), ("p1", "§2")], "paper_id string, marker string")
    return P.Context(nodes, tables, blocks, df([], "paper_id string, label string, marker string"), df([("p1", "headline gain")], "paper_id string, headline string"))


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(1, "p1", "{}", datetime(2024, 1, 1)), (2, "p1", json.dumps({"06_extraction": RECORD}), datetime(2024, 2, 1)), (3, None, "{}", None), (4, "p2", "{cut", None), (5, "p3", None, None)]
    df = spark.createDataFrame(rows, "record_no bigint, paper_id string, payload string, received_at timestamp").withColumn("id", F.lit("clash"))
    return G.graph(df).cut()


@pytest.fixture(scope="module")
def done(raw, context):
    return P.assemble(raw, context)


def test_log(done):
    log = {}
    for r in done.log.collect():
        log.setdefault(r.step, []).append(r.subject)
    want = {
        "R1": ["mea:lost"], "R5": ["cmp:Part One"], "R7": ["prb:stray"], "R9": ["exp:twin"], "R12": ["mea:acc"], "R13": ["mea:empty"], "R34": ["evidence"], "R16": ["fnd:gain", "mea:acc"], "R17": ["method"], "R18": ["mea:acc"],
        "R19": ["fnd:gain"], "R20": ["con:net"], "R36": ["prb:gap"], "R37": ["con:net"], "R21": ["con:net", "con:net"], "R22": ["mea:acc"], "R23": ["fnd:gain"], "R24": ["fnd:gain"],
        "R27": ["cmp:planned", "mea:empty"],
    }
    assert {k: sorted(v) for k, v in log.items() if k not in ("R4", "R15", "R35")} == {k: v for k, v in want.items() if v}


def test_graph(done):
    units = {r.id: r for r in done.graph.units.collect()}
    assert set(units) == {"prb:gap", "con:net", "cmp:part_one", "cmp:part_one_2", "exp:data", "mea:acc", "fnd:gain"}
    assert units["mea:acc"].setup_ids == ["exp:data"] and units["mea:acc"].finding_ids == ["fnd:gain"] and units["mea:acc"].unit == "unitless"
    assert units["mea:acc"].source_table_marker is None and units["mea:acc"].has_quantitative_payload
    assert units["mea:acc"].provenance == ["§3"] == units["fnd:gain"].provenance  # of the section, as no table was captured
    assert (units["fnd:gain"].kind, units["fnd:gain"].polarity) == ("descriptive", "positive")
    assert units["con:net"].cite_keys == ["[3]"]
    assert [(f.expression, f.role, f.description) for f in units["con:net"].formulas] == [("a = b", "objective", "kept"), ("c", None, None)]
    scores = sorted((r.row_no, r.system_id, r.setup_id, r.value_num) for r in done.graph.scores.collect())
    assert scores == [(0, "con:net", "exp:data", 95.2), (1, "", "", None)]
    edges = {(r.source_id, r.relation, r.target_id): r.provenance for r in done.graph.edges.collect()}
    assert edges == {
        ("prb:gap", "motivates", "con:net"): ["§1"], ("fnd:gain", "about", "con:net"): ["§4"], ("mea:acc", "evaluates", "con:net"): [], ("fnd:gain", "resolves", "prb:gap"): ["§4"],
    }
    sections = {r.section: (r.anchor_id, r.covers) for r in done.graph.sections.collect()}
    assert sections == {"problem": ("prb:gap", ["prb:gap"]), "method": ("con:net", ["con:net"]), "evidence": ("mea:acc", [])}
    d = done.documents.head()
    assert (d.document_kind, d.sections_used, d.n_markers, d.n_resolved) == ("review", ["evidence", "method", "problem"], 10, 5)
    c = done.coverage.head()
    assert (c.n_planned, c.n_covered, c.n_missing) == (3, 2, 1)


def test_faults_before_and_after(raw, done, context):
    before = {(r.rule, r.subject) for r in validate.issues(raw, context.nodes, context.tables).collect()}
    for fault in [
        ("V1 missing key", "p1"), ("V1 unexpected key", "p1"), ("V2 id", "cmp:Part One"), ("V2 prefix", "ctx:gap"), ("V3 list", "ctx:gap"), ("V3 empty", "fnd:gain"), ("V4 kind", "fnd:gain"),
        ("V4 formula role", "con:net"), ("V4 unit", "mea:acc"), ("V4 no scores", "mea:empty"), ("V4 setups missing", "mea:empty"), ("V4 variance", "mea:acc"), ("V4 unknown reference", "mea:acc"), ("V5 type in section", "prb:stray"),
        ("V5 anchor unknown", "1"), ("V5 covers", "1"), ("V6 relation", "con:net likes exp:data"), ("V6 target", "con:net uses exp:gone"), ("V6 source", "prb:gap motivates con:net"),
        ("V8 notes", "p1"), ("V9 marker", "mea:acc"), ("V10 not covered", "con:net"), ("V10 unknown node", "ctx:gap"), ("V5 type in section", "mea:lost"),
    ]:
        assert fault in before, fault
    after = {(r.rule, r.subject) for r in validate.issues(done.graph, context.nodes, context.tables).collect()}
    assert after == {("V4 variance", "mea:acc"), ("V10 not covered", "cmp:planned")}


def test_empty(raw, context):
    none = G.Graph(*(t.limit(0) for t in (raw.documents, raw.sections, raw.units, raw.scores, raw.edges)))
    done = P.assemble(none, context)
    assert done.log.count() == 0 and done.graph.units.count() == 0 and done.documents.count() == 0
    assert validate.issues(none, context.nodes, context.tables).count() == 0

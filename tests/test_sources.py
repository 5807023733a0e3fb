"""Readers, writers, resumable runs and the file stream, in temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from folioweave.sources import files
from folioweave.streaming import incremental


def test_markdown_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "b_2020.md").write_text("# B\n[§1] x", encoding="utf-8")
    (tmp_path / "a.md").write_text("", encoding="utf-8")
    (tmp_path / "c.txt").write_text("no")
    (tmp_path / "sub" / "d.md").write_text("deep")
    got = {r.paper_id: r.content for r in files.scan_markdown(spark, str(tmp_path)).collect()}
    assert got == {"b_2020": "# B\n[§1] x", "a": ""} or got == {"b_2020": "# B\n[§1] x"}


def test_json_and_jsonl(spark, tmp_path):
    blocks = [{"type": "text", "text": "Hello."}]
    (tmp_path / "one.json").write_text(json.dumps(blocks))
    got = files.scan_papers(spark, str(tmp_path)).collect()
    assert [(r.paper_id, r.content) for r in got] == [("one", "[§1] Hello.\n")]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "x.jsonl").write_text(json.dumps({"content_list": blocks}) + "\n\n" + json.dumps({"content_list": json.dumps(blocks)}) + "\n")
    assert {r.paper_id for r in files.scan_papers(spark, str(lines)).collect()} == {"x:1", "x:3"}
    (lines / "x.jsonl").write_text('{"a": 1}\nbroken\n')
    assert files.scan_jsonl(spark, str(lines), strict=False).count() == 1
    with pytest.raises(Exception, match="not JSON"):
        files.scan_jsonl(spark, str(lines)).collect()
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        files.scan_papers(spark, str(tmp_path / "empty"))


def test_tree(spark, tmp_path):
    for paper, body in (("p1", '{"a": 1}'), ("p2", "{broken")):
        (tmp_path / paper).mkdir()
        (tmp_path / paper / "06_extraction.json").write_text(body)
        (tmp_path / paper / "notes.json").write_text("{}")
    got = {(r.paper_id, r.stage): r.payload for r in files.scan_tree(spark, str(tmp_path)).collect()}
    assert got == {("p1", "06_extraction"): '{"a": 1}', ("p2", "06_extraction"): None}


def test_jsonl_sink_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    files.write_jsonl(df, str(tmp_path / "o"))
    (line,) = [x for p in (tmp_path / "o").glob("*.json") for x in p.read_text(encoding="utf-8").splitlines()]
    assert line == '{"a":"é","b":null}'


def test_json_sink(tmp_path):
    target = tmp_path / "x.json"
    files.write_json({"é": 1}, str(target))
    files.write_json({"é": 2}, str(target))
    assert json.loads(target.read_text(encoding="utf-8")) == {"é": 2} and [p.name for p in tmp_path.iterdir()] == ["x.json"]


def test_changed_rows_and_resume(spark):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 1, None), ("b", 3, "x"), ("c", 1, None)], "k string, v int, w string")
    assert {r.k for r in files.changed_rows(new, old, ["k"]).collect()} == {"b", "c"}
    assert files.changed_rows(new, new, ["k"]).count() == 0
    papers = spark.createDataFrame([("a",), ("b",), ("c",)], "paper_id string")
    status = spark.createDataFrame([("a", "completed"), ("b", "failed"), ("c", None)], "paper_id string, status string")
    assert {r.paper_id for r in files.unfinished(papers, status).collect()} == {"b", "c"}
    assert files.unfinished(papers, status, limit=1).count() == 0
    assert files.unfinished(papers, status, force=True).count() == 3
    assert {r.status: r.n_papers for r in files.run_summary(status).collect()} == {"completed": 1, "failed": 1, "unknown": 1}


def test_stream_handles_each_file_once(spark, tmp_path):
    src, out, ck = (tmp_path / x for x in ("in", "out", "ck"))
    src.mkdir()
    (src / "a.md").write_text("[§1] one\n[§2] two")
    incremental.process_new(spark, str(src), str(out), str(ck))
    (src / "b.md").write_text("[§1] three")
    incremental.process_new(spark, str(src), str(out), str(ck))
    incremental.process_new(spark, str(src), str(out), str(ck))
    got = spark.read.parquet(str(out)).groupBy("paper_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.paper_id: r.n for r in got} == {"a": 2, "b": 1}


def test_manifest(spark):
    m = files.manifest({"t": spark.createDataFrame([(1,)], "a int")}, "v1", {"t": "a table", "t.a": "a number"})
    assert m["ir_version"] == "v1" and m["tables"] == {"t": {"description": "a table", "columns": [{"name": "a", "type": "int", "description": "a number"}]}}
    assert m["units"]["Measure"]["id_prefix"] == "mea" and m["relations"]["resolves"] == {"sources": ["Finding"], "targets": ["Problem"]}


def test_lines_of_split_files_keep_their_numbers(spark, tmp_path):
    """Two files in many blocks each, with blank lines and carriage returns."""
    for name, n in (("a", 400), ("b", 90)):
        rows = [json.dumps({"k": i, "pad": "x" * (i % 50)}) + ("\r" if i % 7 == 0 else "") if i % 11 else "" for i in range(1, n + 1)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(rows) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        got = [(r.doc, r.line_no, json.loads(r.payload)["k"]) for r in files.scan_jsonl(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(got) == 490 - 400 // 11 - 90 // 11
    assert all(no == k and doc.endswith(f":{k}") for doc, no, k in got)


def test_progress(spark):
    p = spark.createDataFrame([(f"p{i}",) for i in range(10)], "paper_id string")
    s = spark.createDataFrame([("p1", "completed"), ("p2", "completed"), ("p3", "failed"), ("p4", None)], "paper_id string, status string")
    r = files.progress(p, s, 90.0).head()
    assert (r.n_papers, r.n_completed, r.n_failed, r.papers_per_minute, r.minutes_left) == (10, 2, 1, 2.0, 3.5)
    assert files.progress(p, s.limit(0), 90.0).head().minutes_left is None


def test_usage_of_a_run(spark):
    from folioweave.plans import telemetry

    rows = [("p1", "status", json.dumps({"token_usage": {"by_stage": {"method": {"prompt_tokens": 10, "cached_tokens": 4, "completion_tokens": 2, "truncated": True}}}})), ("p2", "status", json.dumps({"token_usage": {"problem": {"prompt": 5}}})), ("p3", "status", None), ("p4", "01_census", "{}")]
    got = sorted(tuple(r) for r in telemetry.load_usage(spark.createDataFrame(rows, "paper_id string, stage string, payload string")).collect())
    assert got == [("p1", "method", 10, 4, 2, True), ("p2", "problem", 5, 0, 0, False)]
    total = [r for r in telemetry.cost_report(telemetry.load_usage(spark.createDataFrame(rows, "paper_id string, stage string, payload string"))).collect() if r.stage == "TOTAL"][0]
    assert (total.effective, total.share, total.hit_rate) == (6 + 5 + 8, 1.0, 4 / 15)

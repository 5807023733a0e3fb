"""The operators that SQL cannot check, on written cases and against brute force."""

import json
import re

import pytest
from pyspark.sql import functions as F

from folioweave.functions import ids, schemas, vocab
from folioweave.functions import scalar as S
from folioweave.operators import assemble as A
from folioweave.operators import bibliography as B
from folioweave.operators import blocks as K
from folioweave.operators import tables as H
from folioweave.operators import text as T
from folioweave.plans import corpus, model, render, sample

PAPER = """# Toy Net: a title
[§1] Abstract text, 2021.
# 1 Introduction
[§2] First block citing [3].
[§3] Second block.
# 3 Method
[§4] Opening of the method section.
## 3.1 Setup
[§5] Block under heading 3.1.
[§6] **Table 1: Accuracy**
[§7]
<table><tr><th>Method</th><th>Acc</th></tr><tr><td>Ours</td><td>95.20</td></tr><tr><td>Base</td><td>.931</td></tr></table>
# References
[1] A. One. Title. 2019.  [2] B. Two. Title. 2020.  [3] C. Three. Title. 2021.
# Appendix
[§8] Text after the bibliography.
"""


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


SCALARS = [
    (S.normalize_name, {"ResNet-50 (Ours)": "resnet 50 ours", "Café": "caf", None: "", "": ""}),
    (S.normalize_cite_key, {"[31]": "31", "Warburg et al., 2021": "warburg2021", "Qin et al., 2022a": "qin2022a", "Vaswani2017": "vaswani2017", "[AlexNet]": "alexnet", "2021": "2021", None: ""}),
    (S.canon_marker, {"53": "§53", "[§53]": "§53", "§53": "§53", " ": "", None: ""}),
    (S.parse_value_num, {"95.2%": 95.2, "1,234": 1234.0, "−3.1": -3.1, "95.2 ± 0.3": 95.2, "1 × 10−2": 0.01, "6.4e-4": 0.00064, ".5": 0.5, "≈ 12": 12.0, "up to 34%": None, "": None, None: None, "7": 7.0, "3x1024": 3e24}),
    (S.numeric_values, {"28.40": [28.4], ".323": [0.323], "1,234": [1234.0], "12/15": [12.0, 15.0], "none": [], None: []}),
    (S.coerce_year, {"in 2019.": 2019, "1799": None, None: None}),
    (S.dirname_year, {"020_NeurIPS_2024_x": 2024, "ACL_2025_y": 2025, "012_2024_z": 2024, "2024_w": 2024, "no_year": None}),
    (S.dirname_venue, {"020_NeurIPS_2024_x": "NeurIPS", "ACL_2025_y": "ACL", "012_2024_z": None, "no_year": None}),
    (S.url_host, {"https://www.GitHub.com/x": "github.com", "a.github.com:80/y": "a.github.com:80", " ": "", None: ""}),
    (S.derive_aliases, {"Long Form (LF2)": ["Long Form", "LF2"], "Model (ours)": [], "A (one two three Four)": [], None: []}),
    (S.sanitize_text, {"a\x00b   c \t d ": "a b c d", None: None}),
    (S.is_marker, {"§5": True, "§B": True, "§3.1": False, "Table 5": True, "prose": False, None: False}),
    (S.marker_order, {"§12": 12, "Table": 1_000_000_000, None: 1_000_000_000}),
    (S.paper_key, {"a/b/123.json": "b", "x/paper.json": "paper", "out/p1/06_extraction.json": "p1"}),
    (ids.canonical, {"met:Delta 1.25": "mea:delta_1_25", "exp:a-b": "exp:a_b", "nocolon X": "nocolon X", "cmp:__": "cmp:__", "set:a:b": "exp:a_b", None: None, ":x": ":x"}),
    (T.document_title, {"# A b\n[§1] x": "A b", "\n\nfirst\nsecond": "first", " ": "Untitled"}),
]


@pytest.mark.parametrize("fn,cases", SCALARS, ids=lambda x: getattr(x, "__name__", ""))
def test_scalar(spark, fn, cases):
    got = apply(spark, fn, list(cases))
    for (value, want), have in zip(cases.items(), got):
        assert have == (pytest.approx(want) if isinstance(want, float) else want), value


def test_release_hosts(spark):
    got = apply(spark, lambda c: S.is_release_host(c, S.CODE_HOSTS), ["github.com", "x.github.com", "notgithub.com", None])
    assert got == [True, True, False, False]


def test_number_keys():
    assert [S.number_key(x) for x in (28.4, 0.323, 1234.0, 0.00001)] == ["28.4", "0.323", "1234", "1e-05"]


@pytest.fixture(scope="module")
def papers(spark):
    rows = [(1, PAPER), (2, None), (3, ""), (4, "no marks"), (5, "<table><td>1</td></table>\n[§1] x\n[§1] y\r\n[§2] z"), (6, PAPER.replace("\n", "\r\n"))]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_blocks(papers):
    b = T.blocks(papers)
    assert {r.marker for r in b.where("doc_id = 1").collect()} == {f"§{i}" for i in range(1, 9)}
    last = {r.marker: r.text for r in T.block_map(b.where("doc_id = 5")).collect()}
    first = {r.marker: r.text for r in T.block_map(b.where("doc_id = 5"), last=False).collect()}
    assert last["§1"].startswith("[§1] y") and first["§1"].startswith("[§1] x")
    assert b.where("doc_id in (2, 3, 4)").count() == 0


def test_bibliography(papers):
    r = papers.where("doc_id = 1").select(T.bibliography(F.col("text")).alias("b"), T.references_blob(F.col("text")).alias("r"), T.body_slice(F.col("text")).alias("t")).head()
    assert r.b.score == 3 and r.r.startswith("# References\n[1]") and "Appendix" not in r.r
    assert r.t.endswith("</table>\n") and "[§8]" not in r.t
    none = papers.where("doc_id = 4").select(T.bibliography(F.col("text")).alias("b"), T.body_slice(F.col("text")).alias("t")).head()
    assert none.b is None and none.t == "no marks"


def test_densest_bibliography_wins(spark):
    real = "# References\n" + "\n".join(f"[{i}] X. {2000 + i}." for i in range(5))
    for text in (real + "\n# References\n", "references\nnone here\n" + real, "**References**\n[1] 2001\n# A\n" + real):
        df = spark.createDataFrame([(text,)], "t string").select(T.bibliography(F.col("t")).alias("b"))
        assert df.head().b.score == 5


def test_source_tables(papers):
    got = {(r.doc_id, r.marker): (r.caption, r.n_tables) for r in T.source_tables(papers).collect()}
    assert got[1, "§7"] == ("Table 1: Accuracy", 1)
    assert got[5, ""] == ("", 1)


def test_captions_belong_to_one_table(spark):
    t = "<table>{}</table>"
    text = f"[§1] **Table 1: A**\n{t.format(1)}\n{t.format(2)}\n[§2] **Table 2: B** **Tab. 3: C**\n{t.format(3)}"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = {r.marker: (r.caption, r.n_tables, r.html) for r in T.source_tables(df).collect()}
    assert got == {"§1": ("Table 1: A", 2, t.format(1) + "\n" + t.format(2)), "§2": ("Tab. 3: C", 1, t.format(3))}


def test_capture_warnings(spark):
    got = apply(spark, T.capture_warnings, ["<table>", "<table><table></table></table>", "| a | b |\n|---|---|\n| 1 | 2 |", "x", None])
    assert got[0] == ["unbalanced"] and got[1] == ["nested"] and got[2] == ["pipe_tables"] and got[3] == []


def test_heading_map(papers):
    got = {r.label: r.marker for r in T.heading_map(papers.where("doc_id = 1")).collect()}
    assert got["3.1"] == "§5" and got["3"] == "§4" and got["1"] == "§2" and got["introduction"] == "§2" and got["setup"] == "§5"


def test_markers(spark):
    labels = {"3.1": "§5", "iv": "§9", "abstract": "§1"}
    cases = {
        "§3.1": "§5", "§3.2": "§3", "§IV-D": "§9", "§A4.2": "§A", "§107-108": "§107", "Appendix A.2": "§A", "App. D.1": "§D", "§Table 3": "Table 3",
        "B.2": "§B", "Abstract": "§1", "Table 5": "Table 5", "free prose here": "free prose here", "§12": "§12",
    }
    rows = spark.createDataFrame([("p", [k for k in cases]), ("q", None)], "paper_id string, provenance array<string>")
    lab = spark.createDataFrame([("p", k, v) for k, v in labels.items()], "paper_id string, label string, marker string")
    got = {r.paper_id: r.provenance for r in A.normalize_provenance(rows, lab).collect()}
    assert dict(zip(cases, got["p"])) == cases and got["q"] == []


def test_span_prefix(spark):
    long_ = "word " * 100
    got = apply(spark, T.span_prefix, ["short", "x" * 300, long_])
    assert got[0] == "short" and got[1] == "x" * 240 and got[2] == ("word " * 48).rstrip()


def test_metadata_slice(spark):
    head = "h" * 50 + "\n"
    text = head + "\n".join(["a", "b", "see https://x.org", "c", "d", "e"])
    df = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.slice for r in T.metadata_slice(df, head=10).collect()}
    assert got[1].startswith("h" * 50) and got[1].endswith("b\nsee https://x.org\nc") and got[2] == "short" and got[3] is None


def suffixed(spark, names):
    df = spark.createDataFrame([("p", n, i) for i, n in enumerate(names)], "paper_id string, id string, ord int")
    return [r.new_id for r in A.suffix_duplicates(df).orderBy("ord").collect()]


def test_suffixes(spark):
    assert suffixed(spark, ["a", "a", "a_2"]) == ["a", "a_2", "a_2_2"]
    assert suffixed(spark, ["a", "a_2", "a", "a"]) == ["a", "a_2", "a_3", "a_4"]
    assert suffixed(spark, ["b", "c"]) == ["b", "c"]


def test_clean_ids(spark):
    df = spark.createDataFrame([("p", x) for x in ("cmp:a b", "cmp:a_b", "cmp:A-B", "met:x")], "paper_id string, raw_id string")
    got = {r.raw_id: r.new_id for r in A.clean_ids(df).collect()}
    assert got["cmp:a_b"] == "cmp:a_b" and got["met:x"] == "mea:x" and sorted(got.values()) == ["cmp:a_b", "cmp:a_b_2", "cmp:a_b_3", "mea:x"]


def test_formulas(spark):
    rows = [("p", "u", "x = 1", None, "objective", None, 1), ("p", "u", "x=1", "n", "bad", "d", 2), ("p", "u", " ", "z", None, None, 3)]
    df = spark.createDataFrame(rows, "paper_id string, id string, expression string, name string, role string, description string, ord int")
    (r,) = A.clean_formulas(df).collect()
    assert (r.expression, r.name, r.role, r.description, r.ord) == ("x = 1", "n", "objective", "d", 1)
    again = A.clean_formulas(A.clean_formulas(df)).collect()
    assert len(again) == 1


GRID = """<table><tr><th rowspan=2>Group</th><th rowspan=2>Method</th><th colspan=2>Acc</th></tr><tr><th>A</th><th>B</th></tr>
<tr><td rowspan=2>Weak</td><td>M1</td><td>1.5</td><td>2</td></tr><tr><td>M2</td><td>3</td><td>-</td></tr><tr><td>Full</td><td>M3</td><td>4</td><td>5</td></tr></table>"""


def test_grid():
    got = [(r[1], r[3], r[4], r[6]) for r in H.lift(GRID)]
    assert got == [(2, "Weak / M1", "Acc / A", 1.5), (2, "Weak / M1", "Acc / B", 2.0), (3, "Weak / M2", "Acc / A", 3.0), (4, "Full / M3", "Acc / A", 4.0), (4, "Full / M3", "Acc / B", 5.0)]


def test_grid_without_th_and_two_tables():
    plain = "<table><tr><td>Model</td><td>F1</td></tr><tr><td>X</td><td>9</td></tr><tr><td></td><td></td></tr></table>"
    assert [(r[0], r[3], r[4], r[6]) for r in H.lift(plain + plain)] == [(0, "X", "F1", 9.0), (1, "X", "F1", 9.0)]
    assert H.lift("<table><tr><td>1") == [] and H.lift(None) == [] and H.lift("") == []


def test_cells():
    assert H.cell_texts("<table><tr><td>a<b>b</b></td><td> </td><th>c &amp; d</th></tr></table>") == ["ab", "c & d"]


@pytest.mark.parametrize(
    "html,safe",
    [("<table><tr><td>1</td></tr></table>", True), ("<table><div></table>", False), ("<script></script>", False), ("<td onclick='x'>1</td>", False), ("<td style='x'>1</td>", False), ("<!-- x", False), ("a <x", False), ("<br>1 < 2", True), (None, False)],
)
def test_safe(html, safe):
    assert H.is_safe(html) is safe


NUMBERED = "# References\n" + " ".join(f"[{i}] A. Author. A long enough title number {i}. {2000 + i}." for i in range(1, 7))
KEYED = " ".join(f"[Abc{90 + i}] A. Author. A long enough title number {i}. {1990 + i}." for i in range(5))
DOTTED = "\n".join(f"{i}. Author A. A long enough title number {i}. {2000 + i}" for i in range(1, 8))
YEARS = "\n".join(f"Surname, A. and Other, B. A long enough title {'abcde'[i]}. Venue, {2000 + i}." for i in range(5))


@pytest.mark.parametrize("text,kind,n", [(NUMBERED, "numbered-bracket", 6), (KEYED, "bracket-key", 5), (DOTTED, "numbered-dot", 7), (YEARS, "author-year", 5)])
def test_bibliography_split(text, kind, n):
    got = B.split(text)
    assert got["regime"] == kind and len(got["entries"]) == n
    letters = lambda s: re.sub(r"\W", "", s)
    joined = letters("".join((e["marker"] or "") + e["body"] for e in got["entries"]))
    assert joined == letters(text.replace("# References", ""))


def test_bibliography_split_keeps_unclear_texts():
    for text in (None, "", "prose with [3] and [7] and [9] but no list", "Two. 2001. Entries. 2002.", "x" * 50_000):
        assert B.split(text) is None


def test_far_citation_folds_into_the_last_entry():
    got = B.split(NUMBERED + " See also [99] for more.")
    assert len(got["entries"]) == 6 and "[99]" in got["entries"][-1]["body"]


def test_longest_run():
    assert [[3, 1, 2, 9, 4][i] for i in B.longest_run([3, 1, 2, 9, 4])] == [1, 2, 4]
    assert B.longest_run([]) == []


def test_markdown(spark):
    content = [
        {"type": "text", "text": "Title", "text_level": 1}, {"type": "text", "text": "One.\n\nTwo."}, {"type": "header", "text": "skip"},
        {"type": "image", "img_path": "a.png", "image_caption": ["Fig [1]"]}, {"type": "table", "table_caption": "Table 1", "table_body": "<table></table>", "table_footnote": ["note"]},
        {"type": "list", "list_items": ["a", " ", "b"]}, {"type": "code", "code_body": "x = ```"}, {"type": "equation", "text": "$x$"}, {"type": "other", "z": 1},
        {"type": "text", "text": "References", "text_level": 1}, {"type": "text", "text": "[1] X."}, {"type": "list", "sub_type": "ref_text", "list_items": ["[2] Y."]},
        {"type": "text", "text": "Appendix", "text_level": 1}, {"type": "text", "text": "After."},
    ]
    rows = [("a", json.dumps(content)), ("b", json.dumps({"content_list": content})), ("c", json.dumps({"content_list": json.dumps(content)})), ("d", "broken")]
    df = spark.createDataFrame(rows, "doc string, payload string")
    got = {r.doc: r.markdown for r in K.to_markdown(K.explode_records(df)).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] == got["b"] == got["c"]
    parts = got["a"].strip().split("\n\n")
    assert parts[:3] == ["# Title", "[§1] One.", "[§2] Two."]
    assert "[§3] ![Fig (1)](<a.png>)" in parts and "[§4] **Fig [1]**" in parts and "[§6]\n<table></table>" in parts and "[§8]\n- a\n- b" in parts
    assert "[§9]\n````\nx = ```\n````" in parts and "[1] X." in parts and "[2] Y." in parts and parts[-1] == "[§12] After."


@pytest.mark.parametrize(
    "text,want",
    [('{"a": 1}', {"a": 1}), ('<think>{"x": 2}</think> so: {"a": {"b": "}"}} end', {"a": {"b": "}"}}), ('```json\n{"a": "\\alpha"}\n```', {"a": "\\alpha"}), ("[1]", None), ("", None), (None, None), ("{broken", None)],
)
def test_salvage(text, want):
    assert model.salvage_json(text) == want


def test_retries():
    calls = []

    def flaky(stage, prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise ConnectionError("x")
        return ("junk" if len(calls) == 3 else '{"ok": 1}'), {"prompt": 5}

    waits = []
    row = model.ask(flaky, "census", "p", sleep=waits.append)
    assert json.loads(row["answer"]) == {"ok": 1} and row["calls"] == 4 and waits == [2.0, 4.0] and calls[-1] != "p" and row["prompt"] == 10

    def cut(stage, prompt):
        raise model.Truncated

    assert model.ask(cut, "s", "p")["truncated"] and model.ask(cut, "s", "p")["calls"] == 1


def test_replay_stage(spark):
    stored = {model.digest("census", "p1"): '{"n": 1}'}
    df = spark.createDataFrame([("a", "census", "p1"), ("b", "census", "missing")], "paper_id string, stage string, prompt string")
    got = {r.paper_id: (r.answer, r.error is None) for r in model.run_stage(df, model.Replay(stored), tries=1).collect()}
    assert got == {"a": ('{"n": 1}', True), "b": (None, False)}


def test_prompts():
    assert model.fill("a {{x}} {{y}}", x="1") == "a 1 {{y}}"
    assert model.fenced("t\n```\none\n```\n```\ntwo\n```\n", last=True) == "two"


def test_schemas(spark):
    for section, types in vocab.SECTION_UNIT_TYPES.items():
        s = schemas.section_schema(section)
        assert s["additionalProperties"] is False and len([k for k in s["properties"] if k in vocab.TYPED_ARRAY_KEYS]) == len(types)
        spark.createDataFrame([], schemas.spark_type(s))
        assert "section_type" in schemas.prompt_lines(s)
    assert set(vocab.ID_PREFIX) == set(vocab.TYPED_ARRAY_KEYS.values())
    assert {t for s, ts in vocab.RELATION_MATRIX.values() for t in (*s, *ts)} <= set(vocab.ID_PREFIX)


def test_pages_escape(spark):
    p = spark.createDataFrame([("p", "<b>&")], "paper_id string, title string")
    u = spark.createDataFrame([("p", "con:a", "method", "Contribution", None, "<i>", "d", 1)], "paper_id string, id string, section string, type string, kind string, name string, description string, ord int")
    e = spark.createDataFrame([("p", "con:a", "uses", "cmp:b")], "paper_id string, source_id string, relation string, target_id string")
    (r,) = render.pages(p, u, e).collect()
    assert "&lt;b&gt;&amp;" in r.html and "&lt;i&gt;" in r.html and "<i>" not in r.html and "uses cmp:b" in r.html


def test_entities_ties_and_blank(spark):
    rows = [("p1", "r1", "A Title", 2001, None, 2), ("p2", "r2", "a title!", 2002, "V", 1), ("p2", "r3", None, 1, "x", 3), ("p2", "r4", " ", 1, "x", 4)]
    df = spark.createDataFrame(rows, "paper_id string, ref_id string, title string, year int, venue string, ord int")
    (r,) = corpus.entities(df).collect()
    assert (r.canonical_key, r.title, r.year, r.n_references, r.n_papers, r.n_titles) == ("a title", "a title!", 2002, 2, 2, 2)


def test_stratified_is_deterministic(spark):
    df = spark.createDataFrame([(f"p{i}", "v" if i % 3 else "w", 2015 + i % 10) for i in range(300)], "paper_id string, venue string, year int")
    a = {r.paper_id for r in sample.stratified(df, 10, 3, 2018).collect()}
    b = {r.paper_id for r in sample.stratified(df.repartition(7), 10, 3, 2018).collect()}
    assert a == b and len(a) == 20


def test_match_prefix(spark):
    idf = spark.createDataFrame([("abcdef",), ("abcd",), ("zzzz",)], "id string")
    names = spark.createDataFrame([("abcdefgh",), ("abcdxy",), ("abcd",)], "name string")
    assert {r.id: r.name for r in sample.match_prefix(idf, names, 4).collect()} == {"abcdef": "abcdefgh", "abcd": "abcd"}


def test_asof_against_brute_force(spark):
    import random

    from folioweave.operators.asof import asof

    rng = random.Random(7)
    right = [(rng.choice("abc"), rng.randint(0, 60), rng.randint(0, 9)) for _ in range(80)] + [(None, 3, 1), ("a", None, 1)]
    left = [(i, rng.choice("aabcd"), rng.randint(0, 60)) for i in range(150)] + [(900, None, 5), (901, "a", None)]
    r = spark.createDataFrame(right, "k string, t int, v int")
    lf = spark.createDataFrame(left, "i int, k string, t int")
    for forward in (False, True):
        got = {x.i: x.v for x in asof(lf, r, ["k"], "t", "v", F.floor(F.col("t") / 7), forward).collect()}
        assert len(got) == len(left)
        for i, k, t in left:
            fits = [(tt, v) for kk, tt, v in right if k is not None and t is not None and kk == k and tt is not None and (tt >= t if forward else tt <= t)]
            near = (min if forward else max)(tt for tt, _ in fits) if fits else None
            assert got[i] == (max(v for tt, v in fits if tt == near) if fits else None), (i, k, t, forward)


def test_command_line_fails_with_an_exit_code(tmp_path, monkeypatch):
    from folioweave import __main__ as cli

    class Session:
        class builder:  # noqa: N801
            @staticmethod
            def appName(name):  # noqa: N802
                return type("B", (), {"getOrCreate": staticmethod(lambda: None)})

    monkeypatch.setattr(cli, "SparkSession", Session)
    assert cli.main(["convert", str(tmp_path), str(tmp_path / "o")]) == 1


def test_legacy_marks(spark):
    from folioweave.plans.pipeline import legacy_marks

    got = apply(spark, legacy_marks, ['{"a": [{"paradigm_tags": 1}]}', '{"a": {"type": "Method"}}', '{"type": "Measure", "name": "Method"}', None, "broken"])
    assert got == [True, True, False, False, False]


def test_further_issues(spark):
    unit = "paper_id string, id string, section string, type string, kind string, name string, description string"
    rows = [
        ("good", "mea:a", "evidence", "Measure", None, "a", None), ("good", "con:c", "method", "Contribution", "method", "c", None),
        ("good", "exp:d", "evidence", "ExperimentSetup", "dataset", "d", None),
        ("bad", "mea:a", "evidence", "Measure", None, "a", None), ("bad", "mea:none", "evidence", "Measure", None, "a", None),
        ("bad", "con:c", "method", "Contribution", None, "c", None), ("bad", "con:ds", "method", "Contribution", "dataset", "c", None),
        ("bad", "prb:p", "problem", "Problem", None, "p", ""), ("bad", "fnd:f", "evidence", "Finding", "bound", "f", None),
    ]
    units = spark.createDataFrame(rows, unit)
    score = "paper_id string, measure_id string, system_id string, setup_id string, variant string, value string, unit string, direction string, table_role string"
    scores = spark.createDataFrame([
        ("good", "mea:a", "con:c", "exp:d", "v", "1", "%", "target", "ablation"), ("good", "mea:a", "", None, "v", "1", "%", None, None),
        ("bad", "mea:a", "fnd:f", "con:c", "", None, None, "up", "side"), ("bad", "mea:a", "con:x", "exp:x", "v", "1", "%", None, None),
        ("bad", "mea:a", None, "con:ds", "v", "1", "%", None, None),
    ], score)
    edges = spark.createDataFrame([("good", "mea:a", []), ("bad", "mea:a", None)], "paper_id string, source_id string, provenance array<string>")
    marked = spark.createDataFrame([("good", "§1"), ("good", None), ("bad", "§9")], "paper_id string, marker string")
    tables = spark.createDataFrame([("good", "§1"), ("bad", "§1")], "paper_id string, marker string")
    versions = spark.createDataFrame([("good", "section-ir-0.17"), ("bad", "section-ir-0.1"), ("none", None)], "paper_id string, ir_version string")
    got = {tuple(r) for r in A.further_issues(units, edges, scores, marked, tables, versions).collect()}
    on_a = ["unit_missing", "variant_missing", "value_missing", "unknown_system", "system_type", "unknown_setup", "setup_section", "setup_type", "direction", "table_role", "edge_provenance"]
    want = {("bad", r, "mea:a") for r in on_a} | {("bad", "no_scores", "mea:none"), ("bad", "kind_missing", "con:c"), ("bad", "text_missing", "prb:p"), ("bad", "text_missing", "fnd:f"), ("bad", "table_marker", "§9")}
    assert got == want | {("bad", "ir_version", "section-ir-0.1"), ("none", "ir_version", None)}


def test_canonical_ids_of_odd_spelling(spark):
    from folioweave.functions import ids

    want = {
        "fnd:a_b": "fnd:a_b", "clm:a": "fnd:a", "set:": "exp:", "fnd:A b!": "fnd:a_b", "fnd:_a_": "fnd:a", "fnd:a\n": "fnd:a", "fnd:a\r": "fnd:a",
        "no colon ": "no colon ", "x:y:z": "x:y_z", "fnd:__": "fnd:__", ":a": ":a", "": "", "met:met:A": "mea:met_a", "fnd:é": "fnd:é",
    }
    rows = spark.createDataFrame(list(want.items()), "a string, b string").select("a", "b", ids.canonical(F.col("a")).alias("c")).collect()
    assert [(r.a, r.c) for r in rows] == [(r.a, r.b) for r in rows]


def test_markdown_pieces_of_plain_text():
    text = "```markdown\n\\section{Intro}\nFirst.\n\nSecond\nline.\n```\n"
    assert K.markdown_pieces(text) == [{"kind": "heading", "text": "# Intro"}, {"kind": "para", "text": "First."}, {"kind": "para", "text": "Second\nline."}]
    code = "Text.\n\n~\n```py\na\n\n# no heading\n```\n\n## References\n\nReferences\n[1] A."
    assert [p["kind"] for p in K.markdown_pieces(code)] == ["para", "para", "ref_heading", "ref_heading", "para"]
    assert K.markdown_pieces("\\subsubsection*{Deep}") == [{"kind": "heading", "text": "### Deep"}]
    assert K.markdown_pieces(None) == [] == K.markdown_pieces(" \n ")


def test_plain_blocks_headers_and_fences(spark):
    df = spark.createDataFrame([("d", 0, '"# One\\n\\nTwo"'), ("d", 1, '{"type": "code", "code_body": "a ```` b"}')], "doc string, ord int, block string")
    assert K.to_markdown(df).head().markdown == "# One\n\n[§1] Two\n\n[§2]\n`````\na ```` b\n`````\n"
    rows = spark.createDataFrame([("s", '{"id": "7", "origin_path": " a/b.pdf ", "model_name": ""}'), ("s", "[]"), ("s", None)], "s string, r string")
    got = [r[0] for r in rows.select(K.metadata_comment(F.col("s"), F.col("r"))).collect()]
    assert got == ["<!--\nsource: s\nid: 7\norigin_path: a/b.pdf\n-->", "", ""]


def test_fuzzy_tags_backfill_and_questions(spark):
    from folioweave.plans import ask

    ids = spark.createDataFrame([("abc",), ("x-abc-y",), ("bc",), ("zz",), (None,)], "id string")
    keys = spark.createDataFrame([("abc",), ("zzz",), (None,)], "key string")
    assert {r.id: r.tagged for r in sample.fuzzy_tagged(ids, keys).collect()} == {"abc": True, "x-abc-y": True, "bc": False, "zz": False, None: False}
    papers = spark.createDataFrame([(f"p{i}", "v" if i < 30 else "w", 2024 if i % 2 else 2010) for i in range(40)], "paper_id string, venue string, year int")
    got = sample.stratified(papers, quota=5, tail_quota=2, tail_before=2020, total=20)
    assert got.count() == 20 and got.select("paper_id").distinct().count() == 20
    assert sample.stratified(papers, 5, 2, 2020).count() == 10
    assert {r.year: r.n for r in sample.year_histogram(papers).collect()} == {2024: 20, 2010: 20}
    assert ask.load_questions('[{"id": "a", "task": "facet"}]')[0]["task"] == "facet"
    for bad in ("{}", '[{"id": "a", "task": "none"}]', "[1]"):
        with pytest.raises(ValueError):
            ask.load_questions(bad)


def test_stages_from_prompts_to_tables(spark):
    """Every stage with a stand-in that answers in the stage's form, and answers that are broken."""
    from folioweave.plans import stages

    papers = spark.createDataFrame([("p", PAPER), ("q", None)], "paper_id string, text string")
    fake = model.Fake(stages.stand_in)
    run = lambda stage, i: model.run_stage(stages.prompts(stage, i), fake)
    census = run("census", stages.Inputs(papers)).cache()
    assert [(r.id, r.type) for r in stages.census_nodes(census).collect()] == [("x", "Problem")] and stages.summaries(census).head().domain == "x"
    with_census = stages.Inputs(papers, stages.census_input(census))
    relations = run("relations", with_census).cache()
    assert stages.relation_edges(relations).count() == 1
    whole = stages.Inputs(papers, stages.census_input(census), stages.relation_input(relations))
    made = [stages.prompts(f"section:{s}", whole).head().prompt for s in ("problem", "method", "evidence")]
    cut = made[0].index("TASK\n")
    assert len({m[:cut] for m in made}) == 1 and len(set(made)) == 3 and "[§8]" not in made[0]
    sections = run("section:problem", whole).unionByName(run("section:method", whole)).unionByName(run("section:evidence", whole))
    assert {(r.section, r.type) for r in stages.section_units(sections).collect()} == {(s, t) for s, t in __import__("folioweave.functions.vocab", fromlist=["x"]).section_unit_rows()}
    assert stages.section_edges(sections).count() == 2
    assert stages.metadata(run("metadata", whole)).head().authors == ["x"]
    assert stages.citations(run("citations", whole)).head().signal == "x"
    assert stages.references(run("references", whole)).head().year == 2020
    bad = spark.createDataFrame([("p", "census", None), ("q", "census", '{"nodes": [1], "spine_summary": "no"}'), ("r", "census", "{}")], "paper_id string, stage string, answer string")
    assert stages.census_nodes(bad).count() <= 1 and stages.relation_edges(bad).count() == 0

"""Text statistics, sketches and the search for texts that are not prose."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioweave.llm import quality as Q

PROSE = {
    "en": "We find that the labels are sparse in most cases, although the older model is not. Surprisingly little is known about depth estimation under open vocabularies.",
    "de": "Wir danken den Lesern für Hinweise auf doppelte Tabellen in Anhang B. Das Ergebnis verfehlt die Verweise in den meisten Fällen.",
    "es": "Según la tabla 2, el modelo sustituye el resumen en 4 puntos. Aunque las citas parecen escasas, el modelo explica los resultados.",
    "fr": "Nous montrons que les relations sont utiles pour ce corpus. Dans la plupart des cas, un seul modèle suffit pour toutes les tables.",
    "zh": "我们发现可靠的系统对样本很重要。然而，方法并未解释了所有表格。",
    "caps": "WE FIND THAT THE LABELS ARE SPARSE IN MOST CASES, ALTHOUGH THE OLDER MODEL IS NOT.",
    "wrapped": "A closer look at the modest encoder\nshows why: the variances are stable, not\nmissing. The remaining captions were\nfrozen, so they are listed in Appendix D.",
    "marked": "[§3] The table supports the late half of the references.\n[§4] It is worth noting that the model was trained on 23.1 hours of data.",
}
OTHER = [
    "- entity linking\n- Graph Routing\n- sparse decoder",
    "Keywords: robot grasping, citation recommendation, coreference resolution",
    "1.1 Latent Replay ........ 2\n2.1 Program Sketches ..... 5",
    "[1] A. Jotim, T. Mabhemul. On the Limits of Channel Gating in Protein Folding with Weak Priors. CORSA, 2016.\n[2] N. Talmosend. Towards Robust Entity Linking under Label Noise. TRAIL, 2020.",
    "Torul M. (2006) Scarce Negatives in Knowledge-Base Completion: A Study of Stochastic Feature Whitening, pp. 62-720.",
    "| System | F1 |\n|---|---|\n| Nevtalos | 76.5 |",
    "System            F1     Latency\nMabne             1.0    3.5",
    "<table><tr><td>the</td><td>of</td></tr></table>",
    ".detadp usihpar garapeh terofeb sreiltu orevode garevas jpglrfwggxqb cmqjbwdxhqkllkrhcdmp",
    "nRCeqSFWYfjbXsy42KspiMEsuf075oE2l9RwvG0BMBbDRcJcj9YcCg6XczHcjLxuoKoGzB",
    "=========================================",
    "3186NSQcV9EOUH4CO/oOfnZm0PSa844VWd122t2zC726GoP/5tvTljd8065Fgsy6/l7rJEYAeBMH6HO5u1MWPWIwz9M/a8de/la1d2l",
    "b~ea^|iucc1r.e`^a slnbs^c.'~dd rdldr;cc  atbIldr`r.lablo l d n Ilner'^a~''c,.  s l n d",
    "mixers critics projector aligners tokenizer adapter critic aligner encoders head adapter planner",
    "2025-04-16 WARN stage=head rc=6 tok=3020 retry=2",
    "Download PDF Share Cite\nDownload PDF Share Cite",
    '{"zelquinan": [97, 29, 56], "nevwexavel": [60, 98, 75]}',
    "\\hbox#1 \\@ifnextchar \\csname \\hbox#1 \\let#1 \\vskip0pt",
]


WORDS = "/root/testdata/sf0.001/common_words.parquet"


@pytest.fixture(scope="module")
def lex(spark):
    return Q.lexicon(spark.read.parquet(WORDS))


@pytest.mark.parametrize("name", PROSE)
def test_prose(lex, name):
    row = Q.statistics_of(PROSE[name], lex)
    assert row[-1] > 0.9
    assert row[0] == {"caps": "en", "wrapped": "en", "marked": "en"}.get(name, name)


@pytest.mark.parametrize("text", OTHER)
def test_no_prose(lex, text):
    assert Q.statistics_of(text, lex)[-1] < 0.1


def test_mixed_share(lex):
    text = PROSE["en"] + "\n\n" + OTHER[0]
    share = Q.statistics_of(text, lex)[-1]
    assert share == pytest.approx(len(PROSE["en"]) / len(text), abs=0.05)


def test_statistics_of_odd_texts(lex):
    for t in ["x", "​", "\r", "a\x00b", "…", "x" * 200_000, "a b " * 50_000]:
        row = Q.statistics_of(t, lex)
        assert len(row) == 1 + len(Q.STATISTICS) and 0 <= row[-1] <= 1


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, list(PROSE.values())[i % 5]) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(OTHER)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (1000, OTHER[0])]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("language", F.lit("clash"))


def _labels(spark, prose, other):
    rows = [(i, "prose", "r") for i in prose] + [(i, "list", "r") for i in other] + [(None, "prose", "r"), (prose[0], None, "r"), (77_777, "junk", "r")]
    return spark.createDataFrame(rows, "doc_id bigint, form string, rater string")


def test_found(spark, docs):
    words = spark.read.parquet(WORDS).unionByName(spark.createDataFrame([(None, "x"), ("en", None)], "lang string, word string"))
    labels = _labels(spark, range(40), range(1000, 1012))
    want = [1000 + i for i in range(len(OTHER))]
    assert sorted(r.doc_id for r in Q.not_prose(docs, words, labels).collect()) == want
    assert sorted(r.doc_id for r in Q.not_prose(docs, words, labels.limit(0)).collect()) == want  # default weights
    assert Q.not_prose(docs.limit(0), words, labels).count() == 0
    assert Q.not_prose(docs, None, None).count() == 0  # no common words: nothing stands out


@pytest.mark.parametrize("other", [100, 200])
def test_found_where_much_of_the_corpus_is_no_prose(spark, other):
    """A third and two thirds of lists, which are then no outliers; some labels are wrong."""
    rows = [(i, OTHER[0] if i < other else PROSE["en"]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = _labels(spark, [*range(other, 300, 3), 1], [*range(0, other, 3), 298])
    stats = Q.document_statistics(df, spark.read.parquet(WORDS))
    got = Q.flagged(Q.scored(stats, labels)).where(~F.col("is_prose"))
    assert sorted(r.doc_id for r in got.collect()) == list(range(other))


@pytest.mark.parametrize("n", [5, 99, 100])
def test_found_does_not_depend_on_the_size_of_a_language(spark, n):
    """A German text that is mostly a list, among n German texts and a corpus with many lists."""
    mixed = PROSE["de"] + "\n\n" + "\n".join(["- entity linking", "- Graph Routing"] * 6)
    rows = [(i, PROSE["de"]) for i in range(n - 1)] + [(1000 + i, PROSE["en"]) for i in range(100)] + [(3000 + i, OTHER[0]) for i in range(150)] + [(5000, mixed)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = _labels(spark, range(1000, 1040), range(3000, 3060))
    assert sorted(r.doc_id for r in Q.not_prose(df, spark.read.parquet(WORDS), labels).collect()) == [*range(3000, 3150), 5000]


def test_scores(spark, docs):
    rows = Q.flagged(Q.scored(Q.document_statistics(docs, spark.read.parquet(WORDS)))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.prose_share is None:
            assert r.tails == [] and r.p_prose_share is None and r.is_prose is None
        else:
            assert 0 <= r.p_n_words <= 1


def test_sketch_quantiles_are_near_the_exact_ones(spark):
    df = spark.range(20_000).select(F.lit("en").alias("language"), *(F.col("id").cast("double").alias(s) for s in Q.STATISTICS))
    q = {r.language: r for r in Q.quantiles(df).collect()}
    assert set(q) == {"en", "*"}
    for g, v in zip(Q.RANKS, q["*"].prose_share):
        assert abs(v / 20_000 - g) < 0.01


def test_prose_part_of_a_distribution():
    """Median and scale of the upper half, where labels say that half of the texts is no prose."""
    row = {"n": 10**9, **{s: [2 * max(0.0, r - 0.5) for r in Q.RANKS] for s in Q.STATISTICS}}
    known = pd.DataFrame({"language": ["en"] * 200, "other": [0, 1] * 100})
    refs = Q.references({"*": row, "en": row}, known)
    assert refs["en"]["prose_share"][0] == pytest.approx(0.5, abs=0.01)
    assert refs["en"]["prose_share"][1] == pytest.approx(0.5 / 1.349, abs=0.02)


def test_fit_separates_and_bears_wrong_labels():
    x = np.zeros((100, len(Q.STATISTICS)))
    x[:40, -1], x[40:, -1] = 0.9, 0.1
    y = np.r_[np.ones(40), np.zeros(60)]
    y[3], y[97] = 0, 1
    w, bound = Q.fit(x, y)
    assert 0.1 * w[-1] < bound < 0.9 * w[-1]
    assert Q.fit(x[:1], y[:1])[1] == Q.DEFAULT_BOUND


def test_held_out_labels(spark):
    """Agreement with the raters' labels that the fit did not see, of which a few are wrong."""
    d = "/root/testdata/sf0.1"
    stats = Q.document_statistics(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/common_words.parquet"))
    rows = Q.held_out(stats, spark.read.parquet(f"{d}/form_labels.parquet")).collect()
    n = sum(r.n for r in rows)
    assert n > 60 and sum(r.n for r in rows if r.labelled_prose == r.is_prose) > 0.95 * n

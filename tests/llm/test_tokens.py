"""Forced-boundary encoding against the plain encoder."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioweave.llm import tokens as T


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(T.VOCABULARY)


def plain(encoder, text):
    return encoder.bpe.encode_ordinary(text) if text else []


def split_encoding(encoder, texts):
    offsets, ids = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


TEXTS = [
    "it's we've I'll they'd 're 'm 's", "'''s ''t !'s 9's é's", "a  b   c\n\n\n d \t\te\r\n", "   ", "\n", " leading", "trailing  ", "x y z　w   q", "naïve café – “quoted” …",
    "日本語のテキスト。中文，全角！", "русский текст и ещё", "العربية עברית हिन्दी", "🙂👩‍👩‍👧 flags 🇩🇪", "<|endoftext|> [INST] </s>", "x" * 5_000, "ab" * 3_000, "=" * 2_000, "a1b2c3 3.14159 1,000,000", "\x00\x01\x7f�", "é ö", "http://a.b/c?d=e&f=g#h", "_under_score__ CamelCaseWord",
    "'", "''", " '", "' ", "don''t", "’s ’t", "\u0085x y",
]


@pytest.mark.parametrize("text", TEXTS)
def test_one_text(encoder, text):
    assert split_encoding(encoder, [text]) == [plain(encoder, text)]


def test_batch_with_nulls_empty_and_repeated_texts(encoder):
    texts = [None, "", *TEXTS, None, TEXTS[0], "", TEXTS[9]]
    assert split_encoding(encoder, texts) == [plain(encoder, t) for t in texts]
    sliced = pa.array(["skip me", *TEXTS], pa.string()).slice(1)
    offsets, ids = encoder.encode(sliced)
    assert ids.tolist() == [i for t in TEXTS for i in plain(encoder, t)]
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == [0]
    assert encoder.encode(pa.array([None, ""], pa.string()))[1].tolist() == []


@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'’s.t09éß中 　")), max_size=60), max_size=6))
@settings(max_examples=300, deadline=None)
def test_any_text(encoder, texts):
    assert split_encoding(encoder, texts) == [plain(encoder, t) for t in texts]


def test_long_text_of_few_cuts(encoder):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij") for _ in range(50_000)) + " " + "word " * 40_000
    assert split_encoding(encoder, [text]) == [plain(encoder, text)]


def test_cuts_never_fall_within_a_token(encoder):
    table = encoder.free
    for token in list(T.load_ranks(T.VOCABULARY))[::97]:
        assert not any(table[256 * a + b] for a, b in zip(token, token[1:]))
    assert table.any()


def test_tables(spark, encoder):
    rows = [(1, None), (2, ""), (3, "Hello, world's end"), (3, "Hello, world's end"), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = sorted(((r.doc_id or 0), r.ids) for r in T.encode_table(df).collect())
    assert got == sorted(((k or 0), plain(encoder, t)) for k, t in rows)
    counts = sorted(((r.doc_id or 0), r.n_tokens) for r in T.count_tokens(df, ["doc_id"]).collect())
    assert counts == [(k, len(ids)) for k, ids in got]
    assert T.encode_table(df.limit(0)).count() == 0


def test_blocks_hold_every_row_once(encoder, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_BYTES", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 200, "y", None, "z" * 30, "w" * 30, ""])], names=["text"])
    parts = list(T.blocks(batch, "text"))
    assert sum(p.num_rows for p in parts) == 6 and parts[0].num_rows == 1

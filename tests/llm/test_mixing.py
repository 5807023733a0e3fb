"""Weights and realised mixes."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioweave.llm import mixing as M

sizes = st.lists(st.tuples(st.one_of(st.just(0.0), st.floats(1e-6, 10)), st.integers(0, 10**6)), min_size=1, max_size=8)


@given(sizes, st.floats(0.01, 3))
@settings(max_examples=200, deadline=None)
def test_target_weights(pairs, ratio):
    target, capacity = [t for t, _ in pairs], [float(c) for _, c in pairs]
    usable = sum(c for t, c in zip(target, capacity) if t > 0)
    budget = min(ratio * sum(capacity), usable)
    scale, w = M.target_weights(target, capacity, budget)
    if not budget > 0:
        assert not any(w)
        return
    assert sum(w) == pytest.approx(1)
    free = []
    for t, c, x in zip(target, capacity, w):
        assert x * budget <= c * (1 + 1e-6) + 1e-6
        if t > 1e-6 and c > 0 and x * budget < 0.999 * c:
            free.append(x / t)
    assert not free or max(free) == pytest.approx(min(free), rel=1e-3)  # below their limits all keep their proportions


@given(st.lists(st.tuples(st.integers(1, 10**6), st.integers(1, 9)), min_size=2, max_size=8), st.floats(0, 2.5), st.floats(0.05, 4))
@settings(max_examples=200, deadline=None)
def test_temperature(sources, goal, ratio):
    sizes, caps = [float(v) for v, _ in sources], [float(v * r) for v, r in sources]
    budget = min(ratio * sum(sizes), sum(caps))
    a, w = M.temperature_weights(sizes, caps, budget, goal)
    assert 0 <= a <= M.MAX_EXPONENT and sum(w) == pytest.approx(1)  # every feasible budget is filled
    assert all(x * budget <= c * (1 + 1e-6) for x, c in zip(w, caps))
    free = M.tempered(sizes, a)
    if all(x * budget < c * 0.999 for x, c in zip(free, caps)):
        assert w == pytest.approx(free, abs=1e-9)
        low, high = M.entropy(M.tempered(sizes, M.MAX_EXPONENT)), M.entropy(M.tempered(sizes, 0))
        assert M.entropy(w) == pytest.approx(min(max(goal, low), high), abs=1e-3)


def test_temperature_where_a_limit_binds_at_exponent_one():
    """One large source that may not be repeated and a budget beyond its natural share."""
    a, w = M.temperature_weights([900.0, 100.0], [900.0, 1000.0], 1200.0, 0.3)
    assert a == 1 and w == pytest.approx([0.75, 0.25])


def _mix(spark, docs, goals, monkeypatch, bins=3, bits=2):
    monkeypatch.setattr(M, "BIN_DOCUMENTS", bins)
    monkeypatch.setattr(M, "BITS", bits)  # several steps of the search
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string, mix_name string, copies string")
    g = spark.createDataFrame(goals, "mix_name string, source string, target_share double, max_repeats int, size_ratio double")
    rows, plan = M.mixture(d, g)
    return rows.toPandas(), M.shares(rows, plan).toPandas().set_index(["mix_name", "source"])


def test_mix(spark, monkeypatch):
    docs = [(i, "word " * (1 + i % 7), "abc"[i % 3] if i % 10 else None, "x", "y") for i in range(600)] + [(900, None, "a", "x", "y"), (901, "", "a", "x", "y")]
    docs += [(1000 + i, "tiny text here", "small", "x", "y") for i in range(4)]
    goals = [("m", "a", 3.0, 1, 0.4), ("m", "b", 1.0, 2, 0.4), ("m", "none", 5.0, 9, 0.4), ("m", "c", 0.0, 1, 0.4), ("n", "small", 1.0, 3, 0.2), ("n", "a", 1.0, 2, 0.2), ("k", "b", None, 2, 0.2)]
    rows, shares = _mix(spark, docs, goals, monkeypatch)
    assert not rows.duplicated(["mix_name", "doc_id"]).any()
    limits = {(m, s): r for m, s, _, r, _ in goals}
    assert all(c <= limits[m, s] for m, s, c in zip(rows.mix_name, rows.source, rows.copies))
    assert set(rows.doc_id).isdisjoint({900, 901})
    assert shares.loc[("m", "a"), "reached_share"] == pytest.approx(0.75, abs=0.02)
    assert shares.loc[("m", "none"), "tokens"] == 0 and shares.loc[("m", "c"), "tokens"] == 0
    small = shares.loc[("n", "small")]
    assert small["most_copies"] == 3 and small["tokens"] == 4 * 3 * 3  # at its limit; the other source takes the rest
    for (m, s), r in shares.iterrows():
        assert abs(r["tokens"] - r["budget"]) <= 8, (m, s)


def test_deterministic_and_partition_free(spark, monkeypatch):
    docs = [(i, "word " * (1 + i % 5), "ab"[i % 2], "x", "y") for i in range(200)]
    goals = [("m", "a", 1.0, 1, 0.3), ("m", "b", 2.0, 2, 0.3)]
    a = _mix(spark, docs, goals, monkeypatch)[0]
    b = _mix(spark, docs[::-1], goals, monkeypatch)[0]
    order = ["mix_name", "doc_id"]
    pd.testing.assert_frame_equal(a.sort_values(order).reset_index(drop=True), b.sort_values(order).reset_index(drop=True))


def test_steps_do_not_change_the_mix(spark, monkeypatch):
    docs = [(i, "word " * (1 + i % 5), "ab"[i % 2], "x", "y") for i in range(300)]
    goals = [("m", "a", 1.0, 1, 0.3), ("m", "b", 2.0, 2, 0.3), ("n", "a", 1.0, 2, 0.5)]
    order = ["mix_name", "doc_id"]
    got = [_mix(spark, docs, goals, monkeypatch, 3, bits)[0].sort_values(order).reset_index(drop=True) for bits in (1, 10)]
    pd.testing.assert_frame_equal(*got)


def test_empty(spark, monkeypatch):
    rows, shares = _mix(spark, [], [("m", "a", 1.0, 1, 0.3)], monkeypatch)
    assert rows.empty and shares["tokens"].tolist() == [0]
    assert _mix(spark, [(1, "a", "a", "x", "y")], [], monkeypatch)[0].empty

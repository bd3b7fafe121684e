"""Interpolation against a direct definition and against literal values."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidegrid.operators.interpolate import fill_edges, interpolate, levels_for


def by_hand(values, limit):
    """Each missing cell from its nearest valid neighbours, looked up one by one."""
    out = []
    for i, v in enumerate(values):
        if v is not None:
            out.append(v)
            continue
        before = [j for j in range(i) if values[j] is not None]
        after = [j for j in range(i + 1, len(values)) if values[j] is not None]
        near = [d for d in ([i - before[-1]] if before else []) + ([after[0] - i] if after else [])]
        if not near or (limit is not None and min(near) > limit):
            out.append(None)
        elif not before:
            out.append(values[after[0]])
        elif not after:
            out.append(values[before[-1]])
        else:
            p, n = before[-1], after[0]
            out.append(values[p] + (values[n] - values[p]) * (i - p) / (n - p))
    return out


def run(panel, series, **options):
    rows = interpolate(panel(series), ["series"], "pos", ["m1"], **options).collect()
    got = {s: [None] * len(v) for s, v in series.items()}
    for r in rows:
        got[r["series"]][r["pos"]] = r["m1"]
    return got


MICRO = (
    [None] * 8 + [1.0] + [None] * 5 + [7.0] + [None] * 12 + [20.0] + [None] * 13 + [34.0]
    + [None] * 20 + [1.0] + [None] * 9
)


@pytest.mark.parametrize("size", [8192, 5, 3])
def test_micro_panel_with_gaps_and_edges(panel, size):
    got = run(panel, {"a": MICRO}, limit=6, size=size)["a"]
    assert len(MICRO) == 72
    missing = [i for i, v in enumerate(got) if v is None]
    # two leading, the middle of the gap of 13, eight of the gap of 20, three trailing
    assert missing == [0, 1] + [34] + list(range(48, 56)) + [69, 70, 71]
    assert got[2:9] == [1.0] * 7
    assert got[9:15] == pytest.approx([2, 3, 4, 5, 6, 7])
    assert got[63:69] == [1.0] * 6


@pytest.mark.parametrize("limit", [6, None])
def test_equals_pandas(panel, limit):
    want = pd.Series(MICRO, dtype="float64").interpolate(limit=limit, limit_direction="both")
    got = pd.Series(run(panel, {"a": MICRO}, limit=limit)["a"], dtype="float64")
    pd.testing.assert_series_equal(got, want, check_names=False)


cell = st.one_of(st.none(), st.none(), st.floats(-100, 100, width=16))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    series=st.dictionaries(st.sampled_from("abc"), st.lists(cell, min_size=1, max_size=40), min_size=1),
    limit=st.sampled_from([1, 3, None]),
    size=st.sampled_from([2, 4, 8192]),
)
def test_blocks_do_not_change_the_result(panel, series, limit, size):
    got = run(panel, series, limit=limit, size=size)
    for name, values in series.items():
        assert got[name] == pytest.approx(by_hand(values, limit), nan_ok=True)


def test_one_series_holding_most_rows(panel):
    rng = random.Random(7)
    series = {f"s{i}": [rng.choice([None, float(i)]) for _ in range(5)] for i in range(20)}
    series["hot"] = [float(i) if rng.random() < 0.05 else None for i in range(900)]
    got = run(panel, series, limit=6, size=16)
    for name, values in series.items():
        assert got[name] == pytest.approx(by_hand(values, 6))


def test_all_missing_series_stays_missing(panel):
    assert run(panel, {"a": [None] * 4, "b": [None, 2.0]}, limit=None) == {"a": [None] * 4, "b": [2.0, 2.0]}


def test_edges_fill_forward_then_backward(panel):
    df = fill_edges(panel({"a": [None, 1.0, None, 3.0, None]}), ["series"], "pos", ["m1"], size=2)
    assert [r["m1"] for r in df.orderBy("pos").collect()] == [1.0, 1.0, 1.0, 3.0, 3.0]


def test_other_columns_and_order_are_kept(panel):
    df = panel({"a": [1.0, None, 3.0]}).selectExpr("series", "t", "m1", "pos", "'x' AS tag")
    out = interpolate(df, ["series"], "pos", ["m1"], flag_suffix="_filled", size=2)
    assert out.columns == ["series", "t", "m1", "pos", "tag", "m1_filled"]
    assert [r["m1_filled"] for r in out.orderBy("pos").collect()] == [False, True, False]


def test_level_count():
    assert [levels_for(n, 10) for n in (1, 10, 11, 100, 101, 1001)] == [0, 0, 1, 1, 2, 3]

"""Shuffles over many small groups cost what their rows cost, and keep their law."""

import numpy as np
import pandas as pd
import pytest

from orderlens.plans import stats as st


def test_many_small_groups_are_cut_from_shuffled_rows(monkeypatch):
    """No count is drawn by group and value: 300 groups of 40 rows over 100 values."""
    def never(*_):
        raise AssertionError("drawn by group and value")

    monkeypatch.setattr(st, "_draw", never)
    left = np.full((5, 100), 120)
    draws = pd.DataFrame([{"values": np.arange(100.0), "counts": np.full(100, 120), "draw": left.ravel(), "kind": "mean"}])
    groups = pd.DataFrame({"g": [f"{i:03d}" for i in range(300)], "n": np.full(300, 40)})
    out = st._group_statistics(1)(("t", 0, 2), draws, groups)
    assert list(out.rep) == [200, 201, 202, 203, 204] and (out.k == 300).all()
    assert np.allclose(out.s1, 0) and out.s2.to_numpy() / 300 == pytest.approx(np.full(5, np.var(np.arange(100)) / 40), rel=0.35)


@pytest.mark.parametrize("y", [np.array([0.0, 1.0]), np.array([1.0, 2.5, 90.0])])
def test_shuffled_and_drawn_sums_have_the_same_law(monkeypatch, y):
    counts = np.arange(3, 3 + len(y)) * 4
    sizes = np.array([1, 5, counts.sum() - 6])
    left, found = np.tile(counts, (6000, 1)), []
    for few in (0, st.FEW_GROUPS):
        monkeypatch.setattr(st, "FEW_GROUPS", few)
        found.append(np.array(list(st.chunk_sums(np.random.default_rng(4), y, left, sizes))))
    cut, drawn = found
    assert cut.shape == drawn.shape == (3, 6000) and np.allclose(cut.sum(axis=0), counts @ y) and np.allclose(drawn.sum(axis=0), counts @ y)
    error = drawn.std(axis=1) / np.sqrt(3000)
    assert (np.abs(cut.mean(axis=1) - drawn.mean(axis=1)) < 5 * error).all()
    assert cut.std(axis=1) == pytest.approx(drawn.std(axis=1), rel=0.06)
    assert np.corrcoef(cut)[0, 1] == pytest.approx(np.corrcoef(drawn)[0, 1], abs=0.06)

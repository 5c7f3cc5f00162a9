"""Caps and bins against numpy and pandas, including the cut into runs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tallycart.operators import quantiles


def columns(n: int, seed: int) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    skewed = rng.exponential(3, n)
    holes = rng.normal(size=n)
    holes[rng.random(n) < 0.3] = np.nan
    return pd.DataFrame(
        {
            "skewed": skewed,
            "small": rng.integers(0, 4, n).astype(float),
            "mostly_zero": np.where(rng.random(n) < 0.9, 0.0, skewed),
            "holes": holes,
            "ratio": rng.integers(0, 20, n) / rng.integers(1, 9, n),
            "constant": np.full(n, 3.0),
        }
    )


def to_spark(spark, frame):
    rows = [[None if pd.isna(v) else float(v) for v in r] for r in frame.to_numpy()]
    schema = ", ".join(f"{c} double" for c in frame)
    rows = [[i, *r] for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, f"id long, {schema}")


def expected(series: pd.Series, cap: float | None, bins: int):
    values = series
    if cap is not None:
        limit = np.percentile(series.dropna(), cap * 100)
        values = pd.Series(np.where(series > limit, limit, series))
    return values, pd.qcut(values, q=bins, labels=False, duplicates="drop")


@pytest.mark.parametrize("run_values", [10, 100_000])
@pytest.mark.parametrize(("n", "seed"), [(500, 1), (40, 2), (9, 3), (3, 4)])
@pytest.mark.parametrize("bins", [8, 16])
def test_cap_then_bin_equals_pandas(spark, monkeypatch, run_values, n, seed, bins):
    monkeypatch.setattr(quantiles, "SLOT_VALUES", run_values)
    frame = columns(n, seed)
    names = list(frame)
    df = to_spark(spark, frame)
    fitted = quantiles.fit([(df, names)], bins=bins)
    got = quantiles.apply_fit(df, fitted, names, names).orderBy("id").toPandas()
    for c in names:
        values, numbers = expected(frame[c], 0.95, bins)
        np.testing.assert_allclose(got[c].astype(float), values, rtol=1e-12, err_msg=c)
        np.testing.assert_array_equal(
            got[f"{c}_bin"].astype(float), numbers.astype(float), err_msg=c
        )


def test_bins_without_cap(spark):
    frame = columns(200, 5)
    got = quantiles.bin_values(to_spark(spark, frame), list(frame), 5).orderBy("id").toPandas()
    for c in frame:
        _, numbers = expected(frame[c], None, 5)
        np.testing.assert_array_equal(got[f"{c}_bin"].astype(float), numbers.astype(float))


def test_empty_column_stays_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    got = quantiles.apply_fit(df, quantiles.fit([(df, ["x"])]), ["x"], ["x"]).collect()
    assert [tuple(r) for r in got] == [(None, None)] * 2


def test_cap_never_raises_and_bins_follow_order(spark):
    frame = columns(300, 6)
    df = to_spark(spark, frame)
    names = list(frame)
    got = quantiles.apply_fit(df, quantiles.fit([(df, names)]), names, names).orderBy("id")
    got = got.toPandas()
    for c in names:
        both = frame[c].notna()
        assert (got[c][both].astype(float) <= frame[c][both]).all()
        ordered = got.assign(raw=frame[c])[both].sort_values("raw")[f"{c}_bin"].dropna()
        assert ordered.astype(float).is_monotonic_increasing


def test_tables_are_fitted_together(spark):
    left = to_spark(spark, columns(60, 7)).select("id", "skewed")
    right = to_spark(spark, columns(90, 8)).select("id", "ratio")
    together = quantiles.fit([(left, ["skewed"]), (right, ["ratio"])])
    apart = {**quantiles.fit([(left, ["skewed"])]), **quantiles.fit([(right, ["ratio"])])}
    assert together == apart


def test_nan_is_missing_and_infinity_a_value(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0, nan, None, inf)], "x double")
    capped = [r.x for r in quantiles.cap_values(df, ["x"], 75).collect()]
    assert sorted(x for x in capped if x is not None) == [1.0, 2.0, 3.0, 4.0, 4.0] and capped.count(None) == 2
    bins = [r.x_bin for r in quantiles.bin_values(df, ["x"], 2).collect()]
    assert bins.count(None) == 2


def test_a_frequent_value_ends_the_cutting(spark, monkeypatch):
    """Many rare values below one frequent value: each cutting used to take off one of them."""
    monkeypatch.setattr(quantiles, "SLOT_VALUES", 100)
    calls = []
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: calls.append(1) or narrowed(*a))
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.random(400), np.full(3000, 1.0), 1 + rng.random(2000)])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(x)], "x double")
    probs = [0.0, 0.06, 0.1, 0.5, 0.95, 1.0]
    got = quantiles.order_statistics([(df, ["x"])], probs)["x"]
    for p in probs:
        assert got[p].value() == pytest.approx(np.quantile(x, p), rel=1e-12)
    assert len(calls) <= 3

"""Small hand-made logs, one per rule that is easy to get wrong."""

from __future__ import annotations

from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallycart.functions import decode, ratios
from tallycart.operators import grains, quantiles, sequences
from tallycart.plans import families

CLICK, CART, BUY, FAV = "click", "add-to-cart", "purchase", "add-to-favorite"


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_promo_columns_carry_their_own_action(make_log):
    day, other = (11, 11), (5, 1)
    rows = [(1, 1, 1, 1, 1, day, a) for a in (CLICK, CART, BUY, FAV)]
    rows += [(1, 1, 1, 1, 1, other, CLICK)] * 3 + [(1, 1, 1, 1, 1, other, BUY)]
    r = only(grains.user_grain(make_log(rows)))
    assert (r.u_click_1111, r.u_add_to_cart_1111) == (1, 1)
    assert (r.u_purchase_1111, r.u_add_to_favorite_1111) == (1, 1)
    assert r.u_click_1111_ratio == 0.25
    assert r.u_purchase_1111_ratio == 0.5
    assert r.u_add_to_cart_1111_ratio == 1.0


def test_action_that_never_occurs_counts_zero(make_log):
    r = only(grains.merchant_grain(make_log([(1, 1, 1, 1, 1, (11, 11), CLICK)] * 3)))
    assert (r.m_click, r.m_fav, r.m_add_to_favorite_1111) == (3, 0, 0)


def test_key_without_promo_day_gets_zeros_even_for_totals(make_log, make_matrix):
    log = make_log(
        [(1, 1, 1, 1, 1, (11, 11), CLICK), (1, 2, 1, 1, 1, (5, 1), CLICK), (2, 2, 1, 1, 1, (5, 1), BUY)]
    )
    out = families.add_merchant_1111_features(make_matrix([(1, 1), (1, 2)]), log)
    rows = {r.merchant_id: r for r in out.collect()}
    assert rows[2].m_click_total == 0
    assert rows[2].m_click_1111_ratio_bin == 0
    assert rows[1].m_click_total == 1


def test_percentile_population_differs_by_scope(make_log, make_matrix):
    # User 1 has many pairs in the matrix; among users it is one of four.
    rows = [(1, m, 1, 1, 1, (11, 11), CLICK) for m in range(1, 11)]
    rows += [(u, 1, 1, 1, 1, (11, 11), CLICK) for u in (2, 3, 4)]
    log = make_log(rows)
    matrix = make_matrix([(1, m) for m in range(1, 11)] + [(u, 1) for u in (2, 3, 4)])
    over_pairs = {r.user_id: r for r in families.add_user_features(matrix, log).collect()}
    over_users = {r.user_id: r for r in families.add_user_1111_features(matrix, log).collect()}
    assert over_pairs[1].u_click == np.percentile([10] * 10 + [1] * 3, 95)
    assert over_users[1].u_click_1111 == pytest.approx(np.percentile([10, 1, 1, 1], 95))


def test_equal_counts_take_the_lowest_id(make_log):
    log = make_log([(1, 1, 1, 1, b, (5, 1), CLICK) for b in (9, 4, 9, 4)])
    r = only(grains.top_brand_per_pair(log))
    assert (r.top_brand_id, r.freq_brand) == (4, 2)


def test_unknown_brand_can_be_the_favourite(make_log):
    log = make_log([(1, 1, 1, 1, b, (5, 1), CLICK) for b in (0, 0, 4)])
    assert only(grains.top_brand_per_pair(log)).top_brand_id == 0


def test_cart_and_purchase_on_one_day_follow_the_sequence(make_log):
    rows = [(1, 1, 1, 1, 1, (5, 1), CART), (1, 1, 1, 1, 1, (5, 1), BUY)]
    rows += [(2, 1, 1, 1, 1, (5, 1), BUY), (2, 1, 1, 1, 1, (5, 1), CART)]
    got = {r.user_id: r[2] for r in sequences.cart_purchase_interval(make_log(rows)).collect()}
    assert got == {1: 0.0}


def test_session_breaks_only_above_the_gap(make_log):
    rows = [(1, 1, 1, 1, 1, d, CLICK) for d in ((5, 1), (5, 8), (5, 8))]
    rows += [(2, 1, 1, 1, 1, d, CLICK) for d in ((5, 1), (5, 9))]
    got = {(r.user_id, r.session_id): r for r in sequences.sessions(make_log(rows)).collect()}
    assert sorted(got) == [(1, 0), (2, 0), (2, 1)]
    assert got[1, 0].session_action_count == 3
    assert got[1, 0].session_duration == 7 * 86400


def test_gap_between_purchases(make_log):
    rows = [(1, 1, 1, 1, 1, (5, 1), CLICK), (2, 1, 1, 1, 1, (5, 1), BUY)]
    rows += [(3, 1, 1, 1, 1, (5, 1), BUY), (3, 1, 1, 1, 1, (5, 11), BUY)]
    got = grains.user_grain(make_log(rows), ["u_avg_days_between_purchases"]).collect()
    assert {r.user_id: r[1] for r in got} == {1: None, 2: 185.0, 3: 10.0}


def test_recency_and_gap_defaults(make_log, make_matrix):
    rows = [(1, 1, 1, 1, 1, (5, 1), CLICK), (2, 1, 1, 1, 1, (5, 1), BUY), (3, 9, 1, 1, 1, (5, 4), BUY)]
    out = families.add_rfm_and_repurchase_features(make_matrix([(1, 1), (2, 1)]), make_log(rows))
    got = {r.user_id: r for r in out.collect()}
    assert (got[1].R, got[1].F, got[1].repurchase_gap_std) == (0, 0, 0)
    # The last purchase of the log belongs to a pair outside the matrix.
    assert (got[2].R, got[2].F, got[2].M, got[2].repurchase_gap_mean) == (3, 1, 1, 0)


def test_ratio_policies(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (None, 2), (3, None), (0, 0)], "n long, d long")
    n, d = F.col("n"), F.col("d")
    got = df.select(
        ratios.ratio_or_zero(n, d), ratios.ratio_zero_as_one(n, d), ratios.ratio_if_positive(n, d)
    ).collect()
    assert [r[0] for r in got] == [0.0, 1.5, 0.0, 0.0, 0.0]
    assert [r[1] for r in got] == [3.0, 1.5, None, None, 0.0]
    assert [r[2] for r in got] == [0.0, 1.5, None, 0.0, 0.0]


def test_dates_and_codes(spark):
    days = spark.createDataFrame([("0229",), ("0230",), (" ",)], "t string")
    got = days.select(decode.parse_day(F.col("t"), lenient=True)).collect()
    assert [r[0] for r in got] == [date(2016, 2, 29), None, None]
    codes = spark.createDataFrame([(0, 2), (8, None), (None, 0), (1, 1)], "a int, g int")
    got = codes.select(decode.age_name(F.col("a")), decode.gender_name(F.col("g"))).collect()
    assert [tuple(r) for r in got] == [
        ("unknown", "unknown"), ("eighth group", "unknown"), ("unknown", "female"), ("first group", "male"),
    ]


def test_days_of_one_and_two_digits(spark):
    texts = {"829": (8, 29), "0829": (8, 29), "512": (5, 12), "111": (11, 1), "1111": (11, 11), "110": (1, 10), "13": (1, 3), "93": (9, 3)}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for lenient in (False, True):
        got = rows.select("t", decode.parse_day(F.col("t"), lenient=lenient).alias("d")).collect()
        assert {r.t: (r.d.month, r.d.day) for r in got} == texts
    bad = spark.createDataFrame([("1",), ("000",), ("12345",), (None,)], "t string")
    assert {r[0] for r in bad.select(decode.parse_day(F.col("t"), lenient=True)).collect()} == {None}


def test_bad_day_raises_when_strict(spark):
    df = spark.createDataFrame([("0230",)], "t string")
    with pytest.raises(Exception, match="(?i)date|parse|value"):
        df.select(decode.parse_day(F.col("t"))).collect()


def hot_log(rng, rows: int):
    """Random actions; a third of all rows belong to one pair and one brand."""
    frame = pd.DataFrame(
        {
            "user_id": np.where(rng.random(rows) < 0.34, 1, rng.integers(1, 30, rows)),
            "item_id": rng.integers(1, 50, rows),
            "cat_id": rng.integers(1, 6, rows),
            "brand_id": np.where(rng.random(rows) < 0.34, 0, rng.integers(1, 9, rows)),
            "day": rng.integers(0, 40, rows),
            "action_type": rng.choice([CLICK, CART, BUY, FAV], rows),
            "seq1": rng.permutation(rows),
        }
    )
    frame["merchant_id"] = np.where(frame.user_id == 1, 7, rng.integers(1, 10, rows))
    frame["dt"] = [date(2016, 10, 20) + pd.Timedelta(days=int(d)) for d in frame.day]
    frame["seq2"] = 0
    return frame


@pytest.fixture(scope="module")
def hot(spark):
    frame = hot_log(np.random.default_rng(11), 3000)
    from tests.conftest import LOG_SCHEMA

    order = [f.split()[0] for f in LOG_SCHEMA.split(", ")]
    rows = frame[order].astype(object).values.tolist()
    return frame, spark.createDataFrame(rows, LOG_SCHEMA)


@pytest.mark.parametrize("run_length", [7, 1 << 16])
def test_interval_of_a_hot_pair_equals_brute_force(hot, monkeypatch, run_length):
    monkeypatch.setattr(sequences, "RUN_LENGTH", run_length)
    frame, log = hot
    part = frame[frame.action_type.isin([CART, BUY])].sort_values(["dt", "seq1"])
    want = {}
    for key, g in part.groupby(["user_id", "merchant_id"]):
        acts, days = g.action_type.tolist(), g.day.tolist()
        gaps = [
            days[i + 1] - days[i]
            for i in range(len(acts) - 1)
            if acts[i] == CART and acts[i + 1] == BUY
        ]
        if gaps:
            want[key] = float(np.mean(gaps))
    got = {(r[0], r[1]): r[2] for r in sequences.cart_purchase_interval(log).collect()}
    assert got == pytest.approx(want)


def test_gap_stats_of_a_hot_pair_equal_brute_force(hot):
    frame, log = hot
    bought = frame[frame.action_type == BUY].sort_values("day")
    gaps = bought.groupby(["user_id", "merchant_id"]).day.diff()
    want = gaps.groupby([bought.user_id, bought.merchant_id]).agg(["mean", "std", "min", "max"])
    got = sequences.gap_stats(log.filter(grains.is_action(BUY))).toPandas()
    got = got.set_index(["user_id", "merchant_id"]).sort_index().astype(float)
    np.testing.assert_allclose(got.to_numpy(), want.sort_index().to_numpy(), rtol=1e-9, atol=1e-9)


def test_sessions_of_a_hot_user_equal_brute_force(hot):
    frame, log = hot
    part = frame.sort_values(["user_id", "day"])
    new = part.groupby("user_id").day.diff() > 1
    number = new.groupby(part.user_id).cumsum()
    counts = part.groupby(["user_id", number.rename("s")]).size()
    got = {(r.user_id, r.session_id): r.session_action_count for r in sequences.sessions(log, 1).collect()}
    assert got == counts.to_dict()


def test_grains_of_a_hot_key_equal_brute_force(hot):
    frame, log = hot
    by_user = frame.groupby("user_id")
    got = grains.user_grain(log).toPandas().set_index("user_id").sort_index()
    for column, source in (("u_iid", "item_id"), ("u_bid", "brand_id"), ("u_active_days", "day")):
        pd.testing.assert_series_equal(
            got[column], by_user[source].nunique(), check_names=False, check_dtype=False
        )
    assert (got[["u_click", "u_cart", "u_purchase", "u_fav"]].sum().sum()) == len(frame)
    brands = grains.brand_grain(log).toPandas().set_index("brand_id").sort_index()
    want = frame.groupby("brand_id").merchant_id.nunique()
    pd.testing.assert_series_equal(
        brands.b_unique_merchants, want, check_names=False, check_dtype=False
    )


@pytest.fixture(scope="module")
def gappy(spark):
    """A log with null keys, values, days and actions."""
    rng = np.random.default_rng(5)

    def some(high):
        return [None if rng.random() < 0.15 else int(x) for x in rng.integers(0, high, 2000)]

    days = [None if d is None else date(2016, 11, 1 + d) for d in some(25)]
    actions = [None if a is None else list(grains.ACTIONS.values())[a] for a in some(4)]
    columns = [some(7), some(5), some(30), some(6), some(4), days, actions]
    names = ["user_id", "merchant_id", "item_id", "cat_id", "brand_id", "dt", "action_type"]
    kinds = "user_id long, merchant_id long, item_id long, cat_id long, brand_id long, dt date, action_type string"
    rows = list(zip(*columns))
    return [dict(zip(names, r)) for r in rows], spark.createDataFrame(rows, kinds).repartition(4)


@pytest.mark.parametrize("crowded, batch", [(10**9, 50), (10**9, 10**9), (0, 10**9), (280, 50)])
def test_distinct_counts_with_nulls_equal_brute_force(gappy, monkeypatch, crowded, batch):
    rows, log = gappy
    monkeypatch.setattr(grains, "CROWDED", crowded)
    monkeypatch.setattr(grains, "BATCH_ROWS", batch)

    def known(keys, value, when=lambda r: True):
        found = {tuple(r[k] for k in keys): set() for r in rows}
        for r in rows:
            if r[value] is not None and when(r):
                found[tuple(r[k] for k in keys)].add(r[value])
        return {k: len(v) for k, v in found.items()}

    users = {(r.user_id,): r for r in grains.user_grain(log).collect()}
    for column, value in (("u_iid", "item_id"), ("u_mid", "merchant_id"), ("u_active_days", "dt")):
        assert {k: r[column] for k, r in users.items()} == known(["user_id"], value)
    bought = known(["user_id"], "dt", lambda r: r["action_type"] == "purchase")
    assert {k: r.u_purchase_days for k, r in users.items()} == bought
    assert sum(r.u_purchase for r in users.values()) == sum(r["action_type"] == "purchase" for r in rows)
    pairs = {(r.user_id, r.merchant_id): r.um_cid for r in grains.pair_grain(log).collect()}
    assert pairs == known(["user_id", "merchant_id"], "cat_id")


def test_distinct_counts_make_no_row_for_each_field(hot):
    plan = grains.user_grain(hot[1])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan


def test_wide_projections_are_generated_in_parts(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    wide = spark.range(20).selectExpr(*[f"cast(id as double) as c{i}" for i in range(20)])
    fitted = quantiles.fit([(wide, wide.columns)])
    quantiles.apply_fit(wide, fitted, wide.columns, wide.columns)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_only_asked_for_columns_are_built(hot):
    _, log = hot
    assert grains.user_grain(log, ["u_iid"]).columns == ["user_id", "u_iid"]
    plan = grains.user_grain(log, ["u_click_1111"])._jdf.queryExecution().optimizedPlan().toString()
    assert "brand_id" not in plan.split("LogicalRDD")[0].split("LocalRelation")[0]


def test_join_keeps_the_matrix_rows_and_repeats_nothing(hot, make_matrix):
    frame, log = hot
    pairs = sorted(set(zip(frame.user_id.tolist(), frame.merchant_id.tolist())))[:40] + [(999, 999)]
    matrix = make_matrix(pairs)
    wide = families.attach(matrix, log, families.FULL_SET)
    assert wide.count() == len(pairs)
    assert len(set(wide.columns)) == len(wide.columns)
    again = families.attach(wide, log, [families.USER, families.BRAND])
    assert again.columns == wide.columns
    stranger = only(wide.filter("user_id = 999"))
    assert stranger.um_click is None
    assert stranger.um_purchase_per_click == 0
    assert stranger.um_avg_cart_purchase_interval == -1


def test_more_rows_are_dealt_over_more_tasks_for_sessions(spark, make_log, monkeypatch):
    rows = [(u, 1, 1, 1, 1, (1 + d % 2, 1 + d), "click") for u in range(40) for d in range(20)]
    log = make_log(rows)
    whole = sorted(map(tuple, sequences.sessions(log).collect()))
    monkeypatch.setattr(sequences, "TASK_ROWS", 100)
    dealt = sequences.sessions(log)
    assert dealt.rdd.getNumPartitions() == 8
    assert sorted(map(tuple, dealt.collect())) == whole

"""Pruning, encoding, graph and model operators on small data."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallycart.operators import encoding, graph, models, pruning
from tallycart.plans import runs
from tallycart.sources.loader import DataLoader, save_predictions


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    n = 400
    a = rng.normal(size=n)
    frame = pd.DataFrame(
        {
            "a": a,
            "b": a * 2 + rng.normal(size=n) * 0.1,
            "c": rng.normal(size=n) + 1e6,
            "d": np.where(rng.random(n) < 0.4, np.nan, a + rng.normal(size=n)),
            "e": np.full(n, 2.0),
            "label": (a > 0.3).astype(float),
        }
    )
    rows = [[None if pd.isna(v) else float(v) for v in r] for r in frame.to_numpy()]
    return frame, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame))


def test_correlations_use_rows_where_both_are_present(numbers):
    frame, df = numbers
    names = ["a", "b", "c", "d", "e"]
    want = frame[names].corr()
    for r in pruning.correlations(df, names).collect():
        expected = want.iloc[r.i, r.j]
        assert (r["corr"] is None) if np.isnan(expected) else r["corr"] == pytest.approx(expected)


def test_the_later_of_two_correlated_columns_is_dropped(numbers):
    assert pruning.drop_high_corr_features(numbers[1]) == (["b"], ["a", "c", "d", "e"])


def test_anova_against_its_definition(numbers):
    frame, df = numbers
    got = {r.feature: r.f_score for r in pruning.anova_scores(df, ["a", "c", "d", "e"]).collect()}
    for c in ("a", "c", "d"):
        x = frame[[c, "label"]].dropna()
        groups = [g[c] for _, g in x.groupby("label")]
        between = sum(len(g) * (g.mean() - x[c].mean()) ** 2 for g in groups)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - 2)
        assert got[c] == pytest.approx(between / within, rel=1e-4)
    assert got["e"] is None
    assert pruning.select_features(df, k=2) == ["a", "b"]


def test_column_pruning(spark):
    df = spark.createDataFrame(
        [(1, 5.0, None, 2.0, 0, 7.0, None), (2, 5.0, None, 3.0, 1, 8.0, None)],
        "k int, flat double, hollow double, x double, x_bin int, y double, y_bin int",
    )
    assert pruning.constant_columns(df) == ["flat"]
    assert pruning.empty_columns(df) == ["hollow", "y_bin"]
    assert pruning.binned_originals(df) == ["x"]


def test_text_is_encoded_alphabetically(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("z",)], "t string")
    got = [r.t for r in encoding.encode_labels(df).collect()]
    assert got == [1.0, 2.0, 0.0, 3.0]
    with pytest.raises(ValueError, match="text"):
        pruning.require_no_text(df)


def test_two_rounds_of_neighbour_means(make_log):
    log = make_log([(1, 5, 1, 1, 1, (5, 1), "click")] * 2 + [(2, 5, 1, 1, 1, (5, 1), "click")])
    got = {(r.kind, r.id): r.v0 for r in graph.bipartite_vectors(log, 2).collect()}
    start = {
        (kind, id_): int(hashlib.md5(f"{kind}:{id_}:0".encode()).hexdigest()[:8], 16) / 2**32
        for kind, id_ in (("user", 1), ("user", 2), ("merchant", 5))
    }
    for _ in range(2):
        heard = (2 * start["user", 1] + start["user", 2]) / 3
        start = {
            ("user", 1): (start["user", 1] + start["merchant", 5]) / 2,
            ("user", 2): (start["user", 2] + start["merchant", 5]) / 2,
            ("merchant", 5): (start["merchant", 5] + heard) / 2,
        }
    assert got == pytest.approx(start, abs=1e-9)


def test_one_way_edges_leave_users_alone(make_log):
    log = make_log([(1, 5, 1, 1, 1, (5, 1), "click")])
    got = {r.kind: r.v0 for r in graph.bipartite_vectors(log, 1, both_directions=False).collect()}
    digest = int(hashlib.md5(b"user:1:0").hexdigest()[:8], 16)
    assert got["user"] == pytest.approx(digest / 2**32, abs=1e-9)


def test_auc_counts_ties_by_half(spark):
    rows = [(0.1, 0.0), (0.4, 0.0), (0.4, 1.0), (0.8, 1.0), (0.8, 0.0)]
    df = spark.createDataFrame(rows, "prob double, label double")
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert models.auc(df) == pytest.approx(want)


@pytest.fixture(scope="module")
def small_matrix(spark):
    rng = np.random.default_rng(5)
    rows = []
    for u in range(200):
        x = float(rng.normal())
        y = float(x + rng.normal() * 0.5 > 0)
        train = u % 4 != 0
        rows.append((u, u % 7, "train" if train else "test", y if train else None, x, None if u % 5 else 1.0, "ab"[u % 2]))
    schema = "user_id long, merchant_id long, origin string, label double, x double, holes double, t string"
    return spark.createDataFrame(rows, schema)


def test_folds_are_whole_and_repeatable(small_matrix):
    folded = models.with_folds(small_matrix, 5)
    assert {r.fold for r in folded.select("fold").distinct().collect()} == set(range(5))
    assert folded.exceptAll(models.with_folds(small_matrix, 5)).count() == 0


def test_model_scores_every_pair_without_label(small_matrix, spark, tmp_path):
    model = models.RepurchaseModel(small_matrix, models.BoostParams(depth=2))
    model.train_model(use_kfold=True, num_boost_round=3, n_splits=3)
    assert len(model.fold_aucs) == 3
    assert model.holdout_auc > 0.7
    scores = model.scores()
    assert scores.count() == 50
    assert scores.filter("prob < 0 or prob > 1 or prob is null").count() == 0
    assert model.importance().first().feature == "x"
    pairs = small_matrix.filter("origin = 'test'")
    save_predictions(scores, pairs, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["user_id", "merchant_id", "prob"]
    assert back.count() == 50


def test_stacking_gives_each_pair_its_own_score(small_matrix):
    out = models.add_model_ensemble_features(small_matrix, n_splits=3, trees=3, rounds=2)
    assert out.count() == 200
    assert out.filter("rf_pred is null or xgb_pred is null").count() == 0
    # Scores of the half without labels are real scores, not fills.
    assert out.filter("origin = 'test'").select(F.countDistinct("rf_pred")).first()[0] > 1


def test_files_to_matrix(spark, tmp_path):
    folder = tmp_path / "data_format1"
    folder.mkdir()
    (folder / "user_log_format1.csv").write_text(
        "user_id,item_id,cat_id,seller_id,brand_id,time_stamp,action_type\n"
        "1,10,3,7,,0829,0\n1,11,3,7,5,1111,2\n2,12,4,8,6,0229,9\n"
    )
    (folder / "user_info_format1.csv").write_text("user_id,age_range,gender\n1,3,1\n2,,2\n")
    (folder / "train_format1.csv").write_text("user_id,merchant_id,label\n1,7,1\n")
    (folder / "test_format1.csv").write_text("user_id,merchant_id,prob\n2,8,\n")
    loader = DataLoader(spark, str(tmp_path))
    inputs = runs.load(loader)
    rows = inputs.log.orderBy("seq1").collect()
    assert [r.action_type for r in rows] == ["click", "purchase", None]
    assert [r.brand_id for r in rows] == [0, 5, 6]
    assert rows[2].dt.isoformat() == "2016-02-29"
    matrix = {r.user_id: r for r in runs.short_matrix(inputs).collect()}
    assert (matrix[1].label, matrix[1].gender, matrix[1].age_range) == (1.0, "male", "third group")
    assert (matrix[2].label, matrix[2].gender, matrix[2].age_range) == (None, "unknown", "unknown")
    # One click against none in the other pair, capped at the 95th percentile of both.
    assert matrix[1].um_click == pytest.approx(np.percentile([1, 0], 95))


def test_training_ends_after_the_patience_and_keeps_the_best_round(small_matrix):
    model = models.RepurchaseModel(small_matrix, models.BoostParams(depth=3, step=0.5, patience=3))
    model.fit(num_boost_round=40)
    assert model.best_round == len(model.model) < 40
    assert len(model.losses) == model.best_round + 3
    assert min(model.losses) == model.losses[model.best_round - 1]


def test_labels_are_numbered_across_partitions(spark):
    names = [f"n{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(n, None if i % 7 == 0 else n[-1]) for i, n in enumerate(names)], "a string, b string")
    got = encoding.encode_labels(df.repartition(5)).collect()
    assert sorted(r.a for r in got) == [float(i) for i in range(500)]
    assert {r.b for r in got} == {float(i) for i in range(11)}


def test_factors_of_wide_ids(make_log):
    log = make_log([(10**12 + u, 10**13 + u % 3, 1, 1, 1, (5, 1), "click") for u in range(9)])
    users, merchants = graph.factorise_pairs(log, rank=4)
    assert {r.user_id for r in users.collect()} == {10**12 + u for u in range(9)}
    assert merchants.columns == ["merchant_id", "m_als_0", "m_als_1", "m_als_2", "m_als_3"] and merchants.count() == 3


def test_start_vectors_tell_nodes_apart(spark):
    points = spark.range(5000).selectExpr("if(id % 2 = 0, 'user', 'merchant') as kind", "id")
    vectors = graph.start_vectors(points)
    assert vectors.select("v0", "v7").distinct().count() == 5000
    assert abs(vectors.select(F.corr("v0", "v1")).first()[0]) < 0.1


def test_scratch_is_dropped(spark, tmp_path, monkeypatch):
    from tallycart import session

    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(tmp_path))
    session.stage(spark.range(3), "x")
    assert any(tmp_path.rglob("*.parquet"))
    session.drop_scratch(spark)
    assert not any(tmp_path.rglob("*"))


def test_first_trees_give_the_shorter_run(small_matrix):
    vectors, _ = models.assemble(small_matrix.filter("origin = 'train'"))
    booster = models.GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=1)
    whole, short = booster.fit(vectors), booster.copy({booster.maxIter: 5}).fit(vectors)
    cut = models.first_trees(whole, 5)
    assert cut.getNumTrees == 5
    a = [r.p for r in models.probability(cut.transform(vectors), "p").select("p").collect()]
    b = [r.p for r in models.probability(short.transform(vectors), "p").select("p").collect()]
    assert a == pytest.approx(b)


def test_factor_blocks_follow_the_pairs(make_log, monkeypatch):
    seen = []
    set_blocks = graph.ALS.setNumBlocks
    monkeypatch.setattr(graph.ALS, "setNumBlocks", lambda self, n: (seen.append(n), set_blocks(self, n))[1])
    monkeypatch.setattr(graph, "BLOCK_PAIRS", 4)
    log = make_log([(u, u % 3, 1, 1, 1, (5, 1), "click") for u in range(50)])
    users, _ = graph.factorise_pairs(log, rank=2)
    assert seen == [13] and users.count() == 50

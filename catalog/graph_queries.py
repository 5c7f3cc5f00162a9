"""Graph operators, their matrix columns, and the models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from catalog import sql as q
from catalog.family_queries import CHECKS as FAMILY
from catalog.registry import Data, query
from tallycart.operators import graph, models, pruning
from tallycart.plans import families, graph_features, runs
from tallycart.session import stage
from tallycart.sources.tables import LABEL_CUT

PAIR = ["user_id", "merchant_id"]
V = [f"v{i}" for i in range(graph.DIM)]
MATRIX = [*PAIR, "origin", "label", "age_range", "gender"]


def _nodes(kinds: list[str]) -> str:
    return " union all ".join(
        f"select distinct '{k}' as kind, {graph.NODE_IDS[k]} as id from log" for k in kinds
    )


BUYS = """select 'user' as src_kind, 'buys' as relation, 'merchant' as dst_kind,
  user_id as src, merchant_id as dst, count(*) as weight from log group by user_id, merchant_id"""
SELLS = " union all ".join(
    f"select distinct 'merchant' as src_kind, '{r}' as relation, '{k}' as dst_kind, "
    f"merchant_id as src, {graph.NODE_IDS[k]} as dst, 1::bigint as weight from log"
    for r, k in (("has", "category"), ("has", "brand"), ("contains", "item"))
)
SELF = """select distinct 'user' as src_kind, 'self' as relation, 'user' as dst_kind,
  user_id as src, user_id as dst, 1::bigint as weight from log"""


def _both(edges: str) -> str:
    return f"""select * from ({edges}) union all
    select dst_kind, 'from ' || relation, src_kind, dst, src, weight from ({edges})"""


def _start() -> str:
    parts = ", ".join(
        f"('0x' || substr(md5(kind || ':' || id || ':{i // 4}'), {8 * (i % 4) + 1}, 8))::bigint::double / 4294967296.0 as {v}"
        for i, v in enumerate(V)
    )
    return f"select kind, id, {parts} from points"


def _round(before: str, after: str, digits: int | None = None) -> list[tuple[str, str]]:
    sums = ", ".join(f"sum({v} * weight) / sum(weight)::double as {v}" for v in V)
    means = ", ".join(f"avg({v}) as {v}" for v in V)
    new = [f"coalesce((b.{v} + h.{v}) / 2, b.{v})" for v in V]
    new = [f"round({x}, {digits})" for x in new] if digits else new
    moved = ", ".join(f"{x} as {v}" for x, v in zip(new, V))
    return [
        (
            f"{after}_heard",
            f"""select dst_kind, dst, {means} from (
              select dst_kind, dst, e.src_kind, relation, {sums}
              from edges e join {before} b on e.src_kind = b.kind and e.src = b.id
              group by dst_kind, dst, e.src_kind, relation) group by dst_kind, dst""",
        ),
        (
            after,
            f"select b.kind, b.id, {moved} from {before} b left join {after}_heard h on b.kind = h.dst_kind and b.id = h.dst",
        ),
    ]


def vectors_sql(kinds: list[str], edges: str) -> list[tuple[str, str]]:
    return [
        ("points", _nodes(kinds)),
        ("edges", edges),
        ("round0", _start()),
        *_round("round0", "round1"),
        *_round("round1", "round2", 9),
    ]


TWO = vectors_sql(["user", "merchant"], _both(BUYS))
MIXED = vectors_sql(
    list(graph.NODE_IDS), f"{_both(f'{BUYS} union all {SELLS}')} union all {SELF}"
)


@query("graph_nodes", _nodes(list(graph.NODE_IDS)))
def graph_nodes(d: Data):
    return graph.nodes(d.log, list(graph.NODE_IDS))


@query("graph_pair_edges", BUYS)
def graph_pair_edges(d: Data):
    return graph.pair_edges(d.log)


@query("graph_attribute_edges", SELLS)
def graph_attribute_edges(d: Data):
    return graph.attribute_edges(d.log)


@query("graph_self_loops", SELF)
def graph_self_loops(d: Data):
    return graph.self_loops(d.log)


@query("graph_start_vectors", f"points as ({_nodes(['user', 'merchant'])}) :: {_start()}", V)
def graph_start_vectors(d: Data):
    return graph.start_vectors(graph.nodes(d.log, ["user", "merchant"]))


@query(
    "graph_neighbour_mean",
    f"{q.ctes([('points', _nodes(['user', 'merchant'])), ('edges', _both(BUYS)), ('round0', _start()), *_round('round0', 'round1')])} :: select * from round1_heard",
    V,
)
def graph_neighbour_mean(d: Data):
    edges = graph.pair_edges(d.log)
    edges = edges.unionByName(graph.reversed_edges(edges))
    points = graph.nodes(d.log, ["user", "merchant"])
    return graph.neighbour_mean(graph.start_vectors(points), edges)


@query("graph_vectors_bipartite", f"{q.ctes(TWO)} :: select * from round2", settled=True)
def graph_vectors_bipartite(d: Data):
    return graph.bipartite_vectors(d.log)


@query("graph_vectors_mixed", f"{q.ctes(MIXED)} :: select * from round2", settled=True)
def graph_vectors_mixed(d: Data):
    return graph.mixed_vectors(d.log)


def _embedding_sql(vectors: list[tuple[str, str]], user: str, merchant: str) -> tuple[str, str]:
    names = [f"{p}_{i}" for p in (user, merchant) for i in range(graph.DIM)]
    spread = ", ".join(
        f"{a}.{v} as {p}_{i}" for a, p in (("u", user), ("g", merchant)) for i, v in enumerate(V)
    )
    raw = f"""select m.*, {spread} from matrix m
      left join round2 u on u.kind = 'user' and u.id = m.user_id
      left join round2 g on g.kind = 'merchant' and g.id = m.merchant_id"""
    parts = [*vectors, ("emb", raw), *q.cap_bin("emb", MATRIX, names, names, bins=16)]
    numbers = ", ".join(f"coalesce({c}_bin, 0) as {c}" for c in names)
    return q.ctes(parts), f"select {q.cols(MATRIX)}, {numbers} from emb_done"


_parts, _body = _embedding_sql(TWO, "u_emb", "m_emb")


@query("family_graph_embedding", f"{_parts} :: {_body}", ["label"])
def family_graph_embedding(d: Data):
    return graph_features.add_graph_embedding_features(d.matrix, d.log)


_parts, _body = _embedding_sql(MIXED, "user_emb", "merchant_emb")


@query("family_hetero_graph_embedding", f"{_parts} :: {_body}", ["label"])
def family_hetero_graph_embedding(d: Data):
    return graph_features.add_hetero_graph_embedding_features(d.matrix, d.log)


@query(
    "graph_factorised_pairs",
    f"""select distinct 'user' as kind, user_id as id, {graph.DIM}::integer as width from log
    union all select distinct 'merchant', merchant_id, {graph.DIM} from log""",
)
def graph_factorised_pairs(d: Data):
    """Every user and merchant of the log has a vector without gaps."""
    users, merchants = graph.factorise_pairs(d.log)
    sides = [
        side.select(
            F.lit(kind).alias("kind"),
            F.col(graph.NODE_IDS[kind]).alias("id"),
            F.size(F.array_compact(F.array(*side.columns[1:]))).alias("width"),
        )
        for kind, side in (("user", users), ("merchant", merchants))
    ]
    return sides[0].unionByName(sides[1])


@query("family_factorised_pairs", f"select {q.cols(MATRIX)}, true as in_range from matrix", ["label"])
def family_factorised_pairs(d: Data):
    made = graph_features.add_factorised_pair_features(d.matrix, d.log)
    numbers = [F.col(f"{p}_{i}").between(0, 15) for p in ("u_als", "m_als") for i in range(graph.DIM)]
    return made.select(*MATRIX, reduce(Column.__and__, numbers).alias("in_range"))


FOLD = "((user_id * 1000003 + merchant_id * 7919) % 5)::integer"


@query("model_folds", f"select user_id, merchant_id, label, {FOLD} as fold from pairs where origin = 'train'", ["label"])
def model_folds(d: Data):
    return models.with_folds(d.pairs.filter("origin = 'train'").drop("origin"))


@query("model_holdout", f"select user_id, merchant_id, label, {FOLD} = 0 as is_valid from pairs where origin = 'train'", ["label"])
def model_holdout(d: Data):
    return models.with_holdout(d.pairs.filter("origin = 'train'").drop("origin"))


@query(
    "model_auc",
    f"""raw as ({q.PAIR_RAW}), scored as (select um_count::double as score, label from pairs
      join raw using (user_id, merchant_id) where label is not null),
    steps as (select score, sum(label) as pos, sum(1 - label) as neg from scored group by score),
    below as (select *, sum(neg) over (order by score rows unbounded preceding) - neg as lower from steps) ::
    select sum(pos * (lower + neg / 2)) / (sum(pos) * sum(neg)) as auc from below""",
    ["auc"],
)
def model_auc(d: Data):
    pair = families.grains.pair_grain(d.log, ["um_count"])
    scored = d.pairs.filter("label is not null").join(pair, PAIR)
    return d.spark.createDataFrame([(models.auc(scored, "um_count"),)], "auc double")


# The models' own numbers are not SQL's to compute; the checks hold what their results
# must be like: every pair once, probabilities and bins in range, all inputs weighed.


def _before_cut(d: Data):
    """The log that the features of a model may see: the label is what comes after it."""
    return d.log.filter(F.col("dt") < F.lit(LABEL_CUT).cast("date"))


def _share(column: str) -> Column:
    return F.coalesce(F.col(column).between(0, 1), F.lit(False))


@query("family_model_ensemble", f"select {q.cols(MATRIX)}, true as in_range, true as in_bins from matrix", ["label"])
def family_model_ensemble(d: Data):
    """What the stacked models see in the full run: the profile and recency columns."""
    seen = families.add_rfm_and_repurchase_features(d.matrix, _before_cut(d)).drop("M")
    made = models.add_model_ensemble_features(seen)
    bins = [F.coalesce(F.col(f"{c}_bin").between(0, 7), F.lit(True)) for c in ("rf_pred", "xgb_pred")]
    return made.select(
        *MATRIX, (_share("rf_pred") & _share("xgb_pred")).alias("in_range"), (bins[0] & bins[1]).alias("in_bins")
    )


_TRAINED: dict[tuple[str, str], models.RepurchaseModel] = {}


def _trained(d: Data) -> models.RepurchaseModel:
    """Folds and the final model, trained once for the queries that look at it."""
    key = (d.spark.sparkContext.applicationId, d.sf_dir)
    if key not in _TRAINED:
        inputs = runs.Inputs(_before_cut(d), d.pairs, d.users)
        _TRAINED[key] = models.RepurchaseModel(runs.short_matrix(inputs)).train_model(use_kfold=True)
    return _TRAINED[key]


@query("model_scores", "select user_id, merchant_id, true as in_range from pairs where origin = 'test'")
def model_scores(d: Data):
    return _trained(d).scores().select(*PAIR, _share("prob").alias("in_range"))


_SHORT_INPUTS = ["age_range", "gender", *[c for f in ("user", "merchant", "user_merchant") for c in FAMILY[f].columns]]


@query(
    "model_importance",
    f"select unnest({_SHORT_INPUTS!r}) as feature, true as in_range, 1::double as total",
    ["total"],
)
def model_importance(d: Data):
    """One row per input, markers of missing values aside; all gains add up to one."""
    gains = _trained(d).importance()
    # As many rows as the model has inputs.
    rows = gains.withColumn("total", F.sum("gain").over(Window.partitionBy(F.lit(0))))
    return rows.filter(~F.col("feature").endswith("_missing")).select(
        "feature", (_share("gain") & (F.col("splits") >= 0)).alias("in_range"), "total"
    )


@query(
    "model_fold_auc",
    f"""folds as (select {FOLD} as fold from pairs where origin = 'train') ::
    select 'fold ' || fold as part, count(*) as pairs, true as in_range, true as agrees from folds group by fold
    union all select 'holdout', count(*), true, true from folds where fold = 0""",
)
def model_fold_auc(d: Data):
    """The AUC of each fold; that of the hold-out part is computed once more by ranks."""
    model = _trained(d)
    held = model.scored(model.holdout())
    held.select("prob", "label").createOrReplaceTempView("held_scores")
    by_rank = d.spark.sql(
        """with steps as (select prob, sum(label) as pos, sum(1 - label) as neg from held_scores group by prob),
        below as (select *, sum(neg) over (order by prob rows unbounded preceding) - neg as lower from steps)
        select sum(pos * (lower + neg / 2)) / (sum(pos) * sum(neg)) as auc from below"""
    ).first()["auc"]
    sizes = {r["fold"]: r["count"] for r in models.with_folds(model.train).groupBy("fold").count().collect()}
    same = by_rank is None or abs(by_rank - model.holdout_auc) < 1e-9
    rows = [(f"fold {i}", sizes[i], 0 <= a <= 1, True) for i, a in enumerate(model.fold_aucs)]
    rows.append(("holdout", sizes[0], 0 <= model.holdout_auc <= 1, same))
    return d.spark.createDataFrame(rows, "part string, pairs long, in_range boolean, agrees boolean")


@query("matrix_everything", f"select {q.cols(MATRIX)}, true as numbers_only, true as pruned from matrix", ["label"])
def matrix_everything(d: Data):
    """The full run up to training: all families, stacked scores, graph vectors, pruned."""
    inputs = runs.Inputs(_before_cut(d), d.pairs, d.users)
    made = stage(runs.prune(runs.full_matrix(inputs)), "everything")
    wanted = {"rf_pred_bin", "xgb_pred_bin", "u_iid", "m_uid", "c_unique_users", "b_unique_items", "u_emb_0", "user_emb_0"}
    text = [c for c in made.columns if made.schema[c].dataType.typeName() == "string"]
    return made.select(
        *MATRIX,
        F.lit(wanted <= set(made.columns) and set(text) == {"origin", "age_range", "gender"}).alias("numbers_only"),
        F.lit(not pruning.prunable(made)).alias("pruned"),
    )

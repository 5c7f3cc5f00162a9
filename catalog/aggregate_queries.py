"""Aggregations and windows at every grain, and column transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as q
from catalog.family_queries import CHECKS as FAMILY
from catalog.registry import Data, query
from tallycart.operators import encoding, grains, pruning, quantiles, sequences
from tallycart.plans import families, matrix as mx
from tallycart.session import stage

PAIR = ["user_id", "merchant_id"]

DISTINCT = {
    "user": (grains.user_grain, q.USER_RAW, ["user_id"], ["u_iid", "u_cid", "u_mid", "u_bid"]),
    "merchant": (grains.merchant_grain, q.MERCHANT_RAW, ["merchant_id"], ["m_iid", "m_cid", "m_uid", "m_bid"]),
    "pair": (grains.pair_grain, q.PAIR_RAW, PAIR, ["um_iid", "um_cid", "um_bid"]),
    "category": (
        grains.category_grain, q.attribute_raw("cat_id", "c", True), ["cat_id"],
        ["c_unique_users", "c_unique_merchants", "c_unique_items"],
    ),
    "brand": (
        grains.brand_grain, q.attribute_raw("brand_id", "b", False), ["brand_id"],
        ["b_unique_merchants", "b_unique_items"],
    ),
    "merchant_category": (
        grains.merchant_category_grain, q.mixed_raw("cat_id", "mc"), ["merchant_id", "cat_id"],
        ["mc_unique_users", "mc_unique_items"],
    ),
    "merchant_brand": (
        grains.merchant_brand_grain, q.mixed_raw("brand_id", "mb"), ["merchant_id", "brand_id"],
        ["mb_unique_users", "mb_unique_items"],
    ),
}
PREFIX = {"user": "u", "merchant": "m", "pair": "um", "category": "c", "brand": "b", "merchant_category": "mc", "merchant_brand": "mb"}


def _grain_queries(name: str) -> None:
    build, raw, keys, counted = DISTINCT[name]
    prefix = PREFIX[name]
    actions = [f"{prefix}_{a}" for a in ("click", "cart", "purchase", "fav")]
    actions = [a for a in actions if a != "um_cart"]

    @query(f"agg_distinct_{name}", f"raw as ({raw}) :: select {q.cols([*keys, *counted])} from raw")
    def distinct(d: Data):
        return build(d.log, counted).select(*keys, *counted)

    @query(f"agg_actions_{name}", f"raw as ({raw}) :: select {q.cols([*keys, *actions])} from raw")
    def action_counts(d: Data):
        return build(d.log, actions).select(*keys, *actions)


for _name in DISTINCT:
    _grain_queries(_name)


def _promo_query(name: str, key: str, prefix: str) -> None:
    columns = grains.promo_columns(prefix, True)
    build = DISTINCT[name][0]

    @query(f"agg_promo_{name}", f"raw as ({q.promo_raw(key, prefix, True)}) :: select * from raw", columns[8:])
    def promo(d: Data):
        return build(d.log, columns).filter(F.col(columns[0]).isNotNull())


for _name, _key in (("merchant", "merchant_id"), ("category", "cat_id"), ("brand", "brand_id")):
    _promo_query(_name, _key, PREFIX[_name])


@query(
    "agg_span_days",
    f"raw as ({q.MERCHANT_RAW}) :: select merchant_id, m_days_between from raw",
)
def agg_span_days(d: Data):
    return grains.merchant_grain(d.log, ["m_days_between"])


@query("agg_active_days", f"raw as ({q.USER_RAW}) :: select user_id, u_active_days, u_purchase_days from raw")
def agg_active_days(d: Data):
    return grains.user_grain(d.log, ["u_active_days", "u_purchase_days"])


@query(
    "agg_purchase_gap_mean",
    f"raw as ({q.USER_RAW}) :: select user_id, u_avg_days_between_purchases from raw",
    ["u_avg_days_between_purchases"],
)
def agg_purchase_gap_mean(d: Data):
    return grains.user_grain(d.log, ["u_avg_days_between_purchases"])


@query(
    "agg_activity_share",
    """select user_id, merchant_id, n as um_count, n::double / sum(n) over (partition by user_id) as share
    from (select user_id, merchant_id, count(*) as n from log group by all)""",
    ["share"],
)
def agg_activity_share(d: Data):
    pairs = grains.pair_grain(d.log, ["um_count"])
    users = grains.user_grain(d.log, ["u_total"])
    joined = pairs.join(users, "user_id")
    return joined.select(*PAIR, "um_count", (F.col("um_count") / F.col("u_total")).alias("share"))


@query("agg_top_brand_pair", f"top as ({q.top_per_pair('brand_id', 'top_brand_id', 'freq_brand')}) :: select * from top")
def agg_top_brand_pair(d: Data):
    return grains.top_brand_per_pair(d.log)


@query("agg_top_category_pair", f"top as ({q.top_per_pair('cat_id', 'top_cat_id', 'freq_cat')}) :: select * from top")
def agg_top_category_pair(d: Data):
    return grains.top_category_per_pair(d.log)


def _top_merchant(name: str, key: str, prefix: str) -> None:
    build = DISTINCT[name][0]
    columns = ["merchant_id", key, f"{prefix}_unique_users", f"{prefix}_click"]

    @query(
        f"agg_top_{name}",
        f"""raw as ({q.mixed_raw(key, prefix)}) :: select {q.cols(columns)} from raw
        qualify row_number() over (partition by merchant_id order by n desc, {key}) = 1""",
    )
    def top(d: Data):
        return grains.most_frequent(build(d.log), ["merchant_id"], key, "_rows").select(*columns)


_top_merchant("merchant_brand", "brand_id", "mb")
_top_merchant("merchant_category", "cat_id", "mc")


@query("agg_recency_frequency", f"rfm as ({q.RECENCY}) :: select * from rfm", ["R", "F", "M"])
def agg_recency_frequency(d: Data):
    return sequences.recency_frequency(d.log.filter(grains.is_action("purchase")))


GAPS = ["repurchase_gap_mean", "repurchase_gap_std", "repurchase_gap_min", "repurchase_gap_max"]


@query("agg_gap_stats", f"gaps as ({q.GAP_STATS}) :: select * from gaps", GAPS)
def agg_gap_stats(d: Data):
    return sequences.gap_stats(d.log.filter(grains.is_action("purchase")))


@query("agg_cart_interval", f"found as ({q.INTERVAL}) :: select * from found", ["um_avg_cart_purchase_interval"])
def agg_cart_interval(d: Data):
    return sequences.cart_purchase_interval(d.log)


@query("agg_sessions", f"found as ({q.SESSIONS}) :: select * from found", ["session_duration"])
def agg_sessions(d: Data):
    return sequences.sessions(d.log)


SESSION = ["session_action_mean", "session_action_max", "session_duration_mean", "session_duration_max"]


@query("agg_user_sessions", f"found as ({q.USER_SESSIONS}) :: select * from found", SESSION)
def agg_user_sessions(d: Data):
    return sequences.user_sessions(d.log)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_percentile",
    " union all ".join(f"select '{c}' as feature, quantile_cont({c}, 0.95) as value from lineitem" for c in LINE_NUMBERS),
    ["value"],
)
def agg_percentile(d: Data):
    return quantiles.percentiles(d.table("lineitem"), LINE_NUMBERS)


@query(
    "agg_min_max",
    " union all ".join(
        f"select '{c}' as feature, min({c}) as low, max({c}) as high, count({c}) as filled from lineitem"
        for c in LINE_NUMBERS
    ),
    ["low", "high"],
)
def agg_min_max(d: Data):
    return pruning.column_ranges(d.table("lineitem"), LINE_NUMBERS)


@query(
    "win_day_gaps_user",
    """select user_id, dt, n as rows, date_diff('day', lag(dt) over (partition by user_id order by dt), dt)::integer as gap_days
    from (select user_id, dt, count(*) as n from log group by all)""",
)
def win_day_gaps_user(d: Data):
    return sequences.day_gaps(d.log, ["user_id"])


@query(
    "win_day_gaps_pair",
    """select user_id, merchant_id, dt, n as rows, date_diff('day', lag(dt) over
      (partition by user_id, merchant_id order by dt), dt)::integer as gap_days
    from (select user_id, merchant_id, dt, count(*) as n from log where action_type = 'purchase' group by all)""",
)
def win_day_gaps_pair(d: Data):
    return sequences.day_gaps(d.log.filter(grains.is_action("purchase")), PAIR)


@query(
    "win_next_action",
    """seq as (select *, seq1 // 65536 as run, lead(action_type) over (partition by user_id, merchant_id, dt, seq1 // 65536
        order by seq1, seq2, item_id) as follower,
      row_number() over (partition by user_id, merchant_id, dt, seq1 // 65536 order by seq1, seq2, item_id) as place,
      count(*) over (partition by user_id, merchant_id, dt, seq1 // 65536) as size
      from log where action_type in ('add-to-cart', 'purchase')),
    runs as (select user_id, merchant_id, dt, run,
      count(*) filter (where action_type = 'add-to-cart' and follower = 'purchase') as pairs_inside,
      max(action_type) filter (where place = 1) as first_action,
      max(action_type) filter (where place = size) as last_action
      from seq group by all) ::
    select *, lead(dt) over w as next_dt, lead(first_action) over w as next_action
    from runs window w as (partition by user_id, merchant_id order by dt, run)""",
)
def win_next_action(d: Data):
    return sequences.action_runs(d.log)


@query(
    "win_session_id",
    f"marked as ({q.SESSION_ROWS}) :: select user_id, dt, session_id::bigint as session_id, count(*) as rows from marked group by all",
)
def win_session_id(d: Data):
    return sequences.session_days(d.log).drop("gap_days")


@query(
    "win_first_per_key",
    """select user_id, item_id, n from (select user_id, item_id, count(*) as n from log group by all)
    qualify row_number() over (partition by user_id order by n desc, item_id) = 1""",
)
def win_first_per_key(d: Data):
    counts = d.log.groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    return grains.most_frequent(counts, ["user_id"], "item_id", "n")


LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
VALUES = ["l_quantity", "l_extendedprice"]


def _lines(parts: list[tuple[str, str]]) -> str:
    rows = ("line", f"select {q.cols(LINE)}, l_partkey from lineitem")
    return f"{q.ctes([rows, *parts])} :: select * from line_done"


@query("cap_p99", _lines(q.cap_bin("line", ["l_orderkey", "l_linenumber", "l_partkey"], VALUES, [], cap=0.99)), VALUES)
def cap_p99(d: Data):
    return quantiles.cap_values(d.table("lineitem").select(*LINE, "l_partkey"), VALUES)


@query("cap_p95", _lines(q.cap_bin("line", ["l_orderkey", "l_linenumber", "l_partkey"], VALUES, [])), VALUES)
def cap_p95(d: Data):
    return quantiles.cap_values(d.table("lineitem").select(*LINE, "l_partkey"), VALUES, 95)


@query(
    "bin_quintiles",
    _lines(q.cap_bin("line", ["l_orderkey", "l_linenumber", "l_partkey"], VALUES, VALUES, bins=5, cap=None)),
    VALUES,
)
def bin_quintiles(d: Data):
    return quantiles.bin_values(d.table("lineitem").select(*LINE, "l_partkey"), VALUES)


@query(
    "bin_octiles",
    _lines(q.cap_bin("line", ["l_orderkey", "l_linenumber", "l_partkey"], VALUES, VALUES, bins=8, cap=None)),
    VALUES,
)
def bin_octiles(d: Data):
    return quantiles.bin_values(d.table("lineitem").select(*LINE, "l_partkey"), VALUES, 8)


@query("cap_then_bin", _lines(q.cap_bin("line", ["l_orderkey", "l_linenumber", "l_partkey"], VALUES, VALUES)), VALUES)
def cap_then_bin(d: Data):
    lines = d.table("lineitem").select(*LINE, "l_partkey")
    return quantiles.apply_fit(lines, quantiles.fit([(lines, VALUES)]), VALUES, VALUES)


U_COLUMNS = families.USER.takes["user"]
_PAIRS = [(i, j) for i in range(len(U_COLUMNS)) for j in range(i + 1, len(U_COLUMNS))]
U_CORR = " union all ".join(
    f"select {i}::bigint as i, {j}::bigint as j, corr({U_COLUMNS[i]}, {U_COLUMNS[j]}) as corr from raw"
    for i, j in _PAIRS
)


def _user_columns(d: Data):
    """Stored, because the correlations read it twice: for the means, then the products."""
    return stage(grains.user_grain(d.log, U_COLUMNS).select(*U_COLUMNS), "user_columns")


@query("corr_user_columns", f"raw as materialized ({q.USER_RAW}) :: {U_CORR}", ["corr"])
def corr_user_columns(d: Data):
    return pruning.correlations(_user_columns(d), U_COLUMNS)


@query(
    "prune_correlated",
    f"""raw as materialized ({q.USER_RAW}), c as ({U_CORR}),
    names as (select unnest({U_COLUMNS!r}) as feature, generate_subscripts({U_COLUMNS!r}, 1) - 1 as j) ::
    select distinct feature from c join names using (j) where abs(corr) > 0.85""",
)
def prune_correlated(d: Data):
    to_drop, _ = pruning.drop_high_corr_features(_user_columns(d))
    return d.spark.createDataFrame([(c,) for c in to_drop], "feature string")


def _f_score(column: str) -> str:
    return f"""select '{column}' as feature,
      case when count(*) > 1 and sum(within) > 0 then
        (sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / (count(*) - 1)
        / (sum(within) / (sum(n) - count(*))) end as f_score
    from (select label, count(x)::double as n, avg(x) as m, var_pop(x) * count(x) as within
          from (select label, "{column}"::double as x from short where label is not null)
          where x is not null group by label)"""


SCORED = [*FAMILY["user"].columns, *FAMILY["user_merchant"].columns]
SHORT = f"""{q.ctes(FAMILY['user'].parts)}, {q.ctes(FAMILY['user_merchant'].parts)},
short as materialized (select m.*, {q.cols(FAMILY['user'].columns, 'a')}, {q.cols(FAMILY['user_merchant'].columns, 'b')}
  from matrix m join fu_out a using (user_id, merchant_id) join fum_out b using (user_id, merchant_id))"""
SCORES = " union all ".join(_f_score(c) for c in SCORED)


def _short(d: Data):
    return families.attach(d.matrix, d.log, [families.USER, families.USER_MERCHANT])


@query("score_anova", f"{SHORT} :: {SCORES}", ["f_score"])
def score_anova(d: Data):
    return pruning.anova_scores(_short(d), SCORED)


@query(
    "select_best",
    f"{SHORT}, scores as ({SCORES}) :: select feature from scores order by f_score desc nulls last limit 10",
)
def select_best(d: Data):
    chosen = pruning.select_features(_short(d).filter("origin = 'train'"), k=10)
    return d.spark.createDataFrame([(c,) for c in chosen], "feature string")


@query(
    "encode_labels",
    """select user_id, merchant_id, origin, label, (dense_rank() over (order by age_range) - 1)::double as age_range,
      (dense_rank() over (order by gender) - 1)::double as gender from matrix""",
    ["label", "age_range", "gender"],
)
def encode_labels(d: Data):
    return pruning.require_no_text(encoding.encode_labels(d.matrix))


CROSS = ["age_gender_cross", "cat_brand_cross"]
_CROSS_RAW = (
    "cross_raw",
    """select m.*, (coalesce(u.age_range, -1) * 10 + coalesce(u.gender, -1))::double as age_gender_cross,
      (trunc(f.m_cid) * 10000 + trunc(f.m_bid))::double as cat_brand_cross
    from matrix m left join users u using (user_id) join fm_out f using (user_id, merchant_id)""",
)
_MATRIX = [*PAIR, "origin", "label", "age_range", "gender"]


@query(
    "family_cross",
    f"{q.ctes([*FAMILY['merchant'].parts, _CROSS_RAW, *q.cap_bin('cross_raw', _MATRIX, CROSS, CROSS)])} :: select * from cross_raw_done",
    ["label", *CROSS],
)
def family_cross(d: Data):
    matrix = mx.init_matrix(d.pairs, d.users, keep_codes=True)
    crossed = families.add_cross_features(families.add_merchant_features(matrix, d.log))
    return crossed.select(*_MATRIX, *CROSS, *[f"{c}_bin" for c in CROSS])

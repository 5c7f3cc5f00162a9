"""The feature families and how they join the pair matrix.

A family says which columns it takes from which grain of the log, and which of
them are capped and binned over which rows. ``attach`` adds any number of
families in one go: a grain is aggregated and joined once however many families
read it, and one fit covers all columns of a scope.

Join sides are never forced to broadcast, and they are stored tables. Their sizes are
known at run time, so adaptive execution broadcasts those below the session's limit and
splits skewed partitions of the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.operators import grains, quantiles, sequences
from tallycart.session import at_once, compile_in_parts, stage, stage_all

PAIR = ["user_id", "merchant_id"]


@dataclass(frozen=True)
class Grain:
    build: Callable[[DataFrame, list[str]], DataFrame]
    keys: list[str]
    # Matrix columns to join on, where they are called differently.
    on: list[str] | None = None
    # For mixed grains: the attribute whose most frequent value represents a merchant.
    pick: str | None = None
    # The builder also wants the log of all pairs.
    needs_whole: bool = False


GRAINS = {
    "user": Grain(grains.user_grain, ["user_id"]),
    "user_sessions": Grain(sequences.user_sessions, ["user_id"]),
    "merchant": Grain(grains.merchant_grain, ["merchant_id"]),
    "merchant_brand": Grain(grains.merchant_brand_grain, ["merchant_id"], pick="brand_id"),
    "merchant_category": Grain(grains.merchant_category_grain, ["merchant_id"], pick="cat_id"),
    "pair": Grain(grains.pair_grain, PAIR),
    "purchases": Grain(sequences.rfm_and_gaps, PAIR, needs_whole=True),
    "interval": Grain(sequences.cart_purchase_interval, PAIR),
    "top_brand": Grain(grains.top_brand_per_pair, PAIR),
    "top_category": Grain(grains.top_category_per_pair, PAIR),
    "brand": Grain(grains.brand_grain, ["brand_id"], on=["top_brand_id"]),
    "category": Grain(grains.category_grain, ["cat_id"], on=["top_cat_id"]),
}


@dataclass(frozen=True)
class Family:
    """``takes``: columns per grain. ``scope``: whose rows the percentiles run over,
    ``matrix`` (pairs, after the join) or ``entity`` (the grain table, before it)."""

    takes: dict[str, list[str]]
    capped: list[str] = field(default_factory=list)
    binned: list[str] = field(default_factory=list)
    scope: str = "matrix"
    fills: dict[str, float] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)
    helpers: list[str] = field(default_factory=list)

    def outputs(self) -> set[str]:
        taken = {c for columns in self.takes.values() for c in columns}
        return (taken | set(self.derived)) - set(self.helpers)


def _zero(columns: list[str]) -> dict[str, float]:
    return dict.fromkeys(columns, 0)


# The columns of each family, and which are capped and binned.
_U_RATES = ["u_purchase_click_rate", "u_cart_click_rate", "u_fav_click_rate", "u_purchase_cart_rate"]
_U_DAYS = ["u_active_days", "u_purchase_days"]
_U_BASE = [
    "u_iid", "u_cid", "u_mid", "u_bid", "u_click", "u_cart", "u_purchase", "u_fav",
    "u_avg_days_between_purchases", *_U_RATES, *_U_DAYS,
]
_M_RATES = ["m_purchase_per_click", "m_cart_per_click", "m_fav_per_click"]
_M_BASE = [
    "m_iid", "m_cid", "m_uid", "m_bid", "m_click", "m_cart", "m_purchase", "m_fav",
    "m_days_between", "m_avg_orders_per_day", *_M_RATES,
]
_UM_RATES = ["um_purchase_per_click", "um_fav_per_click"]
_UM_BASE = [
    "um_iid", "um_cid", "um_bid", "um_click", "um_purchase",
    "um_days_between", "um_avg_orders_per_day", *_UM_RATES,
]
_RFM = [
    "R", "F", "M", "repurchase_gap_mean", "repurchase_gap_std",
    "repurchase_gap_min", "repurchase_gap_max",
]
_SESSION = [
    "session_action_mean", "session_action_max",
    "session_duration_mean", "session_duration_max",
]


def _attribute_columns(prefix: str, with_users: bool) -> list[str]:
    users = [f"{prefix}_unique_users"] if with_users else []
    rest = [
        "unique_merchants", "unique_items", "purchase_count", "days_between",
        "avg_purchases_per_day", "click", "cart", "purchase", "fav",
        "purchase_click_rate", "cart_click_rate", "fav_click_rate",
    ]
    return users + [f"{prefix}_{c}" for c in rest]


def _attribute_binned(prefix: str) -> list[str]:
    rest = [
        "days_between", "avg_purchases_per_day",
        "purchase_click_rate", "cart_click_rate", "fav_click_rate",
    ]
    return [f"{prefix}_{c}" for c in rest]


def _mixed_columns(prefix: str) -> list[str]:
    rest = ["unique_users", "unique_items", "click", "purchase", "cart", "fav", "purchase_click_rate"]
    return [f"{prefix}_{c}" for c in rest]


def _promo_family(
    grain: str, prefix: str, totals: bool, extra: dict[str, list[str]] | None = None
) -> Family:
    columns = grains.promo_columns(prefix, totals)
    shares = [f"{prefix}_{name}_1111_ratio" for name in grains.PROMO_NAMES]
    return Family(
        takes={**(extra or {}), grain: columns},
        capped=columns,
        binned=shares,
        scope="entity",
        fills=_zero(columns + [f"{c}_bin" for c in shares]),
    )


_TOP_BRAND = {"top_brand": ["top_brand_id", "freq_brand"]}
_TOP_CATEGORY = {"top_category": ["top_cat_id", "freq_cat"]}

USER = Family(
    takes={"user": _U_BASE},
    capped=_U_BASE,
    binned=[*_U_DAYS, "u_avg_days_between_purchases", *_U_RATES],
    fills=_zero(_U_RATES + _U_DAYS),
)
USER_PROMO = _promo_family("user", "u", totals=False)
MERCHANT = Family(
    takes={"merchant": _M_BASE},
    capped=_M_BASE,
    binned=["m_days_between", "m_avg_orders_per_day", *_M_RATES],
    fills=_zero(_M_RATES),
)
MERCHANT_PROMO = _promo_family("merchant", "m", totals=True)
CATEGORY = Family(
    takes={**_TOP_CATEGORY, "category": _attribute_columns("c", True)},
    capped=[*_attribute_columns("c", True), "freq_cat"],
    binned=_attribute_binned("c"),
)
CATEGORY_PROMO = _promo_family("category", "c", totals=True, extra=_TOP_CATEGORY)
BRAND = Family(
    takes={**_TOP_BRAND, "brand": _attribute_columns("b", False)},
    capped=[*_attribute_columns("b", False), "freq_brand"],
    binned=_attribute_binned("b"),
)
BRAND_PROMO = _promo_family("brand", "b", totals=True, extra=_TOP_BRAND)
USER_MERCHANT = Family(
    # The favourite count of a pair is kept but, unlike the others, not capped.
    takes={"pair": [*_UM_BASE, "um_fav", "um_count"], "user": ["u_total"]},
    derived={"um_interaction_freq": "um_count / u_total"},
    helpers=["um_count", "u_total"],
    capped=[*_UM_BASE, "um_interaction_freq"],
    binned=["um_days_between", "um_avg_orders_per_day", *_UM_RATES, "um_interaction_freq"],
    fills=_zero(_UM_RATES),
)
CART_PURCHASE_INTERVAL = Family(
    takes={"interval": ["um_avg_cart_purchase_interval"]},
    capped=["um_avg_cart_purchase_interval"],
    binned=["um_avg_cart_purchase_interval"],
    fills={"um_avg_cart_purchase_interval": -1},
)
MERCHANT_CATEGORY = Family(
    takes={"merchant_category": _mixed_columns("mc")},
    capped=_mixed_columns("mc"),
    binned=["mc_purchase_click_rate"],
    scope="entity",
    fills=_zero([*_mixed_columns("mc"), "mc_purchase_click_rate_bin"]),
)
MERCHANT_BRAND = Family(
    takes={"merchant_brand": _mixed_columns("mb")},
    capped=_mixed_columns("mb"),
    binned=["mb_purchase_click_rate"],
    scope="entity",
    fills=_zero([*_mixed_columns("mb"), "mb_purchase_click_rate_bin"]),
)
RFM_REPURCHASE = Family(takes={"purchases": _RFM}, fills=_zero(_RFM))
SESSION = Family(takes={"user_sessions": _SESSION}, fills=dict.fromkeys(_SESSION, -1))

FULL_SET = [
    RFM_REPURCHASE,
    USER,
    USER_PROMO,
    MERCHANT,
    MERCHANT_PROMO,
    CATEGORY,
    CATEGORY_PROMO,
    BRAND,
    BRAND_PROMO,
    USER_MERCHANT,
    CART_PURCHASE_INTERVAL,
    MERCHANT_CATEGORY,
    MERCHANT_BRAND,
]
SHORT_SET = [USER, MERCHANT, USER_MERCHANT]


def attach(
    matrix: DataFrame,
    log: DataFrame,
    families: list[Family],
    builders: dict[str, Callable[[DataFrame, list[str]], DataFrame]] | None = None,
) -> DataFrame:
    """Join the families' columns to the pairs, capped and binned.

    Columns the matrix already has are left as they are. ``log`` is scanned once
    per grain; pass a stored table, not an expensive view, when adding several.
    """
    compile_in_parts(matrix.sparkSession)
    present = set(matrix.columns)
    families = [f for f in families if not f.outputs() <= present]
    takes: dict[str, list[str]] = {}
    for family in families:
        for grain, columns in family.takes.items():
            wanted = takes.setdefault(grain, [])
            wanted += [c for c in columns if c not in present and c not in wanted]
    of_pairs = log
    if any(GRAINS[grain].keys == PAIR and columns for grain, columns in takes.items()):
        # A pair's columns need the log rows of the matrix's pairs only. Both sides and the
        # outcome are stored tables: adaptive execution then splits a hot pair in the join,
        # and what reads the rows deals them anew by its own, finer keys.
        keys = stage(matrix.select(*PAIR).distinct(), "pair_keys")
        of_pairs = stage(log.join(keys, PAIR, "left_semi"), "pair_log")
    # A grain stores its sums before it is joined: these jobs overlap.
    calls = [
        (log, of_pairs, grain, columns, (builders or {}).get(grain))
        for grain, columns in takes.items()
        if columns
    ]
    tables = dict(zip([call[2] for call in calls], at_once(matrix.sparkSession, _grain_table, calls)))

    entity = [f for f in families if f.scope == "entity"]
    by_pairs = [f for f in families if f.scope == "matrix"]
    tables = _finish_entities(tables, entity)

    joined = _join_grains(matrix, tables)
    derived = {
        name: F.expr(text)
        for f in families
        for name, text in f.derived.items()
        if name not in present
    }
    joined = joined.withColumns(derived) if derived else joined
    joined = joined.drop(*[h for f in families for h in f.helpers if h not in present])
    fills = {
        c: v
        for f in families
        for c, v in f.fills.items()
        if c not in present and c in joined.columns
    }
    joined = joined.fillna(fills) if fills else joined
    joined = joined.select(*matrix.columns, *[c for c in joined.columns if c not in present])

    capped = [c for f in by_pairs for c in f.capped if c not in present]
    binned = [c for f in by_pairs for c in f.binned if c not in present]
    if not capped:
        return joined
    raw = stage(joined, "matrix")
    return quantiles.apply_fit(raw, quantiles.fit([(raw, capped)]), capped, binned)


def _grain_table(
    log: DataFrame,
    of_pairs: DataFrame,
    name: str,
    columns: list[str],
    build: Callable[[DataFrame, list[str]], DataFrame] | None = None,
) -> DataFrame:
    grain = GRAINS[name]
    rows = of_pairs if grain.keys == PAIR else log
    more = [log] if grain.needs_whole else []
    table = (build or grain.build)(rows, columns, *more)
    if grain.pick:
        return table.select(*grain.keys, grain.pick, "_rows", *columns)
    return table.select(*grain.keys, *columns)


def _finish_entities(
    tables: dict[str, DataFrame], families: list[Family]
) -> dict[str, DataFrame]:
    """Cap and bin within the grain tables: one fit over all of them."""
    todo: dict[str, tuple[list[str], list[str]]] = {}
    for family in families:
        for grain in family.takes:
            columns = tables[grain].columns if grain in tables else []
            capped = [c for c in columns if c in family.capped]
            binned = [c for c in columns if c in family.binned]
            if capped:
                todo[grain] = (capped, binned)
    if not todo:
        return tables
    out = {**tables, **stage_all({grain: tables[grain] for grain in todo})}
    fitted = quantiles.fit([(out[g], capped) for g, (capped, _) in todo.items()])
    for grain, (capped, binned) in todo.items():
        done = quantiles.apply_fit(out[grain], fitted, capped, binned)
        pick = GRAINS[grain].pick
        if pick:
            done = grains.most_frequent(done, GRAINS[grain].keys, pick, "_rows")
            done = done.drop(pick, "_rows")
        out[grain] = done
    return out


def _join_grains(matrix: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One left join per key, to a stored table with all columns of that key's grains.

    A key's grains have one row per key each, so they merge without a hot spot. The
    matrix may have very many rows of one merchant or brand: adaptive execution splits
    these in a join of plain tables, but not in a join to an aggregate, nor in two joins
    on one key in a row. Pair columns come first: the attribute grains join on the
    pair's favourites.
    """
    keyed: dict[tuple[str, ...], DataFrame] = {}
    for name, table in tables.items():
        grain = GRAINS[name]
        if grain.on:
            table = table.withColumnsRenamed(dict(zip(grain.keys, grain.on)))
        key = tuple(grain.on or grain.keys)
        keyed[key] = keyed[key].join(table, list(key), "full") if key in keyed else table
    order = sorted(keyed, key=lambda k: (list(k) != PAIR, k))
    stored = stage_all({"_".join(key): keyed[key] for key in order})
    for key in order:
        matrix = matrix.join(stored["_".join(key)], list(key), "left")
    return matrix


def add_user_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [USER])


def add_user_1111_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [USER_PROMO])


def add_merchant_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [MERCHANT])


def add_merchant_1111_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [MERCHANT_PROMO])


def add_category_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [CATEGORY])


def add_category_1111_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [CATEGORY_PROMO])


def add_brand_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [BRAND])


def add_brand_1111_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [BRAND_PROMO])


def add_user_merchant_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [USER_MERCHANT])


def add_user_merchant_cart_purchase_interval(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [CART_PURCHASE_INTERVAL])


def add_merchant_category_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [MERCHANT_CATEGORY])


def add_merchant_brand_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [MERCHANT_BRAND])


def add_rfm_and_repurchase_features(matrix: DataFrame, log: DataFrame) -> DataFrame:
    return attach(matrix, log, [RFM_REPURCHASE])


def add_session_features(
    matrix: DataFrame, log: DataFrame, session_gap: float = 7
) -> DataFrame:
    def build(rows: DataFrame, columns: list[str]) -> DataFrame:
        return sequences.user_sessions(rows, columns, session_gap)

    return attach(matrix, log, [SESSION], {"user_sessions": build})


def add_cross_features(matrix: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Age with gender, and a merchant's category count with its brand count.

    Needs ``age_code``, ``gender_code``, ``m_cid`` and ``m_bid``; missing reads as -1.
    """
    def whole(name: str) -> Column:
        return F.coalesce(F.col(name).cast("long"), F.lit(-1).cast("long"))

    crossed = matrix.withColumns(
        {
            "age_gender_cross": (whole("age_code") * 10 + whole("gender_code")).cast("double"),
            "cat_brand_cross": (whole("m_cid") * 10000 + whole("m_bid")).cast("double"),
        }
    )
    names = ["age_gender_cross", "cat_brand_cross"]
    raw = stage(crossed, "cross")
    return quantiles.apply_fit(raw, quantiles.fit([(raw, names)]), names, names)

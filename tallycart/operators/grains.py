"""One aggregation per grain of the log.

Every function takes the cleaned log and returns one row per key with that
grain's columns, or only the ``columns`` asked for.

A grain wants several exact distinct counts next to its action counts. The action
counts are one plain aggregate, which combines before its shuffle. For the distinct
counts a key's rows meet in one task, once for all counts, unless the key is crowded
(more than ``CROWDED`` rows); tasks count the sorted rows in Arrow batches. The rows of
crowded keys are laid out as (key, field, value) and grouped twice: the first shuffle is on
all three, the second combines before it, so no key of any size has its rows in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.functions.decode import is_promo_day
from tallycart.functions.ratios import ratio_if_positive, ratio_or_zero, ratio_zero_as_one
from tallycart.session import stage

# Short name and full action name, and the longer spelling used
# by the promotion-day columns.
ACTIONS = {
    "click": "click",
    "cart": "add-to-cart",
    "purchase": "purchase",
    "fav": "add-to-favorite",
}
PROMO_NAMES = {
    "click": "click",
    "add_to_cart": "add-to-cart",
    "purchase": "purchase",
    "add_to_favorite": "add-to-favorite",
}
SINGLE_PURCHASE_GAP = 185.0
# Rows of a key that one task may hold, rows that are counted at one time, and the
# number of crowded keys from which they are no longer broadcast.
CROWDED = 200_000
BATCH_ROWS = 200_000
MANY = 10_000


def is_action(name: str) -> Column:
    return F.col("action_type") == name


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys of which some may be null; null keys are a key like any other."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_{k}" for k in keys])


def _crowded_counts(log: DataFrame, keys: list[str], counted: dict[str, Column]) -> DataFrame:
    """(keys, counts): known values of each field, for keys of any size."""
    numbered = [F.struct(F.lit(i).alias("field"), c.alias("value")) for i, c in enumerate(counted.values())]
    values = log.select(*keys, F.inline(F.array(*numbered))).filter("value is not null").distinct()
    return values.groupBy(*keys).agg(*[F.count_if(F.col("field") == i).alias(n) for i, n in enumerate(counted)])


def _count_sorted(keys: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows sorted by their first ``keys`` columns: one row a key, the number of known
    values in each other column. A key's rows are held back until the next key begins."""

    def longs(column: pa.Array) -> np.ndarray:
        return column.fill_null(0).to_numpy(zero_copy_only=False)

    def begins(rows: pa.Table) -> np.ndarray:
        """Whether a row's key differs from the one before."""
        first = np.zeros(rows.num_rows, bool)
        first[:1] = True
        for i in range(keys):
            column = rows.column(i).combine_chunks()
            x, known = longs(column), column.is_valid().to_numpy(zero_copy_only=False)
            first[1:] |= (x[1:] != x[:-1]) | (known[1:] != known[:-1])
        return first

    def counted(rows: pa.Table) -> pa.RecordBatch:
        first = begins(rows)
        group, at = np.cumsum(first) - 1, np.flatnonzero(first)
        found = [rows.column(i).combine_chunks().take(pa.array(at)) for i in range(keys)]
        for i in range(keys, rows.num_columns):
            column = rows.column(i).combine_chunks()
            known = column.is_valid().to_numpy(zero_copy_only=False)
            g, x = group[known], longs(column)[known]
            order = np.lexsort((x, g))
            g, x = g[order], x[order]
            new = np.ones(len(x), bool)
            new[1:] = (g[1:] != g[:-1]) | (x[1:] != x[:-1])
            found.append(pa.array(np.bincount(g[new], minlength=len(at)), pa.int64()))
        return pa.RecordBatch.from_arrays(found, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size < BATCH_ROWS:
                continue
            rows = pa.concat_tables(held)
            last = int(np.flatnonzero(begins(rows))[-1])
            if last:
                yield counted(rows.slice(0, last))
            held, size = [rows.slice(last)], 0
        if held:
            yield counted(pa.concat_tables(held))

    return run


def distinct_counts(log: DataFrame, keys: list[str], counted: dict[str, Column], sizes: DataFrame) -> DataFrame:
    """(keys, counts): the number of known values of each ``counted`` field. Keys without any
    may be missing. ``sizes``: a stored table with ``_n``, the rows of each key."""
    crowded = sizes.filter(F.col("_n") > CROWDED).select(*keys)
    some = crowded.count()
    light = _same(log, F.broadcast(crowded) if some < MANY else crowded, keys, "left_anti") if some else log
    values = [c.alias(f"_v{i}") for i, c in enumerate(counted.values())]
    names = [*keys, *counted]
    counts = (
        light.select(*[F.col(k).cast("long").alias(k) for k in keys], *values)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_count_sorted(len(keys), names), ", ".join(f"`{n}` long" for n in names))
    )
    if not some:
        return counts
    heavy = _same(log, F.broadcast(crowded) if some < MANY else crowded, keys, "left_semi")
    return counts.unionByName(_crowded_counts(heavy, keys, counted))


class _Grain:
    """Action counts and other sums of a key's log rows, and its distinct counts."""

    def __init__(
        self, log: DataFrame, keys: list[str], distinct: dict[str, str], columns: list[str] | None
    ):
        self.log = log.withColumn("day", F.unix_date("dt"))
        self.keys, self.columns = keys, columns
        self.counted = {
            n: F.col(c).cast("long") for n, c in distinct.items() if columns is None or n in columns
        }

    def bought_on(self) -> Column:
        return F.when(is_action("purchase"), F.col("day").cast("long"))

    def actions(self, prefix: str) -> list[Column]:
        return [F.count_if(is_action(a)).alias(f"{prefix}_{short}") for short, a in ACTIONS.items()]

    def span(self) -> Column:
        day = F.col("day").cast("long")
        return F.coalesce(F.max(day) - F.min(day), F.lit(0).cast("long"))

    def promo(self, prefix: str) -> list[Column]:
        """Promotion-day and all-time counts per action, and the day's row count."""
        promo = is_promo_day(F.col("dt"))
        day = [F.count_if(promo & is_action(a)).alias(f"{prefix}_{name}_1111") for name, a in PROMO_NAMES.items()]
        total = [F.count_if(is_action(a)).alias(f"{prefix}_{name}_total") for name, a in PROMO_NAMES.items()]
        return [*day, *total, F.count_if(promo).alias("_promo_rows")]

    def table(self, *exprs: Column) -> DataFrame:
        sums = self.log.groupBy(*self.keys).agg(*exprs, F.count("*").alias("_n"))
        if not self.counted:
            return sums.drop("_n")
        sums = stage(sums, "sums")
        counts = distinct_counts(self.log, self.keys, self.counted, sums)
        both = _same(sums.drop("_n"), counts, self.keys, "left")
        none = F.lit(0).cast("long")
        return both.withColumns({n: F.coalesce(n, none) for n in self.counted})

    def only(self, grain: DataFrame) -> DataFrame:
        """The asked-for columns, with the distinct counts that were left out gone."""
        return grain if self.columns is None else grain.select(*self.keys, *self.columns)


def promo_columns(prefix: str, totals: bool) -> list[str]:
    day = [f"{prefix}_{name}_1111" for name in PROMO_NAMES]
    share = [f"{prefix}_{name}_1111_ratio" for name in PROMO_NAMES]
    total = [f"{prefix}_{name}_total" for name in PROMO_NAMES] if totals else []
    return day + total + share


def with_promo_shares(grain: DataFrame, prefix: str) -> DataFrame:
    """Shares of the promotion day; null for keys that were not active on it."""
    active = F.col("_promo_rows") > 0
    out = {}
    for name in PROMO_NAMES:
        day, total = F.col(f"{prefix}_{name}_1111"), F.col(f"{prefix}_{name}_total")
        out[f"{prefix}_{name}_1111"] = F.when(active, day)
        out[f"{prefix}_{name}_total"] = F.when(active, total)
        out[f"{prefix}_{name}_1111_ratio"] = F.when(active, ratio_zero_as_one(day, total))
    return grain.withColumns(out).drop("_promo_rows")


def user_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    counted = {
        "u_iid": "item_id",
        "u_cid": "cat_id",
        "u_mid": "merchant_id",
        "u_bid": "brand_id",
        "u_active_days": "day",
    }
    g = _Grain(log, ["user_id"], counted, columns)
    bought_on = g.bought_on()
    if columns is None or "u_purchase_days" in columns:
        g.counted["u_purchase_days"] = bought_on
    grain = g.table(
        *g.actions("u"),
        F.count("*").alias("u_total"),
        # The gaps between successive purchases add up to last minus first.
        (F.max(bought_on) - F.min(bought_on)).alias("_bought_span"),
        F.count(bought_on).alias("_bought"),
        *g.promo("u"),
    )
    gap = (
        F.when(F.col("_bought") > 1, F.col("_bought_span") / (F.col("_bought") - 1))
        .when(F.col("u_purchase") > 0, F.lit(SINGLE_PURCHASE_GAP))
        .cast("double")
    )
    grain = grain.withColumns(
        {
            "u_avg_days_between_purchases": gap,
            "u_purchase_click_rate": ratio_or_zero(F.col("u_purchase"), F.col("u_click")),
            "u_cart_click_rate": ratio_or_zero(F.col("u_cart"), F.col("u_click")),
            "u_fav_click_rate": ratio_or_zero(F.col("u_fav"), F.col("u_click")),
            "u_purchase_cart_rate": ratio_or_zero(F.col("u_purchase"), F.col("u_cart")),
        }
    ).drop("_bought_span", "_bought")
    return g.only(with_promo_shares(grain, "u"))


def merchant_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    counted = {"m_iid": "item_id", "m_cid": "cat_id", "m_uid": "user_id", "m_bid": "brand_id"}
    g = _Grain(log, ["merchant_id"], counted, columns)
    grain = g.table(*g.actions("m"), g.span().alias("m_days_between"), *g.promo("m"))
    grain = grain.withColumns(
        {
            "m_avg_orders_per_day": ratio_zero_as_one(
                F.col("m_purchase"), F.col("m_days_between")
            ),
            "m_purchase_per_click": ratio_or_zero(F.col("m_purchase"), F.col("m_click")),
            "m_cart_per_click": ratio_or_zero(F.col("m_cart"), F.col("m_click")),
            "m_fav_per_click": ratio_or_zero(F.col("m_fav"), F.col("m_click")),
        }
    )
    return g.only(with_promo_shares(grain, "m"))


def pair_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per (user, merchant). ``um_count`` over the user's ``u_total`` is the share."""
    counted = {"um_iid": "item_id", "um_cid": "cat_id", "um_bid": "brand_id"}
    g = _Grain(log, ["user_id", "merchant_id"], counted, columns)
    grain = g.table(
        *g.actions("um"), g.span().alias("um_days_between"), F.count("*").alias("um_count")
    )
    grain = grain.withColumns(
        {
            "um_avg_orders_per_day": ratio_zero_as_one(
                F.col("um_purchase"), F.col("um_days_between")
            ),
            "um_purchase_per_click": ratio_or_zero(F.col("um_purchase"), F.col("um_click")),
            "um_fav_per_click": ratio_or_zero(F.col("um_fav"), F.col("um_click")),
        }
    ).drop("um_cart")
    return g.only(grain)


def _attribute_grain(
    log: DataFrame, key: str, prefix: str, counted: dict[str, str], columns: list[str] | None
) -> DataFrame:
    g = _Grain(log, [key], {f"{prefix}_{n}": c for n, c in counted.items()}, columns)
    grain = g.table(
        *g.actions(prefix),
        F.count_if(is_action("purchase")).alias(f"{prefix}_purchase_count"),
        g.span().alias(f"{prefix}_days_between"),
        *g.promo(prefix),
    )
    click = F.col(f"{prefix}_click")
    rates = {
        f"{prefix}_{short}_click_rate": ratio_if_positive(F.col(f"{prefix}_{short}"), click)
        for short in ("purchase", "cart", "fav")
    }
    per_day = ratio_if_positive(F.col(f"{prefix}_purchase_count"), F.col(f"{prefix}_days_between"))
    grain = grain.withColumns({f"{prefix}_avg_purchases_per_day": per_day, **rates})
    return g.only(with_promo_shares(grain, prefix))


def brand_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    counted = {"unique_merchants": "merchant_id", "unique_items": "item_id"}
    return _attribute_grain(log, "brand_id", "b", counted, columns)


def category_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    counted = {
        "unique_users": "user_id",
        "unique_merchants": "merchant_id",
        "unique_items": "item_id",
    }
    return _attribute_grain(log, "cat_id", "c", counted, columns)


def _merchant_by(log: DataFrame, key: str, prefix: str) -> DataFrame:
    counted = {f"{prefix}_unique_users": "user_id", f"{prefix}_unique_items": "item_id"}
    g = _Grain(log, ["merchant_id", key], counted, None)
    grain = g.table(*g.actions(prefix), F.count("*").alias("_rows"))
    rate = ratio_zero_as_one(F.col(f"{prefix}_purchase"), F.col(f"{prefix}_click"))
    return grain.withColumn(f"{prefix}_purchase_click_rate", rate)


def merchant_brand_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per (merchant, brand); ``_rows`` ranks the brands of a merchant."""
    return _merchant_by(log, "brand_id", "mb")


def merchant_category_grain(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _merchant_by(log, "cat_id", "mc")


def most_frequent(counts: DataFrame, keys: list[str], value: str, rows: str) -> DataFrame:
    """The row with the highest count per key, the lowest value among equals.

    ``max_by`` keeps one candidate per key and task before the shuffle, so no key's rows
    are gathered; over a struct Spark aggregates sorted rows.
    """
    others = [c for c in counts.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(F.col(rows), -F.col(value))).alias("_best")
    return counts.groupBy(*keys).agg(best).select(*keys, "_best.*")


def top_brand_per_pair(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _top_per_pair(log, "brand_id", "top_brand_id", "freq_brand")


def top_category_per_pair(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _top_per_pair(log, "cat_id", "top_cat_id", "freq_cat")


def _top_per_pair(log: DataFrame, value: str, top: str, freq: str) -> DataFrame:
    keys = ["user_id", "merchant_id"]
    counts = log.groupBy(*keys, value).agg(F.count("*").alias(freq))
    return most_frequent(counts, keys, value, freq).select(
        *keys, F.col(value).alias(top), F.col(freq)
    )

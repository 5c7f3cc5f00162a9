"""Order-dependent features: gaps, sessions, cart-to-purchase intervals, recency.

The log's time is whole days, so rows are first reduced to one per key and day.
A window over a key then sees at most one row per calendar day, however many
actions the key has. Where the order inside a day matters, the day is cut into
short runs of the sequence number first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.operators.grains import is_action

PAIR = ["user_id", "merchant_id"]
# Sequence numbers per run when the order inside one day is followed.
RUN_LENGTH = 1 << 16
# Log rows for each task that sorts the days of users: day rows shrink so much in a
# shuffle that parts chosen by their bytes there would be large in memory.
TASK_ROWS = 500_000


def day_gaps(rows: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Rows per key and active day, and days since the key's previous active day.

    ``parts`` deals the keys over that many tasks.
    """
    days = rows.filter(F.col("dt").isNotNull()).groupBy(*keys, "dt").agg(F.count("*").alias("rows"))
    days = days if parts is None else days.repartition(parts, *keys)
    by_key = Window.partitionBy(*keys).orderBy("dt")
    return days.withColumn("gap_days", F.datediff("dt", F.lag("dt").over(by_key)))


def gap_stats(purchases: DataFrame) -> DataFrame:
    """Mean, sample deviation, least and largest gap between a pair's purchases.

    n purchases on one day add n - 1 gaps of zero, which change the number of
    gaps and the minimum but none of the sums, so day rows are enough.
    """
    gap = F.col("gap_days").cast("double")
    per_pair = (
        day_gaps(purchases, PAIR)
        .groupBy(*PAIR)
        .agg(
            (F.sum("rows") - 1).alias("_gaps"),
            F.sum(gap).alias("_sum"),
            F.sum(gap * gap).alias("_squares"),
            F.min("gap_days").alias("_min"),
            F.max("gap_days").alias("_max"),
            F.max("rows").alias("_most_on_a_day"),
        )
    )
    n, total = F.col("_gaps").cast("double"), F.coalesce(F.col("_sum"), F.lit(0.0))
    squares = F.coalesce(F.col("_squares"), F.lit(0.0))
    spread = F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1)
    zero_gap = F.col("_most_on_a_day") > 1
    least = F.when(zero_gap, 0).otherwise(F.col("_min"))
    return per_pair.select(
        *PAIR,
        F.when(n > 0, total / n).alias("repurchase_gap_mean"),
        F.when(n > 1, F.sqrt(spread)).alias("repurchase_gap_std"),
        F.when(n > 0, least).cast("double").alias("repurchase_gap_min"),
        F.when(n > 0, F.coalesce(F.col("_max"), F.lit(0))).cast("double").alias(
            "repurchase_gap_max"
        ),
    )


def recency_frequency(purchases: DataFrame, all_purchases: DataFrame | None = None) -> DataFrame:
    """R: days from the pair's last purchase to the log's last; F and M: purchases.

    Where ``purchases`` holds some pairs only, ``all_purchases`` gives the last day.
    """
    newest = (purchases if all_purchases is None else all_purchases).agg(F.max("dt")).scalar()
    return (
        purchases.groupBy(*PAIR)
        .agg(F.max("dt").alias("_last"), F.count("dt").alias("F"))
        .select(
            *PAIR,
            F.datediff(newest, F.col("_last")).cast("double").alias("R"),
            F.col("F").cast("double").alias("F"),
            F.col("F").cast("double").alias("M"),
        )
    )


def rfm_and_gaps(
    log: DataFrame, columns: list[str] | None = None, whole: DataFrame | None = None
) -> DataFrame:
    """Recency, frequency and gaps of the pairs in ``log``, a part of ``whole``."""
    purchases = log.filter(is_action("purchase"))
    everyone = purchases if whole is None else whole.filter(is_action("purchase"))
    return recency_frequency(purchases, everyone).join(gap_stats(purchases), PAIR, "left")


def _order() -> Column:
    return F.struct("seq1", "seq2", "item_id")


def action_runs(log: DataFrame, first: str = "add-to-cart", then: str = "purchase") -> DataFrame:
    """Cart and purchase rows of a pair, cut into ordered runs.

    One row per pair, day and run: how often ``first`` is directly followed by
    ``then`` inside the run, the run's opening and closing action, and the day
    and opening action of the pair's next run.
    """
    run_keys = [*PAIR, "dt", "run"]
    rows = (
        log.filter(F.col("action_type").isin(first, then) & F.col("dt").isNotNull())
        .select(*PAIR, "dt", "seq1", "seq2", "item_id", "action_type")
        .withColumn("run", F.floor(F.col("seq1") / RUN_LENGTH))
    )
    in_run = Window.partitionBy(*run_keys).orderBy("seq1", "seq2", "item_id")
    follows = is_action(first) & (F.lead("action_type").over(in_run) == then)
    runs = (
        rows.withColumn("_follows", F.coalesce(follows, F.lit(False)))
        .groupBy(*run_keys)
        .agg(
            F.count_if("_follows").alias("pairs_inside"),
            F.min_by("action_type", _order()).alias("first_action"),
            F.max_by("action_type", _order()).alias("last_action"),
        )
    )
    by_pair = Window.partitionBy(*PAIR).orderBy("dt", "run")
    return runs.withColumns(
        {
            "next_dt": F.lead("dt").over(by_pair),
            "next_action": F.lead("first_action").over(by_pair),
        }
    )


def cart_purchase_interval(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean days from a cart row to the purchase row right after it, per pair."""
    crosses = (F.col("last_action") == "add-to-cart") & (F.col("next_action") == "purchase")
    return (
        action_runs(log)
        .groupBy(*PAIR)
        .agg(
            F.sum("pairs_inside").alias("_inside"),
            F.count_if(crosses).alias("_across"),
            F.sum(F.when(crosses, F.datediff("next_dt", "dt"))).alias("_days"),
        )
        .filter(F.col("_inside") + F.col("_across") > 0)
        .select(
            *PAIR,
            (
                F.coalesce(F.col("_days"), F.lit(0)).cast("double")
                / (F.col("_inside") + F.col("_across"))
            ).alias("um_avg_cart_purchase_interval"),
        )
    )


def session_days(log: DataFrame, session_gap: float = 7) -> DataFrame:
    """Active days of a user numbered by session: a longer gap opens a new one."""
    by_user = Window.partitionBy("user_id").orderBy("dt")
    opens = F.coalesce((F.col("gap_days") > session_gap).cast("long"), F.lit(0))
    parts = -(-log.count() // TASK_ROWS) or 1
    return day_gaps(log, ["user_id"], parts).withColumn("session_id", F.sum(opens).over(by_user))


def sessions(log: DataFrame, session_gap: float = 7) -> DataFrame:
    return (
        session_days(log, session_gap)
        .groupBy("user_id", "session_id")
        .agg(
            F.sum("rows").alias("session_action_count"),
            F.min("dt").alias("session_start"),
            F.max("dt").alias("session_end"),
        )
        .withColumn(
            "session_duration",
            (F.datediff("session_end", "session_start") * 86400).cast("double"),
        )
    )


def user_sessions(
    log: DataFrame, columns: list[str] | None = None, session_gap: float = 7
) -> DataFrame:
    return (
        sessions(log, session_gap)
        .groupBy("user_id")
        .agg(
            F.avg("session_action_count").alias("session_action_mean"),
            F.max("session_action_count").cast("double").alias("session_action_max"),
            F.avg("session_duration").alias("session_duration_mean"),
            F.max("session_duration").alias("session_duration_max"),
        )
    )

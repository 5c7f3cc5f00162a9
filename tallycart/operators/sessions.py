"""Sessions on time stamps: a key's events cut wherever the time since the previous one exceeds a gap.

A window over the key alone would put all events of one key into one task. Here the
events are first laid out by range of (key, time, tie) over a fixed number of parts, so a
key with a third of all events spans many parts like any other stretch of the order.
Each part finds the gaps between its own neighbours; the first event of a key in a part
takes its predecessor from a small table with one row per part and key (its last time),
and session numbers add the breaks of the key's earlier parts to those within the part.
That small table has at most one row per part for a key, whatever the key's size.

Events without key or time are left out. Equal times are ordered by the tie column; the
gap between them is zero, so they never break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.session import stage

# The gap of the events table's session key, in seconds.
GAP_SECONDS = 12 * 3600


def ranged_events(events: DataFrame, key: str = "user_id", time: str = "ts", tie: str = "event_id") -> DataFrame:
    """The events with ``_t`` (micro-seconds) and ``_part``, laid out by range of the order and stored."""
    spark = events.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    rows = rows.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")))
    ranged = rows.repartitionByRange(parts, key, "_t", tie).withColumn("_part", F.spark_partition_id())
    return stage(ranged, "session_parts")


def timed_sessions(
    events: DataFrame, gap_seconds: float = GAP_SECONDS, key: str = "user_id", time: str = "ts", tie: str = "event_id"
) -> DataFrame:
    """Every event with ``gap_seconds`` (since the key's previous event, null for its first)
    and ``session_no`` (0 for a key's first session, one more after every break)."""
    ranged = ranged_events(events, key, time, tie)
    local = Window.partitionBy("_part", key).orderBy("_t", tie)
    # Last time of the key in each part, and that of the key's previous part.
    ends = ranged.groupBy("_part", key).agg(F.max("_t").alias("_last"))
    ends = ends.withColumn("_before", F.lag("_last").over(Window.partitionBy(key).orderBy("_part")))
    rows = ranged.withColumn("_prev", F.lag("_t").over(local)).join(ends.select("_part", key, "_before"), ["_part", key])
    prev = F.coalesce("_prev", "_before")
    rows = rows.withColumn("gap_seconds", (F.col("_t") - prev) / 1e6).withColumn(
        "_break", F.coalesce((F.col("_t") - prev > int(gap_seconds * 1e6)).cast("long"), F.lit(0))
    )
    rows = stage(rows.drop("_prev", "_before"), "session_breaks")
    counts = rows.groupBy("_part", key).agg(F.sum("_break").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    within = F.sum("_break").over(local.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.join(counts.select("_part", key, "_start"), ["_part", key])
    return numbered.withColumn("session_no", F.col("_start") + within).drop("_part", "_break", "_start")


def session_table(rows: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, session_no, session_action_count, session_start, session_end, session_duration in seconds,
    duration_us in whole micro-seconds)."""
    return (
        rows.groupBy(key, "session_no")
        .agg(F.count("*").alias("session_action_count"), F.min("_t").alias("_a"), F.max("_t").alias("_b"))
        .select(
            key,
            "session_no",
            "session_action_count",
            F.timestamp_micros("_a").alias("session_start"),
            F.timestamp_micros("_b").alias("session_end"),
            ((F.col("_b") - F.col("_a")) / 1e6).alias("session_duration"),
            (F.col("_b") - F.col("_a")).alias("duration_us"),
        )
    )


def user_session_features(events: DataFrame, gap_seconds: float = GAP_SECONDS, key: str = "user_id") -> DataFrame:
    """Per key: number of sessions, mean and largest events and duration (seconds) of its sessions."""
    table = session_table(timed_sessions(events, gap_seconds, key), key)
    return table.groupBy(key).agg(
        F.count("*").alias("n_sessions"),
        F.avg("session_action_count").alias("session_action_mean"),
        F.max("session_action_count").cast("double").alias("session_action_max"),
        # Whole micro-seconds add up exactly in any order; the mean is kept to the micro-second.
        (F.round(F.avg("duration_us")) / 1e6).alias("session_duration_mean"),
        F.max("session_duration").alias("session_duration_max"),
    )

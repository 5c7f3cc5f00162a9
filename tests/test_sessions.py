"""Sessions on time stamps against a plain loop, and a hot key spread over parts."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallycart.operators import sessions

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"


def brute(rows, gap):
    by_user = defaultdict(list)
    for e, ts, u, _ in rows:
        if u is not None and ts is not None:
            by_user[u].append((ts, e))
    out = {}
    for u, events in by_user.items():
        events.sort(key=lambda x: (x[0], -1 if x[1] is None else x[1]))
        no, prev = 0, None
        for ts, e in events:
            g = None if prev is None else (ts - prev).total_seconds()
            if g is not None and g > gap:
                no += 1
            out[e] = (u, g, no)
            prev = ts
    return out


def events(n, hot_share=0.0, seed=4):
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for e in range(n):
        u = 0 if rnd.random() < hot_share else rnd.randrange(1, 20)
        ts = start + timedelta(seconds=rnd.randrange(0, 60 * 86400))
        rows.append((e, ts, u, "click"))
    rows += [(n, None, 3, "x"), (n + 1, start, None, "x"), (n + 2, start, 7, "x"), (n + 3, start, 7, "x")]
    return rows


def test_sessions_match_a_loop(spark):
    rows = events(3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r["event_id"]: (r["user_id"], r["gap_seconds"], r["session_no"]) for r in sessions.timed_sessions(df).collect()}
    want = brute(rows, sessions.GAP_SECONDS)
    assert got.keys() == want.keys()
    for e, (u, g, no) in want.items():
        gu, gg, gno = got[e]
        assert (gu, gno) == (u, no)
        assert (g is None and gg is None) or abs(gg - g) < 1e-6


def test_user_features_match_a_loop(spark):
    rows = events(2000, seed=8)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["user_id"]: r for r in sessions.user_session_features(df, gap_seconds=6 * 3600).collect()}
    per = defaultdict(list)
    seen = brute(rows, 6 * 3600)
    times = {e: ts for e, ts, _, _ in rows}
    for e, (u, _, no) in seen.items():
        per[(u, no)].append(times[e])
    users = defaultdict(list)
    for (u, _), ts in per.items():
        users[u].append((len(ts), (max(ts) - min(ts)).total_seconds()))
    assert got.keys() == users.keys()
    for u, s in users.items():
        r = got[u]
        assert r["n_sessions"] == len(s)
        assert abs(r["session_action_mean"] - sum(n for n, _ in s) / len(s)) < 1e-9
        assert r["session_action_max"] == max(n for n, _ in s)
        assert abs(r["session_duration_mean"] - sum(d for _, d in s) / len(s)) < 1e-6
        assert r["session_duration_max"] == max(d for _, d in s)


def test_hot_user_spans_several_parts(spark):
    rows = events(4000, hot_share=0.5, seed=2)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = sessions.ranged_events(df).filter("user_id = 0").select("_part").distinct().count()
    assert parts >= 2
    got = {r["event_id"]: (r["user_id"], r["session_no"]) for r in sessions.timed_sessions(df).collect()}
    want = {e: (u, no) for e, (u, _, no) in brute(rows, sessions.GAP_SECONDS).items()}
    assert got == want


def test_no_events(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert sessions.timed_sessions(df).count() == 0
    assert sessions.user_session_features(df).count() == 0
    assert "session_no" in sessions.timed_sessions(df.withColumn("extra", F.lit(1))).columns

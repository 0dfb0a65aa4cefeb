import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketloom.operators import sessions

SCHEMA = "user string, event string, ts timestamp_ntz, item string, user_id string, chunk int, us int"
BASE = datetime(2026, 1, 1)
SECOND = 1_000_000


def table(spark, rows):
    return spark.createDataFrame([(u, e, t, i, "clash", 1, 2) for u, e, t, i in rows], SCHEMA)


def brute(rows, gap_us):
    out = set()
    seen = {}
    for u, e, t, i in rows:
        if u is not None and e is not None and t is not None:
            seen[e] = (u, t, i)
    for user in {u for u, _, _ in seen.values()}:
        line = sorted((t, e, i) for e, (u, t, i) in seen.items() if u == user)
        start = 0
        for k in range(1, len(line) + 1):
            if k == len(line) or (line[k][0] - line[k - 1][0]) / timedelta(microseconds=1) > gap_us:
                part = line[start:k]
                out.add((user, part[0][1], part[-1][1], len(part), len({i for _, _, i in part if i is not None})))
                start = k
    return out


def random_rows(seed):
    rng = random.Random(seed)
    rows, at = [], BASE
    for k in range(400):
        at += timedelta(seconds=rng.choice([0, 1, 5, 9, 10, 11, 30, 31, 59, 60, 61, 600, 4000]))
        rows.append(("hot", f"e{k:04d}", at, rng.choice(["x", "y", None])))
    for k in range(200):
        rows.append((rng.choice(["a", "b", "c", None]), f"f{k:04d}", rng.choice([None, *[BASE + timedelta(seconds=rng.randint(0, 2000)) for _ in range(9)]]), "z"))
    rows += [("wrong clock", "g1", datetime(1970, 1, 1), None), ("wrong clock", "g2", datetime(2100, 1, 1), "x"), ("single", "g3", BASE, "x")]
    rows += rng.sample(rows, 60)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,chunk_s", [(1, 60), (2, 977), (3, 86_400)])
def test_same_as_brute_force_at_many_gaps(spark, seed, chunk_s):
    rows = random_rows(seed)
    df = table(spark, rows)
    tree = sessions.gap_tree(df, "user", "event", "ts", 10 * SECOND, chunk_s * SECOND).cache()
    for gap in (10, 11, 30, 60, 599, 600, 5000, 10**10):
        got = {(r["user_id"], r["first_event_id"], r["last_event_id"], r["n_events"]) for r in sessions.cut(tree, gap * SECOND).collect()}
        assert got == {x[:4] for x in brute(rows, gap * SECOND)}, gap
    tree.unpersist()


def test_item_counts(spark):
    rows = random_rows(7)
    df = table(spark, rows)
    found = sessions.cut(sessions.gap_tree(df, "user", "event", "ts", SECOND, 100 * SECOND), 60 * SECOND)
    got = {(r["user_id"], r["first_event_id"], r["last_event_id"], r["n_events"], r["n_items"]) for r in sessions.count_items(found, df, "user", "item", "ts", SECOND, 100 * SECOND).collect()}
    assert got == brute(rows, 60 * SECOND)


def test_gap_to_the_microsecond(spark):
    at = lambda us: BASE + timedelta(microseconds=us)
    df = table(spark, [("a", "e1", at(0), None), ("a", "e2", at(30 * SECOND), None), ("a", "e3", at(60 * SECOND + 1), None)])
    got = sessions.cut(sessions.gap_tree(df, "user", "event", "ts", SECOND), 30 * SECOND)
    assert {(r["first_event_id"], r["last_event_id"]) for r in got.collect()} == {("e1", "e2"), ("e3", "e3")}


def test_long_falling_and_rising_gaps(spark):
    """Every gap stays open until the merge."""
    at, rows = BASE, []
    for k in range(300):
        at += timedelta(seconds=k + 2)
        rows.append(("a", f"e{k:04d}", at, None))
    for k in range(300, 0, -1):
        at += timedelta(seconds=k + 2)
        rows.append(("a", f"f{300 - k:04d}", at, None))
    tree = sessions.gap_tree(table(spark, rows), "user", "event", "ts", SECOND, 500 * SECOND)
    for gap in (50, 250):
        assert {(r["user_id"], r["first_event_id"], r["last_event_id"], r["n_events"]) for r in sessions.cut(tree, gap * SECOND).collect()} == {x[:4] for x in brute(rows, gap * SECOND)}


def test_all_events_of_a_day_by_one_user(spark):
    """What a task holds follows the floor intervals of the day, not its events."""
    n, step = 400_000, 86_400_000_000 // 400_000
    start = int(BASE.timestamp()) * SECOND
    us = F.lit(start) + F.col("id") * step + F.when(F.col("id") >= n // 2, 3_600 * SECOND).otherwise(0)
    df = spark.range(n, numPartitions=8).select(F.lit("hot").alias("user"), F.format_string("e%07d", "id").alias("event"), F.timestamp_micros(us).cast("timestamp_ntz").alias("ts"), F.lit("x").alias("item"))
    tree = sessions.gap_tree(df, "user", "event", "ts", 60 * SECOND)
    assert {(r["first_event_id"], r["last_event_id"], r["n_events"]) for r in sessions.cut(tree, 1800 * SECOND).collect()} == {("e0000000", f"e{n // 2 - 1:07d}", n // 2), (f"e{n // 2:07d}", f"e{n - 1:07d}", n // 2)}


def test_empty(spark):
    assert sessions.gap_tree(table(spark, []), "user", "event", "ts", SECOND).collect() == []
    assert sessions.gap_tree(table(spark, [(None, "e", BASE, None), ("a", "e", None, None)]), "user", "event", "ts", SECOND).collect() == []

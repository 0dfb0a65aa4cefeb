import random
from datetime import date, datetime, timedelta

import pytest

from marketloom.operators import asof

BASE = datetime(2026, 1, 1)
EVENTS = "event string, item string, ts timestamp_ntz, period int, log int, views int"
CHANGES = "id bigint, item string, day date, loaded timestamp_ntz, views bigint, state int, entity int"


def run(spark, events, changes, **more):
    e = spark.createDataFrame([(*x, 1, 2, 3) for x in events], EVENTS)
    c = spark.createDataFrame([(*x, 1, 2) for x in changes], CHANGES)
    got = asof.as_known(e, "event", "item", "ts", c, "loaded", ["day"], ["id", "views"], **more)
    return {r["event"]: (r["known"]["id"], r["known"]["views"]) if r["known"] else None for r in got.collect()}


def brute(events, changes):
    out = {}
    for event, item, ts in events:
        if event is None or item is None or ts is None:
            continue
        known = [(d or date.min, t, i, v if v is not None else -1) for i, it, d, t, v in changes if it == item and t is not None and t <= ts]
        best = max(known, default=None)
        out[event] = None if best is None else (best[2], None if best[3] == -1 else best[3])
    return out


@pytest.mark.parametrize("seed,period,hot", [(1, 1, []), (2, 24, ["a"]), (3, 500, ["a", "b"])])
def test_same_as_brute_force(spark, seed, period, hot):
    rng = random.Random(seed)
    when = lambda: BASE + timedelta(hours=rng.randint(0, 400))
    items = ["a", "b", "c", "never"]
    changes = [(i, rng.choice(items[:3]), (BASE + timedelta(days=rng.randint(-3, 15))).date(), None if rng.random() < 0.1 else when(), rng.choice([None, 0, 7])) for i in range(120)]
    changes += changes[:15]
    events = [(f"e{i}", rng.choice([*items, None]), None if rng.random() < 0.05 else when()) for i in range(300)]
    events += [("far", "a", datetime(2300, 1, 1)), ("early", "a", datetime(1970, 1, 1)), *events[:30]]
    assert run(spark, events, changes, period_us=period * 3_600_000_000, hot=hot, salts=3) == brute(events, changes)


def test_change_at_the_time_of_the_event_and_later_restatement(spark):
    changes = [(1, "a", date(2026, 1, 5), BASE, 1), (2, "a", date(2026, 1, 4), BASE + timedelta(days=1), 2), (3, "a", date(2026, 1, 5), BASE + timedelta(days=20), 3)]
    events = [("at", "a", BASE), ("after an older day came", "a", BASE + timedelta(days=2)), ("restated", "a", BASE + timedelta(days=20)), ("before", "a", BASE - timedelta(microseconds=1))]
    assert run(spark, events, changes) == {"at": (1, 1), "after an older day came": (1, 1), "restated": (3, 3), "before": None}


def test_ties_and_empty(spark):
    changes = [(1, "a", date(2026, 1, 5), BASE, 1), (2, "a", date(2026, 1, 5), BASE, 1)]
    assert run(spark, [("e", "a", BASE)], changes) == {"e": (2, 1)}
    assert run(spark, [("e", "a", BASE)], []) == {"e": None}
    assert run(spark, [], changes) == {}

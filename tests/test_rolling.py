import random
from datetime import date, timedelta

import pytest

from marketloom.operators.rolling import rolling_totals

FIRST, LAST = date(2026, 1, 1), date(2026, 3, 1)
SCHEMA = "item string, day date, x bigint, y bigint, entity string, at int, tile int, m0 int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "e", 1, 2, 3) for r in rows], SCHEMA)


def brute(rows, windows):
    n = (LAST - FIRST).days + 1
    out = {}
    for item in {r[0] for r in rows if r[0] is not None}:
        for d in range(n):
            day = FIRST + timedelta(d)
            for w in windows:
                span = [r for r in rows if r[0] == item and r[1] is not None and FIRST <= r[1] <= LAST and 0 <= (day - r[1]).days < w]
                out[item, day, w] = (sum(r[2] or 0 for r in span), sum(r[3] or 0 for r in span))
    return out


@pytest.mark.parametrize("tile", [5, 32, 200])
def test_same_as_brute_force(spark, tile):
    rng = random.Random(tile)
    rows = []
    for _ in range(300):
        day = FIRST + timedelta(rng.randint(-20, 80)) if rng.random() > 0.05 else None
        rows.append((rng.choice(["a", "b", "c", "d", None]), day, rng.choice([None, 0, 1, 5]), rng.choice([None, 2, -1])))
    rows += rows[:20] + [("only outside", date(1970, 1, 1), 3, 3), ("only null", None, None, None)]
    want = brute(rows, [3, 30])
    got = {(r["item"], r["day"], w): (r[f"x_{w}d"], r[f"y_{w}d"]) for r in rolling_totals(table(spark, rows), "item", "day", ["x", "y"], [3, 30], FIRST, LAST, tile_days=tile).collect() for w in (3, 30)}
    assert got == want


def test_empty_and_keep(spark):
    assert rolling_totals(table(spark, []), "item", "day", ["x"], [7], FIRST, LAST).collect() == []
    df = table(spark, [("a", date(2026, 1, 5), 4, 0)])
    kept = rolling_totals(df, "item", "day", ["x"], [7], FIRST, LAST, keep=lambda c: c["x_7d"] > 3).collect()
    assert [r["day"].day for r in kept] == list(range(5, 12))


def test_many_entities_cross_batches(spark):
    n = 5000
    df = table(spark, [(f"i{i:05d}", date(2026, 2, 1), i, 0) for i in range(n)])
    got = rolling_totals(df.repartition(3), "item", "day", ["x"], [2], FIRST, LAST)
    assert got.count() == n * 60
    assert got.filter("x_2d > 0 and day = date'2026-02-02'").agg({"x_2d": "sum"}).first()[0] == n * (n - 1) // 2

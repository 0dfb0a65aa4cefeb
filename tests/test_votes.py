"""Votes of neighbours: the same from one block of voters and from many, and no rows of single votes."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from marketloom.operators import candidates as c
from marketloom.operators import votes
from tests.support import tuples


def simulated(rows, asked, k, history=5, item_cap=4, neighbour_cap=3):
    held = {}
    for u, i in sorted(rows, key=repr):
        held.setdefault(u, []).append(i)
    got = []
    for u in sorted(held) if asked is None else sorted(asked & set(held)):
        score = Counter()
        for seed in held[u][:item_cap][:history]:
            near = sorted(v for v in held if seed in held[v] and (asked is None or v not in asked))
            for v in [v for v in near if v != u][:neighbour_cap]:
                score.update(i for i in held[v][:item_cap] if i not in held[u][:item_cap])
        best = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]
        got += [(u, i, n, r + 1) for r, (i, n) in enumerate(best)]
    return sorted(got, key=repr)


def test_votes_of_many_blocks_and_of_asked_users(spark, monkeypatch):
    draw = random.Random(5)
    rows = sorted({(f"u{draw.randrange(40):02d}", f"i{draw.randrange(25):02d}") for _ in range(240)})
    pairs = spark.createDataFrame(rows, "user_id string, item_id string").selectExpr("*", "date'2026-04-01' as last_date", "1 as count")
    asked = {u for u, _ in rows if int(u[1:]) % 3 == 0}
    queries = spark.createDataFrame([(u,) for u in sorted(asked)], "user_id string")
    for pair_rows in (1 << 22, 50):
        monkeypatch.setattr(votes, "PAIR_ROWS", pair_rows)
        for who, frame in ((None, None), (asked, queries)):
            got = c.user_knn(pairs, frame, 6, item_cap=4, neighbour_cap=3).select("user_id", "item_id", "score", "rank")
            assert tuples(got) == simulated(rows, who, 6)


def test_single_votes_are_no_rows(spark):
    pairs = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", None), ("b", "z")], "user_id string, item_id string").selectExpr("*", "date'2026-04-01' as last_date", "1 as count")
    found = c.user_knn(pairs, None, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan and plan.count("Generate") <= 2
    assert tuples(found.select("user_id", "item_id", "score", "rank")) == [("a", "z", 1, 2), ("a", None, 1, 1)]
    assert c.user_knn(pairs.filter(F.lit(False)), None, 3).collect() == []

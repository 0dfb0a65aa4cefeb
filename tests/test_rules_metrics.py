import math
import random
from datetime import date, datetime

import pytest

from marketloom.constants import AGENT_SHARE, CATEGORY_SHARES
from marketloom.operators import candidates, cleaning, learned, metrics, rules
from tests.support import tuples


def test_popularity_order(spark):
    df = spark.createDataFrame([("a", 10, 10), ("b", 5, 10), ("c", 0, 20), ("n", None, 5)], "item_id string, contacts_24h bigint, views_24h bigint")
    assert [r["pop_score"] for r in candidates.popularity(df, 3).orderBy("rank").collect()] == [110, 60, 20]
    assert tuples(candidates.popularity(df.drop("contacts_24h").limit(0), 3)) == []


def test_decay(spark):
    now = date(2026, 4, 8)
    rows = [("u1", "i1", "pageview", datetime(2026, 4, 8)), ("u1", "i1", "view_phone", datetime(2026, 4, 8)), ("u1", "i2", "pageview", datetime(2026, 4, 1)), ("u2", "i1", "lead", datetime(2026, 5, 1)), ("u3", "i1", "lead", None)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, event_type string, event_ts timestamp_ntz")
    got = {(r[0], r[1]): r[2] for r in cleaning.decayed_scores(df, now).collect()}
    assert got == {("u1", "i1"): 6.0, ("u1", "i2"): 0.5, ("u2", "i1"): 10.0, ("u3", "i1"): 0.0}


def test_geo(spark):
    sim = spark.createDataFrame([("A", "A", 1.0), ("A", "B", 0.4)], "district_a string, district_b string, jaccard_similarity double")
    schema = "id int, district_name string, user_viewed_districts array<struct<district:string,weight:bigint>>"
    items = spark.createDataFrame([(1, "A", [("A", 2)]), (2, "A", [("B", 1)]), (3, "A", [("Z", 1)]), (4, "A", None), (5, "A", [("A", 1), ("B", 1)])], schema)
    assert {r["id"]: round(r["geo_score"], 6) for r in rules.geo(items, sim, ["id"]).collect()} == {1: 1.0, 2: 0.4, 3: 0.05, 4: 0.5, 5: 0.7}


def test_urgency_and_value_without_their_columns(spark):
    df = spark.createDataFrame([(1, 0)], "id int, listing_age_days int")
    assert rules.urgency(df).first()["urgency_score"] == 1.0
    assert rules.urgency(df.drop("listing_age_days")).first()["urgency_score"] == 0.5
    assert rules.value(df).first()["value_score"] == 1.0


def test_match(spark):
    df = spark.createDataFrame([(1, [1, 2], "x", "x", 0.5, 0.4, 0.6)], "category int, user_top_categories array<int>, city_name string, user_top_city string, item_price_pct double, user_price_min double, user_price_max double")
    assert rules.match(df).first()["match_score"] == 2.5


def test_metrics_per_user(spark):
    truth = spark.createDataFrame([("u", "a"), ("u", "c"), ("v", "x")], "user_id string, item_id string")
    recs = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "c", 3)], "user_id string, item_id string, rank int")
    got = {r["user_id"]: r for r in metrics.per_user(recs, truth, 3).collect()}
    assert got["u"]["recall"] == 1.0 and round(got["u"]["ap"], 3) == 0.833 and round(got["u"]["precision"], 3) == 0.667
    assert round(got["u"]["ndcg"], 6) == round((1 + 1 / math.log2(4)) / (1 + 1 / math.log2(3)), 6)
    assert got["v"]["recall"] == 0.0 and got["v"]["hit"] == 0
    assert metrics.per_user(recs, truth.limit(0), 3).collect() == []


def test_diversity(spark):
    recs = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "c", 3), ("w", "a", 1)], "user_id string, item_id string, rank int")
    items = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "item_id string, city string")
    assert {r[0]: round(r[1], 3) for r in metrics.feature_diversity(recs, items, "city").collect()} == {"u": 0.667, "w": 1.0}


def test_output_checks_see_faults(spark):
    schema = "ID bigint, user_id string, rank int, item_id string"
    users, listings = spark.createDataFrame([("a",), ("b",)], "user_id string"), spark.createDataFrame([(f"i{n}",) for n in range(20)], "item_id string")
    good = [(u * 10 + r, "ab"[u], r, f"i{(u * 3 + r) % 20}") for u in range(2) for r in range(1, 11)]
    row = metrics.violations(spark.createDataFrame(good, schema), users, listings, most_first=0.6).first().asDict()
    assert row.pop("rows") == 20 and set(row.values()) == {0}
    bad = [*good[:-1], (20, "b", 10, "unknown")]
    assert metrics.violations(spark.createDataFrame(bad[1:], schema), users, listings, most_first=0.6).first()["bad_lists"] == 1
    assert metrics.violations(spark.createDataFrame(bad, schema), users, listings, most_first=0.6).first()["unknown_items"] == 1


def test_bots_bounces_and_zombies(spark):
    base = datetime(2026, 4, 1, 10)
    rows = [("u1", "pageview", base, 30), ("u1", "pageview", base.replace(hour=12), 10), *[("bot", "pageview", base.replace(second=s % 60), 0) for s in range(60)], ("u2", "pageview", base, None)]
    df = spark.createDataFrame(rows, "user_id string, event_type string, event_ts timestamp_ntz, dwell_time_sec bigint")
    assert {r[0] for r in cleaning.without_bots(df).select("user_id").collect()} == {"u1"}
    b = spark.createDataFrame([("pageview", 2999), ("pageview", 3000), ("lead", 1), ("pageview", None)], "event_type string, dwell_time_sec bigint")
    assert cleaning.without_bounces(b).count() == 3
    z = spark.createDataFrame([(61, 4, 0, 1), (61, 4, None, 1), (61, 5, None, 1), (10, None, None, 1), (10, 9, 9, 0)], "listing_age_days int, views_24h int, contacts_24h int, images_count int")
    assert cleaning.without_zombies(z).count() == 2


def test_split_errors(spark):
    df = spark.createDataFrame([(date(2026, 1, d),) for d in range(1, 6)], "date date")
    train, rest = cleaning.time_split(df, "date", 2)
    assert (train.count(), rest.count()) == (2, 3)
    with pytest.raises(ValueError):
        cleaning.time_split(df, "none", 2)
    with pytest.raises(ValueError):
        cleaning.time_split(df.limit(0), "date", 2)


def test_fair_top_keeps_the_share(spark):
    rows = [(f"a{i}", 100.0 - i, "agent", "c") for i in range(8)] + [(f"p{i}", 50.0 - i, "private", "c") for i in range(8)] + [("n", 500.0, None, "c")]
    df = spark.createDataFrame(rows, "item_id string, trend_score double, seller_type string, city_name string")
    got = [r["item_id"] for r in candidates.fair_top(df, ["city_name"], 6).orderBy("rank").collect()]
    assert got == ["a0", "p0", "a1", "p1", "a2", "p2"]
    assert candidates.fair_top(df, [], 100).count() == 17


@pytest.mark.parametrize("share", [0.52, 0.5, 0.2, 0.9])
def test_fair_top_takes_turns_as_the_rule_says(spark, share):
    rows, want = [], {}
    for g, (a, p, u) in enumerate([(0, 5, 2), (5, 0, 0), (40, 3, 1), (3, 40, 1), (30, 30, 30), (1, 1, 0), (26, 25, 0)]):
        kinds = [("agent", a), ("private", p), (None, u)]
        rows += [(f"g{g}", f"{kind}{i:03d}", 100.0 - i, kind) for kind, n in kinds for i in range(n)]
        line, used = [], [0, 0, 0]
        while len(line) < 50 and sum(used) < a + p + u:
            wants_agent = sum(x.startswith("agent") for x in line) / max(1, len(line)) < share
            order = (0, 1, 2) if wants_agent else (1, 0, 2)
            turn = next(i for i in order if used[i] < kinds[i][1])
            line.append(f"{kinds[turn][0]}{used[turn]:03d}")
            used[turn] += 1
        want[f"g{g}"] = line
    df = spark.createDataFrame(rows, "city_name string, item_id string, trend_score double, seller_type string")
    got = {}
    for r in candidates.fair_top(df, ["city_name"], 50, share).orderBy("city_name", "rank").collect():
        got.setdefault(r["city_name"], []).append(r["item_id"])
    assert got == want


def worth(chosen, weights):
    """The value of a list apart from its last item's own accuracy and novelty, straight from the definitions."""
    n = len(chosen)
    pairs = [(x, y) for i, x in enumerate(chosen) for y in chosen[:i]]
    alike = sum(0.4 * (x["category"] == y["category"]) + 0.3 * (x["city"] == y["city"]) + 0.3 * ((x["city"], x["district"]) == (y["city"], y["district"])) for x, y in pairs)
    parts = [sum(x["category"] == c for x in chosen) / n for c in {x["category"] for x in chosen}]
    entropy = -sum(s * math.log2(s) for s in parts)
    diversity = 1.0 if n == 1 else 0.6 * (1 - alike / len(pairs)) + 0.4 * (entropy / math.log2(len(parts)) if len(parts) > 1 else entropy)
    divergence = 0.0
    for c, e in CATEGORY_SHARES.items():
        part = sum(x["category"] == c for x in chosen) / n
        divergence += part * math.log((part + 1e-10) / (e + 1e-10))
    fairness = 0.6 * (1 - abs(sum(x["seller"] == "agent" for x in chosen) / n - AGENT_SHARE)) + 0.4 * math.exp(-divergence)
    return weights[1] * diversity + weights[2] * fairness + weights[3] * sum(math.exp(-0.05 * x["age"]) for x in chosen) / n


def test_rerank_same_as_trying_every_item(spark):
    rng = random.Random(5)
    weights, k, pool = (0.3, 0.3, 0.2, 0.1, 0.1), 6, 12
    cols = "user_id string, item_id string, score double, category int, city_name string, district_name string, seller_type string, listing_age_days int, item_total_contacts bigint"
    rows = [(f"u{u}", f"i{i:02d}", rng.random(), rng.choice([1010, 1020, 1050, 7, None]), rng.choice("xyz"), rng.choice("dn"), rng.choice(["agent", "private", None]), rng.choice([None, 1, 50]), rng.choice([None, 0, 9])) for u in range(40) for i in range(rng.choice([1, 2, 5, 20]))]
    got = {}
    for r in learned.rerank(spark.createDataFrame(rows, cols), k, weights, pool).orderBy("user_id", "pos").collect():
        got.setdefault(r["user_id"], []).append((r["item_id"], round(r["score"], 9)))
    for user in got:
        left = sorted(({"id": r[1], "score": r[2], "category": r[3], "city": r[4], "district": r[5], "seller": r[6], "age": 30 if r[7] is None else r[7], "novel": -math.log1p(r[8] or 0)} for r in rows if r[0] == user), key=lambda x: (-x["score"], x["id"]))[:pool]
        for name, into in (("score", "acc"), ("novel", "nov")):
            low, high = min(x[name] for x in left), max(x[name] for x in left)
            for x in left:
                x[into] = (x[name] - low) / ((high - low) or 1.0)
        line = []
        for _ in range(min(k, len(left))):
            value, _, pick = max(((weights[0] * x["acc"] + weights[4] * x["nov"] + worth([y for y, _ in line] + [x], weights), -i, x) for i, x in enumerate(left)), key=lambda v: (round(v[0], 9), v[1]))
            left.remove(pick)
            line.append((pick, value))
        assert got[user] == [(x["id"], round(v, 9)) for x, v in line], user


def test_greedy_rerank(spark):
    cols = "user_id string, item_id string, score double, category int, city_name string, district_name string, seller_type string, listing_age_days int, item_total_contacts bigint"
    rows = [("u", "a", 1.0, 1020, "x", "d", "agent", 1, 5), ("u", "b", 0.9, 1020, "x", "d", "agent", 1, 5), ("u", "c", 0.8, 1050, "y", "e", "private", None, None)]
    got = [r["item_id"] for r in learned.rerank(spark.createDataFrame(rows, cols), 3).orderBy("pos").collect()]
    assert got == ["a", "c", "b"]
    assert learned.rerank(spark.createDataFrame([], cols), 3).collect() == []

"""The fold against a plain simulation of filling each user's list source by source."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marketloom.constants import BUDGETS_POOL, ORDER_POOL, ORDER_TOP10
from marketloom.operators import candidates as c
from marketloom.operators import cascade as cs
from marketloom.operators import learned
from marketloom.plans import cascade as plan
from tests.support import tuples

NAMES = ["pv", "cocontact", "intent", "als", "seller"]
STEPS = {"pv": cs.CUT_FIRST, "cocontact": cs.PLACED_FIRST, "intent": cs.INDEXED, "als": cs.WHOLE, "seller": cs.CUT_FIRST}


def simulate(lists, segment, budgets, k, valid, capped):
    out = {}
    for user in lists:
        placed = []
        for name in NAMES:
            if len(placed) >= k:
                break
            rows, b = lists[user].get(name, []), budgets[name]
            if STEPS[name] == cs.CUT_FIRST:
                new = [i for i in rows[:b] if i in valid and i not in placed]
            elif STEPS[name] == cs.PLACED_FIRST:
                new = [i for i in [i for i in rows if i not in placed][:b] if i in valid]
            elif STEPS[name] == cs.INDEXED:
                new = [i for i in rows if i not in placed][:b]
            else:
                new = [i for i in rows if i in valid and i not in placed]
            placed += new[: min(k - len(placed), b if capped else k)]
        left = k - len(placed)
        placed += [i for i in segment[user][:left] if i in valid and i not in placed][:left]
        out[user] = placed
    return out


@pytest.mark.parametrize("capped", [True, False])
def test_fold_equals_simulation(spark, capped):
    rng = random.Random(5)
    items = [f"i{n:02d}" for n in range(25)]
    valid = set(rng.sample(items, 18))
    users = [f"u{n:03d}" for n in range(120)]
    lists = {u: {n: rng.sample(items, rng.randint(0, 9)) for n in NAMES if rng.random() < 0.8} for u in users}
    for u in users:  # this source's index holds valid items only
        lists[u]["intent"] = [i for i in lists[u].get("intent", []) if i in valid]
    segment = {u: rng.sample(items, 12) for u in users}
    budgets, k = {"pv": 2, "cocontact": 3, "intent": 2, "als": 4, "seller": 1}, 7
    frame = lambda rows: spark.createDataFrame(rows, "user_id string, item_id string, rank int")
    sources = [cs.Source(n, frame([(u, i, r + 1) for u in users for r, i in enumerate(lists[u].get(n, []))]), STEPS[n]) for n in NAMES]
    seg = frame([(u, i, r + 1) for u in users for r, i in enumerate(segment[u])])
    user_rows = spark.createDataFrame([(u,) for u in [*users, None, users[0]]], "user_id string")
    valid_rows = spark.createDataFrame([(i,) for i in valid], "item_id string")
    wanted = user_rows.selectExpr("user_id", "user_id as list").distinct()
    sources.append(cs.Source("segpop", cs.rest_lists(wanted, seg.withColumnRenamed("user_id", "list"), ["list"], valid=valid_rows), cs.REST))
    got: dict = {u: [] for u in users}
    for r in cs.fold(user_rows, sources, budgets, k, valid_rows, capped).orderBy("user_id", "pos").collect():
        got[r["user_id"]].append(r["item_id"])
        assert r["pos"] == len(got[r["user_id"]])
    assert got == simulate(lists, segment, budgets, k, valid, capped)


def test_the_rest_for_unknown_users_starts_at_a_place_of_their_own(spark):
    user_rows = spark.createDataFrame([("known",), ("a",), ("b",), ("c",)], "user_id string")
    first = spark.createDataFrame([("a", "x", 1), ("known", "y", 1)], "user_id string, item_id string, rank int")
    lists = spark.createDataFrame([("known", "m", 1), ("known", "n", 2)], "list string, item_id string, rank int")
    other = spark.createDataFrame([(f"o{i}", i + 1) for i in range(4)], "item_id string, rank int")
    turn = F.expr("case user_id when 'a' then 4 when 'b' then 5 else 0 end")
    rest = cs.rest_lists(user_rows.selectExpr("user_id", "if(user_id = 'known', user_id, null) as list"), lists, ["list"], other, None, turn)
    got = {r["user_id"]: [x["item_id"] for x in r["placed"]] for r in cs.fold_lists(user_rows, [cs.Source("f", first), cs.Source("s", rest, cs.REST)], {"f": 2}, 4).collect()}
    # a has three places left, so its list starts 4 % 3 places later; b starts 5 % 4 places later
    assert got == {"known": ["y", "m", "n"], "a": ["x", "o1", "o2", "o0"], "b": ["o1", "o2", "o3", "o0"], "c": ["o0", "o1", "o2", "o3"]}


def test_fold_is_one_shuffle_by_user_and_stores_nothing(spark):
    rows = spark.createDataFrame([("a", "x", 1)], "user_id string, item_id string, rank int")
    made = [cs.Source(n, rows, STEPS[n]) for n in NAMES]
    plan_text = cs.fold_lists(rows.select("user_id"), made, dict.fromkeys(NAMES, 2), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "checkpoint" not in plan_text.lower() and plan_text.count("collect_list") == len(NAMES)


def test_padding_and_submission(spark):
    placed = spark.createDataFrame([("a", "x", 1, "pv"), ("a", "y", 2, "pv")], "user_id string, item_id string, pos int, source string")
    users = spark.createDataFrame([("a",), ("b",), (None,)], "user_id string")
    popular = spark.createDataFrame([("x", 1), ("z", 2), ("w", 3), ("v", 4)], "item_id string, rank int")
    full = cs.padded(placed, users, popular, 3)
    assert tuples(full.select("user_id", "item_id", "pos")) == [("a", "x", 1), ("a", "y", 2), ("a", "z", 3), ("b", "w", 3), ("b", "x", 1), ("b", "z", 2)]
    ids = cs.submission(full, spark.createDataFrame([("a", 0), ("b", 1)], "user_id string, user_pos bigint"))
    assert sorted(r["ID"] for r in ids.collect()) == [1, 2, 3, 4, 5, 6]


def test_blend_of_two_sources(spark):
    frame = lambda rows: spark.createDataFrame(rows, "user_id string, item_id string, score double")
    a, b = frame([("u", "i1", 10.0), ("u", "i2", 5.0)]), frame([("u", "i3", 8.0), ("u", "i2", 2.0)])
    got = [(r["item_id"], round(r["score"], 6)) for r in cs.weighted_blend([(a, 0.7), (b, 0.3)], 5).orderBy("rank").collect()]
    assert got == [("i1", 0.7), ("i3", 0.3), ("i2", 0.0)]


def test_plans_use_the_orders_of_the_constants():
    assert plan.SHALLOW == ORDER_TOP10
    assert plan.DEEP == [n for n in ORDER_POOL if BUDGETS_POOL.get(n, 1)]


def test_knn_without_queries_asks_every_user(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "z"), ("c", "z")]
    pairs = spark.createDataFrame(rows, "user_id string, item_id string").selectExpr("*", "date'2026-04-01' as last_date", "1 as count")
    got = tuples(c.user_knn(pairs, None, 10, neighbour_cap=1).select("user_id", "item_id", "score"))
    assert got == [("a", "z", 1), ("b", "y", 1), ("c", "x", 1)]


def test_nearest_leaves_out_seen_items_before_the_cut(spark):
    users = spark.createDataFrame([("u", [1.0]), ("v", [1.0])], "user_id string, factors array<double>")
    items = spark.createDataFrame([(f"i{n:03d}", [float(n)]) for n in range(100)], "item_id string, factors array<double>")
    seen = spark.createDataFrame([("u", f"i{n:03d}") for n in range(20, 100)], "user_id string, item_id string")
    got = tuples(learned.nearest(users, "user_id", items, "item_id", 10, seen=seen).select("user_id", "rank", "item_id"))
    assert got == sorted([("u", r, f"i{20 - r:03d}") for r in range(1, 11)] + [("v", r, f"i{100 - r:03d}") for r in range(1, 11)], key=repr)


def test_nearest_without_queries_or_in_many_blocks(spark):
    items = spark.createDataFrame([(f"i{n:03d}", [float(n), 1.0]) for n in range(50)], "item_id string, factors array<double>")
    users = spark.createDataFrame([(f"u{n}", [1.0, float(n)]) for n in range(20)], "user_id string, factors array<double>")
    assert learned.nearest(users.limit(0), "user_id", items, "item_id", 3).collect() == []
    assert learned.nearest(users, "user_id", items.limit(0), "item_id", 3).collect() == []
    one, many = (tuples(learned.nearest(users, "user_id", items, "item_id", 3, block_rows=n)) for n in (1000, 7))
    assert one == many and len(one) == 60


def test_cascade_offers_fifty_listings_of_a_seller(spark, monkeypatch):
    listings = spark.createDataFrame([(f"i{n:03d}", "s") for n in range(60)], "item_id string, seller_id string")
    contacts = spark.createDataFrame([("u", "i059")], "user_id string, item_id string").selectExpr("*", "date'2026-04-01' as last_date", "1 as count", "'c' as city_name", "'k' as category")
    monkeypatch.setattr(plan.cq, "valid_items", lambda t: listings)
    monkeypatch.setattr(plan.cq, "prefs", lambda t: contacts.select("user_id"))
    [source] = plan.sources(SimpleNamespace(contact_pairs=contacts, listings=listings), contacts, ["seller"], 200)
    assert source.rows.count() == BUDGETS_POOL["seller"]


def test_a_list_shared_by_many_users_is_offered_without_rows_of_its_own(spark):
    """The first k valid items of a segment come to the fold as one value a user; only what has to be looked up meets the valid items."""
    users = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "user_id string, kind string")
    lists = spark.createDataFrame([("x", f"i{n}", n + 1) for n in range(6)] + [("y", "j", 4)], "kind string, item_id string, rank int")
    first = spark.createDataFrame([("a", "i1", 1), ("b", "bad", 1), ("c", "k", 1)], "user_id string, item_id string, rank int")
    valid = lists.select("item_id").union(spark.createDataFrame([("k",)], "item_id string"))
    made = [cs.Source("f", first), cs.Source("s", cs.shared_lists(users, lists, ["kind"], 3), cs.WHOLE, True), cs.Source("t", first.filter("item_id = 'k'"), cs.WHOLE, True)]
    found = cs.fold_lists(users, made, {"f": 1, "s": 3, "t": 1}, 3, valid)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 3
    got = {r["user_id"]: [x["item_id"] for x in r["placed"]] for r in found.collect()}
    assert got == {"a": ["i1", "i0", "i2"], "b": ["i0", "i1", "i2"], "c": ["k", "j"], "d": []}


def test_intent_lists_are_made_once_for_users_who_view_the_same(spark):
    kinds = [("d1", 1, "p", "c1"), ("d2", 1, "p", "c1"), (None, 2, None, "c2")]
    rows = [(f"i{n:02d}", *kinds[n % 3], f"2026-03-{n + 1:02d}") for n in range(24)]
    listings = spark.createDataFrame(rows, "item_id string, district_name string, category int, price_bucket string, city_name string, day string").selectExpr("*", "cast(day as date) as posted_date")
    views = spark.createDataFrame([(f"u{u}", f"i{(u * 7 + n * n) % 24:02d}") for u in range(12) for n in range(5)], "user_id string, item_id string")
    users, lists, by = c.intent_lists(views, listings, None, 5)
    assert lists.select(*by).distinct().count() == users.select(*by).distinct().count() < users.count() == 12
    got = [(r["user_id"], x["item_id"], n + 1) for r in cs.shared_lists(users, lists, by, 5).collect() for n, x in enumerate(r["items"])]
    assert sorted(got) == tuples(c.intent(views, listings, None, 5).select("user_id", "item_id", "rank"))


def test_sellers_offer_no_more_than_can_be_left(spark):
    """Users hold the first items of a seller, also beyond the latest contacts: k others come all the same, with doubled listings."""
    listings = spark.createDataFrame([(f"i{n:02d}", f"s{n // 20}") for n in range(60)] + [("i07", "s0"), ("i07", "s1")], "item_id string, seller_id string")
    pairs = spark.createDataFrame([("u", f"i{n:02d}", 1) for n in (*range(6), 21, 22)] + [("v", "i40", 1)], "user_id string, item_id string, count int").withColumn("last_date", F.lit("2026-04-01").cast("date"))
    got = c.seller_expansion(pairs, listings, None, 4, sellers=7, items_per_seller=20).select("user_id", "rank", "item_id")
    assert tuples(got) == [("u", 1, "i06"), ("u", 2, "i07"), ("u", 3, "i08"), ("u", 4, "i09"), *[("v", n, f"i{40 + n}") for n in range(1, 5)]]


def test_knn_cuts_neighbours_after_the_user_is_left_out(spark):
    """Of five users of an item, each reaches the first three others by date and id, whichever place it has itself."""
    pairs = spark.createDataFrame([(f"u{n}", i) for n in range(5) for i in ("x", f"o{n}")], "user_id string, item_id string").selectExpr("*", "date'2026-04-01' as last_date", "1 as count")
    got = {}
    for r in c.user_knn(pairs, None, 10, neighbour_cap=3).collect():
        got.setdefault(r["user_id"], set()).add((r["item_id"], r["score"]))
    assert got == {f"u{n}": {(f"o{m}", 1) for m in [m for m in range(5) if m != n][:3]} for n in range(5)}


def test_lists_meet_their_user_before_they_are_laid_out(spark):
    lists = spark.createDataFrame([("a", [("i1", "s"), ("i2", "s")]), ("b", [("i3", "s"), ("i1", "t")])], "user_id string, placed array<struct<item_id: string, source: string>>")
    users = spark.createDataFrame([("a", 1), ("b", 0)], "user_id string, user_pos bigint")
    found = cs.submission(lists, users)
    assert tuples(found) == tuples(cs.submission(cs.laid_out(lists), users)) == sorted([(3, "a", 1, "i1"), (4, "a", 2, "i2"), (1, "b", 1, "i3"), (2, "b", 2, "i1")], key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")

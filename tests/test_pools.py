"""Pools ranked by parts of the features, and the cascade for blocks of users, against the whole."""

import pytest
from pyspark.sql import functions as F

from marketloom.operators import candidates as c
from marketloom.operators import cascade as cs
from marketloom.operators import features, learned
from tests.support import tuples

NAMES = [*features.OF_USER, "item_total_contacts", "item_photos", "listing_age_days", *features.SNAPSHOT_COLUMNS, *features.OF_PAIR]


def tables(spark):
    """Ten users and thirty listings, some without seller, city, age or figures; one user without contacts."""
    listings = spark.createDataFrame([(f"i{n:02d}", f"s{n % 4}" if n % 7 else None, f"c{n % 3}" if n % 5 else None, n % 2, f"p{n % 2}", n % 9, "2026-03-01" if n % 6 else None) for n in range(30)], "item_id string, seller_id string, city_name string, category bigint, price_bucket string, images_count bigint, day string")
    nothing = {x: F.lit(None).cast(kind) for x, kind in (("ad_type", "string"), ("area_sqm", "double"), ("bedrooms", "bigint"), ("bathrooms", "bigint"), ("legal_status", "string"), ("project_id", "string"), ("seller_type", "string"), ("furnishing", "string"))}
    listings = listings.withColumns(nothing).withColumn("posted_date", F.col("day").cast("date"))
    contacts = spark.createDataFrame([(f"u{u}", f"i{(u * 5 + n * n) % 33:02d}", f"c{n % 2}", n % 2, 1 + n % 3, f"2026-03-{10 + n}") for u in range(9) for n in range(u + 1)], "user_id string, item_id string, city_name string, category bigint, count bigint, day string").withColumn("last_date", F.col("day").cast("date"))
    stats = spark.createDataFrame([(f"i{n:02d}", *[float(n % m) for m in (3, 4, 5, 6, 2)]) for n in range(0, 30, 2)], f"item_id string, {', '.join(f'{x} double' for x in features.SNAPSHOT_COLUMNS)}")
    items = contacts.groupBy("item_id").agg(F.sum("count").alias("item_total_contacts"))
    day = __import__("datetime").date(2026, 4, 2)
    return features.user_behavior(contacts, listings), items, features.item_quality(listings, day), stats, contacts, c.user_history(contacts), listings


def test_pools_ranked_by_parts_equal_rows_ranked_by_the_model(spark):
    known = tables(spark)
    pools = spark.createDataFrame([(f"u{u}", [f"i{(u + 3 * n) % 33:02d}" for n in range(11)]) for u in range(10)], "user_id string, items array<string>")
    weights = {n: ((i * 7) % 5 - 2) / (1000.0 if n.startswith("score") else 8.0) for i, n in enumerate(NAMES)}
    table = features.training_table(pools.select("user_id", F.explode("items").alias("item_id")), *known).fillna(0, NAMES)
    margin = learned.summed(F.lit(0.0), weights)
    whole = learned.best(table.withColumn("score", 1.0 - 1.0 / (1.0 + F.exp(margin))), ["user_id"], [F.col("score").desc(), F.col("item_id")], 4)
    got = learned.ranked_by_parts(weights, pools, *features.split_features(*known), 4)
    assert tuples(got) == tuples(whole.select("user_id", "item_id", "score", "rank")) and got.count() == 40
    with pytest.raises(AssertionError):
        learned.ranked_by_parts(dict(reversed(weights.items())), pools, *features.split_features(*known), 4)


def test_rows_that_are_compared_can_be_chosen_before_their_features(spark):
    rows = spark.createDataFrame([(f"u{u}", f"i{n:02d}", float(n * u % 8 == 5)) for u in range(4) for n in range(25)], "user_id string, item_id string, label double").withColumn("x", F.xxhash64("user_id", "item_id").cast("double"))
    chosen = learned.compared_rows(rows, 10)
    assert chosen.count() < learned.users_with_positives(rows).count()
    assert tuples(learned.pairwise_rows(chosen, ["x"])) == tuples(learned.pairwise_rows(learned.users_with_positives(rows), ["x"]))


def test_knn_of_some_users_is_that_of_all_users_where_those_asked_vote_too(spark):
    pairs = spark.createDataFrame([(f"u{u}", f"i{(u * n) % 7}") for u in range(8) for n in range(4)], "user_id string, item_id string").selectExpr("*", "date'2026-04-01' as last_date", "1 as count")
    asked = spark.createDataFrame([("u1",), ("u4",), ("none",)], "user_id string")
    every = c.user_knn(pairs, None, 3).filter("user_id in ('u1', 'u4')")
    assert tuples(c.user_knn(pairs, asked, 3, all_vote=True)) == tuples(every) != []


def test_fold_looks_items_up_by_hash(spark):
    """Placed items are not searched one after the other for every offer; a null is never placed."""
    rows = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("a", "y", 3)], "user_id string, item_id string, rank int")
    made = cs.fold_lists(rows.select("user_id"), [cs.Source("p", rows, cs.PLACED_FIRST), cs.Source("q", rows, cs.CUT_FIRST)], {"p": 1, "q": 3}, 5)
    assert [x["item_id"] for x in made.first()["placed"]] == ["x", "y"]
    assert "array_contains" not in made._jdf.queryExecution().optimizedPlan().toString()

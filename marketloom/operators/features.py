"""Features of users, items and pairs for the rankers; one implementation serves training and use."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.ranking import best, modes
from marketloom.operators.relational import row_index

KEY = ["user_id", "item_id"]

#: Patterns that features depend on. Fixed values.
LAND_TITLES, FINE_FURNISHING = "(?iu)sổ hồng|sổ đỏ", "(?iu)cao cấp"


def user_behavior(contacts: DataFrame, listings: DataFrame) -> DataFrame:
    """event_count, contact_rate (the mean count, which may exceed 1) and most frequent city, category, price and kind."""
    known = contacts.filter("user_id is not null").join(listings.select("item_id", "price_bucket", "ad_type"), "item_id", "left")
    return known.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        (F.sum("count") / F.count(F.lit(1))).alias("contact_rate"),
        *[F.mode(c, deterministic=True).alias(out) for out, c in (("pref_city", "city_name"), ("pref_cat", "category"), ("pref_price", "price_bucket"), ("pref_ad_type", "ad_type"))],
    )


def rank_share(df: DataFrame, column: str, tie: str, out: str) -> DataFrame:
    """1 - place / rows in descending order, so the largest value gives 1.

    Rows are numbered inside ranges of the order, nulls behind all values, so no
    task orders the whole table, however many rows share a value.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    ordered = df.withColumns({"_none": F.col(column).isNull(), "_falling": -F.col(column)})
    placed = row_index(ordered, ["_none", "_falling", tie], "_place")
    return placed.withColumn(out, 1 - F.col("_place") / total).drop("_none", "_falling", "_place")


def item_stats(contacts: DataFrame, views: DataFrame, recent_after: date) -> DataFrame:
    """Contacts, views, recent contacts, their share, and the place by contacts."""
    recent = F.col("last_date") > F.lit(recent_after.isoformat()).cast("date")
    c = contacts.groupBy("item_id").agg(F.sum("count").alias("item_total_contacts"), F.coalesce(F.sum(F.when(recent, F.col("count"))), F.lit(0)).alias("item_recent_contacts"))
    v = views.groupBy("item_id").agg(F.sum("view_count").alias("item_total_views"))
    both = c.join(v, "item_id", "full").filter("item_id is not null").fillna(0, ["item_total_contacts", "item_recent_contacts", "item_total_views"])
    both = both.withColumn("item_recency", F.col("item_recent_contacts") / (F.col("item_total_contacts") + 1e-6))
    return rank_share(both, "item_total_contacts", "item_id", "item_novelty")


def item_quality(listings: DataFrame, at: date | None = None) -> DataFrame:
    """Photos, completeness and flags of a listing, with its age where a day is given."""
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    photos = F.coalesce("images_count", F.lit(0))
    complete = (photos > 5).cast("int") + F.col("area_sqm").isNotNull().cast("int") + F.col("bedrooms").isNotNull().cast("int") + F.col("bathrooms").isNotNull().cast("int")
    out = listings.select(
        "item_id",
        F.coalesce("city_name", F.lit("Unknown")).alias("item_city"),
        F.col("category").alias("item_cat"),
        photos.cast("double").alias("item_photos"),
        complete.cast("double").alias("item_completeness"),
        yes(F.col("legal_status").rlike(LAND_TITLES)).alias("item_has_so_hong"),
        F.col("project_id").isNotNull().cast("double").alias("item_is_apartment"),
        yes(F.lower("seller_type") == "agent").alias("item_is_agent"),
        yes(F.col("furnishing").rlike(FINE_FURNISHING)).alias("item_has_noi_that_cao_cap"),
        F.col("price_bucket").alias("item_price"),
        F.col("ad_type").alias("item_ad_type"),
        "posted_date",
    )
    if at is not None:
        out = out.withColumn("listing_age_days", F.greatest(F.datediff(F.lit(at.isoformat()).cast("date"), "posted_date"), F.lit(0)).cast("double"))
        out = out.withColumn("listing_age_days", F.when(F.col("posted_date").isNotNull(), F.col("listing_age_days")))
    return out.drop("posted_date")


SNAPSHOT_COLUMNS = ["item_avg_views_7d", "item_avg_contacts_7d", "item_conversion_rate", "item_trend_score", "item_is_active"]


def with_snapshot(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Snapshot figures of the item, 0 where there are none."""
    return pairs.join(stats.select("item_id", *SNAPSHOT_COLUMNS), "item_id", "left").fillna(0.0, SNAPSHOT_COLUMNS)


MATCHES = {"match_city": ("item_city", "pref_city"), "match_cat": ("item_cat", "pref_cat"), "match_price": ("item_price", "pref_price"), "match_ad_type": ("item_ad_type", "pref_ad_type")}


def with_matches(pairs: DataFrame) -> DataFrame:
    """1 where item and preference agree, 0 where not or unknown; only for columns that exist."""
    have = {out: cols for out, cols in MATCHES.items() if set(cols) <= set(pairs.columns)}
    return pairs.withColumns({out: F.coalesce((F.col(a).cast("string") == F.col(b).cast("string")).cast("int"), F.lit(0)) for out, (a, b) in have.items()})


def with_recent_history(pairs: DataFrame, history: DataFrame) -> DataFrame:
    """score_prev: 200, 190, ... 160 for the user's five latest contacts, the best where an item is among them twice."""
    scores = history.filter("rank <= 5").groupBy(*KEY).agg(F.max(200.0 - 10.0 * (F.col("rank") - 1)).alias("score_prev"))
    return pairs.join(scores, KEY, "left").fillna(0.0, ["score_prev"])


def with_seller_affinity(pairs: DataFrame, contacts: DataFrame, listings: DataFrame) -> DataFrame:
    """score_seller: 30 for an item of a contacted seller in the preferred city, 4.5 elsewhere, 15 without preferences."""
    owner = listings.filter("seller_id is not null").select("item_id", "seller_id", F.col("city_name").alias("_city"))
    met = contacts.filter("user_id is not null").select(*KEY).join(owner.select("item_id", "seller_id"), "item_id").select("user_id", "seller_id").distinct()
    cols = [*KEY, "pref_city"] if "pref_city" in pairs.columns else KEY
    hits = pairs.select(*cols).distinct().join(owner, "item_id").join(met, ["user_id", "seller_id"], "left_semi")
    score = F.when(F.col("_city") == F.col("pref_city"), 30.0).otherwise(4.5) if "pref_city" in pairs.columns else F.lit(15.0)
    best_hit = hits.groupBy(*KEY).agg(F.max(score).alias("score_seller"))
    return pairs.drop("score_seller").join(best_hit, KEY, "left").fillna(0.0, ["score_seller"])


def collaborative_score(ranked: DataFrame, same_city: str) -> DataFrame:
    """score_als of ranks from 0: falling steeply to the 30th place, then slowly, three times as much in the user's city."""
    boost = F.when(F.col(same_city), 3.0).otherwise(1.0)
    r = F.col("rank") - 1
    return ranked.withColumn("score_als", F.when(r < 30, (50.0 - r) * boost).otherwise(F.greatest(F.lit(0.1), 20.0 - (r - 30) * 0.1) * boost))


def segment_scores(prefs: DataFrame, segments: DataFrame) -> DataFrame:
    """(user_id, item_id, score_segpop): city and category lists by place, places counted on from one list to the next, and 1 for global items."""
    cc, city, world = (segments.filter((F.col("level") == level) & (F.col("rank") <= n)) for level, n in (("cc", 30), ("city", 20), ("global", 20)))
    sizes = cc.groupBy("city_name", "category").agg(F.count(F.lit(1)).alias("first"))
    a = prefs.join(cc, (F.col("pref_city") == F.col("city_name")) & (F.col("pref_cat") == F.col("category"))).select("user_id", "item_id", F.greatest(3.0 - 0.01 * (F.col("rank") - 1), F.lit(0.1)).alias("s"))
    offset = prefs.join(sizes, (F.col("pref_city") == F.col("city_name")) & (F.col("pref_cat") == F.col("category")), "left").select("user_id", "pref_city", F.coalesce("first", F.lit(0)).alias("first"))
    b = offset.join(city, F.col("pref_city") == F.col("city_name")).select("user_id", "item_id", F.greatest(2.0 - 0.01 * (F.col("first") + F.col("rank") - 1), F.lit(0.1)).alias("s"))
    # twenty rows stand on the right
    g = prefs.select("user_id").join(F.broadcast(world.select("item_id")), F.lit(True)).select("user_id", "item_id", F.lit(1.0).alias("s"))
    return a.unionByName(b).unionByName(g).groupBy(*KEY).agg(F.sum("s").alias("score_segpop"))


def training_table(pairs: DataFrame, users: DataFrame, items: DataFrame, quality: DataFrame, stats: DataFrame, contacts: DataFrame, history: DataFrame, listings: DataFrame) -> DataFrame:
    """All features of (user_id, item_id) pairs, nulls of numbers as 0."""
    out = pairs.join(users, "user_id", "left").join(items, "item_id", "left").join(quality, "item_id", "left")
    out = with_seller_affinity(with_recent_history(with_matches(with_snapshot(out, stats)), history), contacts, listings)
    numeric = [n for n, kind in out.dtypes if kind in ("int", "bigint", "double", "float")]
    return out.fillna(0, numeric)


#: Features of training_table() by what they depend on, and what those of pairs need of an item.
OF_USER = ["event_count", "contact_rate"]
OF_PAIR = [*MATCHES, "score_prev", "score_seller"]
PAIR_NEEDS = ["item_city", "item_cat", "item_price", "item_ad_type", "owners"]


def split_features(users: DataFrame, items: DataFrame, quality: DataFrame, stats: DataFrame, contacts: DataFrame, history: DataFrame, listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What training_table() joins to pairs as one row a user and one a listing; pair_features() makes the rest.

    Users have their latest contacts (prev) and contacted sellers as lists, items
    the sellers and cities of their listings (owners).
    """
    owner = listings.filter("seller_id is not null and item_id is not null").select("item_id", "seller_id", "city_name")
    scores = history.filter("rank <= 5 and item_id is not null").groupBy(*KEY).agg(F.max(200.0 - 10.0 * (F.col("rank") - 1)).alias("score_prev"))
    prev = scores.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("item_id", "score_prev"))).alias("prev"))
    met = contacts.filter("user_id is not null").select(*KEY).join(owner.select("item_id", "seller_id"), "item_id").groupBy("user_id").agg(F.collect_set("seller_id").alias("sellers"))
    of_users = users.join(prev, "user_id", "full").join(met, "user_id", "full").fillna(0, OF_USER)
    owners = owner.groupBy("item_id").agg(F.collect_set(F.struct("seller_id", "city_name")).alias("owners"))
    known = items.join(quality, "item_id", "full").join(stats.select("item_id", *SNAPSHOT_COLUMNS), "item_id", "full").filter("item_id is not null")
    return of_users, known.join(owners, "item_id", "left")


def pair_features(rows: DataFrame) -> DataFrame:
    """Matches, score_prev and score_seller of rows that hold PAIR_NEEDS and what split_features() has of their user."""
    hit = lambda o: F.when(F.array_contains("sellers", o["seller_id"]), F.when(o["city_name"] == F.col("pref_city"), 30.0).otherwise(4.5))
    prev, seller = F.try_element_at("prev", F.col("item_id")), F.array_max(F.transform("owners", hit))
    return with_matches(rows).withColumns({"score_prev": F.coalesce(prev, F.lit(0.0)), "score_seller": F.coalesce(seller, F.lit(0.0))})


def scored_union(parts: Sequence[tuple[DataFrame, str]], k: int = 300) -> DataFrame:
    """(user_id, item_id, score columns, total, rank): sources of scores side by side, the k best sums of a user."""
    names = [n for _, n in parts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.select(*KEY, n) for df, n in parts])
    sums = rows.groupBy(*KEY).agg(*[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    total = sum((F.col(n) for n in names), F.lit(0.0))
    return best(sums.withColumn("total", total), ["user_id"], [F.col("total").desc(), F.col("item_id")], k)


def context_tables(contacts: DataFrame, views: DataFrame, listings: DataFrame, segments: DataFrame, recent_after: date) -> dict[str, DataFrame]:
    """The named tables that feature code looks things up in."""
    history = best(contacts.filter("user_id is not null").groupBy(*KEY).agg(F.max("last_date").alias("last_date")), ["user_id"], [F.col("last_date").desc_nulls_last(), F.col("item_id")], 30)
    return {
        "user_prefs": modes(contacts.filter("user_id is not null"), "user_id", {"pref_city": "city_name", "pref_cat": "category"}),
        "user_history": history,
        "user_sellers": history.join(listings.filter("seller_id is not null").select("item_id", "seller_id"), "item_id").select("user_id", "seller_id").distinct(),
        "item_stats": item_stats(contacts, views, recent_after),
        "segments": segments.filter(F.col("rank") <= F.when(F.col("level") == "global", 500).otherwise(300)),
        "item_quality": item_quality(listings),
    }


"""Soft rules: each adds a score column; columns that a table lacks leave their factor out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.scalar import clip

#: Values that the quality rule rewards. Fixed values.
TRUSTED_LEGAL = ["Đã có sổ", "Sổ hồng riêng"]
FULL_FURNISHING = "Nội thất đầy đủ"
COMPLETE_FIELDS = ["area_sqm", "bedrooms", "bathrooms", "direction", "legal_status"]


def has(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def filled(columns: Sequence[str]) -> Column:
    """How many of the columns are not null."""
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def quality(items: DataFrame, trusted: Sequence[str] = TRUSTED_LEGAL, full: str = FULL_FURNISHING) -> DataFrame:
    """quality_score in 0.3..2 from photos, completeness, legal status, title and furnishing."""
    photos = F.col("images_count")
    score = F.when(photos.between(8, 12), 1.4).when(photos >= 5, 1.1).when(photos < 3, 0.6).otherwise(1.0)
    score = score * (0.7 + 0.3 * filled(COMPLETE_FIELDS) / float(len(COMPLETE_FIELDS)))
    score = score * F.when(F.col("legal_status").isin(list(trusted)), 1.3).otherwise(1.0)
    score = score * F.when(F.char_length("title") < 20, 0.85).otherwise(1.0)
    score = score * F.when((F.col("ad_type") == "let") & (F.col("furnishing") == full), 1.2).otherwise(1.0)
    return items.withColumn("quality_score", clip(score, 0.3, 2.0))


def match(items: DataFrame) -> DataFrame:
    """match_score in 0.2..2.5 from the user's categories, price range, city and bedrooms."""
    score = F.lit(1.0)
    if has(items, "category", "user_top_categories"):
        score = score * F.when(F.array_contains("user_top_categories", F.col("category")), 1.6).otherwise(0.4)
    if has(items, "item_price_pct", "user_price_min", "user_price_max"):
        p, low, high = F.col("item_price_pct"), F.col("user_price_min"), F.col("user_price_max")
        score = score * F.when(p.between(low, high), 1.4).when(F.abs(p - (low + high) / 2) < 0.2, 1.1).otherwise(0.7)
    if has(items, "city_name", "user_top_city"):
        score = score * F.when(F.col("city_name") == F.col("user_top_city"), 1.3).otherwise(1.0)
    if has(items, "bedrooms", "user_modal_bedrooms"):
        score = score * F.when(F.col("bedrooms") == F.col("user_modal_bedrooms"), 1.5).otherwise(1.0)
    return items.withColumn("match_score", clip(score, 0.2, 2.5))


def urgency(items: DataFrame) -> DataFrame:
    """urgency_score in 0..2 from age, change of views and a price drop; an unknown age or count gives null."""
    score = F.exp(F.col("listing_age_days") * -0.03) if has(items, "listing_age_days") else F.lit(0.5)
    if has(items, "recent_3d_views", "older_3d_views"):
        change = (F.col("recent_3d_views") - F.col("older_3d_views")) / (F.col("older_3d_views") + 1.0)
        score = score * (1.0 + clip(change, -0.5, 1.0))
    if has(items, "has_price_drop"):
        score = score * F.when(F.col("has_price_drop"), 1.5).otherwise(1.0)
    return items.withColumn("urgency_score", clip(score, 0.0, 2.0))


def value(items: DataFrame) -> DataFrame:
    """value_score in 0.5..1.8: the market's average price over the item's."""
    if not has(items, "price", "market_avg_price"):
        return items.withColumn("value_score", F.lit(1.0))
    ratio = F.col("price") / (F.col("market_avg_price") + 1e-10)
    return items.withColumn("value_score", clip(F.try_divide(F.lit(1.0), ratio), 0.5, 1.8))


def district_similarity(events: DataFrame, listings: DataFrame) -> DataFrame:
    """(district_a, district_b, jaccard_similarity): shared tracker sessions over all sessions of the two, each with itself included.

    A session meets itself only over its distinct districts.
    """
    places = listings.filter("district_name is not null").select("item_id", "district_name")
    seen = events.filter("session_id is not null").join(places, "item_id").select("session_id", "district_name").distinct()
    lists = seen.groupBy("session_id").agg(F.collect_set("district_name").alias("d"))
    pairs = lists.select(F.explode("d").alias("district_a"), "d").select("district_a", F.explode("d").alias("district_b"))
    counts = pairs.groupBy("district_a", "district_b").agg(F.count(F.lit(1)).alias("n"))
    own = counts.filter("district_a = district_b")
    a, b = own.select("district_a", F.col("n").alias("na")), own.select("district_b", F.col("n").alias("nb"))
    return counts.join(a, "district_a").join(b, "district_b").select("district_a", "district_b", (F.col("n") / (F.col("na") + F.col("nb") - F.col("n"))).alias("jaccard_similarity"))


def geo(items: DataFrame, similarity: DataFrame, keys: Sequence[str]) -> DataFrame:
    """geo_score: similarity of the item's district to the user's viewed districts, by weight.

    items has district_name and user_viewed_districts, an array of structs
    (district, weight), and keys that name a row. Unknown pairs count 0.05; rows
    without a history score 0.5.
    """
    each = items.select(*keys, "district_name", F.explode("user_viewed_districts").alias("h")).select(*keys, "district_name", "h.district", "h.weight").filter("district is not null")
    met = each.join(similarity, (F.col("district_name") == F.col("district_a")) & (F.col("district") == F.col("district_b")), "left")
    sim = F.coalesce("jaccard_similarity", F.lit(0.05))
    scores = met.groupBy(*keys).agg(F.try_divide(F.sum(sim * F.col("weight")), F.sum("weight")).alias("geo_score"))
    return items.join(scores, list(keys), "left").withColumn("geo_score", F.coalesce("geo_score", F.lit(0.5)))

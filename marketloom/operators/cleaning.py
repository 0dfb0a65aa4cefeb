"""Filters that clean facts and the pre-aggregated pair tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.constants import EVENT_WEIGHTS, HALF_LIFE_DAYS, POSITIVE_EVENTS, REAL_CONTACTS, SESSION_ITEMS
from marketloom.functions.ranking import modes
from marketloom.functions.scalar import micros
from marketloom.operators import frequency
from marketloom.operators.relational import row_index

LOGGED_IN = "is_login = 'login'"


def contact_pairs(events: DataFrame) -> DataFrame:
    """Positive events of logged-in users by user, item, city and category."""
    return (
        events.filter(LOGGED_IN).filter(F.col("event_type").isin(POSITIVE_EVENTS)).groupBy("user_id", "item_id", "city_name", "category").agg(F.count(F.lit(1)).alias("count"), F.max("date").alias("last_date"))
    )


def contact_scores(events: DataFrame) -> DataFrame:
    return events.filter(LOGGED_IN).filter("is_contact = 1").groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("score"))


def weighted_contact_scores(events: DataFrame) -> DataFrame:
    """Direct contacts weigh 3, other contacts 1."""
    weight = F.when(F.col("event_type").isin(REAL_CONTACTS), 3.0).otherwise(1.0)
    return events.filter(LOGGED_IN).filter("is_contact = 1").groupBy("user_id", "item_id").agg(F.sum(weight).alias("score"))


def pageview_pairs(events: DataFrame) -> DataFrame:
    return events.filter(LOGGED_IN).filter("event_type = 'pageview'").groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("view_count"), F.avg("dwell_time_sec").alias("avg_dwell"))


def date_range(events: DataFrame) -> DataFrame:
    return events.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def session_items(events: DataFrame, sizes: tuple[int, int] = SESSION_ITEMS) -> DataFrame:
    """(session_id, items, n_items): distinct items of tracker sessions of a plausible size, null item included as the reference data has it."""
    seen = events.filter(LOGGED_IN).filter("session_id is not null").select("session_id", "item_id").distinct()
    sized = seen.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_items")).filter(F.col("n_items").between(*sizes))
    # items are gathered only for sessions whose size is known to be small
    return seen.join(sized, "session_id").groupBy("session_id", "n_items").agg(F.sort_array(F.collect_list("item_id")).alias("items"))


def snapshot_stats(snapshots: DataFrame) -> DataFrame:
    """Seven-day averages of each item with a conversion and a trend ratio; the last day comes from the data."""
    last = snapshots.agg(F.max("date")).scalar()
    d7, d30 = F.date_sub(last, 7), F.date_sub(last, 30)
    recent, prior = F.col("date") >= d7, (F.col("date") >= d30) & (F.col("date") < d7)
    stats = snapshots.groupBy("item_id").agg(
        F.count_if(recent).alias("n_recent"),
        F.avg(F.when(recent, F.col("views_24h"))).alias("item_avg_views_7d"),
        F.avg(F.when(recent, F.col("contacts_24h"))).alias("item_avg_contacts_7d"),
        F.avg(F.when(prior, F.col("views_24h"))).alias("prior_views"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return stats.filter("n_recent > 0").select(
        "item_id",
        "item_avg_views_7d",
        "item_avg_contacts_7d",
        (zero("item_avg_contacts_7d") / (zero("item_avg_views_7d") + 1)).alias("item_conversion_rate"),
        (zero("item_avg_views_7d") / (zero("prior_views") + 1)).alias("item_trend_score"),
        F.lit(1.0).alias("item_is_active"),
    )


def either_preference(prefs: DataFrame) -> DataFrame:
    return prefs.filter("pref_city is not null or pref_cat is not null")


def cold_user_prefs(events: DataFrame) -> DataFrame:
    """City and category that users without contacts look at most; a null user is no user."""
    logged = events.filter(LOGGED_IN).filter("user_id is not null")
    warm = logged.filter(F.col("event_type").isin(POSITIVE_EVENTS)).select("user_id").distinct()
    cold = logged.filter("event_type = 'pageview'").join(warm, "user_id", "left_anti")
    return either_preference(modes(cold, "user_id", {"pref_city": "city_name", "pref_cat": "category"}))


def cold_user_prefs_by_listing(views: DataFrame, warm: DataFrame, listings: DataFrame) -> DataFrame:
    """The same from the viewed listings' own city and category, each viewed pair once."""
    cold = views.select("user_id", "item_id").filter("user_id is not null").join(warm.select("user_id").distinct(), "user_id", "left_anti")
    return either_preference(modes(cold.join(listings.select("item_id", "city_name", "category"), "item_id", "left"), "user_id", {"pref_city": "city_name", "pref_cat": "category"}))


def lead_pairs(pci: DataFrame, least: int = 1, purchased_weight: float = 3.0) -> DataFrame:
    weight = F.when(F.col("purchased"), F.col("lead_count") * purchased_weight).otherwise(F.col("lead_count").cast("double"))
    return pci.filter(F.col("lead_count") >= least).select("user_id", "item_id", "lead_count", "purchased", "category", weight.alias("weight"))


def lead_supplement(pci: DataFrame, existing: DataFrame, mode: str = "existing_only", users: DataFrame | None = None) -> DataFrame:
    """Lead pairs that existing pairs lack; existing_only and test_only keep the users given, all keeps everyone."""
    new = lead_pairs(pci).join(existing.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_anti")
    if mode == "existing_only":
        users = existing if users is None else users
    if mode in ("existing_only", "test_only") and users is not None:
        new = new.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return new.select("user_id", "item_id", "weight")


def blind_user_prefs(pci: DataFrame, users: DataFrame, listings: DataFrame) -> DataFrame:
    seen = pci.join(users.select("user_id").distinct(), "user_id", "left_semi").select("user_id", "item_id", "category").join(listings.select("item_id", "city_name").distinct(), "item_id", "left")
    return either_preference(modes(seen, "user_id", {"pref_city": "city_name", "pref_cat": "category"}))


def merge_scores(*parts: DataFrame) -> DataFrame:
    """Union of (user_id, item_id, score) tables, scores of a pair summed."""
    every = reduce(DataFrame.unionByName, [p.select("user_id", "item_id", F.col("score").cast("double").alias("score")) for p in parts])
    return every.groupBy("user_id", "item_id").agg(F.sum("score").alias("score"))


def enrich_scores(scores: DataFrame, pci: DataFrame) -> DataFrame:
    """Contact scores plus lead pairs that are new; only users already known."""
    return merge_scores(scores, lead_supplement(pci, scores).withColumnRenamed("weight", "score"))


def enrich_weighted_scores(scores: DataFrame, pci: DataFrame) -> DataFrame:
    """Weighted scores plus all lead pairs of known users, pairs that both hold included."""
    leads = lead_pairs(pci).join(scores.select("user_id").distinct(), "user_id", "left_semi").select("user_id", "item_id", F.col("weight").alias("score"))
    return merge_scores(scores, leads)


def fill_missing_users(prefs: DataFrame, more: DataFrame) -> DataFrame:
    """prefs, and rows of more for users that prefs lacks."""
    cols = ["user_id", "pref_city", "pref_cat"]
    return prefs.select(*cols).unionByName(more.select(*cols).filter("user_id is not null").join(prefs.select("user_id"), "user_id", "left_anti"))


def not_after(df: DataFrame, cutoff: date) -> DataFrame:
    """Rows dated up to the cutoff; tables without a date pass."""
    return df.filter(F.col("date").cast("string") <= cutoff.isoformat()) if "date" in df.columns else df


def without_bots(events: DataFrame, most: int = 4, dwell: str = "dwell_time_sec") -> DataFrame:
    """Events of users whose bot score stays below most; a user without any dwell time has no score and drops out."""
    seconds = F.floor((F.max(micros(F.col("event_ts"))) - F.min(micros(F.col("event_ts")))) / 1e6)
    stats = events.filter("user_id is not null").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), (seconds / 60.0).alias("minutes"), F.avg(dwell).alias("dwell"), F.coalesce(F.count_if(F.hour("event_ts").between(2, 5)), F.lit(0)).alias("night"))
    points = (F.col("n") / (F.col("minutes") + 1.0) > 5.0).cast("int") * 3 + (F.col("dwell") < 1.0).cast("int") * 2 + (F.col("night") / (F.col("n") + 1.0) > 0.8).cast("int")
    return events.join(stats.filter(points < most).select("user_id"), "user_id", "left_semi")


def without_bounces(events: DataFrame, least_ms: int = 3000) -> DataFrame:
    return events.filter((F.col("dwell_time_sec") >= least_ms) | F.col("event_type").isin([*POSITIVE_EVENTS, "lead"]) | F.col("dwell_time_sec").isNull())


def without_outliers(items: DataFrame, value: str, groups: list[str], most: float = 3.5) -> DataFrame:
    """Rows within a robust z-score of their group; null values and null groups of none drop out.

    Medians come from rows weighted by group and value and a sort inside one bin
    of values, so a large group is never gathered in one place.
    """
    key = F.struct(*[F.col(g) for g in groups])
    known = items.filter(F.col(value).isNotNull()).withColumn("_key", key)

    def with_median(df: DataFrame, column: str, out: str) -> DataFrame:
        found = frequency.medians(frequency.compress(df, "_key", column)).select(F.col("key").alias("_of"), F.col("median").alias(out))
        return df.join(found, F.col("_key").eqNullSafe(F.col("_of"))).drop("_of")

    off = with_median(known, value, "_median").withColumn("_off", F.abs(F.col(value) - F.col("_median")))
    z = 0.6745 * F.col("_off") / (F.col("_mad") + 1e-6)
    return with_median(off, "_off", "_mad").filter(z <= most).drop("_key", "_median", "_off", "_mad")


def without_zombies(rows: DataFrame, age: int = 60, views: int = 5) -> DataFrame:
    """Old listings that nobody looks at go; unknown figures never count as alive."""
    if {"listing_age_days", "views_24h", "contacts_24h"} <= set(rows.columns):
        rows = rows.filter(~((F.col("listing_age_days") > age) & (F.col("views_24h") < views) & (F.col("contacts_24h") == 0)))
    return rows.filter("images_count >= 1") if "images_count" in rows.columns else rows


def clean_events(events: DataFrame, cutoff: date) -> DataFrame:
    """The event rules in order of priority."""
    return events.transform(not_after, cutoff).transform(without_bots).transform(without_bounces)


def time_split(df: DataFrame, column: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the last days, and the rest. A missing column or an empty table is an error."""
    if column not in df.columns:
        raise ValueError(f"column {column} is missing")
    if df.isEmpty():
        raise ValueError("an empty table cannot be split")
    edge = F.date_sub(df.agg(F.max(column)).scalar(), days)
    return df.filter(F.col(column) < edge), df.filter(F.col(column) >= edge)


def decayed_scores(events: DataFrame, now: date, half_life: float = HALF_LIFE_DAYS) -> DataFrame:
    """Sum over events of the type's weight, halved every half_life days; an unknown time gives a null weight, which adds nothing."""
    ts = next((c for c in ("timestamp", "event_ts", "date", "last_date") if c in events.columns), None)
    base = F.lit(1.0)
    if "event_type" in events.columns:
        base = F.coalesce(F.create_map(*[F.lit(x) for kv in EVENT_WEIGHTS.items() for x in kv])[F.col("event_type")], F.lit(1.0))
    if ts:
        millis = F.floor((F.unix_micros(F.lit(now).cast("timestamp")) - micros(F.col(ts).cast("timestamp_ntz"))) / 1000)
        weight = base * F.pow(F.lit(0.5), F.greatest(millis / 86_400_000.0, F.lit(0.0)) / half_life)
        weight = F.when(F.col(ts).isNotNull(), weight)
    else:
        weight = F.col("score") if "score" in events.columns else base
    return events.groupBy("user_id", "item_id").agg(F.coalesce(F.sum(weight), F.lit(0.0)).alias("interaction_score"))


def blended_scores(contacts: DataFrame, views: DataFrame, contact_weight: float = 3.0, view_range: tuple[float, float] = (1.0, 5.0)) -> DataFrame:
    """Contacts by weight plus view counts clipped into a range."""
    clipped = F.least(F.greatest(F.col("view_count").cast("double"), F.lit(view_range[0])), F.lit(view_range[1]))
    return merge_scores(contacts.withColumn("score", F.col("score") * contact_weight), views.select("user_id", "item_id", clipped.alias("score")))


def user_segments(users: DataFrame, warm: DataFrame, signal: DataFrame) -> DataFrame:
    """(user_id, segment): warm with contacts, cold with another signal, else blind."""
    w, s = warm.select("user_id").distinct().withColumn("w", F.lit(True)), signal.select("user_id").distinct().withColumn("s", F.lit(True))
    known = users.select("user_id").filter("user_id is not null").distinct().join(w, "user_id", "left").join(s, "user_id", "left")
    return known.select("user_id", F.when(F.col("w"), "warm").when(F.col("s"), "cold").otherwise("blind").alias("segment"))


def user_prefs(contacts: DataFrame, cold: DataFrame) -> DataFrame:
    """Preferences from contacts, filled in by cold preferences for users without."""
    warm = either_preference(modes(contacts.filter("user_id is not null"), "user_id", {"pref_city": "city_name", "pref_cat": "category"}))
    return fill_missing_users(warm, cold)


def index_pairs(scores: DataFrame) -> DataFrame:
    """Scores with dense user and item numbers from 0 in order of id.

    Ids are numbered inside ranges of about equal size, each range continuing
    the count of those before, so no task sees all ids, whatever they begin with.
    """

    def numbered(column: str, out: str) -> DataFrame:
        return row_index(scores.select(column).filter(F.col(column).isNotNull()).distinct(), [column], out)

    return scores.join(numbered("user_id", "user_idx"), "user_id").join(numbered("item_id", "item_idx"), "item_id")

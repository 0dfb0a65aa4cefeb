"""Queries that show single relational operators over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.ranking import best, min_max, top
from marketloom.functions.scalar import micros, stable_bucket
from marketloom.operators import relational as rel
from marketloom.plans.cleaning import GT
from marketloom.plans.registry import Registry
from marketloom.sources import formats
from marketloom.sources.tables import Tables
from marketloom.streaming import events as stream

REGISTRY = Registry()
query = REGISTRY.query


def rows() -> Column:
    return F.count(F.lit(1))


def on(d: str):
    return F.lit(d).cast("date")


@query("scan_equal_and_in", "SELECT event_id, event_type, device FROM fact_user_events WHERE is_login = 'login' AND event_type IN ('view_phone', 'contact_chat')")
def scan_equal_and_in(t: Tables) -> DataFrame:
    return rel.where_equal(t.events, {"is_login": "login", "event_type": ["view_phone", "contact_chat"]}).select("event_id", "event_type", "device")


@query("scan_date_range", "SELECT event_id, date FROM fact_user_events WHERE date BETWEEN DATE '2026-01-01' AND DATE '2026-01-31'")
def scan_date_range(t: Tables) -> DataFrame:
    return t.events.filter(F.col("date").between(on("2026-01-01"), on("2026-01-31"))).select("event_id", "date")


@query("scan_complete_events", "SELECT event_id, user_id, item_id FROM fact_user_events WHERE user_id IS NOT NULL AND item_id IS NOT NULL")
def scan_complete_events(t: Tables) -> DataFrame:
    return t.events.dropna(subset=["user_id", "item_id"]).select("event_id", "user_id", "item_id")


@query("scan_table_info", "SELECT count(*) AS n_rows, 8::INTEGER AS n_columns, 1::INTEGER AS n_files FROM documents")
def scan_table_info(t: Tables) -> DataFrame:
    return formats.table_info(t.documents)


@query("scan_first_rows", "SELECT item_id, title FROM dim_listing ORDER BY item_id LIMIT 100")
def scan_first_rows(t: Tables) -> DataFrame:
    return t.listings.orderBy("item_id").limit(100).select("item_id", "title")


@query("scan_json_property", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def scan_json_property(t: Tables) -> DataFrame:
    return t["events"].select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("proj_computed", "SELECT item_id, round(area_sqm / nullif(width_m, 0), 6) AS depth, coalesce(bedrooms, 0) + coalesce(bathrooms, 0) AS rooms, upper(city_name) AS city FROM dim_listing")
def proj_computed(t: Tables) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0))
    return t.listings.select("item_id", F.round(F.try_divide("area_sqm", "width_m"), 6).alias("depth"), (zero("bedrooms") + zero("bathrooms")).alias("rooms"), F.upper("city_name").alias("city"))


@query("proj_conditions", "SELECT item_id FROM dim_listing WHERE (ad_type = 'sell' AND area_sqm > 100) OR NOT (seller_type = 'agent' OR images_count BETWEEN 2 AND 5)")
def proj_conditions(t: Tables) -> DataFrame:
    c = F.col
    return t.listings.filter(((c("ad_type") == "sell") & (c("area_sqm") > 100)) | ~((c("seller_type") == "agent") | c("images_count").between(2, 5))).select("item_id")


@query("proj_case_chain", "SELECT item_id, CASE WHEN area_sqm > 500 THEN 'large' WHEN area_sqm > 100 THEN 'medium' WHEN area_sqm IS NULL THEN 'unknown' ELSE 'small' END AS size FROM dim_listing")
def proj_case_chain(t: Tables) -> DataFrame:
    a = F.col("area_sqm")
    return t.listings.select("item_id", F.when(a > 500, "large").when(a > 100, "medium").when(a.isNull(), "unknown").otherwise("small").alias("size"))


@query("proj_distinct_subset", "SELECT DISTINCT user_id, city_name, category FROM contact_pairs")
def proj_distinct_subset(t: Tables) -> DataFrame:
    return t.contact_pairs.select("user_id", "city_name", "category").distinct()


@query("proj_row_index", "SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS row_index FROM dim_listing")
def proj_row_index(t: Tables) -> DataFrame:
    return rel.row_index(t.listings.select("item_id"), ["item_id"])


@query("proj_fill_numeric", "SELECT item_id, coalesce(bedrooms, 0) AS bedrooms, coalesce(area_sqm, 0) AS area_sqm, direction FROM dim_listing")
def proj_fill_numeric(t: Tables) -> DataFrame:
    return rel.fill_numeric(t.listings.select("item_id", "bedrooms", "area_sqm", "direction"))


@query("join_semi", "SELECT event_id FROM fact_user_events WHERE user_id IN (SELECT user_id FROM contact_pairs)")
def join_semi(t: Tables) -> DataFrame:
    return rel.semi(t.events, t.contact_pairs, ["user_id"]).select("event_id")


@query("join_anti", "SELECT event_id FROM fact_user_events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM contact_pairs WHERE user_id IS NOT NULL)")
def join_anti(t: Tables) -> DataFrame:
    return rel.anti(t.events, t.contact_pairs, ["user_id"]).select("event_id")


@query("join_anti_two_keys", "SELECT user_id, item_id, lead_count FROM fact_post_contact_interactions p WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM contact_pairs c WHERE c.user_id = p.user_id AND c.item_id = p.item_id)")
def join_anti_two_keys(t: Tables) -> DataFrame:
    return rel.anti(t.pci, t.contact_pairs, ["user_id", "item_id"]).select("user_id", "item_id", "lead_count")


@query("join_left_lookup", "SELECT p.user_id, p.item_id, l.district_name, l.seller_id FROM contact_pairs p LEFT JOIN dim_listing l USING (item_id)")
def join_left_lookup(t: Tables) -> DataFrame:
    return t.contact_pairs.join(t.listings.select("item_id", "district_name", "seller_id"), "item_id", "left").select("user_id", "item_id", "district_name", "seller_id")


@query("join_full_coalesced", "WITH a AS (SELECT item_id, sum(count)::BIGINT AS contacts FROM contact_pairs GROUP BY 1), b AS (SELECT item_id, sum(views_24h)::BIGINT AS views FROM fact_listing_snapshot GROUP BY 1) SELECT item_id, coalesce(contacts, 0) AS contacts, coalesce(views, 0) AS views FROM a FULL JOIN b USING (item_id)")
def join_full_coalesced(t: Tables) -> DataFrame:
    a = t.contact_pairs.groupBy("item_id").agg(F.sum("count").alias("contacts"))
    b = t.snapshots.groupBy("item_id").agg(F.sum("views_24h").alias("views"))
    return a.join(b, "item_id", "full").fillna(0, ["contacts", "views"])


@query("join_null_safe", "WITH k AS (SELECT DISTINCT category, city_name, furnishing FROM dim_listing) SELECT l.item_id, count(*) AS n FROM dim_listing l JOIN k ON l.category IS NOT DISTINCT FROM k.category AND l.city_name IS NOT DISTINCT FROM k.city_name AND l.furnishing IS NOT DISTINCT FROM k.furnishing GROUP BY 1")
def join_null_safe(t: Tables) -> DataFrame:
    k, a = t.listings.select("category", "city_name", "furnishing").distinct().alias("k"), t.listings.alias("a")
    same = F.col("a.category").eqNullSafe(F.col("k.category")) & F.col("a.city_name").eqNullSafe(F.col("k.city_name")) & F.col("a.furnishing").eqNullSafe(F.col("k.furnishing"))
    return a.join(k, same).groupBy("a.item_id").agg(rows().alias("n"))


@query("join_named_keys", "SELECT d.doc_id, l.city_name FROM documents d JOIN dim_listing l ON d.item_id = l.item_id AND d.seller_id = l.seller_id")
def join_named_keys(t: Tables) -> DataFrame:
    listings = t.listings.select(F.col("item_id").alias("listing"), F.col("seller_id").alias("owner"), "city_name")
    return t.documents.select("doc_id", "item_id", "seller_id").join(listings, (F.col("item_id") == F.col("listing")) & (F.col("seller_id") == F.col("owner"))).select("doc_id", "city_name")


@query("agg_conditional", f"SELECT city_name, count(*) AS n, count(*) FILTER (WHERE event_type IN {GT}) AS positives, round(avg(dwell_time_sec) FILTER (WHERE event_type = 'pageview'), 6) AS dwell FROM fact_user_events GROUP BY 1")
def agg_conditional(t: Tables) -> DataFrame:
    from marketloom.constants import POSITIVE_EVENTS

    view = F.col("event_type") == "pageview"
    return t.events.groupBy("city_name").agg(rows().alias("n"), F.count_if(F.col("event_type").isin(POSITIVE_EVENTS)).alias("positives"), F.round(F.avg(F.when(view, F.col("dwell_time_sec"))), 6).alias("dwell"))


@query("agg_grouping_sets", "SELECT city_name, category, grouping_id(city_name, category)::BIGINT AS level, sum(count)::BIGINT AS n FROM contact_pairs GROUP BY GROUPING SETS ((city_name, category), (city_name), (category), ())")
def agg_grouping_sets(t: Tables) -> DataFrame:
    return t.contact_pairs.cube("city_name", "category").agg(F.grouping_id("city_name", "category").cast("bigint").alias("level"), F.sum("count").alias("n"))


@query("agg_list_per_group", "SELECT user_id, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM contact_pairs WHERE user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY 1")
def agg_list_per_group(t: Tables) -> DataFrame:
    return t.contact_pairs.filter("user_id is not null").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("item_id")), ",").alias("items"))


@query("win_shift", "SELECT user_id, item_id, last_date, lag(item_id) OVER (PARTITION BY user_id ORDER BY last_date, item_id, city_name NULLS FIRST, category NULLS FIRST, count) AS previous FROM contact_pairs WHERE user_id IS NOT NULL AND last_date IS NOT NULL")
def win_shift(t: Tables) -> DataFrame:
    line = Window.partitionBy("user_id").orderBy("last_date", "item_id", F.col("city_name").asc_nulls_first(), F.col("category").asc_nulls_first(), "count")
    return t.contact_pairs.filter("user_id is not null and last_date is not null").select("user_id", "item_id", "last_date", F.lag("item_id").over(line).alias("previous"))


@query("win_first_per_group", "SELECT seller_id, item_id, posted_date FROM dim_listing WHERE seller_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY posted_date DESC NULLS LAST, item_id) <= 3")
def win_first_per_group(t: Tables) -> DataFrame:
    return best(t.listings.filter("seller_id is not null"), ["seller_id"], [F.col("posted_date").desc_nulls_last(), F.col("item_id")], 3).select("seller_id", "item_id", "posted_date")


@query("win_min_max", "SELECT item_id, category, round(CASE WHEN max(area_sqm) OVER w > min(area_sqm) OVER w THEN (area_sqm - min(area_sqm) OVER w) / (max(area_sqm) OVER w - min(area_sqm) OVER w) ELSE 1.0 END, 6) AS area_scaled FROM dim_listing WINDOW w AS (PARTITION BY category)")
def win_min_max(t: Tables) -> DataFrame:
    return t.listings.select("item_id", "category", F.round(min_max(t.listings, "area_sqm", ["category"], 1.0), 6).alias("area_scaled"))


@query("sort_mixed", "SELECT item_id, CAST(row_number() OVER (ORDER BY city_name ASC NULLS FIRST, area_sqm DESC NULLS LAST, item_id) AS INTEGER) AS rank FROM dim_listing ORDER BY rank LIMIT 200")
def sort_mixed(t: Tables) -> DataFrame:
    return top(t.listings.select("item_id", "city_name", "area_sqm"), [F.col("city_name").asc_nulls_first(), F.col("area_sqm").desc_nulls_last(), F.col("item_id")], 200).select("item_id", "rank")


ORDER = ["draft", "active", "expired", "hidden", "sold"]


@query("sort_by_meaning", "SELECT ad_status, count(*) AS n, CASE ad_status " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(ORDER)) + f" ELSE {len(ORDER)} END AS place FROM dim_listing GROUP BY 1")
def sort_by_meaning(t: Tables) -> DataFrame:
    return t.listings.groupBy("ad_status").agg(rows().alias("n")).withColumn("place", rel.ordinal(F.col("ad_status"), ORDER)).orderBy("place")


@query("sort_rotated", "WITH r AS (SELECT user_id, item_id, row_number() OVER w AS r, count(*) OVER (PARTITION BY user_id) AS n FROM (SELECT DISTINCT user_id, item_id FROM contact_pairs WHERE user_id IS NOT NULL) WINDOW w AS (PARTITION BY user_id ORDER BY item_id)) SELECT user_id, item_id, ((r - 1 - (CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 1000) % n) % n + n) % n + 1 AS rank FROM r")
def sort_rotated(t: Tables) -> DataFrame:
    pairs = t.contact_pairs.filter("user_id is not null").select("user_id", "item_id").distinct()
    r = best(pairs, ["user_id"], [F.col("item_id")]).withColumn("n", rows().over(Window.partitionBy("user_id")))
    return r.select("user_id", "item_id", rel.rotate(F.col("rank"), stable_bucket(F.col("user_id"), 1000) % F.col("n"), F.col("n")).alias("rank"))


@query("set_union_all_sum", "SELECT item_id, sum(n)::BIGINT AS n FROM (SELECT item_id, count AS n FROM contact_pairs UNION ALL SELECT item_id, lead_count FROM fact_post_contact_interactions) GROUP BY 1")
def set_union_all_sum(t: Tables) -> DataFrame:
    return t.contact_pairs.select("item_id", F.col("count").alias("n")).unionByName(t.pci.select("item_id", F.col("lead_count").alias("n"))).groupBy("item_id").agg(F.sum("n").alias("n"))


@query("set_union_relaxed", "SELECT user_id, item_id, count AS contacts, NULL::BIGINT AS leads FROM contact_pairs UNION ALL SELECT user_id, item_id, NULL, lead_count FROM fact_post_contact_interactions")
def set_union_relaxed(t: Tables) -> DataFrame:
    return rel.union_relaxed(t.contact_pairs.select("user_id", "item_id", F.col("count").alias("contacts")), t.pci.select("user_id", "item_id", F.col("lead_count").alias("leads")))


SETS = {"difference": "EXCEPT", "intersection": "INTERSECT", "union": "UNION"}


@query("set_operations", " UNION ALL ".join(f"SELECT '{k}' AS operation, count(*) AS n FROM (SELECT user_id FROM fact_user_events {v} SELECT user_id FROM contact_pairs)" for k, v in SETS.items()))
def set_operations(t: Tables) -> DataFrame:
    a, b = t.events.select("user_id"), t.contact_pairs.select("user_id")
    parts = {"difference": a.subtract(b), "intersection": a.intersect(b), "union": a.union(b).distinct()}
    counted = [df.agg(rows().alias("n")).select(F.lit(k).alias("operation"), "n") for k, df in parts.items()]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


@query(
    "fn_text_and_hash",
    "SELECT item_id, regexp_matches(title, 'nhà|đất', 'i') AS about_house, contains(title, 'm2') AS has_m2, lower(title) AS lowered, length(title)::INTEGER AS n_chars, (CAST('0x' || substr(md5(item_id), 1, 8) AS BIGINT) % 97)::INTEGER AS bucket FROM dim_listing",
)
def fn_text_and_hash(t: Tables) -> DataFrame:
    return t.listings.select("item_id", F.col("title").rlike("(?iu)nhà|đất").alias("about_house"), F.contains("title", F.lit("m2")).alias("has_m2"), F.lower("title").alias("lowered"), F.char_length("title").alias("n_chars"), stable_bucket(F.col("item_id"), 97).alias("bucket"))


@query(
    "fn_dates_and_math",
    "SELECT event_id, hour(event_ts)::INTEGER AS hour, isodow(event_ts)::INTEGER AS weekday, greatest(datediff('day', CAST(event_ts AS DATE), DATE '2026-04-09'), 0)::INTEGER AS age, round(exp(-0.03::DOUBLE * greatest(datediff('day', CAST(event_ts AS DATE), DATE '2026-04-09'), 0)), 6) AS decay, round(ln(1 + coalesce(dwell_time_sec, 0)), 6) AS log_dwell, epoch_us(event_ts) AS us FROM fact_user_events WHERE event_ts IS NOT NULL",
)
def fn_dates_and_math(t: Tables) -> DataFrame:
    known = t.events.filter("event_ts is not null")
    age = F.greatest(F.datediff(on("2026-04-09"), F.col("event_ts").cast("date")), F.lit(0))
    return known.select("event_id", F.hour("event_ts").alias("hour"), (F.weekday("event_ts") + 1).alias("weekday"), age.alias("age"), F.round(F.exp(-0.03 * age), 6).alias("decay"), F.round(F.log1p(F.coalesce("dwell_time_sec", F.lit(0))), 6).alias("log_dwell"), micros(F.col("event_ts")).alias("us"))


@query(
    "fn_arrays_and_structs",
    "WITH k AS (SELECT user_id, list(DISTINCT category) AS cats FROM contact_pairs WHERE user_id IS NOT NULL AND category IS NOT NULL GROUP BY 1) SELECT user_id, len(cats)::INTEGER AS n, list_contains(cats, 1020) AS has_1020, unnest(cats) AS category FROM k",
)
def fn_arrays_and_structs(t: Tables) -> DataFrame:
    k = t.contact_pairs.filter("user_id is not null and category is not null").groupBy("user_id").agg(F.collect_set(F.struct("category")).alias("cats"))
    ids = F.transform("cats", lambda s: s["category"])
    return k.select("user_id", F.size("cats").alias("n"), F.array_contains(ids, F.lit(1020)).alias("has_1020"), F.explode(ids).alias("category"))


STREAMED = "WITH e AS (SELECT DISTINCT event_id, event_type, event_ts FROM fact_user_events WHERE event_ts > TIMESTAMP '1970-01-01')"


@query("t_stream_daily_counts", f"{STREAMED} SELECT CAST(event_ts AS DATE) AS day, event_type, count(*) AS n FROM e GROUP BY 1, 2")
def t_stream_daily_counts(t: Tables) -> DataFrame:
    """Daily counts from a stream over the event files, each event once; the start of 1970, where watermarks start, is already late."""
    events = stream.read_events(t.spark, f"{t.sf_dir}/fact_user_events.parquet*")
    return stream.run_once(stream.daily_counts(stream.once(events, "20000 days")), "stream_daily_counts", "complete")

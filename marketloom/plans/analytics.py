"""Analytic queries over the marketplace tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.constants import CUTOFF, POSITIVE_EVENTS
from marketloom.functions.ranking import best, modes
from marketloom.operators import candidates as c
from marketloom.operators import frequency, profile
from marketloom.plans import candidates as cq
from marketloom.plans.cleaning import GT, mode_sql, rounded
from marketloom.plans.registry import Registry
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query


def rows() -> Column:
    return F.count(F.lit(1))


def r6(c: Column, name: str) -> Column:
    return F.round(c, 6).alias(name)


def is_positive() -> Column:
    return F.col("event_type").isin(POSITIVE_EVENTS)


def on(d: str) -> Column:
    return F.lit(d).cast("date")


NULLS = ["user_id", "item_id", "event_ts", "city_name", "query", "position", "dwell_time_sec", "event_type"]


@query("e1_null_counts", " UNION ALL ".join(f"SELECT '{x}' AS \"column\", count(*) FILTER (WHERE {x} IS NULL) AS nulls, round(avg(({x} IS NULL)::INT), 6) AS share FROM fact_user_events HAVING count(*) FILTER (WHERE {x} IS NULL) > 0" for x in NULLS))
def e1_null_counts(t: Tables) -> DataFrame:
    return rounded(profile.null_counts(t.events, NULLS), "share")


FEW = ["category", "seller_type", "ad_type", "ad_status", "bedrooms", "direction", "legal_status", "furnishing", "city_name", "district_name"]


@query("e1_cardinality", " UNION ALL ".join(f"SELECT '{x}' AS \"column\", count(DISTINCT {x}) AS n_distinct FROM dim_listing HAVING count(DISTINCT {x}) BETWEEN 1 AND 200" for x in FEW))
def e1_cardinality(t: Tables) -> DataFrame:
    return profile.cardinality(t.listings, columns=FEW)


@query("e1_value_counts", "SELECT event_type AS value, count(*) AS n FROM fact_user_events GROUP BY 1 ORDER BY n DESC, value NULLS LAST LIMIT 20")
def e1_value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.events, "event_type", 20)


DESCRIBED = ["area_sqm", "bedrooms", "floors", "images_count"]


@query("e1_describe", " UNION ALL ".join(f"SELECT '{x}' AS \"column\", count({x}) AS n, round(avg({x}), 6) AS mean, min({x})::DOUBLE AS min, max({x})::DOUBLE AS max FROM dim_listing" for x in DESCRIBED))
def e1_describe(t: Tables) -> DataFrame:
    return rounded(profile.describe(t.listings, DESCRIBED), "mean")


@query("e1_table_profile")
def e1_table_profile(t: Tables) -> DataFrame:
    return profile.table_profile(t.listings)


@query("e2_null_rate_by_category", "SELECT category, count(*) AS n, round(100.0 * avg((bedrooms IS NULL)::INT), 6) AS bedrooms_null, round(100.0 * avg((legal_status IS NULL)::INT), 6) AS legal_null, round(100.0 * avg((furnishing IS NULL)::INT), 6) AS furnishing_null FROM dim_listing GROUP BY 1")
def e2_null_rate_by_category(t: Tables) -> DataFrame:
    rate = lambda x, out: r6(100.0 * F.avg(F.col(x).isNull().cast("int")), out)
    return t.listings.groupBy("category").agg(rows().alias("n"), rate("bedrooms", "bedrooms_null"), rate("legal_status", "legal_null"), rate("furnishing", "furnishing_null"))


@query(
    "e3_user_overlap",
    "WITH p AS (SELECT DISTINCT user_id FROM fact_post_contact_interactions WHERE user_id IS NOT NULL) SELECT count(*) AS n_users, count(*) FILTER (WHERE user_id IN (SELECT user_id FROM fact_user_events WHERE user_id IS NOT NULL)) AS in_events, count(*) FILTER (WHERE user_id IN (SELECT user_id FROM contact_pairs WHERE user_id IS NOT NULL)) AS in_contacts FROM p",
)
def e3_user_overlap(t: Tables) -> DataFrame:
    flag = lambda df, name: df.select("user_id").filter("user_id is not null").distinct().withColumn(name, F.lit(1))
    users = t.pci.select("user_id").filter("user_id is not null").distinct()
    return users.join(flag(t.events, "e"), "user_id", "left").join(flag(t.contact_pairs, "c"), "user_id", "left").agg(rows().alias("n_users"), F.count("e").alias("in_events"), F.count("c").alias("in_contacts"))


@query(
    "e4_dwell_by_event_type",
    "SELECT event_type, count(dwell_time_sec) AS n, round(avg(dwell_time_sec) / 1000, 6) AS mean_s, round(median(dwell_time_sec) / 1000, 6) AS median_s, round(quantile_cont(dwell_time_sec, 0.25) / 1000, 6) AS p25_s, round(quantile_cont(dwell_time_sec, 0.75) / 1000, 6) AS p75_s FROM fact_user_events WHERE dwell_time_sec IS NOT NULL GROUP BY 1",
)
def e4_dwell_by_event_type(t: Tables) -> DataFrame:
    known = t.events.filter("dwell_time_sec is not null")
    p = lambda q, name: r6(F.percentile("dwell_time_sec", q) / 1000, name)
    return known.groupBy("event_type").agg(rows().alias("n"), r6(F.avg("dwell_time_sec") / 1000, "mean_s"), p(0.5, "median_s"), p(0.25, "p25_s"), p(0.75, "p75_s"))


@query("e5_event_contact_crosstab", "SELECT event_type, count(*) FILTER (WHERE is_contact = 0) AS contact_0, count(*) FILTER (WHERE is_contact = 1) AS contact_1 FROM fact_user_events GROUP BY 1")
def e5_event_contact_crosstab(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").pivot("is_contact", [0, 1]).agg(rows()).fillna(0).withColumnsRenamed({"0": "contact_0", "1": "contact_1"})


ORPHAN_TABLES = ["fact_user_events", "fact_post_contact_interactions", "fact_listing_snapshot", "contact_pairs"]


@query("e6_orphan_items", " UNION ALL ".join(f"SELECT '{x}' AS table_name, count(DISTINCT item_id) AS n_keys, count(DISTINCT item_id) FILTER (WHERE item_id NOT IN (SELECT item_id FROM dim_listing)) AS n_orphans FROM {x}" for x in ORPHAN_TABLES))
def e6_orphan_items(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile.orphans(t[x], t.listings, "item_id").withColumn("table_name", F.lit(x)) for x in ORPHAN_TABLES])


@query("e7_login_split", "SELECT is_login, count(*) AS n, count(DISTINCT user_id) AS n_users FROM fact_user_events GROUP BY 1")
def e7_login_split(t: Tables) -> DataFrame:
    pairs = frequency.compress(t.events, "is_login", "user_id")
    return frequency.key_totals(pairs).select(F.col("key").alias("is_login"), F.col("n_rows").alias("n"), F.col("n_distinct").alias("n_users"))


@query("e8_daily_volume", f"SELECT date, count(*) AS n, count(*) FILTER (WHERE event_type IN {GT}) AS positives, count(DISTINCT user_id) AS n_users FROM fact_user_events GROUP BY 1")
def e8_daily_volume(t: Tables) -> DataFrame:
    by_user = t.events.groupBy("date", "user_id").agg(rows().alias("n"), F.count_if(is_positive()).alias("positives"))
    return by_user.groupBy("date").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"), F.count("user_id").alias("n_users"))


@query("e9_user_activity", "WITH u AS (SELECT user_id, count(*) AS n FROM fact_user_events WHERE user_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n_users, quantile_cont(n, 0.5) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS most FROM u")
def e9_user_activity(t: Tables) -> DataFrame:
    n = t.events.filter("user_id is not null").groupBy("user_id").agg(rows().alias("n"))
    return n.agg(rows().alias("n_users"), *[r6(F.percentile("n", q), f"p{round(q * 100)}") for q in (0.5, 0.9, 0.99)], F.max("n").alias("most"))


@query("e9_item_popularity", "WITH u AS (SELECT item_id, count(*) AS n FROM fact_user_events WHERE item_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n_items, quantile_cont(n, 0.5) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS most FROM u")
def e9_item_popularity(t: Tables) -> DataFrame:
    n = t.events.filter("item_id is not null").groupBy("item_id").agg(rows().alias("n"))
    return n.agg(rows().alias("n_items"), *[r6(F.percentile("n", q), f"p{round(q * 100)}") for q in (0.5, 0.9, 0.99)], F.max("n").alias("most"))


@query("e10_tracker_sessions", f"SELECT session_id, count(*) AS n_events, count(DISTINCT item_id) AS n_items, round(avg(dwell_time_sec), 6) AS avg_dwell, count(*) FILTER (WHERE event_type IN {GT}) AS positives FROM fact_user_events WHERE session_id IS NOT NULL GROUP BY 1")
def e10_tracker_sessions(t: Tables) -> DataFrame:
    by_item = t.events.filter("session_id is not null").groupBy("session_id", "item_id").agg(rows().alias("n"), F.sum("dwell_time_sec").alias("d"), F.count("dwell_time_sec").alias("k"), F.count_if(is_positive()).alias("p"))
    return by_item.groupBy("session_id").agg(F.sum("n").alias("n_events"), F.count("item_id").alias("n_items"), r6(F.try_divide(F.sum("d"), F.sum("k")), "avg_dwell"), F.sum("p").alias("positives"))


@query("e11_contact_funnel_by_category", f"SELECT category, count(*) FILTER (WHERE event_type = 'pageview') AS views, count(*) FILTER (WHERE event_type IN {GT}) AS contacts, round(count(*) FILTER (WHERE event_type IN {GT}) / nullif(count(*) FILTER (WHERE event_type = 'pageview'), 0)::DOUBLE, 6) AS rate FROM fact_user_events GROUP BY 1")
def e11_contact_funnel_by_category(t: Tables) -> DataFrame:
    views, contacts = F.count_if(F.col("event_type") == "pageview"), F.count_if(is_positive())
    return t.events.groupBy("category").agg(views.alias("views"), contacts.alias("contacts"), r6(F.try_divide(contacts, views), "rate"))


@query("e12_positives_by_day_and_type", "SELECT date, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{x}') AS {x}" for x in POSITIVE_EVENTS) + f" FROM fact_user_events WHERE event_type IN {GT} GROUP BY 1")
def e12_positives_by_day_and_type(t: Tables) -> DataFrame:
    return t.events.filter(is_positive()).groupBy("date").pivot("event_type", POSITIVE_EVENTS).agg(rows()).fillna(0)


@query("e13_user_funnel", f"WITH u AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'pageview') AS v, count(*) FILTER (WHERE event_type IN {GT}) AS c FROM fact_user_events WHERE user_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n_users, count(*) FILTER (WHERE v > 0) AS viewers, count(*) FILTER (WHERE c > 0) AS contacters, count(*) FILTER (WHERE v > 0 AND c > 0) AS converted FROM u")
def e13_user_funnel(t: Tables) -> DataFrame:
    u = t.events.filter("user_id is not null").groupBy("user_id").agg(F.count_if(F.col("event_type") == "pageview").alias("v"), F.count_if(is_positive()).alias("c"))
    return u.agg(rows().alias("n_users"), F.count_if(F.col("v") > 0).alias("viewers"), F.count_if(F.col("c") > 0).alias("contacters"), F.count_if((F.col("v") > 0) & (F.col("c") > 0)).alias("converted"))


BUCKET = "CASE WHEN images_count IS NULL THEN 'unknown' WHEN images_count = 0 THEN '0' WHEN images_count <= 3 THEN '1-3' WHEN images_count <= 7 THEN '4-7' WHEN images_count <= 12 THEN '8-12' ELSE '13+' END"
LEADS = "leads AS (SELECT item_id, sum(coalesce(lead_count, 0))::BIGINT AS n FROM fact_post_contact_interactions GROUP BY 1)"


def lead_sums(t: Tables) -> DataFrame:
    return t.listings.join(t.pci.groupBy("item_id").agg(F.sum(F.coalesce("lead_count", F.lit(0))).alias("n")), "item_id", "left").fillna(0, ["n"])


@query("e14_leads_by_photos", f"WITH {LEADS} SELECT {BUCKET} AS photos, count(*) AS n_items, round(avg(coalesce(n, 0)), 6) AS leads FROM dim_listing LEFT JOIN leads USING (item_id) GROUP BY 1")
def e14_leads_by_photos(t: Tables) -> DataFrame:
    i = F.col("images_count")
    bucket = F.when(i.isNull(), "unknown").when(i == 0, "0").when(i <= 3, "1-3").when(i <= 7, "4-7").when(i <= 12, "8-12").otherwise("13+")
    return lead_sums(t).groupBy(bucket.alias("photos")).agg(rows().alias("n_items"), r6(F.avg("n"), "leads"))


@query("e14_leads_by_seller_and_kind", f"WITH {LEADS} SELECT seller_type, ad_type, count(*) AS n_items, round(avg(coalesce(n, 0)), 6) AS leads FROM dim_listing LEFT JOIN leads USING (item_id) GROUP BY 1, 2")
def e14_leads_by_seller_and_kind(t: Tables) -> DataFrame:
    return lead_sums(t).groupBy("seller_type", "ad_type").agg(rows().alias("n_items"), r6(F.avg("n"), "leads"))


FIELDS = ["area_sqm", "bedrooms", "bathrooms", "floors", "direction", "legal_status", "furnishing"]


@query("e14_leads_by_completeness", f"WITH {LEADS} SELECT {' + '.join(f'({x} IS NOT NULL)::INT' for x in FIELDS)} AS complete, count(*) AS n_items, round(avg(coalesce(n, 0)), 6) AS leads FROM dim_listing LEFT JOIN leads USING (item_id) GROUP BY 1")
def e14_leads_by_completeness(t: Tables) -> DataFrame:
    from marketloom.operators.rules import filled

    return lead_sums(t).groupBy(filled(FIELDS).alias("complete")).agg(rows().alias("n_items"), r6(F.avg("n"), "leads"))


@query("e15_performance_by_age", "SELECT CASE WHEN listing_age_days <= 7 THEN '0-7' WHEN listing_age_days <= 30 THEN '8-30' WHEN listing_age_days <= 90 THEN '31-90' ELSE '91+' END AS age, count(*) AS n, round(avg(views_24h), 6) AS views, round(avg(contacts_24h), 6) AS contacts FROM fact_listing_snapshot WHERE listing_age_days IS NOT NULL GROUP BY 1")
def e15_performance_by_age(t: Tables) -> DataFrame:
    a = F.col("listing_age_days")
    age = F.when(a <= 7, "0-7").when(a <= 30, "8-30").when(a <= 90, "31-90").otherwise("91+")
    return t.snapshots.filter(a.isNotNull()).groupBy(age.alias("age")).agg(rows().alias("n"), r6(F.avg("views_24h"), "views"), r6(F.avg("contacts_24h"), "contacts"))


@query(
    "e16_bot_score_histogram",
    f"""WITH u AS (SELECT user_id, count(*) AS n, count(DISTINCT session_id) AS s, avg(dwell_time_sec) / 1000.0 AS d, count(DISTINCT device) AS dv, count(*) FILTER (WHERE event_type IN {GT}) AS c FROM fact_user_events WHERE user_id IS NOT NULL GROUP BY 1),
        f AS (SELECT (n / greatest(s, 1)::DOUBLE > 50)::INT * 3 + (coalesce(d, 0) < 1)::INT * 2 + (dv > 3)::INT + (n > 5000)::INT * 2 + (n > 100 AND c = 0)::INT AS score FROM u) SELECT score, count(*) AS n_users FROM f GROUP BY 1""",
)
def e16_bot_score_histogram(t: Tables) -> DataFrame:
    known = t.events.filter("user_id is not null")
    per = known.groupBy("user_id", "session_id", "device").agg(rows().alias("n"), F.sum("dwell_time_sec").alias("d"), F.count("dwell_time_sec").alias("k"), F.count_if(is_positive()).alias("c"))
    u = per.groupBy("user_id").agg(F.sum("n").alias("n"), F.countDistinct("session_id").alias("s"), F.countDistinct("device").alias("dv"), F.try_divide(F.sum("d"), F.sum("k") * 1000.0).alias("d"), F.sum("c").alias("c"))
    score = (F.col("n") / F.greatest("s", F.lit(1)) > 50).cast("int") * 3 + (F.coalesce("d", F.lit(0.0)) < 1).cast("int") * 2 + (F.col("dv") > 3).cast("int") + (F.col("n") > 5000).cast("int") * 2 + ((F.col("n") > 100) & (F.col("c") == 0)).cast("int")
    return u.groupBy(score.alias("score")).agg(rows().alias("n_users"))


@query("e17_hourly_activity", "SELECT hour(event_ts)::INTEGER AS hour, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM fact_user_events WHERE event_ts IS NOT NULL GROUP BY 1")
def e17_hourly_activity(t: Tables) -> DataFrame:
    n = t.events.filter("event_ts is not null").groupBy(F.hour("event_ts").alias("hour")).agg(rows().alias("n"))
    return n.select("hour", "n", r6(F.col("n") / F.sum("n").over(Window.partitionBy()), "share"))


@query(
    "e18_zombie_listings",
    "WITH m AS (SELECT max(date) AS d FROM fact_listing_snapshot), s AS (SELECT item_id, sum(coalesce(views_24h, 0))::BIGINT AS views, sum(coalesce(contacts_24h, 0))::BIGINT AS contacts, max(listing_age_days) AS age FROM fact_listing_snapshot, m WHERE date > d - 7 GROUP BY 1) SELECT item_id, views, contacts, age FROM s WHERE age > 60 AND views < 5 AND contacts = 0",
)
def e18_zombie_listings(t: Tables) -> DataFrame:
    last = t.snapshots.agg(F.max("date")).scalar()
    zero = lambda x: F.sum(F.coalesce(x, F.lit(0)))
    week = t.snapshots.filter(F.col("date") > F.date_sub(last, 7)).groupBy("item_id").agg(zero("views_24h").alias("views"), zero("contacts_24h").alias("contacts"), F.max("listing_age_days").alias("age"))
    return week.filter("age > 60 and views < 5 and contacts = 0")


@query("e19_purchase_rate_by_category", "SELECT category, count(*) AS n, count(*) FILTER (WHERE purchased) AS purchases, round(avg(purchased::INT), 6) AS rate, round(avg(lead_count) FILTER (WHERE purchased), 6) AS leads_of_purchases FROM fact_post_contact_interactions GROUP BY 1")
def e19_purchase_rate_by_category(t: Tables) -> DataFrame:
    p = F.col("purchased")
    return t.pci.groupBy("category").agg(rows().alias("n"), F.count_if(p).alias("purchases"), r6(F.avg(p.cast("int")), "rate"), r6(F.avg(F.when(p, F.col("lead_count"))), "leads_of_purchases"))


@query("e20_weekday_averages", f"WITH d AS (SELECT date, count(*) AS n, count(*) FILTER (WHERE event_type IN {GT}) AS c FROM fact_user_events WHERE date IS NOT NULL GROUP BY 1) SELECT isodow(date)::INTEGER AS weekday, count(*) AS days, round(avg(n), 6) AS events, round(avg(c), 6) AS contacts FROM d GROUP BY 1")
def e20_weekday_averages(t: Tables) -> DataFrame:
    d = t.events.filter("date is not null").groupBy("date").agg(rows().alias("n"), F.count_if(is_positive()).alias("c"))
    return d.groupBy((F.weekday("date") + 1).alias("weekday")).agg(rows().alias("days"), r6(F.avg("n"), "events"), r6(F.avg("c"), "contacts"))


@query("e21_holiday_period", f"WITH d AS (SELECT date, CASE WHEN date BETWEEN DATE '2026-02-14' AND DATE '2026-02-22' THEN 'holiday' ELSE 'normal' END AS period, count(*) AS n, count(*) FILTER (WHERE event_type IN {GT}) AS c FROM fact_user_events WHERE date IS NOT NULL GROUP BY 1, 2) SELECT period, count(*) AS days, round(avg(n), 6) AS events, round(avg(c), 6) AS contacts FROM d GROUP BY 1")
def e21_holiday_period(t: Tables) -> DataFrame:
    period = F.when(F.col("date").between(on("2026-02-14"), on("2026-02-22")), "holiday").otherwise("normal")
    d = t.events.filter("date is not null").groupBy("date", period.alias("period")).agg(rows().alias("n"), F.count_if(is_positive()).alias("c"))
    return d.groupBy("period").agg(rows().alias("days"), r6(F.avg("n"), "events"), r6(F.avg("c"), "contacts"))


@query("e22_city_volume", f"SELECT city_name, count(*) AS n, round(avg((event_type IN {GT})::INT), 6) AS contact_rate, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share, contains(city_name, 'Giang') AS is_giang FROM fact_user_events GROUP BY city_name")
def e22_city_volume(t: Tables) -> DataFrame:
    n = t.events.groupBy("city_name").agg(rows().alias("n"), r6(F.avg(is_positive().cast("int")), "contact_rate"))
    return n.select("city_name", "n", "contact_rate", r6(F.col("n") / F.sum("n").over(Window.partitionBy()), "share"), F.contains("city_name", F.lit("Giang")).alias("is_giang"))


@query(
    "e23_price_anchoring",
    f"""WITH c AS (SELECT DISTINCT user_id, price_bucket FROM fact_user_events JOIN dim_listing USING (item_id) WHERE user_id IS NOT NULL AND event_type IN {GT}), v AS (SELECT DISTINCT user_id, price_bucket FROM fact_user_events JOIN dim_listing USING (item_id) WHERE user_id IS NOT NULL AND event_type = 'pageview')
        SELECT c.price_bucket AS contacted, v.price_bucket AS browsed, count(*) AS n_users FROM c JOIN v USING (user_id) GROUP BY 1, 2 ORDER BY n_users DESC, contacted, browsed LIMIT 10""",
)
def e23_price_anchoring(t: Tables) -> DataFrame:
    prices = t.events.filter("user_id is not null").join(t.listings.select("item_id", "price_bucket"), "item_id")
    take = lambda cond, name: prices.filter(cond).select("user_id", F.col("price_bucket").alias(name)).distinct()
    both = take(is_positive(), "contacted").join(take(F.col("event_type") == "pageview", "browsed"), "user_id")
    return both.groupBy("contacted", "browsed").agg(rows().alias("n_users")).orderBy(F.col("n_users").desc(), "contacted", "browsed").limit(10)


@query(
    "e24_user_breadth",
    """WITH k AS (SELECT user_id, category, sum(count) AS n FROM contact_pairs WHERE user_id IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id)::DOUBLE AS p FROM k),
       e AS (SELECT user_id, -sum(p * log2(p)) AS entropy FROM s GROUP BY 1), v AS (SELECT user_id, count(DISTINCT city_name) AS cities FROM contact_pairs WHERE user_id IS NOT NULL GROUP BY 1)
       SELECT count(*) AS n_users, round(avg(entropy), 6) AS entropy, round(avg(cities), 6) AS cities FROM v LEFT JOIN e USING (user_id)""",
)
def e24_user_breadth(t: Tables) -> DataFrame:
    known = t.contact_pairs.filter("user_id is not null")
    k = known.filter("category is not null").groupBy("user_id", "category").agg(F.sum("count").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("user_id"))
    e = k.select("user_id", p.alias("p")).groupBy("user_id").agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))
    v = known.groupBy("user_id").agg(F.countDistinct("city_name").alias("cities"))
    return v.join(e, "user_id", "left").agg(rows().alias("n_users"), r6(F.avg("entropy"), "entropy"), r6(F.avg("cities"), "cities"))


@query(
    "e24_contact_mix",
    "SELECT category, seller_type, sum(count)::BIGINT AS n, round(sum(count) / sum(sum(count)) OVER ()::DOUBLE, 6) AS share, round(avg(exp(-0.05::DOUBLE * greatest(datediff('day', posted_date, DATE '2026-04-09'), 0))), 6) AS freshness FROM (SELECT p.count, l.category, l.seller_type, l.posted_date FROM contact_pairs p JOIN dim_listing l USING (item_id)) GROUP BY 1, 2",
)
def e24_contact_mix(t: Tables) -> DataFrame:
    joined = t.contact_pairs.select("item_id", "count").join(t.listings.select("item_id", "category", "seller_type", "posted_date"), "item_id")
    age = F.greatest(F.datediff(on(CUTOFF.isoformat()), "posted_date"), F.lit(0))
    n = joined.groupBy("category", "seller_type").agg(F.sum("count").alias("n"), r6(F.avg(F.exp(-0.05 * age)), "freshness"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


WINDOWS = [7, 14, 30, 60, 90]
FRESH = "late AS (SELECT DISTINCT user_id, item_id FROM contact_pairs WHERE user_id IS NOT NULL AND last_date > DATE '2026-04-02')"


def late_pairs(t: Tables) -> DataFrame:
    return t.contact_pairs.filter((F.col("last_date") > on("2026-04-02")) & F.col("user_id").isNotNull()).select("user_id", "item_id").distinct()


@query(
    "e25_contact_recency_overlap",
    f"WITH {FRESH} " + " UNION ALL ".join(f"SELECT {d} AS days, (SELECT count(*) FROM late SEMI JOIN (SELECT item_id FROM contact_pairs WHERE last_date > DATE '2026-04-02' - {d} AND last_date <= DATE '2026-04-02') USING (item_id)) AS overlap" for d in WINDOWS),
)
def e25_contact_recency_overlap(t: Tables) -> DataFrame:
    """Late contacts whose item was contacted within the days before: one join on the item's latest earlier contact."""
    earlier = t.contact_pairs.filter(F.col("last_date") <= on("2026-04-02")).groupBy("item_id").agg(F.max("last_date").alias("seen"))
    met = late_pairs(t).join(earlier, "item_id")
    days = F.explode(F.array(*[F.when(F.col("seen") > F.date_sub(on("2026-04-02"), d), F.lit(d)) for d in WINDOWS])).alias("days")
    return met.select(days).filter("days is not null").groupBy("days").agg(rows().alias("overlap"))


@query(
    "e26_hit_rates_of_simple_strategies",
    f"""WITH {FRESH}, old AS (SELECT * FROM contact_pairs WHERE last_date <= DATE '2026-04-02' AND user_id IS NOT NULL), pref AS (SELECT u.user_id, a.city_name, b.category FROM (SELECT DISTINCT user_id FROM old) u LEFT JOIN {mode_sql("old", "user_id", "city_name")} a USING (user_id) LEFT JOIN {mode_sql("old", "user_id", "category")} b USING (user_id)),
        pop AS (SELECT city_name, category, item_id, row_number() OVER (PARTITION BY city_name, category ORDER BY sum(count) DESC, item_id) AS rank FROM old WHERE city_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3 QUALIFY rank <= 10),
        rec AS (SELECT city_name, category, item_id, row_number() OVER (PARTITION BY city_name, category ORDER BY count(*) DESC, item_id) AS rank FROM old WHERE last_date > DATE '2026-03-26' AND city_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3 QUALIFY rank <= 10),
        fresh AS (SELECT city_name, category, item_id, row_number() OVER (PARTITION BY city_name, category ORDER BY posted_date DESC NULLS LAST, item_id) AS rank FROM dim_listing WHERE posted_date <= DATE '2026-04-02' QUALIFY rank <= 10),
        lists AS (SELECT 'segment popularity' AS strategy, user_id, item_id FROM pref JOIN pop USING (city_name, category) UNION ALL SELECT 'recent', user_id, item_id FROM pref JOIN rec USING (city_name, category) UNION ALL SELECT 'fresh', user_id, item_id FROM pref JOIN fresh USING (city_name, category))
        SELECT strategy, count(*) AS n_shown, count(l.item_id) AS hits FROM lists s LEFT JOIN late l ON l.user_id = s.user_id AND l.item_id = s.item_id GROUP BY 1""",
)
def e26_hit_rates_of_simple_strategies(t: Tables) -> DataFrame:
    old = t.contact_pairs.filter((F.col("last_date") <= on("2026-04-02")) & F.col("user_id").isNotNull())
    pref = modes(old, "user_id", {"city_name": "city_name", "category": "category"})
    seg = ["city_name", "category"]
    placed = old.filter("city_name is not null and category is not null")
    top = lambda df, order: best(df, seg, [*order, F.col("item_id")], 10)
    pop = top(placed.groupBy(*seg, "item_id").agg(F.sum("count").alias("n")), [F.col("n").desc()])
    rec = top(placed.filter(F.col("last_date") > on("2026-03-26")).groupBy(*seg, "item_id").agg(rows().alias("n")), [F.col("n").desc()])
    fresh = top(t.listings.filter(F.col("posted_date") <= on("2026-04-02")).select(*seg, "item_id", "posted_date"), [F.col("posted_date").desc_nulls_last()])
    named = [pref.join(df.select(*seg, "item_id"), seg).select(F.lit(name).alias("strategy"), "user_id", "item_id") for name, df in (("segment popularity", pop), ("recent", rec), ("fresh", fresh))]
    shown = named[0].unionByName(named[1]).unionByName(named[2])
    return shown.join(late_pairs(t).withColumn("hit", F.lit(1)), ["user_id", "item_id"], "left").groupBy("strategy").agg(rows().alias("n_shown"), F.count("hit").alias("hits"))


@query(
    "e27_pageview_preferences_agree",
    f"""WITH v AS (SELECT * FROM fact_user_events WHERE event_type = 'pageview' AND user_id IS NOT NULL), p AS (SELECT * FROM contact_pairs WHERE user_id IS NOT NULL),
        a AS {mode_sql("v", "user_id", "city_name")}, b AS {mode_sql("p", "user_id", "city_name")}, x AS {mode_sql("v", "user_id", "category")}, y AS {mode_sql("p", "user_id", "category")}
        SELECT count(*) AS n_users, count(*) FILTER (WHERE a.city_name = b.city_name) AS same_city, count(*) FILTER (WHERE x.category = y.category) AS same_category FROM (SELECT DISTINCT user_id FROM v SEMI JOIN p USING (user_id)) u
        LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id) LEFT JOIN x USING (user_id) LEFT JOIN y USING (user_id)""",
)
def e27_pageview_preferences_agree(t: Tables) -> DataFrame:
    v = modes(t.events.filter("event_type = 'pageview' and user_id is not null"), "user_id", {"vc": "city_name", "vk": "category"})
    p = modes(t.contact_pairs.filter("user_id is not null"), "user_id", {"pc": "city_name", "pk": "category"})
    return v.join(p, "user_id").agg(rows().alias("n_users"), F.count_if(F.col("vc") == F.col("pc")).alias("same_city"), F.count_if(F.col("vk") == F.col("pk")).alias("same_category"))


@query(
    "e27_recency_replay",
    "WITH s AS (SELECT user_id, item_id, max(event_ts) AS last FROM fact_user_events WHERE event_type = 'pageview' AND user_id IS NOT NULL AND item_id IS NOT NULL AND event_ts IS NOT NULL GROUP BY 1, 2) SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY last DESC, item_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 10",
)
def e27_recency_replay(t: Tables) -> DataFrame:
    s = t.events.filter("event_type = 'pageview' and user_id is not null and item_id is not null and event_ts is not null").groupBy("user_id", "item_id").agg(F.max("event_ts").alias("last"))
    return best(s, ["user_id"], [F.col("last").desc(), F.col("item_id")], 10).select("user_id", "item_id", "rank")


SWEEP = [3, 7, 14, 30]


@query(
    "e28_replay_window_sweep",
    f"WITH {FRESH} "
    + " UNION ALL ".join(
        f"SELECT * FROM (WITH s AS (SELECT user_id, item_id, sum(CASE WHEN event_type IN {GT} THEN 10 ELSE 1 END) AS w, max(event_ts) AS last FROM fact_user_events WHERE event_ts BETWEEN TIMESTAMP '2026-04-02' - INTERVAL {d} DAY AND TIMESTAMP '2026-04-02' AND user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY 1, 2), "
        f"r AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY w DESC, last DESC, item_id) <= 10) SELECT {d} AS days, count(*) AS n_shown, count(l.item_id) AS hits FROM r LEFT JOIN late l ON l.user_id = r.user_id AND l.item_id = r.item_id)"
        for d in SWEEP
    ),
)
def e28_replay_window_sweep(t: Tables) -> DataFrame:
    from datetime import date
    lists = [c.pageview_replay(t.events, date(2026, 4, 2), d, 10).select(F.lit(d).alias("days"), "user_id", "item_id") for d in SWEEP]
    shown = reduce(DataFrame.unionByName, lists)
    return shown.join(late_pairs(t).withColumn("hit", F.lit(1)), ["user_id", "item_id"], "left").groupBy("days").agg(rows().alias("n_shown"), F.count("hit").alias("hits"))


COVIEW = """
    v AS (SELECT DISTINCT user_id, item_id FROM fact_user_events WHERE event_type = 'pageview' AND user_id IS NOT NULL AND item_id IS NOT NULL AND date > DATE '2026-03-10'),
    l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS pos FROM v WHERE user_id IN (SELECT user_id FROM v GROUP BY 1 HAVING count(*) BETWEEN 2 AND 200)),
    n AS (SELECT a.item_id AS x, b.item_id AS y, count(*) AS n FROM l a JOIN l b ON a.user_id = b.user_id AND b.pos > a.pos AND b.pos - a.pos <= 29 GROUP BY 1, 2)
"""


@query("e29_coview_graph", f"WITH {COVIEW} SELECT item_id, co_item_id, n, CAST(row_number() OVER (PARTITION BY item_id ORDER BY n DESC, co_item_id) AS INTEGER) AS rank FROM (SELECT x AS item_id, y AS co_item_id, n FROM n UNION ALL SELECT y, x, n FROM n) QUALIFY rank <= 50")
def e29_coview_graph(t: Tables) -> DataFrame:
    views = t.events.filter("event_type = 'pageview'").select("user_id", "item_id", F.col("date").alias("last_date"))
    return c.cocontact_graph(views, CUTOFF, 30, 200, 29)


INTENT_LEVELS = {"ward": ["ward_name", "price_bucket", "category"], "district": ["district_name", "category", "price_bucket"], "city": ["city_name", "category"]}


@query(
    "e30_intent_match_rate",
    "WITH seen AS (SELECT e.user_id, l.* FROM fact_user_events e JOIN dim_listing l USING (item_id) WHERE e.event_type = 'pageview' AND e.date <= DATE '2026-04-02' AND e.user_id IS NOT NULL), "
    f"{FRESH}, target AS (SELECT late.user_id, l.* FROM late JOIN dim_listing l USING (item_id)) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS level, {top} AS top, count(*) AS n, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM (SELECT user_id, {', '.join(cols)} FROM seen GROUP BY user_id, {', '.join(cols)} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {', '.join(x + ' NULLS FIRST' for x in cols)}) <= {top}) m WHERE m.user_id = t.user_id AND {' AND '.join(f'm.{x} IS NOT DISTINCT FROM t.{x}' for x in cols)})) AS matched FROM target t WHERE user_id IN (SELECT user_id FROM seen)"
        for name, cols in INTENT_LEVELS.items()
        for top in (1, 3)
    ),
)
def e30_intent_match_rate(t: Tables) -> DataFrame:
    attrs = ["city_name", "district_name", "ward_name", "category", "price_bucket"]
    listings = t.listings.select("item_id", *attrs)
    seen = t.events.filter((F.col("event_type") == "pageview") & (F.col("date") <= on("2026-04-02")) & F.col("user_id").isNotNull()).select("user_id", "item_id").join(listings, "item_id")
    target = late_pairs(t).join(listings, "item_id").join(seen.select("user_id"), "user_id", "left_semi")
    parts = []
    for name, cols in INTENT_LEVELS.items():
        mine = best(seen.groupBy("user_id", *cols).agg(rows().alias("n")), ["user_id"], [F.col("n").desc(), *[F.col(x).asc_nulls_first() for x in cols]], 3, "place")
        a, b = target.alias("a"), mine.alias("b")
        same = reduce(Column.__and__, [F.col(f"a.{x}").eqNullSafe(F.col(f"b.{x}")) for x in cols], F.col("a.user_id") == F.col("b.user_id"))
        met = a.join(b, same, "left").select("place")
        parts += [met.agg(rows().alias("n"), F.count_if(F.col("place") <= top).alias("matched")).select(F.lit(name).alias("level"), F.lit(top).alias("top"), "n", "matched") for top in (1, 3)]
    return reduce(DataFrame.unionByName, parts)


@query("e31_adview_bins", "SELECT (floor(adview_count / 10) * 10)::BIGINT AS bin, count(*) AS n, round(sum(coalesce(lead_count, 0)) / sum(adview_count)::DOUBLE, 6) AS leads_per_view FROM fact_post_contact_interactions WHERE adview_count > 0 GROUP BY 1")
def e31_adview_bins(t: Tables) -> DataFrame:
    known = t.pci.filter("adview_count > 0")
    return known.groupBy((F.floor(F.col("adview_count") / 10) * 10).alias("bin")).agg(rows().alias("n"), r6(F.sum(F.coalesce("lead_count", F.lit(0))) / F.sum("adview_count"), "leads_per_view"))


@query("e31_adview_lead_correlation", "SELECT round(corr(adview_count, coalesce(lead_count, 0)), 6) AS r, count(*) AS n FROM fact_post_contact_interactions WHERE adview_count IS NOT NULL")
def e31_adview_lead_correlation(t: Tables) -> DataFrame:
    known = t.pci.filter("adview_count is not null").withColumn("l", F.coalesce("lead_count", F.lit(0)))
    return known.agg(r6(F.corr("adview_count", "l"), "r"), rows().alias("n"))


TRANSITIONS = "WITH s AS (SELECT category AS b, lag(category) OVER (PARTITION BY user_id ORDER BY last_date, item_id, city_name NULLS FIRST, category NULLS FIRST, count) AS a FROM contact_pairs WHERE user_id IS NOT NULL AND last_date IS NOT NULL), n AS (SELECT a, b, count(*) AS n FROM s WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2), p AS (SELECT a AS from_category, b AS to_category, n, n / sum(n) OVER (PARTITION BY a)::DOUBLE AS p FROM n)"


def transitions(t: Tables) -> DataFrame:
    line = Window.partitionBy("user_id").orderBy("last_date", "item_id", F.col("city_name").asc_nulls_first(), F.col("category").asc_nulls_first(), "count")
    steps = t.contact_pairs.filter("user_id is not null and last_date is not null").select(F.lag("category").over(line).alias("from_category"), F.col("category").alias("to_category")).dropna()
    n = steps.groupBy("from_category", "to_category").agg(rows().alias("n"))
    return n.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("from_category")))


@query("e32_category_transitions", f"{TRANSITIONS} SELECT from_category, to_category, n, round(p, 6) AS p FROM p")
def e32_category_transitions(t: Tables) -> DataFrame:
    return rounded(transitions(t), "p")


@query("e32_self_transition", f"{TRANSITIONS} SELECT round(avg(p), 6) AS mean_self FROM p WHERE from_category = to_category")
def e32_self_transition(t: Tables) -> DataFrame:
    return transitions(t).filter("from_category = to_category").agg(r6(F.avg("p"), "mean_self"))


@query("e33_recall_of_sources")
def e33_recall_of_sources(t: Tables) -> DataFrame:
    """Recall of late contacts by each source, fitted on everything up to the split."""
    from datetime import date
    from marketloom.constants import ITEMS_PER_SELLER
    from marketloom.operators import metrics

    split = date(2026, 4, 2)
    old = t.contact_pairs.filter((F.col("last_date") <= on("2026-04-02")) & F.col("user_id").isNotNull())
    late = late_pairs(t)
    sources = {
        "pageview replay": c.pageview_replay(t.events, split, cap=200),
        "co-contact": c.cocontact(c.user_history(old), c.cocontact_graph(old, split), old, 200),
        "seller": c.seller_expansion(old, t.listings, cq.valid_items(t), 200, items_per_seller=ITEMS_PER_SELLER),
        "item to item": c.item2item(c.user_history(old), c.item2item_graph(t.events.filter(F.col("date") <= on("2026-04-02")), cq.valid_items(t)), t.listings, None, old, 200),
    }
    return reduce(DataFrame.unionByName, [metrics.averages(metrics.per_user(df.select("user_id", "item_id", "rank"), late, 200)).select(F.lit(name).alias("source"), "n_users", r6(F.col("recall"), "recall"), r6(F.col("hit_rate"), "hit_rate")) for name, df in sources.items()])


@query(
    "e34_interactions_overview",
    """WITH c AS (SELECT DISTINCT user_id, item_id FROM contact_pairs WHERE user_id IS NOT NULL), p AS (SELECT * FROM fact_post_contact_interactions WHERE user_id IS NOT NULL)
       SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(*) FILTER (WHERE lead_count > 0) AS lead_rows, (SELECT count(DISTINCT user_id) FROM p WHERE user_id NOT IN (SELECT user_id FROM c)) AS users_without_contacts,
       (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM p WHERE lead_count > 0) ANTI JOIN c USING (user_id, item_id)) AS new_lead_pairs FROM p""",
)
def e34_interactions_overview(t: Tables) -> DataFrame:
    p = t.pci.filter("user_id is not null")
    contacts = t.contact_pairs.filter("user_id is not null").select("user_id", "item_id").distinct()
    by_user = p.groupBy("user_id").agg(rows().alias("n"), F.count_if(F.col("lead_count") > 0).alias("l"))
    known = contacts.select("user_id").distinct().withColumn("known", F.lit(1))
    users = by_user.join(known, "user_id", "left").agg(F.sum("n").alias("n_rows"), rows().alias("n_users"), F.sum("l").alias("lead_rows"), F.count_if(F.col("known").isNull()).alias("users_without_contacts"))
    new = p.filter("lead_count > 0").select("user_id", "item_id").distinct().join(contacts, ["user_id", "item_id"], "left_anti").agg(rows()).scalar()
    return users.withColumn("new_lead_pairs", new)


@query(
    "e35_contacts_by_listing_age",
    "WITH a AS (SELECT greatest(datediff('day', posted_date, last_date), 0) AS age FROM contact_pairs JOIN dim_listing USING (item_id) WHERE posted_date IS NOT NULL AND last_date IS NOT NULL) "
    + " UNION ALL ".join(f"SELECT {d} AS days, count(*) FILTER (WHERE age <= {d}) AS n, round(count(*) FILTER (WHERE age <= {d}) / count(*)::DOUBLE, 6) AS share FROM a" for d in WINDOWS),
)
def e35_contacts_by_listing_age(t: Tables) -> DataFrame:
    age = F.greatest(F.datediff("last_date", "posted_date"), F.lit(0))
    ages = t.contact_pairs.join(t.listings.select("item_id", "posted_date"), "item_id").filter("posted_date is not null and last_date is not null").groupBy(age.alias("age")).agg(rows().alias("n"))
    within = F.explode(F.array(*[F.struct(F.lit(d).alias("days"), F.when(F.col("age") <= d, F.col("n")).otherwise(0).alias("k")) for d in WINDOWS])).alias("w")
    return ages.select("n", within).groupBy("w.days").agg(F.sum("w.k").alias("n"), r6(F.sum("w.k") / F.sum("n"), "share"))


@query(
    "e35_segment_ceiling",
    f"""WITH {FRESH}, old AS (SELECT * FROM contact_pairs WHERE last_date <= DATE '2026-04-02' AND city_name IS NOT NULL AND category IS NOT NULL),
        pop AS (SELECT city_name, category, item_id, row_number() OVER (PARTITION BY city_name, category ORDER BY sum(count) DESC, item_id) AS rank FROM old GROUP BY 1, 2, 3),
        tg AS (SELECT late.user_id, late.item_id, p.city_name, p.category FROM late JOIN (SELECT DISTINCT user_id, item_id, city_name, category FROM contact_pairs WHERE last_date > DATE '2026-04-02') p USING (user_id, item_id))
        SELECT k, count(*) AS n, count(rank) FILTER (WHERE rank <= k) AS hits FROM tg LEFT JOIN pop USING (city_name, category, item_id), (VALUES (10), (50), (500)) v(k) GROUP BY 1""",
)
def e35_segment_ceiling(t: Tables) -> DataFrame:
    """How often a late contact is among the k most contacted items of its own city and category."""
    old = t.contact_pairs.filter((F.col("last_date") <= on("2026-04-02")) & F.col("city_name").isNotNull() & F.col("category").isNotNull())
    seg = ["city_name", "category"]
    pop = best(old.groupBy(*seg, "item_id").agg(F.sum("count").alias("n")), seg, [F.col("n").desc(), F.col("item_id")], 500).select(*seg, "item_id", "rank")
    target = t.contact_pairs.filter((F.col("last_date") > on("2026-04-02")) & F.col("user_id").isNotNull()).select("user_id", "item_id", *seg).distinct()
    ks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("rank") <= k).alias("hit")) for k in (10, 50, 500)])).alias("x")
    return target.join(pop, [*seg, "item_id"], "left").select(ks).groupBy("x.k").agg(rows().alias("n"), F.count_if("x.hit").alias("hits"))

"""Queries of the cleaning filters and pair tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.constants import CUTOFF
from marketloom.operators import cleaning
from marketloom.plans.registry import Registry
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query

GT = "('view_phone', 'contact_chat', 'contact_zalo', 'contact_sms', 'other_interaction')"
REAL = "('view_phone', 'contact_chat', 'contact_zalo', 'contact_sms')"
LOGIN = "is_login = 'login'"


def mode_sql(source: str, key: str, value: str) -> str:
    """One row a key: the most frequent non-null value, the smallest on a tie."""
    return (
        f"(SELECT {key}, {value} FROM (SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS rn FROM {source} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) WHERE rn = 1)"
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


CONTACT_SCORES = f"SELECT user_id, item_id, count(*) AS score FROM fact_user_events WHERE {LOGIN} AND is_contact = 1 GROUP BY 1, 2"
WEIGHTED_SCORES = f"SELECT user_id, item_id, sum(CASE WHEN event_type IN {REAL} THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END) AS score FROM fact_user_events WHERE {LOGIN} AND is_contact = 1 GROUP BY 1, 2"
LEADS = "SELECT user_id, item_id, lead_count, purchased, category, CASE WHEN purchased THEN lead_count * 3.0::DOUBLE ELSE lead_count::DOUBLE END AS weight FROM fact_post_contact_interactions WHERE lead_count >= 1"


@query("d1_contact_pairs", f"SELECT user_id, item_id, city_name, category, count(*) AS count, max(date) AS last_date FROM fact_user_events WHERE {LOGIN} AND event_type IN {GT} GROUP BY 1, 2, 3, 4")
def d1_contact_pairs(t: Tables) -> DataFrame:
    return cleaning.contact_pairs(t.events)


@query("d2_contact_scores", CONTACT_SCORES)
def d2_contact_scores(t: Tables) -> DataFrame:
    return cleaning.contact_scores(t.events)


@query("d3_weighted_contact_scores", WEIGHTED_SCORES)
def d3_weighted_contact_scores(t: Tables) -> DataFrame:
    return cleaning.weighted_contact_scores(t.events)


@query("d4_pageview_pairs", f"SELECT user_id, item_id, count(*) AS view_count, round(avg(dwell_time_sec), 6) AS avg_dwell FROM fact_user_events WHERE {LOGIN} AND event_type = 'pageview' GROUP BY 1, 2")
def d4_pageview_pairs(t: Tables) -> DataFrame:
    return rounded(cleaning.pageview_pairs(t.events), "avg_dwell")


@query("d5_date_range", "SELECT min(date) AS min_date, max(date) AS max_date FROM fact_user_events")
def d5_date_range(t: Tables) -> DataFrame:
    return cleaning.date_range(t.events)


@query(
    "d6_session_items",
    f"WITH d AS (SELECT DISTINCT session_id, item_id FROM fact_user_events WHERE {LOGIN} AND session_id IS NOT NULL) "
    "SELECT session_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM d GROUP BY 1 HAVING count(*) BETWEEN 2 AND 30",
)
def d6_session_items(t: Tables) -> DataFrame:
    items = cleaning.session_items(t.events)
    joined = F.when(F.size("items") > 0, F.array_join("items", ","))
    return items.select("session_id", "n_items", joined.alias("items"))


SNAPSHOT_STATS = """
    WITH m AS (SELECT max(date) AS d FROM fact_listing_snapshot),
         r AS (SELECT item_id, avg(views_24h) AS v, avg(contacts_24h) AS c FROM fact_listing_snapshot, m WHERE date >= m.d - 7 GROUP BY 1),
         p AS (SELECT item_id, avg(views_24h) AS pv FROM fact_listing_snapshot, m WHERE date >= m.d - 30 AND date < m.d - 7 GROUP BY 1),
         snapshot_stats AS (SELECT r.item_id, round(v, 6) AS item_avg_views_7d, round(c, 6) AS item_avg_contacts_7d, round(coalesce(c, 0) / (coalesce(v, 0) + 1), 6) AS item_conversion_rate,
                round(coalesce(v, 0) / (coalesce(pv, 0) + 1), 6) AS item_trend_score, 1.0::DOUBLE AS item_is_active FROM r LEFT JOIN p USING (item_id))
"""


@query("d7_snapshot_stats", SNAPSHOT_STATS + "SELECT * FROM snapshot_stats")
def d7_snapshot_stats(t: Tables) -> DataFrame:
    return rounded(cleaning.snapshot_stats(t.snapshots), "item_avg_views_7d", "item_avg_contacts_7d", "item_conversion_rate", "item_trend_score")


COLD_PREFS = f"""
    cold_rows AS (SELECT * FROM fact_user_events WHERE {LOGIN} AND event_type = 'pageview' AND user_id IS NOT NULL
                  AND user_id NOT IN (SELECT user_id FROM fact_user_events WHERE {LOGIN} AND event_type IN {GT} AND user_id IS NOT NULL)),
    cold_prefs AS (SELECT u.user_id, c.city_name AS pref_city, k.category AS pref_cat FROM (SELECT DISTINCT user_id FROM cold_rows) u
                   LEFT JOIN {mode_sql("cold_rows", "user_id", "city_name")} c USING (user_id) LEFT JOIN {mode_sql("cold_rows", "user_id", "category")} k USING (user_id)
                   WHERE c.city_name IS NOT NULL OR k.category IS NOT NULL)
"""


@query("d8_cold_user_prefs", f"WITH {COLD_PREFS} SELECT * FROM cold_prefs")
def d8_cold_user_prefs(t: Tables) -> DataFrame:
    return cleaning.cold_user_prefs(t.events)


@query(
    "d9_cold_user_prefs_by_listing",
    f"""WITH v AS (SELECT DISTINCT user_id, item_id FROM fact_user_events WHERE {LOGIN} AND event_type = 'pageview' AND user_id IS NOT NULL),
        j AS (SELECT v.user_id, l.city_name, l.category FROM v LEFT JOIN dim_listing l USING (item_id) WHERE user_id NOT IN (SELECT user_id FROM contact_pairs WHERE user_id IS NOT NULL))
        SELECT u.user_id, c.city_name AS pref_city, k.category AS pref_cat FROM (SELECT DISTINCT user_id FROM j) u
        LEFT JOIN {mode_sql("j", "user_id", "city_name")} c USING (user_id) LEFT JOIN {mode_sql("j", "user_id", "category")} k USING (user_id) WHERE c.city_name IS NOT NULL OR k.category IS NOT NULL""",
)
def d9_cold_user_prefs_by_listing(t: Tables) -> DataFrame:
    return cleaning.cold_user_prefs_by_listing(cleaning.pageview_pairs(t.events), t.contact_pairs, t.listings)


@query("d10_lead_pairs", LEADS)
def d10_lead_pairs(t: Tables) -> DataFrame:
    return cleaning.lead_pairs(t.pci)


SUPPLEMENT = f"WITH e AS ({CONTACT_SCORES}), l AS ({LEADS}), s AS (SELECT user_id, item_id, weight FROM l ANTI JOIN e USING (user_id, item_id))"


@query("d11_lead_supplement", SUPPLEMENT + " SELECT * FROM s WHERE user_id IN (SELECT user_id FROM e)")
def d11_lead_supplement(t: Tables) -> DataFrame:
    return cleaning.lead_supplement(t.pci, cleaning.contact_scores(t.events))


@query("d11_lead_supplement_all", SUPPLEMENT + " SELECT * FROM s")
def d11_lead_supplement_all(t: Tables) -> DataFrame:
    return cleaning.lead_supplement(t.pci, cleaning.contact_scores(t.events), mode="all")


BLIND_PREFS = f"""
    blind_rows AS (SELECT p.user_id, p.category, l.city_name FROM fact_post_contact_interactions p LEFT JOIN dim_listing l USING (item_id) WHERE p.user_id IN (SELECT user_id FROM blind_users)),
    blind_prefs AS (SELECT u.user_id, c.city_name AS pref_city, k.category AS pref_cat FROM (SELECT DISTINCT user_id FROM blind_rows) u
                    LEFT JOIN {mode_sql("blind_rows", "user_id", "city_name")} c USING (user_id) LEFT JOIN {mode_sql("blind_rows", "user_id", "category")} k USING (user_id)
                    WHERE c.city_name IS NOT NULL OR k.category IS NOT NULL)
"""


def blind_users(t: Tables) -> DataFrame:
    """Users of the interactions table without a contact."""
    return t.pci.select("user_id").filter("user_id is not null").distinct().join(t.contact_pairs.select("user_id"), "user_id", "left_anti")


BLIND_USERS = "blind_users AS (SELECT DISTINCT user_id FROM fact_post_contact_interactions WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM contact_pairs WHERE user_id IS NOT NULL))"


@query("d12_blind_user_prefs", f"WITH {BLIND_USERS}, {BLIND_PREFS} SELECT * FROM blind_prefs")
def d12_blind_user_prefs(t: Tables) -> DataFrame:
    return cleaning.blind_user_prefs(t.pci, blind_users(t), t.listings)


@query("d13_enriched_scores", SUPPLEMENT + " SELECT user_id, item_id, sum(score) AS score FROM (SELECT user_id, item_id, score::DOUBLE AS score FROM e UNION ALL SELECT user_id, item_id, weight FROM s WHERE user_id IN (SELECT user_id FROM e)) GROUP BY 1, 2")
def d13_enriched_scores(t: Tables) -> DataFrame:
    return cleaning.enrich_scores(cleaning.contact_scores(t.events), t.pci)


@query("d14_enriched_weighted_scores", f"WITH e AS ({WEIGHTED_SCORES}), l AS ({LEADS}) SELECT user_id, item_id, sum(score) AS score FROM (SELECT * FROM e UNION ALL SELECT user_id, item_id, weight FROM l WHERE user_id IN (SELECT user_id FROM e)) GROUP BY 1, 2")
def d14_enriched_weighted_scores(t: Tables) -> DataFrame:
    return cleaning.enrich_weighted_scores(cleaning.weighted_contact_scores(t.events), t.pci)


@query("d15_enriched_cold_prefs", f"WITH {COLD_PREFS}, {BLIND_USERS}, {BLIND_PREFS} SELECT * FROM cold_prefs UNION ALL SELECT * FROM blind_prefs WHERE user_id NOT IN (SELECT user_id FROM cold_prefs)")
def d15_enriched_cold_prefs(t: Tables) -> DataFrame:
    return cleaning.fill_missing_users(cleaning.cold_user_prefs(t.events), cleaning.blind_user_prefs(t.pci, blind_users(t), t.listings))


@query("d16_not_after_cutoff", "SELECT event_id, user_id, date FROM fact_user_events WHERE CAST(date AS VARCHAR) <= '2026-04-09'")
def d16_not_after_cutoff(t: Tables) -> DataFrame:
    return cleaning.not_after(t.events, CUTOFF).select("event_id", "user_id", "date")


LEGIT = """legit AS (SELECT user_id FROM (SELECT user_id, count(*) AS n, floor((epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 1e6) / 60.0::DOUBLE AS minutes, avg(dwell_time_sec) AS dwell,
           count(*) FILTER (WHERE hour(event_ts) BETWEEN 2 AND 5) AS night FROM {source} WHERE user_id IS NOT NULL GROUP BY 1)
           WHERE CAST(n / (minutes + 1.0::DOUBLE) > 5.0 AS INTEGER) * 3 + CAST(dwell < 1.0 AS INTEGER) * 2 + CAST(night / (n + 1.0::DOUBLE) > 0.8 AS INTEGER) < 4)"""


@query("d17_without_bots", f"WITH {LEGIT.format(source='fact_user_events')} SELECT event_id, user_id FROM fact_user_events WHERE user_id IN (SELECT user_id FROM legit)")
def d17_without_bots(t: Tables) -> DataFrame:
    return cleaning.without_bots(t.events).select("event_id", "user_id")


NO_BOUNCE = f"(dwell_time_sec >= 3000 OR event_type IN {GT} OR event_type = 'lead' OR dwell_time_sec IS NULL)"


@query("d18_without_bounces", f"SELECT event_id, user_id FROM fact_user_events WHERE {NO_BOUNCE}")
def d18_without_bounces(t: Tables) -> DataFrame:
    return cleaning.without_bounces(t.events).select("event_id", "user_id")


@query(
    "d19_without_area_outliers",
    """WITH m AS (SELECT category, district_name, median(area_sqm) AS med FROM dim_listing GROUP BY 1, 2),
       o AS (SELECT l.*, med FROM dim_listing l JOIN m ON l.category IS NOT DISTINCT FROM m.category AND l.district_name IS NOT DISTINCT FROM m.district_name),
       a AS (SELECT category, district_name, median(abs(area_sqm - med)) AS mad FROM o GROUP BY 1, 2)
       SELECT o.item_id, o.area_sqm FROM o JOIN a ON o.category IS NOT DISTINCT FROM a.category AND o.district_name IS NOT DISTINCT FROM a.district_name
       WHERE abs(0.6745::DOUBLE * (area_sqm - med) / (mad + 1e-6)) <= 3.5""",
)
def d19_without_area_outliers(t: Tables) -> DataFrame:
    return cleaning.without_outliers(t.listings.select("item_id", "category", "district_name", "area_sqm"), "area_sqm", ["category", "district_name"]).select("item_id", "area_sqm")


@query(
    "d20_without_zombies",
    "SELECT s.snapshot_id, s.item_id, s.date FROM fact_listing_snapshot s JOIN dim_listing l USING (item_id) WHERE NOT (s.listing_age_days > 60 AND s.views_24h < 5 AND s.contacts_24h = 0) AND l.images_count >= 1",
)
def d20_without_zombies(t: Tables) -> DataFrame:
    return cleaning.without_zombies(t.snapshots.join(t.listings.select("item_id", "images_count"), "item_id")).select("snapshot_id", "item_id", "date")


@query("d21_clean_events", f"WITH c AS (SELECT * FROM fact_user_events WHERE CAST(date AS VARCHAR) <= '2026-04-09'), {LEGIT.format(source='c')} SELECT event_id, user_id FROM c WHERE user_id IN (SELECT user_id FROM legit) AND {NO_BOUNCE}")
def d21_clean_events(t: Tables) -> DataFrame:
    return cleaning.clean_events(t.events, CUTOFF).select("event_id", "user_id")


@query("d22_time_split", "WITH m AS (SELECT max(date) - 7 AS d FROM fact_user_events) SELECT CASE WHEN date < d THEN 'train' ELSE 'validation' END AS part, count(*) AS n FROM fact_user_events, m GROUP BY 1")
def d22_time_split(t: Tables) -> DataFrame:
    train, validation = cleaning.time_split(t.events, "date", 7)
    named = train.select(F.lit("train").alias("part")).unionAll(validation.select(F.lit("validation").alias("part")))
    return named.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("d23_contact_split", "SELECT CASE WHEN last_date <= DATE '2026-04-02' THEN 'train' ELSE 'validation' END AS part, count(*) AS n FROM contact_pairs WHERE last_date IS NOT NULL GROUP BY 1")
def d23_contact_split(t: Tables) -> DataFrame:
    part = F.when(F.col("last_date") <= F.lit("2026-04-02").cast("date"), "train").otherwise("validation")
    return t.contact_pairs.filter("last_date is not null").groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


DECAYED = """SELECT user_id, item_id, round(coalesce(sum(CASE WHEN event_ts IS NOT NULL THEN 1 END * CASE event_type WHEN 'pageview' THEN 1.0::DOUBLE WHEN 'other_interaction' THEN 1.5::DOUBLE WHEN 'view_phone' THEN 5.0::DOUBLE WHEN 'contact_chat' THEN 5.0::DOUBLE
    WHEN 'contact_zalo' THEN 5.0::DOUBLE WHEN 'contact_sms' THEN 5.0::DOUBLE WHEN 'lead' THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END
    * pow(0.5::DOUBLE, greatest(floor((epoch_us(TIMESTAMP '2026-04-09') - epoch_us(event_ts)) / 1000) / 86400000.0::DOUBLE, 0.0::DOUBLE) / 7.0::DOUBLE)), 0), 6) AS interaction_score FROM fact_user_events GROUP BY 1, 2"""


@query("d24_decayed_scores", DECAYED)
def d24_decayed_scores(t: Tables) -> DataFrame:
    return rounded(cleaning.decayed_scores(t.events, CUTOFF), "interaction_score")


@query(
    "d24_indexed_scores",
    f"""WITH s AS ({CONTACT_SCORES}), u AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM s WHERE user_id IS NOT NULL)),
        i AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM s WHERE item_id IS NOT NULL)) SELECT user_idx, item_idx, score FROM s JOIN u USING (user_id) JOIN i USING (item_id)""",
)
def d24_indexed_scores(t: Tables) -> DataFrame:
    return cleaning.index_pairs(cleaning.contact_scores(t.events)).select("user_idx", "item_idx", "score")


@query(
    "d25_blended_scores",
    f"""WITH c AS ({CONTACT_SCORES}), v AS (SELECT user_id, item_id, count(*) AS n FROM fact_user_events WHERE {LOGIN} AND event_type = 'pageview' GROUP BY 1, 2)
        SELECT user_id, item_id, sum(score) AS score FROM (SELECT user_id, item_id, score * 3.0::DOUBLE AS score FROM c UNION ALL SELECT user_id, item_id, least(greatest(n::DOUBLE, 1.0), 5.0) FROM v) GROUP BY 1, 2""",
)
def d25_blended_scores(t: Tables) -> DataFrame:
    return cleaning.blended_scores(cleaning.contact_scores(t.events), cleaning.pageview_pairs(t.events))


@query(
    "d26_split_clean_scores",
    f"""WITH e AS (SELECT * FROM ({WEIGHTED_SCORES.replace("WHERE", "WHERE date <= DATE '2026-04-02' AND")})),
        l AS (SELECT user_id, item_id, CASE WHEN purchased THEN lead_count * 3.0::DOUBLE ELSE lead_count::DOUBLE END AS weight FROM fact_post_contact_interactions WHERE lead_count >= 1 AND date <= DATE '2026-04-02'),
        s AS (SELECT * FROM l ANTI JOIN e USING (user_id, item_id))
        SELECT user_id, item_id, sum(score) AS score FROM (SELECT * FROM e UNION ALL SELECT user_id, item_id, weight FROM s WHERE user_id IN (SELECT user_id FROM e)) GROUP BY 1, 2""",
)
def d26_split_clean_scores(t: Tables) -> DataFrame:
    until = "date <= date'2026-04-02'"
    return cleaning.enrich_scores(cleaning.weighted_contact_scores(t.events.filter(until)), t.pci.filter(until))


@query(
    "d27_split_clean_lead_prefs",
    f"""WITH j AS (SELECT p.user_id, p.category, l.city_name FROM fact_post_contact_interactions p LEFT JOIN dim_listing l USING (item_id) WHERE lead_count > 0 AND date <= DATE '2026-04-02' AND user_id IS NOT NULL)
        SELECT u.user_id, c.city_name AS pref_city, k.category AS pref_cat FROM (SELECT DISTINCT user_id FROM j) u
        LEFT JOIN {mode_sql("j", "user_id", "city_name")} c USING (user_id) LEFT JOIN {mode_sql("j", "user_id", "category")} k USING (user_id) WHERE c.city_name IS NOT NULL OR k.category IS NOT NULL""",
)
def d27_split_clean_lead_prefs(t: Tables) -> DataFrame:
    leads = t.pci.filter("lead_count > 0 and date <= date'2026-04-02' and user_id is not null")
    return cleaning.blind_user_prefs(leads, leads, t.listings)


ALL_USERS = "all_users AS (SELECT user_id FROM fact_user_events WHERE user_id IS NOT NULL UNION SELECT user_id FROM fact_post_contact_interactions WHERE user_id IS NOT NULL)"


def all_users(t: Tables) -> DataFrame:
    return t.events.select("user_id").union(t.pci.select("user_id")).filter("user_id is not null").distinct()


@query(
    "d28_user_segments",
    f"WITH {ALL_USERS} SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM contact_pairs WHERE user_id IS NOT NULL) THEN 'warm' WHEN user_id IN (SELECT user_id FROM fact_user_events WHERE event_type = 'pageview' AND user_id IS NOT NULL) THEN 'cold' ELSE 'blind' END AS segment FROM all_users",
)
def d28_user_segments(t: Tables) -> DataFrame:
    return cleaning.user_segments(all_users(t), t.contact_pairs, t.events.filter("event_type = 'pageview'"))


USER_PREFS = f"""
    warm_rows AS (SELECT * FROM contact_pairs WHERE user_id IS NOT NULL),
    warm_prefs AS (SELECT u.user_id, c.city_name AS pref_city, k.category AS pref_cat FROM (SELECT DISTINCT user_id FROM warm_rows) u
                   LEFT JOIN {mode_sql("warm_rows", "user_id", "city_name")} c USING (user_id) LEFT JOIN {mode_sql("warm_rows", "user_id", "category")} k USING (user_id)
                   WHERE c.city_name IS NOT NULL OR k.category IS NOT NULL),
    user_prefs AS (SELECT * FROM warm_prefs UNION ALL SELECT * FROM cold_prefs WHERE user_id NOT IN (SELECT user_id FROM warm_prefs))
"""


@query("d29_user_prefs", f"WITH {COLD_PREFS}, {USER_PREFS} SELECT * FROM user_prefs")
def d29_user_prefs(t: Tables) -> DataFrame:
    return cleaning.user_prefs(t.contact_pairs, cleaning.cold_user_prefs(t.events))

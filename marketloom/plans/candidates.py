"""Queries of the candidate sources."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.constants import CUTOFF
from marketloom.operators import candidates as c
from marketloom.operators import cleaning
from marketloom.plans.cleaning import COLD_PREFS, GT, LOGIN, SNAPSHOT_STATS, USER_PREFS
from marketloom.plans.registry import Registry
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query

CAPS = {"global": 500, "city": 500, "cat": 500, "cc": 500, "ccd": 50}
VALID_SQL = "SELECT item_id FROM dim_listing WHERE ad_status = 'active'"


def valid_items(t: Tables) -> DataFrame:
    return t.listings.filter("ad_status = 'active'").select("item_id")


def scored(df: DataFrame) -> DataFrame:
    return df.select("user_id", "item_id", F.round(F.col("score").cast("double"), 6).alias("score"), "rank")


@query(
    "g1_popularity",
    "SELECT item_id, contacts_24h * 10 + views_24h AS pop_score, CAST(row_number() OVER (ORDER BY contacts_24h * 10 + views_24h DESC NULLS LAST, item_id) AS INTEGER) AS rank FROM fact_listing_snapshot QUALIFY rank <= 100",
)
def g1_popularity(t: Tables) -> DataFrame:
    return c.popularity(t.snapshots, 100)


TREND = """
    l AS (SELECT item_id, coalesce(sum(lead_count) FILTER (WHERE date >= DATE '2026-04-02'), 0)::BIGINT AS recent_leads, coalesce(sum(lead_count) FILTER (WHERE date < DATE '2026-04-02'), 0)::BIGINT AS prior_leads
          FROM fact_post_contact_interactions WHERE date >= DATE '2026-03-10' AND lead_count > 0 GROUP BY 1),
    trend AS (SELECT l.*, recent_leads * 3.0::DOUBLE + recent_leads / (prior_leads / 7.0::DOUBLE + 1.0::DOUBLE) AS trend_score, city_name, category, seller_type FROM l LEFT JOIN dim_listing USING (item_id))
"""


@query("g2_burst_trend", f"WITH {TREND} SELECT item_id, recent_leads, prior_leads, round(trend_score, 6) AS trend_score, city_name, category, seller_type FROM trend")
def g2_burst_trend(t: Tables) -> DataFrame:
    return c.burst_trend(t.pci, t.listings, CUTOFF).withColumn("trend_score", F.round("trend_score", 6))


@query(
    "g2_trend_by_city_category",
    f"WITH {TREND} SELECT city_name, category, item_id, CAST(row_number() OVER (PARTITION BY city_name, category ORDER BY trend_score DESC, item_id) AS INTEGER) AS rank FROM trend WHERE city_name IS NOT NULL AND category IS NOT NULL QUALIFY rank <= 50",
)
def g2_trend_by_city_category(t: Tables) -> DataFrame:
    trend = c.burst_trend(t.pci, t.listings, CUTOFF).filter("city_name is not null and category is not null")
    return c.best(trend, ["city_name", "category"], [F.col("trend_score").desc(), F.col("item_id")], 50).select("city_name", "category", "item_id", "rank")


def fair_sql(by: str, k: int, where: str = "") -> str:
    """Agents and private sellers in turn: places of the queues from the sizes of the groups."""
    return f"""WITH {TREND}, q AS (SELECT *, CASE WHEN seller_type = 'agent' THEN 0 WHEN seller_type IS NOT NULL THEN 1 ELSE 2 END AS kind FROM (SELECT *, 'all' AS level FROM trend) {where}),
        o AS (SELECT {by}, item_id, kind, row_number() OVER (PARTITION BY {by}, kind ORDER BY trend_score DESC, item_id) AS place FROM q QUALIFY place <= {k}),
        z AS (SELECT *, count(*) FILTER (WHERE kind = 0) OVER (PARTITION BY {by}) AS agents, count(*) FILTER (WHERE kind = 1) OVER (PARTITION BY {by}) AS private FROM o),
        r AS (SELECT {by}, item_id, CASE kind WHEN 0 THEN least(CASE WHEN place = 1 THEN 1 ELSE floor(round((place - 1) / 0.52::DOUBLE, 9)) + 2 END, place + private)
              WHEN 1 THEN least(CASE WHEN place = 1 THEN 2 ELSE ceil(round((place - 1) / 0.48::DOUBLE, 9)) + 1 END, place + agents) ELSE place + agents + private END::BIGINT AS rank FROM z)
        SELECT {by}, item_id, rank FROM r WHERE rank <= {k}"""


@query("g2b_fair_by_city", fair_sql("city_name", 100, "WHERE city_name IS NOT NULL"))
def g2b_fair_by_city(t: Tables) -> DataFrame:
    return c.fair_top(c.burst_trend(t.pci, t.listings, CUTOFF).filter("city_name is not null"), ["city_name"], 100)


@query("g2b_fair_global", fair_sql("level", 300))
def g2b_fair_global(t: Tables) -> DataFrame:
    return c.fair_top(c.burst_trend(t.pci, t.listings, CUTOFF), [], 300)


TREND_LEVELS = {"cc": ["city_name", "category"], "city": ["city_name"], "cat": ["category"], "global": []}
TREND_SHOWN = 10


@query(
    "g2c_trend_lookup",
    "WITH "
    + TREND
    + ", e AS (SELECT DISTINCT item_id FROM contact_pairs WHERE user_id IS NOT NULL AND last_date > DATE '2026-04-02'), w AS (SELECT DISTINCT city_name AS pref_city, category AS pref_cat FROM dim_listing), b AS ("
    + " UNION ALL ".join(
        f"SELECT pref_city, pref_cat, item_id, {i} AS level, trend_score FROM w, trend WHERE item_id NOT IN (SELECT item_id FROM e) {''.join(f' AND trend.{c} = w.{p}' for c, p in (('city_name', 'pref_city'), ('category', 'pref_cat')) if c in cols)} QUALIFY row_number() OVER (PARTITION BY pref_city, pref_cat ORDER BY trend_score DESC, item_id) <= {TREND_SHOWN}"
        for i, cols in enumerate(TREND_LEVELS.values())
    )
    + "), o AS (SELECT pref_city, pref_cat, item_id, min(level) AS level, any_value(trend_score) AS trend_score FROM b GROUP BY 1, 2, 3)"
    + f" SELECT pref_city, pref_cat, item_id, CAST(row_number() OVER (PARTITION BY pref_city, pref_cat ORDER BY level, trend_score DESC, item_id) AS INTEGER) AS rank FROM o QUALIFY rank <= {TREND_SHOWN}",
)
def g2c_trend_lookup(t: Tables) -> DataFrame:
    """Ten trending items for every city and category asked for: from both, else the city, the category, all; items contacted in the last week are left out."""
    contacted = t.contact_pairs.filter("user_id is not null and last_date > date'2026-04-02'").select("item_id").distinct()
    trend = c.burst_trend(t.pci, t.listings, CUTOFF).join(contacted, "item_id", "left_anti")
    wanted = t.listings.select(F.col("city_name").alias("pref_city"), F.col("category").alias("pref_cat")).distinct()
    return c.trend_lookup(trend, wanted, TREND_LEVELS, TREND_SHOWN)


def segment_sql(weights: str) -> str:
    """Five levels by hand; weights selects item_id, city_name, category, district_name, w."""
    parts = []
    for level, cols in c.LEVELS.items():
        shown = ", ".join(x if x in cols else f"CAST(NULL AS {'BIGINT' if x == 'category' else 'VARCHAR'}) AS {x}" for x in ("city_name", "category", "district_name"))
        keys = ", ".join([*cols, "item_id"])
        where = " AND ".join(["item_id IS NOT NULL", *[f"{x} IS NOT NULL" for x in cols]])
        over = f"PARTITION BY {', '.join(cols)} " if cols else ""
        parts.append(
            f"SELECT '{level}' AS level, {shown}, item_id, n, CAST(row_number() OVER ({over}ORDER BY n DESC, item_id) AS INTEGER) AS rank FROM (SELECT {keys}, sum(w)::BIGINT AS n FROM w WHERE {where} GROUP BY {keys}) QUALIFY rank <= {CAPS[level]}"
        )
    return f"w AS ({weights}), seg AS (" + " UNION ALL ".join(parts) + ")"


PAIR_WEIGHTS = "SELECT p.item_id, p.city_name, p.category, l.district_name, p.count AS w FROM contact_pairs p LEFT JOIN dim_listing l USING (item_id)"


def segments(t: Tables) -> DataFrame:
    return c.segment_popularity(c.pair_rows(t.contact_pairs, t.listings), CAPS)


@query("g3_segment_popularity", f"WITH {segment_sql(f'SELECT e.item_id, e.city_name, e.category, l.district_name, 1 AS w FROM fact_user_events e JOIN ({VALID_SQL}) USING (item_id) LEFT JOIN dim_listing l USING (item_id) WHERE {LOGIN} AND event_type IN {GT}')} SELECT * FROM seg")
def g3_segment_popularity(t: Tables) -> DataFrame:
    return c.segment_popularity(c.positive_rows(t.events, t.listings), CAPS, valid_items(t))


@query("g3b_segment_popularity_of_pairs", f"WITH {segment_sql(PAIR_WEIGHTS)} SELECT * FROM seg")
def g3b_segment_popularity_of_pairs(t: Tables) -> DataFrame:
    return segments(t)


@query(
    "g3c_blind_items",
    "SELECT item_id, score, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM (SELECT item_id, (coalesce(sum(contacts_24h), 0) * 20 + coalesce(sum(views_24h), 0))::BIGINT AS score FROM fact_listing_snapshot GROUP BY 1) QUALIFY rank <= 500",
)
def g3c_blind_items(t: Tables) -> DataFrame:
    return c.blind_items(t.snapshots, 500)


@query(
    "g3c_blind_items_of_averages",
    SNAPSHOT_STATS
    + "SELECT item_id, round(score, 4) AS score, CAST(row_number() OVER (ORDER BY round(score, 4) DESC, item_id) AS INTEGER) AS rank FROM (SELECT item_id, coalesce(item_avg_contacts_7d, 0) * 20 + coalesce(item_avg_views_7d, 0) AS score FROM snapshot_stats) QUALIFY rank <= 500",
)
def g3c_blind_items_of_averages(t: Tables) -> DataFrame:
    stats = cleaning.snapshot_stats(t.snapshots).withColumns({x: F.round(x, 6) for x in ("item_avg_contacts_7d", "item_avg_views_7d")})
    scores = c.blind_items(stats, 1 << 30).select("item_id", F.round("score", 4).alias("score"))
    return c.top(scores, [F.col("score").desc(), F.col("item_id")], 500)


def prefs(t: Tables) -> DataFrame:
    return cleaning.user_prefs(t.contact_pairs, cleaning.cold_user_prefs(t.events))


@query(
    "g3d_segment_items",
    f"""WITH {COLD_PREFS}, {USER_PREFS}, {segment_sql(PAIR_WEIGHTS)}, q AS (SELECT DISTINCT pref_city, pref_cat FROM user_prefs),
        a AS (SELECT pref_city, pref_cat, item_id, 1 AS p, rank AS r FROM q JOIN seg ON level = 'cc' AND pref_city = city_name AND pref_cat = category
              UNION ALL SELECT pref_city, pref_cat, item_id, 2, rank FROM q JOIN seg ON level = 'city' AND pref_city = city_name
              UNION ALL SELECT pref_city, pref_cat, item_id, 3, rank FROM q JOIN seg ON level = 'cat' AND pref_cat = category
              UNION ALL SELECT pref_city, pref_cat, item_id, 4, rank FROM q, seg WHERE level = 'global'),
        o AS (SELECT pref_city, pref_cat, item_id, min(p * 1000 + r) AS pos FROM a GROUP BY 1, 2, 3)
        SELECT pref_city, pref_cat, item_id, CAST(row_number() OVER (PARTITION BY pref_city, pref_cat ORDER BY pos, item_id) AS INTEGER) AS rank FROM o QUALIFY rank <= 10""",
)
def g3d_segment_items(t: Tables) -> DataFrame:
    return c.segment_items(segments(t), prefs(t), 10)


def blind_shares(t: Tables, n: int = 10) -> list[tuple[tuple[str, int], float]]:
    """The n largest city and category segments with their share of contacts."""
    sums = t.contact_pairs.filter("city_name is not null and category is not null").groupBy("city_name", "category").agg(F.sum("count").alias("n"))
    total = sums.agg(F.sum("n")).scalar()
    rows = sums.withColumn("share", F.col("n") / total).orderBy(F.col("n").desc(), "city_name", "category").limit(n).collect()
    return [((r["city_name"], r["category"]), r["share"]) for r in rows]


@query("g3e_blind_rotation")
def g3e_blind_rotation(t: Tables) -> DataFrame:
    """Ten items for every user without preferences, started at a place of their own."""
    blind = t.events.select("user_id").filter("user_id is not null").distinct().join(prefs(t), "user_id", "left_anti")
    return c.rotated(blind, c.blind_list(segments(t), blind_shares(t), 10), 10)


@query(
    "g4_pageview_replay",
    f"""WITH s AS (SELECT user_id, item_id, sum(CASE WHEN event_type IN {GT} THEN 10 ELSE 1 END)::DOUBLE AS score, max(event_ts) AS last_event FROM fact_user_events
        WHERE event_ts BETWEEN TIMESTAMP '2026-03-26' AND TIMESTAMP '2026-04-09' AND user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY 1, 2)
        SELECT user_id, item_id, score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, last_event DESC, item_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 50""",
)
def g4_pageview_replay(t: Tables) -> DataFrame:
    return scored(c.pageview_replay(t.events, CUTOFF))


GRAPH = """
    rec AS (SELECT DISTINCT user_id, item_id FROM contact_pairs WHERE last_date > DATE '2026-03-10' AND user_id IS NOT NULL AND item_id IS NOT NULL),
    line AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS pos FROM rec WHERE user_id IN (SELECT user_id FROM rec GROUP BY 1 HAVING count(*) BETWEEN 2 AND 100)),
    near AS (SELECT a.item_id AS x, b.item_id AS y, count(*) AS n FROM line a JOIN line b ON a.user_id = b.user_id AND b.pos > a.pos AND b.pos - a.pos <= 19 GROUP BY 1, 2),
    both_ways AS (SELECT x AS item_id, y AS co_item_id, n FROM near UNION ALL SELECT y, x, n FROM near),
    graph AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY n DESC, co_item_id) AS INTEGER) AS rank FROM both_ways QUALIFY rank <= 50)
"""


@query("g5_cocontact_graph", f"WITH {GRAPH} SELECT * FROM graph")
def g5_cocontact_graph(t: Tables) -> DataFrame:
    return c.cocontact_graph(t.contact_pairs, CUTOFF)


HISTORY = "hist AS (SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY last_date DESC NULLS LAST, item_id, city_name NULLS FIRST, category NULLS FIRST, count DESC) AS INTEGER) AS rank FROM contact_pairs WHERE user_id IS NOT NULL QUALIFY rank <= 20)"


@query(
    "g5b_cocontact",
    f"""WITH {GRAPH}, {HISTORY}, v AS (SELECT h.user_id, g.co_item_id AS item_id, sum(g.n)::DOUBLE AS score FROM hist h JOIN graph g ON g.item_id = h.item_id WHERE h.rank <= 10 AND g.rank <= 10
        AND NOT EXISTS (SELECT 1 FROM contact_pairs p WHERE p.user_id = h.user_id AND p.item_id = g.co_item_id) GROUP BY 1, 2)
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM v QUALIFY rank <= 10""",
)
def g5b_cocontact(t: Tables) -> DataFrame:
    return scored(c.cocontact(c.user_history(t.contact_pairs), c.cocontact_graph(t.contact_pairs, CUTOFF), t.contact_pairs.filter("user_id is not null"), 10))


def recent_views(t: Tables, days: int = 14) -> DataFrame:
    start = F.lit((CUTOFF - timedelta(days=days)).isoformat()).cast("timestamp_ntz")
    return t.events.filter((F.col("event_type") == "pageview") & (F.col("event_ts") >= start) & F.col("user_id").isNotNull())


INTENT = """
    known AS (SELECT * FROM dim_listing WHERE ad_status = 'active'),
    seen AS (SELECT e.user_id, k.* FROM fact_user_events e JOIN known k USING (item_id) WHERE e.event_type = 'pageview' AND e.event_ts >= TIMESTAMP '2026-03-26' AND e.user_id IS NOT NULL),
    i1 AS (SELECT user_id, district_name, category, price_bucket FROM seen GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, district_name NULLS FIRST, category NULLS FIRST, price_bucket NULLS FIRST) = 1),
    i2 AS (SELECT user_id, city_name, category FROM seen GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, city_name NULLS FIRST, category NULLS FIRST) = 1),
    f1 AS (SELECT *, row_number() OVER (PARTITION BY district_name, category, price_bucket ORDER BY posted_date DESC NULLS LAST, item_id) AS r FROM known),
    f2 AS (SELECT *, row_number() OVER (PARTITION BY city_name, category ORDER BY posted_date DESC NULLS LAST, item_id) AS r FROM known),
    lists AS (SELECT user_id, item_id, r AS pos FROM i1 JOIN f1 ON i1.district_name IS NOT DISTINCT FROM f1.district_name AND i1.category IS NOT DISTINCT FROM f1.category AND i1.price_bucket IS NOT DISTINCT FROM f1.price_bucket
              UNION ALL SELECT user_id, item_id, 1000000000 + r FROM i2 JOIN f2 ON i2.city_name IS NOT DISTINCT FROM f2.city_name AND i2.category IS NOT DISTINCT FROM f2.category),
    once AS (SELECT user_id, item_id, min(pos) AS pos FROM lists l WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = l.user_id AND h.item_id = l.item_id) GROUP BY 1, 2)
"""


@query(
    "g6_intent",
    f"WITH {HISTORY}, {INTENT} SELECT user_id, item_id, CAST(11 - row_number() OVER o AS DOUBLE) AS score, CAST(row_number() OVER o AS INTEGER) AS rank FROM once WINDOW o AS (PARTITION BY user_id ORDER BY pos, item_id) QUALIFY row_number() OVER o <= 10",
)
def g6_intent(t: Tables) -> DataFrame:
    return scored(c.intent(recent_views(t), t.listings, valid_items(t), 10, c.user_history(t.contact_pairs)))


#: Users asked about: one in four by a stable hash of the id. The other users are their possible neighbours.
def knn_queries(t: Tables) -> DataFrame:
    return t.contact_pairs.filter("user_id is not null").select("user_id").distinct().filter(c.stable_bucket(F.col("user_id"), 4) == 0)


PAIRS = "rows AS (SELECT user_id, item_id, max(last_date) AS last_date FROM contact_pairs WHERE count > 0 AND user_id IS NOT NULL GROUP BY 1, 2)"


@query(
    "g7_user_knn",
    f"""WITH {PAIRS}, q AS (SELECT DISTINCT user_id FROM rows WHERE CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 4 = 0),
        items AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY last_date DESC NULLS LAST, item_id) AS pos FROM rows QUALIFY pos <= 30),
        nb AS (SELECT item_id, user_id AS neighbour, row_number() OVER (PARTITION BY item_id ORDER BY last_date DESC NULLS LAST, user_id) AS place FROM rows WHERE user_id NOT IN (SELECT user_id FROM q) QUALIFY place <= 30),
        mine AS (SELECT * FROM items WHERE user_id IN (SELECT user_id FROM q)),
        v AS (SELECT m.user_id, i.item_id, count(*)::DOUBLE AS score FROM mine m JOIN nb USING (item_id) JOIN items i ON i.user_id = nb.neighbour WHERE m.pos <= 5
              AND NOT EXISTS (SELECT 1 FROM mine x WHERE x.user_id = m.user_id AND x.item_id = i.item_id) GROUP BY 1, 2)
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM v QUALIFY rank <= 10""",
)
def g7_user_knn(t: Tables) -> DataFrame:
    return scored(c.user_knn(t.contact_pairs, knn_queries(t), 10))


@query(
    "g8_seller_expansion",
    f"""WITH {PAIRS}, line AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_date DESC NULLS LAST, item_id) AS pos FROM rows),
        met AS (SELECT user_id, seller_id, min(pos) AS pos FROM line JOIN dim_listing USING (item_id) WHERE pos <= 15 AND seller_id IS NOT NULL GROUP BY 1, 2),
        stock AS (SELECT seller_id, item_id, row_number() OVER (PARTITION BY seller_id ORDER BY item_id) AS place FROM dim_listing WHERE ad_status = 'active' AND seller_id IS NOT NULL QUALIFY place <= 10),
        v AS (SELECT user_id, item_id, round(max(1.0::DOUBLE / pos), 6) AS score, max(1.0::DOUBLE / pos) AS s FROM met JOIN stock USING (seller_id) WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE r.user_id = met.user_id AND r.item_id = stock.item_id) GROUP BY 1, 2)
        SELECT user_id, item_id, score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY s DESC, item_id) AS INTEGER) AS rank FROM v QUALIFY rank <= 10""",
)
def g8_seller_expansion(t: Tables) -> DataFrame:
    return scored(c.seller_expansion(t.contact_pairs, t.listings, valid_items(t), 10))


RECENT_CC = "recent_cc AS (SELECT city_name, category, item_id, count(*) AS n, CAST(row_number() OVER (PARTITION BY city_name, category ORDER BY count(*) DESC, item_id) AS INTEGER) AS rank FROM contact_pairs WHERE last_date > DATE '2026-04-02' AND city_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3 QUALIFY rank <= 200)"


@query("g9_recent_by_segment", f"WITH {RECENT_CC} SELECT * FROM recent_cc")
def g9_recent_by_segment(t: Tables) -> DataFrame:
    return c.recent_by_segment(t.contact_pairs, CUTOFF)


@query("g10_user_history", f"WITH {HISTORY} SELECT * FROM hist")
def g10_user_history(t: Tables) -> DataFrame:
    return c.user_history(t.contact_pairs)


I2I = f"""
    s AS (SELECT DISTINCT session_id, item_id FROM fact_user_events WHERE {LOGIN} AND session_id IS NOT NULL AND event_type IN ('pageview', 'view_phone', 'contact_chat', 'contact_zalo', 'contact_sms')),
    kept AS (SELECT * FROM s WHERE session_id IN (SELECT session_id FROM s GROUP BY 1 HAVING count(*) BETWEEN 2 AND 50) AND item_id IN ({VALID_SQL})),
    co AS (SELECT a.item_id AS x, b.item_id AS y, count(*) AS n FROM kept a JOIN kept b ON a.session_id = b.session_id AND a.item_id < b.item_id GROUP BY 1, 2 HAVING count(*) >= 3),
    i2i AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY n DESC, similar_id) AS INTEGER) AS rank FROM (SELECT x AS item_id, y AS similar_id, n FROM co UNION ALL SELECT y, x, n FROM co) QUALIFY rank <= 50)
"""


@query("g11_item2item_graph", f"WITH {I2I} SELECT * FROM i2i")
def g11_item2item_graph(t: Tables) -> DataFrame:
    return c.item2item_graph(t.events, valid_items(t))


@query(
    "g11b_item2item",
    f"""WITH {COLD_PREFS}, {USER_PREFS}, {HISTORY}, {I2I},
        v AS (SELECT h.user_id, similar_id AS item_id, sum(n * CASE WHEN pref_city IS NULL THEN 1.0::DOUBLE WHEN l.city_name = pref_city THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END) AS score
              FROM hist h JOIN i2i g ON g.item_id = h.item_id LEFT JOIN user_prefs p ON p.user_id = h.user_id LEFT JOIN dim_listing l ON l.item_id = similar_id
              WHERE NOT EXISTS (SELECT 1 FROM hist x WHERE x.user_id = h.user_id AND x.item_id = similar_id) GROUP BY 1, 2)
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM v QUALIFY rank <= 10""",
)
def g11b_item2item(t: Tables) -> DataFrame:
    history = c.user_history(t.contact_pairs)
    return scored(c.item2item(history, c.item2item_graph(t.events, valid_items(t)), t.listings, prefs(t), history, 10))

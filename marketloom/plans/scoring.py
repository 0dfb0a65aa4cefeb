"""Queries of features, rules, models and metrics."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.constants import CUTOFF
from marketloom.operators import candidates as c
from marketloom.operators import cleaning, features, learned, metrics, rules
from marketloom.plans import candidates as cq
from marketloom.plans.cleaning import COLD_PREFS, GT, LOGIN, SNAPSHOT_STATS, USER_PREFS, mode_sql, rounded
from marketloom.plans.registry import Registry
from marketloom.session import cut_lineage
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query

SPLIT = date(2026, 4, 2)

BEHAVIOR = f"""
    known AS (SELECT p.*, l.price_bucket, l.ad_type FROM contact_pairs p LEFT JOIN dim_listing l USING (item_id) WHERE user_id IS NOT NULL),
    behavior AS (SELECT u.user_id, u.event_count, u.contact_rate, a.city_name AS pref_city, b.category AS pref_cat, d.price_bucket AS pref_price, e.ad_type AS pref_ad_type
        FROM (SELECT user_id, count(*) AS event_count, sum(count) / count(*)::DOUBLE AS contact_rate FROM known GROUP BY 1) u
        LEFT JOIN {mode_sql("known", "user_id", "city_name")} a USING (user_id) LEFT JOIN {mode_sql("known", "user_id", "category")} b USING (user_id)
        LEFT JOIN {mode_sql("known", "user_id", "price_bucket")} d USING (user_id) LEFT JOIN {mode_sql("known", "user_id", "ad_type")} e USING (user_id))
"""


@query("x1_user_behavior", f"WITH {BEHAVIOR} SELECT * REPLACE (round(contact_rate, 6) AS contact_rate) FROM behavior")
def x1_user_behavior(t: Tables) -> DataFrame:
    return rounded(features.user_behavior(t.contact_pairs, t.listings), "contact_rate")


ITEM_STATS = f"""
    cc AS (SELECT item_id, sum(count)::BIGINT AS item_total_contacts, coalesce(sum(count) FILTER (WHERE last_date > DATE '2026-04-02'), 0)::BIGINT AS item_recent_contacts FROM contact_pairs GROUP BY 1),
    vv AS (SELECT item_id, count(*) AS item_total_views FROM fact_user_events WHERE {LOGIN} AND event_type = 'pageview' GROUP BY 1),
    fv AS (SELECT item_id, coalesce(item_total_contacts, 0) AS item_total_contacts, coalesce(item_recent_contacts, 0) AS item_recent_contacts, coalesce(item_total_views, 0) AS item_total_views FROM cc FULL JOIN vv USING (item_id) WHERE item_id IS NOT NULL),
    item_stats AS (SELECT *, item_recent_contacts / (item_total_contacts + 1e-6::DOUBLE) AS item_recency, 1 - (row_number() OVER (ORDER BY item_total_contacts DESC, item_id) - 1) / count(*) OVER ()::DOUBLE AS item_novelty FROM fv)
"""


@query("x2_item_stats", f"WITH {ITEM_STATS} SELECT * REPLACE (round(item_recency, 6) AS item_recency, round(item_novelty, 6) AS item_novelty) FROM item_stats")
def x2_item_stats(t: Tables) -> DataFrame:
    return rounded(features.item_stats(t.contact_pairs, cleaning.pageview_pairs(t.events), SPLIT), "item_recency", "item_novelty")


QUALITY = """
    SELECT item_id, coalesce(city_name, 'Unknown') AS item_city, category AS item_cat, coalesce(images_count, 0)::DOUBLE AS item_photos,
        ((coalesce(images_count, 0) > 5)::INT + (area_sqm IS NOT NULL)::INT + (bedrooms IS NOT NULL)::INT + (bathrooms IS NOT NULL)::INT)::DOUBLE AS item_completeness,
        coalesce(regexp_matches(legal_status, 'sổ hồng|sổ đỏ', 'i'), false)::INT::DOUBLE AS item_has_so_hong, (project_id IS NOT NULL)::INT::DOUBLE AS item_is_apartment,
        coalesce(lower(seller_type) = 'agent', false)::INT::DOUBLE AS item_is_agent, coalesce(regexp_matches(furnishing, 'cao cấp', 'i'), false)::INT::DOUBLE AS item_has_noi_that_cao_cap,
        price_bucket AS item_price, ad_type AS item_ad_type, CASE WHEN posted_date IS NOT NULL THEN greatest(datediff('day', posted_date, DATE '2026-04-02'), 0)::DOUBLE END AS listing_age_days FROM dim_listing
"""


@query("x3_item_quality", QUALITY)
def x3_item_quality(t: Tables) -> DataFrame:
    return features.item_quality(t.listings, SPLIT)


PAIRS = "pairs AS (SELECT DISTINCT user_id, item_id FROM contact_pairs WHERE user_id IS NOT NULL)"


def pairs(t: Tables) -> DataFrame:
    return t.contact_pairs.filter("user_id is not null").select("user_id", "item_id").distinct()


@query(
    "x4_snapshot_features",
    SNAPSHOT_STATS
    + f", {PAIRS} SELECT user_id, item_id, "
    + ", ".join(f"coalesce({x}, 0) AS {x}" for x in features.SNAPSHOT_COLUMNS)
    + " FROM pairs LEFT JOIN snapshot_stats USING (item_id)",
)
def x4_snapshot_features(t: Tables) -> DataFrame:
    return rounded(features.with_snapshot(pairs(t), cleaning.snapshot_stats(t.snapshots)), *features.SNAPSHOT_COLUMNS)


@query(
    "x5_preference_matches",
    f"""WITH {BEHAVIOR}, {PAIRS}, q AS ({QUALITY}) SELECT p.user_id, p.item_id, coalesce((item_city = pref_city)::INT, 0) AS match_city, coalesce((item_cat = pref_cat)::INT, 0) AS match_cat,
        coalesce((item_price = pref_price)::INT, 0) AS match_price, coalesce((item_ad_type = pref_ad_type)::INT, 0) AS match_ad_type FROM pairs p LEFT JOIN behavior USING (user_id) LEFT JOIN q USING (item_id)""",
)
def x5_preference_matches(t: Tables) -> DataFrame:
    joined = pairs(t).join(features.user_behavior(t.contact_pairs, t.listings), "user_id", "left").join(features.item_quality(t.listings), "item_id", "left")
    return features.with_matches(joined).select("user_id", "item_id", *features.MATCHES)


HISTORY = cq.HISTORY


@query("x6_recent_history", f"WITH {HISTORY}, {PAIRS}, s AS (SELECT user_id, item_id, max(200.0::DOUBLE - 10 * (rank - 1)) AS score_prev FROM hist WHERE rank <= 5 GROUP BY 1, 2) SELECT user_id, item_id, coalesce(score_prev, 0) AS score_prev FROM pairs LEFT JOIN s USING (user_id, item_id)")
def x6_recent_history(t: Tables) -> DataFrame:
    return features.with_recent_history(pairs(t), c.user_history(t.contact_pairs))


@query(
    "x7_seller_affinity",
    f"""WITH {BEHAVIOR}, {HISTORY}, {cq.GRAPH}, met AS (SELECT DISTINCT user_id, seller_id FROM contact_pairs JOIN dim_listing USING (item_id) WHERE seller_id IS NOT NULL AND user_id IS NOT NULL),
        g AS (SELECT user_id, item_id FROM (SELECT user_id, co_item_id AS item_id FROM (SELECT * FROM hist WHERE rank <= 3) h JOIN graph USING (item_id)) GROUP BY 1, 2)
        SELECT g.user_id, g.item_id, coalesce(max(CASE WHEN m.seller_id IS NOT NULL THEN CASE WHEN l.city_name = b.pref_city THEN 30.0::DOUBLE ELSE 4.5::DOUBLE END END), 0) AS score_seller
        FROM g LEFT JOIN behavior b USING (user_id) LEFT JOIN dim_listing l USING (item_id) LEFT JOIN met m ON m.user_id = g.user_id AND m.seller_id = l.seller_id GROUP BY 1, 2""",
)
def x7_seller_affinity(t: Tables) -> DataFrame:
    """Over the neighbours of each user's three latest contacts."""
    near = c.cocontact_graph(t.contact_pairs, CUTOFF).select("item_id", "co_item_id")
    cand = c.user_history(t.contact_pairs).filter("rank <= 3").join(near, "item_id").select("user_id", F.col("co_item_id").alias("item_id")).distinct()
    prefs = features.user_behavior(t.contact_pairs, t.listings).select("user_id", "pref_city")
    return features.with_seller_affinity(cand.join(prefs, "user_id", "left"), t.contact_pairs, t.listings).select("user_id", "item_id", "score_seller")


@query("x8_collaborative")
def x8_collaborative(t: Tables) -> DataFrame:
    """Factorisation ranks turned into a score, with a boost in the user's city."""
    users = t.contact_pairs.filter("user_id is not null")
    known = learned.als_top(cleaning.weighted_contact_scores(t.events), users, 300, cq.valid_items(t), about_users=cq.prefs(t).select("user_id", "pref_city"), about_items=t.listings.select("item_id", "city_name"))
    return features.collaborative_score(known.withColumn("same", F.coalesce(F.col("city_name") == F.col("pref_city"), F.lit(False))), "same").select("user_id", "item_id", "rank", F.round("score_als", 6).alias("score_als"))


@query(
    "x9_segment_scores",
    f"""WITH {COLD_PREFS}, {USER_PREFS}, {cq.segment_sql(cq.PAIR_WEIGHTS)},
        a AS (SELECT user_id, item_id, greatest(3.0::DOUBLE - 0.01 * (rank - 1), 0.1) AS s FROM user_prefs JOIN seg ON level = 'cc' AND rank <= 30 AND pref_city = city_name AND pref_cat = category),
        f AS (SELECT city_name, category, count(*) AS first FROM seg WHERE level = 'cc' AND rank <= 30 GROUP BY 1, 2),
        b AS (SELECT user_id, item_id, greatest(2.0::DOUBLE - 0.01 * (coalesce(first, 0) + rank - 1), 0.1) AS s FROM user_prefs JOIN seg ON level = 'city' AND rank <= 20 AND pref_city = seg.city_name LEFT JOIN f ON f.city_name = pref_city AND f.category = pref_cat),
        g AS (SELECT user_id, item_id, 1.0::DOUBLE AS s FROM user_prefs, seg WHERE level = 'global' AND rank <= 20)
        SELECT user_id, item_id, round(sum(s), 6) AS score_segpop FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM g) GROUP BY 1, 2""",
)
def x9_segment_scores(t: Tables) -> DataFrame:
    return rounded(features.segment_scores(cq.prefs(t), cq.segments(t)), "score_segpop")


FEATURES = [
    "event_count", "contact_rate", "item_total_contacts", "item_total_views", "item_recent_contacts", "item_recency", "item_novelty", "item_photos", "item_completeness", "item_has_so_hong",
    "item_is_apartment", "item_is_agent", "item_has_noi_that_cao_cap", "listing_age_days", *features.SNAPSHOT_COLUMNS, *features.MATCHES, "score_prev", "score_seller",
]


def feature_table(t: Tables, pairs: DataFrame, until: date) -> DataFrame:
    """Features of (user_id, item_id) from what was known up to a day."""
    return features_until(t, until, partial(features.training_table, pairs))


def features_until(t: Tables, until: date, joined: Callable):
    """What joined makes of the tables of features of what was known up to a day."""
    day = F.lit(until.isoformat()).cast("date")
    before = t.contact_pairs.filter(F.col("last_date") <= day)
    return joined(
        features.user_behavior(before, t.listings), features.item_stats(before, cleaning.pageview_pairs(t.events.filter(F.col("date") <= day)), until),
        features.item_quality(t.listings, until), cleaning.snapshot_stats(t.snapshots.filter(F.col("date") <= day)), before, c.user_history(before), t.listings,
    )


def training_rows(t: Tables, chosen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Contacts up to the split and their co-contacted neighbours, labelled by contacts after it, with features from before it.

    chosen takes (user_id, item_id, label) and gives those rows of them that features are wanted for.
    """
    split = F.lit(SPLIT.isoformat()).cast("date")
    before = t.contact_pairs.filter(F.col("last_date") <= split)
    after = t.contact_pairs.filter((F.col("last_date") > split) & F.col("user_id").isNotNull()).select("user_id", "item_id").distinct().withColumn("label", F.lit(1.0))
    near = c.cocontact_graph(before, SPLIT).filter("rank <= 20").select("item_id", "co_item_id")
    cand = c.user_history(before).filter("rank <= 5").join(near, "item_id").select("user_id", F.col("co_item_id").alias("item_id")).union(after.select("user_id", "item_id")).distinct()
    labelled = lambda rows: rows.join(after, ["user_id", "item_id"], "left").fillna(0.0, ["label"])
    if chosen is not None:
        return feature_table(t, cut_lineage(chosen(labelled(cand))), SPLIT)
    return labelled(feature_table(t, cand, SPLIT))


#: Classes of a pair's outcome, from what is worth least; each stands at the place of its worth in learned.OUTCOME_VALUES.
OUTCOMES = {"other_interaction": 2, "view_phone": 1, "contact_sms": 4, "contact_zalo": 4, "contact_chat": 3}


@query(
    "l1_outcomes",
    "WITH k AS (SELECT user_id, item_id, max(CASE event_type "
    + " ".join(f"WHEN '{kind}' THEN {i + 1}" for i, kind in enumerate(OUTCOMES))
    + f" END) AS place FROM fact_user_events WHERE date > DATE '{SPLIT.isoformat()}' AND user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY 1, 2) SELECT user_id, item_id, CASE place "
    + " ".join(f"WHEN {i + 1} THEN {code}.0::DOUBLE" for i, code in enumerate(OUTCOMES.values()))
    + " END AS outcome FROM k WHERE place IS NOT NULL",
)
def l1_outcomes(t: Tables) -> DataFrame:
    """What became of each pair after the split: its event that is worth most."""
    late = t.events.filter((F.col("date") > F.lit(SPLIT.isoformat()).cast("date")) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    place = F.create_map(*[F.lit(x) for i, kind in enumerate(OUTCOMES) for x in (kind, i + 1)])[F.col("event_type")]
    best_of = late.groupBy("user_id", "item_id").agg(F.max(place).alias("place")).filter("place is not null")
    code = F.array(*[F.lit(float(x)) for x in OUTCOMES.values()])
    return best_of.select("user_id", "item_id", F.element_at(code, F.col("place")).alias("outcome"))


@query("x12_training_table")
def x12_training_table(t: Tables) -> DataFrame:
    return training_rows(t).select("user_id", "item_id", "label", *[F.round(F.col(f).cast("double"), 6).alias(f) for f in FEATURES])


@query("x12_scored_union")
def x12_scored_union(t: Tables) -> DataFrame:
    """Segment and history scores side by side, the 300 best of a user."""
    seg = features.segment_scores(cq.prefs(t), cq.segments(t))
    prev = features.with_recent_history(pairs(t), c.user_history(t.contact_pairs)).filter("score_prev > 0")
    return features.scored_union([(seg, "score_segpop"), (prev, "score_prev")])


@query("x11_user_sellers", f"WITH {cq.PAIRS}, h AS (SELECT user_id, item_id FROM rows QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY last_date DESC NULLS LAST, item_id) <= 30) SELECT DISTINCT user_id, seller_id FROM h JOIN dim_listing USING (item_id) WHERE seller_id IS NOT NULL")
def x11_user_sellers(t: Tables) -> DataFrame:
    return features.context_tables(t.contact_pairs, cleaning.pageview_pairs(t.events), t.listings, cq.segments(t), SPLIT)["user_sellers"]


@query(
    "r1_quality",
    """SELECT item_id, round(least(greatest(CASE WHEN images_count BETWEEN 8 AND 12 THEN 1.4::DOUBLE WHEN images_count >= 5 THEN 1.1::DOUBLE WHEN images_count < 3 THEN 0.6::DOUBLE ELSE 1.0::DOUBLE END
        * (0.7::DOUBLE + 0.3::DOUBLE * ((area_sqm IS NOT NULL)::INT + (bedrooms IS NOT NULL)::INT + (bathrooms IS NOT NULL)::INT + (direction IS NOT NULL)::INT + (legal_status IS NOT NULL)::INT) / 5.0)
        * CASE WHEN legal_status IN ('Đã có sổ', 'Sổ hồng riêng') THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END * CASE WHEN length(title) < 20 THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END
        * CASE WHEN ad_type = 'let' AND furnishing = 'Nội thất đầy đủ' THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END, 0.3), 2.0), 6) AS quality_score FROM dim_listing""",
)
def r1_quality(t: Tables) -> DataFrame:
    return rounded(rules.quality(t.listings).select("item_id", "quality_score"), "quality_score")


@query(
    "r2_match",
    f"""WITH {BEHAVIOR}, {PAIRS}, bd AS (SELECT p.user_id, l.bedrooms FROM contact_pairs p JOIN dim_listing l USING (item_id) WHERE user_id IS NOT NULL), m AS {mode_sql("bd", "user_id", "bedrooms")}
        SELECT p.user_id, p.item_id, round(least(greatest(CASE WHEN l.category = b.pref_cat THEN 1.6::DOUBLE ELSE 0.4::DOUBLE END * CASE WHEN l.city_name = b.pref_city THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END
        * CASE WHEN l.bedrooms = m.bedrooms THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END, 0.2), 2.5), 6) AS match_score
        FROM pairs p JOIN dim_listing l USING (item_id) LEFT JOIN behavior b USING (user_id) LEFT JOIN m USING (user_id)""",
)
def r2_match(t: Tables) -> DataFrame:
    prefs = features.user_behavior(t.contact_pairs, t.listings).select("user_id", F.array("pref_cat").alias("user_top_categories"), F.col("pref_city").alias("user_top_city"))
    beds = c.best(t.contact_pairs.filter("user_id is not null").join(t.listings.filter("bedrooms is not null").select("item_id", "bedrooms"), "item_id").groupBy("user_id", "bedrooms").agg(F.count(F.lit(1)).alias("n")), ["user_id"], [F.col("n").desc(), F.col("bedrooms")], 1)
    joined = pairs(t).join(t.listings.select("item_id", "category", "city_name", "bedrooms"), "item_id").join(prefs, "user_id", "left").join(beds.select("user_id", F.col("bedrooms").alias("user_modal_bedrooms")), "user_id", "left")
    return rounded(rules.match(joined).select("user_id", "item_id", "match_score"), "match_score")


VIEW_TREND = """
    vt AS (SELECT item_id, coalesce(sum(views_24h) FILTER (WHERE date > DATE '2026-04-06'), 0)::BIGINT AS recent_3d_views, coalesce(sum(views_24h) FILTER (WHERE date BETWEEN DATE '2026-04-04' AND DATE '2026-04-06'), 0)::BIGINT AS older_3d_views,
           max(listing_age_days) AS listing_age_days FROM fact_listing_snapshot GROUP BY 1)
"""


@query(
    "r3_urgency",
    f"WITH {VIEW_TREND} SELECT item_id, round(least(greatest(exp(-0.03::DOUBLE * listing_age_days) * (1.0::DOUBLE + least(greatest((recent_3d_views - older_3d_views) / (older_3d_views + 1.0::DOUBLE), -0.5), 1.0)), 0.0), 2.0), 6) AS urgency_score FROM vt WHERE listing_age_days IS NOT NULL",
)
def r3_urgency(t: Tables) -> DataFrame:
    zero = lambda s: F.coalesce(s, F.lit(0))
    views = t.snapshots.groupBy("item_id").agg(
        zero(F.sum(F.when(F.col("date") > F.lit("2026-04-06").cast("date"), F.col("views_24h")))).alias("recent_3d_views"),
        zero(F.sum(F.when(F.col("date").between(F.lit("2026-04-04").cast("date"), F.lit("2026-04-06").cast("date")), F.col("views_24h")))).alias("older_3d_views"),
        F.max("listing_age_days").alias("listing_age_days"),
    )
    return rounded(rules.urgency(views.filter("listing_age_days is not null")).select("item_id", "urgency_score"), "urgency_score")


@query(
    "r4_value",
    """WITH m AS (SELECT category, city_name, avg(area_sqm) AS market_avg_price FROM dim_listing GROUP BY 1, 2)
       SELECT item_id, CASE WHEN area_sqm IS NOT NULL THEN round(least(greatest(1.0 / (area_sqm / (market_avg_price + 1e-10)), 0.5), 1.8), 6) END AS value_score FROM dim_listing l JOIN m ON l.category IS NOT DISTINCT FROM m.category AND l.city_name IS NOT DISTINCT FROM m.city_name""",
)
def r4_value(t: Tables) -> DataFrame:
    """The area stands in for the price, which the tables only hold in ranges."""
    market = t.listings.groupBy("category", "city_name").agg(F.avg("area_sqm").alias("market_avg_price"))
    a, m = t.listings.alias("a"), market.alias("m")
    joined = a.join(m, F.col("a.category").eqNullSafe(F.col("m.category")) & F.col("a.city_name").eqNullSafe(F.col("m.city_name"))).select("a.item_id", F.col("a.area_sqm").alias("price"), "market_avg_price")
    return rounded(rules.value(joined).select("item_id", "value_score"), "value_score")


JACCARD = """
    sd AS (SELECT DISTINCT session_id, district_name FROM fact_user_events JOIN dim_listing USING (item_id) WHERE session_id IS NOT NULL AND district_name IS NOT NULL),
    co AS (SELECT a.district_name AS district_a, b.district_name AS district_b, count(*) AS n FROM sd a JOIN sd b USING (session_id) GROUP BY 1, 2),
    sim AS (SELECT co.district_a, co.district_b, co.n / (x.n + y.n - co.n)::DOUBLE AS jaccard_similarity FROM co JOIN co x ON x.district_a = co.district_a AND x.district_b = co.district_a JOIN co y ON y.district_a = co.district_b AND y.district_b = co.district_b)
"""


@query("r6_district_similarity", f"WITH {JACCARD} SELECT district_a, district_b, round(jaccard_similarity, 6) AS jaccard_similarity FROM sim")
def r6_district_similarity(t: Tables) -> DataFrame:
    return rounded(rules.district_similarity(t.events.select("session_id", "item_id"), t.listings), "jaccard_similarity")


@query(
    "r5_geo",
    f"""WITH {JACCARD}, {PAIRS}, h AS (SELECT user_id, district_name AS district, count(*) AS weight FROM pairs JOIN dim_listing USING (item_id) WHERE district_name IS NOT NULL GROUP BY 1, 2)
        SELECT p.user_id, p.item_id, coalesce(round(sum(coalesce(jaccard_similarity, 0.05) * weight) / sum(weight), 6), 0.5) AS geo_score FROM pairs p JOIN dim_listing l USING (item_id) LEFT JOIN h USING (user_id)
        LEFT JOIN sim ON district_a = l.district_name AND district_b = h.district GROUP BY 1, 2""",
)
def r5_geo(t: Tables) -> DataFrame:
    places = pairs(t).join(t.listings.select("item_id", "district_name"), "item_id")
    weights = places.filter("district_name is not null").groupBy("user_id", "district_name").agg(F.count(F.lit(1)).alias("weight"))
    viewed = weights.groupBy("user_id").agg(F.collect_list(F.struct(F.col("district_name").alias("district"), "weight")).alias("user_viewed_districts"))
    items = places.join(viewed, "user_id", "left")
    return rounded(rules.geo(items, rules.district_similarity(t.events.select("session_id", "item_id"), t.listings), ["user_id", "item_id"]).select("user_id", "item_id", "geo_score"), "geo_score")


SPLIT_SQL = "DATE '2026-04-02'"
TRUTH = f"truth AS (SELECT DISTINCT user_id, item_id FROM fact_user_events WHERE date > {SPLIT_SQL} AND {LOGIN} AND user_id IS NOT NULL AND item_id IS NOT NULL AND event_type IN {GT})"
RECS = f"""recs AS (SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY sum(CASE WHEN event_type IN {GT} THEN 10 ELSE 1 END) DESC, max(event_ts) DESC, item_id) AS INTEGER) AS rank FROM fact_user_events
    WHERE event_ts BETWEEN TIMESTAMP '2026-03-19' AND TIMESTAMP '2026-04-02' AND user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY 1, 2 QUALIFY rank <= 10)"""


def replayed(t: Tables) -> DataFrame:
    return c.pageview_replay(t.events, SPLIT, cap=10).select("user_id", "item_id", "rank")


def truth(t: Tables) -> DataFrame:
    return metrics.ground_truth(t.events, SPLIT.isoformat())


PER_USER = f"""{TRUTH}, {RECS}, nt AS (SELECT user_id, count(*) AS n_true FROM truth GROUP BY 1),
    hit AS (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS so_far FROM recs JOIN truth USING (user_id, item_id)),
    hs AS (SELECT user_id, count(*) AS hits, sum(1 / log2(rank + 1.0)) AS dcg, sum(so_far / rank::DOUBLE) AS ap FROM hit GROUP BY 1),
    pu AS (SELECT user_id, n_true, coalesce(hits, 0) AS hits, coalesce(hits, 0) / n_true::DOUBLE AS recall, coalesce(hits, 0) / least(n_true, 10)::DOUBLE AS recall_capped, coalesce(hits, 0) / 10.0::DOUBLE AS precision,
           coalesce(dcg, 0) / list_sum(list_transform(generate_series(1, least(n_true, 10)), lambda i: 1 / log2(i + 1.0))) AS ndcg, coalesce(ap, 0) / n_true AS ap, (coalesce(hits, 0) > 0)::INT AS hit FROM nt LEFT JOIN hs USING (user_id))"""
MEASURES = ["recall", "recall_capped", "precision", "ndcg", "ap"]


@query("m1_metrics_per_user", f"WITH {PER_USER} SELECT * REPLACE ({', '.join(f'round({m}, 6) AS {m}' for m in MEASURES)}) FROM pu")
def m1_metrics_per_user(t: Tables) -> DataFrame:
    return rounded(metrics.per_user(replayed(t), truth(t), 10), *MEASURES)


@query("m1b_list_recall", f"WITH {TRUTH}, {RECS}, nt AS (SELECT user_id, count(*) AS n FROM truth GROUP BY 1), h AS (SELECT user_id, count(*) AS hits FROM recs SEMI JOIN truth USING (user_id, item_id) GROUP BY 1) SELECT user_id, round(coalesce(hits, 0) / n::DOUBLE, 6) AS recall FROM nt LEFT JOIN h USING (user_id)")
def m1b_list_recall(t: Tables) -> DataFrame:
    return rounded(metrics.list_recall(replayed(t), truth(t), 10), "recall")


@query("m5_diversity", f"WITH {RECS}, k AS (SELECT user_id, city_name, count(*) AS n FROM recs LEFT JOIN dim_listing USING (item_id) GROUP BY 1, 2), s AS (SELECT user_id, sum(n) AS t, sum(n * (n - 1) / 2) AS same FROM k GROUP BY 1) SELECT user_id, round(CASE WHEN t < 2 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - same / (t * (t - 1) / 2) END, 6) AS diversity FROM s")
def m5_diversity(t: Tables) -> DataFrame:
    return rounded(metrics.feature_diversity(replayed(t), t.listings, "city_name"), "diversity")


@query("m6_novelty", f"WITH {RECS}, p AS (SELECT item_id, count(DISTINCT user_id) AS pop FROM contact_pairs WHERE user_id IS NOT NULL GROUP BY 1), n AS (SELECT count(DISTINCT user_id) AS n FROM contact_pairs) SELECT user_id, round(avg(-log2((coalesce(pop, 0) + 1.0::DOUBLE) / (n + 1.0::DOUBLE))), 6) AS novelty FROM recs LEFT JOIN p USING (item_id), n GROUP BY 1")
def m6_novelty(t: Tables) -> DataFrame:
    return rounded(metrics.novelty(replayed(t), t.contact_pairs), "novelty")


def aged(t: Tables) -> DataFrame:
    age = F.greatest(F.datediff(F.lit(CUTOFF.isoformat()).cast("date"), "posted_date"), F.lit(0))
    return t.listings.withColumn("listing_age_days", F.when(F.col("posted_date").isNotNull(), age))


@query(
    "m7_list_health",
    f"""WITH {RECS}, k AS (SELECT r.user_id, r.item_id, category, city_name, district_name, seller_type, CASE WHEN posted_date IS NOT NULL THEN greatest(datediff('day', posted_date, DATE '2026-04-09'), 0) END AS age FROM recs r LEFT JOIN dim_listing USING (item_id)),
        pr AS (SELECT a.user_id, avg(1.0::DOUBLE - CASE WHEN a.category IS NOT DISTINCT FROM b.category THEN 0.4::DOUBLE ELSE 0 END - CASE WHEN a.city_name IS NOT DISTINCT FROM b.city_name THEN 0.3::DOUBLE + CASE WHEN a.district_name IS NOT DISTINCT FROM b.district_name THEN 0.3::DOUBLE ELSE 0 END ELSE 0 END) AS ild
               FROM k a JOIN k b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1),
        ct AS (SELECT user_id, category, count(*) / sum(count(*)) OVER (PARTITION BY user_id)::DOUBLE AS share FROM k GROUP BY 1, 2),
        en AS (SELECT user_id, -sum(share * log2(share)) AS h, count(*) AS kinds FROM ct GROUP BY 1),
        ex AS (SELECT * FROM (VALUES (1010, 0.156::DOUBLE), (1020, 0.446::DOUBLE), (1030, 0.065::DOUBLE), (1040, 0.102::DOUBLE), (1050, 0.231::DOUBLE)) v(category, e)),
        kl AS (SELECT user_id, coalesce(sum(share * ln((share + 1e-10) / (e + 1e-10))), 0) AS kl FROM ct LEFT JOIN ex USING (category) GROUP BY 1),
        b AS (SELECT user_id, count(*) AS n, avg(coalesce(seller_type = 'agent', false)::INT) AS agents, avg(exp(-0.05::DOUBLE * coalesce(age, 30))) AS freshness FROM k GROUP BY 1)
        SELECT user_id, n, round(CASE WHEN n <= 1 THEN 1.0::DOUBLE ELSE 0.6::DOUBLE * ild + 0.4::DOUBLE * CASE WHEN kinds > 1 THEN h / log2(kinds) ELSE h END END, 6) AS diversity,
        round(0.6::DOUBLE * (1.0::DOUBLE - abs(agents - 0.52::DOUBLE)) + 0.4::DOUBLE * exp(-kl), 6) AS fairness, round(freshness, 6) AS freshness FROM b LEFT JOIN pr USING (user_id) JOIN en USING (user_id) JOIN kl USING (user_id)""",
)
def m7_list_health(t: Tables) -> DataFrame:
    return rounded(metrics.list_health(replayed(t), aged(t)), "diversity", "fairness", "freshness")


@query("m10_ground_truth", f"WITH {TRUTH} SELECT * FROM truth")
def m10_ground_truth(t: Tables) -> DataFrame:
    return truth(t)


@query("m11_metric_means", f"WITH {PER_USER} SELECT count(*) AS n_users, {', '.join(f'round(avg({m}), 6) AS {m}' for m in MEASURES)}, round(avg(hits), 6) AS hits_per_user, round(avg(hit), 6) AS hit_rate FROM pu")
def m11_metric_means(t: Tables) -> DataFrame:
    return rounded(metrics.averages(metrics.per_user(replayed(t), truth(t), 10)), *MEASURES, "hits_per_user", "hit_rate")


@query(
    "m12_recall_by_category",
    f"WITH {TRUTH}, {RECS} SELECT category, count(*) AS n_true, count(r.item_id) AS hits, round(count(r.item_id) / count(*)::DOUBLE, 6) AS recall FROM truth t LEFT JOIN recs r ON r.user_id = t.user_id AND r.item_id = t.item_id LEFT JOIN dim_listing l ON l.item_id = t.item_id GROUP BY 1",
)
def m12_recall_by_category(t: Tables) -> DataFrame:
    met = truth(t).join(replayed(t).select("user_id", "item_id", F.lit(1).alias("hit")), ["user_id", "item_id"], "left").join(t.listings.select("item_id", "category"), "item_id", "left")
    return rounded(met.groupBy("category").agg(F.count(F.lit(1)).alias("n_true"), F.count("hit").alias("hits"), (F.count("hit") / F.count(F.lit(1))).alias("recall")), "recall")


@query("m12_active_truth", f"WITH {TRUTH} SELECT count(*) AS n_true, count(l.item_id) AS n_active, round(count(l.item_id) / count(*)::DOUBLE, 6) AS ceiling FROM truth t LEFT JOIN (SELECT item_id FROM dim_listing WHERE ad_status = 'active') l USING (item_id)")
def m12_active_truth(t: Tables) -> DataFrame:
    met = truth(t).join(cq.valid_items(t).withColumn("on", F.lit(1)), "item_id", "left")
    return rounded(met.agg(F.count(F.lit(1)).alias("n_true"), F.count("on").alias("n_active"), (F.count("on") / F.count(F.lit(1))).alias("ceiling")), "ceiling")


@query(
    "m14_coverage",
    f"WITH {RECS}, s AS (SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rn FROM recs GROUP BY 1), c AS (SELECT count(DISTINCT item_id) AS n_catalogue FROM dim_listing), z AS (SELECT count(*) AS n_items FROM s) "
    "SELECT n_items, n_catalogue, round(n_items / n_catalogue::DOUBLE, 6) AS coverage, round((SELECT sum(n) FROM s, z WHERE rn <= greatest(floor(n_items / 100), 1)) / (SELECT sum(n) FROM s)::DOUBLE, 6) AS top_share FROM z, c",
)
def m14_coverage(t: Tables) -> DataFrame:
    return rounded(metrics.coverage(replayed(t), t.listings), "coverage", "top_share")


@query("m13_output_checks")
def m13_output_checks(t: Tables) -> DataFrame:
    """Counts of violations in a submission of the cascade."""
    from marketloom.plans import cascade as cascade_plans

    out = cut_lineage(cascade_plans.c9_submission(t))
    return metrics.violations(out, cascade_plans.all_users(t), t.listings)


@query("l2_pairwise_ranking")
def l2_pairwise_ranking(t: Tables) -> DataFrame:
    """Candidates ranked by a model trained on pairs of rows of the same user."""
    rows = cut_lineage(training_rows(t))
    model = learned.fit_pairwise(learned.users_with_positives(rows), FEATURES)
    return learned.ranked_by_model(model, rows, FEATURES, 10)


@query("l1_multitask_scores")
def l1_multitask_scores(t: Tables) -> DataFrame:
    """A yes/no and a five-way model blended."""
    rows = cut_lineage(training_rows(t).join(l1_outcomes(t), ["user_id", "item_id"], "left").fillna(0.0, ["outcome"]))
    models = learned.fit_multitask(learned.users_with_positives(rows), FEATURES)
    return learned.multitask_scores(models, rows, FEATURES).select("user_id", "item_id", "score")


@query("l3_users_with_positives")
def l3_users_with_positives(t: Tables) -> DataFrame:
    return learned.users_with_positives(training_rows(t)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))


@query("l5_greedy_rerank")
def l5_greedy_rerank(t: Tables) -> DataFrame:
    """Co-contact candidates chosen greedily for accuracy, diversity, fairness, freshness and novelty."""
    cand = c.cocontact(c.user_history(t.contact_pairs), c.cocontact_graph(t.contact_pairs, CUTOFF), t.contact_pairs.filter("user_id is not null"), 30)
    stats = features.item_stats(t.contact_pairs, cleaning.pageview_pairs(t.events), SPLIT).select("item_id", "item_total_contacts")
    return learned.rerank(cand.join(aged(t), "item_id", "left").join(stats, "item_id", "left"))


@query(
    "g12_title_weights",
    """WITH w AS (SELECT item_id, unnest(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}_]+')) AS term FROM dim_listing), tf AS (SELECT item_id, term, count(*) AS tf FROM w WHERE length(term) >= 2 GROUP BY 1, 2),
       df AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY 1 ORDER BY cf DESC, term LIMIT 500), n AS (SELECT count(*) AS n FROM dim_listing),
       x AS (SELECT item_id, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (term), n)
       SELECT item_id AS item, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY item_id)), 6) AS w FROM x""",
)
def g12_title_weights(t: Tables) -> DataFrame:
    return rounded(learned.tfidf(t.listings, "item_id", "title", most_terms=500), "w")


@query("g12_content_based")
def g12_content_based(t: Tables) -> DataFrame:
    """Listings with titles like those of a user's five latest contacts."""
    history = c.user_history(t.contact_pairs).filter("rank <= 5")
    return learned.content_based(cut_lineage(learned.tfidf(t.listings, "item_id", "title")), history, 10)


@query("g13_als")
def g13_als(t: Tables) -> DataFrame:
    return learned.als_top(cleaning.weighted_contact_scores(t.events), t.contact_pairs.filter("user_id is not null"), 10, cq.valid_items(t))


@query("g13b_similar_items")
def g13b_similar_items(t: Tables) -> DataFrame:
    """The ten nearest items by factors of every item whose hash falls on 0 of 20."""
    _, items = learned.fit_als(cleaning.weighted_contact_scores(t.events))
    asked = items.filter(c.stable_bucket(F.col("item_id"), 20) == 0)
    return learned.nearest(asked, "item_id", items, "item_id", 11, cosine=True).filter("item_id <> similar_id")


@query("g13c_pair_scores")
def g13c_pair_scores(t: Tables) -> DataFrame:
    users, items = learned.fit_als(cleaning.weighted_contact_scores(t.events))
    return learned.pair_scores(pairs(t), users, items)


@query("g14_bpr")
def g14_bpr(t: Tables) -> DataFrame:
    """Ten unseen items a user by personalised ranking factors over time-decayed scores."""
    recent = t.contact_pairs.filter("user_id is not null and last_date > date'2026-03-10'")
    scores = cleaning.decayed_scores(recent, CUTOFF).withColumnRenamed("interaction_score", "score")
    users, items = learned.fit_bpr(scores)
    return learned.nearest(users, "user_id", items, "item_id", 10, seen=recent)


@query("g15_graph_embeddings")
def g15_graph_embeddings(t: Tables) -> DataFrame:
    """Items nearest to each user on the user-item graph of the last month, by aggregated vectors."""
    vec = learned.graph_embeddings(t.contact_pairs.filter("last_date > date'2026-03-10'"))
    users = vec.filter("node like 'u:%'").select(F.substring("node", 3, 100).alias("user_id"), F.col("vec").alias("factors"))
    items = vec.filter("node like 'i:%'").select(F.substring("node", 3, 100).alias("item_id"), F.col("vec").alias("factors"))
    return learned.nearest(users, "user_id", items, "item_id", 10)


@query("g16_sequences", "WITH k AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) AS rn FROM fact_user_events WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND event_ts IS NOT NULL QUALIFY rn <= 20) SELECT user_id, string_agg(item_id, ',' ORDER BY rn DESC) AS items FROM k GROUP BY 1")
def g16_sequences(t: Tables) -> DataFrame:
    return learned.user_sequences(t.events).select("user_id", F.array_join("items", ",").alias("items"))


@query("g16_sequence_vectors")
def g16_sequence_vectors(t: Tables) -> DataFrame:
    return learned.encode_sequences(learned.user_sequences(t.events)).select("user_id", *[F.round(F.col("vec")[i], 6).alias(f"v{i}") for i in range(4)])



@query(
    "f_cosine_to_label_mean",
    """WITH u AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
       m AS (SELECT label, pos, avg(x) AS y FROM u GROUP BY 1, 2)
       SELECT vec_id, u.label, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 5) AS cosine FROM u JOIN m ON m.label = u.label AND m.pos = u.pos GROUP BY 1, 2""",
)
def f_cosine_to_label_mean(t: Tables) -> DataFrame:
    """Cosine of each embedding with the mean of its label."""
    from marketloom.functions.scalar import cosine

    e = t["embeddings"]
    means = e.select("label", F.posexplode("embedding")).groupBy("label", "pos").agg(F.avg("col").alias("m")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("mean"))
    return e.join(means, "label").select("vec_id", "label", F.round(cosine(F.col("embedding"), F.col("mean")), 5).alias("cosine"))


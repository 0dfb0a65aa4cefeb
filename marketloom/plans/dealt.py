"""Queries of the data-preparation operators that belong to the core."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.scalar import clean_label, micros
from marketloom.operators import asof, entity_features, frequency, rolling, sessions, skew
from marketloom.plans.registry import Registry
from marketloom.session import scratch_dir
from marketloom.sources import formats
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query

FIRST_DAY, LAST_DAY = date(2025, 11, 9), date(2026, 4, 9)
MINUTE = 60_000_000
HEAVY_SHARE = 0.02
#: Deliveries after this day come as deltas in the feature queries.
LOADED_UNTIL = "2026-03-27"


@query(
    "p1_found",
    """
    WITH e AS (SELECT user_id AS key_value, count(*) AS n FROM fact_user_events GROUP BY 1),
         p AS (SELECT item_id AS key_value, count(*) AS n FROM fact_post_contact_interactions GROUP BY 1)
    SELECT 'fact_user_events' AS table_name, key_value FROM e WHERE key_value IS NOT NULL AND n >= 0.02 * (SELECT count(*) FROM fact_user_events)
    UNION ALL
    SELECT 'fact_post_contact_interactions', key_value FROM p WHERE key_value IS NOT NULL AND n >= 0.02 * (SELECT count(*) FROM fact_post_contact_interactions)
    """,
)
def p1_found(t: Tables) -> DataFrame:
    users = frequency.heavy_keys(t.events, "user_id", "event_type", HEAVY_SHARE)
    items = frequency.heavy_keys(t.pci, "item_id", "date", HEAVY_SHARE)
    named = lambda df, table: df.select(F.lit(table).alias("table_name"), F.col("key").alias("key_value"))
    return named(users, "fact_user_events").unionByName(named(items, "fact_post_contact_interactions"))


@query(
    "p1_user_profile",
    """
    WITH d AS (SELECT user_id, dwell_time_sec AS v, row_number() OVER (PARTITION BY user_id ORDER BY dwell_time_sec) AS rn, count(*) OVER (PARTITION BY user_id) AS n
               FROM fact_user_events WHERE user_id IS NOT NULL AND dwell_time_sec IS NOT NULL),
         q AS (SELECT user_id, max(v) FILTER (WHERE rn = ceil(n * 0.5)) AS dwell_p50, max(v) FILTER (WHERE rn = ceil(n * 0.9)) AS dwell_p90 FROM d GROUP BY 1),
         i AS (SELECT user_id, item_id, count(*) AS n FROM fact_user_events WHERE user_id IS NOT NULL GROUP BY 1, 2),
         m AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS rn FROM i WHERE item_id IS NOT NULL),
         a AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS n_rows, count(item_id) AS n_items FROM i GROUP BY 1)
    SELECT a.user_id, n_rows, n_items, m.item_id AS top_item, dwell_p50, dwell_p90
    FROM a LEFT JOIN m ON m.user_id = a.user_id AND m.rn = 1 LEFT JOIN q ON q.user_id = a.user_id
    """,
)
def p1_user_profile(t: Tables) -> DataFrame:
    """Rows, distinct items, most frequent item and exact dwell percentiles of every user."""
    known = t.events.filter("user_id is not null")
    totals = frequency.key_totals(frequency.compress(known, "user_id", "item_id"))
    dwell = frequency.percentiles(frequency.compress(known, "user_id", "dwell_time_sec"), [0.5, 0.9])
    return totals.join(dwell, "key", "left").select(
        F.col("key").alias("user_id"), "n_rows", F.col("n_distinct").alias("n_items"), F.col("mode").alias("top_item"), F.col("p50").alias("dwell_p50"), F.col("p90").alias("dwell_p90")
    )


@query(
    "p1_item_profile",
    """
    WITH d AS (SELECT item_id, adview_count AS v, row_number() OVER (PARTITION BY item_id ORDER BY adview_count) AS rn, count(*) OVER (PARTITION BY item_id) AS n
               FROM fact_post_contact_interactions WHERE item_id IS NOT NULL AND adview_count IS NOT NULL),
         q AS (SELECT item_id, max(v) FILTER (WHERE rn = ceil(n * 0.5)) AS adviews_p50, max(v) FILTER (WHERE rn = ceil(n * 0.9)) AS adviews_p90 FROM d GROUP BY 1),
         i AS (SELECT item_id, user_id, count(*) AS n FROM fact_post_contact_interactions WHERE item_id IS NOT NULL GROUP BY 1, 2),
         m AS (SELECT item_id, user_id, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, user_id) AS rn FROM i WHERE user_id IS NOT NULL),
         a AS (SELECT item_id, CAST(sum(n) AS BIGINT) AS n_rows, count(user_id) AS n_users FROM i GROUP BY 1)
    SELECT a.item_id, n_rows, n_users, m.user_id AS top_user, adviews_p50, adviews_p90
    FROM a LEFT JOIN m ON m.item_id = a.item_id AND m.rn = 1 LEFT JOIN q ON q.item_id = a.item_id
    """,
)
def p1_item_profile(t: Tables) -> DataFrame:
    """Rows, distinct users, most frequent user and exact adview percentiles of every item."""
    known = t.pci.filter("item_id is not null")
    totals = frequency.key_totals(frequency.compress(known, "item_id", "user_id"))
    views = frequency.percentiles(frequency.compress(known, "item_id", "adview_count"), [0.5, 0.9])
    return totals.join(views, "key", "left").select(
        F.col("key").alias("item_id"), "n_rows", F.col("n_distinct").alias("n_users"), F.col("mode").alias("top_user"), F.col("p50").alias("adviews_p50"), F.col("p90").alias("adviews_p90")
    )


ROLLING_SQL = """
    WITH d AS (SELECT DISTINCT * FROM fact_post_contact_interactions),
         s AS (SELECT item_id, date AS day, sum(coalesce(lead_count, 0)) AS leads, sum(coalesce(adview_count, 0)) AS views FROM d
               WHERE item_id IS NOT NULL AND date BETWEEN DATE '2025-11-09' AND DATE '2026-04-09' GROUP BY 1, 2),
         g AS (SELECT i.item_id, CAST(c.day AS DATE) AS day FROM (SELECT DISTINCT item_id FROM d WHERE item_id IS NOT NULL) i,
               (SELECT unnest(generate_series(DATE '2025-11-09', DATE '2026-04-09', INTERVAL 1 DAY)) AS day) c),
         f AS (SELECT g.item_id, g.day, coalesce(leads, 0) AS leads, coalesce(views, 0) AS views FROM g LEFT JOIN s USING (item_id, day)),
         r AS (SELECT item_id, day,
                CAST(sum(leads) OVER w7 AS BIGINT) AS lead_count_7d, CAST(sum(leads) OVER w30 AS BIGINT) AS lead_count_30d,
                CAST(sum(views) OVER w7 AS BIGINT) AS adview_count_7d, CAST(sum(views) OVER w30 AS BIGINT) AS adview_count_30d
               FROM f WINDOW w7 AS (PARTITION BY item_id ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY item_id ORDER BY day ROWS 29 PRECEDING))
"""


def daily_interactions(t: Tables) -> DataFrame:
    """Each delivered row once: exact repeats are told from differing rows of a day by all columns."""
    return t.pci.distinct()


@query("p2_found", ROLLING_SQL + "SELECT item_id, strftime(day, '%Y-%m-%d') AS day FROM r WHERE lead_count_30d >= 8 AND adview_count_7d = 0")
def p2_found(t: Tables) -> DataFrame:
    keep = lambda c: (c["lead_count_30d"] >= 8) & (c["adview_count_7d"] == 0)
    totals = rolling.rolling_totals(daily_interactions(t), "item_id", "date", ["lead_count", "adview_count"], [7, 30], FIRST_DAY, LAST_DAY, keep=keep)
    return totals.select("item_id", F.date_format("date", "yyyy-MM-dd").alias("day"))


@query(
    "p2_rolling",
    ROLLING_SQL
    + """SELECT item_id, day, lead_count_7d, lead_count_30d, adview_count_7d, adview_count_30d,
         round(lead_count_7d / 7.0::DOUBLE, 6) AS lead_avg_7d, round(lead_count_30d / 30.0::DOUBLE, 6) AS lead_avg_30d,
         round(adview_count_7d / 7.0::DOUBLE, 6) AS adview_avg_7d, round(adview_count_30d / 30.0::DOUBLE, 6) AS adview_avg_30d FROM r""",
)
def p2_rolling(t: Tables) -> DataFrame:
    """Totals and daily averages over the last 7 and 30 days for every item and calendar day."""
    totals = rolling.rolling_totals(daily_interactions(t), "item_id", "date", ["lead_count", "adview_count"], [7, 30], FIRST_DAY, LAST_DAY).withColumnRenamed("date", "day")
    avg = lambda c, w: F.round(F.col(f"{c}_count_{w}d") / F.lit(float(w)), 6).alias(f"{c}_avg_{w}d")
    return totals.select("*", *[avg(c, w) for c in ("lead", "adview") for w in (7, 30)])


def event_versions(t: Tables) -> DataFrame:
    """The columns that the feature table reads; kinds of events in one spelling."""
    return t.events.filter("event_id is not null").select("event_id", "user_id", clean_label(F.col("event_type")).alias("kind"), micros(F.col("event_ts")).alias("us"), "dwell_time_sec", "date")


def once(versions: DataFrame) -> DataFrame:
    """Deliveries of an event differ in the day alone, so distinct leaves one row an event."""
    return versions.drop("date").repartition("event_id").distinct()


def signed(events: DataFrame, sign: int) -> DataFrame:
    return entity_features.signed(events, "user_id", "kind", "us", "dwell_time_sec", sign)


def loaded_and_late(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Deliveries without a date count as loaded."""
    versions = event_versions(t)
    late = F.coalesce(F.col("date") > F.lit(LOADED_UNTIL).cast("date"), F.lit(False))
    return once(versions.filter(~late)), once(versions.filter(late))


def after_batch(state: DataFrame, known: DataFrame, late: DataFrame) -> DataFrame:
    """The state after a batch of deliveries: a late copy of a known event takes the old one back and puts the new one in."""
    named = lambda df: df.withColumnRenamed("user_id", "entity")
    replaced = known.join(late.select("event_id"), "event_id", "left_semi")

    def left(keys: DataFrame) -> DataFrame:
        old = entity_features.of_keys(named(known), keys).join(late.select("event_id"), "event_id", "left_anti")
        return old.unionByName(entity_features.of_keys(named(late), keys)).withColumnRenamed("us", "at")

    return entity_features.apply_deltas(state, signed(late, 1).unionByName(signed(replaced, -1)), left)


def current_features(t: Tables) -> DataFrame:
    """The state of the loaded deliveries after the later ones."""
    loaded, late = loaded_and_late(t)
    return after_batch(entity_features.build(signed(loaded, 1)), loaded, late)


FEATURE_SQL = """
    WITH e AS (SELECT event_id, any_value(user_id) AS user_id, any_value(regexp_replace(lower(trim(event_type)), '[ \\-]+', '_', 'g')) AS kind, any_value(epoch_us(event_ts)) AS us, any_value(dwell_time_sec) AS dwell, min(date) AS first_date
               FROM fact_user_events WHERE user_id IS NOT NULL {where} GROUP BY event_id),
         s AS (SELECT user_id, kind, count(*) AS n, CAST(sum(coalesce(dwell, 0)) AS BIGINT) AS total, max(us) AS last FROM e GROUP BY 1, 2)
"""


def rendered(by_entity: DataFrame) -> DataFrame:
    entry = lambda f: F.concat_ws(":", F.coalesce(f["kind"], F.lit("")), f["n"].cast("string"), f["total"].cast("string"), F.coalesce(f["last"].cast("string"), F.lit("")))
    return by_entity.select(
        F.col("entity").alias("user_id"), "n_kinds", F.col("n").alias("n_events"), F.col("total").alias("dwell_total"), F.col("last").alias("last_us"), F.array_join(F.transform("features", entry), ";").alias("features")
    )


RENDERED_SQL = """
    SELECT user_id, count(*) AS n_kinds, CAST(sum(n) AS BIGINT) AS n_events, CAST(sum(total) AS BIGINT) AS dwell_total, max(last) AS last_us,
           string_agg(kind || ':' || n || ':' || total || ':' || coalesce(CAST(last AS VARCHAR), ''), ';' ORDER BY kind) AS features
    FROM s GROUP BY user_id
"""


@query("p4_user_features", FEATURE_SQL.format(where="") + RENDERED_SQL)
def p4_user_features(t: Tables) -> DataFrame:
    """One row a user; features lists kind:count:dwell:last for every kind of event the user has."""
    return rendered(entity_features.by_entity(current_features(t)))


#: Days after which a batch of deliveries begins.
BATCHES = ["2026-02-28", "2026-03-27", "2026-04-05"]


@query("p4_in_batches", FEATURE_SQL.format(where="") + RENDERED_SQL)
def p4_in_batches(t: Tables) -> DataFrame:
    """The same features from a state that is stored after each of several batches and read again for the next."""
    versions, spark = event_versions(t), t.spark
    root = f"{scratch_dir(spark)}/features-{uuid.uuid4().hex}"
    kept = lambda state: spark.read.parquet(formats.write_version(state, root))
    begun = sum((F.coalesce((F.col("date") > F.lit(d).cast("date")).cast("int"), F.lit(0)) for d in BATCHES), F.lit(0))
    state = kept(entity_features.build(signed(once(versions.filter(begun == 0)), 1)))
    for i in range(1, len(BATCHES) + 1):
        state = kept(after_batch(state, once(versions.filter(begun < i)), once(versions.filter(begun == i))))
    return rendered(entity_features.by_entity(state))


MAIN_KINDS = ["pageview", "other_interaction", "view_phone", "contact_chat", "contact_zalo", "contact_sms"]


@query(
    "p4_main_features",
    FEATURE_SQL.format(where="")
    + "SELECT user_id, "
    + ", ".join(
        f"coalesce(CAST(sum(n) FILTER (WHERE kind = '{k}') AS BIGINT), 0) AS n_{k}, coalesce(CAST(sum(total) FILTER (WHERE kind = '{k}') AS BIGINT), 0) AS total_{k}, max(last) FILTER (WHERE kind = '{k}') AS last_{k}"
        for k in MAIN_KINDS
    )
    + " FROM s GROUP BY user_id",
)
def p4_main_features(t: Tables) -> DataFrame:
    """Columns for the six main kinds."""
    return entity_features.wide(current_features(t), MAIN_KINDS).withColumnRenamed("entity", "user_id")


@query("p4_after_withdrawal", FEATURE_SQL.format(where="AND date <= DATE '2026-03-27'") + RENDERED_SQL)
def p4_after_withdrawal(t: Tables) -> DataFrame:
    """The features after all events first delivered past a day were withdrawn again."""
    loaded, late = loaded_and_late(t)
    new = late.join(loaded.select("event_id"), "event_id", "left_anti")
    state = entity_features.build(signed(loaded.unionByName(new), 1))
    return rendered(entity_features.by_entity(entity_features.apply_deltas(state, signed(new, -1), signed(loaded, 1))))


SESSION_SQL = """
    WITH e AS (SELECT DISTINCT user_id, event_id, event_ts, item_id FROM fact_user_events WHERE user_id IS NOT NULL AND event_ts IS NOT NULL),
         g AS (SELECT *, CASE WHEN epoch_us(event_ts) - epoch_us(lag(event_ts) OVER o) > {gap} THEN 1 ELSE 0 END AS cut FROM e WINDOW o AS (PARTITION BY user_id ORDER BY event_ts, event_id)),
         s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g),
         r AS (SELECT user_id, k, arg_min(event_id, (event_ts, event_id)) AS first_event_id, arg_max(event_id, (event_ts, event_id)) AS last_event_id, min(epoch_us(event_ts)) AS start_us, max(epoch_us(event_ts)) AS end_us,
                      count(*) AS n_events, count(DISTINCT item_id) AS n_items FROM s GROUP BY 1, 2)
"""
#: Thresholds from a minute on can be cut from the stored tree.
TREE_FLOOR = MINUTE


def session_tree(t: Tables) -> DataFrame:
    return sessions.gap_tree(t.events, "user_id", "event_id", "event_ts", TREE_FLOOR)


@query("p5_found", SESSION_SQL.format(gap=30 * MINUTE) + "SELECT user_id, first_event_id, last_event_id FROM r")
def p5_found(t: Tables) -> DataFrame:
    return sessions.cut(session_tree(t), 30 * MINUTE).select("user_id", "first_event_id", "last_event_id")


@query("p5_sessions", SESSION_SQL.format(gap=30 * MINUTE) + "SELECT user_id, first_event_id, last_event_id, start_us, end_us, end_us - start_us AS duration_us, n_events, n_items FROM r")
def p5_sessions(t: Tables) -> DataFrame:
    """Start, end, duration and numbers of events and items of each session."""
    found = sessions.count_items(sessions.cut(session_tree(t), 30 * MINUTE), t.events, "user_id", "item_id", "event_ts", TREE_FLOOR)
    return found.withColumn("duration_us", F.col("end_us") - F.col("start_us"))


GAPS = [5, 15, 30, 60, 240]


@query(
    "p5_gap_settings",
    "\nUNION ALL\n".join(
        f"SELECT * FROM ({SESSION_SQL.format(gap=m * MINUTE)} SELECT {m} AS gap_minutes, count(*) AS n_sessions, CAST(sum(n_events) AS BIGINT) AS n_events, max(n_events) AS longest FROM r)" for m in GAPS
    ),
)
def p5_gap_settings(t: Tables) -> DataFrame:
    """Sessions at several thresholds, all from one tree."""
    tree = session_tree(t)
    fits = F.array_compact(F.array(*[F.when((F.col("gap_us") <= m * MINUTE) & (F.col("parent_gap_us") > m * MINUTE), F.lit(m)) for m in GAPS]))
    return tree.select(F.explode(fits).alias("gap_minutes"), "n_events").groupBy("gap_minutes").agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("n_events").alias("n_events"), F.max("n_events").alias("longest"))


ASOF_SQL = """
    WITH e AS (SELECT DISTINCT event_id, item_id, event_ts FROM fact_user_events WHERE event_ts IS NOT NULL AND item_id IS NOT NULL),
         s AS (SELECT DISTINCT snapshot_id, item_id, date, loaded_at, views_24h, contacts_24h FROM fact_listing_snapshot WHERE loaded_at IS NOT NULL),
         j AS (SELECT event_id, e.item_id, snapshot_id, views_24h, contacts_24h, row_number() OVER (PARTITION BY event_id ORDER BY date DESC NULLS LAST, loaded_at DESC NULLS LAST, snapshot_id DESC) AS rn
               FROM e {join} JOIN s ON s.item_id = e.item_id AND s.loaded_at <= e.event_ts)
"""


def events_as_known(t: Tables) -> DataFrame:
    hot, latest = skew.hot_and_latest(t.events, "item_id", "event_type", latest=micros(F.col("event_ts")))
    return asof.as_known(t.events, "event_id", "item_id", "event_ts", t.snapshots, "loaded_at", ["date"], ["snapshot_id", "views_24h", "contacts_24h"], hot=hot, latest=latest)


@query("p6_found", ASOF_SQL.format(join="") + "SELECT event_id, snapshot_id FROM j WHERE rn = 1")
def p6_found(t: Tables) -> DataFrame:
    return events_as_known(t).filter("known is not null").select(F.col("event").alias("event_id"), "known.snapshot_id")


@query("p6_event_attributes", ASOF_SQL.format(join="LEFT") + "SELECT event_id, item_id, snapshot_id, views_24h, contacts_24h FROM j WHERE rn = 1")
def p6_event_attributes(t: Tables) -> DataFrame:
    """Every event with the figures known at its time, nulls where none were."""
    return events_as_known(t).select(F.col("event").alias("event_id"), F.col("entity").alias("item_id"), "known.snapshot_id", "known.views_24h", "known.contacts_24h")

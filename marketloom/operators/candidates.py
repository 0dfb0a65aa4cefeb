"""Candidate sources: each gives (user_id, item_id, score, rank) or an index that a lookup joins.

Ties are always settled by item or user id, so results do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.constants import AGENT_SHARE, POSITIVE_EVENTS, REAL_CONTACTS
from marketloom.functions.ranking import best, top
from marketloom.functions.scalar import stable_bucket
from marketloom.operators import learned
from marketloom.operators.relational import row_index
from marketloom.operators.votes import voted
from marketloom.session import cut_lineage

USER_ITEM = ["user_id", "item_id"]
LEVELS = {"global": [], "city": ["city_name"], "cat": ["category"], "cc": ["city_name", "category"], "ccd": ["city_name", "category", "district_name"]}


def day(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def only_valid(df: DataFrame, valid: DataFrame | None) -> DataFrame:
    return df if valid is None else df.join(valid.select("item_id"), "item_id", "left_semi")


def popularity(snapshots: DataFrame, k: int) -> DataFrame:
    """The k rows with the most contacts (ten times) and views; rows, not items, compete. Without counts every row scores 1."""
    have = set(snapshots.columns)
    if {"contacts_24h", "views_24h"} <= have:
        score = F.col("contacts_24h") * 10 + F.col("views_24h")
    else:
        score = F.col("views_24h") if "views_24h" in have else F.lit(1.0)
    return top(snapshots.select("item_id", score.alias("pop_score")), [F.col("pop_score").desc_nulls_last(), F.col("item_id")], k).select("item_id", "pop_score", "rank")


def burst_trend(pci: DataFrame, listings: DataFrame, cutoff: date, recent_days: int = 7, window_days: int = 30) -> DataFrame:
    """(item_id, recent_leads, prior_leads, trend_score, city_name, category, seller_type) of items with leads in the window."""
    recent, start = cutoff - timedelta(days=recent_days), cutoff - timedelta(days=window_days)
    leads = pci.filter((F.col("date") >= day(start)) & (F.col("lead_count") > 0))
    sums = leads.groupBy("item_id").agg(
        F.coalesce(F.sum(F.when(F.col("date") >= day(recent), F.col("lead_count"))), F.lit(0)).alias("recent_leads"), F.coalesce(F.sum(F.when(F.col("date") < day(recent), F.col("lead_count"))), F.lit(0)).alias("prior_leads")
    )
    score = F.col("recent_leads") * 3.0 + F.col("recent_leads") / (F.col("prior_leads") / float(recent_days) + 1.0)
    return sums.withColumn("trend_score", score).join(listings.select("item_id", "city_name", "category", "seller_type"), "item_id", "left")


def fair_top(scored: DataFrame, by: Sequence[str], k: int, share: float = AGENT_SHARE) -> DataFrame:
    """(by..., item_id, rank): the k best of a group with agents kept near their share.

    Agents go first while they are below the share of what stands before, then
    private sellers, then further agents, then unknown sellers. With agents
    below the share s, the agent after j others comes behind j / s places, the
    private seller after j others behind j / (1 - s), so all ranks follow from a
    row's place among its kind and the sizes of the kinds. Only the k best of
    each kind can be chosen.
    """
    kind = F.when(F.col("seller_type") == "agent", 0).when(F.col("seller_type").isNotNull(), 1).otherwise(2)
    keys = [F.col(c) for c in by] or [F.lit("all").alias("level")]
    names = list(by) or ["level"]
    rows = scored.select(*keys, "item_id", "trend_score", kind.alias("kind"))
    limited = best(rows, [*names, "kind"], [F.col("trend_score").desc(), F.col("item_id")], k, "place")
    group = Window.partitionBy(*names)
    agents, private = (F.sum(F.when(F.col("kind") == i, 1).otherwise(0)).over(group) for i in (0, 1))
    # places while both kinds last, counted from the ones before; each kind follows on where the other is used up
    before = F.col("place") - 1
    agent_at = F.when(before == 0, 1).otherwise(F.floor(F.round(before / share, 9)) + 2)
    private_at = F.when(before == 0, 2).otherwise(F.ceil(F.round(before / (1 - share), 9)) + 1)
    rank = F.when(F.col("kind") == 0, F.least(agent_at, F.col("place") + private)).when(F.col("kind") == 1, F.least(private_at, F.col("place") + agents)).otherwise(F.col("place") + agents + private)
    return limited.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= k).select(*names, "item_id", "rank")


def trend_lookup(trend: DataFrame, wanted: DataFrame, levels: dict[str, list[str]], k: int) -> DataFrame:
    """(pref_city, pref_cat, item_id, rank): the k best of the levels in turn for distinct preferences, each item once.

    Only the k best of a group can be shown, so each level is cut first and a
    preference meets k rows a level. A null preference skips its levels.
    """
    pref = {"city_name": "pref_city", "category": "pref_cat"}
    found = []
    for i, by in enumerate(levels.values()):
        keys = [F.col(x) for x in by] or [F.lit(0)]
        short = trend.select(*[F.col(x).alias(f"_{x}") for x in by], "item_id", "trend_score", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("trend_score").desc(), F.col("item_id"))).alias("n")).filter(F.col("n") <= k)
        same = reduce(Column.__and__, [F.col(f"_{x}") == F.col(pref[x]) for x in by], F.lit(True))
        # without keys the right side has k rows
        found.append(wanted.join(short if by else F.broadcast(short), same).select("pref_city", "pref_cat", "item_id", F.lit(i).alias("level"), "trend_score"))
    once = reduce(DataFrame.unionByName, found).groupBy("pref_city", "pref_cat", "item_id").agg(F.min("level").alias("level"), F.first("trend_score").alias("trend_score"))
    return best(once, ["pref_city", "pref_cat"], [F.col("level"), F.col("trend_score").desc(), F.col("item_id")], k).select("pref_city", "pref_cat", "item_id", "rank")


def segment_popularity(weighted: DataFrame, caps: dict[str, int], valid: DataFrame | None = None) -> DataFrame:
    """(level, city_name, category, district_name, item_id, n, rank) from (item_id, city_name, category, district_name, w).

    One pass of grouping sets counts all levels; a level skips rows where one of
    its own columns is null.
    """
    cols = ["city_name", "category", "district_name"]
    rows = only_valid(weighted, valid).select("item_id", *cols, "w").filter("item_id is not null")
    rows = rows.groupBy("item_id", *cols).agg(F.sum("w").alias("w"))
    sets = [[F.col(c) for c in LEVELS[level]] + [F.col("item_id")] for level in caps]
    # grouping() tells a rolled-up column from a null in the data
    grouped = rows.groupingSets(sets, "item_id", *cols).agg(F.sum("w").alias("n"), *[F.grouping(c).alias(f"off_{c}") for c in cols])
    level = F.lit(None)
    for name in caps:
        held = reduce(Column.__and__, [F.col(f"off_{c}") == (0 if c in LEVELS[name] else 1) for c in cols])
        whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in LEVELS[name]], F.lit(True))
        level = F.when(held & whole, name).otherwise(level)
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])
    ranked = best(grouped.withColumn("level", level).filter("level is not null"), ["level", *cols], [F.col("n").desc(), F.col("item_id")], max(caps.values()))
    return ranked.filter(F.col("rank") <= cap[F.col("level")]).select("level", *cols, "item_id", "n", "rank")


def positive_rows(events: DataFrame, listings: DataFrame) -> DataFrame:
    """Positive logged-in events as weights of 1, with the listing's district."""
    hits = events.filter("is_login = 'login'").filter(F.col("event_type").isin(POSITIVE_EVENTS)).select("item_id", "city_name", "category", F.lit(1).alias("w"))
    return hits.join(listings.select("item_id", "district_name"), "item_id", "left")


def pair_rows(pairs: DataFrame, listings: DataFrame) -> DataFrame:
    return pairs.select("item_id", "city_name", "category", F.col("count").alias("w")).join(listings.select("item_id", "district_name"), "item_id", "left")


def blind_items(snapshots: DataFrame, k: int) -> DataFrame:
    """Items for users nothing is known of: 20 times the contacts plus the views of all their days, or of the weekly averages."""
    if "contacts_24h" in snapshots.columns:
        sums = snapshots.groupBy("item_id").agg((F.coalesce(F.sum("contacts_24h"), F.lit(0)) * 20 + F.coalesce(F.sum("views_24h"), F.lit(0))).alias("score"))
    else:
        sums = snapshots.select("item_id", (F.coalesce("item_avg_contacts_7d", F.lit(0.0)) * 20 + F.coalesce("item_avg_views_7d", F.lit(0.0))).alias("score"))
    return top(sums, [F.col("score").desc(), F.col("item_id")], k).select("item_id", "score", "rank")


def segment_items(segments: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(pref_city, pref_cat, item_id, rank): the first k items from the finest to the coarsest segment, each once.

    wanted holds distinct preferences (pref_city, pref_cat); lists are made once a
    preference, however many users share it. A null preference skips its levels.
    """
    w = wanted.select("pref_city", "pref_cat").distinct()
    seg = segments.filter(F.col("rank") <= k)
    both, city, cat = (seg.filter(F.col("level") == name) for name in ("cc", "city", "cat"))
    lists = [
        w.join(both, (F.col("pref_city") == F.col("city_name")) & (F.col("pref_cat") == F.col("category"))).withColumn("p", F.lit(1)),
        w.join(city, F.col("pref_city") == F.col("city_name")).withColumn("p", F.lit(2)),
        w.join(cat, F.col("pref_cat") == F.col("category")).withColumn("p", F.lit(3)),
        # k rows at most stand on the right
        w.join(F.broadcast(seg.filter("level = 'global'")), F.lit(True)).withColumn("p", F.lit(4)),
    ]
    every = reduce(DataFrame.unionByName, [x.select("pref_city", "pref_cat", "item_id", "p", F.col("rank").alias("r")) for x in lists])
    once = every.groupBy("pref_city", "pref_cat", "item_id").agg(F.min(F.struct("p", "r")).alias("at"))
    return best(once, ["pref_city", "pref_cat"], [F.col("at"), F.col("item_id")], k).select("pref_city", "pref_cat", "item_id", "rank")


def slots(shares: Sequence[tuple[tuple[str, int], float]], remaining: int) -> list[tuple[tuple[str, int], int]]:
    """Places of each segment in a list for unknown users: its share, rounded half to even, one at least."""
    return [(seg, max(1, round(share * remaining))) for seg, share in shares]


def blind_list(segments: DataFrame, shares: Sequence[tuple[tuple[str, int], float]], k: int) -> DataFrame:
    """(item_id, rank): k items for unknown users, places shared out over segments and then filled globally.

    The lists involved hold a few hundred rows whatever the data; they are walked on the driver.
    """
    spark = segments.sparkSession
    wanted = spark.createDataFrame([(c, g) for (c, g), _ in shares], "city_name string, category bigint")
    cc = segments.filter((F.col("level") == "cc") & (F.col("rank") <= k * (len(shares) + 1))).join(F.broadcast(wanted), ["city_name", "category"], "left_semi")
    rows = cc.unionByName(segments.filter((F.col("level") == "global") & (F.col("rank") <= k * (len(shares) + 1)))).orderBy("rank").collect()
    pools: dict = {}
    for r in rows:
        pools.setdefault((r["city_name"], r["category"]) if r["level"] == "cc" else None, []).append(r["item_id"])
    picked: list[str] = []
    for seg, n in [*slots(shares, k), (None, k)]:
        fresh = [i for i in pools.get(seg, []) if i not in set(picked)]
        picked += fresh[: min(n, k - len(picked))]
    return spark.createDataFrame([(i, n + 1) for n, i in enumerate(picked)], "item_id string, rank int")


def rotated(users: DataFrame, ranked: DataFrame, k: int) -> DataFrame:
    """(user_id, item_id, rank): the same short list for everyone, started at a place that depends on the user."""
    n = ranked.agg(F.count(F.lit(1))).scalar()
    shift = stable_bucket(F.col("user_id"), 1 << 30) % F.least(n, F.lit(k))
    shown = users.select("user_id").join(F.broadcast(ranked.select("item_id", F.col("rank").alias("r"))), F.lit(True))
    return shown.select("user_id", "item_id", (F.pmod(F.col("r") - 1 - shift, n) + 1).cast("int").alias("rank"))


def pageview_replay(events: DataFrame, cutoff: date, window_days: int = 14, cap: int = 50) -> DataFrame:
    """The items a user was busy with up to the start of the cutoff day, positive events ten times."""
    start, end = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (cutoff - timedelta(days=window_days), cutoff))
    weight = F.when(F.col("event_type").isin(POSITIVE_EVENTS), 10).otherwise(1)
    seen = events.filter(F.col("event_ts").between(start, end) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    sums = seen.groupBy(*USER_ITEM).agg(F.sum(weight).alias("score"), F.max("event_ts").alias("last_event"))
    return best(sums, ["user_id"], [F.col("score").desc(), F.col("last_event").desc(), F.col("item_id")], cap)


def cocontact_graph(pairs: DataFrame, cutoff: date, window_days: int = 30, most_items: int = 100, reach: int = 19, cap: int = 50) -> DataFrame:
    """(item_id, co_item_id, n, rank): items contacted by the same users.

    Users with too many items are left out, and an item meets only the next
    items of its user in order of id, so a user yields reach times its items at most.
    """
    recent = pairs.filter((F.col("last_date") > day(cutoff - timedelta(days=window_days))) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).select(*USER_ITEM).distinct()
    sized = recent.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(2, most_items))
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("item_id"))
    line = recent.join(sized.select("user_id"), "user_id").withColumn("at", at)
    ahead = F.collect_list("item_id").over(Window.partitionBy("user_id").orderBy("item_id").rowsBetween(1, reach))
    near = line.withColumn("ahead", ahead).select("item_id", F.explode("ahead").alias("co")).groupBy("item_id", "co").agg(F.count(F.lit(1)).alias("n"))
    both = near.select("item_id", F.col("co").alias("co_item_id"), "n").unionByName(near.select(F.col("co").alias("item_id"), F.col("item_id").alias("co_item_id"), "n"))
    return best(both, ["item_id"], [F.col("n").desc(), F.col("co_item_id")], cap)


#: Items of a user whose pairs contact_neighbours() makes rows; users with more meet as sets.
PAIR_ITEMS = 100


def contact_neighbours(pairs: DataFrame, cutoff: date, k: int, window_days: int = 30) -> DataFrame:
    """(item_id, co_item_id, n, rank): the k items that most users contacted beside an item, of all pairs of all users.

    Pairs of users with up to PAIR_ITEMS items are rows. Of users with more, an
    item keeps the set; items with equal sets are one question, and its k + 1 best
    are enough: whatever is behind them and is in no row stays behind them.
    """
    recent = pairs.filter((F.col("last_date") > day(cutoff - timedelta(days=window_days))) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).select(*USER_ITEM).distinct()
    sized = recent.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    few = recent.join(sized.filter(F.col("n").between(2, PAIR_ITEMS)).select("user_id"), "user_id").groupBy("user_id").agg(F.collect_list("item_id").alias("xs"))
    rows = few.select(F.explode("xs").alias("item_id"), "xs").select("item_id", F.explode("xs").alias("co_item_id")).filter("item_id != co_item_id").groupBy("item_id", "co_item_id").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("co_item_id")]
    many = cut_lineage(sized.filter(F.col("n") > PAIR_ITEMS).select("user_id"))
    if many.isEmpty():
        return best(rows, ["item_id"], order, k)
    numbers = row_index(many, ["user_id"], "u").select("user_id", F.col("u").cast("int").alias("u"))
    held = recent.join(numbers, "user_id").groupBy("item_id").agg(F.array_sort(F.collect_list("u")).alias("held"))
    same = Window.partitionBy("held").orderBy("item_id")
    sets = cut_lineage(held.withColumn("at", F.row_number().over(same)).withColumn("like", F.first("item_id").over(same)))
    found = learned.dealt_best(sets.filter("at = 1").select("like", "held"), "like", sets.filter(F.col("at") <= k + 1).select("item_id", "held"), "item_id", k + 1, learned.common_counts(), ["held"], item_rows=learned.SPARSE_ROWS)
    far = sets.select(F.col("item_id").alias("x"), "like").join(found.select("like", F.col("item_id").alias("y"), F.col("score").cast("bigint").alias("n")), "like").filter("x != y").select(F.col("x").alias("item_id"), F.col("y").alias("co_item_id"), "n")
    a, b = sets.select("item_id", F.col("held").alias("a")), sets.select(F.col("item_id").alias("co_item_id"), F.col("held").alias("b"))
    both = rows.join(a, "item_id", "left").join(b, "co_item_id", "left")
    near = both.select("item_id", "co_item_id", (F.col("n") + F.coalesce(F.size(F.array_intersect("a", "b")), F.lit(0))).alias("n"))
    # a pair on both sides has its whole count in near, which is the larger
    return best(near.unionByName(far).groupBy("item_id", "co_item_id").agg(F.max("n").alias("n")), ["item_id"], order, k)


def user_history(pairs: DataFrame, cap: int = 20) -> DataFrame:
    """(user_id, item_id, rank) by recency; rows of one item in several cities stay apart."""
    known = pairs.filter("user_id is not null")
    order = [F.col("last_date").desc_nulls_last(), F.col("item_id"), F.col("city_name").asc_nulls_first(), F.col("category").asc_nulls_first(), F.col("count").desc()]
    return best(known, ["user_id"], order, cap).select(*USER_ITEM, "rank")


def cocontact(history: DataFrame, graph: DataFrame, exclude: DataFrame, k: int, seeds: int = 10, fanout: int = 10) -> DataFrame:
    """Neighbours of the latest items, by summed counts, without excluded pairs."""
    start = history.filter(F.col("rank") <= seeds).select("user_id", F.col("item_id").alias("seed"))
    near = graph.filter(F.col("rank") <= fanout).select(F.col("item_id").alias("seed"), F.col("co_item_id").alias("item_id"), "n")
    votes = start.join(near, "seed").join(exclude.select(*USER_ITEM).distinct(), USER_ITEM, "left_anti").groupBy(*USER_ITEM).agg(F.sum("n").alias("score"))
    return best(votes, ["user_id"], [F.col("score").desc(), F.col("item_id")], k)


PROFILE, FALLBACK = ["district_name", "category", "price_bucket"], ["city_name", "category"]


def intent(views: DataFrame, listings: DataFrame, valid: DataFrame | None, k: int, exclude: DataFrame | None = None, most_excluded: int = 20) -> DataFrame:
    """The freshest listings of the kind a user views most, then of the wider kind.

    Null attributes are values of their own. A user excludes most_excluded items
    at most, which the histories given as exclude are capped to, so k listings of
    a kind and as many more are enough.
    """
    fresh_cap = k if exclude is None else k + most_excluded
    known = only_valid(listings, valid).select("item_id", *dict.fromkeys(PROFILE + FALLBACK), "posted_date")
    seen = views.select(*USER_ITEM).filter("user_id is not null").join(known, "item_id")

    def lists(keys: list[str], priority: int) -> DataFrame:
        n = seen.groupBy("user_id", *keys).agg(F.count(F.lit(1)).alias("n"))
        mine = best(n, ["user_id"], [F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in keys]], 1, "top")
        fresh = best(known, keys, [F.col("posted_date").desc_nulls_last(), F.col("item_id")], fresh_cap)
        m, f = mine.alias("m"), fresh.alias("f")
        same = reduce(Column.__and__, [F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}")) for c in keys])
        return m.join(f, same).select("user_id", "f.item_id", F.lit(priority).alias("p"), F.col("f.rank").alias("r"))

    every = lists(PROFILE, 1).unionByName(lists(FALLBACK, 2))
    if exclude is not None:
        every = every.join(exclude.select(*USER_ITEM).distinct(), USER_ITEM, "left_anti")
    once = every.groupBy(*USER_ITEM).agg(F.min(F.struct("p", "r")).alias("at"))
    ranked = best(once, ["user_id"], [F.col("at"), F.col("item_id")], k)
    return ranked.select(*USER_ITEM, (F.lit(k + 1) - F.col("rank")).cast("double").alias("score"), "rank")


def intent_lists(views: DataFrame, listings: DataFrame, valid: DataFrame | None, k: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """What intent() gives, as users with the kinds they view most, and k items for every two kinds that occur together.

    Returns (user_id, kinds), (kinds, item_id, rank) and the names of the kinds' columns.
    """
    known = only_valid(listings, valid).select("item_id", *dict.fromkeys(PROFILE + FALLBACK), "posted_date")
    seen = views.select(*USER_ITEM).filter("user_id is not null").join(known, "item_id")
    n = seen.groupBy("user_id", *dict.fromkeys(PROFILE + FALLBACK)).agg(F.count(F.lit(1)).alias("n"))
    kinds = {"p": PROFILE, "f": FALLBACK}
    names = {p: [f"{p}_{c}" for c in keys] for p, keys in kinds.items()}

    def most_viewed(p: str) -> DataFrame:
        sums = n.groupBy("user_id", *kinds[p]).agg(F.sum("n").alias("n"))
        mine = best(sums, ["user_id"], [F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in kinds[p]]], 1, "top")
        return mine.select("user_id", *[F.col(c).alias(x) for c, x in zip(kinds[p], names[p])])

    users = most_viewed("p").join(most_viewed("f"), "user_id")
    wanted = users.select(*names["p"], *names["f"]).distinct()

    def lists(p: str, priority: int) -> DataFrame:
        fresh = best(known, kinds[p], [F.col("posted_date").desc_nulls_last(), F.col("item_id")], k)
        same = reduce(Column.__and__, [F.col(x).eqNullSafe(F.col(c)) for c, x in zip(kinds[p], names[p])])
        return wanted.join(fresh, same).select(*names["p"], *names["f"], "item_id", F.lit(priority).alias("p"), F.col("rank").alias("r"))

    by = [*names["p"], *names["f"]]
    once = lists("p", 1).unionByName(lists("f", 2)).groupBy(*by, "item_id").agg(F.min(F.struct("p", "r")).alias("at"))
    return users, best(once, by, [F.col("at"), F.col("item_id")], k).select(*by, "item_id", "rank"), by


def user_knn(pairs: DataFrame, queries: DataFrame | None, k: int, history: int = 5, item_cap: int = 30, neighbour_cap: int = 30, all_vote: bool = False) -> DataFrame:
    """Items of users who contacted the same items, by the number of ways they are reached.

    Both caps bound the fan-out of every user and item. Users asked about are no
    neighbours; without queries every user is asked and every other one may be a
    neighbour, and so it is with all_vote for those asked about.
    """
    rows = pairs.filter("count > 0 and user_id is not null").groupBy(*USER_ITEM).agg(F.max("last_date").alias("last_date"))
    asks, votes = F.lit(True), F.lit(True)
    if queries is not None:
        rows = rows.join(queries.select("user_id", F.lit(True).alias("asked")).distinct(), "user_id", "left")
        asks = F.col("asked").isNotNull()
        votes = F.lit(True) if all_vote else ~asks
    recent = [F.col("last_date").desc_nulls_last()]
    # one place more, as the user may hold one
    place = F.row_number().over(Window.partitionBy("item_id", "votes").orderBy(*recent, F.col("user_id")))
    placed = rows.select(*USER_ITEM, "last_date", asks.alias("asks"), votes.alias("votes")).withColumn("place", F.when(F.col("votes"), place))
    at = F.row_number().over(Window.partitionBy("user_id").orderBy(*recent, F.col("item_id")))
    kept = placed.withColumn("at", at).filter((F.col("at") <= item_cap) | (F.col("place") <= neighbour_cap + 1))
    lists = kept.groupBy("user_id").agg(F.first("asks").alias("asks"), F.first("votes").alias("votes"), F.collect_list(F.struct("at", "item_id", "place")).alias("xs"))
    return voted(lists, k, history, item_cap, neighbour_cap + 1)


def seller_expansion(pairs: DataFrame, listings: DataFrame, valid: DataFrame | None, k: int, sellers: int = 15, items_per_seller: int = 10) -> DataFrame:
    """Other listings of the sellers a user contacted; the earlier a seller came, the higher."""
    rows = pairs.filter("count > 0 and user_id is not null").groupBy(*USER_ITEM).agg(F.max("last_date").alias("last_date"))
    line = best(rows, ["user_id"], [F.col("last_date").desc_nulls_last(), F.col("item_id")], None, "at")
    owner = listings.filter("seller_id is not null").select("item_id", "seller_id")
    # a seller of whom a user holds n items has k others among the first k + n
    met = line.join(owner, "item_id").groupBy("user_id", "seller_id").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("held")).filter(F.col("at") <= sellers)
    stock = best(only_valid(owner, valid), ["seller_id"], [F.col("item_id")], items_per_seller, "place")
    stock = stock.withColumn("nth", F.dense_rank().over(Window.partitionBy("seller_id").orderBy("item_id")))
    near = met.join(stock, "seller_id").filter(F.col("nth") <= F.col("held") + k)
    offered = near.join(rows.select(*USER_ITEM), USER_ITEM, "left_anti").groupBy(*USER_ITEM).agg(F.max(1.0 / F.col("at")).alias("score"))
    return best(offered, ["user_id"], [F.col("score").desc(), F.col("item_id")], k)


def recent_by_segment(pairs: DataFrame, cutoff: date, window_days: int = 7, cap: int = 200) -> DataFrame:
    """(city_name, category, item_id, n, rank): rows, not contacts, of the last days."""
    recent = pairs.filter((F.col("last_date") > day(cutoff - timedelta(days=window_days))) & F.col("city_name").isNotNull() & F.col("category").isNotNull())
    n = recent.groupBy("city_name", "category", "item_id").agg(F.count(F.lit(1)).alias("n"))
    return best(n, ["city_name", "category"], [F.col("n").desc(), F.col("item_id")], cap)


def item2item_graph(events: DataFrame, valid: DataFrame | None = None, sizes: tuple[int, int] = (2, 50), least: int = 3, cap: int = 50) -> DataFrame:
    """(item_id, similar_id, n, rank): items seen in the same tracker sessions. The size test comes before the valid filter."""
    kinds = ["pageview", *REAL_CONTACTS]
    seen = events.filter("is_login = 'login' and session_id is not null").filter(F.col("event_type").isin(kinds)).select("session_id", "item_id").distinct()
    sized = seen.groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(*sizes)).select("session_id")
    kept = only_valid(seen.join(sized, "session_id").filter("item_id is not null"), valid)
    a, b = kept.alias("a"), kept.alias("b")
    pairs = a.join(b, (F.col("a.session_id") == F.col("b.session_id")) & (F.col("a.item_id") < F.col("b.item_id"))).groupBy(F.col("a.item_id").alias("x"), F.col("b.item_id").alias("y")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    both = pairs.select(F.col("x").alias("item_id"), F.col("y").alias("similar_id"), "n").unionByName(pairs.select(F.col("y").alias("item_id"), F.col("x").alias("similar_id"), "n"))
    return best(both, ["item_id"], [F.col("n").desc(), F.col("similar_id")], cap)


def item2item(seeds: DataFrame, graph: DataFrame, listings: DataFrame, prefs: DataFrame | None, exclude: DataFrame, k: int) -> DataFrame:
    """Similar items of a user's seeds; the preferred city counts one and a half times, others half, all once without a preference."""
    near = seeds.select("user_id", "item_id").join(graph.select("item_id", "similar_id", "n"), "item_id").select("user_id", F.col("similar_id").alias("item_id"), "n")
    near = near.join(exclude.select(*USER_ITEM).distinct(), USER_ITEM, "left_anti")
    factor = F.lit(1.0)
    if prefs is not None:
        near = near.join(prefs.select("user_id", "pref_city"), "user_id", "left").join(listings.select("item_id", "city_name"), "item_id", "left")
        factor = F.when(F.col("pref_city").isNull(), 1.0).when(F.col("city_name") == F.col("pref_city"), 1.5).otherwise(0.5)
    votes = near.groupBy(*USER_ITEM).agg(F.sum(F.col("n") * factor).alias("score"))
    return best(votes, ["user_id"], [F.col("score").desc(), F.col("item_id")], k)

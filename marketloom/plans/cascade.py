"""Queries of the cascade and the ensembles."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.constants import BUDGETS_POOL, BUDGETS_TOP10, CUTOFF, ITEMS_PER_SELLER, ORDER_POOL, ORDER_TOP10, POOL_SIZE, TOP_K
from marketloom.functions.ranking import best
from marketloom.operators import candidates as c
from marketloom.operators import cascade, cleaning, features, learned
from marketloom.operators.relational import row_index
from marketloom.plans import candidates as cq
from marketloom.plans import scoring
from marketloom.plans.cleaning import all_users
from marketloom.plans.registry import Registry
from marketloom.session import cut_lineage, stored
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query


def stored_segments(t: Tables) -> DataFrame:
    """A few hundred rows a segment, read by every level of segment_source() and by the padding."""
    return stored(cq.segments(t))


#: Neighbours that an item of a user's history offers.
FANOUT = 10


class Parts:
    """What the sources need whoever is asked about, made when first used.

    again: sources are asked more than once, so all of it is stored.
    """

    def __init__(self, t: Tables, again: bool = False) -> None:
        self.t, self.again, self._intents = t, again, {}
        self.contacts = t.contact_pairs.filter("user_id is not null")

    def kept(self, df: DataFrame) -> DataFrame:
        return stored(df) if self.again else df

    @cached_property
    def segments(self) -> DataFrame:
        return stored_segments(self.t)

    @cached_property
    def prefs(self) -> DataFrame:
        return stored(cq.prefs(self.t))

    @cached_property
    def history(self) -> DataFrame:
        return self.kept(c.user_history(self.contacts))

    @cached_property
    def near(self) -> DataFrame:
        """All pairs of all users; g5_cocontact_graph leaves out large users and far items."""
        return self.kept(c.contact_neighbours(self.contacts, CUTOFF, FANOUT))

    @cached_property
    def replay(self) -> DataFrame:
        return self.kept(c.pageview_replay(self.t.events, CUTOFF).select("user_id", "item_id", "rank"))

    @cached_property
    def factors(self) -> tuple[DataFrame, DataFrame]:
        users, items = learned.fit_als(cleaning.weighted_contact_scores(self.t.events))
        return self.kept(users), self.kept(items)

    def intent(self, k: int) -> tuple[DataFrame, DataFrame, list[str]]:
        if k not in self._intents:
            viewers, lists, kinds = c.intent_lists(cq.recent_views(self.t), self.t.listings, cq.valid_items(self.t), k)
            self._intents[k] = self.kept(viewers), self.kept(lists), kinds
        return self._intents[k]


def segment_source(t: Tables, users: DataFrame, segments: DataFrame, prefs: DataFrame, k: int) -> DataFrame:
    """Items of a user's segments, as many as places are left; users without preferences get the blind list."""
    lists, blind = c.segment_items(segments, prefs, k), c.blind_list(segments, cq.blind_shares(t), k)
    known = users.select("user_id").distinct().join(prefs.withColumn("known", F.lit(True)), "user_id", "left")
    wanted = lists.withColumn("known", F.lit(True))
    return cascade.rest_lists(known, wanted, ["known", "pref_city", "pref_cat"], blind, cq.valid_items(t), c.stable_bucket(F.col("user_id"), 1 << 30))


def sources(t: Tables, users: DataFrame, names: list[str], k: int, parts: Parts | None = None, some: bool = False) -> list[cascade.Source]:
    """The named sources, fitted on everything up to the cutoff. some: users are a small share, so others are left out first."""
    parts = Parts(t) if parts is None else parts
    contacts, valid = parts.contacts, cq.valid_items(t)
    of = (lambda rows: rows.join(users.select("user_id").distinct(), "user_id", "left_semi")) if some else (lambda rows: rows)
    budgets = BUDGETS_POOL if k > TOP_K else BUDGETS_TOP10

    def recent_cc() -> DataFrame:
        lists = c.only_valid(c.recent_by_segment(contacts, CUTOFF), valid).select(F.col("city_name").alias("pref_city"), F.col("category").alias("pref_cat"), "item_id", "rank")
        return cascade.shared_lists(of(parts.prefs).filter("pref_city is not null and pref_cat is not null"), lists, ["pref_city", "pref_cat"], k)

    def intent() -> DataFrame:
        viewers, lists, kinds = parts.intent(BUDGETS_POOL["intent"] + k)
        return cascade.shared_lists(of(viewers), lists, kinds, BUDGETS_POOL["intent"] + k)

    build = {
        "pv": lambda: cascade.Source("pv", of(parts.replay)),
        "intent": lambda: cascade.Source("intent", intent(), cascade.INDEXED, True),
        "cocontact": lambda: cascade.Source("cocontact", stored(c.cocontact(of(parts.history), parts.near, parts.history.limit(0), BUDGETS_POOL["cocontact"] + k).select("user_id", "item_id", "rank")), cascade.PLACED_FIRST),
        "als": lambda: cascade.Source("als", stored(learned.als_top(None, users, BUDGETS_POOL["als"] if k > TOP_K else TOP_K, valid, fitted=parts.factors).select("user_id", "item_id", "rank")), cascade.WHOLE, True),
        "user_knn": lambda: cascade.Source("user_knn", stored(c.user_knn(contacts, users if some else None, budgets["user_knn"], all_vote=True).select("user_id", "item_id", "rank"))),
        "seller": lambda: cascade.Source("seller", c.seller_expansion(of(contacts), t.listings, valid, budgets["seller"], items_per_seller=ITEMS_PER_SELLER), all_valid=True),
        "recent_cc": lambda: cascade.Source("recent_cc", recent_cc(), cascade.WHOLE, True),
        "segpop": lambda: cascade.Source("segpop", segment_source(t, users, parts.segments, parts.prefs, k), cascade.REST),
    }
    return [build[n]() for n in names]


#: The orders without the source that has a budget of 0.
SHALLOW, DEEP = ([n for n in order if n != "als_view"] for order in (ORDER_TOP10, ORDER_POOL))


def top_lists(t: Tables, names: list[str] = SHALLOW, users: DataFrame | None = None, parts: Parts | None = None, some: bool = False) -> DataFrame:
    users = stored(all_users(t)) if users is None else users
    return cascade.fold_lists(users, sources(t, users, names, TOP_K, parts, some), BUDGETS_TOP10, TOP_K, cq.valid_items(t))


def filled_lists(t: Tables, names: list[str] = SHALLOW, users: DataFrame | None = None, parts: Parts | None = None, some: bool = False) -> DataFrame:
    parts = Parts(t) if parts is None else parts
    popular = parts.segments.filter("level = 'global'").select("item_id", "rank")
    return cascade.filled_lists(top_lists(t, names, users, parts, some), popular, TOP_K, cq.valid_items(t))


def padded_lists(t: Tables, names: list[str] = SHALLOW, users: DataFrame | None = None) -> DataFrame:
    return cascade.laid_out(filled_lists(t, names, users))


@query("c1_single_user")
def c1_single_user(t: Tables) -> DataFrame:
    """The list of the user with the smallest id: the same plan for one user."""
    one = all_users(t).orderBy("user_id").limit(1)
    return cascade.fold(one, sources(t, one, SHALLOW, TOP_K), BUDGETS_TOP10, TOP_K, cq.valid_items(t))


@query("c2_cascade_top10")
def c2_cascade_top10(t: Tables) -> DataFrame:
    return cascade.laid_out(top_lists(t))


@query("c3_tracked_pool")
def c3_tracked_pool(t: Tables) -> DataFrame:
    """Pools of up to 200 with their sources, without a cap on what a source may place, labelled by the contacts of the last week."""
    users = t.contact_pairs.select("user_id").filter("user_id is not null").distinct()
    pool = cascade.fold(users, sources(t, users, DEEP, POOL_SIZE), BUDGETS_POOL, POOL_SIZE, cq.valid_items(t), capped=False)
    late = t.contact_pairs.filter("last_date > date'2026-04-02'")
    return cascade.tracked(pool, ORDER_POOL, late)


@query("c7_padded_cascade")
def c7_padded_cascade(t: Tables) -> DataFrame:
    return padded_lists(t)


#: Users of one pass from sources to lists in c8_lists_by_segment: what a pass shuffles and stores is gone before the next.
POOL_USERS = 1 << 17


def pool_ranker(t: Tables) -> tuple[dict[str, float], tuple[DataFrame, DataFrame]]:
    """The weights of a ranker trained on earlier weeks, and the features of users and items at the cutoff."""
    trained = stored(scoring.training_rows(t, learned.compared_rows))
    model = learned.fit_pairwise(trained, scoring.FEATURES)
    weights = dict(zip(scoring.FEATURES, model.stages[-1].coefficients.toArray().tolist()))
    of_users, of_items = scoring.features_until(t, CUTOFF, features.split_features)
    return weights, (stored(of_users), stored(of_items))


@query("c8_lists_by_segment")
def c8_lists_by_segment(t: Tables) -> DataFrame:
    """Users with contacts get the best of their pool by a ranker trained on earlier weeks, all others the padded cascade."""
    seg = cut_lineage(cleaning.user_segments(all_users(t), t.contact_pairs, t.events.filter("event_type = 'pageview'")))
    users = seg.filter("segment = 'warm'").select("user_id")
    weights, (of_users, of_items) = pool_ranker(t)
    parts, n = Parts(t, again=True), -(-users.count() // POOL_USERS) or 1

    def ranked(block: DataFrame) -> DataFrame:
        lists = cascade.fold_lists(block, sources(t, block, DEEP, POOL_SIZE, parts, True), BUDGETS_POOL, POOL_SIZE, cq.valid_items(t), capped=False)
        pools = lists.select("user_id", F.col("placed.item_id").alias("items"))
        found = learned.ranked_by_parts(weights, pools, of_users, of_items, TOP_K)
        return stored(found.select("user_id", "item_id", F.col("rank").alias("pos")))

    blocks = [ranked(cut_lineage(users.filter(F.pmod(F.xxhash64("user_id"), F.lit(n)) == i))) for i in range(n)]
    warm = reduce(DataFrame.unionByName, blocks)
    # sources from contacts have nothing for users without
    rest = cut_lineage(seg.filter("segment != 'warm'").select("user_id"))
    names = [n for n in SHALLOW if n not in ("cocontact", "user_knn", "seller")]
    other = cascade.laid_out(stored(filled_lists(t, names, rest, parts, True))).select("user_id", "item_id", "pos")
    return cascade.by_segment(seg, {"warm": warm, "cold": other, "blind": other})


@query("c9_submission")
def c9_submission(t: Tables) -> DataFrame:
    users = row_index(all_users(t).filter("user_id is not null").distinct(), ["user_id"], "user_pos")
    return cascade.submission(stored(filled_lists(t)), users)


@query("c10_contributions")
def c10_contributions(t: Tables) -> DataFrame:
    return cascade.contributions(cascade.laid_out(top_lists(t)))


TWO = """
    a AS (SELECT user_id, item_id, count(*)::DOUBLE AS score, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item_id) AS r FROM fact_user_events WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND event_type = 'pageview' GROUP BY 1, 2 QUALIFY r <= 20),
    b AS (SELECT user_id, item_id, sum(count)::DOUBLE AS score, row_number() OVER (PARTITION BY user_id ORDER BY sum(count) DESC, item_id) AS r FROM contact_pairs WHERE user_id IS NOT NULL GROUP BY 1, 2 QUALIFY r <= 20)
"""


def two_sources(t: Tables) -> tuple[DataFrame, DataFrame]:
    views = t.events.filter("user_id is not null and item_id is not null and event_type = 'pageview'").groupBy("user_id", "item_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    contacts = t.contact_pairs.filter("user_id is not null").groupBy("user_id", "item_id").agg(F.sum("count").cast("double").alias("score"))
    return tuple(best(x, ["user_id"], [F.col("score").desc(), F.col("item_id")], 20) for x in (views, contacts))


@query(
    "c5_first_source_wins",
    f"""WITH {TWO}, s AS (SELECT *, 0 AS source FROM a UNION ALL SELECT *, 1 FROM b),
        n AS (SELECT user_id, item_id, source, r, CASE WHEN max(score) OVER w > min(score) OVER w THEN (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) ELSE 1.0 END AS score FROM s WINDOW w AS (PARTITION BY user_id, source)),
        o AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY source, r) = 1)
        SELECT user_id, item_id, source, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY source, r, item_id) AS INTEGER) AS rank FROM o QUALIFY rank <= 20""",
)
def c5_first_source_wins(t: Tables) -> DataFrame:
    return cascade.first_source_wins(two_sources(t), 20).withColumn("score", F.round("score", 6))


@query(
    "c6_weighted_blend",
    f"""WITH {TWO}, n AS (
        SELECT user_id, item_id, 0.7::DOUBLE * CASE WHEN count(*) OVER w > 1 THEN (score - min(score) OVER w) / CASE WHEN max(score) OVER w > min(score) OVER w THEN max(score) OVER w - min(score) OVER w ELSE 1.0 END ELSE score END AS score FROM a WINDOW w AS (PARTITION BY user_id)
        UNION ALL SELECT user_id, item_id, 0.3::DOUBLE * CASE WHEN count(*) OVER w > 1 THEN (score - min(score) OVER w) / CASE WHEN max(score) OVER w > min(score) OVER w THEN max(score) OVER w - min(score) OVER w ELSE 1.0 END ELSE score END FROM b WINDOW w AS (PARTITION BY user_id)),
        g AS (SELECT user_id, item_id, round(sum(score), 6) AS score FROM n GROUP BY 1, 2)
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM g QUALIFY rank <= 10""",
)
def c6_weighted_blend(t: Tables) -> DataFrame:
    views, contacts = two_sources(t)
    blended = cascade.weighted_blend([(views, 0.7), (contacts, 0.3)], 40).withColumn("score", F.round("score", 6)).drop("rank")
    return best(blended, ["user_id"], [F.col("score").desc(), F.col("item_id")], 10)

"""Offline metrics over ranked lists, and checks of a final output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.constants import AGENT_SHARE, CATEGORY_SHARES, POSITIVE_EVENTS

KEY = ["user_id", "item_id"]


def ground_truth(events: DataFrame, after: str) -> DataFrame:
    """Distinct positive pairs of logged-in users after a day."""
    return events.filter((F.col("date") > F.lit(after).cast("date")) & (F.col("is_login") == "login") & F.col("user_id").isNotNull()).filter(F.col("event_type").isin(POSITIVE_EVENTS)).select(*KEY).filter("item_id is not null").distinct()


def per_user(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """One row a user with truth: n_true, hits, recall, recall_capped, precision, ndcg, average precision, hit.

    recs: (user_id, item_id, rank), each item once a user. Users without
    recommendations count with zeros.
    """
    n = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_true"))
    got = recs.filter(F.col("rank") <= k).join(truth.withColumn("hit", F.lit(1)), KEY, "inner").select("user_id", "rank")
    running = F.row_number().over(Window.partitionBy("user_id").orderBy("rank"))
    sums = got.withColumn("so_far", running).groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"), F.sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("dcg"), F.sum(F.col("so_far") / F.col("rank")).alias("ap"))
    out = n.join(sums, "user_id", "left").fillna(0, ["hits", "dcg", "ap"])
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_true"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))
    return out.select(
        "user_id",
        "n_true",
        "hits",
        (F.col("hits") / F.col("n_true")).alias("recall"),
        (F.col("hits") / F.least(F.col("n_true"), F.lit(k))).alias("recall_capped"),
        (F.col("hits") / float(k)).alias("precision"),
        (F.col("dcg") / ideal).alias("ndcg"),
        (F.col("ap") / F.col("n_true")).alias("ap"),
        (F.col("hits") > 0).cast("int").alias("hit"),
    )


def averages(users: DataFrame) -> DataFrame:
    """Means over users with truth; hits_per_user is the plain number of hits a user."""
    return users.agg(F.count(F.lit(1)).alias("n_users"), *[F.avg(c).alias(c) for c in ("recall", "recall_capped", "precision", "ndcg", "ap")], F.avg("hits").alias("hits_per_user"), F.avg("hit").alias("hit_rate"))


def list_recall(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """(user_id, recall) with repeated recommendations and repeated truth counted as often as they occur."""
    n = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_true"))
    got = recs.filter(F.col("rank") <= k).join(truth.select(*KEY).distinct(), KEY, "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))
    return n.join(got, "user_id", "left").select("user_id", (F.coalesce("hits", F.lit(0)) / F.col("n_true")).alias("recall"))


def feature_diversity(recs: DataFrame, features: DataFrame, column: str) -> DataFrame:
    """(user_id, diversity): share of pairs of a list that differ in a feature; 1 below two items. Nulls differ from nothing but each other."""
    known = recs.select(*KEY).join(features.select("item_id", F.col(column).alias("f")), "item_id", "left")
    counts = known.groupBy("user_id", "f").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy("user_id").agg(F.sum("n").alias("t"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("same"))
    return sums.select("user_id", F.when(F.col("t") < 2, 1.0).otherwise(1.0 - F.col("same") / F.greatest(F.col("t") * (F.col("t") - 1) / 2, F.lit(1.0))).alias("diversity"))


def novelty(recs: DataFrame, contacts: DataFrame) -> DataFrame:
    """(user_id, novelty): mean of -log2((users of the item + 1) / (users + 1))."""
    pop = contacts.filter("user_id is not null").select(*KEY).distinct().groupBy("item_id").agg(F.count(F.lit(1)).alias("pop"))
    n = contacts.agg(F.countDistinct("user_id")).scalar()
    return recs.join(pop, "item_id", "left").groupBy("user_id").agg(F.avg(-F.log2((F.coalesce("pop", F.lit(0)) + 1.0) / (n + 1.0))).alias("novelty"))


def list_health(recs: DataFrame, listings: DataFrame) -> DataFrame:
    """(user_id, n, diversity, fairness, freshness) of short lists; unknown ages count 30 days.

    All terms follow from counts by attribute, so no list meets itself.
    """
    cols = ["category", "city_name", "district_name", "seller_type", "listing_age_days"]
    known = recs.select(*KEY).join(listings.select("item_id", *cols), "item_id", "left")

    def same(by: list[str], out: str) -> DataFrame:
        n = known.groupBy("user_id", *by).agg(F.count(F.lit(1)).alias("n"))
        return n.groupBy("user_id").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias(out))

    cats = known.groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("user_id"))
    cats = cats.withColumn("share", F.col("n") / total)
    entropy = cats.groupBy("user_id").agg((-F.sum(F.col("share") * F.log2("share"))).alias("h"), F.count(F.lit(1)).alias("kinds"))
    expected = F.create_map(*[F.lit(x) for kv in CATEGORY_SHARES.items() for x in kv])[F.col("category")]
    eps = 1e-10
    term = F.when(expected.isNotNull(), F.col("share") * F.ln((F.col("share") + eps) / (expected + eps))).otherwise(0.0)
    kl = cats.groupBy("user_id").agg(F.sum(term).alias("kl"))
    base = known.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.coalesce((F.col("seller_type") == "agent").cast("double"), F.lit(0.0))).alias("agents"), F.avg(F.exp(-0.05 * F.coalesce("listing_age_days", F.lit(30)))).alias("freshness")
    )
    out = base.join(same(["category"], "sc"), "user_id").join(same(["city_name"], "sv"), "user_id").join(same(["city_name", "district_name"], "sd"), "user_id").join(entropy, "user_id").join(kl, "user_id")
    pairs = F.greatest(F.col("n") * (F.col("n") - 1) / 2, F.lit(1.0))
    ild = 1.0 - (0.4 * F.col("sc") + 0.3 * F.col("sv") + 0.3 * F.col("sd")) / pairs
    scaled = F.when(F.col("kinds") > 1, F.col("h") / F.log2(F.greatest(F.col("kinds"), F.lit(2)).cast("double"))).otherwise(F.col("h"))
    diversity = F.when(F.col("n") <= 1, 1.0).otherwise(0.6 * ild + 0.4 * scaled)
    fairness = 0.6 * (1.0 - F.abs(F.col("agents") - AGENT_SHARE)) + 0.4 * F.exp(-F.col("kl"))
    return out.select("user_id", "n", diversity.alias("diversity"), fairness.alias("fairness"), "freshness")


def coverage(recs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(n_items, n_catalogue, coverage, top_share): share of the catalogue shown, and of places taken by the top hundredth of shown items."""
    shown = recs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = shown.groupBy("n").agg(F.count(F.lit(1)).alias("items"))
    before = F.sum("items").over(Window.orderBy(F.col("n").desc())) - F.col("items")
    count = F.sum("items").over(Window.partitionBy())
    limit = F.greatest(F.floor(count / 100), F.lit(1))
    taken = F.greatest(F.least(F.col("items"), limit - before), F.lit(0)) * F.col("n")
    marked = sizes.select("n", "items", taken.alias("taken"))
    total = catalogue.select("item_id").distinct().agg(F.count(F.lit(1))).scalar()
    return marked.agg(F.sum("items").alias("n_items"), (F.sum("taken") / F.sum(F.col("n") * F.col("items"))).alias("top_share")).select("n_items", total.alias("n_catalogue"), (F.col("n_items") / total).alias("coverage"), "top_share")


def violations(out: DataFrame, users: DataFrame, listings: DataFrame, k: int = 10, most_first: float = 0.1) -> DataFrame:
    """One row of counts, all 0 for a valid output (ID, user_id, rank, item_id)."""
    base = out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("ID").isNull() | F.col("user_id").isNull() | F.col("rank").isNull() | F.col("item_id").isNull()).alias("nulls"),
        F.abs(F.count(F.lit(1)) - F.countDistinct("ID") + F.coalesce(F.max("ID") - F.count(F.lit(1)), F.lit(0))).alias("id_gaps"),
        F.count_if(~F.col("rank").between(1, k)).alias("bad_ranks"),
    )
    by_user = out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("item_id").alias("items"), F.countDistinct("rank").alias("ranks"))
    lists = by_user.agg(F.count_if((F.col("n") != k) | (F.col("items") != k) | (F.col("ranks") != k)).alias("bad_lists"))
    missing = users.select("user_id").distinct().join(out.select("user_id"), "user_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_users"))
    extra = out.select("user_id").distinct().join(users.select("user_id"), "user_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_users"))
    orphans = out.select("item_id").distinct().join(listings.select("item_id"), "item_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_items"))
    first = out.filter("rank = 1").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    crowded = first.agg((F.max("n") > F.sum("n") * most_first).cast("int").alias("crowded_first"))
    one = F.lit(True)
    for part in (lists, missing, extra, orphans, crowded):  # one row each
        base = base.join(F.broadcast(part), one)
    return base

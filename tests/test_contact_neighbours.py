"""Co-contacts of the cascade: all pairs of all users count, however many items a user has."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marketloom.constants import CUTOFF
from marketloom.operators import candidates as c
from marketloom.operators import learned
from marketloom.plans import cascade
from tests.support import DATA, tuples


def contacts(spark, held, old=()):
    rows = [(u, i, "2026-04-01") for u, xs in held.items() for i in xs] + [(u, i, "2026-03-01") for u, i in old]
    return spark.createDataFrame(rows, "user_id string, item_id string, day string").select("user_id", "item_id", F.col("day").cast("date").alias("last_date"), F.lit(None).cast("string").alias("city_name"), F.lit(None).cast("bigint").alias("category"), F.lit(1).cast("bigint").alias("count"))


def simulated(held, k):
    n = Counter((x, y) for xs in held.values() for x in set(xs) for y in set(xs) if x != y)
    of = {}
    for (x, y), m in n.items():
        of.setdefault(x, []).append((-m, y))
    return sorted((x, y, -m, r + 1) for x, ys in of.items() for r, (m, y) in enumerate(sorted(ys)[:k]))


@pytest.mark.parametrize("pair_items", [0, 3, 8, 100])
def test_neighbours_equal_brute_force(spark, monkeypatch, pair_items):
    """Rows only, sets only and both at once, in several blocks; equal sets, ties, users with one item."""
    for where, name, size in ((c, "PAIR_ITEMS", pair_items), (learned, "SPARSE_ROWS", 9), (learned, "SPARSE_STRIP", 4)):
        monkeypatch.setattr(where, name, size)
    rng = random.Random(pair_items)
    items = [f"i{n:02d}" for n in range(40)]
    held = {f"u{u}": rng.sample(items[: 10 + 10 * (u % 4)], rng.choice([1, 2, 5, 9, 10])) for u in range(25)}
    held |= {"bot": items[8:38], "twin": items[8:38] * 2}
    got = c.contact_neighbours(contacts(spark, held, [("u0", "i39"), (None, "i38")]), date(2026, 4, 9), 4)
    assert tuples(got) == sorted(simulated(held, 4), key=repr)


def test_a_user_of_many_items_offers_all_of_them(spark):
    """Of 150 items all meet; with 30 items the first meets the last. Before, neither was a pair."""
    large, wide = [f"b{n:03d}" for n in range(150)], [f"w{n:02d}" for n in range(30)]
    held = {"large": large, "wide": wide, **{f"u{n}": ["w00", "w29"] for n in range(3)}}
    parts = cascade.Parts(SimpleNamespace(contact_pairs=contacts(spark, held)))
    assert tuples(parts.near) == sorted(simulated(held, 10), key=repr)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The test tables, with contacts of four users of the same 120 listings and of one user of the first of them."""
    at = tmp_path_factory.mktemp("large_users")
    for p in Path(DATA).iterdir():
        if p.stem not in ("contact_pairs", "dim_listing", "fact_user_events"):
            (at / p.name).symlink_to(p)
    names = [f"w{n:03d}" for n in range(120)]
    held = {"zz": names[:1], **{f"b{n}": names for n in range(4)}}
    contacts(spark, held).write.parquet(f"{at}/contact_pairs.parquet")
    listings = spark.read.parquet(f"{DATA}/dim_listing.parquet")
    new = listings.filter("ad_status = 'active'").limit(1).drop("item_id").join(spark.createDataFrame([(x,) for x in names], "item_id string"))
    listings.unionByName(new).write.parquet(f"{at}/dim_listing.parquet")
    # users of the cascade are those with events
    events = spark.read.parquet(f"{DATA}/fact_user_events.parquet")
    seen = events.filter("user_id is not null").limit(1).drop("user_id").join(spark.createDataFrame([(u,) for u in held], "user_id string"))
    events.unionByName(seen).write.parquet(f"{at}/fact_user_events.parquet")
    return str(at)


@pytest.mark.parametrize("query", ["c10_contributions", "c2_cascade_top10", "c3_tracked_pool", "c7_padded_cascade", "c9_submission"])
def test_queries_offer_what_large_users_contacted(spark, monkeypatch, folder, query):
    """With co-contacts as the only source; before, users of 120 items gave none."""
    every = cascade.sources
    monkeypatch.setattr(cascade, "sources", lambda t, users, names, *more: every(t, users, ["cocontact"], *more))
    got = cascade.REGISTRY.queries[query](spark, folder)
    if query == "c10_contributions":
        assert tuples(got.filter("source = 'cocontact'")) == [("cocontact", 25, 5)]
        return
    place = next(x for x in ("pos", "rank") if x in got.columns)
    mine = [r["item_id"] for r in got.filter("user_id = 'zz'").orderBy(place).collect()]
    n = 10 if query == "c3_tracked_pool" else 5
    assert mine[:n] == [f"w{i:03d}" for i in range(1, n + 1)]

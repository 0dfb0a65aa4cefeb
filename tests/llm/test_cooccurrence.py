import random
from collections import Counter
from itertools import combinations

import pytest

from marketloom.llm.cooccurrence import item_pairs
from tests.support import tuples

SCHEMA = "u string, i string, basket int, item int, n int, a int, b int"


def table(spark, rows):
    return spark.createDataFrame([(u, i, 1, 2, 3, 4, 5) for u, i in rows], SCHEMA)


def brute(rows, least, lift=0.0):
    baskets = {}
    for u, i in rows:
        if u is not None and i is not None:
            baskets.setdefault(u, set()).add(i)
    n = Counter(i for b in baskets.values() for i in b)
    pairs = Counter(p for b in baskets.values() for p in combinations(sorted(b), 2))
    return sorted(((a, b, n[a], n[b], c, len(baskets)) for (a, b), c in pairs.items() if c >= least and c * len(baskets) >= lift * n[a] * n[b]), key=repr)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for u in range(60):
        rows += [(f"u{u}", f"i{min(int(rng.expovariate(0.06)), 90):02d}") for _ in range(rng.randint(1, 12))]
    for u in range(7):  # large baskets
        rows += [(f"big{u}", f"i{k:02d}") for k in rng.sample(range(100), 55)]
    rows += [(None, "i01"), ("u1", None), *rng.sample(rows, 40)]
    return rows


@pytest.mark.parametrize("heavy,large", [(1024, 400), (1024, 20), (20, 400), (20, 20), (1, 3), (5, 1)])
def test_any_split_of_the_work_gives_the_same(spark, heavy, large):
    rows = random_rows(heavy * 7 + large)
    assert tuples(item_pairs(table(spark, rows), "u", "i", 3, heavy=heavy, large_basket=large)) == brute(rows, 3)


def test_lift(spark):
    rows = random_rows(3)
    assert tuples(item_pairs(table(spark, rows), "u", "i", 3, 1.5, heavy=20, large_basket=20)) == brute(rows, 3, 1.5)


def test_pairs_in_large_baskets_alone(spark):
    rows = [(f"u{k}", f"x{j}") for k in range(5) for j in range(30)]
    assert tuples(item_pairs(table(spark, rows), "u", "i", 5, heavy=1, large_basket=10)) == brute(rows, 5)


def test_empty_and_single(spark):
    assert tuples(item_pairs(table(spark, []), "u", "i", 1)) == []
    assert tuples(item_pairs(table(spark, [("u", "a"), ("u", "a"), (None, "b")]), "u", "i", 1)) == []
    assert tuples(item_pairs(table(spark, [("u", "b"), ("u", "a")]), "u", "i", 1)) == [("a", "b", 1, 1, 1, 1)]

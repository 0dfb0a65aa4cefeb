import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.operators import frequency as fr
from marketloom.operators import skew
from tests.support import tuples

SCHEMA = "k string, v bigint, n string, key int, value int"


def table(spark, rows):
    return spark.createDataFrame([(k, v, "x", 1, 2) for k, v in rows], SCHEMA)


def test_nulls_repeats_ties_and_clashing_columns(spark):
    df = table(spark, [("a", 1), ("a", 1), ("a", 2), ("a", 2), ("a", None), ("b", None), (None, 3), (None, 3)])
    got = tuples(fr.key_totals(fr.compress(df, "k", "v")))
    assert got == sorted([("a", 5, 4, 2, 1), ("b", 1, 0, 0, None), (None, 2, 2, 1, 3)], key=repr)


def test_empty(spark):
    df = table(spark, [])
    assert tuples(fr.key_totals(fr.compress(df, "k", "v"))) == []
    assert tuples(fr.percentiles(fr.compress(df, "k", "v"), [0.5])) == []
    assert tuples(fr.heavy_keys(df, "k", "v", 0.1)) == []


def test_strings_as_values(spark):
    df = spark.createDataFrame([("a", "é" * 5000), ("a", ""), ("a", "")], "k string, v string")
    assert tuples(fr.key_totals(fr.compress(df, "k", "v"))) == [("a", 3, 3, 2, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_are_exact(spark, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.randint(-5, 10**6) if rng.random() < 0.9 else None) for _ in range(2000)] + [(f"k{rng.randint(0, 9)}", rng.choice([0, 1, 7, 7, -3])) for _ in range(300)]
    got = {r["key"]: (r["p10"], r["p50"], r["p99"], r["p100"]) for r in fr.percentiles(fr.compress(table(spark, rows), "k", "v"), [0.1, 0.5, 0.99, 1.0]).collect()}
    for key in {k for k, _ in rows}:
        v = sorted(x for k, x in rows if k == key and x is not None)
        want = tuple(v[max(0, -(-len(v) * p // 100) - 1)] for p in (10, 50, 99, 100))
        assert got[key] == want


def test_linear_bins(spark):
    rows = [("a", 1_700_000_000 + i) for i in range(1000)]
    got = fr.percentiles(fr.compress(table(spark, rows), "k", "v"), [0.5], bins=lambda v: F.floor(v / 16)).collect()
    assert got[0]["p50"] == 1_700_000_499


def test_heavy_keys_count_null_keys_and_repeats(spark):
    rows = [("a", 1)] * 3 + [("b", 1)] * 2 + [(None, 1)] * 95
    assert tuples(fr.heavy_keys(table(spark, rows), "k", "v", 0.03)) == [("a", 3)]
    assert tuples(fr.heavy_keys(table(spark, rows), "k", "v", 0.02)) == [("a", 3), ("b", 2)]


def test_salts_cover_each_other(spark):
    df = table(spark, [("a", i) for i in range(50)] + [("b", 1)])
    assert skew.hot_list(df, "k", "v", 0.5) == ["a"]
    left = df.select("k", "v", skew.salt_of(F.col("k"), ["a"], F.col("v"), 8).alias("s"))
    right = spark.createDataFrame([("a",), ("b",)], "k string").select("k", F.explode(skew.all_salts(F.col("k"), ["a"], 8)).alias("s"))
    joined = left.join(right, ["k", "s"])
    assert joined.count() == 51 and left.select("s").distinct().count() > 4
    assert Counter(r["k"] for r in right.collect()) == {"a": 8, "b": 1}

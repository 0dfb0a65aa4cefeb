import random

from marketloom.llm.topn import top_n
from tests.support import tuples

SCHEMA = "g string, h int, item string, score bigint, part int, bound int, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def brute(rows, n):
    out = []
    for key in {r[:2] for r in rows}:
        mine = sorted((r for r in rows if r[:2] == key), key=lambda r: (r[3] is None, -(r[3] or 0), r[2] is None, r[2] or ""))
        out += [(*r, i + 1) for i, r in enumerate(mine[:n])]
    return sorted(out, key=repr)


def test_same_as_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([1, None]), rng.choice([None, *[f"i{k}" for k in range(40)]]), rng.choice([None, 1, 1, 2, 3, -4])) for _ in range(600)]
    df = table(spark, rows).repartition(7)
    for n in (1, 5, 1000):
        assert tuples(top_n(df, ["g", "h"], "item", "score", n)) == brute(rows, n)


def test_repeats_few_rows_and_empty(spark):
    rows = [("a", 1, "x", 2), ("a", 1, "x", 2), ("a", 1, "y", None)]
    assert tuples(top_n(table(spark, rows), ["g", "h"], "item", "score", 2)) == [("a", 1, "x", 2, 1), ("a", 1, "x", 2, 2)]
    assert tuples(top_n(table(spark, rows), ["g"], "item", "score", 0)) == []
    assert tuples(top_n(table(spark, []), ["g", "h"], "item", "score", 3)) == []

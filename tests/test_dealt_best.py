"""Lists by matrix products against brute force, and what their plans and the driver hold."""

import numpy as np
import pytest

from marketloom.operators import cascade as cs
from marketloom.operators import learned
from tests.support import tuples


def frame(spark, name, m):
    return spark.createDataFrame([(f"{name}{i:03d}", x.tolist()) for i, x in enumerate(m)], f"{name}_id string, factors array<double>")


def explained(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bpr_keeps_item_factors_off_the_driver(spark, monkeypatch):
    """Two groups of users and items that never meet: a user's own group scores higher."""
    rows = [(f"u{g}{u}", f"i{g}{i:02d}", 1.0) for g in (0, 1) for u in range(10) for i in range(30) if (u + i) % 3]
    scores = spark.createDataFrame(rows, "user_id string, item_id string, score double")
    sizes, collect = [], type(scores).collect
    monkeypatch.setattr(type(scores), "collect", lambda df: sizes.append(len(out := collect(df))) or out)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("item factors pass the driver"))
    users, items = learned.fit_bpr(scores, epochs=20)
    assert max(sizes) < 20
    monkeypatch.undo()
    u, i = ({r[0]: np.array(r["factors"]) for r in df.collect()} for df in (users, items))
    assert len(u) == 20 and len(i) == 60
    mean = lambda g, h: np.mean([a @ b for x, a in u.items() if x[1] == g for y, b in i.items() if y[1] == h])
    assert mean("0", "0") > mean("0", "1") and mean("1", "1") > mean("1", "0")


@pytest.mark.parametrize("block_rows", [None, 40])
@pytest.mark.parametrize("cosine", [False, True])
def test_nearest_equals_brute_force(spark, monkeypatch, cosine, block_rows):
    for name, size in (("STRIP", 5), ("TILE", 8), ("MOST_TILE", 16)):
        monkeypatch.setattr(learned, name, size)
    rng = np.random.default_rng(3)
    left, right = rng.normal(size=(23, 4)), rng.normal(size=(90, 4)) * rng.pareto(1, (90, 1))
    right[30:60] = right[:30]  # ties
    left[0] = 0
    got = learned.nearest(frame(spark, "u", left), "u_id", frame(spark, "i", right), "i_id", 11, cosine=cosine, block_rows=block_rows)
    norm = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) if cosine else m
    s = np.einsum("ik,jk->ij", norm(left), norm(right)).round(12)
    want = [(f"u{a:03d}", n + 1, f"i{b:03d}") for a in range(23) for n, b in enumerate(np.lexsort((np.arange(90), -s[a]))[:11])]
    assert tuples(got.select("u_id", "rank", "i_id")) == sorted(want, key=repr)


def test_lists_are_final_while_one_block_holds_all_items(spark):
    m = np.eye(3)
    found = learned.nearest(frame(spark, "u", m), "u_id", frame(spark, "i", m), "i_id", 2)
    assert "Window" not in explained(found)


def test_als_lists_carry_what_is_asked_of_users_and_items(spark, monkeypatch):
    """Nothing is joined to the lists any more: the plan ends with the products and the valid filter."""
    u, i = frame(spark, "u", np.eye(3)).withColumnRenamed("u_id", "user_id"), frame(spark, "i", np.eye(3)).withColumnRenamed("i_id", "item_id")
    monkeypatch.setattr(learned, "fit_als", lambda *_: (u, i))
    valid = spark.createDataFrame([("i000",), ("i002",), ("i002",)], "item_id string")
    cities, homes = spark.createDataFrame([("i000", "a")], "item_id string, city_name string"), spark.createDataFrame([("u002", "b")], "user_id string, pref_city string")
    got = learned.als_top(None, u, 2, valid, about_users=homes, about_items=cities)
    plan = explained(got)
    assert "Join" not in plan[: plan.index("MapInArrow")]
    want = [("u000", "i000", 1, None, "a"), ("u001", "i000", 2, None, "a"), ("u002", "i000", 2, "b", "a"), ("u002", "i002", 1, "b", None)]
    assert tuples(got.select("user_id", "item_id", "rank", "pref_city", "city_name")) == want


def test_content_based_equals_brute_force_without_rows_of_pairs(spark, monkeypatch):
    for name, size in (("FULL_TERMS", 3), ("SPARSE_STRIP", 4), ("SPARSE_BLOCK", 8), ("SPARSE_ROWS", 50)):
        monkeypatch.setattr(learned, name, size)
    rng = np.random.default_rng(8)
    held = rng.random((90, 20)) < np.linspace(0.6, 0.02, 20)
    held[0, 1:] = True
    w = np.where(held, rng.random((90, 20)) + 0.1, 0)
    w[30:60] = w[:30]  # ties
    w = (w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)).round(6)
    weights = spark.createDataFrame([(f"i{i:03d}", f"t{t}", float(w[i, t])) for i, t in zip(*np.nonzero(w))], "item string, term string, w double")
    mine = {u: sorted(rng.choice(90, rng.integers(1, 6), replace=False).tolist()) for u in range(25)}
    history = spark.createDataFrame([(f"u{u:02d}", f"i{i:03d}") for u, xs in mine.items() for i in xs], "user_id string, item_id string")
    got = learned.content_based(weights, history, 7)
    assert "MapInArrow" in explained(got)
    want = []
    for u, xs in mine.items():
        v = w[xs].sum(axis=0)
        s = (w @ v / max(np.linalg.norm(v), 1e-12)).round(12)
        order = [i for i in np.lexsort((np.arange(90), -s)) if i not in xs and s[i] > 0][:7]
        want += [(f"u{u:02d}", n + 1, f"i{i:03d}", round(float(s[i]), 9)) for n, i in enumerate(order)]
    have = sorted((r["user_id"], r["rank"], r["item_id"], round(r["score"], 9)) for r in got.collect())
    assert have == sorted(want)


def test_offers_follow_what_sources_before_can_have_placed(spark):
    """Of 300 rows a source, a pool of 200 looks at 5, 6 + 5 and 7 + 11; everything after a source without a limit counts with 200."""
    rows = spark.range(300).selectExpr("'u' as user_id", "concat('i', id) as item_id", "cast(id + 1 as int) as rank")
    sources = [cs.Source("a", rows), cs.Source("b", rows, cs.INDEXED), cs.Source("c", rows, cs.PLACED_FIRST), cs.Source("d", rows, cs.WHOLE), cs.Source("e", rows, cs.INDEXED)]
    [r] = cs.offers(rows.select("user_id").distinct(), sources, {"a": 5, "b": 6, "c": 7, "d": 8, "e": 9}, 200, None, capped=False).collect()
    assert [len(r[f"s{i}"]) for i in range(5)] == [5, 11, 18, 300, 209]


@pytest.mark.parametrize("width", [1, 8, 13, 40])
def test_places_that_reach_a_bound(width):
    rng = np.random.default_rng(width)
    reach = learned.Reach(6, 40)
    for rows in (6, 3):
        left, right = rng.normal(size=(rows, 3)).astype(np.float32), rng.normal(size=(width, 3)).astype(np.float32)
        s = reach.products(left, right)
        least = np.quantile(s, 0.8, axis=1).astype(np.float32)
        assert [x.tolist() for x in reach.at_least(s, least)] == [x.tolist() for x in np.nonzero(s >= least[:, None])]

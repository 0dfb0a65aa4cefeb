import random

import pytest

from marketloom.operators import entity_features as ef

EVENTS = "id int, u string, kind string, at bigint, amount bigint, n int, total int, last int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], EVENTS)


def brute(rows):
    out = {}
    for _, u, k, at, amount in rows:
        if u is None:
            continue
        n, total, last = out.get((u, k), (0, 0, None))
        out[u, k] = (n + 1, total + (amount or 0), max((x for x in (last, at) if x is not None), default=None))
    return out


def state_of(df):
    return {(r["entity"], r["kind"]): (r["n"], r["total"], r["last"]) for r in df.collect()}


def signed(spark, rows, sign=1):
    return ef.signed(table(spark, rows), "u", "kind", "at", "amount", sign)


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_a_fresh_build(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "c", None]), rng.choice(["v", "w", "rare", None]), rng.choice([None, *range(20)]), rng.choice([None, 0, 5])) for i in range(200)]
    first, new = rows[:140], rows[140:]
    gone = rng.sample(first, 60) + new[:5]
    left = [r for r in rows if r not in gone]
    state = ef.build(signed(spark, first))
    assert state_of(state) == brute(first)
    deltas = signed(spark, new).unionByName(signed(spark, gone, -1))
    assert state_of(ef.apply_deltas(state, deltas, signed(spark, left))) == brute(left)


def test_everything_retracted_and_empty(spark):
    rows = [(1, "a", "v", 3, 1), (2, "a", "v", 5, 1)]
    state = ef.build(signed(spark, rows))
    assert state_of(ef.apply_deltas(state, signed(spark, rows, -1), signed(spark, []))) == {}
    assert state_of(ef.apply_deltas(state, signed(spark, []), signed(spark, rows))) == brute(rows)
    assert state_of(ef.build(signed(spark, []))) == {}


def test_latest_is_only_computed_again_where_it_went(spark):
    rows = [(1, "a", "v", 3, 1), (2, "a", "v", 5, 1), (3, "b", "v", 5, 1), (4, "b", "v", 9, 1)]
    state = ef.build(signed(spark, rows))
    # remaining holds nothing of b: its latest event stays, so it must not be asked
    got = state_of(ef.apply_deltas(state, signed(spark, [rows[1], rows[2]], -1), signed(spark, [rows[0]])))
    assert got == {("a", "v"): (1, 1, 3), ("b", "v"): (1, 1, 9)}


def test_one_row_an_entity(spark):
    rows = [(1, "a", "v", 3, 1), (2, "a", "w", 5, None), (3, None, "w", 5, 1), (4, "b", "v", None, 2)]
    state = ef.build(signed(spark, rows))
    got = {r["entity"]: r for r in ef.by_entity(state).collect()}
    assert got.keys() == {"a", "b"} and [f["kind"] for f in got["a"]["features"]] == ["v", "w"] and got["a"]["n"] == 2 and got["b"]["last"] is None
    wide = {r["entity"]: r for r in ef.wide(state, ["v", "none"]).collect()}
    assert (wide["a"]["n_v"], wide["a"]["total_v"], wide["a"]["last_v"], wide["a"]["n_none"], wide["a"]["last_none"]) == (1, 1, 3, 0, None)


def test_deliveries_without_a_date_count_as_loaded(spark):
    from types import SimpleNamespace

    from marketloom.plans import dealt

    rows = [("e1", "u", "lead", 1, None), ("e2", "u", "lead", 1, "2026-03-01"), ("e3", "u", "lead", 1, "2026-04-01")]
    events = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, dwell_time_sec int, date string").selectExpr("* except (date)", "cast(date as date) as date", "timestamp_ntz'2026-03-01 00:00:00' as event_ts")
    loaded, late = dealt.loaded_and_late(SimpleNamespace(events=events))
    assert {r["event_id"] for r in loaded.collect()} == {"e1", "e2"}
    assert {r["event_id"] for r in late.collect()} == {"e3"}


def test_several_batches_in_turn_from_a_stored_state(spark, tmp_path):
    from marketloom.sources import formats

    rng = random.Random(7)
    live, number, state = {}, 0, None
    for turn in range(5):
        new = [(number + i, rng.choice(["a", "b", None]), rng.choice(["v", "w", None]), rng.choice([None, *range(9)]), rng.choice([None, 4])) for i in range(60)]
        number += 60
        gone = rng.sample(sorted(live.values(), key=repr), min(len(live), 25))
        live = {r[0]: r for r in [*live.values(), *new] if r not in gone}
        asked = []

        def left(keys, rows=list(live.values()), asked=asked):
            asked.append(keys.count())
            return signed(spark, rows)

        state = ef.build(signed(spark, new)) if state is None else ef.apply_deltas(state, signed(spark, new).unionByName(signed(spark, gone, -1)), left)
        state = spark.read.parquet(formats.write_version(state, str(tmp_path / "features")))
        assert state_of(state) == brute(list(live.values())), turn
        assert sum(asked) <= 6  # doubtful keys alone
    assert len(list((tmp_path / "features").iterdir())) == 5


def test_hundreds_of_kinds_side_by_side(spark):
    rows = [(i, f"u{i % 5}", f"k{i % 300:03d}", i, 1) for i in range(1500)]
    wide = ef.wide(ef.build(signed(spark, rows)), [f"k{i:03d}" for i in range(300)])
    got = {r["entity"]: r for r in wide.collect()}
    assert len(wide.columns) == 901 and got["u0"]["n_k000"] == 5 and got["u0"]["last_k005"] == 1205 and got["u1"]["n_k000"] == 0 and got["u1"]["last_k000"] is None

from datetime import datetime, timedelta

import pytest

from marketloom.operators import relational as rel
from marketloom.sources import formats
from marketloom.streaming import events as stream
from tests.support import tuples


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", 1, "y"), (1, "a", 1, "x")], "ID bigint, user_id string, rank int, item_id string")
    formats.write_table(df, f"{tmp_path}/t", partition_by=["rank"])
    assert tuples(formats.read_parquet(spark, f"{tmp_path}/t").select(*df.columns)) == tuples(df)
    one, two = formats.write_version(df, f"{tmp_path}/v"), formats.write_version(df, f"{tmp_path}/v")
    assert one != two and formats.read_parquet(spark, f"{tmp_path}/v", recursive=True).count() == 4
    formats.write_submission(df, f"{tmp_path}/s")
    back = formats.read_csv(spark, f"{tmp_path}/s", "ID bigint, user_id string, rank int, item_id string")
    assert [r["ID"] for r in back.collect()] == [1, 2]
    assert formats.table_info(formats.read_parquet(spark, f"{tmp_path}/t")).first()["n_rows"] == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id")
    formats.write_bucketed(df, "bucketed_left", ["k"], 4)
    formats.write_bucketed(df, "bucketed_right", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = spark.table("bucketed_left").join(spark.table("bucketed_right").withColumnRenamed("id", "other"), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan


def test_json_distribution():
    good = '{"agent_ratio": 0.5, "category_dist": {"1010": 1}}'
    assert formats.read_json_distribution(good, {})["category_dist"] == {1010: 1.0}
    for bad in (None, "", "[1]", '{"category_dist": {"x": 1}}', "{}"):
        assert formats.read_json_distribution(bad, {"a": 1}) == {"a": 1}


def test_relational_rules(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", 2.0), (3, None, 3.0)], "k int, s string, x double")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    assert tuples(rel.semi(df, keys, ["k"]).select("k")) == [(1,)] and tuples(rel.anti(df, keys, ["k"]).select("k")) == [(3,)]
    assert tuples(rel.where_equal(df, {"s": ["a", "b"], "k": 1}).select("k")) == [(1,)]
    assert rel.fill_numeric(df).filter("x = 0").count() == 1
    with pytest.raises(ValueError):
        rel.require(df, ["k", "none"])
    assert [r["row_index"] for r in rel.row_index(df, ["k"]).orderBy("row_index").collect()] == [0, 1, 2]
    assert rel.union_relaxed(df.select("k"), df.select("s")).count() == 6


BASE = datetime(2026, 1, 1, 10)


def events(spark, path, rows):
    full = [("login", u, "s", e, i, "c", 1, k, None, t, "search", 1, "iOS", 5, 0, (t or BASE).date()) for e, u, i, k, t in rows]
    from marketloom.sources.tables import SCHEMAS

    spark.createDataFrame(full, SCHEMAS["fact_user_events"]).coalesce(1).write.mode("append").parquet(path)


def test_streams(spark, tmp_path):
    path, m = f"{tmp_path}/e", lambda n: BASE + timedelta(minutes=n)
    events(spark, path, [("1", "u", "i", "pageview", m(0)), ("1", "u", "i", "pageview", m(0)), ("2", "u", "i", "view_phone", m(20)), ("3", "u", "j", "pageview", m(90)), ("4", None, "j", "pageview", m(95)), ("5", "u", "j", "pageview", None)])
    read = lambda: stream.once(stream.read_events(spark, path))
    daily = stream.run_once(stream.daily_counts(read()), "daily", "complete")
    assert {(r["event_type"], r["n"]) for r in daily.collect()} == {("pageview", 3), ("view_phone", 1)}
    week = stream.run_once(stream.trailing_counts(read(), 2), "week", "complete")
    assert {(r["last_day"].day, r["item_id"], r["n"]) for r in week.collect()} == {(d, i, 2) for d in (1, 2) for i in "ij"}
    events(spark, path, [("9", "z", "i", "pageview", m(60 * 24 * 9))])  # moves the watermark on
    closed = stream.run_once(stream.sessions(read()), "closed", "append")
    assert sorted((r["user_id"], r["n_events"]) for r in closed.filter("user_id = 'u'").collect()) == [("u", 1), ("u", 2)]


def test_decayed_stream(spark, tmp_path):
    path = f"{tmp_path}/d"
    events(spark, path, [("1", "u", "i", "pageview", BASE), ("2", "u", "i", "view_phone", BASE + timedelta(days=7))])
    got = stream.run_once(stream.decayed_totals(stream.once(stream.read_events(spark, path))), "decayed", "update").collect()
    assert [round(r["score"], 6) for r in got] == [5.5]


def test_problems_of_a_submission_file(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u", 1, "i")], "ID bigint, user_id string, rank int, item_id string")
    path = str(tmp_path / "good")
    formats.write_submission(rows, path)
    columns = ["ID", "user_id", "rank", "item_id"]
    assert tuple(formats.submission_problems(spark, path, columns, 1000).first()) == (False, False, False)
    assert tuple(formats.submission_problems(spark, path, columns[:3], 10).first()) == (False, True, True)
    (tmp_path / "marked").mkdir()
    (tmp_path / "marked" / "a.csv").write_text("ID,user_id,rank,item_id\n1,u,1,i\n", encoding="utf-8-sig")
    assert tuple(formats.submission_problems(spark, str(tmp_path / "marked"), columns, 1000).first()) == (True, False, False)

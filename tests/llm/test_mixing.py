import os
import random

import pytest
from pyspark.sql import functions as F

from marketloom.llm import mixing, tokens

TARGETS = "source string, target_share double, max_repeats bigint"
RECORDS = "id bigint, source string, size bigint, position int, bucket int"


def tables(spark, seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["big"] * 8 + ["mid", "mid", "small", None, "unlisted"]), rng.choice([None, 0, *range(20, 60)]), 1, 2) for k in range(4000)]
    return rows, spark.createDataFrame(rows, RECORDS), spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 3), ("absent", 0.0, 1), (None, 0.1, 1)], TARGETS)


def test_shares_repeats_and_order(spark):
    rows, records, targets = tables(spark)
    schedule = {"small": (0.2, 1.0, 1.8)}
    mix = mixing.mix(records, "id", "source", "size", targets, schedule).cache()
    got = mix.collect()
    assert [r["position"] for r in got] == sorted(r["position"] for r in got) and 0 <= got[0]["position"] and got[-1]["position"] <= 1
    assert len({(r["id"], r["repeat"]) for r in got}) == len(got)
    supply = {s: sum(r[2] or 0 for r in rows if r[1] == s) for s in ("big", "mid", "small")}
    total = min(supply["big"] / 0.5, supply["mid"] * 2 / 0.3, supply["small"] * 3 / 0.2)
    report = {r["source"]: r for r in mixing.shares(mix, "source", "size", targets).collect()}
    for s, share, most in (("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 3)):
        assert abs(report[s]["size"] - share * total) <= 61 and abs(report[s]["share"] - share) < 0.01 and report[s]["most_repeats"] <= most
    assert report["absent"]["size"] == 0
    # the curriculum: small comes late, and its integral is kept
    early = sum(r["size"] for r in got if r["source"] == "small" and r["position"] < 0.5) / report["small"]["size"]
    assert abs(early - 0.3) < 0.03
    mix.unpersist()


def test_position_inverts_the_integral(spark):
    knots, m = (0.0, 0.3, 1.0), (0.5, 2.0, 0.0)
    segments = mixing.integrated({"s": m}, "s", knots)
    done = spark.range(101).select((F.col("id") / 100).alias("u"))
    got = [r[0] for r in done.select(mixing.position_of(F.lit("s"), F.col("u"), {"s": m}, knots)).collect()]
    for u, t in zip(range(101), got):
        area = sum(w * min(max(t - x, 0), e - x) + k / 2 * min(max(t - x, 0), e - x) ** 2 for (x, w, k, *_), e in zip(segments, knots[1:]))
        assert abs(area - u / 100) < 1e-9
    with pytest.raises(ValueError):
        mixing.integrated({"s": (1.0, -1.0)}, "s", (0.0, 1.0))
    with pytest.raises(ValueError):
        mixing.integrated({"s": (0.0, 0.0)}, "s", (0.0, 1.0))


def test_larger_total_is_capped_and_reported(spark):
    _, records, targets = tables(spark, 2)
    mix = mixing.mix(records, "id", "source", "size", targets, total=10**9)
    report = {r["source"]: r for r in mixing.shares(mix, "source", "size", targets).collect()}
    assert report["big"]["most_repeats"] == 1 and report["small"]["most_repeats"] == 3


def test_sources_that_run_out_leave_their_part_to_the_others(spark):
    rows, records, targets = tables(spark, 4)
    supply = {s: sum(r[2] or 0 for r in rows if r[1] == s) for s in ("big", "mid", "small")}
    targets = spark.createDataFrame([("big", 0.2, 3), ("mid", 0.4, 2), ("small", 0.4, 3), ("absent", 0.0, 1), (None, 0.1, 1)], TARGETS)
    total = supply["big"] * 2 + supply["mid"] * 2 + supply["small"] * 3  # only the big source has something left
    mix = mixing.mix(records, "id", "source", "size", targets, total=total, fill=True)
    report = {r["source"]: r for r in mixing.report(mix, records, "source", "size", targets, total, fill=True).collect()}
    assert abs(sum(r["size"] for r in report.values()) - total) < 200
    assert report["small"]["size"] == supply["small"] * 3 and report["mid"]["size"] == supply["mid"] * 2
    assert abs(report["small"]["missing"] - (0.4 * total - supply["small"] * 3)) <= 1 and abs(report["mid"]["missing"] - (0.4 * total - supply["mid"] * 2)) <= 1
    assert report["big"]["missing"] == 0 and report["absent"]["supply"] == report["absent"]["wanted"] == 0
    everything = mixing.mix(records, "id", "source", "size", targets, total=10**9, fill=True)
    got = {r["source"]: r["size"] for r in mixing.shares(everything, "source", "size", targets).collect()}
    assert (got["big"], got["mid"], got["small"]) == (supply["big"] * 3, supply["mid"] * 2, supply["small"] * 3)


def test_buckets_do_not_matter_to_what_is_chosen(spark):
    _, records, targets = tables(spark, 3)
    a, b = (mixing.mix(records, "id", "source", "size", targets, bucket_records=n).select("position", "id", "repeat").collect() for n in (1_000_000, 7))
    assert a == b


def test_empty_and_records_in_order(spark):
    _, records, targets = tables(spark)
    assert mixing.mix(records.limit(0), "id", "source", "size", targets).collect() == []
    assert mixing.mix(records, "id", "source", "size", targets.limit(0)).collect() == []
    mix = mixing.mix(records, "id", "source", "size", targets)
    full = mixing.records_in_order(mix, records.withColumn("text", F.lit("t")), "id")
    assert full.count() == mix.count() and "text" in full.columns


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "nhà đất"), (2, ""), (3, None), (4, "a" * 50_000), (5, "<|endoftext|>")], "id int, text string")
    got = {r["id"]: r["n_tokens"] for r in tokens.count_tokens(df, "text", ["id"]).collect()}
    assert got[2] == got[3] == 0 and got[1] > 0 and got[4] > 100 and got[5] > 1

"""Event streams: cleaning, daily counts, sessions and decayed scores as they arrive.

Timestamps without zone are read as UTC, because watermarks need a zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketloom.constants import EVENT_WEIGHTS, HALF_LIFE_DAYS
from marketloom.sources.tables import SCHEMAS


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Event files in the order they arrive; path is a folder or a pattern of files or folders."""
    return spark.readStream.schema(SCHEMAS["fact_user_events"]).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def once(events: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Each event id once; copies later than the lateness pass again, events without a time drop out."""
    timed = events.filter("event_ts is not null").withColumn("ts", F.col("event_ts").cast("timestamp"))
    return timed.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def daily_counts(events: DataFrame) -> DataFrame:
    """(day, event_type, n) of a deduplicated stream."""
    return events.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), "event_type", "n")


def trailing_counts(events: DataFrame, days: int = 7) -> DataFrame:
    """(last_day, item_id, n): events of an item over days that end with last_day, a row a day."""
    w = F.window("ts", f"{days} days", "1 day")
    return events.groupBy(w, "item_id").agg(F.count(F.lit(1)).alias("n")).select(F.date_sub(F.to_date("window.end"), 1).alias("last_day"), "item_id", "n")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """(user_id, start, end, n_events) of closed sessions; end is the last event plus the gap."""
    known = events.filter("user_id is not null")
    return known.groupBy("user_id", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n_events")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n_events")


def decayed_totals(events: DataFrame, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """(user_id, item_id, score, as_of_us): the pair's weight decayed to its latest event, updated with every batch.

    The state is one number and one time a pair; an event older than the state
    is decayed to the state's time.
    """
    micros_per_day = 86_400_000_000.0

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        score, at = state.get if state.exists else (0.0, None)
        for rows in batches:
            for us, weight in zip(rows["us"], rows["weight"]):
                if at is None or us > at:
                    score = (score * 0.5 ** ((us - at) / micros_per_day / half_life_days) if at is not None else 0.0) + weight
                    at = us
                else:
                    score += weight * 0.5 ** ((at - us) / micros_per_day / half_life_days)
        state.update((float(score), int(at)))
        yield pd.DataFrame({"user_id": [key[0]], "item_id": [key[1]], "score": [score], "as_of_us": [at]})

    weights = F.create_map(*[F.lit(x) for kv in EVENT_WEIGHTS.items() for x in kv])
    rows = events.filter("user_id is not null and item_id is not null").select("user_id", "item_id", F.unix_micros("ts").alias("us"), F.coalesce(weights[F.col("event_type")], F.lit(1.0)).alias("weight"))
    return rows.groupBy("user_id", "item_id").applyInPandasWithState(update, "user_id string, item_id string, score double, as_of_us bigint", "score double, at bigint", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, mode: str) -> DataFrame:
    """Process all that is there and return the rows as a table in memory, for checks and small outputs."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return stream.sparkSession.table(name)

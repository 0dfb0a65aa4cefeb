"""Readers and writers of files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str, recursive: bool = False, schema: str | None = None) -> DataFrame:
    """A Parquet folder; recursive also takes files in folders below."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header; a byte order mark is no part of the first name."""
    return spark.read.option("header", "true").option("encoding", "UTF-8").schema(schema).csv(path)


def read_json_distribution(text: str | None, fallback: Mapping[str, object]) -> dict:
    """A small JSON object with whole-number keys of category_dist; the fallback for anything that is none."""
    try:
        got = json.loads(text or "")
        return {**got, "category_dist": {int(k): float(v) for k, v in got["category_dist"].items()}}
    except (ValueError, KeyError, TypeError, AttributeError):
        return dict(fallback)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of literal rows, also of none."""
    return spark.createDataFrame(list(rows), schema)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table."""
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_version(df: DataFrame, root: str) -> str:
    """Write a new version below root and return its path; earlier versions stay for readers that use them."""
    path = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_submission(df: DataFrame, path: str) -> None:
    """One CSV with a header in order of ID."""
    df.orderBy("ID").coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A table whose later joins on keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def table_info(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns, n_files)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(len(df.inputFiles())).alias("n_files"))


def submission_problems(spark: SparkSession, path: str, columns: Sequence[str], most_bytes: int) -> DataFrame:
    """(has_mark, bad_header, too_large) of a CSV written as one file: a byte order mark, other columns than asked for, more bytes than allowed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    marked = F.hex(F.substring("content", 1, 3)) == "EFBBBF"
    bytes_of = files.agg(F.coalesce(F.bool_or(marked), F.lit(False)).alias("has_mark"), (F.coalesce(F.sum("length"), F.lit(0)) > most_bytes).alias("too_large"))
    head = spark.read.option("pathGlobFilter", "*.csv").text(path).limit(1).agg((F.coalesce(F.max("value"), F.lit("")) != ",".join(columns)).alias("bad_header"))
    # one row stands on each side
    return bytes_of.join(F.broadcast(head), F.lit(True)).select("has_mark", "bad_header", "too_large")

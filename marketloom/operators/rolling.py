"""Totals over trailing days for every entity and day, days without rows included.

Daily sums are packed into dense blocks of entities by days and multiplied by a
banded 0/1 operator, one band per window. The calendar is cut into tiles; a
tile also gets the days before it that its longest window reaches (its halo),
so tiles are independent rows. An entity's daily sums meet in one row, no longer
than the calendar, and a task holds a batch of rows and a block of entities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 2048


def band(window: int, halo: int, days: int) -> np.ndarray:
    """(halo + days) x days: column j sums the window days that end at day j of the tile."""
    row = np.arange(halo + days)[:, None] - halo
    col = np.arange(days)[None, :]
    return ((row <= col) & (row > col - window)).astype(np.float64)


def rolling_totals(
    rows: DataFrame,
    entity: str,
    day: str,
    measures: Sequence[str],
    windows: Sequence[int],
    first: date,
    last: date,
    tile_days: int = 32,
    keep: Callable[[dict[str, np.ndarray]], np.ndarray] | None = None,
) -> DataFrame:
    """(entity, day, <measure>_<window>d ... bigint) for every entity and day first..last.

    Each measure is a whole number; nulls add 0. Rows with a null day or a day
    outside the calendar add nothing, but their entity still gets its rows. Rows
    with a null entity are left out. Several rows for an entity and day add up.
    An empty table gives no rows. Sums beyond 2**53 are not exact. keep gets
    {output column: entities x days} of a block and returns a mask of the same
    shape, so that a sparse selection need not be written out in full first.
    """
    n_days = (last - first).days + 1
    halo = max(windows) - 1
    n_tiles = -(-n_days // tile_days)
    reach = -(-halo // tile_days)  # tiles after its own that a day is in the halo of
    at = F.datediff(F.col(day), F.lit(first))
    inside = F.col(day).isNotNull() & at.between(0, n_days - 1)
    sums = [F.sum(F.when(inside, F.col(m)).otherwise(0)).alias(f"m{i}") for i, m in enumerate(measures)]
    # days outside the calendar fold into one marker row, -1, which keeps the entity
    daily = (
        rows.filter(F.col(entity).isNotNull())
        .groupBy(F.col(entity).alias("entity"), F.when(inside, at).otherwise(F.lit(-1)).alias("at"))
        .agg(*[F.coalesce(s, F.lit(0)).cast("bigint").alias(f"m{i}") for i, s in enumerate(sums)])
    )
    # an entity has a row of all its days, no longer than the calendar, and gives one row a tile with the days that the tile can see
    lines = daily.groupBy("entity").agg(F.collect_list(F.struct("at", *[f"m{i}" for i in range(len(measures))])).alias("days"))
    tiles = lines.select("entity", "days", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))).alias("tile"))
    begin = F.col("tile") * tile_days
    seen = F.filter("days", lambda d: (d["at"] >= 0) & (d["at"] >= begin - halo) & (d["at"] < begin + tile_days))
    tiled = tiles.select("entity", "tile", seen.alias("days"))

    names = [f"{m}_{w}d" for m in measures for w in windows]
    k = len(measures)
    epoch = (first - date(1970, 1, 1)).days
    out = pa.schema([("entity", pa.string()), ("day", pa.date32()), *[(n, pa.int64()) for n in names]])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = [band(w, halo, tile_days) for w in windows]

        for batch in batches:
            tile, sizes = batch["tile"].to_numpy(), np.diff(batch["days"].offsets.to_numpy())
            flat = batch["days"].flatten()
            row, at = np.repeat(np.arange(len(tile)), sizes), flat.field("at").to_numpy()
            values = [flat.field(f"m{i}").to_numpy() for i in range(k)]
            for here in np.unique(tile):
                mine = np.flatnonzero(tile == here)
                begin = int(here) * tile_days
                days = min(tile_days, n_days - begin)
                for lo in range(0, len(mine), BLOCK):
                    block = mine[lo : lo + BLOCK]
                    place = np.full(len(tile), -1)
                    place[block] = np.arange(len(block))
                    inside = place[row] >= 0
                    r, c = place[row][inside], at[inside] - begin + halo
                    columns = {}
                    for i in range(k):
                        dense = np.zeros((len(block), halo + tile_days))
                        dense[r, c] = values[i][inside]
                        for w, op in zip(windows, bands):
                            columns[f"{measures[i]}_{w}d"] = np.rint(dense @ op).astype(np.int64)[:, :days]
                    mask = np.ones((len(block), days), bool) if keep is None else keep(columns)
                    who, when = np.nonzero(mask)
                    if len(who):
                        yield pa.RecordBatch.from_arrays([batch["entity"].take(pa.array(block[who])), pa.array((when + begin + epoch).astype(np.int32)).cast(pa.date32()), *[pa.array(columns[n][who, when]) for n in names]], schema=out)

    schema = T.StructType([T.StructField("entity", T.StringType()), T.StructField("day", T.DateType()), *[T.StructField(n, T.LongType()) for n in names]])
    return tiled.mapInArrow(blocks, schema).withColumnsRenamed({"entity": entity, "day": day})

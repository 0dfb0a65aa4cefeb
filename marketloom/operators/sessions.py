"""Sessions at inactivity gaps, from a Cartesian tree over each user's gaps.

The gaps between a user's consecutive events form a tree with the longest gap
at the root. A node stands for the stretch of events joined by gaps no longer
than its own, and keeps that stretch's first and last event and its parent's
gap. The sessions for a threshold are the nodes with gap <= threshold < gap of
the parent: one filter over the stored tree, whatever the threshold.

Events closer than the floor of the tree are joined by partial aggregation
before anything meets by user: what leaves it is at most one row a user and
floor interval, 1,440 a day for a floor of a minute, however many events a user
has. A user's timeline is cut into chunks of time, so that a hot user is spread
over many tasks. Inside a chunk every node with a longer gap on both sides is
final. What remains open, the two spines of the chunk's tree, goes on to a merge
by user, which sees a few rows a chunk instead of all events.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.scalar import micros

#: Gap of the parent of a root.
NO_PARENT = np.iinfo(np.int64).max
DAY = 86_400_000_000
TREE_COLUMNS = "user_id string, first_event_id string, last_event_id string, start_us bigint, end_us bigint, n_events bigint, gap_us bigint, parent_gap_us bigint"


def cartesian_nodes(gaps: list[int]) -> tuple[list[int], list[int]]:
    """For each gap the index of the nearest longer gap before it and after it.

    Of equal gaps the earlier one is the parent. -1 and len(gaps) where there is none.
    """
    n = len(gaps)
    left, right, stack = [-1] * n, [n] * n, []
    for i, g in enumerate(gaps):
        while stack and gaps[stack[-1]] < g:
            right[stack.pop()] = i
        left[i] = stack[-1] if stack else -1
        stack.append(i)
    return left, right


def gap_tree(events: DataFrame, user: str, event: str, ts: str, floor_us: int, chunk_us: int = DAY) -> DataFrame:
    """The merged tree: (user_id, first_event_id, last_event_id, start_us, end_us, n_events, gap_us, parent_gap_us).

    Each event id counts once (deliveries of one id must agree in user and
    time); events with a null user, id or time are left out; an empty table
    gives no rows. Events are ordered by time, then id. Gaps up to floor_us are
    joined at once, with leaves of gap -1, so thresholds from floor_us on can
    be cut. Columns besides the three named are never read.
    """
    clean = events.select(F.col(user).alias("user_id"), F.col(event).alias("event_id"), micros(F.col(ts)).alias("us")).filter("user_id is not null and event_id is not null and us is not null")
    cells = clean.distinct().groupBy("user_id", F.floor(F.col("us") / chunk_us).alias("chunk"), F.floor(F.col("us") / floor_us).alias("cell"))
    at = F.struct("us", "event_id")
    joined = cells.agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")).select("user_id", "chunk", F.col("first.event_id").alias("first_id"), F.col("last.event_id").alias("last_id"), F.col("first.us").alias("us"), F.col("last.us").alias("end"), "n")
    chunked = joined.repartition("user_id", "chunk").sortWithinPartitions("user_id", "chunk", "us").drop("chunk")
    schema = pa.schema([("user_id", pa.string()), ("first_event_id", pa.string()), ("last_event_id", pa.string()), ("start_us", pa.int64()), ("end_us", pa.int64()), ("n_events", pa.int64()), ("gap_us", pa.int64()), ("parent_gap_us", pa.int64())])

    def trees(pieces: Iterator[tuple], chunked: bool) -> Iterator[pa.RecordBatch]:
        """pieces: arrays (user ids, group number, first ids, last ids, start, end, n, leaf) of whole groups in order.

        Parent gap -1 marks a stretch at an edge of its chunk, which the merge must
        place; -2 one between two spine gaps, which the merge only needs as a weight.
        """
        for users, group, first, last, start, end, n, leaf in pieces:
            m = len(start)
            if not m:
                continue
            edge = np.ones(m, bool)
            edge[1:] = group[1:] != group[:-1]
            before = np.empty(m, np.int64)
            before[0] = 0
            before[1:] = start[1:] - end[:-1]
            opens = np.flatnonzero(edge)
            closes = np.append(opens[1:], m)
            # a single open stretch needs no tree
            single = closes - opens == 1
            f, l, g, pg = [opens[single]], [opens[single]], [np.full(single.sum(), -1)], [np.full(single.sum(), -1 if chunked else NO_PARENT)]
            of, ol, og, op = [], [], [], []
            cum = np.concatenate(([0], np.cumsum(n)))
            for a, b in zip(opens[~single].tolist(), closes[~single].tolist()):
                gaps = before[a + 1 : b].tolist()
                k = len(gaps)
                lo, hi = cartesian_nodes(gaps)
                spine = []
                for i in range(k):  # the node of gap i covers stretches a + lo + 1 .. a + hi
                    x, y = lo[i], hi[i]
                    if chunked and (x < 0 or y >= k):
                        spine.append(i)
                        continue
                    parent = NO_PARENT if x < 0 and y >= k else min(gaps[x] if x >= 0 else NO_PARENT, gaps[y] if y < k else NO_PARENT)
                    of.append(a + x + 1), ol.append(a + y), og.append(gaps[i]), op.append(parent)
                if not chunked:
                    for i in range(k + 1):
                        if not leaf[a + i]:
                            continue
                        of.append(a + i), ol.append(a + i), og.append(-1)
                        op.append(min(gaps[i - 1] if i else NO_PARENT, gaps[i] if i < k else NO_PARENT))
                    continue
                for i in range(1, k):  # inner stretches lie between two known gaps
                    of.append(a + i), ol.append(a + i), og.append(-1), op.append(min(gaps[i - 1], gaps[i]))
                bounds = [-1, *spine, k]
                for x, y in zip(bounds, bounds[1:]):  # the stretches between spine gaps, whole, for the merge
                    of.append(a + x + 1), ol.append(a + y), og.append(-1), op.append(-1 if x < 0 or y >= k else -2)
            f, l = np.concatenate([*f, np.array(of, np.int64)]), np.concatenate([*l, np.array(ol, np.int64)])
            g, pg = np.concatenate([*g, np.array(og, np.int64)]), np.concatenate([*pg, np.array(op, np.int64)])
            at = pa.array(f)
            yield pa.RecordBatch.from_arrays([users.take(at), first.take(at), last.take(pa.array(l)), pa.array(start[f]), pa.array(end[l]), pa.array(cum[l + 1] - cum[f]), pa.array(g), pa.array(pg)], schema=schema)

    def whole_groups(batches: Iterator[pa.RecordBatch], key) -> Iterator[pa.Table]:
        """Tables that never split a group; key gives the group number of each row."""
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < 50_000:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            number = key(t)
            cut = int(np.searchsorted(number, number[-1]))
            if cut:
                yield t.slice(0, cut)
            held = t.slice(cut).to_batches()
            size = t.num_rows - cut
        if size:
            yield pa.Table.from_batches(held).combine_chunks()

    def number_of(t: pa.Table, us: str, by_chunk: bool) -> np.ndarray:
        code = t["user_id"].combine_chunks().dictionary_encode().indices.to_numpy()
        new = np.zeros(t.num_rows, bool)
        new[1:] = code[1:] != code[:-1]
        if by_chunk:
            chunk = t[us].to_numpy() // chunk_us
            new[1:] |= chunk[1:] != chunk[:-1]
        return np.cumsum(new)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for t in whole_groups(batches, lambda t: number_of(t, "us", True)):
                start, end, n, number = t["us"].to_numpy(), t["end"].to_numpy(), t["n"].to_numpy(), number_of(t, "us", True)
                first, last = t["first_id"].combine_chunks(), t["last_id"].combine_chunks()
                cut = np.ones(len(start), bool)
                cut[1:] = (number[1:] != number[:-1]) | (start[1:] - end[:-1] > floor_us)
                a = np.flatnonzero(cut)
                b = np.append(a[1:], len(start)) - 1
                yield t["user_id"].combine_chunks().take(pa.array(a)), number[a], first.take(pa.array(a)), last.take(pa.array(b)), start[a], end[b], np.add.reduceat(n, a), None

        return trees(pieces(), True)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []

        def still_open() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                final = pc.greater_equal(batch["parent_gap_us"], 0)
                ready.append(batch.filter(final).select(schema.names))
                yield batch.filter(pc.invert(final))

        def pieces() -> Iterator[tuple]:
            for t in whole_groups(still_open(), lambda t: number_of(t, "start_us", False)):
                number = number_of(t, "start_us", False)
                start, end, n, leaf = t["start_us"].to_numpy(), t["end_us"].to_numpy(), t["n_events"].to_numpy(), t["parent_gap_us"].to_numpy() == -1
                first, last = t["first_event_id"].combine_chunks(), t["last_event_id"].combine_chunks()
                # stretches that the floor joins across a chunk's border become one
                cut = np.ones(len(start), bool)
                cut[1:] = (number[1:] != number[:-1]) | (start[1:] - end[:-1] > floor_us)
                a = np.flatnonzero(cut)
                b = np.append(a[1:], len(start)) - 1
                yield t["user_id"].combine_chunks().take(pa.array(a)), number[a], first.take(pa.array(a)), last.take(pa.array(b)), start[a], end[b], np.add.reduceat(n, a), leaf[a]

        for made in trees(pieces(), False):
            while ready:
                yield ready.pop()
            yield made
        yield from ready

    # Final rows only pass through, spread by hash so that they follow no hot user.
    spread = F.when(F.col("parent_gap_us") >= 0, F.pmod(F.xxhash64("first_event_id", "gap_us"), F.lit(1024))).otherwise(F.lit(-1))
    nodes = chunked.mapInArrow(local, TREE_COLUMNS).withColumn("spread", spread)
    return nodes.repartition("user_id", "spread").sortWithinPartitions("user_id", "start_us", "end_us").drop("spread").mapInArrow(merged, TREE_COLUMNS)


def cut(tree: DataFrame, gap_us: int) -> DataFrame:
    """(user_id, first_event_id, last_event_id, start_us, end_us, n_events): sessions that end where the next event is more than gap_us later.

    gap_us may be any number from the floor of the tree on.
    """
    return tree.filter((F.col("gap_us") <= gap_us) & (F.col("parent_gap_us") > gap_us)).drop("gap_us", "parent_gap_us")


def count_items(sessions: DataFrame, events: DataFrame, user: str, item: str, ts: str, floor_us: int, chunk_us: int = DAY) -> DataFrame:
    """The sessions with n_items, the number of distinct non-null items of their events.

    Events of one user and floor interval share a session, so items are made
    distinct by interval first. Sessions are laid out over the chunks that they
    touch, and what is left of the events takes the last session begun before it
    in its chunk: one sorted pass, no pair of an event and another session.
    """
    chunk = F.explode(F.sequence(F.floor(F.col("start_us") / chunk_us), F.floor(F.col("end_us") / chunk_us)))
    laid = sessions.select("user_id", F.struct("start_us", "end_us").alias("begun"), chunk.alias("chunk"))
    laid = laid.select("user_id", "chunk", F.greatest("begun.start_us", F.col("chunk") * chunk_us).alias("us"), F.lit(None).cast("string").alias("item_id"), "begun")
    us = micros(F.col(ts))
    seen = events.select(F.col(user).alias("user_id"), us.alias("us"), F.col(item).cast("string").alias("item_id")).filter("user_id is not null and us is not null and item_id is not null")
    seen = seen.groupBy("user_id", F.floor(F.col("us") / chunk_us).alias("chunk"), F.floor(F.col("us") / floor_us).alias("cell"), "item_id").agg(F.min("us").alias("us")).drop("cell")
    both = laid.unionByName(seen.withColumn("begun", F.lit(None).cast("struct<start_us: bigint, end_us: bigint>")))
    line = Window.partitionBy("user_id", "chunk").orderBy("us", F.col("begun").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.withColumn("begun", F.last("begun", ignorenulls=True).over(line)).filter("item_id is not null and us <= begun.end_us")
    counts = placed.select("user_id", "begun.start_us", "item_id").distinct().groupBy("user_id", "start_us").agg(F.count(F.lit(1)).alias("n_items"))
    return sessions.join(counts, ["user_id", "start_us"], "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)))

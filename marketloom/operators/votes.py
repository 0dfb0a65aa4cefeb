"""Votes of neighbours for what they hold, counted as integers in blocks of users."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.ranking import best
from marketloom.session import cut_lineage

#: Asking users in one cell of voted(), pairs of neighbours in one cell, and asking users whose votes are counted at once.
QUERY_ROWS, PAIR_ROWS, STRIP = 1 << 16, 1 << 22, 512


def spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, at): every place of every range, with the number of its range."""
    n = stop - start
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) + np.repeat(start - (np.cumsum(n) - n), n)


class Neighbours:
    """What the users of one block hold and who of them are near an item, over items numbered in order of id, 0 for null."""

    def __init__(self, users: pa.Array, lists: pa.ListArray, item_cap: int, near_cap: int):
        flat = lists.flatten()
        coded = flat.field("item_id").dictionary_encode()
        self.users = users
        order = pc.sort_indices(coded.dictionary).to_numpy()
        self.ids = coded.dictionary.take(pa.array(order))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(1, len(order) + 1)
        items = np.concatenate([number, [0]])[pc.fill_null(coded.indices, len(order)).to_numpy(zero_copy_only=False)]
        owner = np.repeat(np.arange(len(users)), np.diff(lists.offsets.to_numpy()))
        held = flat.field("at").to_numpy(zero_copy_only=False) <= item_cap
        self.held = items[held]
        self.held_at = np.concatenate([[0], np.cumsum(np.bincount(owner[held], minlength=len(users)))])
        place = pc.fill_null(flat.field("place"), 0).to_numpy(zero_copy_only=False)
        near = np.flatnonzero((place >= 1) & (place <= near_cap) & (items > 0))
        near = near[np.argsort(items[near], kind="stable")]
        self.near, self.place = owner[near], place[near]
        self.near_at = np.searchsorted(items[near], np.arange(len(order) + 2))

    def numbers(self, items: pa.Array) -> np.ndarray:
        """Of items, -1 where nobody here has it."""
        found = pc.fill_null(pc.index_in(items, value_set=self.ids), -2).to_numpy(zero_copy_only=False) + 1
        return np.where(items.is_null().to_numpy(zero_copy_only=False), 0, found)


def counted(to: Neighbours, users: pa.Array, lists: pa.ListArray, history: int, item_cap: int, near_cap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(asking user, item number, score) of all votes, strip by strip, without what a user holds."""
    n_items, n_users = len(to.ids) + 1, max(1, len(to.users))
    me = pc.fill_null(pc.index_in(users, value_set=to.users), -1).to_numpy(zero_copy_only=False)
    flat, start = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    asker = np.repeat(np.arange(len(users)), np.diff(start))
    items, at = to.numbers(flat.field("item_id")), flat.field("at").to_numpy(zero_copy_only=False)
    place = pc.fill_null(flat.field("place"), 0).to_numpy(zero_copy_only=False)
    among = (place >= 1) & (place <= near_cap)
    for a in range(0, len(users), STRIP):
        part = slice(start[a], start[min(a + STRIP, len(users))])
        u, i, first, own = asker[part] - a, items[part], at[part] <= min(history, item_cap), at[part] <= item_cap
        seed = np.flatnonzero(first & (i > 0))
        which, near = spans(to.near_at[i[seed]], to.near_at[i[seed] + 1])
        which, other = seed[which], to.near[near]
        # an item's list is one place longer than the cap, for the user it may hold
        kept = (other != me[a + u[which]]) & ((to.place[near] < near_cap) | among[part][which])
        reached, ways = np.unique(u[which[kept]] * n_users + other[kept], return_counts=True)
        of, other = np.divmod(reached, n_users)
        which, held = spans(to.held_at[other], to.held_at[other + 1])
        # a neighbour is reached in history ways at most
        votes = np.sort((of[which] * n_items + to.held[held]) * (history + 1) + ways[which])
        keys, ways = np.divmod(votes, history + 1)
        begin = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, score = keys[begin], np.add.reduceat(ways, begin) if len(begin) else ways
        mine = u[own & (i >= 0)] * n_items + i[own & (i >= 0)]
        found = np.searchsorted(keys, mine)
        hit = found < len(keys)
        hit[hit] = keys[found[hit]] == mine[hit]
        free = np.ones(len(keys), bool)
        free[found[hit]] = False
        of, item = np.divmod(keys[free], n_items)
        yield a + of, item, score[free]


def first_places(of: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each user by score, then item number, with their rank; users stand together."""
    if not len(of):
        return of, item, score, of
    most, wide = int(score.max()) + 1, int(item.max()) + 1
    low = of.min()
    order = np.sort(((of - low) * most + (most - 1 - score)) * wide + item)
    rest, item = np.divmod(order, wide)
    of, less = np.divmod(rest, most)
    nth = np.arange(len(of)) - np.searchsorted(of, of)
    kept = nth < k
    return of[kept] + low, item[kept], (most - 1 - less)[kept], nth[kept] + 1


def voted(lists: DataFrame, k: int, history: int, item_cap: int, near_cap: int, pair_rows: int | None = None) -> DataFrame:
    """(user_id, item_id, score, rank): the k items with most votes of those who are near a user's first items.

    lists: (user_id, asks, votes, xs), a row a user, xs of (at, item_id, place): an
    item's place among the user's, and the user's among those near the item.
    Asking users are dealt to blocks, voters too, and every two blocks meet in a
    task of their own. While one block holds all voters, lists are final in
    the task; beyond, the votes of blocks are added up.
    """
    lists = cut_lineage(lists)
    n_asking, n_pairs = lists.agg(F.count_if("asks"), F.coalesce(F.sum(F.when(F.col("votes"), F.size("xs"))), F.lit(0))).first()
    n_right = -(-n_pairs // (pair_rows or PAIR_ROWS)) or 1
    cores = lists.sparkSession.sparkContext.defaultParallelism
    n_left = max(-(-n_asking // QUERY_ROWS), min(-(-cores // n_right), -(-n_asking // STRIP))) or 1
    dealt = lambda n: F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = lists.filter("asks").select("user_id", "xs", F.lit(True).alias("asks"), dealt(n_left).alias("left"), every(n_right).alias("right"))
    voters = lists.filter("votes").select("user_id", "xs", F.lit(False).alias("asks"), every(n_left).alias("left"), dealt(n_right).alias("right"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list, list] = ([], [])
        for batch in batches:
            for side, chosen in zip(sides, (batch["asks"], pc.invert(batch["asks"]))):
                side.append(batch.filter(chosen).select(["user_id", "xs"]))
        if not all(any(x.num_rows for x in side) for side in sides):
            return
        (users, mine), (others, theirs) = ([x.combine_chunks() for x in pa.Table.from_batches(side).columns] for side in sides)
        sides[0].clear(), sides[1].clear()
        to = Neighbours(others, theirs, item_cap, near_cap)
        ids = pa.concat_arrays([pa.nulls(1, to.ids.type), to.ids])
        for of, item, score in counted(to, users, mine, history, item_cap, near_cap):
            rank = np.zeros(len(of), np.int64)
            if n_right == 1:
                of, item, score, rank = first_places(of, item, score, k)
            yield pa.RecordBatch.from_arrays([users.take(pa.array(of)), ids.take(pa.array(item)), pa.array(score), pa.array(rank.astype(np.int32))], ["user_id", "item_id", "score", "rank"])

    cells = asking.unionByName(voters).repartitionById(n_left * n_right, F.col("left") * n_right + F.col("right"))
    found = cells.mapInArrow(work, "user_id string, item_id string, score bigint, rank int")
    if n_right == 1:
        return found
    sums = found.groupBy("user_id", "item_id").agg(F.sum("score").alias("score"))
    return best(sums, ["user_id"], [F.col("score").desc(), F.col("item_id")], k)

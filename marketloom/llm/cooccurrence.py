"""Pairs of items that appear in the same baskets, and how far beyond chance.

Items are heavy or light. Pairs of heavy items are counted by popcounts over a
bit matrix of items by baskets; pairs of light items are counted by hash from
each basket's list; mixed pairs by probing the heavy items in the baskets of a
light item. At most a fixed number of items can be heavy.

Baskets beyond a size are handled the other way round, so that no basket is
ever turned into all its pairs: a pair that small baskets hold is looked up in
the large baskets of whichever of its items is in fewer of them. A pair that
only large baskets hold is found by popcounts over blocks of the items that are
in enough of them, one block of baskets after another, so a task holds two
blocks of items by one of baskets and the counts of one block pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.relational import row_index
from marketloom.session import cut_lineage

#: Items in more than 1/HEAVY of all (basket, item) rows are heavy: no more than HEAVY of them.
HEAVY = 1024
#: Baskets with more items are large.
LARGE_BASKET = 400
#: Items and baskets in a block: bits of two blocks take 32 MB, the counts of a pair of blocks 32 MB.
BLOCK_ITEMS = 2048
BLOCK_BASKETS = 1 << 16


def popcounts(bits: np.ndarray, other: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each row i of bits the popcounts of its AND with rows i+1.. of bits, or with all rows of other."""
    for i in range(len(bits)):
        rest = bits[i + 1 :] if other is None else other
        if len(rest):
            yield i, np.bitwise_count(rest & bits[i]).sum(axis=1, dtype=np.int64)


def bit_rows(row: np.ndarray, col: np.ndarray, n_rows: int, n_cols: int) -> np.ndarray:
    """A packed matrix of n_rows by n_cols bits in whole 64-bit words."""
    bits = np.zeros((n_rows, -(-n_cols // 64)), np.uint64)
    np.bitwise_or.at(bits, (row, col // 64), np.uint64(1) << (col % 64).astype(np.uint64))
    return bits


def heavy_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, n) for heavy items from rows (basket, item): each task packs blocks of baskets and counts all pairs there."""
    out = pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            items = t["item"].combine_chunks().dictionary_encode()
            names = np.array(items.dictionary.to_pylist(), object)
            order = np.argsort(names)
            rank = np.empty(len(names), np.int64)
            rank[order] = np.arange(len(names))
            names = names[order]
            basket = t["basket"].combine_chunks().dictionary_encode()
            bits = bit_rows(rank[items.indices.to_numpy()], basket.indices.to_numpy(), len(names), len(basket.dictionary))
            a, b, n = [], [], []
            for i, c in popcounts(bits):
                j = np.flatnonzero(c)
                a.append(np.full(len(j), i)), b.append(j + i + 1), n.append(c[j])
            if not a:
                return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in out], schema=out)
            a, b = names[np.concatenate(a)], names[np.concatenate(b)]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(np.concatenate(n))], schema=out)

        held, baskets, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch["basket"].dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            if baskets + len(starts) > BLOCK_BASKETS and held:
                # rows of the basket at hand belong to the block that began it
                same = 0 if batch["basket"][0].as_py() != last else (int(starts[1]) if len(starts) > 1 else batch.num_rows)
                yield flush([*held, batch.slice(0, same)])
                held, baskets, batch = [], 0, batch.slice(same)
                if not batch.num_rows:
                    continue
            held.append(batch)
            baskets += len(starts)
            last = batch["basket"][batch.num_rows - 1].as_py()
        if held:
            yield flush(held)

    sorted_rows = rows.select("basket", "item").repartition("basket").sortWithinPartitions("basket")
    return sorted_rows.mapInArrow(count, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def ordered_pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def light_and_mixed(rows: DataFrame) -> DataFrame:
    """(a, b, n) of pairs with at least one light item in the baskets of rows (basket, item, is_heavy)."""
    lists = rows.groupBy("basket").agg(F.sort_array(F.collect_list(F.when(~F.col("is_heavy"), F.col("item")))).alias("light"), F.collect_list(F.when(F.col("is_heavy"), F.col("item"))).alias("heavy"))
    light = lists.filter(F.size("light") > 1).select(F.posexplode("light").alias("at", "x"), "light").filter(F.col("at") + 1 < F.size("light"))
    light = light.select("x", F.explode(F.slice("light", F.col("at") + 2, F.size("light"))).alias("y"))
    mixed = lists.filter((F.size("light") > 0) & (F.size("heavy") > 0)).select(F.explode("light").alias("x"), "heavy").select("x", F.explode("heavy").alias("y"))
    return light.unionByName(mixed).groupBy(*ordered_pair(F.col("x"), F.col("y"))).agg(F.count(F.lit(1)).alias("n"))


def large_only(rows: DataFrame, n_items: int, least: int) -> DataFrame:
    """(a, b, n) of items that share at least least large baskets, from rows (item, is_heavy, number of the basket).

    Items fall into blocks; a task takes a pair of blocks, adds up the popcounts
    of one block of baskets after another, and gives out only the pairs that
    reach least. Pairs of heavy items are left out.
    """
    blocks = max(1, -(-n_items // BLOCK_ITEMS))
    cells = rows.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = cells.select(F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), F.floor(F.col("number") / BLOCK_BASKETS).alias("k"), "block", "item", "is_heavy", (F.col("number") % BLOCK_BASKETS).cast("int").alias("col"))
    out = pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64())])

    class Cell:
        """The items of two blocks as they come up, and their common baskets so far."""

        def __init__(self, p: int, q: int) -> None:
            self.same = p == q
            self.known: list[dict[str, int]] = [{}, {}]
            self.heavy: list[list[bool]] = [[], []]
            self.counts = np.zeros((64, 64), np.int64)

        def add(self, side: np.ndarray, item: list[str], heavy: np.ndarray, col: np.ndarray) -> None:
            at = np.empty(len(item), np.int64)
            for i, (s, name) in enumerate(zip(side.tolist(), item)):
                n = len(self.known[s])
                at[i] = self.known[s].setdefault(name, n)
                if at[i] == n:
                    self.heavy[s].append(bool(heavy[i]))
            n, m = len(self.known[0]), len(self.known[0 if self.same else 1])
            if n > self.counts.shape[0] or m > self.counts.shape[1]:
                grown = np.zeros((max(n, 2 * self.counts.shape[0]), max(m, 2 * self.counts.shape[1])), np.int64)
                grown[: self.counts.shape[0], : self.counts.shape[1]] = self.counts
                self.counts = grown
            width = int(col.max()) + 1
            left = bit_rows(at[side == 0], col[side == 0], n, width)
            if self.same:
                for i, c in popcounts(left):
                    self.counts[i, i + 1 : n] += c
            else:
                right = bit_rows(at[side == 1], col[side == 1], m, width)
                for i, c in popcounts(left, right):
                    self.counts[i, :m] += c

        def pairs(self) -> pa.RecordBatch:
            other = 0 if self.same else 1
            i, j = np.nonzero(self.counts >= least)
            light = [np.array(h, bool) for h in self.heavy]
            keep = ~(light[0][i] & light[other][j])
            i, j = i[keep], j[keep]
            x, y = np.array(list(self.known[0]), object)[i], np.array(list(self.known[other]), object)[j]
            low = x < y
            return pa.RecordBatch.from_arrays([pa.array(np.where(low, x, y), pa.string()), pa.array(np.where(low, y, x), pa.string()), pa.array(self.counts[i, j])], schema=out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, at, part, held = None, None, None, []

        def take() -> None:
            t = pa.Table.from_batches(held)
            cell.add((t["block"].to_numpy() != at[0]).astype(np.int64), t["item"].to_pylist(), t["is_heavy"].to_numpy(), t["col"].to_numpy())
            held.clear()

        for batch in batches:
            p, q, k = (batch[c].to_numpy() for c in ("p", "q", "k"))
            starts = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (q[1:] != q[:-1]) | (k[1:] != k[:-1])))) if len(p) else []
            for a, b in zip(starts, [*starts[1:], len(p)]):
                here = (int(p[a]), int(q[a]))
                if held and (here, int(k[a])) != (at, part):
                    take()
                if here != at:
                    if cell is not None:
                        yield cell.pairs()
                    cell, at = Cell(*here), here
                part = int(k[a])
                held.append(batch.slice(a, b - a))
        if held:
            take()
        if cell is not None:
            yield cell.pairs()

    return cells.repartition("p", "q").sortWithinPartitions("p", "q", "k").mapInArrow(compare, "a string, b string, n bigint")


def with_large_baskets(kept: DataFrame, large: DataFrame, least: int) -> DataFrame:
    """(a, b, n) of pairs with at least one light item, where some baskets of kept are large (basket, number)."""
    of_item = cut_lineage(kept.join(large, "basket").select("item", "is_heavy", "number"))
    n_large = of_item.groupBy("item").agg(F.count(F.lit(1)).alias("n_large"))
    counted = light_and_mixed(kept.join(large, "basket", "left_anti"))
    for side in ("a", "b"):
        counted = counted.join(n_large.select(F.col("item").alias(side), F.col("n_large").alias(f"{side}_large")), side, "left").fillna(0, [f"{side}_large"])
    hope = F.least("a_large", "b_large")
    counted = cut_lineage(counted.filter(F.col("n") + hope >= least).withColumn("hope", hope))
    # the baskets of the item that is in fewer of them, looked up among those of the other
    few = F.when(F.col("a_large") <= F.col("b_large"), F.col("a")).otherwise(F.col("b"))
    asked = counted.filter("hope > 0").select("a", "b", few.alias("item"), F.when(few == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("many"))
    probes = asked.join(of_item.select("item", "number"), "item").drop("item").withColumnRenamed("many", "item")
    probed = probes.join(of_item.select("item", "number"), ["item", "number"], "left_semi").groupBy("a", "b").agg(F.count(F.lit(1)).alias("more"))
    small = counted.join(probed, ["a", "b"], "left").select("a", "b", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
    often = of_item.join(n_large.filter(F.col("n_large") >= least).select("item"), "item", "left_semi")
    beyond = large_only(often, n_large.filter(F.col("n_large") >= least).count(), least)
    # a pair of both kinds has all its baskets in the first
    return small.unionByName(beyond).groupBy("a", "b").agg(F.max("n").alias("n"))


def item_pairs(df: DataFrame, basket: str, item: str, min_count: int = 5, min_lift: float = 0.0, heavy: int = HEAVY, large_basket: int = LARGE_BASKET) -> DataFrame:
    """(item_a, item_b, n_a, n_b, n_ab, n_baskets): item_a < item_b, in at least min_count common baskets, with a lift of at least min_lift.

    The lift is n_ab * n_baskets / (n_a * n_b). A basket is the set of its
    items: repeats count once; rows with a null basket or item are left out, but
    a basket counts only if it has an item. Ties do not matter, as nothing is
    ranked. An empty table gives no rows; other columns are never read. Counts are
    exact for any choice of heavy and large_basket, which only move the work.
    """
    rows = df.select(F.col(basket).cast("string").alias("basket"), F.col(item).cast("string").alias("item")).filter("basket is not null and item is not null").distinct()
    rows = cut_lineage(rows)
    n_baskets = rows.agg(F.countDistinct("basket")).scalar()
    frequent = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n_item")).filter(F.col("n_item") >= min_count)
    n_rows = rows.count()
    kept = cut_lineage(rows.join(frequent, "item").select("basket", "item", (F.col("n_item") * heavy > n_rows).alias("is_heavy")))
    sizes = kept.groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
    large = cut_lineage(sizes.filter(F.col("size") > large_basket).select("basket"))
    other = light_and_mixed(kept)
    if not large.isEmpty():
        other = with_large_baskets(kept, row_index(large, ["basket"], "number"), min_count)
    pairs = heavy_pairs(kept.filter("is_heavy")).unionByName(other).filter(F.col("n") >= min_count)
    fa, fb = frequent.select(F.col("item").alias("a"), F.col("n_item").alias("n_a")), frequent.select(F.col("item").alias("b"), F.col("n_item").alias("n_b"))
    scored = pairs.join(fa, "a").join(fb, "b").select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "n_a", "n_b", F.col("n").alias("n_ab"), n_baskets.alias("n_baskets"))
    return scored.filter(F.col("n_ab") * F.col("n_baskets") >= F.lit(min_lift) * F.col("n_a") * F.col("n_b"))

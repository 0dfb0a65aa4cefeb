"""Models: factorisation, text similarity, graph and sequence encoders, rankers, the greedy re-ranker."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.constants import AGENT_SHARE, CATEGORY_SHARES
from marketloom.functions.ranking import best
from marketloom.functions.scalar import dot
from marketloom.operators import features as pair_parts
from marketloom.operators.cleaning import index_pairs
from marketloom.operators.relational import row_index
from marketloom.session import cut_lineage

KEY = ["user_id", "item_id"]


def fit_als(scores: DataFrame, rank: int = 32, iterations: int = 5, reg: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """(user_id, factors) and (item_id, factors) of implicit-feedback alternating least squares over (user_id, item_id, score)."""
    indexed = cut_lineage(index_pairs(scores).select(*KEY, F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), F.col("score").cast("float").alias("score")))
    # a checkpoint an iteration, after which the shuffles of those before are deleted
    model = ALS(rank=rank, maxIter=iterations, regParam=reg, implicitPrefs=True, userCol="user_idx", itemCol="item_idx", ratingCol="score", coldStartStrategy="drop", seed=42, checkpointInterval=1).fit(indexed)
    users = indexed.select("user_id", "user_idx").distinct().join(model.userFactors.withColumnRenamed("id", "user_idx"), "user_idx").select("user_id", F.col("features").alias("factors"))
    items = indexed.select("item_id", "item_idx").distinct().join(model.itemFactors.withColumnRenamed("id", "item_idx"), "item_idx").select("item_id", F.col("features").alias("factors"))
    return users, items


#: Queries and items in one cell of dealt_best().
QUERY_ROWS, ITEM_ROWS = 1 << 16, 1 << 19
#: Queries and, at first and at most, items that are multiplied at once inside a cell; a tile should stay in the cache.
STRIP, TILE, MOST_TILE = 256, 8192, 8192
#: One product in single precision is off by no more than this share of the lengths, for each number of a row.
ROUNDING = 2.4e-7


class Shortlist:
    """The best items of the queries of one strip: score, then the item's place in order of id."""

    def __init__(self, most: np.ndarray, place: np.ndarray):
        self.most, self.place = most, place
        self.bound = np.full(len(most), -np.inf)
        self.rows, self.cols, self.scores = np.array([], np.int64), np.array([], np.int64), np.array([])
        self.new, self.waiting = [], 0

    def ordered(self, rows: np.ndarray, cols: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((self.place[cols], -scores, rows))
        rows, cols, scores = rows[order], cols[order], scores[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = nth < self.most[rows]
        return rows[kept], cols[kept], scores[kept], nth[kept]

    def add(self, rows: np.ndarray, cols: np.ndarray, scores: np.ndarray) -> None:
        """New pairs, none of them known; they wait until there are about as many as in the lists."""
        self.new.append((rows, cols, scores))
        self.waiting += len(rows)
        if self.waiting > self.most.sum() or np.isneginf(self.bound[rows]).any():
            self.merge()

    def merge(self) -> None:
        parts = zip((self.rows, self.cols, self.scores), *self.new)
        self.rows, self.cols, self.scores, self.nth = self.ordered(*map(np.concatenate, parts))
        self.new, self.waiting = [], 0
        full = self.nth == self.most[self.rows] - 1
        self.bound[self.rows[full]] = self.scores[full]


def first_bound(s: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A value that at least as many of each row reach as are wanted of it; -inf where a row is too short."""
    bound, short = np.full(len(s), -np.inf), most < s.shape[1]
    if short.any():
        n = s.shape[1] - int(most[short].max())
        bound[short] = np.partition(s[short], n, axis=1)[:, n]
    return bound


class Reach:
    """Where a tile of products reaches a bound a row; its memory is used again for the next tile."""

    def __init__(self, rows: int, width: int):
        self.s, self.mask = np.empty(rows * width, np.float32), np.empty(rows * (width + 7), bool)

    def products(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.matmul(left, right.T, out=self.s[: len(left) * len(right)].reshape(len(left), len(right)))

    def at_least(self, s: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As np.nonzero(s >= least), eight places at a time, as few of them reach it."""
        n, width = s.shape
        wide = -(-width // 8) * 8
        flat = self.mask[: n * wide]
        mask = flat.reshape(n, wide)
        mask[:, width:] = False
        np.greater_equal(s, least[:, None], out=mask[:, :width])
        eights = np.flatnonzero(flat.view(np.uint64))
        which, place = np.nonzero(flat.reshape(-1, 8)[eights])
        return np.divmod(eights[which] * 8 + place, wide)


def in_parts(f, rows: np.ndarray, cols: np.ndarray, size: int = 1 << 16) -> np.ndarray:
    return np.concatenate([f(rows[a : a + size], cols[a : a + size]) for a in range(0, len(rows), size)] or [np.array([])])


def factor_products(cosine: bool):
    """For dealt_best(): inner products of factor rows.

    Items go by falling length, so a query is done when length times length
    is less than the worst of its list. Single precision only rules pairs out;
    what is left is computed again in double precision, so scores of equal
    rows are equal.
    """

    def matrix(side: pa.Table) -> np.ndarray:
        m = side["factors"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        m = m.reshape(side.num_rows, -1)
        return m / np.maximum(np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True), 1e-12) if cosine else m

    def products(asked: pa.Table, stock: pa.Table, most: np.ndarray, place: np.ndarray):
        left, right = matrix(asked), matrix(stock)
        length = np.sqrt(np.einsum("ij,ij->i", right, right, dtype=np.float64))
        by = np.argsort(-length, kind="stable")
        right, length, place = right[by], length[by], place[by]
        left32, right32 = left.astype(np.float32, copy=False), right.astype(np.float32, copy=False)
        reached = Reach(STRIP, max(TILE, MOST_TILE))
        for a in range(0, len(left), STRIP):
            q, q32 = left[a : a + STRIP].astype(np.float64), left32[a : a + STRIP]
            reach = np.sqrt((q * q).sum(axis=1))
            short, going, b, size = Shortlist(most[a : a + STRIP], place), np.arange(len(q)), 0, TILE
            while b < len(right):
                going = going[reach[going] * length[b] * (1 + 1e-6) >= short.bound[going]]
                if not len(going):
                    break
                s = reached.products(q32[going], right32[b : b + size])
                slack = reach[going] * length[b] * ROUNDING * (q.shape[1] + 8)
                least = short.bound[going] if b else first_bound(s, short.most[going])
                # twice the slack: the first bound is itself in single precision
                r, c = reached.at_least(s, (least - 2 * slack).astype(np.float32))
                r, c = going[r], c + b
                short.add(r, c, in_parts(lambda r, c: (q[r] * right[c].astype(np.float64)).sum(axis=1), r, c))
                b, size = b + size, min(2 * size, MOST_TILE)
            short.merge()
            yield a + short.rows, by[short.cols], short.scores, short.nth + 1

    return products


def dealt_best(queries: DataFrame, query: str, base: DataFrame, item: str, k: int, products, needs: Sequence[str], block_rows: int | None = None, seen: DataFrame | None = None, item_rows: int = ITEM_ROWS) -> DataFrame:
    """(query, item, score, rank, other columns): the k best items of each query by products.

    A stated set of queries meets all items: both are dealt to blocks, and every
    pair of blocks is a task of its own that gives k rows a query. needs are the
    columns that products reads on both sides; all other columns are carried along.
    While one block holds all items, lists are final and nothing is shuffled
    any more. Pairs of seen (query, item) are left out before the cut: a query's
    blocks give as many rows more as it has seen pairs.
    """
    if seen is None:
        asking = queries.withColumn("more", F.lit(0))
    else:
        seen = seen.select(query, item).distinct()
        asking = queries.join(seen.groupBy(query).agg(F.count(F.lit(1)).cast("int").alias("more")), query, "left").fillna(0, ["more"])
    target = item if item != query else "similar_id"
    n_rows, n_stock = queries.count(), base.count()
    n_items = -(-n_stock // (block_rows or item_rows)) or 1
    n_queries = -(-n_rows // (block_rows or QUERY_ROWS)) or 1
    if block_rows is None:  # one task a core, if there are queries enough
        n_queries = max(n_queries, min(-(-queries.sparkSession.sparkContext.defaultParallelism // n_items), -(-n_rows // STRIP)))
    with_query, with_item = ([c for c in df.columns if c not in (key, *needs)] for df, key in ((queries, query), (base, item)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = asking.select(F.col(query).alias("id"), *needs, *with_query, dealt(query, n_queries).alias("left"), every(n_items).alias("right"), F.lit(True).alias("is_query"), "more")
    b = base.select(F.col(item).alias("id"), *needs, *with_item, every(n_queries).alias("left"), dealt(item, n_items).alias("right"), F.lit(False).alias("is_query"), F.lit(0).alias("more"))
    kinds = {f.name: f.dataType.simpleString() for df in (queries, base) for f in df.schema.fields}
    fields = [(query, kinds[query]), (target, kinds[item]), ("score", "double"), ("rank", "int"), *((c, kinds[c]) for c in (*with_query, *with_item))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list, list] = ([], [])
        for batch in batches:
            asks = batch["is_query"]
            for side, chosen in zip(sides, (asks, pc.invert(asks))):
                side.append(batch.filter(chosen))
        if not all(any(x.num_rows for x in side) for side in sides):
            return
        asked, stock = (pa.Table.from_batches(side).combine_chunks() for side in sides)
        sides[0].clear(), sides[1].clear()
        place = np.empty(stock.num_rows, np.int64)
        place[pc.sort_indices(stock["id"]).to_numpy()] = np.arange(stock.num_rows)
        asked = asked.take(pc.sort_indices(asked["more"]))  # those that want many rows together
        for rows, cols, scores, nth in products(asked, stock, k + asked["more"].to_numpy().astype(np.int64), place):
            left, right = asked.select(["id", *with_query]).take(pa.array(rows)), stock.select(["id", *with_item]).take(pa.array(cols))
            out = [left["id"], right["id"], pa.array(scores), pa.array(nth.astype(np.int32)), *(left[c] for c in with_query), *(right[c] for c in with_item)]
            yield from pa.Table.from_arrays(out, [name for name, _ in fields]).combine_chunks().to_batches()

    cells = q.unionByName(b, allowMissingColumns=True).repartitionById(n_queries * n_items, F.col("left") * n_items + F.col("right"))
    found = cells.mapInArrow(work, ", ".join(f"`{name}` {kind}" for name, kind in fields))
    if seen is not None:
        found = found.join(seen.select(query, F.col(item).alias(target)), [query, target], "left_anti")
    return found if n_items == 1 and seen is None else best(found, [query], [F.col("score").desc(), F.col(target)], k).select(*[name for name, _ in fields])


def nearest(queries: DataFrame, query: str, base: DataFrame, item: str, k: int, cosine: bool = False, block_rows: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """(query, item, score, rank, other columns of both sides): the k largest inner products of factor rows, see dealt_best()."""
    return dealt_best(queries, query, base, item, k, factor_products(cosine), ["factors"], block_rows, seen)


def als_top(scores: DataFrame, users: DataFrame, k: int, valid: DataFrame | None = None, rank: int = 32, about_users: DataFrame | None = None, about_items: DataFrame | None = None, fitted: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(user_id, item_id, score, rank): the k best by factors for known users; invalid items go after the cut.

    fitted: what fit_als() gave, where it is there already.

    Columns of about_users and about_items, one row a key, come along. All that
    is asked of a user or an item is joined before the lists are made, as lists are many rows.
    """
    user_factors, item_factors = fit_als(scores, rank) if fitted is None else fitted
    asked = user_factors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    if about_users is not None:
        asked = asked.join(about_users, "user_id", "left")
    if about_items is not None:
        item_factors = item_factors.join(about_items, "item_id", "left")
    if valid is None:
        return nearest(cut_lineage(asked), "user_id", cut_lineage(item_factors), "item_id", k)
    stock = item_factors.join(valid.select("item_id", F.lit(True).alias("is_valid")).distinct(), "item_id", "left")
    # both are counted before they are dealt
    return nearest(cut_lineage(asked), "user_id", cut_lineage(stock), "item_id", k).filter("is_valid").drop("is_valid")


def pair_scores(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Inner product of each pair's factors, 0 for unknown users or items."""
    u, i = user_factors.withColumnRenamed("factors", "uf"), item_factors.withColumnRenamed("factors", "if")
    return pairs.select(*KEY).join(u, "user_id", "left").join(i, "item_id", "left").select(*KEY, F.coalesce(dot(F.col("uf"), F.col("if")), F.lit(0.0)).alias("score"))


def first_factors(n_items: int, rank: int) -> np.ndarray:
    """Where all tasks of fit_bpr begin, drawn again by each."""
    return np.random.default_rng(42).normal(0, 0.1, (n_items, rank))


def descent(turn: int, n_items: int, rank: int, epochs: int, rate: float, reg: float):
    """The work of one task of fit_bpr: stochastic descent on its users' pairs from the shared item factors.

    Rows with factors are items that have left their first ones, the others are pairs.
    """

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, pairs = first_factors(n_items, rank), []
        for batch in batches:
            is_item = batch["user_idx"].is_null()
            moved = batch.filter(is_item)
            if moved.num_rows:
                q[moved["item_idx"].to_numpy()] = moved["factors"].flatten().to_numpy().reshape(-1, rank)
            own = batch.filter(pc.invert(is_item))
            pairs.append(np.stack([own["user_idx"].to_numpy(), own["item_idx"].to_numpy()]))
        pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        if not pairs.size:
            return
        users, pos = pairs[:, np.lexsort(pairs[::-1])]
        users, at = np.unique(users, return_inverse=True)
        old = q.copy()
        p = np.random.default_rng(42).normal(0, 0.1, (len(users), rank))
        local = np.random.default_rng(turn)
        for _ in range(epochs):
            for i in local.permutation(len(pos)):
                u, x, y = at[i], pos[i], local.integers(len(q))
                d = 1 / (1 + math.exp(min(30, p[u] @ (q[x] - q[y]))))
                pu = p[u].copy()
                p[u] += rate * (d * (q[x] - q[y]) - reg * p[u])
                q[x] += rate * (d * pu - reg * q[x])
                q[y] += rate * (-d * pu - reg * q[y])
        moved = np.flatnonzero(np.any(q != old, axis=1))
        for is_user, ids, rows in ((True, users, p), (False, moved, q[moved])):
            for a in range(0, len(ids), 10_000):
                part = rows[a : a + 10_000].astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * rank), pa.array(part.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), is_user)), pa.array(ids[a : a + 10_000]), lists], ["is_user", "idx", "factors"])

    return descend


#: Tasks of fit_bpr; each holds the factors of all items.
BPR_TASKS = 8


def fit_bpr(scores: DataFrame, rank: int = 16, epochs: int = 5, rate: float = 0.05, reg: float = 0.01, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """Factors by Bayesian personalised ranking: users are dealt to tasks, each descends on its own pairs, item factors are averaged a round.

    Item factors go from round to round as rows; the driver sees none of them.
    """
    indexed = cut_lineage(index_pairs(scores).select(*KEY, F.col("user_idx").cast("bigint"), F.col("item_idx").cast("bigint")))
    n_items = indexed.agg(F.coalesce(F.max("item_idx") + 1, F.lit(0))).first()[0]
    dealt = indexed.select(F.pmod(F.xxhash64("user_id"), F.lit(BPR_TASKS)).cast("int").alias("part"), "user_idx", "item_idx")
    state = None
    for turn in range(rounds):
        rows = dealt.withColumn("factors", F.lit(None).cast("array<float>"))
        if state is not None:
            to_all = F.explode(F.sequence(F.lit(0), F.lit(BPR_TASKS - 1))).alias("part")
            rows = rows.unionByName(state.select(to_all, F.lit(None).cast("bigint").alias("user_idx"), F.col("idx").alias("item_idx"), "factors"))
        work = descent(turn, n_items, rank, epochs, rate, reg)
        out = cut_lineage(rows.repartitionById(BPR_TASKS, F.col("part")).mapInArrow(work, "is_user boolean, idx bigint, factors array<float>"))
        means = [F.avg(F.col("factors")[i]) for i in range(rank)]
        mean = out.filter("not is_user").groupBy("idx").agg(F.array(*means).cast("array<float>").alias("factors"))
        state = mean if state is None else mean.unionByName(state.join(mean.select("idx"), "idx", "left_anti"))
        state = cut_lineage(state)
    names = indexed.select("item_id", F.col("item_idx").alias("idx")).distinct()
    user_names = indexed.select("user_id", F.col("user_idx").alias("idx")).distinct()

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in batches:
            still = np.flatnonzero(batch["factors"].is_null().to_numpy(zero_copy_only=False))
            if len(still):  # drawn as a negative by no task
                first = first_factors(n_items, rank) if first is None else first
                lists = batch["factors"].to_pylist()
                for i in still:
                    lists[i] = first[batch["idx"][i].as_py()].tolist()
                batch = batch.set_column(batch.schema.get_field_index("factors"), "factors", pa.array(lists, pa.list_(pa.float32())))
            yield batch.select(["item_id", "factors"])

    items = names.join(state, "idx", "left").select("item_id", "idx", "factors").mapInArrow(filled, "item_id string, factors array<float>")
    return out.filter("is_user").join(user_names, "idx").select("user_id", "factors"), items


def tfidf(docs: DataFrame, item: str, text: str, stop: Sequence[str] = (), most_terms: int = 5000) -> DataFrame:
    """(item, term, w): smoothed inverse document frequency, rows of length 1, the most frequent terms only."""
    words = F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}_]+"))
    tokens = docs.select(F.col(item).alias("item"), words.alias("term")).filter((F.length("term") >= 2) & ~F.col("term").isin(list(stop) or [""]))
    tf = tokens.groupBy("item", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    kept = df.orderBy(F.col("cf").desc(), "term").limit(most_terms)
    n = docs.agg(F.count(F.lit(1))).scalar()
    w = tf.join(kept, "term").withColumn("w", F.col("tf") * (F.ln((1 + n) / (1 + F.col("df"))) + 1))
    norms = w.groupBy("item").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norms, "item").select("item", "term", (F.col("w") / F.col("norm")).alias("w"))


#: Terms, the most frequent first, that sparse_products() keeps as full columns; users and items it takes at once; items in a cell.
FULL_TERMS, SPARSE_STRIP, SPARSE_BLOCK, SPARSE_ROWS = 48, 32, 64, 1 << 18


def sparse_products():
    """For dealt_best(): cosines of sums of sparse rows (terms, ws) with single rows, where above 0.

    The most frequent terms are multiplied as matrices; the items of any other
    term of a user get its share added one term after the other. Blocks whose
    best item is not among the best of blocks are out. Single precision only
    rules pairs out, as in factor_products().
    """

    def flat(side: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        terms, ws = (side[c].combine_chunks() for c in ("terms", "ws"))
        start = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy())]).astype(np.int64)
        return start, terms.flatten().to_numpy(), ws.flatten().to_numpy()

    def products(asked: pa.Table, stock: pa.Table, most: np.ndarray, place: np.ndarray):
        (at, ut, uw), (start, terms, ws) = flat(asked), flat(stock)
        n_items, n_terms = stock.num_rows, int(max(ut.max(initial=-1), terms.max(initial=-1))) + 1
        n_blocks = -(-n_items // SPARSE_BLOCK)
        sizes = np.diff(start)
        owner = np.repeat(np.arange(n_items, dtype=np.int32), sizes)
        length = np.sqrt(np.bincount(owner, ws * ws, n_items).max(initial=0))
        full = np.argsort(-np.bincount(terms, minlength=n_terms), kind="stable")[:FULL_TERMS]
        column = np.full(n_terms, -1, np.int32)
        column[full] = np.arange(len(full))
        is_full = column[terms] >= 0
        matrix = np.zeros((len(full), n_blocks * SPARSE_BLOCK), np.float32)
        matrix[column[terms[is_full]], owner[is_full]] = ws[is_full]
        rare = np.flatnonzero(~is_full)
        rare = rare[np.argsort(terms[rare], kind="stable")]
        first = np.searchsorted(terms[rare], np.arange(n_terms + 1))
        holders, share = owner[rare], ws[rare].astype(np.float32)
        slack = 2 * ROUNDING * length * (FULL_TERMS + int(sizes.max(initial=0)) + 8)
        for a in range(0, len(at) - 1, SPARSE_STRIP):
            z = min(a + SPARSE_STRIP, len(at) - 1)
            u = np.zeros((z - a, n_terms))
            np.add.at(u, (np.repeat(np.arange(z - a), np.diff(at[a : z + 1])), ut[at[a] : at[z]]), uw[at[a] : at[z]])
            u /= np.maximum(np.sqrt((u * u).sum(axis=1, keepdims=True)), 1e-300)
            s = u[:, full].astype(np.float32) @ matrix
            for row, term in zip(*np.nonzero((u > 0) & (column < 0))):
                s[row, holders[first[term] : first[term + 1]]] += np.float32(u[row, term]) * share[first[term] : first[term + 1]]
            s = s.reshape(z - a, n_blocks, SPARSE_BLOCK)
            top = s.max(axis=2)
            least = np.maximum(first_bound(top, most[a:z]) - slack, 1e-30).astype(np.float32)
            r, block = np.nonzero(top >= least[:, None])
            i, j = np.nonzero(s[r, block] >= least[r, None])
            r, c = r[i], block[i] * SPARSE_BLOCK + j

            def exact(r: np.ndarray, c: np.ndarray) -> np.ndarray:
                n = sizes[c]
                each = np.repeat(np.arange(len(c)), n)
                where = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + start[c][each]
                return np.bincount(each, u[r[each], terms[where]] * ws[where], len(c))

            short = Shortlist(most[a:z], place)
            short.add(r, c, in_parts(exact, r, c))
            short.merge()
            yield a + short.rows, short.cols, short.scores, short.nth + 1

    return products


def common_counts():
    """For dealt_best(): how many numbers the lists held have in common, where any; of equal counts the smaller id first."""

    def flat(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        held = side["held"].combine_chunks()
        return np.concatenate([[0], np.cumsum(pc.list_value_length(held).to_numpy())]).astype(np.int64), held.flatten().to_numpy()

    def products(asked: pa.Table, stock: pa.Table, most: np.ndarray, place: np.ndarray):
        (at, wanted), (start, numbers) = flat(asked), flat(stock)
        n, k = stock.num_rows, min(int(most.max()), stock.num_rows)
        by = np.argsort(numbers, kind="stable")
        holders = np.repeat(np.arange(n), np.diff(start))[by]
        first = np.searchsorted(numbers[by], np.arange(max(wanted.max(initial=-1), numbers.max(initial=-1)) + 2))
        for a in range(0, len(at) - 1, SPARSE_STRIP):
            z = min(a + SPARSE_STRIP, len(at) - 1)
            # the place breaks ties within the count, so no two keys are equal
            keys = np.zeros((z - a, n), np.int64)
            for row in range(z - a):
                for x in wanted[at[a + row] : at[a + row + 1]]:
                    keys[row, holders[first[x] : first[x + 1]]] += n
            keys += n - 1 - place
            chosen = np.argpartition(keys, n - k, axis=1)[:, n - k :]
            chosen = np.take_along_axis(chosen, np.argsort(-np.take_along_axis(keys, chosen, 1), axis=1), 1)
            score = np.take_along_axis(keys, chosen, 1) // n
            rows, nth = np.nonzero((score > 0) & (np.arange(k) < most[a:z, None]))
            yield a + rows, chosen[rows, nth], score[rows, nth].astype(np.float64), nth + 1

    return products


def content_based(weights: DataFrame, history: DataFrame, k: int, query_users: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, score, rank): cosine of the mean title of a user's items with every other item that shares a term.

    Weights are positive. Users and items meet as blocks, see dealt_best(); pairs that share a term are never rows.
    """
    mine = history.select(*KEY).distinct()
    if query_users is not None:
        mine = mine.join(query_users.select("user_id"), "user_id", "left_semi")
    numbers = row_index(weights.select("term").distinct(), ["term"], "t").select("term", F.col("t").cast("int").alias("t"))
    row = F.array_sort(F.collect_list(F.struct("t", "w")))
    titles = cut_lineage(weights.join(numbers, "term").groupBy(F.col("item").alias("item_id")).agg(row.alias("x")).select("item_id", F.col("x.t").alias("terms"), F.col("x.w").alias("ws")))
    # a sum has the direction of the mean
    sums = mine.join(titles, "item_id").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("item_id", "terms", "ws"))).alias("x"))
    asked = cut_lineage(sums.select("user_id", F.flatten("x.terms").alias("terms"), F.flatten("x.ws").alias("ws")))
    return dealt_best(asked, "user_id", titles, "item_id", k, sparse_products(), ["terms", "ws"], seen=mine, item_rows=SPARSE_ROWS)


def seeded_vector(key: Column, size: int) -> Column:
    """A vector in [-1, 1) that depends on the key alone."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(20001)) / 10000.5 - 1.0 for i in range(size)])


def graph_embeddings(pairs: DataFrame, size: int = 16, layers: int = 2) -> DataFrame:
    """(node, vec) after layers of mean aggregation over the user-item graph, from vectors seeded by the node's id."""
    edges = pairs.select(F.concat(F.lit("u:"), "user_id").alias("a"), F.concat(F.lit("i:"), "item_id").alias("b")).dropna().distinct()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    vec = both.select(F.col("a").alias("node")).distinct().select("node", seeded_vector(F.col("node"), size).alias("vec"))
    for _ in range(layers):
        near = both.join(vec, F.col("b") == F.col("node")).groupBy("a").agg(*[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(size)])
        mixed = vec.join(near, F.col("node") == F.col("a"), "left")
        vec = cut_lineage(mixed.select("node", F.array(*[F.greatest(F.lit(0.0), (F.col("vec")[i] + F.coalesce(F.col(f"m{i}"), F.lit(0.0))) / 2) for i in range(size)]).alias("vec")))
    return vec


def user_sequences(events: DataFrame, length: int = 20) -> DataFrame:
    """(user_id, items): a user's last items in order of time, null in front up to the length."""
    known = events.filter("user_id is not null and item_id is not null and event_ts is not null")
    last = best(known.select("user_id", "item_id", "event_ts", "event_id"), ["user_id"], [F.col("event_ts").desc(), F.col("event_id").desc()], length)
    lists = last.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("p"), "item_id"))).alias("s"))
    items = F.transform("s", lambda x: x["item_id"])
    return lists.select("user_id", F.concat(F.array_repeat(F.lit(None).cast("string"), F.lit(length) - F.size("s")), items).alias("items"))


def encode_sequences(sequences: DataFrame, size: int = 16) -> DataFrame:
    """(user_id, vec): a gated recurrent pass with fixed seeded weights over id-seeded item vectors."""

    def encode(batches):
        rng = np.random.default_rng(7)
        wz, wh, uz, uh = (rng.normal(0, 0.3, (size, size)) for _ in range(4))
        table: dict[str, np.ndarray] = {}

        def vector(item: str | None) -> np.ndarray:
            if item is None:
                return np.zeros(size)
            if item not in table:
                table[item] = np.random.default_rng(list(item.encode())).uniform(-1, 1, size)
            return table[item]

        for pdf in batches:
            steps = np.stack([np.stack([vector(i) for i in s]) for s in pdf["items"]]) if len(pdf) else np.zeros((0, 1, size))
            h = np.zeros((len(steps), size))
            for t in range(steps.shape[1]):
                x = steps[:, t]
                z = 1 / (1 + np.exp(-(x @ wz + h @ uz)))
                h = (1 - z) * h + z * np.tanh(x @ wh + h @ uh)
            yield pd.DataFrame({"user_id": pdf["user_id"], "vec": list(h)})

    return sequences.mapInPandas(encode, "user_id string, vec array<double>")


def fit_pointwise(rows: DataFrame, features: Sequence[str], label: str = "label"):
    """Gradient-boosted trees on single rows; nulls count as 0."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="v"), GBTClassifier(featuresCol="v", labelCol=label, maxIter=10, maxDepth=4, seed=42)]).fit(rows.fillna(0, list(features)))


def pairwise_rows(rows: DataFrame, features: Sequence[str], negatives: int = 10) -> DataFrame:
    """Feature differences of each positive row with up to negatives other rows of its user, in both directions."""
    pos = rows.filter("label = 1").select("user_id", *[F.col(f).alias(f"p_{f}") for f in features])
    neg = best(rows.filter("label = 0"), ["user_id"], [F.xxhash64("item_id"), F.col("item_id")], negatives, "nr").select("user_id", *features)
    d = pos.join(neg, "user_id").select(*[(F.col(f"p_{f}") - F.col(f)).alias(f) for f in features])
    return d.withColumn("label", F.lit(1.0)).unionByName(d.select(*[(-F.col(f)).alias(f) for f in features]).withColumn("label", F.lit(0.0)))


def compared_rows(rows: DataFrame, negatives: int = 10) -> DataFrame:
    """The rows that pairwise_rows() compares: ids and labels choose them, so they can be chosen before features are joined."""
    own = users_with_positives(rows)
    neg = best(own.filter("label = 0"), ["user_id"], [F.xxhash64("item_id"), F.col("item_id")], negatives, "nr").drop("nr")
    return own.filter("label = 1").unionByName(neg)


def fit_pairwise(rows: DataFrame, features: Sequence[str]):
    """A linear scorer trained on pairs: the order within a user is what counts."""
    diffs = pairwise_rows(rows.fillna(0, list(features)), features)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="v"), LogisticRegression(featuresCol="v", labelCol="label", fitIntercept=False, maxIter=20, regParam=0.01)]).fit(diffs)


#: What each kind of outcome is worth in the blended score. Fixed values.
OUTCOME_VALUES = [0.0, 0.8, 0.5, 1.0, 0.9]


def fit_multitask(rows: DataFrame, features: Sequence[str], outcome: str = "outcome"):
    """A yes/no model and a five-way model of the outcome."""
    clean = rows.fillna(0, list(features))
    five = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="w"), LogisticRegression(featuresCol="w", labelCol=outcome, probabilityCol="p5", rawPredictionCol="r5", predictionCol="y5", family="multinomial", maxIter=20)]).fit(clean)
    return fit_pointwise(clean, features), five


def multitask_scores(models, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    two, five = models
    out = five.transform(two.transform(rows.fillna(0, list(features))))
    p5 = vector_to_array("p5")
    worth = sum((F.coalesce(F.get(p5, F.lit(i)), F.lit(0.0)) * v for i, v in enumerate(OUTCOME_VALUES)), F.lit(0.0))
    return out.withColumn("score", 0.7 * vector_to_array("probability")[1] + 0.3 * worth)


def users_with_positives(rows: DataFrame) -> DataFrame:
    """Rows of users with at least one positive row."""
    return rows.join(rows.filter("label = 1").select("user_id").distinct(), "user_id", "left_semi")


def ranked_by_model(model, rows: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    scored = model.transform(rows.fillna(0, list(features))).withColumn("score", vector_to_array("probability")[1])
    return best(scored, ["user_id"], [F.col("score").desc(), F.col("item_id")], k).select(*KEY, "score", "rank")


def summed(start: Column, weights: Mapping[str, float]) -> Column:
    """start and the weighted columns, one after the other."""
    return reduce(lambda s, name: s + F.col(name).cast("double") * F.lit(float(weights[name])), weights, start)


def ranked_by_parts(weights: Mapping[str, float], pools: DataFrame, of_users: DataFrame, of_items: DataFrame, k: int) -> DataFrame:
    """ranked_by_model() of a linear scorer for pools (user_id, items), with the parts of features.split_features().

    A pair carries the sum so far instead of its features: it takes along its user's
    part, meets its item, and then its user's preferences, which make the rest.
    """
    part = lambda names: {n: weights[n] for n in names}
    user_names, item_names, pair_names = ([n for n in weights if n in names] for names in (pair_parts.OF_USER, of_items.columns, pair_parts.OF_PAIR))
    assert [*user_names, *item_names, *pair_names] == list(weights), "weights stand in the order of the parts"
    user_sum = of_users.select("user_id", summed(F.lit(0.0), part(user_names)).alias("_sum"))
    pairs = pools.join(user_sum, "user_id", "left").select("user_id", F.coalesce("_sum", F.lit(0.0)).alias("_sum"), F.explode("items").alias("item_id"))
    known = of_items.withColumns({n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in item_names})
    met = pairs.join(known, "item_id", "left").fillna(0.0, item_names)
    met = met.select(*KEY, summed(F.col("_sum"), part(item_names)).alias("_sum"), *pair_parts.PAIR_NEEDS)
    rows = pair_parts.pair_features(met.join(of_users.drop(*user_names), "user_id", "left"))
    # as the logistic model has it
    score = 1.0 - 1.0 / (1.0 + F.exp(summed(F.col("_sum"), part(pair_names))))
    return best(rows.select(*KEY, score.alias("score")), ["user_id"], [F.col("score").desc(), F.col("item_id")], k).select(*KEY, "score", "rank")


#: Measures of a list: weights of same category, city and district; of pairs and entropy; of agents and categories; decay of age a day.
SAME, SPREAD, BALANCE, AGEING, SMOOTH = (0.4, 0.3, 0.3), (0.6, 0.4), (0.6, 0.4), 0.05, 1e-10


@dataclass
class Pools:
    """Candidates of many users as matrices of users by places; empty places at the end."""

    held: np.ndarray
    accuracy: np.ndarray
    novelty: np.ndarray
    #: For every two places whether they agree, for category, city and district within a city.
    alike: list[np.ndarray]
    agent: np.ndarray
    #: The place of the category among those with an expected share, or -1.
    expected: np.ndarray
    fresh: np.ndarray


def scaled(x: np.ndarray, held: np.ndarray) -> np.ndarray:
    low, high = (f(np.where(held, x, w), axis=1, keepdims=True) for f, w in ((np.min, np.inf), (np.max, -np.inf)))
    return np.where(held, (x - low) / np.where(high > low, high - low, 1.0), 0.0)


def best_lists(p: Pools, k: int, weights: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """(places, values), users by k, of lists that grow by the item with the best value of the longer list; place -1 where a user has no more.

    What an item adds follows from running sums: how many of the list agree
    with each candidate, how often each category occurs, agents, and freshness.
    """
    users, n_places = p.held.shape
    row = np.arange(users)
    share = np.array(list(CATEGORY_SHARES.values()))
    agreeing = [np.zeros((users, n_places)) for _ in p.alike]
    pairs_alike, weighted, kinds, agents, fresh = (np.zeros(users) for _ in range(5))
    counts = np.zeros((users, len(share)))
    free = p.held.copy()
    places, values = np.full((users, k), -1), np.zeros((users, k))
    count_log = lambda c: c * np.log2(np.maximum(c, 1))
    term = lambda part, x: part * np.log((part + SMOOTH) / (x + SMOOTH))
    for step in range(min(k, n_places)):
        n = step + 1
        more_alike = sum(w * a for w, a in zip(SAME, agreeing))
        more_weighted = count_log(agreeing[0] + 1) - count_log(agreeing[0])
        more_kinds = agreeing[0] == 0
        if n > 1:
            apart = 1.0 - (pairs_alike[:, None] + more_alike) / (n * (n - 1) / 2)
            entropy = np.log2(n) - (weighted[:, None] + more_weighted) / n
            of_kinds = kinds[:, None] + more_kinds
            diversity = SPREAD[0] * apart + SPREAD[1] * np.where(of_kinds > 1, entropy / np.log2(np.maximum(of_kinds, 2)), entropy)
        else:
            diversity = np.ones((users, n_places))
        now = term(counts / n, share)
        at = np.maximum(p.expected, 0)
        own = np.take_along_axis(counts, at, 1)
        moved = term((own + 1) / n, share[at]) - np.take_along_axis(now, at, 1)
        divergence = now.sum(axis=1, keepdims=True) + np.where(p.expected >= 0, moved, 0.0)
        fairness = BALANCE[0] * (1.0 - np.abs((agents[:, None] + p.agent) / n - AGENT_SHARE)) + BALANCE[1] * np.exp(-divergence)
        value = sum(w * x for w, x in zip(weights, (p.accuracy, diversity, fairness, (fresh[:, None] + p.fresh) / n, p.novelty)))
        pick = np.argmax(np.where(free, value, -np.inf), axis=1)
        going = free.any(axis=1)
        places[going, step], values[going, step] = pick[going], value[row, pick][going]
        pairs_alike += more_alike[row, pick]
        weighted += more_weighted[row, pick]
        kinds += more_kinds[row, pick]
        agents += p.agent[row, pick]
        fresh += p.fresh[row, pick]
        e = p.expected[row, pick]
        counts[row[e >= 0], e[e >= 0]] += 1
        for a, same in zip(agreeing, p.alike):
            a += same[row, pick]
        free[row, pick] = False
    return places, values


def rerank(candidates: DataFrame, k: int = 10, weights: tuple[float, float, float, float, float] = (0.55, 0.15, 0.15, 0.05, 0.10), pool: int = 30) -> DataFrame:
    """(user_id, item_id, pos, score) by greedy choice of the item that makes the list best.

    candidates: user_id, item_id, score, category, city_name, district_name,
    seller_type, listing_age_days, item_total_contacts. The weights are for
    accuracy, diversity, fairness, freshness and novelty. Only the pool best
    rows of a user reach Python, many users at a time; the first of equals wins.
    A null label is a label of its own.
    """
    labels = ["category", "city_name", "district_name"]
    rows = candidates.select(*KEY, F.col("score").cast("double").alias("score"), *labels, "seller_type", "listing_age_days", "item_total_contacts").fillna(30, ["listing_age_days"]).fillna(0, ["item_total_contacts"])
    limited = best(rows, ["user_id"], [F.col("score").desc(), F.col("item_id")], pool, "r")
    codes = [F.xxhash64(*labels[:1]).alias("c0"), F.xxhash64(labels[1]).alias("c1"), F.xxhash64(*labels[1:]).alias("c2")]
    known = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(CATEGORY_SHARES) for x in (c, i)]), F.col("category").cast("int")), F.lit(-1))
    numbers = [F.col("score"), *codes, (F.col("seller_type") == "agent").cast("double").alias("agent"), known.cast("int").alias("expected"), F.col("listing_age_days").cast("double").alias("age"), F.col("item_total_contacts").cast("double").alias("contacts")]
    lists = limited.select("user_id", F.struct("r", "item_id", *numbers).alias("x")).groupBy("user_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = batch["xs"]
            size = np.diff(xs.offsets.to_numpy())
            if not len(size):
                continue
            flat, row = xs.flatten(), np.repeat(np.arange(len(size)), size)
            col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)

            def matrix(name: str, kind: type, empty: float = 0) -> np.ndarray:
                out = np.full((len(size), int(size.max())), empty, kind)
                out[row, col] = flat.field(name).fill_null(0).to_numpy(zero_copy_only=False)
                return out

            held = np.zeros((len(size), int(size.max())), bool)
            held[row, col] = True
            alike = [(c[:, :, None] == c[:, None, :]) for c in (matrix(f"c{i}", np.int64) for i in range(3))]
            novelty = scaled(-np.log1p(matrix("contacts", float)), held)
            p = Pools(held, scaled(matrix("score", float), held), novelty, alike, matrix("agent", float), matrix("expected", np.int64, -1), np.exp(-AGEING * matrix("age", float)))
            places, values = best_lists(p, k, weights)
            u, step = np.nonzero(places >= 0)
            start = np.cumsum(size) - size
            yield pa.RecordBatch.from_arrays([batch["user_id"].take(pa.array(u)), flat.field("item_id").take(pa.array(start[u] + places[u, step])), pa.array((step + 1).astype(np.int32)), pa.array(values[u, step])], ["user_id", "item_id", "pos", "score"])

    return lists.mapInArrow(choose, "user_id string, item_id string, pos int, score double")

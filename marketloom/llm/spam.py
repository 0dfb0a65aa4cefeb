"""Keyword-stuffed pages, link lists and tag lists.

Neighbouring words of sentences belong together elsewhere in the corpus too.
For every pair of neighbouring words the pointwise mutual information is taken
from corpus counts. A text's windows of words are judged by the mean of it,
where pairs that no other text holds in plain sentences, and words and pairs
that the text repeats far more often than the corpus does, count 0. Windows of
a small mean are no sentences. A text is stuffed when they hold more than half
of its words and enough of its words are repeated excessively; if they are not,
it is word salad, which stays apart.

All words of a text are scored. A sentence that a text repeats is exempt when
it is coherent by the same mean and does not consist of words that the text
repeats in other sentences too; a keyword line that it repeats is not.

Corpus counts are numbers of texts that hold a pair, so repeats inside a text
add nothing, and near copies of a text count as one. Each text is read once,
into blocks of hashed words; a block sends one row for each of its different
pairs, however often they occur, so a frequent pair is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.text import char_kinds, kinds, powers, word_codes
from marketloom.session import cut_lineage


@dataclass(frozen=True)
class Limits:
    """What decides; every value holds at any corpus size."""

    #: Words in a window.
    window: int = 24
    #: Windows of a smaller mean association, in nats, are no sentences; one pair counts no more than cap.
    least: float = 1.4
    cap: float = 3.0
    #: Times the corpus rate at which a repeated pair or word is excessive, and how often a text must have it.
    excess: float = 8.0
    repeats: int = 3
    #: In a window with a smaller share of pairs that make up so much of the text, pairs are evidence for other texts.
    plain: float = 0.25
    dense: float = 1 / 64
    #: Words a sentence must have to be looked at as a whole when it is repeated, and the share of excessive words it may have.
    sentence_words: int = 8
    loud: float = 0.25
    #: Share of words in windows that are no sentences, and of excessive words, beyond which a text is stuffed.
    most: float = 0.5
    excessive: float = 0.2


LIMITS = Limits()
#: Near copies: words in a shingle, minima of a signature, the first of them by which copies meet, and how many must agree.
SHINGLE, MINIMA, MEET, AGREE = 8, 32, 8, 16
#: A block ends with the text that fills it.
BLOCK_WORDS = 1 << 19
#: Bits for the place of a text in its block, and of a block in its partition.
TEXT_BITS, BLOCK_BITS = 21, 16


def ranks(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each place the number of its (group, value), both small numbers from 0, counted from 0."""
    return np.unique(group * (int(value.max(initial=0)) + 1) + value, return_inverse=True)[1]


def runs_of(*keys: np.ndarray) -> np.ndarray:
    """For each place the number of the run of equal keys that it stands in."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def tally(of: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """For each place how often its number occurs, or the sum of weights there."""
    return np.bincount(of, weights=weight)[of] if len(of) else np.zeros(0)


def signatures(words: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """MINIMA minima of hashed runs of SHINGLE words, or of the whole shorter text, for each of n texts of at least one word."""
    rng = np.random.default_rng(42)
    times, plus = (rng.integers(1, 1 << 63, MINIMA, np.uint64) | np.uint64(1) for _ in range(2))
    begins = np.searchsorted(text, np.arange(n))
    runs = np.zeros(len(words), np.uint64)
    for i, p in enumerate(powers(0x9E3779B97F4A7C15, SHINGLE + 1)[1:]):
        inside = text[i:] == text[: len(text) - i]
        runs[: len(words) - i] += np.where(inside, words[i:].astype(np.uint64) * p, np.uint64(0))
    runs ^= runs >> np.uint64(29)
    whole = np.zeros(len(words), bool)
    whole[: len(words) - SHINGLE + 1] = text[SHINGLE - 1 :] == text[: len(text) - SHINGLE + 1]
    whole[begins] = True
    runs, begins = runs[whole], np.searchsorted(text[whole], np.arange(n))
    return np.stack([np.minimum.reduceat((runs * t + p) >> np.uint64(32), begins) for t, p in zip(times, plus)], axis=1).astype(np.uint32)


def read_blocks(documents: DataFrame, doc: str, text: str) -> DataFrame:
    """(block, n_texts, docs, words, owners, sentences, sigs) of texts with at least two words; all but the first three are packed numbers."""
    rows = documents.filter(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    binary = ["words", "owners", "sentences", "sigs"]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("n_texts", T.IntegerType()), T.StructField("docs", T.ArrayType(rows.schema["doc"].dataType)), *[T.StructField(c, T.BinaryType()) for c in binary]])
    packed = char_kinds()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, number = kinds(packed), 0

        def block(held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            nonlocal number
            docs = pa.concat_arrays([h[0] for h in held])
            shift = np.cumsum([0, *[len(h[0]) for h in held]])
            words, owners = np.concatenate([h[1] for h in held]), np.concatenate([h[2] + s for h, s in zip(held, shift)])
            first = np.concatenate([h[3] for h in held])
            at = TaskContext.get().partitionId() << BLOCK_BITS | number
            number += 1
            sigs = signatures(words, owners, len(docs))
            cols = [pa.array([at]), pa.array([len(docs)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)]
            cols += [pa.array([x.tobytes()], pa.binary()) for x in (words, owners.astype(np.int32), np.packbits(first), sigs)]
            return pa.RecordBatch.from_arrays(cols, ["block", "n_texts", "docs", *binary])

        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words, owners, sentences = word_codes(part["text"].to_pylist(), kind)
                n = np.bincount(owners, minlength=part.num_rows)
                keep = (n > 1)[owners]
                words, owners, sentences = words[keep], owners[keep], sentences[keep]
                if not len(words):
                    continue
                first = (np.diff(sentences, prepend=-1) != 0) | (np.diff(owners, prepend=-1) != 0)
                held.append((part["doc"].filter(pa.array(n > 1)), words, (np.cumsum(n > 1) - 1)[owners], first))
                size += len(words)
                if size >= BLOCK_WORDS:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    return rows.mapInArrow(read, schema)


def near_copies(blocks: DataFrame) -> DataFrame:
    """(block, members: array of (at, cls)): the texts that have near copies and the class they share with them.

    Texts meet by equal minima and join the greatest group with whose first
    text they share at least AGREE minima. A class is named by that first text.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sigs in zip(batch["block"].to_pylist(), batch["sigs"]):
                s = np.frombuffer(sigs.as_py(), np.uint32).reshape(-1, MINIMA).view(np.int32)
                tid = (block << TEXT_BITS) + np.arange(len(s))
                for at in range(0, len(s), 10_000):
                    part = s[at : at + 10_000]
                    offsets = pa.array(np.arange(len(part) + 1) * MINIMA, pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(tid[at : at + 10_000]), pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))], ["tid", "sig"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sigs in zip(batch["block"].to_pylist(), batch["sigs"]):
                s = np.frombuffer(sigs.as_py(), np.uint32).reshape(-1, MINIMA)[:, :MEET].astype(np.int64)
                tid = np.repeat((block << TEXT_BITS) + np.arange(len(s)), MEET)
                at = (s | np.arange(MEET) << 32).ravel()
                for i in range(0, len(at), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(tid[i : i + 100_000]), pa.array(at[i : i + 100_000])], ["tid", "at"])

    packed = blocks.select("block", "sigs")
    sigs = packed.mapInArrow(spread, "tid bigint, sig array<int>")
    met = packed.mapInArrow(meet, "tid bigint, at bigint")
    groups = met.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("tid").alias("head")).filter("n > 1")
    asked = met.join(groups, "at").filter("tid != head").groupBy("tid", "head").agg(F.max("n").alias("n"))
    alike = F.aggregate(F.zip_with("sig", "head_sig", lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda a, b: a + b)
    both = asked.join(sigs, "tid").join(sigs.select(F.col("tid").alias("head"), F.col("sig").alias("head_sig")), "head")
    best = both.filter(alike >= AGREE).groupBy("tid").agg(F.max(F.struct("n", (-F.col("head")).alias("head"))).alias("best")).select("tid", (-F.col("best.head")).alias("cls"))
    every = best.unionByName(best.select(F.col("cls").alias("tid"), "cls"))
    # a first text that joined another group has that group's class
    one = every.groupBy("tid").agg(F.coalesce(F.min(F.when(F.col("cls") != F.col("tid"), F.col("cls"))), F.first("tid")).alias("cls"))
    return one.groupBy(F.shiftright("tid", TEXT_BITS).alias("block")).agg(F.collect_list(F.struct(F.col("tid").bitwiseAND((1 << TEXT_BITS) - 1).cast("int").alias("at"), "cls")).alias("members"))


@dataclass
class Pairs:
    """The pairs of neighbouring words of a block, in order; each array has a value for every pair."""

    text: np.ndarray
    number: np.ndarray
    #: The number of the text and pair, and of the text and window.
    cell: np.ndarray
    window: np.ndarray
    #: The number of the repeated sentence that the pair begins in, or -1, and whether that sentence stood there before.
    line: np.ndarray
    again: np.ndarray


def read_pairs(words: bytes, owners: bytes, sentences: bytes, limits: Limits) -> tuple[Pairs, np.ndarray]:
    """Also the different pairs, by their number."""
    w, text = np.frombuffer(words, np.uint32), np.frombuffer(owners, np.int32).astype(np.int64)
    begin = np.unpackbits(np.frombuffer(sentences, np.uint8), count=len(w)).view(bool)
    starts = np.flatnonzero(begin)
    size = np.diff(np.append(starts, len(w)))
    place = np.arange(len(w)) - np.repeat(starts, size)
    key = np.add.reduceat((w.astype(np.uint64) + np.uint64(1)) * powers(0x9E3779B97F4A7C15, int(size.max()))[place], starts)
    same = ranks(text[starts], np.unique(key, return_inverse=True)[1])
    first = np.full(int(same.max()) + 1, len(starts))
    np.minimum.at(first, same, np.arange(len(starts)))
    repeated = (tally(same) > 1) & (size >= limits.sentence_words)
    line, again = np.where(repeated, first[same], -1), repeated & (first[same] != np.arange(len(starts)))
    inside = text[1:] == text[:-1]
    sentence = np.repeat(np.arange(len(starts)), size)[:-1][inside]
    text = text[:-1][inside]
    different, number = np.unique(w[:-1][inside].astype(np.uint64) << np.uint64(32) | w[1:][inside], return_inverse=True)
    begins = np.searchsorted(text, np.arange(text[-1] + 1))
    window = runs_of(text, (np.arange(len(text)) - begins[text]) // limits.window)
    pairs = Pairs(text, number, ranks(text, number), window, line[sentence], again[sentence])
    return pairs, different


def in_plain_window(p: Pairs, limits: Limits) -> np.ndarray:
    """Where a pair stands in a window with few pairs that the text repeats much."""
    n = tally(p.cell)
    much = (n >= limits.repeats) & (n >= limits.dense * tally(p.text))
    return tally(p.window, much) < limits.plain * tally(p.window)


def held_plainly(p: Pairs, limits: Limits) -> np.ndarray:
    """Whether the text holds the pair in some such window."""
    return tally(p.cell, in_plain_window(p, limits)) > 0


def pair_cells(blocks: DataFrame, limits: Limits) -> DataFrame:
    """(block, pair, cls, n, plain, asks): the pairs of a block with the numbers of texts that hold them, and hold them plainly; those of near copies by class. One row of each pair asks for its counts."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p, different = read_pairs(row["words"], row["owners"], row["sentences"], limits)
                plain = held_plainly(p, limits)
                cls = np.full(row["n_texts"], -1, np.int64)
                for m in row["members"] or ():
                    cls[m["at"]] = m["cls"]
                once = np.empty(int(p.cell.max()) + 1, np.int64)
                once[p.cell] = np.arange(len(p.cell))
                number, plain, c = p.number[once], plain[once], cls[p.text[once]]
                single = c < 0
                n = np.bincount(number[single], minlength=len(different))
                n_plain = np.bincount(number[single & plain], minlength=len(different))
                alone = np.flatnonzero(n)
                number, plain, c = number[~single], plain[~single], c[~single]
                of = ranks(np.unique(c, return_inverse=True)[1], number)
                shared = np.unique(of, return_index=True)[1]
                loud = (np.bincount(of, weights=plain) > 0)[of][shared] if len(of) else plain
                number, c = number[shared], c[shared]
                asks = np.zeros(len(number), bool)
                asks[np.unique(number, return_index=True)[1]] = True
                asks &= n[number] == 0
                out = [
                    np.full(len(alone) + len(number), row["block"]),
                    np.concatenate([different[alone], different[number]]).view(np.int64),
                    np.concatenate([np.full(len(alone), -1), c]),
                    np.concatenate([n[alone], np.ones(len(number), np.int64)]),
                    np.concatenate([n_plain[alone], loud.astype(np.int64)]),
                ]
                arrays = [pa.array(x, pa.int64()) for x in out] + [pa.array(np.concatenate([np.ones(len(alone), bool), asks]))]
                whole = pa.RecordBatch.from_arrays(arrays, ["block", "pair", "cls", "n", "plain", "asks"])
                for at in range(0, whole.num_rows, 100_000):
                    yield whole.slice(at, 100_000)

    return blocks.join(near_copies(blocks), "block", "left").drop("docs", "sigs").mapInArrow(cells, "block bigint, pair bigint, cls bigint, n bigint, plain bigint, asks boolean")


def pair_counts(cells: DataFrame) -> DataFrame:
    """(pair, n, plain, chance, rate): texts that hold a pair, and hold it plainly; how many would by chance; the rate of its first word."""
    by_class = cells.select("pair", "cls", "n", "plain").repartition("pair").groupBy("pair", "cls").agg(F.sum("n").alias("n"), F.sum("plain").alias("plain"))
    one = F.col("cls") >= 0
    held = by_class.groupBy("pair").agg(F.sum(F.when(one, 1).otherwise(F.col("n"))).alias("n"), F.sum(F.when(one, F.least("plain", F.lit(1))).otherwise(F.col("plain"))).alias("plain"))
    held = cut_lineage(held).withColumns({"a": F.shiftrightunsigned("pair", 32), "b": F.col("pair").bitwiseAND(0xFFFFFFFF)})
    first, second = (held.groupBy(c).agg(F.sum("n").cast("double").alias(f"n_{c}")) for c in ("a", "b"))
    every = held.agg(F.sum("n")).scalar().cast("double")
    return held.join(first, "a").join(second, "b").select("pair", "n", "plain", (F.col("n_a") * F.col("n_b") / every).alias("chance"), (F.col("n_a") / every).alias("rate"), (F.col("n") / every).alias("pair_rate"))


def score_block(p: Pairs, different: np.ndarray, n_texts: int, n: np.ndarray, plain: np.ndarray, chance: np.ndarray, rate: np.ndarray, pair_rate: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    """The scores of each text of a block; the corpus figures are given for each pair."""
    words = np.bincount(p.text, minlength=n_texts)
    share = lambda x: np.bincount(p.text, weights=x, minlength=n_texts) / words
    first = np.unique(different >> np.uint64(32), return_inverse=True)[1]
    of_word = ranks(p.text, first[p.number])
    n_word = tally(of_word)
    stuffed_word = (n_word >= limits.repeats) & (n_word / words[p.text] >= limits.excess * rate)
    n_pair = tally(p.cell)
    stuffed_pair = (n_pair >= limits.repeats) & (n_pair / words[p.text] >= limits.excess * pair_rate)
    elsewhere = plain - held_plainly(p, limits)
    known = np.where(elsewhere > 0, np.clip(np.log(np.maximum(elsewhere, 1) / chance), 0, limits.cap), 0)
    # a repeated sentence: coherent, and not made of words that are excessive with each sentence read once
    once = tally(of_word, ~p.again)
    loud = (once >= limits.repeats) & (once / np.bincount(p.text, weights=~p.again, minlength=n_texts)[p.text] >= limits.excess * rate)
    line = p.line + 1
    sound = (p.line >= 0) & (tally(line, known) >= limits.least * tally(line)) & (tally(line, loud) < limits.loud * tally(line))

    def flagged(worth: np.ndarray) -> np.ndarray:
        return share(tally(p.window, worth) < limits.least * tally(p.window))

    worth = np.where(stuffed_word | stuffed_pair, 0, known)
    left = np.where(sound, limits.cap, worth)
    return {
        "n_words": words,
        "mean_pmi": share(np.log(n / chance)),
        "association": share(left),
        "excessive": share(stuffed_word),
        "flagged": flagged(worth),
        "excessive_left": share(stuffed_word & ~sound),
        "flagged_left": flagged(left),
    }


def text_scores(documents: DataFrame, doc: str, text: str, limits: Limits = LIMITS) -> DataFrame:
    """(doc, n_words, mean_pmi, association, excessive, flagged, excessive_left, flagged_left) of documents with at least two words.

    n_words counts pairs of neighbouring words; mean_pmi is the mean mutual
    information over all of them; association is the mean that windows are
    judged by; excessive is the share of pairs whose first word is excessive,
    flagged the share in windows that are no sentences. The two with _left leave
    out repeated sentences that are sound. A text's own class is no evidence
    for its pairs. Null ids, null texts and texts of fewer than two words give
    no row; exact repeats of rows give one, other rows of one id one each; very
    long texts are scored whole; an empty table gives none. Other columns are
    never read.
    """
    blocks = cut_lineage(read_blocks(documents, doc, text))
    cells = cut_lineage(pair_cells(blocks, limits))
    asked = cells.filter("asks").select("block", "pair").join(pair_counts(cells), "pair")
    told = asked.groupBy("block").agg(F.collect_list(F.struct("pair", "n", "plain", "chance", "rate", "pair_rate")).alias("told"))
    of_doc = blocks.schema["docs"].dataType.elementType
    names = ["n_words", "mean_pmi", "association", "excessive", "flagged", "excessive_left", "flagged_left"]
    schema = T.StructType([T.StructField(doc, of_doc), T.StructField("n_words", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in names[1:]]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in ("n_texts", "words", "owners", "sentences")}
                p, different = read_pairs(row["words"], row["owners"], row["sentences"], limits)
                known = batch["told"][i].values
                told_of = known.field("pair").to_numpy().view(np.uint64)
                order = np.argsort(told_of)
                if not np.array_equal(told_of[order], different):
                    raise ValueError("a block was told other pairs than it asked for")
                figures = [known.field(c).to_numpy()[order][p.number] for c in ("n", "plain", "chance", "rate", "pair_rate")]
                scores = score_block(p, different, row["n_texts"], *figures, limits)
                yield pa.RecordBatch.from_arrays([batch["docs"][i].values, *[pa.array(scores[c]) for c in names]], [doc, *names])

    return blocks.drop("sigs").join(told, "block").mapInArrow(score, schema).distinct()


def is_stuffed(limits: Limits = LIMITS) -> Column:
    return (F.col("flagged_left") > limits.most) & (F.col("excessive_left") >= limits.excessive)


def is_salad(limits: Limits = LIMITS) -> Column:
    """Incoherent for the most part without repeating anything."""
    return (F.col("flagged_left") > limits.most) & (F.col("excessive_left") < limits.excessive)

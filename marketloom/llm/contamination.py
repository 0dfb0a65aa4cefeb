"""Held-out passages inside training documents.

The words of the held-out items are numbered, and an Aho-Corasick automaton
holds each item cut into seeds: a run of words that two texts share holds at
least one whole seed, if a seed is half as long. So the automaton has a few
nodes for each word of an item, whatever the length of the runs. Documents are
folded, turned into word numbers and scanned once. From a seed that is found,
the run is extended to both sides, compared with the words themselves, and
mapped back to the original characters.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.text import char_kinds, kinds, plain_with_offsets, word_codes, words

#: Words of held-out items in one automaton, about 200 MB. More items fill several, which each batch of documents passes in turn.
AUTOMATON_WORDS = 2_000_000
#: Letters that stand for the digits of a word's number: the first digit has letters of its own, so that a match begins at a word.
DIGITS, OTHER = 64, 255


@dataclass
class Shard:
    """Items with the automaton of their seeds; a seed's value lists (item number, place)."""

    ids: list[int]
    items: list[list[str]]
    #: Items as codes, for the extension.
    coded: list[list[int]]
    #: The words as sorted codes, and the letters of each; the last row stands for words of no item.
    codes: np.ndarray
    letters: np.ndarray
    machine: ahocorasick.Automaton


def build_shard(items: Sequence[tuple[int, list[str]]], run: int, kind: np.ndarray) -> Shard:
    coded = [word_codes([" ".join(w)], kind)[0] for _, w in items]
    codes = np.unique(np.concatenate(coded))
    width, reach = 1, DIGITS
    while reach < len(codes):
        width, reach = width + 1, reach * DIGITS
    number = np.arange(len(codes))
    digits = [number // DIGITS**k % DIGITS for k in reversed(range(width))]
    letters = np.full((len(codes) + 1, width), OTHER, np.uint8)
    letters[:-1] = np.stack([digits[0] + DIGITS, *digits[1:]], axis=1)
    seeds: dict[str, list[tuple[int, int]]] = {}
    for i, c in enumerate(coded):
        size = (min(run, len(c)) + 1) // 2
        line = letters[np.searchsorted(codes, c)].tobytes().decode("latin-1")
        for at in range(0, len(c) - size + 1, size):
            seeds.setdefault(line[at * width : (at + size) * width], []).append((i, at))
    machine = ahocorasick.Automaton()
    for seed, places in seeds.items():
        machine.add_word(seed, (len(seed) // width, tuple(places)))
    machine.make_automaton()
    return Shard([i for i, _ in items], [w for _, w in items], [c.tolist() for c in coded], codes, letters, machine)


def shards(items: DataFrame, item: str, text: str, run: int, shortest: int) -> Iterator[Shard]:
    """Items come to the driver one after another; a shard is built as soon as it is full."""
    known = items.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("bigint").alias("item"), F.col(text).alias("text")).distinct()
    kind, held, size = kinds(char_kinds()), [], 0
    for row in known.toLocalIterator():
        w = words(row["text"])
        if len(w) < min(run, shortest):
            continue
        if held and size + len(w) > AUTOMATON_WORDS:
            yield build_shard(held, run, kind)
            held, size = [], 0
        held.append((row["item"], w))
        size += len(w)
    if held:
        yield build_shard(held, run, kind)


def stretches(shard: Shard, codes: np.ndarray, begin: np.ndarray, run: int) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
    """(text, item number) -> [(first word of the text, of the item, length)] of equal runs of codes that are long enough; texts stand one after another from begin."""
    at = np.searchsorted(shard.codes, codes)
    known = np.where(shard.codes[np.minimum(at, len(shard.codes) - 1)] == codes, at, len(shard.codes))
    width = shard.letters.shape[1]
    line = shard.letters[known].tobytes().decode("latin-1")
    begins, ends = begin[:-1].tolist(), begin[1:].tolist()
    read: dict[tuple[int, int, int], int] = {}
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for last, (size, places) in shard.machine.iter(line):
        first = (last + 1) // width - size
        text = bisect_right(begins, first) - 1
        low, high = begins[text], ends[text]
        if first + size > high:
            continue
        for i, place in places:
            # a run is read once, whichever of its seeds comes first
            if read.get((text, i, first - place), -1) > first:
                continue
            other, a, b = shard.coded[i], first, first + size
            shift = place - first
            while a > low and a + shift > 0 and codes[a - 1] == other[a + shift - 1]:
                a -= 1
            while b < high and b + shift < len(other) and codes[b] == other[b + shift]:
                b += 1
            read[text, i, -shift] = b
            if b - a >= min(run, len(other)):
                found.setdefault((text, i), []).append((a - low, a + shift, b - a))
    return found


def exact(text: list[str], item: list[str], runs: list[tuple[int, int, int]], run: int) -> list[tuple[int, int]]:
    """Runs of equal codes, compared word by word: (first word, end) of those that stay long enough; ones that overlap or touch come as one."""
    least, kept = min(run, len(item)), []
    for a, b, n in runs:
        first = 0
        for i in range(n + 1):
            if i == n or text[a + i] != item[b + i]:
                if i - first >= least:
                    kept.append((a + first, a + i))
                first = i + 1
    out: list[tuple[int, int]] = []
    for a, b in sorted(kept):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_leaks(documents: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, run: int = 12, spans: bool = False, shortest: int | None = None) -> DataFrame:
    """(doc, item) of documents that share at least run consecutive words with an item; with spans also (start, end, first_word, n_words).

    start and end are places in the original text, end after the last
    character, first_word counts from 0; stretches that overlap or touch come as
    one. Ids are whole numbers. Items shorter than run words match nothing; with
    shortest, those of at least so many words match where they stand whole.
    Null texts and ids match nothing; repeated documents or items give one row a
    pair (and place); an empty table gives none. Very long texts are scanned
    whole; other columns are never read.
    """
    spark = documents.sparkSession
    of_span = ["start", "end", "first_word", "n_words"]
    names = ["doc", "item", *(of_span if spans else [])]
    texts = documents.filter(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    shared = [spark.sparkContext.broadcast(s) for s in shards(items, item, item_text, run, run if shortest is None else shortest)]
    packed = char_kinds()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = kinds(packed)
        for whole in batches:
            rows: list[tuple[int, ...]] = []
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                codes, owners, _ = word_codes(batch["text"].to_pylist(), kind)
                begin = np.searchsorted(owners, np.arange(batch.num_rows + 1))
                read: dict[int, list[str]] = {}
                for s in shared:
                    shard = s.value
                    for (t, i), runs in stretches(shard, codes, begin, run).items():
                        if t not in read:
                            read[t] = words(batch["text"][t].as_py())
                        kept = exact(read[t], shard.items[i], runs, run)
                        key = (batch["doc"][t].as_py(), shard.ids[i])
                        if kept and not spans:
                            rows.append(key)
                        elif kept:
                            line, back = plain_with_offsets(batch["text"][t].as_py())
                            blank = [k for k, c in enumerate(line) if c == " "]
                            rows += [(*key, back[blank[a] + 1], back[blank[b] - 1] + 1, a, b - a) for a, b in kept]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return texts.mapInArrow(scan, ", ".join(f"{c} bigint" for c in names)).distinct().withColumnsRenamed({"doc": doc, "item": item})

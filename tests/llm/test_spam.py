import math
import random
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import spam
from marketloom.llm.text import char_kinds, fold, kinds, word_codes, words

SCHEMA = "doc_id bigint, text string, doc int, pair int, n int, block int"
SCORES = ("n_words", "mean_pmi", "excessive", "flagged", "excessive_left", "flagged_left")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def by_doc(frame):
    return {r["doc_id"]: tuple(round(r[c], 6) for c in SCORES) for r in frame.collect()}


def sentences_of(text):
    text, out, at = fold(text), [], 0
    marks = [i for i, c in enumerate(text) if c == "\n" or (c.isspace() and i and text[i - 1] in ".!?")]
    for i in [*marks, len(text)]:
        out.append(words(text[at:i]))
        at = i
    return [s for s in out if s]


def brute(rows, copies=(), limits=spam.LIMITS):
    """copies: sets of ids whose texts are near copies; equal texts are anyway."""
    read, cls = {}, {}
    for d, t in rows:
        if d is not None and t is not None and len(words(t)) > 1:
            read[d] = sentences_of(t)
            cls[d] = next((f"c{min(c)}" for c in copies if d in c), t)
    held, calm, own = {}, {}, {}
    for d, s in read.items():
        w = [x for y in s for x in y]
        pairs = list(zip(w, w[1:]))
        n = Counter(pairs)
        mine = set()
        for i in range(0, len(pairs), limits.window):
            win = pairs[i : i + limits.window]
            if sum(n[p] >= limits.repeats and n[p] >= limits.dense * len(pairs) for p in win) < limits.plain * len(win):
                mine |= set(win)
        own[d] = mine
        for p in n:
            held.setdefault(p, set()).add(cls[d])
        for p in mine:
            calm.setdefault(p, set()).add(cls[d])
    first, second = Counter(), Counter()
    for (a, b), c in held.items():
        first[a] += len(c)
        second[b] += len(c)
    total = sum(map(len, held.values()))
    chance = lambda p: first[p[0]] * second[p[1]] / total
    out = {}
    for d, s in read.items():
        w, line, again, seen = [], [], [], {}
        n_lines = Counter(map(tuple, s))
        for i, y in enumerate(s):
            repeated = len(y) >= limits.sentence_words and n_lines[tuple(y)] > 1
            f = seen.setdefault(tuple(y), i) if repeated else -1
            w += y
            line += [f] * len(y)
            again += [repeated and f != i] * len(y)
        pairs = list(zip(w, w[1:]))
        k = len(pairs)
        n, nw, nw_once = Counter(pairs), Counter(w[:-1]), Counter(x for x, g in zip(w[:-1], again) if not g)
        k_once = k - sum(again[:-1])
        known, over, bad, loud = [], [], [], []
        for p in pairs:
            e = len(calm.get(p, ())) - (p in own[d])
            known.append(min(max(math.log(e / chance(p)), 0), limits.cap) if e > 0 else 0)
            over.append(nw[p[0]] >= limits.repeats and nw[p[0]] / k >= limits.excess * first[p[0]] / total)
            bad.append(over[-1] or (n[p] >= limits.repeats and n[p] / k >= limits.excess * len(held[p]) / total))
            loud.append(nw_once[p[0]] >= limits.repeats and nw_once[p[0]] / k_once >= limits.excess * first[p[0]] / total)
        sound = set()
        for f in set(line) - {-1}:
            at = [i for i in range(k) if line[i] == f]
            if sum(known[i] for i in at) >= limits.least * len(at) and sum(loud[i] for i in at) < limits.loud * len(at):
                sound |= set(at)
        worth = [0 if b else x for b, x in zip(bad, known)]
        left = [limits.cap if i in sound else x for i, x in enumerate(worth)]
        share = lambda v: sum(len(v[i : i + limits.window]) for i in range(0, k, limits.window) if sum(v[i : i + limits.window]) < limits.least * len(v[i : i + limits.window])) / k
        pmi = sum(math.log(len(held[p]) / chance(p)) for p in pairs) / k
        figures = (pmi, sum(over) / k, share(worth), sum(o and i not in sound for i, o in enumerate(over)) / k, share(left))
        out[d] = (k, *(round(x, 6) for x in figures))
    return out


def sentences(rng, n):
    who = ["the buyer", "a tenant", "the old landlord", "one broker", "our notary", "this family", "her uncle", "their lawyer", "some visitor", "a second agent"]
    what = ["sold the plot", "kept the keys", "left a stone table", "asked for a lower price", "measured both rooms", "painted each door", "lost those papers", "paid in small notes", "planted three trees", "fixed an open pipe"]
    where = ["near the bridge", "behind the library", "by the canal", "at the market", "under that hill", "past two schools", "along Mill Lane", "above a bakery", "outside his office", "around Fern Square"]
    return " ".join(f"{rng.choice(who)} {rng.choice(what)} {rng.choice(where)} on day {rng.randint(1, 28)}." for _ in range(n))


def corpus():
    rng = random.Random(4)
    rows = [(k, sentences(rng, rng.randint(5, 12))) for k in range(300)]
    stuffed = " ".join(f"cheap house {rng.choice(['Oak', 'Elm', 'Ash'])} buy house," for _ in range(40))
    links = "\n".join(f"https://www.site{rng.randint(1, 999)}.test/cheap-house-{rng.randint(1, 9999)}" for _ in range(30))
    salad = sentences(rng, 9).split()
    rng.shuffle(salad)
    once = sentences(rng, 8)
    rows += [(1000, stuffed), (1001, links), (1002, " ".join(salad)), (1003, sentences(rng, 9) + " https://www.site1.test/a"), (1004, once + "\n" + "\n".join([once] * 5))]
    return rows


def test_word_codes_are_the_words_of_the_plain_reader(monkeypatch):
    rng = random.Random(3)
    texts = ["", " ", "a", "Đất_nền, Đà-Nẵng 647m²!", "a\x00b. C\nd! e", "ß İ ſ", "x" * 300, *("".join(rng.choice("aàÁđ ́_.!?\n\t 9") for _ in range(rng.randint(0, 200))) for _ in range(200))]
    kind = kinds(char_kinds())
    for piece in (1 << 17, 40):
        monkeypatch.setattr("marketloom.llm.text.PIECE", piece)
        codes, owners, sentence = word_codes(texts, kind)
        known, at = {}, 0
        for i, t in enumerate(texts):
            mine = owners == i
            w = words(t)
            assert mine.sum() == len(w) and (np.flatnonzero(mine) == np.arange(at, at + len(w))).all()
            assert all(known.setdefault(x, c) == c for x, c in zip(w, codes[mine].tolist()))
            at += len(w)
            begins = np.flatnonzero(np.diff(sentence[mine], prepend=-1) != 0).tolist()
            assert begins == [sum(map(len, sentences_of(t.replace("\x00", " "))[:k])) for k in range(len(sentences_of(t.replace("\x00", " "))))]
        assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("block", [1, 1000, 1 << 19])
def test_same_as_brute_force_with_nulls_repeats_and_long_texts(spark, monkeypatch, block):
    monkeypatch.setattr(spam, "BLOCK_WORDS", block)
    rows = corpus()
    rows += [(2000, None), (None, rows[0][1]), (2001, ""), (2002, "one"), (2003, rows[1][1]), (2003, rows[1][1]), (2004, "word pair " * 30_000)]
    once = rows[304][1].split("\n")[0]
    frame = spam.text_scores(table(spark, rows), "doc_id", "text")
    got, want = by_doc(frame), brute(rows)
    assert once and got.keys() == want.keys()
    assert {d for d in got if any(abs(a - b) > 2e-6 for a, b in zip(got[d], want[d]))} == set()
    assert got[2003] == got[1] and frame.filter("doc_id = 2003").count() == 1


def test_kinds(spark):
    rows = corpus()
    scores = spam.text_scores(table(spark, rows), "doc_id", "text")
    assert {r["doc_id"] for r in scores.filter(spam.is_stuffed()).collect()} == {1000, 1001}
    assert {r["doc_id"] for r in scores.filter(spam.is_salad()).collect()} == {1002}


def test_copies_in_many_tasks_count_once(spark):
    rows = corpus()
    copies = [(5000 + k, rows[300][1]) for k in range(200)] + [(5500 + k, rows[301][1]) for k in range(200)]
    one = by_doc(spam.text_scores(table(spark, rows), "doc_id", "text"))
    many = by_doc(spam.text_scores(table(spark, rows + copies).repartition(13), "doc_id", "text"))
    assert {d: many[d] for d in one} == one and many[5000] == one[1000] and many[5500] == one[1001]


def test_empty(spark):
    assert spam.text_scores(table(spark, []), "doc_id", "text").collect() == []
    assert spam.text_scores(table(spark, [(1, None), (2, "word")]), "doc_id", "text").collect() == []


def test_repeated_keyword_lines_are_found_and_repeated_sentences_are_not(spark):
    rng = random.Random(9)
    rows = corpus()
    nine, thirteen = "shop floor to let in Rosewater number one deal.", "cheap Rosewater shop rent Rosewater office buy Rosewater flat deal Rosewater plot sale"
    rows += [(3000, f"{nine} " * 60), (3001, "\n".join([thirteen] * 40)), (3002, f"{nine} " * 60 + sentences(rng, 12)), (3003, f"{sentences(rng, 1)} " * 60), (3004, f"{sentences(rng, 3)} " * 30 + "cheap house buy house " * 8)]
    # 450 words of one keyword line; 40 words of keywords after 320 of repeated sentences
    rows += [(3005, f"{nine} " * 50), (3006, " ".join([sentences(rng, 4)] * 8) + " " + "buy cheap Rosewater house " * 10)]
    scores = spam.text_scores(table(spark, rows), "doc_id", "text").cache()
    assert {r["doc_id"] for r in scores.filter(spam.is_stuffed()).collect()} == {1000, 1001, 3000, 3001, 3002, 3005}
    assert {r["doc_id"]: r["n_words"] for r in scores.filter("doc_id >= 3000").collect()} == {d: len(words(t)) - 1 for d, t in rows if d >= 3000}


def test_near_copies_count_as_one_text(spark):
    rows = corpus()
    page, links = rows[300][1], rows[301][1]
    rows += [(6000 + k, f"{page} last{k}") for k in range(250)] + [(6500 + k, f"{links} more{k}") for k in range(250)]
    found = spam.text_scores(table(spark, rows), "doc_id", "text").filter(spam.is_stuffed()).select("doc_id").collect()
    assert {r["doc_id"] for r in found} == {1000, 1001} | {6000 + k for k in range(250)} | {6500 + k for k in range(250)}

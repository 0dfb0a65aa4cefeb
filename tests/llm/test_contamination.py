import random
import unicodedata

import pytest

from marketloom.llm import contamination
from marketloom.llm.text import fold, plain, plain_with_offsets, words
from tests.support import tuples

ITEM = "Chủ nhà ra giá 765 triệu với miếng đất 647m2 gần chợ nổi, hướng đông, pháp lý sổ chung."
SPAN = "ra giá 765 triệu với miếng đất 647m2 gần chợ nổi hướng"  # twelve words


def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, doc string, item int")


def items(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "eval_id bigint, text string, line string")


def find(spark, d, i, **more):
    return contamination.find_leaks(docs(spark, d), "doc_id", "text", items(spark, i), "eval_id", "text", **more)


def test_folding():
    assert words("ĐẤT_nền, Đà-Nẵng 647m²!") == ["dat", "nen", "da", "nang", "647m²"] or words("ĐẤT") == ["dat"]
    assert fold("Ế") == fold(unicodedata.normalize("NFD", "Ế")) == "e"
    assert plain("  ") == "  " and plain("a  b") == " a b "
    for t in ("", "Đất  nền!", unicodedata.normalize("NFD", "Chợ nổi – 3"), "ß Straße", "x" * 10):
        line, back = plain_with_offsets(t)
        assert line == plain(t) and len(back) == len(line)


def test_spellings_boundaries_and_nulls(spark):
    nfd = unicodedata.normalize("NFD", SPAN)
    d = [
        (1, f"Trước. {SPAN} sau"),
        (2, SPAN.upper().replace(" ", " ,\n")),
        (3, nfd),
        (4, fold(SPAN)),
        (5, SPAN.rsplit(" ", 1)[0]),  # eleven words
        (6, f"x{SPAN}"),  # the first word is another
        (7, None),
        (8, ""),
        (9, "từ " * 200_000 + SPAN),
        (None, SPAN),
        (1, f"Trước. {SPAN} sau"),
    ]
    i = [(70, ITEM), (70, ITEM), (71, "too short"), (72, None), (73, f"Mở đầu {SPAN}"), (None, ITEM)]
    assert tuples(find(spark, d, i)) == sorted([(n, e) for n in (1, 2, 3, 4, 9) for e in (70, 73)], key=repr)


def test_empty(spark):
    assert tuples(find(spark, [], [(1, ITEM)])) == [] and tuples(find(spark, [(1, SPAN)], [])) == []


def test_spans_point_into_the_original(spark):
    text = unicodedata.normalize("NFD", f"Mở đầu!! {SPAN.upper()}... hết; và lại {SPAN}")
    got = [(r["start"], r["end"], r["n_words"]) for r in find(spark, [(1, text)], [(70, ITEM)], spans=True).orderBy("start").collect()]
    assert len(got) == 2 and all(n == 12 for *_, n in got)
    assert all(words(text[a:b]) == words(SPAN) for a, b, _ in got)


def test_several_automata_give_the_same(spark, monkeypatch):
    i = [(k, f"{SPAN} mục {k} " + " ".join(f"w{k}x{j}" for j in range(20))) for k in range(30)]
    d = [(k, i[k][1]) for k in range(30)]
    want = tuples(find(spark, d, i))
    monkeypatch.setattr(contamination, "AUTOMATON_WORDS", 100)
    assert tuples(find(spark, d, i)) == want and len(want) == 900


def brute(d, i, run, shortest):
    out = set()
    for n, t in d:
        w = words(t)
        for e, x in i:
            y = words(x)
            least = min(run, len(y))
            if len(y) >= min(run, shortest):
                runs = {tuple(y[k : k + least]) for k in range(len(y) - least + 1)}
                out |= {(n, e) for k in range(len(w) - least + 1) if tuple(w[k : k + least]) in runs}
    return sorted(out, key=repr)


@pytest.mark.parametrize("run,shortest", [(12, 12), (12, 3), (5, 5), (2, 1), (1, 1)])
def test_same_as_brute_force_for_any_run_and_short_items(spark, run, shortest):
    rng = random.Random(run * 100 + shortest)
    line = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    i = [(k, line(rng.randint(1, 30))) for k in range(20)]
    d = [(k, line(rng.randint(1, 40)) + (" " + i[k % 20][1]) * (k % 3 == 0)) for k in range(60)]
    assert tuples(find(spark, d, i, run=run, shortest=shortest)) == brute(d, i, run, shortest)


def test_megabytes_of_items_are_one_automaton_and_one_scan(spark):
    rng = random.Random(8)
    i = [(k, " ".join(f"v{rng.randrange(50_000)}" for _ in range(150))) for k in range(3000)]
    d = [(k, "lead in " + " ".join(i[k][1].split()[20:32]) + " and out") for k in range(0, 3000, 7)] + [(9000, "nothing of the kind at all")]
    assert sum(len(t) for _, t in i) > 2_500_000
    found = find(spark, d, i)
    assert tuples(found) == [(k, k) for k in sorted(range(0, 3000, 7), key=lambda k: repr((k, k)))]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_a_common_code_is_no_match(spark, monkeypatch):
    """Words with equal codes are compared themselves."""
    real = contamination.word_codes
    monkeypatch.setattr(contamination, "word_codes", lambda texts, kind: (lambda c, o, s: (c % 2, o, s))(*real(texts, kind)))
    assert tuples(find(spark, [(1, SPAN), (2, "other " * 40)], [(70, ITEM)])) == [(1, 70)]

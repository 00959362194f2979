"""Number words, phrases of a vocabulary and spans, against plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from voxloom.functions import numbers, tags
from voxloom.operators import vocabulary


def test_numbers_are_spelled_and_read_back(spark):
    rng = random.Random(1)
    some = [*range(0, 2100), *(10**k + d for k in range(3, 13) for d in (-1, 0, 1)), *(rng.randrange(10 ** rng.randint(3, 15)) for _ in range(500)), 10**15 - 1]
    rows = spark.createDataFrame([(n,) for n in some] + [(None,), (-1,), (10**15,)], "n long").select("n", numbers.spell(F.col("n")).alias("s"), numbers.spell_ordinal(F.col("n")).alias("o")).collect()
    for r in rows:
        if r["n"] is None or not 0 <= r["n"] < 10**15:
            assert r["s"] is None and r["o"] is None
            continue
        found = {end: n for end, n, ordinal in numbers.cardinals(r["s"].split(" "), 0) if not ordinal}
        assert found[len(r["s"].split(" "))] == r["n"], r
        if r["n"] > 2:
            assert numbers.normalize("is " + r["s"]) == f"is {r['n']}"
            assert numbers.normalize(f"its {r['o']} time") == f"its {numbers.nth(r['n'])} time"


@pytest.mark.parametrize("said,want", [
    ("one hundred and five dollars and five cents, then", "$105.05, then"), ("Twenty One euros", "€21"), ("three point one four percent", "3.14%"), ("three point five million", "3.5 million"),
    ("october third nineteen ninety eight", "1998-10-03"), ("the third of may two thousand five", "the 2005-05-03"), ("July fourth", "July 4"), ("june first twenty oh five", "2005-06-01"),
    ("second to none, one by one", "second to none, 1 by 1"), ("twenty, one", "20, 1"), ("five six", "5 6"), ("hundred and thousand", "hundred and thousand"), ("two  spaces", "2  spaces"),
    ("ninety per cent of ten kilometers", "90% of 10 km"), ("the twenty first of", "the 21st of"), ("", ""), ("one thousand thousand", "1000 thousand"), ("two million three thousand and four", "2003004"), ("may be march", "may be march"),
])
def test_phrases_are_written_in_digits(said, want):
    assert numbers.normalize(said) == want


def test_the_path_is_the_cheapest_and_covers_every_token():
    rng = random.Random(5)
    words = ["one", "two", "twenty", "hundred", "and", "thousand", "dollars", "cents", "point", "third", "of", "may", "nineteen", "x", "five,"]

    def paths(graph, n):
        if n == len(graph):
            yield 0.0, (), []
            return
        for end, said, weight in graph[n]:
            for cost, first, rest in paths(graph, end):
                yield weight + cost, (-end, *first), [said, *rest]

    for _ in range(300):
        tokens = [rng.choice(words) for _ in range(rng.randint(1, 7))]
        best = min(paths(numbers.edges(tokens), 0), key=lambda p: (round(p[0], 9), p[1]))
        assert numbers.normalize(" ".join(tokens)) == " ".join(best[2]), tokens
    plain = " ".join(rng.choice(["word", "and", "of", "", "hundreds", "a.b"]) for _ in range(5000))
    assert numbers.normalize(plain) == plain


def test_phrases_are_looked_for_only_where_a_cheapest_path_may_go(monkeypatch):
    asked, real = [], numbers.phrases
    monkeypatch.setattr(numbers, "phrases", lambda words, i: asked.append(i) or real(words, i))
    numbers._cheapest.cache_clear()
    said = "it costs one hundred twelve thousand nine hundred forty six dollars and twenty six cents, they say"
    assert numbers.normalize(said) == "it costs $112946.26, they say" and len(asked) == 1
    assert numbers.normalize(said) == "it costs $112946.26, they say" and len(asked) == 1
    assert numbers.normalize("one " * 5000 + "two") == "1 " * 5000 + "2"


def test_one_file_of_orders_is_many_tasks(spark):
    from voxloom import catalog

    assert catalog.queries()["inverse_normalize"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4


def brute(text, phrases, whole):
    found = []
    for start in range(len(text)):
        hits = [(len(p), k) for p, k in phrases.items() if text.startswith(p, start) and not (whole and (start and text[start - 1].isalnum() or text[start + len(p) : start + len(p) + 1].isalnum()))]
        if hits:
            found.append((start, start + max(hits)[0], max(hits)[1]))
    out, free = [], 0
    for a, b, k in found:
        if a >= free:
            out.append((a, b, k))
            free = b
    return out


@pytest.mark.parametrize("part_bytes,whole", [(8 << 20, True), (8 << 20, False), (400, True), (70, False)])
def test_vocabulary_spans_are_all_phrases(spark, part_bytes, whole):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abé漢") for _ in range(rng.randint(1, 3)))
    phrases = {" ".join(word() for _ in range(rng.randint(1, 3))): f"K{i % 4}" for i in range(60)}
    texts = [rng.choice(" .,").join(word() for _ in range(rng.randint(0, 60))) for _ in range(30)] + ["", None, "a a a a", "ab" * 2000]
    known = spark.createDataFrame([*phrases.items(), (None, "K"), ("", "K"), *[(p, "Z") for p in list(phrases)[:5]], *list(phrases.items())[:9]], "phrase string, type string")
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, phrase string").repartition(3)
    got = vocabulary.vocabulary_spans(df, "text", known, whole_words=whole, part_bytes=part_bytes).collect()
    for r in got:
        want = None if r["text"] is None else brute(r["text"], phrases, whole)
        assert (None if r["spans"] is None else [tuple(s) for s in r["spans"]]) == want
    assert sorted(r["id"] for r in got) == list(range(len(texts)))
    none = vocabulary.vocabulary_spans(df, "text", known.limit(0)).collect()
    assert all(r["spans"] == ([] if r["text"] is not None else None) for r in none)


def test_spans_are_put_in_from_the_right(spark):
    def one_by_one(text, spans):
        for a, b, k in sorted(spans, reverse=True):
            text = f"{text[:a]}ENTITY_{k.upper()} {text[a:b]} END{text[b:]}"
        return text

    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("ab é漢") for _ in range(rng.randint(0, 30)))
        cuts = [sorted((rng.randint(0, 32), rng.randint(0, 32))) for _ in range(rng.randint(0, 4))]
        rows.append((i, text, [(a, b, rng.choice("xy")) for a, b in cuts]))
    rows += [(100, None, [(0, 1, "x")]), (101, "a", None), (102, "ab", [(0, 1, None)]), (103, "b" * 50_000, [(2 * k, 2 * k + 1, "x") for k in range(25_000)])]
    df = spark.createDataFrame(rows, "id long, text string, spans array<struct<start:int,end:int,type:string>>")
    for r in df.select("id", "text", "spans", tags.inject_spans(F.col("text"), F.col("spans")).alias("out")).collect():
        whole = r["text"] is not None and r["spans"] is not None and all(None not in tuple(s) for s in r["spans"])
        assert r["out"] == (one_by_one(r["text"], [tuple(s) for s in r["spans"]]) if whole else None)


def test_products_of_edges_end(spark):
    assert all(end > n for tokens in itertools.product(["one", "hundred", "may"], repeat=3) for n, row in enumerate(numbers.edges(list(tokens))) for end, _, _ in row)

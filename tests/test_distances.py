"""Edit distances: right for any blocks, and quick for long texts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from voxloom.operators import metrics


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        was, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            was, row[j] = row[j], min(was + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@pytest.mark.parametrize("block", [1, 2, 5, metrics.BLOCK])
def test_distances_in_blocks(monkeypatch, block):
    monkeypatch.setattr(metrics, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(1000):
        a = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 14))]
        b = [x for x in a if rng.random() < 0.8] if rng.random() < 0.5 else [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        assert metrics.distance(a, b) == metrics.distance(b, a) == plain(a, b)


def test_characters_of_texts(spark):
    rows = [("a  b\t\nc", "a b c"), (None, "ab"), ("", ""), ("é ß", "e ß "), ("𝒳y", "y"), ("abc", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, ref string, hyp string")
    got = metrics.with_edits(df, "ref", "hyp", chars=True).orderBy("i").select("edits", "units", "heard").collect()
    assert [tuple(r) for r in got] == [(0, 5, 5), (2, 0, 2), (0, 0, 0), (2, 3, 4), (1, 2, 1), (3, 3, 0)]


def test_long_texts_that_differ_throughout(spark):
    """As many edits as words are replaced, since all words are different: 16,001 of 80,001 words, the first and the last among them."""
    df = spark.range(1).select(*[F.expr(f"array_join(transform(sequence(0, 80000), i -> concat(IF(i % 5 = 0, '{x}', ''), i)), ' ')").alias(c) for c, x in (("ref", "r"), ("hyp", "h"))])
    began = time.monotonic()
    assert tuple(metrics.with_edits(df, "ref", "hyp").select("edits", "units", "heard").first()) == (16_001, 80_001, 80_001)
    assert time.monotonic() - began < 12

"""Very long and hostile texts: bounded memory, time in proportion, and no influence on other rows."""

import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import langid, media, quality


def plain_features(text):
    """The features by whole-text operations."""
    words, lines = text.lower().split(), text.split(b"\n")
    n = max(1, len(words))
    share = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ quality._CLASS / len(text)
    return [1, share[1], share[2], share[4], share[5], share[3], share[6], np.log1p(len(words)) / 10, len(set(words)) / n, np.log1p(len(text) / n), len(set(lines)) / len(lines)]


@pytest.mark.parametrize("seed", range(6))
def test_features_do_not_depend_on_windows(monkeypatch, seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("aB é\n\t .7漢") * rng.randint(1, 4) for _ in range(700)).encode()
    whole = quality.features(text)
    assert np.allclose(whole[: quality.STATISTICS], plain_features(text))
    grams = langid.trigrams(text)
    monkeypatch.setattr(quality, "WINDOW", 1 + 7 * seed)
    monkeypatch.setattr(langid, "WINDOW", 1 + 7 * seed)
    assert np.allclose(whole, quality.features(text))
    assert all((a == b).all() for a, b in zip(grams, langid.trigrams(text)))
    assert langid.has_letter(text) and not langid.has_letter(b"12 \n.,")
    assert langid.has_letter("1" * 6 * (seed + 1) + "é") if seed == -1 else langid.has_letter(("1" * 6 * (seed + 1) + "é").encode())


@pytest.mark.parametrize("f", [quality.features, langid.trigrams, langid.has_letter])
@pytest.mark.parametrize("text", [b"word salad and more of it\n" * 400_000, b"x" * 10_000_000, b"1 \n" * 3_000_000])
def test_memory_of_a_long_text_is_bounded(f, text):
    tracemalloc.start()
    f(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # of windows and what a text has of different words, not of its length


def test_one_long_word_changes_no_other_verdict(spark):
    rng = random.Random(1)
    good, bad = [f"good{i}" for i in range(30)], [f"bad{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(40)), f"h{i % 3}.org/p") for i in range(120)]
    labels = [(i, i % 2) for i in range(0, 110)] + [(500, 1), (501, 0)]
    odd = [(500, "A" * 5_000_000, "h0.org/p"), (501, "x" * 2_000_000 + " y", "h1.org/p"), (502, "q" * 3_000_000, "h1.org/p")]
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string, source string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {}
    for name, some in (("plain", rows), ("odd", rows + odd)):
        docs = frame(some)
        got = quality.score(docs, quality.fit(docs, marks)).select("doc_id", "quality", "kept").collect()
        assert all(np.isfinite(r["quality"]) for r in got)
        kept[name] = {r["doc_id"]: r["kept"] for r in got if r["doc_id"] < 500}
    assert kept["plain"] == kept["odd"]
    assert [kept["odd"][i] for i in range(120)] == [bool(i % 2) for i in range(120)]
    nothing = frame(rows).withColumn("quality", F.lit(float("nan")))
    assert nothing.where(quality._good("quality", 0.5)).count() == 0


NESTED = ["<figure><figcaption>a", "<figure><figcaption>a<img src=x>", "<figcaption>a", "<figure>a", "<nav>a", "<nav></p>", "<template><nav>", "<head><title>a", "<figure><img src=x><figcaption>b</figcaption></figure>", "<p>a", "<script>a", "</figure></nav>", "<audio src=y><figcaption>"]


@pytest.mark.parametrize("unit", NESTED)
def test_parsing_takes_time_in_proportion_to_the_page(unit):
    def seconds(n):
        began = time.process_time()
        media.parse_items(unit * n)
        return time.process_time() - began

    seconds(100)
    few, many = max(0.02, seconds(4000)), seconds(16_000)
    assert many < 9 * few, (few, many)


def test_unclosed_figures_keep_their_captions():
    items = media.parse_items("<figure><img src=a><figcaption>one<figure><figcaption>two<img src=b><figure><figcaption>three")
    assert [(i["kind"], i["text"] or i["src"], i["caption"]) for i in items] == [("image", "a", "one"), ("image", "b", "two"), ("text", "three", None)]
    items = media.parse_items("<figure><figcaption>out<figure><figcaption>in</figcaption></figure><p>t</p></figure>")
    assert [i["text"] for i in items] == ["out", "in", "t"]


def test_kept_trees_encode_only_what_edits_touch(spark):
    import public_tokenizers
    import tiktoken

    from voxloom.llm import token_counts, tokens

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rng = random.Random(2)
    words = ["the", "house", "größer", "漢字", "x" * 30, "\n\n", "12,5"]
    texts = [" ".join(rng.choice(words) for _ in range(2000)) for _ in range(8)] + ["", None, "plain ascii text " * 50]
    rows = [(i, t, [(5, 9, "new words"), (800, 800, " ins ert ")], 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:bigint,end:bigint,text:string>>, tree int").repartition(2)
    trees = token_counts.token_trees(df, path, pattern)
    first = token_counts.edit_trees(trees.join(df.select("doc_id", "edits"), "doc_id"), path, pattern)
    again = token_counts.edit_trees(first.withColumn("edits", F.expr("array(struct(20L as start, 40L as end, '!' as text), null)")), path, pattern).collect()
    encoding = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=tokens.load_ranks(tokens.read_file(path)), special_tokens={})
    for r in again:
        want = texts[r["doc_id"]] or ""
        for a, b, new in ((5, 9, "new words"), (800, 800, " ins ert "), (20, 40, "!")):
            want = want[:a] + new + want[b:]
        assert r["text"] == want and r["n_tokens"] == len(encoding.encode_ordinary(want))
        assert len(want) < 1000 or r["reencoded_bytes"] < 400
    calls = []
    cache = token_counts.counter(tokens.read_file(path), pattern)
    text = texts[0].encode()
    packed = token_counts.TokenTree(text, cache).pack()
    values_of = cache.values_of
    cache.values_of = lambda t: calls.append(len(t)) or values_of(t)
    tree = token_counts.TokenTree(text, cache, leaves=packed)
    assert not calls  # nothing is encoded to take a tree up again
    tree.edit(100, 110, b"changed")
    assert sum(calls) < 200 < len(text)
    assert [token_counts.byte_at("aé漢b".encode(), i) for i in range(6)] == [0, 1, 3, 6, 7, 7]


def test_filters_hold_their_keys_in_parts(spark, monkeypatch):
    from voxloom.llm import common, minhash

    keys = spark.range(3000).select(F.xxhash64("id").alias("k"))
    own = np.array([r["k"] for r in keys.collect()], np.int64)
    monkeypatch.setattr(common, "MOST_BITS", 1 << 12)
    parts = list(common.key_filters(keys, "k"))
    assert len(parts) == -(-3000 * common.KEY_BITS // (1 << 12)) and np.any([common.key_in(p, own) for p in parts], axis=0).all()
    assert list(common.key_filters(keys, "k", most_parts=1)) == [] and list(common.key_filters(keys.limit(0), "k")) == []
    rng = random.Random(3)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(60)] for _ in range(20)]
    rows = [(i * 10 + k, " ".join(w[:30] + [f"new{k}"] * (k > 0) + w[30:])) for i, w in enumerate(base) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    many = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 80).collect()}  # many passes over the texts
    monkeypatch.undo()
    assert many == {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 80).collect()}
    assert len(set(many.values())) < len(many)
    twice = spark.createDataFrame([(1, "a b c d e f", z) for z in "cab"] * 2 + [(2, "other", "x")], "doc_id long, text string, z string").repartition(3)
    assert sorted(tuple(r) for r in minhash.keep_one(twice).collect()) == [(1, "a b c d e f", "a"), (2, "other", "x")]

"""Hard negatives, repeated strings and prefix tries against brute force on small fixtures."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import common, negatives, suffixes, trie, vectors

# 11


def mined(rows, scale=256, low=50, high=95, positives=5, negatives=3):
    rows = [(i, v, lab, a) for i, v, lab, a in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(i, [int(np.floor(np.float64(x) * scale)) for x in v], lab, a) for i, v, lab, a in rows]
    out = set()
    for i, v, lab, asked in rows:
        if not asked:
            continue
        best, other = {}, {}
        for j, w, of, _ in rows:
            if j != i and len(w) == len(v):
                s = sum(x * y for x, y in zip(v, w))
                if of == lab:
                    best[j] = max(best.get(j, s), s)
                else:
                    other.setdefault(j, set()).add(s)
        for j, p in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:positives]:
            inside = {k: max(s for s in some if low * p <= 100 * s <= high * p) for k, some in other.items() if any(low * p <= 100 * s <= high * p for s in some)}
            out |= {(i, j, r + 1, k, p, s) for r, (k, s) in enumerate(sorted(inside.items(), key=lambda x: (-x[1], x[0]))[:negatives])}
    return out


@pytest.mark.parametrize("block_rows,anchor_bytes", [(4096, 16 << 20), (7, 700)])
def test_hard_negatives_are_exact(spark, block_rows, anchor_bytes):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)], rng.randrange(3), i % 10 == 0) for i in range(150)]
    rows += [(200 + i, [rng.choice((-1.0, 0.0, 1.0)) for _ in range(3)], i % 2, i % 4 == 0) for i in range(40)]  # many ties, another dimension
    rows += [rows[0], rows[3], (3, [0.5] * 9, 1, False), (10, [0.25] * 9, 2, True), (None, [0.1] * 9, 1, True), (400, None, 1, True), (401, [], 1, True), (402, [0.1, None] + [0.0] * 7, 1, True)]
    rows += [(403, [float("nan")] * 9, 1, True), (404, [0.1] * 9, None, True), (405, [float("inf")] * 9, 0, False), (406, [0.0] * 9, 1, True), (407, [1e9] + [0.0] * 8, 1, False), (408, [0.3] * 11, 1, True)]
    df = spark.createDataFrame([r + (1, "x") for r in rows], "vec_id long, embedding array<double>, label int, asked boolean, id long, dim string").repartition(3)
    got = negatives.hard_negatives(df, F.col("asked"), block_rows=block_rows, anchor_bytes=anchor_bytes).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == mined(rows)
    assert negatives.hard_negatives(df.limit(0), F.col("asked")).collect() == []
    assert negatives.hard_negatives(df, F.lit(None).cast("boolean")).collect() == []


def test_bounds_hold_the_products():
    rng = np.random.default_rng(1)
    for scale in (1, 1e4, 1e20):
        x = np.floor(rng.normal(size=(300, 7)) * 50 * scale)
        centres = negatives.codebook(x[::3])
        codes, left = negatives.encode(x, centres)
        block = negatives.Block({"n": 300, "dim": 7, "ids": np.arange(300).tobytes(), "labels": ["a"] * 300, "data": x.tobytes(), "codes": codes.tobytes(), "residuals": left.tobytes()})
        anchors = negatives.Anchors([{"index": i, "id": i, "label": "a", "data": x[i].tobytes()} for i in range(20)], centres)
        low, high = anchors.bounds(np.arange(20), block, np.arange(300))
        exact = x[:20] @ x.T
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < 0.5 * (exact.max() - exact.min())


def test_products_beyond_a_long_are_an_error(spark):
    df = spark.createDataFrame([(i, [1e12, 1.0], i % 2) for i in range(8)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="may not fit a long"):
        negatives.hard_negatives(df, F.lit(True)).collect()


def test_integers_are_floors_of_rows_that_take_part(spark):
    rows = [(1, [0.5, -0.3]), (2, None), (3, []), (4, [1.0, None]), (None, [1.0]), (5, [float("inf")]), (6, [-1.0, 2.0, 0.1])]
    got = vectors.integers(spark.createDataFrame(rows, "i long, v array<double>").repartition(1), "i", "v", 10).collect()
    assert {r["id"]: np.frombuffer(r["data"], np.float64).tolist() for r in got} == {1: [5.0, -3.0], 6: [-10.0, 20.0, 1.0]}
    assert {r["id"]: (r["dim"], round(r["norm"], 6)) for r in got} == {1: (2, round(34**0.5, 6)), 6: (3, round(501**0.5, 6))}


# 12


def removed(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(a > b for a, b in zip(gone, b"\0" + gone)), hashlib.sha256(kept).hexdigest()))
    return out


def odd_corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é漢\n") for _ in range(rng.randint(150, 500))) for _ in range(5)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 3)):
            b = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                b[rng.randrange(len(b))] = rng.choice("xyz")
            a = rng.randrange(len(b))
            parts.append("".join(b[a : a + rng.randint(1, 400)]))
        texts.append("".join(parts))
    return texts + [None, "", "short", base[0], base[0], base[0][:100], "a" * 700, "a" * 250, "b" * 199, "c" * 200, "ab" * 300, "long " + "".join(rng.choice("abcdefgh ") for _ in range(30_000))]


@pytest.mark.parametrize("length,chunk,most", [(200, 480, 8192), (150, 5, 8192), (80, 3, 2)])
def test_repeats_are_removed_exactly(spark, length, chunk, most):
    texts = odd_corpus(length)
    rows = [(None if i == 7 else i % 50, t, 1, "x", 0.5) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (60, texts[1], 1, "x", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, s string, a double").repartition(3)
    got = suffixes.remove_repeats(df, length, chunk=chunk, most=most).collect()
    want = Counter((r[0], *w) for r, w in zip(rows, removed([r[1] for r in rows], length)))
    assert Counter(tuple(r) for r in got) == want
    assert suffixes.remove_repeats(df.limit(0), length).collect() == []
    alone = suffixes.remove_repeats(df.where("doc_id = 2").limit(1), length).first()
    assert alone["n_bytes"] == len(texts[2].encode())
    with pytest.raises(ValueError, match="at least"):
        suffixes.remove_repeats(df, 50)


def test_merge_is_the_order_of_all_suffixes():
    rng = np.random.default_rng(2)
    rows = rng.integers(97, 99, (23, suffixes.WIDTH)).astype(np.uint8)
    rows[5:9] = rows[4]
    before = np.concatenate((rows[:, -8:], rows), axis=1)
    words = np.ndarray(rows.shape, ">u8", before.tobytes(), 0, (suffixes.WIDTH + 8, 1)).astype(np.uint64)
    words = np.unique(words, return_inverse=True)[1].reshape(rows.shape).astype(np.uint16)
    shards = [suffixes.Shard(rows[a : a + 7], words[a : a + 7]) for a in range(0, 23, 7)]
    entries, interval = suffixes.merge(shards)
    which = np.concatenate([s.order + 7 * i * suffixes.WIDTH for i, s in enumerate(shards)])[entries]
    assert sorted(which.tolist()) == list(range(rows.size))
    circle = [bytes(r) * 2 for r in rows]
    keys = [circle[e // suffixes.WIDTH][e % suffixes.WIDTH :][: suffixes.REACH + 1] for e in which.tolist()]
    assert keys == sorted(keys)
    assert all((a == b) == (x == y) for a, b, x, y in zip(keys, keys[1:], interval.tolist(), interval[1:].tolist()))


def test_cores_cover_all_windows_at_any_block(monkeypatch):
    text = random.Random(4).randbytes(3000) + b"\0" * 500
    whole = suffixes.cores(text, 200)
    assert whole[1][0] == 0 and whole[2][-1] == len(text) - 200 and (whole[1][1:] == whole[2][:-1] + 1).all()
    assert ((whole[1] <= whole[0]) & (whole[0] <= whole[2] + suffixes.REACH)).all() and (whole[2] <= whole[0]).all()
    monkeypatch.setattr(suffixes, "_PLACES", 37)
    assert all((a == b).all() for a, b in zip(whole, suffixes.cores(text, 200)))


# 13


def nodes(turns):
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    own: dict = {}
    for row in sorted((t for t in turns if t[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    built = {}
    for c, units in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + units[h:])
    members: dict = {}
    for c, units in built.items():
        for d in range(len(units) + 1):
            members.setdefault(units[:d], []).append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, some in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(some) - 1) * len(n[-1][1].encode()) if n else 0
    ends = lambda n: hashlib.sha256(",".join(map(str, sorted(c for c in members[n] if len(built[c]) == len(n)))).encode()).hexdigest()
    return Counter((min(some), len(n), min(members[n[:-1]]) if n else None, len(some), children[n], leaves[n], saved[n], ends(n)) for n, some in members.items())


@pytest.mark.parametrize("parts,waiting,piece", [(1, 100_000, 50_000), (7, 3, 2), (40, 100_000, 50_000)])
def test_prefix_trie(spark, monkeypatch, parts, waiting, piece):
    rng = random.Random(8)
    said = ["hi", "héllo", "", None, "漢字", "long " * 50]
    turns = [(c, t, rng.choice(["user", "bot", None]), rng.choice(said)) for c in range(-20, 90) for t in range(rng.choice((1, 2, 3, 12)))]
    turns += [(c, t, "user", "same") for c in range(100, 160) for t in range(3)]  # copies over many partitions
    turns += [(200, None, "user", "first"), (200, None, "bot", "first"), (200, 0, "user", "x"), (200, 0, "user", "x"), (None, 1, "user", "nobody"), (207, 0, "user", "alone")]
    sweep = trie.Sweep

    class Small(sweep):
        WAITING, PIECE = waiting, piece

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([t + (1, "x") for t in turns], "conv_id long, turn long, role string, text string, n_convs long, units string").repartition(3)
        arrays = common.staged(trie.turn_arrays(df))
        rows = trie.share_heads(arrays).repartition(5)
        if waiting < 10:  # the sweep itself, since workers don't see a changed limit
            monkeypatch.setattr(trie, "Sweep", Small)
            path = F.coalesce(F.unhex(F.array_join("units", "")), F.lit(b"")).alias("path")
            each = [(r["conv_id"], bytes(r["path"])) for r in rows.select("conv_id", path).orderBy("path", "conv_id").collect()]
            s = Small(0)
            for conv, units in each:
                s.see(conv, units)
            s.finish()
            kinds = Counter(r[0] for r in s.rows)
            assert kinds["waits"] > 0 and kinds["ends"] > 5 and kinds["lookup"] > 0
        else:
            got = trie.prefix_trie(rows).collect()
            assert Counter(tuple(r) for r in got) == nodes(turns)
            assert trie.prefix_trie(rows.limit(0)).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

"""Archives and keyed tables: damage is routed, and a killed run changes nothing."""

import io
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from voxloom.sources import archives, keyed
from voxloom.staging import scratch


def tar(rows, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, data in rows:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def zipped(rows, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.writestr("folder/", b"")
        for name, data in rows:
            z.writestr(name, data)
    return out.getvalue()


def test_archives(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"clé/{i}.bin", rng.randbytes(rng.choice([0, 1, 511, 512, 513, 70_000]))) for i in range(60)] + [("long/" + "x" * 200, b"abc"), ("clé/3.bin", b"again")]
    whole = {"a.tar": tar(rows), "b.zip": zipped(rows), "c.zip": zipped(rows, zipfile.ZIP_STORED), "d.tgz": tar(rows, "w:gz"), "e.tar.gz": tar(rows, "w:gz"), "none.tar": tar([]), "none.zip": zipped([])}
    for name, data in whole.items():
        (tmp_path / name).write_bytes(data)
    df = spark.createDataFrame([(f"file://{tmp_path}/{n}", 1) for n in whole] + [(None, 1)], "path string, size int")
    for size in (64 << 20, 5000):
        got = archives.read_archives(df, range_bytes=size)
        assert got.columns == ["path", "member", "size", "content", "error"]
        found = {}
        for r in got.collect():
            assert r["error"] is None and r["size"] == len(r["content"])
            found.setdefault(r["path"].rpartition("/")[2], []).append((r["member"], bytes(r["content"])))
        assert {k: sorted(v) for k, v in found.items()} == {n: sorted(rows) for n in whole if not n.startswith("none")}
    assert archives.read_archives(df.limit(0)).collect() == []
    small = archives.read_archives(df, largest=600).where("error IS NOT NULL")
    assert small.count() == 5 * sum(len(d) > 600 for _, d in rows) and {r["error"] for r in small.collect()} == {"larger than 600 bytes"}


def test_damaged_archives(spark, tmp_path):
    rows = [(f"{i}", bytes([65 + i]) * 2000) for i in range(5)]
    plain, packed = tar(rows), zipped(rows, zipfile.ZIP_STORED)
    at = plain.index(b"C" * 2000) - 512
    bad = {"cut.tar": plain[: at + 900], "head.tar": plain[: at + 100] + b"\xff" * 60 + plain[at + 160 :], "open.tar": plain[: plain.index(b"E" * 2000) + 2048], "sum.zip": packed.replace(b"C" * 2000, b"C" * 1999 + b"x"),
        "cut.zip": packed[:3000], "empty.tar": b"", "cut.tgz": tar(rows, "w:gz")[:60], "words.tar": b"no archive" * 100}
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
    got = {n: [] for n in [*bad, "missing.tar"]}
    for r in archives.read_archives(spark.createDataFrame([(f"{tmp_path}/{n}",) for n in got], "path string")).collect():
        got[r["path"].rpartition("/")[2]].append((r["member"], None if r["content"] is None else bytes(r["content"]), r["error"]))
    right = lambda name: sorted((m, c) for m, c, e in got[name] if e is None)
    wrong = lambda name: [(m, c) for m, c, e in got[name] if e]
    assert right("head.tar") == rows[:2] and wrong("head.tar") == [(None, None)]
    assert right("cut.tar") == rows[:2] and set(wrong("cut.tar")) <= {("2", None), (None, None)} and wrong("cut.tar")
    assert right("open.tar") == rows and wrong("open.tar") == [(None, None)]
    assert right("sum.zip") == rows[:2] + rows[3:] and wrong("sum.zip") == [("2", None)]
    for name in ("cut.zip", "empty.tar", "words.tar", "missing.tar"):
        assert right(name) == [] and wrong(name) == [(None, None)], (name, got[name])
    assert (None, None) in wrong("cut.tgz")


def test_keyed_tables(spark):
    t = keyed.KeyedTable(spark, scratch(spark, "keyed"), ["k", "part"], 4)
    with pytest.raises(ValueError):
        t.read()
    rng, want = random.Random(3), {}
    schema = "k string, part int, v double, bucket string, n long, gone boolean"
    for step in range(5):
        rows = [(rng.choice(["a", "b", "c", "", None, "é"]), rng.choice([1, 2, None]), rng.random(), f"s{step}", i, rng.choice([True, False, None])) for i in range(0 if step == 3 else 12)]
        for k, part, v, b, n, gone in rows:
            want.pop((k, part), None)
            if not gone:
                want[k, part] = (v, b, n, gone)
        assert t.merge(spark.createDataFrame(rows, schema), "n", F.col("gone")) == step + 1
        assert {(r["k"], r["part"]): tuple(r)[2:] for r in t.read().collect()} == want and t.read().count() == len(want)
    assert t.versions() == [1, 2, 3, 4, 5] and t.read(1).count() <= 12
    all_gone = t.read().withColumn("gone", F.lit(True))
    t.merge(all_gone, "n", F.col("gone"))
    assert t.read().collect() == [] and t.read().columns == ["k", "part", "v", "bucket", "n", "gone"]
    t.vacuum(1)
    assert t.versions() == [6] and t._names(f"{t.path}/data") == []
    with pytest.raises(ValueError):
        keyed.KeyedTable(spark, t.path, ["k"]).read()


def test_merges_touch_only_their_buckets(spark):
    t = keyed.KeyedTable(spark, scratch(spark, "keyed"), ["id"], 8)
    t.merge(spark.range(100).withColumn("v", F.lit(0)), "v")
    before = t._state()[1]["folders"]
    t.merge(spark.createDataFrame([(7, 1)], "id long, v int"), "v")
    after = t._state()[1]["folders"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert t.read().where("v = 1").collect()[0]["id"] == 7 and t.read().count() == 100
    assert t.read(1).where("v = 1").count() == 0


def test_killed_and_rival_merges(spark, monkeypatch):
    t = keyed.KeyedTable(spark, scratch(spark, "keyed"), ["id"], 4)
    t.merge(spark.createDataFrame([(1, 1), (2, 1)], "id long, v int"), "v")
    commit = t._commit

    def killed(version, state):
        raise KeyboardInterrupt

    monkeypatch.setattr(t, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        t.merge(spark.createDataFrame([(1, 2)], "id long, v int"), "v")
    assert sorted(map(tuple, t.read().collect())) == [(1, 1), (2, 1)]
    monkeypatch.setattr(t, "_commit", lambda version, state: (commit(version, state), commit(version, state)))
    with pytest.raises(RuntimeError):
        t.merge(spark.createDataFrame([(1, 3)], "id long, v int"), "v")
    monkeypatch.setattr(t, "_commit", commit)
    assert sorted(map(tuple, t.read().collect())) == [(1, 3), (2, 1)] and t.versions() == [1, 2]
    assert t.vacuum(2) == 1


def test_streams_resume_once(spark, monkeypatch):
    """A run that is killed between the table's commit and the stream's own repeats its batch without effect; one killed before the commit does it again."""
    src, ck, schema = scratch(spark, "in"), scratch(spark, "ck"), "id long, n long"
    t = keyed.KeyedTable(spark, scratch(spark, "keyed"), ["id"], 4)
    spark.createDataFrame([(1, 1), (2, 2)], schema).write.mode("append").parquet(src)
    rows = spark.readStream.schema(schema).parquet(src)
    run = lambda: keyed.merge_stream(rows, t, "n", "s", ck).awaitTermination()
    run()
    commit = t._commit
    for late in (True, False):
        def killed(version, state, late=late):
            if late:
                commit(version, state)
            raise RuntimeError("killed")

        monkeypatch.setattr(t, "_commit", killed)
        spark.createDataFrame([(1, 3 if late else 4), (5, 5)], schema).write.mode("append").parquet(src)
        with pytest.raises(Exception):
            run()
        monkeypatch.setattr(t, "_commit", commit)
        versions = t.versions()
        run()
        assert len(t.versions()) == len(versions) + (0 if late else 1)
        assert sorted(map(tuple, t.read().collect())) == [(1, 3 if late else 4), (2, 2), (5, 5)]
    run()
    assert len(t.versions()) == 3

"""Joins of manifests with their companions. Equi-joins are left to the optimizer; hot keys are split by adaptive execution."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.paths import basename, stem
from voxloom.staging import staged


def pair_by_stem(audio: DataFrame, texts: DataFrame, audio_path: str = "audio_filepath", text_path: str = "text_path") -> DataFrame:
    """Audio and text files of the same stem."""
    a = audio.withColumn("stem", stem(F.col(audio_path)))
    return a.join(texts.withColumn("stem", stem(F.col(text_path))), "stem")


def unpaired(audio: DataFrame, texts: DataFrame, audio_path: str = "audio_filepath", text_path: str = "text_path") -> DataFrame:
    return audio.withColumn("stem", stem(F.col(audio_path))).join(texts.select(stem(F.col(text_path)).alias("stem")), "stem", "left_anti")


def last_transcript(df: DataFrame, transcripts: DataFrame, key: str, text: str, order: str) -> DataFrame:
    """Inner join with the last transcript of each key."""
    return df.join(transcripts.groupBy(key).agg(F.max_by(text, order).alias(text)), key)


def with_default(df: DataFrame, other: DataFrame, key: str | list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join; columns of the other side get a default where nothing matches."""
    joined = df.join(other, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def lookup_update(df: DataFrame, table: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """old replaced by the table's new for the same key, else as it is."""
    return df.join(table.select(key, F.col(new).alias("_new")), key, "left").withColumn(old, F.coalesce("_new", old)).drop("_new")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those done; put it before any expensive step."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def not_done_by_path(df: DataFrame, done: DataFrame, path: str = "audio_filepath") -> DataFrame:
    """Neither the whole path nor the file name is among those done: two equi anti joins, not an OR."""
    whole = df.join(done.select(F.col(path)).distinct(), path, "left_anti")
    return whole.withColumn("_name", basename(F.col(path))).join(done.select(basename(F.col(path)).alias("_name")).distinct(), "_name", "left_anti").drop("_name")


def without_prefixes(lines: DataFrame, prefixes: DataFrame, value: str = "value", prefix: str = "prefix") -> DataFrame:
    """Lines that begin with none of the prefixes; a null line begins with none, an empty or null prefix is none.

    Prefixes and distinct heads of lines (as long as the longest prefix) are range-partitioned in one order. Of prefixes that
    begin with one another only the shortest counts, so a line begins with a prefix just if it does with the last one
    that stands before it: in its partition, or else in those before, of which the driver gets the last prefix each.
    The work does not depend on how many lengths there are.
    """
    prefixes = prefixes.select(F.col(prefix).alias("s")).where("s <> ''").distinct()
    most = prefixes.agg(F.max(F.length("s"))).first()[0]
    if most is None:
        return lines
    heads = lines.select(F.substring(value, 1, most).alias("s")).where("s is not null").distinct()
    both = prefixes.select("s", F.lit(0).alias("line")).unionByName(heads.select("s", F.lit(1).alias("line")))
    ranged = both.repartitionByRange("s", "line").select("s", "line", F.spark_partition_id().alias("part"))
    ordered = staged(ranged, "ranged").repartition("part").sortWithinPartitions("part", "s", "line")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = last = None
        for batch in batches:
            out = []
            for s, line, here in zip(*(c.to_pylist() for c in batch.columns)):
                if here != part:
                    if last is not None:
                        out.append((last, part, None))
                    part, last = here, None
                begins = last is not None and s.startswith(last)
                if line:
                    out.append((s, part, begins))
                elif not begins:
                    last = s
            yield made(out)
        if last is not None:
            yield made([(last, part, None)])

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.string(), pa.int32(), pa.bool_()))], ["s", "part", "begins"])

    found = staged(ordered.mapInArrow(walk, "s string, part int, begins boolean"), "begins")
    lasts = {r["part"]: r["s"] for r in found.where("begins is null").collect()}  # one for each partition
    carried, last = [], None
    for part in range(max(lasts) + 2):  # the last entry stands for all partitions behind those with prefixes
        carried.append((part, last))
        if part in lasts and (last is None or not lasts[part].startswith(last)):
            last = lasts[part]
    before = lines.sparkSession.createDataFrame(carried, "part int, before string")
    hits = found.where("begins is not null").withColumn("part", F.least("part", F.lit(len(carried) - 1))).join(F.broadcast(before), "part").where(F.col("begins") | F.coalesce(F.col("s").startswith(F.col("before")), F.lit(False))).select("s")
    named = lines.withColumn("_head", F.substring(value, 1, most))
    return named.join(hits.withColumnRenamed("s", "_head"), "_head", "left_anti").drop("_head")


def resolve_paths(df: DataFrame, listing: DataFrame, candidates, key: str) -> DataFrame:
    """The first of an array of candidate paths that the listing has, as resolved (null if none)."""
    tried = df.select(key, F.posexplode(candidates).alias("_rank", "path"))
    found = tried.join(listing.select("path").distinct(), "path").groupBy(key).agg(F.min_by("path", "_rank").alias("resolved"))
    return df.join(found, key, "left")


#: Lengths of intervals are rounded up to width * 2^level; bounds beyond width * 2^LEVELS, infinite ones too, count as that far for binning.
LEVELS = 52


def _level(start: Column, end: Column, width: float) -> Column:
    """The least level whose bins are as long as the interval, so that it touches two of them (or three, by rounding)."""
    return F.least(F.greatest(F.ceil(F.log2(F.greatest((end - start) / width, F.lit(1.0)))), F.lit(0)), F.lit(LEVELS)).cast("int")


def _bin(at: Column, level: Column, width: float) -> Column:
    most = width * 2.0**LEVELS
    return F.floor(F.greatest(F.least(at, F.lit(most)), F.lit(-most)) / (F.lit(width) * F.pow(F.lit(2.0), level)))


def _levels(df: DataFrame, start: str, end: str, width: float, name: str) -> DataFrame:
    """One row: the levels that occur, at most LEVELS + 1 of them."""
    return df.where(F.col(start) <= F.col(end)).agg(F.collect_set(_level(F.col(start), F.col(end), width)).alias(name))


def point_in_range(points: DataFrame, ranges: DataFrame, key: str, at: str, start: str, end: str, width: float = 30.0) -> DataFrame:
    """Points within [start, end] of ranges of the same key, both ends included; a point on a shared bound is in both.

    Bins double in length from level to level. A range goes into the few bins that it touches at the level of its own
    length, however long it is, and a point into one bin at every level that occurs, so this is an equi-join on (key, level, bin).
    Nulls, and ranges that end before they start, match nothing.
    """
    level = _level(F.col(start), F.col(end), width)
    binned = ranges.where(F.col(start) <= F.col(end)).withColumn("_level", level).withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_level"), width), _bin(F.col(end), F.col("_level"), width))))
    tried = points.crossJoin(F.broadcast(_levels(ranges, start, end, width, "_all"))).withColumn("_level", F.explode("_all")).drop("_all")
    return tried.withColumn("_bin", _bin(F.col(at), F.col("_level"), width)).join(binned, [key, "_level", "_bin"]).where(F.col(at).between(F.col(start), F.col(end))).drop("_level", "_bin")


def overlaps(left: DataFrame, right: DataFrame, key: str, a: tuple[str, str], b: tuple[str, str], width: float = 30.0) -> DataFrame:
    """Pairs of intervals of the same key that touch; each pair once, from the bin in which the later start lies at the level of the longer interval.

    An interval goes into the few bins that it touches at its own level and at the longer levels of the other side.
    """
    def bins(df: DataFrame, s: str, e: str, other: DataFrame, own: str) -> DataFrame:
        rows = df.where(F.col(s) <= F.col(e)).withColumn(own, _level(F.col(s), F.col(e), width)).crossJoin(F.broadcast(other))
        rows = rows.withColumn("_level", F.explode(F.array_union(F.array(own), F.filter("_all", lambda n: n > F.col(own))))).drop("_all")
        return rows.withColumn("_bin", F.explode(F.sequence(_bin(F.col(s), F.col("_level"), width), _bin(F.col(e), F.col("_level"), width))))

    both = bins(left, *a, _levels(right, *b, width, "_all"), "_la").join(bins(right, *b, _levels(left, *a, width, "_all"), "_lb"), [key, "_level", "_bin"])
    once = (F.col("_level") == F.greatest("_la", "_lb")) & (F.col("_bin") == _bin(F.greatest(a[0], b[0]), F.col("_level"), width))
    return both.where((F.col(a[1]) >= F.col(b[0])) & (F.col(a[0]) <= F.col(b[1])) & once).drop("_level", "_bin", "_la", "_lb")

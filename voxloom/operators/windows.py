"""Order-sensitive operators: speaker turns, cue merging, duplicates kept first, and windows over audio."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.paths import basename
from voxloom.operators.aggregates import union_all
from voxloom.operators.components import components
from voxloom.staging import drop, staged


def speaker_change(df: DataFrame, file: str, pos: str, speaker: str) -> DataFrame:
    """changed: the speaker differs from the one before (false for the first)."""
    before = F.lag(speaker).over(Window.partitionBy(file).orderBy(pos))
    return df.withColumn("changed", F.coalesce(before != F.col(speaker), F.lit(False)))


def speaker_number(df: DataFrame, file: str, pos: str, speaker: str) -> DataFrame:
    """Speakers numbered from 1 by first appearance; short turns count too."""
    first = F.min(pos).over(Window.partitionBy(file, speaker))
    return df.withColumn("_first", first).withColumn("speaker_no", F.dense_rank().over(Window.partitionBy(file).orderBy("_first"))).drop("_first")


def repeats_previous(df: DataFrame, file: str, pos: str, text: str) -> DataFrame:
    """repeated: a text, not empty, that equals the one before without regard to case; an empty text resets the memory."""
    said = F.lower(F.trim(F.coalesce(F.col(text), F.lit(""))))
    before = F.lag(said).over(Window.partitionBy(file).orderBy(pos))
    return df.withColumn("repeated", (said != "") & F.coalesce(before == said, F.lit(False)))


def tagged_turns(df: DataFrame, file: str, pos: str, speaker: str, text: str) -> DataFrame:
    """One text per file: turns in order, SPEAKER_CHANGE before a new speaker. The mark of a turn that is dropped as a repeat is lost with it."""
    rows = repeats_previous(speaker_change(df, file, pos, speaker), file, pos, text)
    piece = F.concat_ws(" ", F.when(F.col("changed"), "SPEAKER_CHANGE"), F.nullif(F.trim(text), F.lit("")))
    return rows.where("not repeated").groupBy(file).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), piece.alias("t")))), lambda s: s["t"]), " ").alias("text"))


def merge_overlapping(cues: Column, most: int = 30) -> Column:
    """Texts of an ordered array as one: of every next text only what follows the longest overlap of its head with the tail so far (at most most words, any case)."""
    def step(acc, cue):
        words = F.filter(F.split(F.trim(F.regexp_replace(cue, r"(?U)\s+", " ")), " "), lambda w: w != "")
        low = lambda a: F.transform(a, lambda w: F.lower(w))
        widest = F.least(F.size(acc), F.size(words), F.lit(most))
        fits = F.filter(F.sequence(F.lit(0), F.lit(most)), lambda k: (k > 0) & (k <= widest) & (low(F.slice(acc, F.greatest(F.size(acc) - k + 1, F.lit(1)), k)) == low(F.slice(words, F.lit(1), k))))
        skip = F.coalesce(F.array_max(fits), F.lit(0))
        return F.concat(acc, F.slice(words, skip + 1, F.greatest(F.size(words) - skip, F.lit(0))))

    return F.array_join(F.aggregate(F.filter(cues, lambda c: c.isNotNull()), F.array().cast("array<string>"), step), " ")


def keep_first(df: DataFrame, key: Column | str, order: list[str]) -> DataFrame:
    """The first row of each key."""
    key = F.col(key) if isinstance(key, str) else key
    return df.withColumn("_key", key).withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_n = 1").drop("_key", "_n")


def keep_first_name(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    return keep_first(df, basename(F.col(path)), order)


def keep_first_of_two_keys(df: DataFrame, path: str, content: str, pos: str) -> DataFrame:
    """Sequential keep-first on two keys: a row stays if no row that stays before it has its path or its content.

    In rounds, a row that is the first undecided one of both its path and its content stays, and all other rows of that
    path or that content go: every round decides the first rows of all groups side by side. Where a round leaves more
    than half of the rows, what is left are chains of rows that alternate keys: each group of rows that keys join
    (connected components) is then walked in order, all groups side by side, with the keys that were kept in memory.
    Only keys and positions take part; least positions are pre-aggregated before each shuffle.
    Null keys are keys like any other; positions are unique.
    """
    key = lambda c: F.to_json(F.struct(F.col(c).alias("k")))  # noqa: E731  {} for null
    live = staged(df.select(F.col(pos).alias("n"), key(path).alias("p"), key(content).alias("c")), "live")
    stay, rows = [], live.count()
    while rows:
        first = lambda k: live.groupBy(k).agg(F.min("n").alias("n"))
        winners = staged(first("p").join(first("c"), ["n"]).select("n", "p", "c"), "stay")
        stay.append(winners.select("n"))
        left = staged(live.join(winners.select("p"), "p", "left_anti").join(winners.select("c"), "c", "left_anti").select("n", "p", "c"), "live")
        drop(live)
        live, before, rows = left, rows, left.count()
        if 2 * rows > before:
            stay.append(_walk_groups(live))
            break
    if not stay:
        return df.where("false")
    return df.join(union_all(*stay).withColumnRenamed("n", pos), pos, "left_semi")


def _walk_groups(live: DataFrame) -> DataFrame:
    """n of the rows that stay, each group of rows that share keys walked by one task in order."""
    schema = live.select("n").schema
    rows = live.withColumns({"a": F.xxhash64(F.lit("p"), "p"), "b": F.xxhash64(F.lit("c"), "c")})
    groups = components(rows, "a", "b")
    ordered = rows.join(groups, rows.a == groups.node).select("component", "n", "p", "c").repartition("component").sortWithinPartitions("component", "n")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, paths, contents = None, set(), set()
        for batch in batches:
            keep = []
            for i, (g, p, c) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)))):
                if g != group:
                    group, paths, contents = g, set(), set()
                if p not in paths and c not in contents:
                    paths.add(p)
                    contents.add(c)
                    keep.append(i)
            yield batch.select(["n"]).take(pa.array(keep, pa.int64()))

    return ordered.mapInArrow(walk, schema)


def sliding_chunks(seconds: Column, length: float = 30.0, overlap: float = 10.0, least: float = 1.0) -> Column:
    """array of (idx, start, end): windows every length - overlap seconds; tails shorter than least are dropped."""
    step = length - overlap
    starts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(seconds / step) - 1, F.lit(0)).cast("int")), lambda i: F.struct(i.alias("idx"), (i * step).cast("double").alias("start"), F.least(i * step + length, seconds).cast("double").alias("end")))
    return F.filter(starts, lambda w: w["end"] - w["start"] >= least)


def tumbling_chunks(seconds: Column, length: float = 30.0, base: int = 1) -> Column:
    """array of (idx, start, end) of windows side by side, the last one cut; numbered from base."""
    n = F.ceil(seconds / length).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((i + base).alias("idx"), (i * length).cast("double").alias("start"), F.least((i + 1) * length, seconds).cast("double").alias("end")))).otherwise(F.array().cast("array<struct<idx:int,start:double,end:double>>"))


def trim_windows(millis: Column, length: int = 30_000, step: int = 20_000) -> Column:
    """array of (start, end) in milliseconds: the whole if it is no longer than length; else windows every step that fit, and a tail window at the end if the step doesn't divide the whole (also if it repeats the last)."""
    fit = F.transform(F.sequence(F.lit(0), F.floor((millis - length) / step).cast("int")), lambda i: F.struct((i * step).cast("long").alias("start"), (i * step + length).cast("long").alias("end")))
    tail = F.when(millis % step > 0, F.array(F.struct((millis - length).cast("long").alias("start"), millis.cast("long").alias("end")))).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return F.when(millis <= length, F.array(F.struct(F.lit(0).cast("long").alias("start"), millis.cast("long").alias("end")))).otherwise(F.concat(fit, tail))


def page(df: DataFrame, order: list[str], skip: int, most: int) -> DataFrame:
    return df.orderBy(*order).offset(skip).limit(most)


def until_unique(df: DataFrame, batch: str, item: str, wanted: int) -> DataFrame:
    """Items of batches in order until at least wanted different ones are there: an item counts for its first batch.

    Every batch that counts brings a new item, so the first wanted of them are enough, and no ordered pass over all batches is made.
    """
    first = df.groupBy(item).agg(F.min(batch).alias(batch))
    sizes = first.groupBy(batch).agg(F.count("*").alias("n")).orderBy(batch).limit(wanted)
    before = F.sum("n").over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1))
    keep = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < wanted).select(batch)
    return first.join(F.broadcast(keep), batch, "left_semi")


def number_rows(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Rows numbered from 1 in a total order, without bringing them to one task.

    Rows are range-partitioned and written; the driver adds up one count for each partition, and each partition numbers its own rows.
    """
    ranged = staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = sorted(tuple(r) for r in ranged.groupBy("_part").agg(F.count("*")).collect())
    offsets = list(zip((p for p, _ in counts), accumulate((n for _, n in counts), initial=0)))
    table = df.sparkSession.createDataFrame(offsets, "_part int, _before long")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_own", own).join(F.broadcast(table), "_part").withColumn(name, F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")


def ordered_batches(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a number of rows; for providers that take so many texts in a call."""
    for batch in rows:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)

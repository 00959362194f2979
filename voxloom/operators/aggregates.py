"""Aggregations over manifests: durations, speakers, tags, ordered texts, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_text(df: DataFrame, key: str, order: list[str], piece: Column, name: str = "text") -> DataFrame:
    """The pieces of each key in order, joined by spaces; null keys and null pieces are left out. A key's text is one row, and has to fit in one."""
    rows = df.where(F.col(key).isNotNull()).select(key, F.struct(*order, piece.alias("_t")).alias("_s"))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["_t"]), " ").alias(name))


def chunk_texts(df: DataFrame, file: str, order: list[str], texts: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """One row per chunk: each text column's non-empty pieces in order, joined by spaces, and duration, from the first start to the last end. A chunk's segments meet in one row, as their texts do."""
    rows = df.groupBy(file).agg(F.array_sort(F.collect_list(F.struct(*order, *[F.col(t).alias(f"t{i}") for i, t in enumerate(texts)]))).alias("_s"), (F.max(end) - F.min(start)).alias("duration"))
    joined = lambda i: F.trim(F.array_join(F.filter(F.transform("_s", lambda s: s[f"t{i}"]), lambda x: x != ""), " "))
    return rows.select(file, *[joined(i).alias(t) for i, t in enumerate(texts)], "duration")


def durations(df: DataFrame, by: list[str] = (), duration: str = "duration") -> DataFrame:
    """n (numeric durations), total_hours and avg_seconds (0 if there are none)."""
    d = F.col(duration).try_cast("double")
    return df.groupBy(*by).agg(F.count(d).alias("n"), (F.coalesce(F.sum(d), F.lit(0.0)) / 3600).alias("total_hours"), F.coalesce(F.avg(d), F.lit(0.0)).alias("avg_seconds"))


def speaker_stats(df: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    return df.groupBy(*by).agg(F.min(start).alias("first_start_time"), F.sum(F.greatest(F.lit(0.0), F.col(end) - F.col(start))).alias("cumulative_duration"), F.count("*").alias("segment_count"))


def tag_counts(df: DataFrame, text: str, pattern: str = r"\b([A-Z]+_[A-Z0-9_]+)\b") -> DataFrame:
    """tag, prefix, n of every tag in the texts."""
    tags = df.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), 1)).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n")).withColumn("prefix", F.split_part("tag", F.lit("_"), F.lit(1)))


def prefix_counts(df: DataFrame, text: str) -> DataFrame:
    """Distinct tags per prefix."""
    return tag_counts(df, text).groupBy("prefix").agg(F.count("*").alias("tags"))


def label_vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Sorted distinct tags of each prefix, comma-joined. The vocabulary of tags is small by nature; texts never meet in one task."""
    return tag_counts(df, text).groupBy("prefix").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("labels"))


def route_counts(df: DataFrame, route: str = "route") -> DataFrame:
    """n and share of each route."""
    counts = df.groupBy(route).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))  # one row
    return counts.join(F.broadcast(total)).select(route, "n", (F.col("n") / F.col("_all")).alias("share"))


def changes(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """For each name, how many rows differ between before and after."""
    return df.agg(*[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(n) for n, (a, b) in pairs.items()])


def word_counts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def error_summary(df: DataFrame, by: list[str], error: str, order: str) -> DataFrame:
    """Errors of each group in order, joined by '; '. A group's errors are one text, and have to fit in one row."""
    return df.where(F.col(error).isNotNull()).groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(error).alias("e")))), lambda s: s["e"]), "; ").alias("errors"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def common_prefix(df: DataFrame, c: str) -> DataFrame:
    """The longest common prefix of a column, from its least and greatest values."""
    ends = df.agg(F.min(c).alias("a"), F.max(c).alias("b"))
    same = F.filter(F.sequence(F.lit(0), F.length("a")), lambda k: F.substr(F.col("a"), F.lit(1), k) == F.substr(F.col("b"), F.lit(1), k))
    return ends.select(F.substr(F.col("a"), F.lit(1), F.array_max(same)).alias("prefix"))

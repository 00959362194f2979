"""WebVTT files to cues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.buckets import timestamp_seconds
from voxloom.functions.tags import squeeze

# Fixed value: the times of a cue, as the format has them.
_TIMES = r"^(\d{2}:\d{2}:\d{2}\.\d{3}) --> (\d{2}:\d{2}:\d{2}\.\d{3})"


def drop_equal_neighbours(lines: Column) -> Column:
    return F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1)))


def parse_cues(text: Column) -> Column:
    """array of (pos, start, end, text): blocks between blank lines that begin with times; equal neighbouring lines, inline times and <c> marks out; cues without text are none."""
    body = F.regexp_replace(F.regexp_replace(text, "^\\ufeff", ""), r"\r\n?", "\n")
    body = F.regexp_replace(body, rf"(?m)(?={_TIMES})", "\n\n")  # times start a block even without a blank line
    blocks = F.transform(F.split(body, r"\n\s*\n"), lambda b: F.filter(F.split(b, "\n"), lambda x: F.trim(x) != ""))
    timed = F.filter(blocks, lambda b: F.coalesce(F.trim(F.get(b, F.lit(0))).rlike(_TIMES), F.lit(False)))

    def cue(b: Column, i: Column) -> Column:
        said = F.filter(F.slice(b, F.lit(2), F.greatest(F.size(b) - 1, F.lit(0))), lambda x: ~(x.rlike("^(WEBVTT|Kind:|Language:)") | x.contains("align:") | x.contains("position:") | x.contains("line:")))
        clean = F.regexp_replace(F.regexp_replace(F.array_join(drop_equal_neighbours(said), " "), r"</?c>", ""), r"<\d{2}:\d{2}:\d{2}\.\d{3}>", "")
        at = lambda k: timestamp_seconds(F.regexp_extract(F.trim(b[0]), _TIMES, k))
        return F.struct(i.alias("pos"), at(1).alias("start"), at(2).alias("end"), squeeze(clean).alias("text"))

    return F.filter(F.transform(timed, cue), lambda c: c["text"] != "")


def read_vtt(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, start, end, text of each cue."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.inline(parse_cues(F.col("value"))))

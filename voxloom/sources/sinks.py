"""Writers: JSON lines, CSV, routed and batched output, resumable appends."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.paths import basename
from voxloom.operators.windows import number_rows


def write_json_lines(df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "overwrite") -> None:
    """One object per line in the order of the columns; nulls are left out unless kept."""
    df.write.mode(mode).option("ignoreNullFields", not keep_nulls).json(path)


def write_json_array(df: DataFrame, path: str, rows: int = 10_000) -> None:
    """Files that each hold one array of at most so many objects, one a line, without null fields; coalesce(1) before it for a single file of few rows."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= rows:
                yield pa.RecordBatch.from_arrays([pa.array(["[\n" + ",\n".join(held[:rows]) + "\n]"])], ["value"])
                del held[:rows]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(["[\n" + ",\n".join(held) + "\n]"])], ["value"])

    df.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(arrays, "value string").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_csv(df: DataFrame, path: str, decimals: int | None = None) -> None:
    """With a header; quotes in values doubled; doubles rounded half to even."""
    columns = [F.bround(c, decimals).alias(c) if decimals is not None and t == "double" else F.col(c) for c, t in df.dtypes]
    df.select(*columns).write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_routed(df: DataFrame, path: str, route: str = "route", mode: str = "overwrite") -> None:
    """One folder per route (or language), in one pass; empty routes have none."""
    df.write.mode(mode).partitionBy(route).json(path)


def write_batches(df: DataFrame, path: str, rows: int) -> None:
    """Files of at most so many rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).json(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the sink doesn't hold yet; a first run creates it."""
    spark = df.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath):
        df = df.join(spark.read.parquet(path).select(key), key, "left_anti")
    df.write.mode("append").parquet(path)


def removed_rows(df: DataFrame, kept: Column, path: str = "audio_filepath", text: str = "text", sample: int = 100) -> DataFrame:
    """The log of what a filter drops: path and a sample of the text."""
    return df.where(~F.coalesce(kept, F.lit(False))).select(path, F.substring(text, 1, sample).alias("sample"))


def batch_numbers(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows with batch, the number from 1 of their batch of size rows in a total order."""
    return number_rows(df, order, "_row").withColumn("batch", F.expr(f"(_row - 1) div {size} + 1")).drop("_row")


def batch_requests(df: DataFrame, key: str, text: str, size: int, model: str, prompt: str) -> DataFrame:
    """Request lines for a batch service: custom_id and the texts of size consecutive keys (key div size), in order."""
    rows = df.groupBy(F.expr(f"`{key}` div {size}").alias("batch")).agg(F.array_sort(F.collect_list(F.struct(key, text))).alias("rows"))
    body = F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")), F.struct(F.lit("user").alias("role"), F.array_join(F.transform("rows", lambda r: r[text]), "\n").alias("content"))).alias("messages"))
    return rows.select(F.concat(F.lit("request-"), F.col("batch")).alias("custom_id"), F.size("rows").alias("n"), F.to_json(body).alias("body"))


def with_metadata_json(df: DataFrame, media: str) -> DataFrame:
    """media bytes kept, all other columns as one JSON metadata column (nested ones as strings)."""
    flat = [F.col(c) if t in ("string", "int", "bigint", "double", "float", "boolean") else F.col(c).cast("string").alias(c) for c, t in df.dtypes if c != media and t != "binary"]
    return df.select(media, F.to_json(F.struct(*flat)).alias("metadata"))


def transcripts_map(df: DataFrame, file: str, text: str) -> DataFrame:
    """One JSON object of file to transcript for each folder of files; the last of equal files wins by text. A folder's object is one row, and has to fit in one."""
    folder = F.regexp_extract(F.col(file), "^(.*/)?[^/]*$", 1)
    pairs = df.groupBy(folder.alias("folder"), basename(F.col(file)).alias("f")).agg(F.max(text).alias("t"))
    return pairs.groupBy("folder").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("f", "t"))))).alias("value"))


def predicted_text_dump(df: DataFrame, predicted: str = "predicted_text") -> DataFrame:
    return df.where(F.trim(F.coalesce(F.col(predicted), F.lit(""))) != "").select(F.col(predicted).alias("value"))


def relocate(df: DataFrame, listing: DataFrame, target: str, path: str = "audio_filepath") -> DataFrame:
    """The file moves of a list: old and new path for files that exist; rows without a file keep theirs. Moving is the caller's."""
    there = listing.select(F.col("path").alias(path)).distinct().withColumn("_there", F.lit(True))
    return df.join(there, path, "left").withColumn("new_path", F.when(F.col("_there"), F.concat(F.lit(target.rstrip("/") + "/"), basename(F.col(path)))).otherwise(F.col(path))).drop("_there")

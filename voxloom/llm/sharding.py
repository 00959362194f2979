"""Contiguous shards of near-equal bytes by global prefix sums.

Rows are range-partitioned by id (ties by checksum, size and a running number, so that a repeated id spreads over
partitions). Each partition sums its bytes and rows; the driver adds up these totals, one pair for each partition,
and sends the offsets back; a running sum inside each partition plus its offset is the global prefix sum. A row goes
to the shard in whose equal target interval its middle byte falls, so every shard is within one row of its target.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common


def shard_by_bytes(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard (0 to shards - 1), slot (from 0 without gaps in each shard).

    size: UTF-8 bytes plus overhead (null text: overhead alone, checksum 0). Shards follow the order of ids, nulls
    first; equal ids are told apart by checksum and size, and rows alike in all three are interchangeable. An empty
    table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = common.staged(df.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc")), "sizes")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = slim.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, "id", "crc", "size", "tie")
    ranged = common.staged(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    totals = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.sum("size"), F.count("*")).collect())  # one row for each partition
    offsets = list(zip((p for p, _, _ in totals), accumulate((s for _, s, _ in totals), initial=0), accumulate((c for _, _, c in totals), initial=0)))
    total = max(1, sum(s for _, s, _ in totals))
    table = df.sparkSession.createDataFrame(offsets, "part int, byte0 long, row0 long")
    before = Window.partitionBy("part").orderBy("id", "crc", "size", "tie")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, 0))).withColumn("nth", F.row_number().over(before))
        .join(F.broadcast(table), "part")
        .withColumn("row", F.col("row0") + F.col("nth") - 1)
        .withColumn("twice", 2 * (F.col("byte0") + F.col("upto")) - F.col("size"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"twice * {shards} div {2 * total}")).cast("int"))
    )
    placed = common.staged(placed.select("id", "size", "crc", "shard", "row"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("first")).alias("slot"))

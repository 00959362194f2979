"""Helpers that the training-data operators share: Arrow batch maps, checked broadcasts, free names; tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.batches import small_batches  # noqa: F401  operators take it from here
from voxloom.staging import drop, settled, shared_dir, staged  # noqa: F401  operators take them from here

#: A table is broadcast only if its values have at most this many bytes in all.
BROADCAST_BYTES = 16 << 20


def map_batches(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow with one output batch for each input batch."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield kernel(batch)

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """Texts as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def maybe_broadcast(df: DataFrame, size: int) -> DataFrame:
    """Hint a broadcast if the counted bytes are few; else the join shuffles, and AQE splits skewed keys."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


#: Bits a key in a filter of hashed keys, and bits that one such filter may have: 32 MB.
KEY_BITS, MOST_BITS = 12, 1 << 28


def key_filters(keys: DataFrame, c: str, most_parts: int | None = None) -> Iterator[np.ndarray]:
    """Filters that together hold all keys (64-bit hashes), sized by their count: none for no keys, more than one where one would be too large. More than most_parts, and there is none either."""
    n = keys.count()
    parts = -(-n * KEY_BITS // MOST_BITS)
    if most_parts is not None and parts > most_parts:
        return
    size = 1 << max(16, (-(-n // max(1, parts)) * KEY_BITS - 1).bit_length())
    at = F.explode(F.array(F.col(c).bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned(c, 32).bitwiseAND(F.lit(size - 1)))).alias("at")
    for part in range(parts):
        own = keys.where(F.pmod(F.xxhash64(c), F.lit(parts)) == part).select(at)
        words = own.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toPandas()
        out = np.zeros(size // 64, np.int64)
        out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
        yield out


def key_in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a filter of key_filters may hold keys; it holds all of its own."""
    mask = np.uint64(64 * len(bits) - 1)
    keys = keys.view(np.uint64)
    out = np.ones(len(keys), bool)
    for at in (keys & mask, keys >> np.uint64(32) & mask):
        at = at.astype(np.int64)
        out &= (bits[at >> 6] >> (at & 63) & 1).astype(bool)
    return out


def threshold(share: float) -> int:
    """The xxhash64 up to which a share of all hashes lies; to sample rows, xxhash64(id) <= threshold(share), at every size."""
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))


def free_name(taken: list[str], name: str) -> str:
    """A column name that doesn't clash with those taken (without regard to case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name

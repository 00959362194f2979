"""Hierarchical packing of documents into windows of several lengths.

Whole windows of the longest tier are cut from the front of long documents. What is left of each document is routed to
the shortest tier that holds it. Tiers are packed from the longest down: a window starts with the longest waiting
document of its tier, is filled with the longest documents of its own and shorter tiers that fit, and its last gap with the head
of one that does not, whose rest waits in its own tier. So windows are full; those that could not be filled wait for
the next round of the partition, and the last ones are cut into powers of two. Windows of a round are dealt to step
groups of a stated number of tokens, longest first to the least loaded. Partitions pack on their own: nothing is
shuffled, a lost task is packed again from its input, and memory is bounded by the documents of one round.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

#: The pattern of the byte-level pre-tokenizer (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TIERS = (2048, 1024, 512, 256)


class Packer:
    """Packs pieces (length, document, start) of one partition; round(final) gives finished windows as lists of pieces."""

    def __init__(self, tiers=TIERS):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.pools: dict[int, list] = {t: [] for t in self.tiers}

    def tier(self, length: int) -> int:
        return min(t for t in self.tiers if t >= length)

    def add(self, length: int, doc: int, start: int, windows: list) -> None:
        """Cut whole longest windows into windows, and let the rest wait."""
        longest = self.tiers[0]
        while length >= longest:
            windows.append([(longest, doc, start)])
            length, start = length - longest, start + longest
        if length:
            insort(self.pools[self.tier(length)], (length, doc, start))

    def _largest(self, room: int, tiers) -> tuple | None:
        for t in tiers:
            pool = self.pools[t]
            if at := bisect_right(pool, (room, float("inf"), 0)):
                return pool.pop(at - 1)
        return None

    def _over(self, room: int, tiers) -> tuple | None:
        """The shortest waiting piece that is longer than room."""
        for t in reversed(tiers):
            pool = self.pools[t]
            if (at := bisect_left(pool, (room + 1, -1, 0))) < len(pool):
                return pool.pop(at)
        return None

    def round(self, final: bool) -> list[list[tuple]]:
        windows, waiting = [], []
        for k, size in enumerate(self.tiers):
            lower = self.tiers[k:]
            while self.pools[size]:
                window = [self.pools[size].pop()]
                room = size - window[0][0]
                while room and (piece := self._largest(room, lower)):
                    window.append(piece)
                    room -= piece[0]
                if room and (piece := self._over(room, lower)):
                    window.append((room, *piece[1:]))
                    rest = piece[0] - room
                    insort(self.pools[self.tier(rest)], (rest, piece[1], piece[2] + room))
                    room = 0
                (waiting if room else windows).append(window)
        left = [piece for window in waiting for piece in window]
        if not final:
            for piece in left:
                insort(self.pools[self.tier(piece[0])], piece)
            return windows
        total = sum(p[0] for p in left)
        sizes = [self.tiers[0]] * (total // self.tiers[0]) + [1 << b for b in range(self.tiers[0].bit_length(), -1, -1) if total % self.tiers[0] >> b & 1]
        for size in sizes:
            window, room = [], size
            while room:
                length, doc, start = left.pop()
                take = min(room, length)
                window.append((take, doc, start))
                if take < length:
                    left.append((length - take, doc, start + take))
                room -= take
            windows.append(window)
        return windows


_ENCODERS: dict[tuple[bytes, str], tuple] = {}


def encoder_of(vocabulary: bytes, pattern: str) -> tuple[tokens.ChunkCache, dict[bytes, bytes], re.Pattern]:
    """Chunks to their ids, added tokens to theirs, and the split of a text by these; one at a time for each Python worker, whose tasks share the bounded cache."""
    key = hashlib.sha256(vocabulary).digest(), pattern
    if key not in _ENCODERS:
        encoding = tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=tokens.load_ranks(vocabulary), special_tokens={})
        added = {text: array("I", [i]).tobytes() for text, i in tokens.load_added(vocabulary).items()}
        _ENCODERS.clear()
        _ENCODERS[key] = tokens.ChunkCache(lambda chunk: array("I", encoding.encode_ordinary(chunk.decode())).tobytes()), added, tokens.splitter(added)
    return _ENCODERS[key]


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """The group of each window: longest first to the group with the fewest tokens."""
    loads = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heapq.heappop(loads)
        out[i] = g
        heapq.heappush(loads, (load + sizes[i], g))
    return out


def pack_documents(df: DataFrame, vocabulary: str, pattern: str = PATTERN, end_id: int = 1, tiers=TIERS, step_tokens: int = 1 << 16, round_docs: int = 2000, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids (if keep_ids).

    A document is the ids of its text and then end_id; a null or empty text is end_id alone. The vocabulary's added tokens
    are matched in texts and keep their ids, as tokenizers does by default. Every id lies in one piece; offsets of a sequence are without gaps. Sequences are as long as a tier,
    but for at most one of each power of two in a partition. Rows with equal or null ids are documents of their own,
    told apart by their pieces alone. step_group: groups of about step_tokens tokens for one training step. vocabulary:
    a path on the driver. Other columns are not read.
    """
    data = df.sparkSession.sparkContext.broadcast(tokens.read_file(vocabulary))
    common.small_batches(df.sparkSession)
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", *(["ids"] if keep_ids else [])]
    kinds = [*[pa.int64()] * 7, pa.int32(), pa.int64(), *([pa.binary()] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, added, by_added = encoder_of(data.value, pattern)

        def ids_of(text: bytes) -> bytes:
            return b"".join([x for i, part in enumerate(by_added.split(text)) for x in ((added[part],) if i % 2 else cache.values_of(part))])

        end, base = array("I", [end_id]).tobytes(), TaskContext.get().partitionId() << 36
        packer, docs, next_doc, sequence, group = Packer(tiers), {}, 0, base, base

        def rows(windows):
            nonlocal sequence, group
            out = [[] for _ in names]
            groups = step_groups([sum(p[0] for p in w) for w in windows], step_tokens)
            for window, g in zip(windows, groups):
                offset, size = 0, sum(p[0] for p in window)
                for length, doc, start in window:
                    name, ids, left = docs[doc]
                    part = ids[4 * start : 4 * (start + length)]
                    row = [name, start, length, zlib.crc32(part), len(ids) // 4, sequence, offset, size, group + g, *([part] if keep_ids else [])]
                    for column, value in zip(out, row):
                        column.append(value)
                    offset += length
                    if left == length:
                        del docs[doc]
                    else:
                        docs[doc] = name, ids, left - length
                sequence += 1
            group += max(groups, default=-1) + 1
            for i in range(0, len(out[0]), 5000):
                columns = [pa.array(c[i : i + 5000], k) for c, k in zip(out, kinds)]
                if keep_ids:
                    ends = np.cumsum([0, *out[2][i : i + 5000]]).astype(np.int32)
                    columns[-1] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(out[-1][i : i + 5000]), np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names)

        windows, waiting = [], 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), common.utf8(batch.column(1))):
                ids = ids_of(text or b"") + end
                docs[next_doc] = name, ids, len(ids) // 4
                packer.add(len(ids) // 4, next_doc, 0, windows)
                next_doc, waiting = next_doc + 1, waiting + len(ids)
                if next_doc % round_docs == 0 or waiting > 32 << 20:
                    yield from rows(windows + packer.round(False))
                    windows, waiting = [], 0
        yield from rows(windows + packer.round(True))

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long" + (", ids array<int>" if keep_ids else "")
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)

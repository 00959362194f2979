"""Token counts that follow edits.

A document is cut into chunks at every space that a non-space follows, which always is a pre-token boundary; the leaves
of a segment tree hold the bytes and tokens of runs of such pre-tokens, inner nodes hold the sums of their subtrees.
An edit re-encodes only the leaves that it touches, with one boundary of context on either side, and updates the sums
on the paths above them. If a region grows by more chunks than it had leaves, its last leaf takes the surplus; a leaf
that has become too long by that makes the tree be built anew, which encodes the whole document. A chunk that is long of
itself (no space in it) is one leaf at any length, and only it is encoded when an edit touches it.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


def counter(vocabulary: bytes, pattern: str) -> tokens.ChunkCache:
    """Chunks to their bytes and tokens, packed as two unsigned 32-bit integers."""
    encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=tokens.load_ranks(vocabulary), special_tokens={})
    return tokens.ChunkCache(lambda chunk: struct.pack("<II", len(chunk), len(encoding.encode_ordinary(chunk.decode()))))


class TokenTree:
    """The segment tree of one document; reencoded counts the bytes that edits have encoded anew."""

    def __init__(self, text: bytes, cache: tokens.ChunkCache, longest_leaf: int = 4096, leaves: bytes | None = None):
        """leaves: what pack() gave for this text; then nothing is encoded."""
        self.text, self.cache, self.longest_leaf, self.reencoded = bytearray(text), cache, longest_leaf, 0
        self._build(None if leaves is None else np.frombuffer(leaves, "<u4").reshape(-1, 2).astype(np.int64))

    def pack(self) -> bytes:
        """Bytes and tokens of the leaves, eight bytes a leaf."""
        return self.tree[self.half : self.half + self.n].astype("<u4").tobytes()

    def _leaves(self, text: bytes) -> np.ndarray:
        return np.frombuffer(b"".join(self.cache.values_of(text)), "<u4").reshape(-1, 2).astype(np.int64)

    def _build(self, leaves: np.ndarray | None = None) -> None:
        leaves = self._leaves(bytes(self.text)) if leaves is None else leaves
        self.n = len(leaves)
        self.half = 1 << max(0, (self.n - 1).bit_length())
        self.tree = np.zeros((2 * self.half, 2), np.int64)
        self.tree[self.half : self.half + self.n] = leaves
        level = self.half
        while level > 1:
            self.tree[level // 2 : level] = self.tree[level : 2 * level : 2] + self.tree[level + 1 : 2 * level : 2]
            level //= 2

    @property
    def total(self) -> int:
        return int(self.tree[1, 1])

    def _leaf_at(self, offset: int) -> tuple[int, int]:
        """The leaf that holds the byte at offset, and where it starts."""
        node, start, tree = 1, 0, self.tree
        while node < self.half:
            node *= 2
            if offset - start >= (left := int(tree[node, 0])):
                start += left
                node += 1
        return node - self.half, start

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes start to end (at code point boundaries) and return the new number of tokens."""
        size = len(self.text)
        start, end = max(0, min(start, size)), max(0, min(end, size))
        end = max(start, end)
        if self.n == 0 or size == 0:
            self.text = bytearray(new)
            self.reencoded += len(new)
            self._build()
            return self.total
        first, left = self._leaf_at(min(max(0, start - 2), size - 1))
        if end >= size:
            last, right = self.n - 1, size
        else:
            last, at = self._leaf_at(end)
            right = at + int(self.tree[self.half + last, 0])
            if at == end and last > first:
                last, right = last - 1, at
        region = bytes(self.text[left:start]) + new + bytes(self.text[end:right])
        self.text[start:end] = new  # in place
        self.reencoded += len(region)
        fresh, slots = self._leaves(region), last - first + 1
        put = np.zeros((slots, 2), np.int64)
        put[: min(slots, len(fresh))] = fresh[:slots]
        if len(fresh) > slots:
            put[-1] += fresh[slots:].sum(axis=0)
        if len(fresh) > slots and put[-1, 0] > max(self.longest_leaf, 2 * len(self.text) // max(1, self.n)):
            self.reencoded += len(self.text)
            self._build()
            return self.total
        a, b = self.half + first, self.half + last
        self.tree[a : b + 1] = put
        while a > 1:
            a, b = a // 2, b // 2
            self.tree[a : b + 1] = self.tree[2 * a : 2 * b + 2 : 2] + self.tree[2 * a + 1 : 2 * b + 2 : 2]
        return self.total


def byte_at(text: bytes | bytearray, n: int) -> int:
    """Where the n-th code point begins; the end if there are fewer."""
    raw, step = np.frombuffer(text, np.uint8), 1 << 18
    for a in range(0, len(raw), step):
        begins = np.flatnonzero(raw[a : a + step] & 0xC0 != 0x80)
        if n < len(begins):
            return a + int(begins[n])
        n -= len(begins)
    return len(raw)


def apply_edits(tree: TokenTree, edits: list | None) -> None:
    """Edits (start, end, text) in code points, one after the other."""
    ascii_only = tree.text.isascii()
    for e in edits or ():
        if e is None:
            continue
        a, new = max(0, e["start"] or 0), (e["text"] or "").encode()
        b = max(a, e["end"] or 0)
        if not ascii_only:
            a, b = byte_at(tree.text, a), byte_at(tree.text, b)
        tree.edit(a, b, new)
        ascii_only = ascii_only and new.isascii()


def token_trees(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text, n_tokens, tree (the leaves of its segment tree), to be kept and edited later by edit_trees. A null text is empty."""
    held, data = [], df.sparkSession.sparkContext.broadcast(tokens.read_file(vocabulary))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(counter(data.value, pattern))
        trees = [TokenTree(t, held[0]) for t in common.utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.total for t in trees], pa.int64()), pa.array([t.pack() for t in trees], pa.binary())], ["id", "text", "n_tokens", "tree"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return common.map_batches(src, kernel, "id long, text string, n_tokens long, tree binary").withColumnRenamed("id", id_col)


def edit_trees(trees: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", edits_col: str = "edits") -> DataFrame:
    """Rows of token_trees with edits: id, the edited text, its n_tokens and tree, reencoded_bytes. Only the regions that edits touch are encoded; edits as in count_tokens. What it gives can be edited again."""
    held, data = [], trees.sparkSession.sparkContext.broadcast(tokens.read_file(vocabulary))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(counter(data.value, pattern))
        out = []
        for text, leaves, edits in zip(common.utf8(batch.column(1)), *(batch.column(i).to_pylist() for i in (2, 3))):
            out.append(tree := TokenTree(text, held[0], leaves=leaves))
            apply_edits(tree, edits)
        made = [([t.text.decode() for t in out], pa.string()), ([t.total for t in out], pa.int64()), ([t.pack() for t in out], pa.binary()), ([t.reencoded for t in out], pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in made]], ["id", "text", "n_tokens", "tree", "reencoded_bytes"])

    src = trees.select(F.col(id_col).alias("id"), "text", "tree", F.col(edits_col).cast(EDITS).alias("edits"))
    return common.map_batches(src, kernel, "id long, text string, n_tokens long, tree binary, reencoded_bytes long").withColumnRenamed("id", id_col)


def count_tokens(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None) -> DataFrame:
    """One row per input row: id, n_tokens, n_leaves, and with edits edited_tokens, edited_bytes, reencoded_bytes.

    edits_col: array of (start, end, text) in code points, applied in order, each to what the one before has left;
    places beyond the text are its end, a null array or null fields stand for no edit, 0 and ''. A null or empty text
    has no tokens. Rows are independent; other columns are not read. vocabulary is a path on the driver.
    """
    held, data = [], df.sparkSession.sparkContext.broadcast(tokens.read_file(vocabulary))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(counter(data.value, pattern))
        out = [[] for _ in range(5)]
        for text, edits in zip(common.utf8(batch.column(1)), batch.column(2).to_pylist()):
            tree = TokenTree(text or b"", held[0])
            row = [tree.total, tree.n]
            apply_edits(tree, edits)
            for column, value in zip(out, (*row, tree.total, len(tree.text), tree.reencoded)):
                column.append(value)
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out)], ["id", "n_tokens", "n_leaves", "edited_tokens", "edited_bytes", "reencoded_bytes"])

    edits = F.col(edits_col).cast(EDITS) if edits_col else F.lit(None).cast(EDITS)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), edits.alias("edits"))
    out = common.map_batches(src, kernel, "id long, n_tokens long, n_leaves long, edited_tokens long, edited_bytes long, reencoded_bytes long")
    return (out if edits_col else out.select("id", "n_tokens", "n_leaves")).withColumnRenamed("id", id_col)

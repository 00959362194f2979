"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is one token that can stand last in the encoding of that prefix. It is the one
token that ends there, that follows on the last token of the prefix before it, and whose pair with that token encodes
to itself. The table of last tokens gives the encoding by walking back; bytes may be appended exactly, and after an
edit the table is computed anew only until it agrees with the old one over the length of the longest token.
Pre-tokens (matches of the pattern) are encoded separately.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens


#: Lengths of prefixes whose tables of last tokens are kept for other pieces that begin alike.
STOPS = (10, 7, 4)


class Codec:
    """Encoder and decoder over ranks; pairs: most remembered answers about pairs of tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: int = 1 << 19, limit: int = 250_000):
        self.ranks, self.pattern, self.most_pairs, self.limit = ranks, regex.compile(pattern), pairs, limit
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.pieces = tokens.TwoAges(self._piece, limit)
        self.prefixes: dict[bytes, tuple[int, ...]] = {}
        #: Every suffix of a token that merges reach, to that token's id or -1: a miss ends the search for longer tokens.
        self.suffixes: dict[bytes, int] = {}
        #: The right and left edges of a token's merges: (bytes, rank of the merge that takes them up, that of the merge that made them) from the token down to a byte.
        self.right: dict[int, list[tuple[bytes, float, int]]] = {}
        self.left: dict[int, list[tuple[bytes, float, int]]] = {}
        parts_of = {}
        for b, i in ranks.items():
            parts = self.merged(b, 2)
            if len(b) == 1 or len(parts) == 2:
                parts_of[i] = parts
                for k in range(1, len(b)):
                    self.suffixes.setdefault(b[k:], -1)
                self.suffixes[b] = i
        for i in parts_of:
            for side, edges in ((-1, self.right), (0, self.left)):
                at, up, edge = i, float("inf"), []
                while True:
                    edge.append((self.bytes_of[at], up, at if len(self.bytes_of[at]) > 1 else -1))
                    if len(parts_of[at]) < 2:
                        break
                    at, up = parts_of[at][side], at
                edges[i] = edge
        self.cache = tokens.ChunkCache(self._chunk, limit)
        #: Decimal ids, as they stand in lines, to their bytes.
        self.named = {b"": b""} | {b"%d" % i: b for i, b in self.bytes_of.items()}

    def merged(self, piece: bytes, stop: int = 1) -> list[int]:
        """Plain merging by rank until stop parts are left, for what tokens are made of."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        if (known := self.pairs.get(a << 24 | b)) is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            known = self.pairs[a << 24 | b] = self._stays(a, b)
        return known

    def _stays(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives a and b: no merge across their border comes before the merges that take up its two sides."""
        ranks = self.ranks
        for x, x_up, x_made in self.right[a]:
            for y, y_up, y_made in self.left[b]:
                if x_made < y_up and y_made <= x_up and (r := ranks.get(x + y)) is not None and max(r, x_made, y_made) < x_up and max(r, x_made, y_made) <= y_up:
                    return False
        return True

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Fill in the last tokens of the prefixes of data up to upto bytes; last[i] belongs to the prefix of i + 1 bytes."""
        suffixes, pairs = self.suffixes.get, self.pairs.get
        for end in range(len(last) + 1, upto + 1):
            for start in range(end - 1, -1, -1):
                token = suffixes(data[start:end])
                if token is None:
                    raise ValueError("the vocabulary lacks a byte")
                if token >= 0:
                    if start == 0:
                        break
                    before = last[start - 1]
                    ok = pairs(before << 24 | token)
                    if ok or ok is None and self.compatible(before, token):
                        break
            last.append(token)

    def walk(self, last: list[int], end: int | None = None) -> list[int]:
        out, at = [], len(last) if end is None else end
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token; a piece that is a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n, prefixes = len(piece), self.prefixes
        for at in STOPS:
            if at < n and (known := prefixes.get(piece[:at])) is not None:
                last = list(known)
                break
        else:
            at, last = 0, []
        self.extend(piece, last, n)
        if n > STOPS[-1]:
            if len(prefixes) >= self.limit:
                prefixes.clear()
            for k in STOPS:
                if at < k < n:
                    prefixes[piece[:k]] = tuple(last[:k])
        out, at, bytes_of = [], n, self.bytes_of
        while at:
            token = last[at - 1]
            out.append(token)
            at -= len(bytes_of[token])
        out.reverse()
        return out

    def _piece(self, piece: str) -> bytes:
        return b",".join([b"%d" % i for i in self.encode_piece(piece.encode())])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if text[1:].isalpha() and text[0] == " ":  # one pre-token: a space and letters
            return self.pieces[text]
        return b",".join([self.pieces[piece] for piece in self.pattern.findall(text)])

    def encode_parts(self, text: bytes) -> list[bytes]:
        """The ids of a text in decimal, comma-joined, in parts whose joint is a comma too."""
        return self.cache.values_of(text)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in b",".join(self.encode_parts(text.encode())).split(b",") if i]

    def decode_line(self, line: bytes) -> bytes:
        """The bytes of decimal, comma-joined ids."""
        return b"".join(map(self.named.__getitem__, line.split(b",")))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids)


class PrefixTable:
    """The last tokens of all prefixes of one pre-token's bytes; may grow and be edited."""

    def __init__(self, codec: Codec, data: bytes = b""):
        self.codec, self.data, self.last = codec, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.codec.extend(self.data, self.last, len(self.data))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes start to end; returns the number of prefixes computed anew."""
        old, shift, longest = self.last, len(new) - (end - start), self.codec.longest
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        at, same = start, 0
        while at < len(self.data) and same < longest:
            at += 1
            self.codec.extend(self.data, self.last, at)
            same = same + 1 if at - shift > end and self.last[-1] == old[at - 1 - shift] else 0
        self.last += old[at - shift :]
        return at - start

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the whole, or of its first end bytes."""
        return self.codec.walk(self.last, end)


_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec_of(vocabulary: bytes, pattern: str) -> Codec:
    """The codec of a vocabulary, one at a time for each Python worker: the tasks that a worker runs share its tables and caches, whose sizes are bounded."""
    key = hashlib.sha256(vocabulary).digest(), pattern
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens.load_ranks(vocabulary), pattern)
    return _CODECS[key]


def _shared(spark, path: str):
    return spark.sparkContext.broadcast(tokens.read_file(path))


def encode_texts(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per input row: id, ids (array, if keep_ids), n_tokens, ids_sha256, decoded_sha256.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the bytes that the ids decode to. A null or
    empty text has no ids. vocabulary is a path on the driver. Rows are independent; other columns are not read.
    """
    held, data = [], _shared(df.sparkSession, vocabulary)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(codec_of(data.value, pattern))
        codec, n, all_ids, sums, decoded = held[0], [], [], [], []
        for text in common.utf8(batch.column(1)):
            line = b",".join(codec.encode_parts(text or b""))
            n.append(line.count(b",") + 1 if line else 0)
            sums.append(hashlib.sha256(line).hexdigest())
            decoded.append(hashlib.sha256(codec.decode_line(line)).hexdigest())
            if keep_ids:
                all_ids.append([int(i) for i in line.split(b",") if i])
        columns = [batch.column(0), *([pa.array(all_ids, pa.list_(pa.int32()))] if keep_ids else []), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["id", *(["ids"] if keep_ids else []), "n_tokens", "ids_sha256", "decoded_sha256"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return common.map_batches(src, kernel, f"id long, {'ids array<int>, ' if keep_ids else ''}n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, data (the bytes of the ids; null where ids is null)."""
    held, raw = [], _shared(df.sparkSession, vocabulary)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append({i: b for b, i in tokens.load_ranks(raw.value).items()})
        out = [None if ids is None else b"".join(held[0][i] for i in ids) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "data"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return common.map_batches(src, kernel, "id long, data binary").withColumnRenamed("id", id_col)

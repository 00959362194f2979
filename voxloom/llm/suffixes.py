"""Removal of long repeated byte strings by merging Burrows-Wheeler transforms of shards.

Every window of `length` bytes names a core: of its first REACH + 1 places the one whose next bytes hash least, and from there length - REACH bytes. Equal windows name equal cores at the
same place, so a window whose core is nowhere else is nowhere else. Cores are counted; around those that repeat, the windows that name them are kept as segments, the bytes to the left and to the
right of the core. Equal segments of a core are one with a count, and segments are dealt to tasks by their cores.

A task takes some cores at a time. Their segments, as strings of one width with one symbol for the core, are split into shards. Each shard gets its suffix order and its
transform: before each suffix, in order, the eight symbols that precede it. The shards' transforms are then merged without sorting suffixes again: the interleave of the shards by the first symbol
is refined, eight symbols a step, by dealing its entries out stably by the word that precedes them, until it is the order by REACH + 1 symbols. Borders that a step adds are where the common prefix of
neighbours ends; what no border divides is an interval of a repeated string. A window is REACH bytes and its core, so it occurs again if another stands in its interval.

Texts that repeat wholly go wholly, and one of them stands for all. Segments that occur twice or more need no merge: all their windows do. A core with more different segments than a task should hold has its windows grouped one by one instead, by 128 bits of hash; the rest
is exact up to 128 bits of hash for texts, cores and segments.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Windows of one core begin in so many places before it, at most, and one more.
REACH = 64
#: Width of a segment's string: the left bytes, the core's symbol, the right bytes, made full to words of eight symbols.
WORD = 8
WIDTH = -(-(2 * REACH + 1) // WORD) * WORD
_LEFT, _RIGHT, _CORE = 0xFE, 0xFD, 0xFF
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_PLACES = 1 << 18


def cores(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the cores of a text's windows begin, with the first and the last window that names each. Memory is bounded: windows are taken a block at a time."""
    n, out = len(text) - length + 1, []
    for a in range(0, max(0, n), _PLACES):
        m = min(_PLACES, n - a) + REACH  # places of this block's windows
        h = np.ndarray((m,), "<u8", text, a, (1,)) * _M1
        h ^= h >> np.uint64(31)
        h *= _M2
        h &= np.uint64(0xFFFFFFFF00000000)
        h |= np.uint64(0xFFFFFFFF) - np.arange(m, dtype=np.uint64)  # of equal ones the last
        span = 1
        while span <= REACH:  # least of REACH + 1 neighbours
            step = min(span, REACH + 1 - span)
            h = np.minimum(h[:-step], h[step:])
            span += step
        at = (np.uint64(0xFFFFFFFF) - (h & np.uint64(0xFFFFFFFF))).astype(np.int64) + a
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out.append((at[first], first + a, np.append(first[1:], len(at)) - 1 + a))
    if not out:
        return (np.empty(0, np.int64),) * 3
    at, first, last = (np.concatenate(x) for x in zip(*out))
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))  # not a block's border within the windows of one core
    return at[new], first[new], last[np.append(new[1:], len(at)) - 1]


def _keys(text: bytes, at: np.ndarray, size: int) -> np.ndarray:
    view, digest = memoryview(text), xxhash.xxh3_64_intdigest
    return np.array([digest(view[p : p + size]) for p in at.tolist()], np.uint64).view(np.int64)


def _counted(df: DataFrame, length: int) -> DataFrame:
    """key: cores that occur more than once, or share 64 bits of hash."""

    def run(batches):
        for batch in batches:
            keys = [_keys(t, cores(t, length)[0], length - REACH) for t in common.utf8(batch.column(0)) if t is not None and len(t) >= length]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys))], ["key"])

    common.small_batches(df.sparkSession)
    return df.select("text").mapInArrow(run, "key long").groupBy("key").count().where("count > 1").select("key")


def _segments(df: DataFrame, length: int, bits) -> DataFrame:
    """Segments around cores that the filter may hold: c1, c2 (the core), s (of the segment), lr, nl (left and right bytes; how many are left), id, th, copied, first window's start, last window's end."""
    size = length - REACH

    def one(batch):
        out: list[list] = [[] for _ in range(10)]
        for name, th, copied, text in zip(*(batch.column(i).to_pylist() for i in range(3)), common.utf8(batch.column(3))):
            if text is None or len(text) < length:
                continue
            at, first, last = cores(text, length)
            keys = _keys(text, at, size)
            hit = np.flatnonzero(common.key_in(bits.value, keys))
            for c1, p, a, b in zip(keys[hit].tolist(), at[hit].tolist(), first[hit].tolist(), (last[hit] + length).tolist()):
                lr = text[a:p] + text[p + size : b]
                c2 = xxhash.xxh64_intdigest(text[p : p + size], 1)
                row = c1, c2 - (c2 >> 63 << 64), (s := xxhash.xxh3_64_intdigest(lr, p - a)) - (s >> 63 << 64), lr, p - a, name, th, copied, a, b
                for column, value in zip(out, row):
                    column.append(value)
            if len(out[0]) > 50_000:
                yield out
                out = [[] for _ in range(10)]
        yield out

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        for batch in batches:
            for out in one(batch):
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["c1", "c2", "s", "lr", "nl", "id", "th", "copied", "a", "b"])

    return df.select("id", "th", "copied", "text").mapInArrow(run, "c1 long, c2 long, s long, lr binary, nl int, id long, th long, copied boolean, a long, b long")


def _stable(keys: np.ndarray) -> np.ndarray:
    """A stable order of small numbers, by radix."""
    if keys.dtype == np.uint32:
        order = np.argsort(keys.astype(np.uint16), kind="stable")
        return order[np.argsort((keys >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]
    return np.argsort(keys, kind="stable")


class Shard:
    """Suffix order by REACH + 1 symbols of some strings (rows of symbols, WIDTH each, taken as circles), and its transform."""

    def __init__(self, rows: np.ndarray, words: np.ndarray):
        n = rows.size
        row, column = np.divmod(np.arange(n, dtype=np.int32), WIDTH)
        before = row * WIDTH + (column - WORD) % WIDTH
        first, words = rows.reshape(-1), words.reshape(-1)
        order = _stable(first)
        for _ in range(REACH // WORD):
            order = before[order[_stable(words[order])]]
        self.order, self.first, self.transform = order, first[order], words[order]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the shards' orders, one shard behind the other, in the merged order by REACH + 1 symbols; and the number of each one's interval."""
    first, transform = np.concatenate([s.first for s in shards]), np.concatenate([s.transform for s in shards])
    shard = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(s.order) for s in shards])
    order = _stable(first)
    interleave = shard[order]
    border = np.concatenate(([False], first[order][1:] != first[order][:-1]))
    entries = np.empty(len(order), np.int32)
    for step in range(REACH // WORD + 1):
        entries[_stable(interleave)] = np.arange(len(order), dtype=np.int32)  # a shard's entries keep their order
        if step == REACH // WORD:
            break
        word = transform[entries]
        order = _stable(word)
        word, interval = word[order], np.cumsum(border, dtype=np.int32)[order]
        border[1:] = (word[1:] != word[:-1]) | (interval[1:] != interval[:-1])
        interleave = interleave[order]
    return entries, np.cumsum(border, dtype=np.int64)


def symbols(lr: pa.Array, nl: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments as rows of WIDTH symbols with the core's at REACH, and the number of right bytes of each."""
    offsets = np.frombuffer(lr.buffers()[1], np.int32)[lr.offset : lr.offset + len(lr) + 1].astype(np.int64)
    sizes, data = np.diff(offsets), np.frombuffer(lr.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    out = np.full((len(lr), WIDTH), _RIGHT, np.uint8)
    out[:, :REACH] = _LEFT
    out[:, REACH] = _CORE
    inside = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    left = np.repeat(nl, sizes)
    out[np.repeat(np.arange(len(lr)), sizes), REACH - left + inside + (inside >= left)] = data
    return out, sizes - nl


def repeated(core: np.ndarray, lr: pa.Array, nl: np.ndarray, shard_rows: int = 64) -> np.ndarray:
    """Which windows (row, column: REACH less the bytes on the left) of different segments occur in another segment of the same core."""
    rows, nr = symbols(lr, nl)
    before = np.concatenate((rows[:, -WORD:], rows), axis=1)
    words = np.ndarray((len(rows), WIDTH), ">u8", before.tobytes(), 0, (WIDTH + WORD, 1)).astype(np.uint64)  # as numbers in the order of their symbols
    seen, words = np.unique(words, return_inverse=True)
    words = words.reshape(rows.shape).astype(np.uint16 if len(seen) <= 1 << 16 else np.uint32)
    cuts = range(0, len(rows), max(shard_rows, -(-len(rows) // 1000)))
    shards = [Shard(rows[a : a + cuts.step], words[a : a + cuts.step]) for a in cuts]
    entries, interval = merge(shards)
    which = np.concatenate([s.order + a * WIDTH for a, s in zip(cuts, shards)])[entries]
    row, column = np.divmod(which, WIDTH)
    whole = (column >= REACH - nl[row]) & (column <= np.minimum(nr[row], REACH))
    row, column, interval = row[whole], column[whole], interval[whole]
    order = np.lexsort((column, core[row], interval))
    key = np.stack((interval[order], core[row][order], column[order]))
    new = np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))) if len(order) else np.empty(0, bool)
    many = np.bincount(np.cumsum(new) - 1, minlength=1)[np.cumsum(new) - 1] > 1
    out = np.zeros((len(rows), REACH + 1), bool)
    out[row[order][many], column[order][many]] = True
    return out


def _merged(batches, length: int, chunk: int):
    """Spans (id, th, a, b) of repeated windows of segments that occur once. Rows come core by core."""

    def spans(held: list) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        c = np.stack([table[x].to_numpy() for x in ("c1", "c2")])
        core = np.cumsum(np.concatenate(([False], (c[:, 1:] != c[:, :-1]).any(axis=0))))
        once = (table["n"].to_numpy() == 1) & ~table["copied"].to_numpy()
        wanted = (np.bincount(core) > 1)[core] & (np.bincount(core, once) > 0)[core]
        table, core, once = table.filter(pa.array(wanted)), core[wanted], once[wanted]
        out = []
        if table.num_rows:
            table = table.combine_chunks()
            nl = table["nl"].to_numpy().astype(np.int64)
            found = repeated(core, table["lr"].chunk(0), nl) & once[:, None]
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            (row, a), (_, b) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            start = table["a"].to_numpy()[row] + nl[row] - REACH
            out = [table["id"].to_numpy()[row], table["th"].to_numpy()[row], start + a, start + b - 1 + length]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out or [[]] * 4], ["id", "th", "a", "b"])

    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        c = [batch.column(x).to_numpy() for x in ("c1", "c2")]
        cuts = np.flatnonzero((c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])) + 1
        if held:
            last = held[-1]
            if any(last.column(x)[-1].as_py() != batch.column(x)[0].as_py() for x in ("c1", "c2")):
                cuts = np.concatenate(([0], cuts))
        at = 0
        for cut in cuts.tolist():
            if rows + cut - at >= chunk:  # whole cores only
                if cut > at:
                    held.append(batch.slice(at, cut - at))
                yield spans(held)
                held, rows, at = [], 0, cut
        if at < batch.num_rows:
            held.append(batch.slice(at))
            rows += batch.num_rows - at
    if held:
        yield spans(held)


def _one_by_one(rows: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows of segments whose core has too many: each window by itself, grouped by its bytes' hash."""
    nr = F.octet_length("lr") - F.col("nl")
    window = F.explode(F.sequence(F.greatest(REACH - nr, F.lit(0)), F.least("nl", F.lit(REACH)))).alias("left")
    each = rows.select("*", window)
    own = F.substring("lr", F.col("nl") - F.col("left") + 1, F.lit(REACH))
    each = each.select("c1", "c2", F.xxhash64(own, "left").alias("w1"), F.xxhash64(F.lit(7), "left", own).alias("w2"), "id", "th", (F.col("a") + F.col("nl") - F.col("left")).alias("a"))
    each = common.staged(each, "windows")
    keys = ["c1", "c2", "w1", "w2"]
    many = each.groupBy(*keys).count().where("count > 1").select(keys)
    return each.join(many, keys).select("id", "th", "a", (F.col("a") + length).alias("b"))


def cut(text: bytes, a: np.ndarray, b: np.ndarray) -> tuple[int, int, str]:
    """Removed bytes, maximal removed runs, SHA-256 of what is left when spans [a, b) are removed."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
    starts, ends = a[new], np.append(b[new[1:] - 1], b[-1])
    state, view = hashlib.sha256(), memoryview(text)
    for x, y in zip([0, *ends.tolist()], [*starts.tolist(), len(text)]):
        state.update(view[x:y])
    return int((ends - starts).sum()), len(starts), state.hexdigest()


def remove_repeats(df: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", chunk: int = 480, most: int = 8192) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256: every byte goes that is covered by a string of `length` bytes which also starts anywhere else, in this text or another.

    Texts are UTF-8 bytes, a null one empty; strings never cross texts, overlaps count, and strings are judged on the input. Rows that repeat are texts of their own: so long as they have `length` bytes, all of
    them go. Shorter texts stay whole. Ids may repeat or be null. Other columns are not read. length is REACH + 8 or more.

    Cores with more than `most` different segments are counted window by window. The filter of repeated cores is sized by their count; beyond 32 MB it is used in parts, one pass over the texts for each.
    """
    if length < REACH + 8:
        raise ValueError(f"length has to be {REACH + 8} at least")
    spark = df.sparkSession
    text = F.col(text_col).cast("string")
    docs = df.select(F.col(id_col).alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text).alias("th"), F.xxhash64(F.lit(1), text).alias("th2"), text.alias("text"))
    classes = common.staged(docs.where(F.octet_length("text") >= length).groupBy("th", "th2").agg(F.count("*").alias("n"), F.min("id").alias("stands")).where("n > 1").select("th", "th2", "stands"), "copies")
    docs = docs.join(common.maybe_broadcast(classes, 24 * classes.count()), ["th", "th2"], "left").withColumn("copied", F.col("stands").isNotNull())
    own = F.coalesce("text", F.lit(""))
    size, none = F.octet_length(own).cast("long").alias("n_bytes"), F.lit(0).cast("long")
    untouched = [size, none.alias("n_removed"), none.alias("n_spans"), F.sha2(own.cast("binary"), 256).alias("kept_sha256")]
    copies = docs.where("copied").select("doc", size, size.alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    long = docs.where((F.octet_length("text") >= length) & (~F.col("copied") | (F.col("id") == F.col("stands"))))
    docs = docs.where("not copied")
    many = common.staged(_counted(long, length), "cores")
    found = None
    for bits in common.key_filters(many, "key"):
        part = common.staged(_segments(long, length, spark.sparkContext.broadcast(bits)), "segments")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return copies.unionByName(docs.select("doc", *untouched)).withColumnRenamed("doc", id_col)
    first = [F.min(c).alias(c) for c in ("id", "th", "a")]
    segments = common.staged(found.groupBy("c1", "c2", "s", "lr", "nl").agg(F.count("*").alias("n"), F.bool_or("copied").alias("copied"), *first), "distinct")
    hot = common.staged(segments.groupBy("c1", "c2").count().where(F.col("count") > most).select("c1", "c2"), "hot")
    whole = found.where("not copied").select("c1", "s", "id", "th", "a", "b").join(segments.where("n > 1").select("c1", "s"), ["c1", "s"], "left_semi").select("id", "th", "a", "b")
    rest, spans = segments, whole
    if not hot.isEmpty():
        rest = segments.join(hot, ["c1", "c2"], "left_anti")
        spans = spans.unionByName(_one_by_one(found.join(hot, ["c1", "c2"]), length))
    dealt = rest.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "s")
    spans = spans.unionByName(dealt.mapInArrow(lambda batches: _merged(batches, length, chunk), "id long, th long, a long, b long"))
    by_doc = common.staged(spans.groupBy("id", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    filters = list(common.key_filters(by_doc.select("th"), "th", most_parts=1))
    if filters:
        bits = spark.sparkContext.broadcast(filters[0])

        @F.arrow_udf("boolean")
        def maybe(th: pa.Array) -> pa.Array:
            return pa.array(common.key_in(bits.value, th.to_numpy(zero_copy_only=False)))

        docs = docs.withColumn("maybe", maybe("th"))
    else:  # too many for a filter: all texts are shuffled
        docs = docs.withColumn("maybe", F.lit(True))

    def kernel(batch):
        rows = []
        for t, spans in zip(common.utf8(batch.column(1)), batch.column(2).to_pylist()):
            a, b = (np.array([s[x] for s in spans or []], np.int64) for x in "ab")
            rows.append((len(t or b""), *(cut(t, a, b) if len(a) else (0, 0, hashlib.sha256(t or b"").hexdigest()))))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    touched = docs.where("maybe").join(by_doc, ["id", "th"], "left").select("doc", "text", "spans")
    kind = df.schema[id_col].dataType.simpleString()
    touched = common.map_batches(touched, kernel, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    out = touched.unionByName(docs.where("not maybe").select("doc", *untouched)).unionByName(copies)
    return out.withColumnRenamed("doc", id_col)

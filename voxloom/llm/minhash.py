"""Near-duplicates by fast similarity sketching, banding and exact verification.

Words are maximal runs without ASCII white space, A-Z lower-cased; a document's set holds its distinct five-word
shingles as 64-bit hashes. The sketch has t coordinates. Round i throws every element into one of t hashed bins with value
i plus a hashed fraction, and a bin keeps its least value; after t rounds, every bin left empty takes all elements in a
round of its own, so every coordinate is filled. Sketches are cut into bands; documents that agree on a band
are candidates, and candidates are grouped by connected components over bands (a superset of every true group). Only the
texts of candidates are read again: all others are passed over by a filter of fixed size before anything is shuffled.

All pairs of a small group are counted exactly in one task, by matrix products over shared shingles. A large group
goes in two steps. First each of its documents is held against a bounded number of pivots of the group, which joins most
copies. Then the documents outside its largest joined set are counted against all of the group, or, if that is less work,
band by band, those outside the largest joined set of a band against all of the band; in pairs of blocks, whose size grows with
the group so that a matrix product has enough to do. So every pair that agrees on a band is counted or joined already, at
any size. Only links of a spanning forest leave a task.

Equal sets are one node from the start. A pair at similarity s is missed if no band agrees: (1 - s^7)^48, which is
9e-9 at 0.85 and 1e-5 at 0.8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators import components

from . import common, tokens

WORDS, ROWS, BANDS = 5, 7, 48
SIZE = ROWS * BANDS
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MULTIPLIERS = np.array([int.from_bytes(xxhash.xxh64(b"word%d" % i).digest(), "big") | 1 for i in range(WORDS + 1)], np.uint64)
_SEEDS = np.array([int.from_bytes(xxhash.xxh64(b"round%d" % i).digest(), "big") for i in range(2 * SIZE)], np.uint64)
_BAND_MULTIPLIERS = np.array([int.from_bytes(xxhash.xxh64(b"row%d" % i).digest(), "big") | 1 for i in range(ROWS)], np.uint64)
_BAND_SEEDS = np.array([int.from_bytes(xxhash.xxh64(b"band%d" % i).digest(), "big") for i in range(BANDS)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes() -> tokens.TwoAges:
    return tokens.TwoAges(lambda w: xxhash.xxh64(w).digest(), 250_000)


def shingles(text: bytes | None, known: tokens.TwoAges) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; a text of fewer words is one shingle, one without words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u8")
    n = len(h)
    if n < WORDS:
        return _mix(np.array([(h * _MULTIPLIERS[:n]).sum(dtype=np.uint64) ], np.uint64) + _MULTIPLIERS[WORDS:] * np.uint64(n))
    out = h[: n - WORDS + 1] * _MULTIPLIERS[0]
    for i in range(1, WORDS):
        out = out + h[i : n - WORDS + 1 + i] * _MULTIPLIERS[i]
    return np.unique(_mix(out))


def sketch(elements: np.ndarray) -> np.ndarray:
    """SIZE coordinates (round and hashed fraction in one number) of a set that isn't empty."""
    out = np.zeros(SIZE, np.uint64)
    empty = np.ones(SIZE, bool)
    n, first = len(elements), 0
    rounds = max(1, -(-4 * SIZE // n))
    while first < SIZE and empty.any():
        rounds = min(rounds, SIZE - first)
        x = _mix(elements[None, :] ^ _SEEDS[first : first + rounds, None])
        keys = ((x >> np.uint64(32)) * np.uint64(SIZE) >> np.uint64(32)) << np.uint64(52) | np.arange(first, first + rounds, dtype=np.uint64)[:, None] << np.uint64(32) | x & np.uint64(0xFFFFFFFF)
        keys = np.sort(keys, axis=None)
        bins = (keys >> np.uint64(52)).astype(np.int64)
        keep = np.empty(len(bins), bool)
        keep[0] = True
        np.not_equal(bins[1:], bins[:-1], out=keep[1:])
        bins, keys = bins[keep], keys[keep] & np.uint64((1 << 52) - 1)
        new = empty[bins]
        out[bins[new]] = keys[new]
        empty[bins] = False
        first += rounds
    for b in np.flatnonzero(empty):
        out[b] = np.uint64((SIZE + b) << 32) | (_mix(elements ^ _SEEDS[SIZE + b]) & np.uint64(0xFFFFFFFF)).min()
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    return _mix((values.reshape(BANDS, ROWS) * _BAND_MULTIPLIERS).sum(axis=1, dtype=np.uint64) ^ _BAND_SEEDS).view(np.int64)


def _sketched(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n, h1, h2 (a 128-bit hash of the set), bands (null for an empty set)."""
    held = []

    def kernel(batch):
        if not held:
            held.append(word_hashes())
        n, h1, h2, bands = [], [], [], []
        for text in common.utf8(batch.column(1)):
            s = shingles(text, held[0])
            n.append(len(s))
            a, b = np.frombuffer(xxhash.xxh3_128(s.tobytes()).digest(), ">i8") if len(s) else (None, None)
            h1.append(a if a is None else int(a))
            h2.append(b if b is None else int(b))
            bands.append(band_keys(sketch(s)) if len(s) else None)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["id", "n", "h1", "h2", "bands"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return common.map_batches(src, kernel, "id long, n long, h1 long, h2 long, bands array<bigint>")


def forest(sets: list[np.ndarray], percent: int, rows: np.ndarray | None = None, joined: list | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that connect what pairs with 100 * intersection >= percent * union connect: all pairs, or those of rows with all others. Sets with equal names in joined are connected from the start."""
    sizes = np.array([len(s) for s in sets], np.int64)
    m = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.empty(len(values), bool)
    new[:1] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    alone = rows is not None
    rows = rows if alone else np.arange(m)
    inter = np.zeros((len(rows), m), np.int64)
    if len(column):
        column = np.unique(column, return_inverse=True)[1]
        width = max(64, (4 << 20) // m)
        for low in range(0, int(column[-1]) + 1, width):
            a, b = np.searchsorted(column, (low, low + width))
            part = np.zeros((m, min(width, int(column[-1]) + 1 - low)), np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            inter += (part[rows] @ part.T).astype(np.int64)
    linked = 100 * inter >= percent * (sizes[rows][:, None] + sizes[None, :] - inter)
    label = np.arange(m) if joined is None else np.unique(np.array(joined), return_inverse=True)[1]
    out = []
    for row, i in zip(linked if alone else np.triu(linked, 1), rows.tolist()):
        others = np.flatnonzero(row)
        others = others[label[others] != label[i]]
        if len(others):
            found, first = np.unique(label[others], return_index=True)
            out += [(i, int(j)) for j in others[first]]
            label[np.isin(label, found)] = label[i]
    return out


def _sets(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of wanted (id, h1, h2, ...) with their shingles; texts of other ids are dropped by filters before the shuffle (sized by the count, more than one pass over the texts where one would be too large), repeats of a text under one id are one row."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null").select("id", "text", F.xxhash64("id").alias("key"))
    schema, sets = "id long, h1 long, h2 long, shingles binary", None
    for filled in common.key_filters(wanted.select(F.xxhash64("id").alias("key")), "key"):
        held, bits = [], spark.sparkContext.broadcast(filled)

        def kernel(batch, held=held, bits=bits):
            if not held:
                held.append(word_hashes())
            batch = batch.filter(pa.array(common.key_in(bits.value, batch.column(2).to_numpy())))
            sets = [shingles(t, held[0]).tobytes() for t in common.utf8(batch.column(1))]
            names = [np.frombuffer(xxhash.xxh3_128(s).digest(), ">i8") if s else (None, None) for s in sets]
            hashes = [pa.array([None if x[i] is None else int(x[i]) for x in names], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([batch.column(0), *hashes, pa.array(sets, pa.binary())], ["id", "h1", "h2", "shingles"])

        part = common.map_batches(src, kernel, schema)
        sets = part if sets is None else sets.unionByName(part)
    if sets is None:
        sets = spark.createDataFrame([], schema)
    return sets.groupBy("id", "h1", "h2").agg(F.first("shingles").alias("shingles")).join(wanted, ["id", "h1", "h2"])


def _links(percent: int):
    def verify(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group["id"].to_pylist()
        links = forest([np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()], percent)
        return pa.table({"a": pa.array([ids[i] for i, _ in links], pa.int64()), "b": pa.array([ids[j] for _, j in links], pa.int64())})

    return verify


def _in_blocks(docs: str, size: str, block_docs: int, block_bytes: int):
    return F.greatest(F.ceil(F.col(docs) / block_docs), F.ceil(F.col(size) / block_bytes)).cast("int")


def _large_links(big: DataFrame, percent: int, pivots: int, block_docs: int, block_bytes: int) -> DataFrame:
    """Links (a, b) of large groups: big has component, id, n, blocks, bands, shingles."""
    by_hash = Window.partitionBy("component").orderBy(F.xxhash64("id", F.lit(3)), "id")
    few = big.select("component", "id", "n", "blocks", "shingles").withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= pivots)
    few = few.withColumn("sum", F.sum(8 * F.col("n")).over(by_hash)).where((F.col("sum") <= block_bytes) | (F.col("r") == 1))
    dealt = big.select("component", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "shingles").unionByName(few.select("component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "shingles"))
    first = common.staged(dealt.groupBy("component", "block").applyInArrow(_links(percent), "a long, b long"), "links")
    joined = components.components(first)
    whole_group = F.xxhash64("component", F.lit("group"))  # one more band, that all of a group share
    named = big.join(joined.select(F.col("node").alias("id"), F.col("component").alias("c")), "id", "left").select("component", "id", F.coalesce("c", "id").alias("c"), "n", F.explode(F.array_append("bands", whole_group)).alias("band"))
    members = common.staged(named, "members")
    size = F.struct(F.col("docs"), F.col("bytes"), F.col("c"))
    bands = members.groupBy("component", "band", "c").agg(F.count("*").alias("docs"), F.sum(8 * F.col("n")).alias("bytes")).groupBy("component", "band").agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"), F.max(size).alias("top"), F.count("*").alias("sets")).where("sets > 1")
    bands = bands.select("component", "band", F.col("top.c").alias("top"), "docs", "bytes", (F.col("docs") - F.col("top.docs")).alias("rest"), (F.col("bytes") - F.col("top.bytes")).alias("rest_bytes"), (F.col("band") == whole_group).alias("whole_group"))
    bands = common.staged(bands, "bands")
    work = F.col("docs").cast("double") * F.col("rest")
    choice = bands.groupBy("component").agg((F.coalesce(F.sum(F.when(F.col("whole_group"), work)), F.lit(0.0)) < F.coalesce(F.sum(F.when(~F.col("whole_group"), work)), F.lit(0.0))).alias("at_once"))
    block = F.least(F.greatest(F.col("docs") / 64, F.lit(block_docs)), F.lit(8 * block_docs))
    in_blocks = lambda docs, size: F.greatest(F.ceil(F.col(docs) / block), F.ceil(F.col(size) / block_bytes)).cast("int")
    bands = bands.join(choice, "component").where(F.col("whole_group") == F.col("at_once")).select("component", "band", "top", "docs", in_blocks("docs", "bytes").alias("whole"), in_blocks("rest", "rest_bytes").alias("parts"))
    bands = common.staged(bands, "chosen")
    tasks = max(1, (bands.where("whole = 1 and parts = 1").agg(F.sum("docs")).first()[0] or 0) // block_docs)
    mixed = members.join(bands, ["component", "band"])
    whole = mixed.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.pmod(F.xxhash64("id"), F.col("whole")).cast("int").alias("j"), F.lit(False).alias("part"))
    part = mixed.where("c <> top").select("*", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("j"), F.lit(True).alias("part"))
    task = F.when((F.col("whole") == 1) & (F.col("parts") == 1), F.pmod(F.xxhash64("band"), F.lit(tasks))).otherwise(F.xxhash64("band", "i", "j"))  # small bands share a task
    rows = whole.unionByName(part).select(task.alias("task"), "band", "i", "j", "id", "c", "part").join(big.select("id", "shingles"), "id")

    def verify(group: pa.Table) -> pa.Table:
        columns = [group[x].to_pylist() for x in ("band", "i", "j", "id", "c", "part", "shingles")]
        held: dict = {}
        for *key, name, c, part, shingled in zip(*columns):
            one = held.setdefault(tuple(key), {})
            one[name, shingled] = c, part or one.get((name, shingled), (c, False))[1]
        out = []
        for one in held.values():
            ids = [name for name, _ in one]
            links = forest([np.frombuffer(x, np.uint64) for _, x in one], percent, np.flatnonzero([part for _, part in one.values()]), [c for c, _ in one.values()])
            out += [(ids[i], ids[j]) for i, j in links]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return first.unionByName(rows.groupBy("task").applyInArrow(verify, "a long, b long"))


def near_duplicates(df: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", block_docs: int = 128, block_bytes: int = 8 << 20, pivots: int = 64) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id reachable over links), kept (id = component_id).

    Null, empty and blank texts have no shingles and are linked with nothing: they are components of their own. Rows with
    equal ids are one node if their texts are equal; rows with equal ids and other texts are linked by their id alone where a
    component takes it in. A null id has a null component and is kept, but still links nothing. An empty table gives no rows.
    Groups of more than two blocks (block_docs different sets, or block_bytes of shingles) are large ones. Other columns are not read.
    """
    table = common.staged(_sketched(df, id_col, text_col), "sketched")
    classes = common.staged(table.where("n > 0 and id is not null").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    members = classes.select("rep", F.explode("bands").alias("band"))
    heads = members.groupBy("band").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last").select("band", "head")
    candidates = components.components(members.join(heads, "band").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")))
    candidates = common.staged(candidates.join(classes.select(F.col("rep").alias("node"), "n", "h1", "h2", "bands"), "node"), "candidates")
    groups = candidates.groupBy("component").agg(F.count("*").alias("docs"), F.sum(8 * F.col("n")).alias("bytes")).select("component", _in_blocks("docs", "bytes", block_docs, block_bytes).alias("blocks"), ((F.col("docs") > 2 * block_docs) | (F.col("bytes") > 2 * block_bytes)).alias("large"))
    groups = common.staged(groups, "groups")
    wanted = candidates.join(groups, "component").select(F.col("node").alias("id"), "h1", "h2", "component", "n", "blocks", "large", F.when(F.col("large"), F.col("bands")).alias("bands"))
    sets = common.staged(_sets(df, wanted, id_col, text_col), "sets")
    links = sets.where("not large").groupBy("component").applyInArrow(_links(percent), "a long, b long")
    if not groups.where("large").isEmpty():
        links = links.unionByName(_large_links(sets.where("large"), percent, pivots, block_docs, block_bytes))
    found = common.staged(components.components(links), "components")
    for done in (candidates, groups, sets):
        common.drop(done)
    named = classes.select("h1", "h2", "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    named = common.staged(named, "named")
    common.drop(classes)
    common.drop(found)
    out = table.select("id", "n", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the least of its near-duplicates, with their columns as they are. Rows with a null id stay. Of rows alike in id and text one stays, the first by its columns as JSON.

    Ids that go or that repeat are put in a filter sized by their count; only rows that it may hold are shuffled, all rows if it would be too large.
    """
    named = near_duplicates(df.select(id_col, text_col), percent, id_col, text_col)
    ids = common.staged(named.groupBy(F.col(id_col).alias("id")).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows")).where("id is not null and (not kept or rows > 1)"), "gone")
    if ids.isEmpty():
        return df
    name, own = common.free_name(df.columns, "maybe"), F.col(id_col).cast("long")
    filters = list(common.key_filters(ids.select(F.xxhash64("id").alias("key")), "key", most_parts=1))
    may = F.lit(True)
    if filters:
        bits = df.sparkSession.sparkContext.broadcast(filters[0])

        @F.arrow_udf("boolean")
        def maybe(keys: pa.Array) -> pa.Array:
            return pa.array(common.key_in(bits.value, keys.to_numpy(zero_copy_only=False)))

        may = maybe(F.xxhash64(own))
    rows, columns = df.withColumn(name, may & own.isNotNull()), [F.col(f"`{c}`") for c in df.columns]
    left = rows.where(F.col(name)).join(ids.where("not kept").select(F.col("id").alias(name + "_id")), own == F.col(name + "_id"), "left_anti")
    row = F.struct(*columns)
    checked = left.groupBy(own.alias(name), F.xxhash64(text_col).alias(name + "_h"), F.col(text_col).alias(name + "_t")).agg(F.min_by(row, F.to_json(row)).alias(name + "_row"))
    return rows.where(~F.col(name)).select(*columns).unionByName(checked.select(*[F.col(f"{name}_row.`{c}`").alias(c) for c in df.columns]))

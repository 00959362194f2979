"""Hard negatives by product quantisation with stored residual norms.

Vectors are made integers and cut into stretches of SUB components. Each stretch has a codebook of up to 256 centres, fitted on a
bounded sample; a vector is kept as its codes, with the norm of what each code leaves (rounded up), beside its integers. A
table of products of an anchor's stretches with all centres gives a score for every vector by lookups, and the
anchor's stretch norms times the residual norms give how far off it can be. So every vector has a lower and an upper bound,
which are rigorous; products are worked out exactly only where the bounds leave open that a row is wanted.

Two passes over the blocks for each block of anchors: the first takes each anchor's best rows of its own label, the second fills,
for each of these positives, the window of scores that make a hard negative, with the best rows of other labels. Both passes keep a few
rows for each anchor and task, and only these are shuffled; no rows are grouped by label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

#: Components a stretch, and centres a codebook.
SUB, CENTRES = 2, 256
#: What rounding to 32 bits may cost, as a share of the lengths; lengths beyond _WIDE are bounded in 64 bits.
_SLACK, _WIDE = 8e-6, 1e15


def codebook(x: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Centres (stretch, centre, component) by Lloyd's rounds from evenly spaced rows of a sample; components that fill up the last stretch are 0."""
    x = stretches(x)
    n, parts, _ = x.shape
    k = min(CENTRES, n)
    out = x[np.arange(k) * n // k].transpose(1, 0, 2).copy()
    for s in range(parts):
        for _ in range(rounds):
            nearest = _nearest(x[:, s], out[s])
            counts = np.bincount(nearest, minlength=k)
            for d in range(SUB):
                total = np.bincount(nearest, x[:, s, d], minlength=k)
                out[s, counts > 0, d] = total[counts > 0] / counts[counts > 0]
    return out


def stretches(x: np.ndarray) -> np.ndarray:
    """Rows as (row, stretch, component)."""
    short = -x.shape[1] % SUB
    return np.pad(x, ((0, 0), (0, short))).reshape(len(x), -1, SUB)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):  # any centre is a right one, the residual says how far it is
        return (x @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)


def encode(x: np.ndarray, centres: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and residual norms of each stretch, rounded up. Without a codebook, one centre at 0."""
    x = stretches(x)
    codes = np.zeros(x.shape[:2], np.uint8)
    left = x
    if centres is not None:
        codes = np.stack([_nearest(x[:, s], centres[s]) for s in range(x.shape[1])], axis=1).astype(np.uint8)
        left = x - centres[np.arange(x.shape[1]), codes]
    return codes, np.sqrt((left * left).sum(axis=2)) * (1 + _SLACK)


def quantised(df: DataFrame, centres: dict[int, np.ndarray], rows: int) -> DataFrame:
    """Blocks of up to rows neighbours of one dimension: dim, n, ids, labels, data, codes, residuals."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    def kernel(batches):
        for batch in batches:
            for dim, run in vectors.runs_of_dims(batch):
                for at in range(0, run.num_rows, rows):
                    part = run.slice(at, rows)
                    x = vectors.matrix(part.column("data"), dim)
                    codes, left = encode(x, shared.value.get(dim))
                    columns = [pa.array([dim], pa.int32()), pa.array([len(x)], pa.int32()), pa.array([part.column("id").to_numpy().tobytes()], pa.binary()), pa.array([part.column("label").to_pylist()], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*columns, *[pa.array([a.tobytes()], pa.binary()) for a in (x, codes, left)]], ["dim", "n", "ids", "labels", "data", "codes", "residuals"])

    common.small_batches(df.sparkSession)
    return df.select("id", "dim", "data", "label").mapInArrow(kernel, "dim int, n int, ids binary, labels array<string>, data binary, codes binary, residuals binary")


class Anchors:
    """Anchors of one dimension with their tables."""

    def __init__(self, rows: list, centres: np.ndarray | None):
        self.index, self.ids, self.labels = np.array([r["index"] for r in rows], np.int64), np.array([r["id"] for r in rows], np.int64), [r["label"] for r in rows]
        self.data = np.stack([np.frombuffer(r["data"], np.float64) for r in rows])
        cut = stretches(self.data)
        norms = np.sqrt((cut * cut).sum(axis=2))
        self.norms = np.sqrt((norms * norms).sum(axis=1))
        self.reach = np.column_stack((norms * (1 + _SLACK), _SLACK * self.norms, np.full(len(rows), 1e-3)))  # with what rounding may cost
        self.table = np.einsum("asd,skd->sak", cut, centres) if centres is not None else np.zeros((cut.shape[1], len(rows), 1))

    def bounds(self, rows: np.ndarray, block: Block, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the products of some anchors with some rows of a block."""
        kind = np.float32 if max(self.norms.max(), block.norms.max()) < _WIDE else np.float64
        score = np.zeros((len(rows), len(columns)), kind)
        for table, codes in zip(self.table, block.codes):
            score += np.take(table[rows].astype(kind), codes[columns], axis=1)
        off = self.reach[rows].astype(kind) @ block.reach[columns].astype(kind).T
        return score - off, score + off

    def products(self, rows: np.ndarray | int, block: Block, columns: np.ndarray) -> np.ndarray:
        """Exact products of anchor rows[i], or one anchor, and block row columns[i]."""
        q, x = self.data[rows], block.data[columns]
        widest = (self.norms[rows] * block.norms[columns]).max(initial=0)
        if widest < 2**52 and q.ndim == 1:
            return (x @ q).astype(np.int64)
        q = np.broadcast_to(q, x.shape)
        if widest < 2**52:
            return np.einsum("ij,ij->i", q, x).astype(np.int64)
        if widest < 2**62:
            return np.einsum("ij,ij->i", q.astype(np.int64), x.astype(np.int64))
        raise OverflowError("the lengths of an anchor and a row multiply to 2^62 or more: their score may not fit a long")


class Block:
    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        self.dim, self.ids = dim, np.frombuffer(row["ids"], np.int64)
        self.names = {label: i for i, label in enumerate(sorted(set(row["labels"])))}
        self.labels = np.array([self.names[x] for x in row["labels"]])
        self.data = np.frombuffer(row["data"], np.float64).reshape(n, dim)
        self.codes = np.frombuffer(row["codes"], np.uint8).reshape(n, -1).T.astype(np.intp)
        self.norms = np.sqrt((self.data * self.data).sum(axis=1))
        self.reach = np.column_stack((left := np.frombuffer(row["residuals"], np.float64).reshape(n, -1), self.norms + left.sum(axis=1), np.ones(n)))
        self.distinct = len(np.unique(self.ids)) == n


def _nth(values: np.ndarray, n: int) -> float:
    """The n-th largest value, or none."""
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


class Positives:
    """The k best rows of each anchor's own label so far."""

    def __init__(self, anchors: Anchors, k: int):
        self.a, self.k, self.least = anchors, k, np.full(len(anchors.ids), -np.inf)
        self.found = (np.empty(0, np.int64),) * 3

    def see(self, block: Block) -> None:
        named = np.array([block.names.get(x, -1) for x in self.a.labels])
        for label in range(len(block.names)):
            columns, rows = np.flatnonzero(block.labels == label), np.flatnonzero(named == label)
            if not len(rows):
                continue
            low, high = self.a.bounds(rows, block, columns)
            need = self.least[rows]
            if block.distinct and len(columns) > self.k:  # of so many rows one may be the anchor
                need = np.maximum(need, np.partition(low, len(columns) - self.k - 1, axis=1)[:, len(columns) - self.k - 1])
            r, c = np.nonzero((high >= need[:, None]) & (block.ids[columns][None, :] != self.a.ids[rows][:, None]))
            r, c = rows[r], columns[c]
            new = (r, block.ids[c], self.a.products(r, block, c))
            *self.found, full = vectors.best(*(np.concatenate((old, more)) for old, more in zip(self.found, new)), self.k)
            self.least[self.found[0][full]] = self.found[2][full]


class Negatives:
    """The k best rows of other labels so far in each window of an anchor. windows: (anchor's row, its number, least score, most score)."""

    def __init__(self, anchors: Anchors, windows: list[tuple[int, int, int, int]], k: int):
        self.a, self.k = anchors, k
        self.of: dict[int, list] = {}
        for row, number, low, high in windows:
            self.of.setdefault(row, []).append([number, low, high, -np.inf, (np.empty(0, np.int64), np.empty(0, np.int64))])

    def see(self, block: Block) -> None:
        asked = np.array(sorted(self.of), np.int64)
        named = [block.names.get(x, -1) for x in self.a.labels]
        for at in range(0, len(asked), 256):
            rows = asked[at : at + 256]
            lows, highs = self.a.bounds(rows, block, np.arange(len(block.ids)))
            for row, low, high in zip(rows.tolist(), lows, highs):
                least, most = min(max(w[1], w[3]) for w in self.of[row]), max(w[2] for w in self.of[row])
                columns = np.flatnonzero((high >= least) & (low <= most) & (block.labels != named[row]))
                columns = columns[block.ids[columns] != self.a.ids[row]]
                if len(columns):
                    self._fill(row, block, columns, low[columns], high[columns])

    def _fill(self, row: int, block: Block, columns: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        wanted = np.zeros(len(columns), bool)
        for _, least, most, nth, _ in self.of[row]:
            if block.distinct:  # k rows that lie in the window for sure
                nth = max(nth, _nth(low[(low >= least) & (high <= most)], self.k))
            wanted |= (high >= max(least, nth)) & (low <= most)
        columns = columns[wanted]
        scores, ids = self.a.products(row, block, columns), block.ids[columns]
        for window in self.of[row]:
            _, least, most, nth, (old_ids, old_scores) = window
            inside = (scores >= max(least, nth)) & (scores <= most)
            if block.distinct and np.count_nonzero(inside) > self.k:
                inside &= scores >= _nth(scores[inside], self.k)
            if inside.any():
                new_ids, new_scores = np.concatenate((old_ids, ids[inside])), np.concatenate((old_scores, scores[inside]))
                _, new_ids, new_scores, full = vectors.best(np.zeros(len(new_ids), np.int64), new_ids, new_scores, self.k)
                window[3:] = (new_scores[full][0] if full.any() else -np.inf), (new_ids, new_scores)


def _best(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.groupBy(*keys, "id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, fit_rows: int = 8192, block_rows: int = 4096, anchor_bytes: int = 16 << 20,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer products of floor(scale * component). An anchor's positives are its best rows of the same label, its negatives for one of them
    the best rows of other labels whose score is from low to high percent of the positive's; ties go to the smaller id. A positive below 0 has no such scores.

    Rows with a null id, label or vector, an empty vector, or null or non-finite components take no part, as anchors neither. Vectors are compared with those of their
    dimension. Rows of the anchor's own id are not its partners; of several rows with one id the best counts, and anchor rows that differ under one id are mined each for itself,
    anchors that repeat wholly once. An anchor without positives or negatives has no rows. Lengths that multiply to 2^62 or more where a product is needed are an error.

    Codebooks are fitted on about fit_rows rows of the commonest dimensions (64 at most, 32 MB in all); a dimension without one has residuals as long as its vectors, and loses only speed. The driver holds
    that sample, and anchor_bytes of anchors with their positives at a time.
    """
    spark = df.sparkSession
    own = df.withColumn(name := common.free_name(df.columns, "is_anchor"), F.coalesce(anchor, F.lit(False)))
    table = common.staged(vectors.integers(own, id_col, vector_col, scale, label_col), "vectors")
    asked = vectors.integers(own.where(F.col(name)), id_col, vector_col, scale, label_col).dropDuplicates(["id", "data", "label"])
    asked = common.staged(asked, "anchors")
    dims = table.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(64).collect()
    centres = {}
    for dim, n in dims:
        want = min(fit_rows, (32 << 20) // (8 * dim * len(dims)))
        if want >= 2:
            sample = table.where((F.col("dim") == dim) & (F.xxhash64("id", F.lit(11)) <= common.threshold(min(1.0, want / n)))).select("id", "data").orderBy(F.xxhash64("id", F.lit(12)), "id", "data").limit(want)
            rows = sample.select("data").toArrow()
            if rows.num_rows:
                centres[dim] = codebook(vectors.matrix(rows["data"], dim))
    blocks = common.staged(quantised(table, centres, block_rows), "blocks")
    size, = asked.agg(F.coalesce(F.sum(8 * F.col("dim") + 64), F.lit(0))).first()
    rounds, out = -(-size // anchor_bytes), None
    for i in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(rounds)) == i).orderBy("dim", "id", "label", "data")
        by_dim: dict[int, list] = {}
        for index, r in enumerate(part.toLocalIterator()):  # about anchor_bytes
            by_dim.setdefault(r["dim"], []).append(r.asDict() | {"index": index})
        anchors = spark.sparkContext.broadcast((by_dim, centres))

        def first_pass(batches, anchors=anchors):
            own = None
            for batch in batches:
                if own is None:
                    own = {dim: Positives(Anchors(rows, anchors.value[1].get(dim)), positives) for dim, rows in anchors.value[0].items()}
                for row in batch.to_pylist():
                    if row["dim"] in own:
                        own[row["dim"]].see(Block(row))
            for p in (own or {}).values():
                a, ids, scores = p.found
                yield pa.RecordBatch.from_arrays([pa.array(p.a.index[a]), pa.array(p.a.ids[a]), pa.array(ids), pa.array(scores)], ["index", "anchor_id", "id", "score"])

        found = common.staged(_best(blocks.mapInArrow(first_pass, "index long, anchor_id long, id long, score long"), ["index", "anchor_id"], positives), "positives")
        wanted = [r.asDict() for r in found.where("score >= 0").orderBy("index", "rank").toLocalIterator()]  # at most so many an anchor
        place = {r["index"]: (dim, row) for dim, rows in by_dim.items() for row, r in enumerate(rows)}
        windows: dict[int, list] = {}
        for number, r in enumerate(wanted):
            dim, row = place[r["index"]]
            windows.setdefault(dim, []).append((row, number, -(-low * r["score"] // 100), high * r["score"] // 100))
        second = spark.sparkContext.broadcast((windows, [(r["anchor_id"], r["id"], r["score"]) for r in wanted]))

        def second_pass(batches, anchors=anchors, second=second):
            own = None
            for batch in batches:
                if own is None:
                    own = {dim: Negatives(Anchors(rows, anchors.value[1].get(dim)), second.value[0][dim], negatives) for dim, rows in anchors.value[0].items() if dim in second.value[0]}
                for row in batch.to_pylist():
                    if row["dim"] in own:
                        own[row["dim"]].see(Block(row))
            for n in (own or {}).values():
                rows = [(number, *second.value[1][number], int(name), int(score)) for some in n.of.values() for number, _, _, _, (ids, scores) in some for name, score in zip(ids, scores)]
                columns = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["number", "anchor_id", "positive_id", "positive_score", "id", "score"])

        mined = blocks.mapInArrow(second_pass, "number long, anchor_id long, positive_id long, positive_score long, id long, score long")
        mined = _best(mined, ["number", "anchor_id", "positive_id", "positive_score"], negatives).drop("number")
        if rounds > 1:  # one table a round, so that its anchors can go
            mined = common.staged(mined, "mined")
            anchors.destroy()
            second.destroy()
        out = mined if out is None else out.unionByName(mined)
    if out is None:
        out = spark.createDataFrame([], "anchor_id long, positive_id long, positive_score long, id long, score long, rank int")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

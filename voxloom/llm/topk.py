"""Exact top-k search by norm-bucketed retrieval.

Vectors are made integers, floor(scale * x), and dealt by length into buckets of bounded size, longest first. Queries
come in blocks of bounded size, each broadcast for one pass over the buckets. A query's threshold starts as its k-th
score in the longest bucket. In every other bucket the threshold becomes a local one on the cosine, t / (|q| * longest length): above 1 the bucket
is skipped; if it is high, a coordinate prunes (vectors whose share on the query's largest coordinate lies outside
the range that such a cosine allows); else length prunes (only the vectors that are long enough). Products of what
is left are verified exactly, and they raise the threshold. Bounds have slack for rounding, so no score is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

#: Local cosine thresholds from here up are pruned by coordinate, those below by length.
COORDINATE = 0.75
_SLACK = 1e-9
#: Products of vectors up to this length fit in 64 bits; others are worked out in Python's integers.
_WIDE = 2.0**31


def _pack(df: DataFrame, rows: int) -> DataFrame:
    """Blocks of up to rows vectors of one dimension, in the order of each partition: dim, n, longest, ids, norms, data. Equal neighbours are one."""

    def block(dim, parts):
        ids, norms, data = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([norms.max()]), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, norms, data)]], ["dim", "n", "longest", "ids", "norms", "data"])

    def run(batches):
        held, n, last, of = [], 0, None, None
        for batch in batches:
            for dim, part in vectors.runs_of_dims(batch):
                if of != dim and held:
                    yield block(of, held)
                    held, n = [], 0
                last = last if of == dim else None
                of = dim
                ids, norms, data = part.column("id").to_numpy(), part.column("norm").to_numpy(), vectors.matrix(part.column("data"), dim)
                new = np.ones(len(ids), bool)
                new[1:] = (ids[1:] != ids[:-1]) | (data[1:] != data[:-1]).any(axis=1)
                new[0] = last is None or last[0] != ids[0] or (last[1] != data[0]).any()
                last = ids[-1], data[-1].copy()
                ids, norms, data = ids[new], norms[new], data[new]
                while len(ids):
                    some = rows - n
                    held.append((ids[:some].copy(), norms[:some].copy(), data[:some].copy()))  # the batch can go
                    n += len(held[-1][0])
                    ids, norms, data = ids[some:], norms[some:], data[some:]
                    if n == rows:
                        yield block(dim, held)
                        held, n = [], 0
        if held:
            yield block(of, held)

    return df.select("id", "dim", "norm", "data").mapInArrow(run, "dim int, n int, longest double, ids binary, norms binary, data binary")


class Block:
    def __init__(self, row: dict):
        self.n, self.dim, self.longest = row["n"], row["dim"], row["longest"]
        self.ids, self.norms = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["norms"], np.float64)
        self.data = np.frombuffer(row["data"], np.float64).reshape(self.n, self.dim)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows in Python's integers."""
    a, b = (np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape) for x in (a, b))
    return a @ b.T


class Search:
    """The k best of one block of queries so far; see(block) goes on with one bucket."""

    def __init__(self, queries: Block, k: int):
        self.q, self.k = queries, k
        self.least = np.full(queries.n, -np.inf)
        self.unit = queries.data / np.maximum(queries.norms, 1e-300)[:, None]
        self.focus = np.abs(self.unit).argmax(axis=1)
        self.found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # query, id, score
        self.products = 0

    def _products(self, block: Block, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        self.products += len(rows) * len(columns)
        q, x, widest = self.q.data[rows], block.data[columns], self.q.norms[rows].max() * block.norms[columns].max()
        if widest < 2**52:
            return (q @ x.T).astype(np.int64)
        if widest < 2**62:
            return q.astype(np.int64) @ x.astype(np.int64).T
        out = np.empty((len(rows), len(columns)), object)
        long_q, long_x = self.q.norms[rows] >= _WIDE, block.norms[columns] >= _WIDE
        out[np.ix_(~long_q, ~long_x)] = q[~long_q].astype(np.int64) @ x[~long_x].astype(np.int64).T
        out[np.ix_(~long_q, long_x)] = _exact(q[~long_q], x[long_x])
        out[long_q] = _exact(q[long_q], x)
        return out

    def _take(self, block: Block, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray) -> None:
        r, c = np.nonzero(scores.astype(np.float64) >= self.least[rows][:, None])
        r, ids, s = rows[r], block.ids[columns[c]], scores[r, c]
        other = ids != self.q.ids[r]
        q, ids, s = (np.concatenate((old, new[other])) for old, new in zip(self.found, (r, ids, s)))
        *self.found, full = vectors.best(q, ids, s, self.k)
        q, _, s = self.found
        self.least[q[full]] = np.maximum(self.least[q[full]], s[full].astype(np.float64))

    def see(self, block: Block) -> None:
        if block.dim != self.q.dim:
            return
        local = self.least / np.maximum(self.q.norms * block.longest, 1e-300)
        live = local <= 1 + _SLACK
        by_coordinate = live & (local >= COORDINATE)
        for r in np.flatnonzero(by_coordinate).tolist():
            t, f = min(1.0, max(0.0, local[r] - 1e-6)), self.focus[r]
            u = self.unit[r, f]
            spread = np.sqrt((1 - t * t) * max(0.0, 1 - u * u)) + 1e-6
            share = block.data[:, f] / np.maximum(block.norms, 1e-300)
            # a cosine of t or more keeps the coordinate within spread of u * cosine, whose least and most values are at t and 1
            low, high = min(u * t, u) - spread, max(u * t, u) + spread
            columns = np.flatnonzero((share >= low) & (share <= high) & (block.norms * self.q.norms[r] * (1 + _SLACK) >= self.least[r]))
            if len(columns):
                rows = np.array([r])
                self._take(block, rows, columns, self._products(block, rows, columns))
        rows = np.flatnonzero(live & ~by_coordinate)
        if len(rows):
            need = (self.least[rows] / np.maximum(self.q.norms[rows], 1e-300)).min() * (1 - _SLACK)
            columns = np.flatnonzero(block.norms >= need) if np.isfinite(need) else np.arange(block.n)
            if len(columns):
                self._take(block, rows, columns, self._products(block, rows, columns))


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", bucket_rows: int = 4096, query_bytes: int = 32 << 20) -> DataFrame:
    """query_id, rank (from 1), the candidate's id, score: the k largest integer inner products of every query with rows of other ids.

    Ties go to the smaller id. Null vectors, ids and components, non-finite ones and empty vectors take no part; vectors are
    compared with those of their own dimension. Rows alike in id and vector count once; of several vectors with one id, as
    candidates and as queries, the best counts. A query without candidates has no rows. Products are exact at every size: beyond
    64 bits they are worked out in Python's integers, and one among a query's k largest that doesn't fit a long is an error, as is a
    component beyond 1e150. A vector has to fit in a task some times over. Other columns are not read.

    The driver holds query_bytes of queries at a time, and up to 64 heads of buckets of about 0.5 MB.
    """
    spark = df.sparkSession
    table = common.staged(vectors.integers(df, id_col, vector_col, scale), "vectors")
    n, dim = table.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    bucket_rows = max(1, min(bucket_rows, (32 << 20) // (8 * dim)))
    query_rows = max(1, query_bytes // (8 * dim))
    parts = max(1, min(-(-n // bucket_rows), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    by_length = table.repartitionByRange(parts, "dim", F.desc("norm"), "id", F.xxhash64("data")).sortWithinPartitions("dim", F.desc("norm"), "id", "data")
    buckets = common.staged(_pack(by_length, bucket_rows), "buckets")
    asked = vectors.integers(queries, id_col, vector_col, scale).dropDuplicates(["id", "data"])
    asked = common.staged(asked, "queries")
    rounds = -(-asked.count() // query_rows)
    head = F.least("n", F.greatest(F.lit(k + 1), F.floor(F.lit(1 << 19) / (8 * F.col("dim")))).cast("int"))
    heads = buckets.select("dim", head.alias("n"), "longest", *[F.substring(c, F.lit(1), 8 * head * (F.col("dim") if c == "data" else 1)).alias(c) for c in ("ids", "norms", "data")])
    seeds = [r.asDict() for r in heads.groupBy("dim").agg(F.max_by(F.struct("dim", "n", "longest", "ids", "norms", "data"), F.struct("longest", "n")).alias("b")).select("b.*").limit(64).collect()]  # for first thresholds; a dimension without one starts at none
    out = None
    for i in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(rounds)) == i).orderBy("dim", F.desc("norm"))
        rows: dict[int, list] = {}
        for r in part.toLocalIterator():  # at most about query_bytes
            rows.setdefault(r["dim"], []).append(r)
        blocks = []
        for dim, group in rows.items():
            for at in range(0, len(group), 2048):
                some = group[at : at + 2048]
                blocks.append({"n": len(some), "dim": dim, "longest": some[0]["norm"], "ids": np.array([r["id"] for r in some], np.int64).tobytes(), "norms": np.array([r["norm"] for r in some]).tobytes(), "data": b"".join(r["data"] for r in some)})
        shared = spark.sparkContext.broadcast((blocks, seeds))

        def scan(batches, shared=shared):
            own = []
            for batch in batches:
                if not own:
                    asked, first = shared.value
                    own = [Search(Block(b), k) for b in asked]
                    for search in own:  # thresholds from the longest bucket, whose own task gives its rows
                        for seed in first:
                            search.see(Block(seed))
                        search.found = (np.empty(0, np.int64),) * 3
                for row in batch.to_pylist():
                    bucket = Block(row)
                    for search in own:
                        search.see(bucket)
            for search in own:
                q, ids, s = search.found
                if s.dtype == object:  # null for what is too far below 0, which matters only where fewer than k are above
                    if any(v >= 1 << 63 for v in s):
                        raise OverflowError("a score does not fit a long")
                    s = [v if v >= -1 << 63 else None for v in s]
                yield pa.RecordBatch.from_arrays([pa.array(search.q.ids[q]), pa.array(ids), pa.array(s, pa.int64())], ["query_id", "id", "score"])

        found = buckets.mapInArrow(scan, "query_id long, id long, score long")
        if rounds > 1:  # one table a round, so that its queries can go
            found = common.staged(found, "found")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "query_id long, id long, score long")
    best = out.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    fits = F.coalesce("score", F.raise_error(F.lit("a score does not fit a long")).cast("long")).alias("score")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col if id_col != "query_id" else "id"), fits)

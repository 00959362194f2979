"""Tables with a key that changes are merged into: rows lie in hashed buckets, a merge writes only the buckets it touches, and readers see the version before or behind it."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from voxloom.staging import drop, staged


class KeyedTable:
    """A table at a path that all machines share.

    Each version is a small file that names the folder of every bucket; it is put in place by a rename that fails if it exists, so a merge takes effect wholly or not at all,
    and of two that start from one version one fails. Null is a key like any other.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    def _hadoop(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), jpath

    def _names(self, path: str) -> list[str]:
        fs, at = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.path}/versions") if n.endswith(".json") and n[:-5].isdigit())

    def _state(self, version: int | None = None) -> tuple[int, dict]:
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if version == 0:
            return 0, {"schema": None, "folders": {}, "batches": {}, "buckets": self.buckets, "key": self.key}
        fs, at = self._hadoop(f"{self.path}/versions/{version}.json")
        stream = fs.open(at)
        try:
            state = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if state["key"] != self.key:
            raise ValueError(f"the table's key is {state['key']}")
        return version, state

    def _rows(self, spark: SparkSession, state: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(state["schema"])
        paths = [f"{self.path}/data/{folder}" for b, folder in state["folders"].items() if buckets is None or b in buckets]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one unless named; a version stays readable until vacuum deletes it."""
        _, state = self._state(version)
        if state["schema"] is None:
            raise ValueError("the table has no version yet")
        return self._rows(self.spark, state)

    def merge(self, changes: DataFrame, order: str, deleted: Column | None = None, batch: tuple[str, int] | None = None) -> int:
        """Puts changes in the table and returns its version.

        Of the changes of one key the last by `order` counts (of ties the one with the greater values); it replaces the table's row, or deletes it where `deleted` is true. Columns are the table's;
        the first merge sets them. batch: the name of a stream and a number that grows; a batch that the table has already is passed over.
        """
        version, state = self._state()
        if batch and state["batches"].get(batch[0], -1) >= batch[1]:
            return version
        schema = StructType.fromJson(state["schema"]) if state["schema"] else changes.schema
        columns = [f.name for f in schema]
        gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        values = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name not in self.key]
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(state["buckets"])).cast("int")
        typed = changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in self.key], F.struct(F.col(order).alias("o"), F.struct(*values, gone.alias("gone ")).alias("v")).alias("last "))
        last = staged(typed.groupBy(*self.key).agg(F.max("`last `").alias("last ")).withColumn("bucket ", bucket), "changes")
        touched = [str(r[0]) for r in last.select("`bucket `").distinct().collect()]  # at most the number of buckets
        rows = last.where("NOT `last `.v.`gone `").select(*[c if c in self.key else F.col("`last `")["v"][c].alias(c) for c in columns])
        if state["schema"]:
            old = self._rows(changes.sparkSession, state, touched)
            same = [old[k].eqNullSafe(last[k]) for k in self.key]
            rows = old.join(last, same, "left_anti").select(columns).unionByName(rows)
        folder, name = uuid.uuid4().hex, "bucket"
        while name in (c.lower() for c in columns):
            name += "_"
        rows.withColumn(name, bucket).hint("rebalance", name).write.partitionBy(name).parquet(f"{self.path}/data/{folder}")
        drop(last)
        written = [n for n in self._names(f"{self.path}/data/{folder}") if n.startswith(f"{name}=")]
        folders = {b: f for b, f in state["folders"].items() if b not in touched} | {n.partition("=")[2]: f"{folder}/{n}" for n in written}
        batches = state["batches"] | ({batch[0]: batch[1]} if batch else {})
        self._commit(version + 1, {**state, "schema": json.loads(schema.json()), "folders": folders, "batches": batches})
        return version + 1

    def _commit(self, version: int, state: dict) -> None:
        target = f"{self.path}/versions/{version}.json"
        fs, at = self._hadoop(f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = fs.create(at, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        never = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(at, self._hadoop(target)[1], never)
        except Py4JJavaError as error:
            fs.delete(at, False)
            if version in self.versions():
                raise RuntimeError(f"another merge has made version {version}") from error
            raise

    def vacuum(self, keep: int = 2) -> int:
        """Deletes all versions but the last `keep`, and folders that none of these names (those of killed merges too); for a time when no merge runs. Returns how many folders went."""
        known = self.versions()
        kept = known[-keep:]
        used = {f.partition("/")[0] for v in kept for f in self._state(v)[1]["folders"].values()}
        for v in known[: -len(kept)] if kept else []:
            fs, at = self._hadoop(f"{self.path}/versions/{v}.json")
            fs.delete(at, False)
        unused = [n for n in self._names(f"{self.path}/data") if n not in used]
        for name in unused:
            fs, at = self._hadoop(f"{self.path}/data/{name}")
            fs.delete(at, True)
        return len(unused)


def merge_stream(rows: DataFrame, table: KeyedTable, order: str, name: str, checkpoint: str, deleted: Column | None = None) -> StreamingQuery:
    """Merges the rows of a stream that are new since its last run, each batch once: a batch that was merged before the run was killed is passed over when the stream repeats it.

    What has come is in the table itself, so the stream keeps no state, however many keys there are.
    """

    def each(batch: DataFrame, i: int) -> None:
        table.merge(batch, order, deleted, (name, i))

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

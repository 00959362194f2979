"""Tables written in the folder that driver and executors share (spark.checkpoint.dir), to cut long lineages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a folder of our own if the master is local, as in tests; on a cluster, whose machines would not share that, an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="voxloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Tables that this process has staged and not deleted, in order.
_MADE: list[str] = []


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/voxloom/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jpath, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else has; clear() deletes it."""
    return f"{_own(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "t") -> DataFrame:
    """df written as Parquet and read back: a short lineage that survives lost executors."""
    path = scratch(df.sparkSession, label)
    _MADE.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def settled(make: Callable[[], DataFrame], label: str = "t") -> DataFrame:
    """make() staged, and the tables deleted that were staged on the way to it. For one thread."""
    before = set(_MADE)
    out = staged(make(), label)
    for path in [p for p in _MADE if p not in before and p != out.staged_at]:
        _MADE.remove(path)
        _delete(out.sparkSession, path)
    return out


def drop(df: DataFrame) -> None:
    """Delete the table of a frame that staged() gave; nothing that is still to be computed may read it."""
    if df.staged_at in _MADE:
        _MADE.remove(df.staged_at)
    _delete(df.sparkSession, df.staged_at)


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has staged; for its end, when no frame that reads them is needed any more."""
    _delete(spark, _own(spark))
    _MADE.clear()

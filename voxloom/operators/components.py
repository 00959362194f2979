"""Connected components of an edge table, without bringing edges or labels to the driver.

Every round hooks each node to the neighbour (or itself) that is least in a hashed order drawn for that round, and maps
both ends of every edge through that choice, so the graph shrinks by a constant share a round. The choices of all rounds are then
applied in turn. Each round is written in the shared folder, so a lost executor costs one round at most; what later rounds
don't read is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.staging import drop, staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges, component the least node reachable. Loops, repeats and nulls in edges do no harm."""
    live = staged(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    labels, rounds = [], 0
    while not live.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.lit(rounds), F.col(c)).alias("o"), F.col(c).alias("n"))
        both = live.select("a", "b").unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = staged(both.groupBy("a").agg(F.min(order("b")).alias("m")).select("a", F.least(F.col("m"), order("a")).alias("m")).select(F.col("a").alias("node"), F.col("m.n").alias("up")), "hook")
        labels.append(hook)
        step = live.join(hook.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(hook.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        done, live = live, staged(step.where("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
        drop(done)
        rounds += 1
    drop(live)
    if not labels:
        return edges.select(F.col(a).alias("node"), F.col(b).alias("component")).where("false")
    out = labels[-1]
    for below in labels[-2::-1]:
        above, out = out, staged(below.join(out.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "left").select("node", F.coalesce("top", "up").alias("up")), "labels")
        drop(above)
        drop(below)
    least = out.groupBy("up").agg(F.min("node").alias("component"))
    return out.join(least, "up").select("node", "component")

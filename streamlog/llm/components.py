"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import discard, materialise


#: Rows of a task, where a table is so small that it needs fewer tasks than the session has for a shuffle.
TASK_ROWS = 5000


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """A frame of about so many rows in no more tasks than they need. Large ones stay as they are dealt."""
    tasks = max(1, rows // TASK_ROWS)
    return df.coalesce(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _clean(edges: DataFrame, rows: int) -> DataFrame:
    return materialise(few_tasks(edges.where("a <> b").distinct(), rows), "links")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = materialise(few_tasks(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), rows), "lowest")
    out = _clean(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), rows)
    discard(lowest)
    return out


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = materialise(few_tasks(down.groupBy("a").agg(F.min("b").alias("m")), rows), "lowest")
    moved = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = _clean(moved.union(lowest.select("a", F.col("m").alias("b"))), rows)
    discard(lowest)
    return out


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links between longs -> (node, component): each linked node and the smallest node it reaches.

    Every round is a few keyed shuffles over a table no larger than the input; nothing reaches the driver but a count and a checksum. A node's lowest neighbour is
    a table of its own before it is joined back, so that Spark can split the links of a node that a large cluster hangs on. Rounds end when the
    table stops changing, after about log2 of the longest chain. No links give no rows.
    """
    mark = F.struct(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).cast("string"))
    current = _clean(edges.select("a", "b"), edges.count())
    seen = current.agg(mark).first()[0]
    for _ in range(rounds):
        if seen[0] == 0:
            break
        large = _large_star(current, seen[0])
        discard(current)
        current = _small_star(large, seen[0])
        discard(large)
        before, seen = seen, current.agg(mark).first()[0]
        if before == seen:
            break
    else:
        raise RuntimeError("the components did not settle")
    stars = current.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    return stars.union(stars.select(F.col("component"), F.col("component")).distinct())

"""What several corpus operators share: shared-folder tables, global ranks, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.session import ensure_checkpoint_dir, stage_path

#: Prefix of the columns that operators add for themselves; input columns with such names are not supported.
OWN = "__llm_"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: later reads neither recompute nor depend on one executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back with pruned columns."""
    spark = df.sparkSession
    path = stage_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A table of at most so many narrow rows is broadcast after its rows have been counted.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """``df``, saved, marked for broadcast if it has at most SMALL_ROWS rows; the join is the same without."""
    kept = saved(df)
    return F.broadcast(kept) if kept.count() <= SMALL_ROWS else kept


def ranked(rows: DataFrame, by: list[str], rank: str) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, 2, ... in the order of ``by``, without gaps, over all rows.

    The rows (narrow ones: the caller leaves texts out) are dealt by range into partitions of about equal size.
    A unique tag is the last sort column, so that any number of equal rows can still be cut into several
    partitions. A row's rank is its place in its partition plus the sizes of the partitions before; only the
    latter, one number per partition, meet in one place. Rows that are equal in ``by`` get ranks in any order.
    """
    tag, block, place = OWN + "tag", OWN + "block", OWN + "place"
    columns = rows.columns
    tagged = saved(rows.withColumn(tag, F.monotonically_increasing_id()))
    dealt = (tagged.repartitionByRange(*by, tag).sortWithinPartitions(*by, tag)
             .select(*columns, F.spark_partition_id().alias(block),
                     F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(place)))
    dealt = saved(dealt)
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(block).agg((F.max(place) + 1).alias("n"))
              .select(block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    # one row per partition of the job: the bound of this broadcast is the number of partitions
    return (dealt.join(F.broadcast(starts), block)
            .select(*columns, (F.col("start") + F.col(place)).alias(rank)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: one row ``(node, root)`` per node of an edge.

    Random contraction: in each round every node points to the smallest of itself and its neighbours, in an
    order that is hashed anew; the edges are then drawn between the targets. About a constant part of the nodes
    goes in each round, whatever the shape of the graph, so the rounds grow with the logarithm of the largest
    component. Aggregates combine before the shuffle; joins are plain equi-joins that AQE may split at a hot
    node. The rounds' pointers are followed back from the last. ``root`` is some node of the component.
    """
    order = lambda c, k: F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("n"))
    left = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .filter("a <> b").distinct())
    rounds = []
    while not left.isEmpty():
        k = len(rounds)
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = saved(both.groupBy(F.col("a").alias("node")).agg(F.min(order("b", k)).alias("best"))
                       .select("node", F.least("best", order("node", k))["n"].alias("to")))
        moved_a = left.join(points, left["a"] == points["node"]).select(F.col("to").alias("a"), "b")
        moved = moved_a.join(points, moved_a["b"] == points["node"]).select("a", F.col("to").alias("b"))
        left = saved(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .distinct())
        rounds.append(points)
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds.pop().withColumnRenamed("to", "root")
    while rounds:
        points = rounds.pop()
        later = roots.select(F.col("node").alias("to"), F.col("root").alias("later"))
        roots = saved(points.join(later, "to", "left").select("node", F.coalesce("later", "to").alias("root")))
    return roots


def parts(text: str, most: int = 1 << 20) -> Iterator[str]:
    """A whole text in parts of about ``most`` characters, each cut at white space (one part if there is none)."""
    at = 0
    while len(text) - at > most:
        end = at + most
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]

"""Connected components of an undirected graph, by contraction.

Each round every node takes the smallest of itself and its neighbours as its
parent, the parents are followed once, and the edges are rewritten to join
parents; edges inside one parent vanish.  Edges shrink from round to round and
nothing but one counter reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch

#: A table of more rows than this is never broadcast, whatever the session's threshold: the driver would hold a row for each node.
LARGE = 50_000
#: A key is hot if more than one in ``HOT`` of all rows have it; so there are fewer than ``HOT`` hot keys.
HOT = 200


def apart(right: DataFrame, rows: int) -> DataFrame:
    """``right`` for a join: of ``rows`` rows (or whose other side has as many), merged by shuffles if they are many."""
    return right.hint("merge") if rows > LARGE else right


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` (a written table) joined with ``right``, which has one row at most for a key, however many of
    ``left`` share it: rows of hot keys stay where they are and meet theirs by a broadcast of fewer than ``HOT`` rows.

    ``how`` is ``inner`` or ``left``; null keys meet nothing.  ``right`` has a column besides the key."""
    n = left.count()
    hot = left.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > n / HOT).where(F.col(key).isNotNull()).select(key)
    hot = scratch.materialise(hot)
    theirs = hot.join(F.broadcast(right.join(F.broadcast(hot), key)), key, how)
    return left.join(F.broadcast(theirs), key).unionByName(left.join(F.broadcast(hot), key, "left_anti").join(apart(right, n), key, how))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """One row per node that has an edge: ``node``, ``component`` (its smallest node).

    Nulls and self-loops in ``edges`` are ignored; repeated edges do no harm; no
    edges give no rows.  Node ids may be any type with an order.
    """
    spark = edges.sparkSession
    pair = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    path = scratch.write(pair.where("u < v").distinct())
    labels_path = None
    for _ in range(max_rounds):
        pairs = spark.read.parquet(path)
        n = pairs.count()  # nodes are twice as many at most
        if not n:
            break
        # v's smaller neighbours are its u's; u has only larger ones here, but keeps itself.
        parent = pairs.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("parent"))
        parent = parent.union(pairs.select("u", "u").distinct()).groupBy("node").agg(F.min("parent").alias("parent"))
        p = scratch.materialise(parent)
        up = p.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        p = scratch.materialise(p.join(apart(up, n), "parent").select("node", F.col("grand").alias("parent")))
        to = p.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        tv = p.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        moved = pairs.join(apart(to, n), "u").join(apart(tv, n), "v").where("pu <> pv")
        nxt = scratch.write(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
        if labels_path is None:
            labels = p.select("node", F.col("parent").alias("component"))
        else:
            old = spark.read.parquet(labels_path)
            step = p.select(F.col("node").alias("component"), F.col("parent").alias("above"))
            labels = old.join(apart(step, n), "component", "left").select("node", F.coalesce("above", "component").alias("component"))
        new_labels = scratch.write(labels)
        scratch.drop(spark, path)
        if labels_path:
            scratch.drop(spark, labels_path)
        path, labels_path = nxt, new_labels
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if labels_path is None:
        return spark.read.parquet(path).select(F.col("u").alias("node"), F.col("v").alias("component"))
    return spark.read.parquet(labels_path)

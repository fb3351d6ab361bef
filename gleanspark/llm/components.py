"""Connected components over edges of any number, by alternating stars.

Each round points every node at the least label around it; a chain of length n takes about log n
rounds. Nothing but counts reaches the driver, and each round's edges are cut off from their lineage
in the shared checkpoint folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.checkpoints import with_checkpoints

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: links each node's greater neighbours to its least one. Small: links a node and its lesser neighbours to the least."""
    if large:
        edges = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = edges.join(least, "a")
    if large:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return made.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) but the roots; root is the least node of the component.

    Self-loops, repeated and reversed edges are fine; nulls are dropped; no edges give no rows.
    """
    with_checkpoints(edges.sparkSession)
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, now = state, _star(_star(now, True), False).checkpoint()
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

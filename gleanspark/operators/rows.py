"""Deduplication and batches in result order, without a window over everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one seed that are numbered together.
RUN = 4096


def first_of_each(rows: DataFrame, seed: str, order: str, content: str, keep: list[str]) -> DataFrame:
    """The first row of each content within a seed. A sum by key, so copies collapse before they are shuffled."""
    first = F.min(F.struct(order, *keep)).alias("f")
    return rows.groupBy(seed, content).agg(first).select(seed, f"f.{order}", *(f"f.{k}" for k in keep), content)


def with_batch(rows: DataFrame, seed: str, place: str, size: int, ties: Sequence[str] = ()) -> DataFrame:
    """Adds `batch`: the row's place among all rows, by seed and then by `place` (a whole number), over the batch size; `ties` order rows of one place.

    Rows are numbered within runs of RUN places; only one count for each run is summed up in one task.
    """
    run = F.floor(F.col(place) / RUN)
    counts = rows.groupBy(seed, run.alias("_run")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(seed, "_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(seed, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(seed, "_run").orderBy(place, *ties)
    numbered = rows.withColumn("_run", run).withColumn("_in", F.row_number().over(inside) - 1).join(starts, [seed, "_run"])
    return numbered.withColumn("batch", F.floor((F.col("_start") + F.col("_in")) / size).cast("int")).drop("_run", "_in", "_start")

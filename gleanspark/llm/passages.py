"""Passages that a corpus repeats: what followed, in other documents, the last few words.

Texts are cut into pieces where a hash of two words says so, about one in PIECE_WORDS, so that copies are cut alike
wherever they begin. A piece is named by a hash of its words, the place before it by one of the last three.
For every place the two pieces that most documents continue with are kept, in a table that grows with the
corpus and is joined by place. A document does not count for itself. The likelier of the two is the
prediction; how likely it is right is counted by how many documents have it, whether there is a rival, and how
the last predictions in the same document turned out.

Edge cases: a text has one piece at least; its first piece has no place and is not predicted; no places give no
rows; of pieces with equal counts the one with the greater hash is first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE_WORDS = 16
COUNTS, RUNS = 4, 3
CLASSES = (COUNTS + 1) * 2 * RUNS
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


class Pieces:
    """The pieces of some documents whose tokens, and the two before each, have the given names."""

    def __init__(self, token: np.ndarray, one: np.ndarray, two: np.ndarray, first: np.ndarray):
        token, one, two = (x.astype(np.uint64) + np.uint64(1) for x in (token, one, two))
        n = len(token)
        last = _mixed(token * _A ^ one * _B)
        closes = last % np.uint64(PIECE_WORDS) == 0
        closes[first[1:] - 1] = True
        closes[n - 1 :] = True
        ends = np.flatnonzero(closes)
        self.start = np.concatenate([[0], ends[:-1] + 1]) if n else np.empty(0, np.int64)
        #: The piece of each token, and the document of each piece.
        self.of = np.cumsum(closes) - closes
        self.doc = np.searchsorted(first, self.start, "right") - 1
        inside = (np.arange(n) - self.start[self.of]).astype(np.uint64)
        self.name = np.add.reduceat(_mixed(token * _A + (inside + np.uint64(1)) * _C), self.start) if n else np.empty(0, np.uint64)
        before = np.maximum(self.start - 1, 0)
        place = _mixed(last[before] * _C ^ two[before] * _A) | np.uint64(1)
        #: 0 at the start of a document.
        self.place = np.where(self.start == first[self.doc], np.uint64(0), place)

    def firsts(self) -> np.ndarray:
        """Whether a piece is the first in its document with its place and name."""
        key = _mixed(self.place * _A + self.name) ^ self.doc.astype(np.uint64) * _B
        _, at = np.unique(key, return_index=True)
        out = np.zeros(len(key), bool)
        out[at] = True
        return out


def predictions(pieces: DataFrame) -> DataFrame:
    """(row, piece, right, class, taught, cost) of the pieces that are predicted.

    `pieces` has row, piece (its number in the row), place, name, first, taught (whether the row is one that teaches)
    and cost; pieces without a place are left out before.
    """
    known = pieces.where("taught and first").groupBy("place", "name").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("n"), F.desc("name")))
    best = known.withColumn("rank", rank).where("rank <= 2")
    pair = F.struct("n", "name")
    best = best.groupBy("place").agg(F.max(pair).alias("a"), F.when(F.count(F.lit(1)) > 1, F.min(pair)).alias("b"))
    met = pieces.join(best, "place")
    own = lambda x: F.coalesce(F.col(f"{x}.n"), F.lit(0)) - (F.col("taught") & F.coalesce(F.col(f"{x}.name") == F.col("name"), F.lit(False))).cast("int")
    met = met.withColumn("na", own("a")).withColumn("nb", own("b"))
    chosen = F.when(F.col("na") >= F.col("nb"), F.col("a.name")).otherwise(F.col("b.name"))
    met = met.where("na > 0 or nb > 0").select("row", "piece", "taught", "cost", (chosen == F.col("name")).alias("right"), F.greatest("na", "nb").alias("n"), (F.least("na", "nb") > 0).alias("rival"))
    order = Window.partitionBy("row").orderBy("piece")
    went = lambda back: F.coalesce((F.lag("piece", back).over(order) == F.col("piece") - back) & F.lag("right", back).over(order), F.lit(False))
    run = F.when(went(1), F.when(went(2), 2).otherwise(1)).otherwise(0)
    kind = (F.least("n", F.lit(COUNTS)) * 2 + F.col("rival").cast("int")) * RUNS + run
    return met.select("row", "piece", "right", kind.cast("int").alias("class"), "taught", "cost")


def chances(predicted: DataFrame) -> list[tuple[float, float]]:
    """log10 of how likely a prediction of each class is wrong and right, counted in the rows that teach."""
    right = F.count_if("right")
    counted = {r["class"]: (r["n"] - r["k"], r["k"]) for r in predicted.where("taught").groupBy("class").agg(F.count(F.lit(1)).alias("n"), right.alias("k")).collect()}
    made = []
    for c in range(CLASSES):
        wrong, good = counted.get(c, (0, 0))
        made.append((float(np.log10((wrong + 0.5) / (wrong + good + 1))), float(np.log10((good + 0.5) / (wrong + good + 1)))))
    return made

"""SimHash near-duplicates: every link within the Hamming budget, by pigeonring filtering.

The 64 bits form a ring of SEGMENTS segments. If two fingerprints differ in at most `budget` bits, some
chain of consecutive segments starts at which every prefix of l segments differs in at most
l * budget / SEGMENTS bits (the pigeonring principle). With 4 segments and 3 bits a chain starts with
equal segments, has at most 1 differing bit after two, 2 after three and 3 after four. Equality of the
first segment and at most one bit in the second is looked up by key: each fingerprint is stored under
its own pairs of segments and asks for those pairs with each bit of the second turned. What meets under
a key still has to pass the third step of the chain before the full Hamming check.

Copies collapse first, so keys are made of distinct fingerprints only. Under one key, links are not
listed but merged: only a spanning forest of the key's links leaves the task. A key with more than KEY_ROWS
fingerprints stored under it, or asking for it, is dealt out. Of the 32 bits that the key leaves open at most
BUDGET differ, so of PIECES pieces of them all but BUDGET are equal: rows meet by each choice of so many pieces.
Fingerprints that differ in three neighbouring bits at most have been merged before (at most eight of them agree
in all others), and what is merged need not meet again: the rows of the largest such part are dealt in blocks of
KEY_ROWS, and only the others are copied to each block, themselves in blocks if they are many. So no task holds more
than two blocks, and rows grow with the square of a group only if it has many rows under one choice of pieces that are not
linked by neighbouring bits. Components then follow from the forests.

Edge cases: a null or wordless text has the fingerprint zero and is linked like any other; fewer than
three words are one shingle; repeated rows and ids keep their rows; null ids never name a component
unless all of its ids are null; a bit set in just half of the shingles is 0; no other ties arise; an empty
table gives an empty result; extra columns, whatever their names, are ignored or carried along as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.arrowmap import fresh, map_texts
from gleanspark.llm.components import components, with_checkpoints

BITS, SEGMENTS, BUDGET = 64, 4, 3
WIDTH = BITS // SEGMENTS
_LOW = (1 << WIDTH) - 1
SHINGLE = 3
#: Rows of one key that a task takes as one block.
KEY_ROWS = 4096
#: Widths of the pieces of the bits that a key leaves open, any two of which may have to be equal.
PIECES = (7, 7, 6, 6, 6)
#: More keys of that size than this are joined by a shuffle instead of a broadcast (8 bytes each).
BROADCAST_KEYS = 100_000


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        flat, hashed = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: -SHINGLE].tolist()]
        hashes = np.array([hashed(flat[a:b], 42) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns and `fp` of each row; map-only."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "fp long"])
    return map_texts(docs, keep, text_col, schema, lambda: lambda texts: {"fp": pa.array(map(fingerprint, texts), pa.int64())})


def _part(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit(_LOW).cast("long"))


def _keyed(fps: DataFrame) -> DataFrame:
    """key, fp, asks: each distinct fingerprint under its own keys, and under those it asks for."""
    fp, rows = F.col("fp"), []
    for i in range(SEGMENTS):
        start = F.shiftleft(_part(fp, i), WIDTH).bitwiseOR(F.lit(i << (2 * WIDTH)).cast("long"))
        own = start.bitwiseOR(_part(fp, i + 1))
        rows.append(F.struct(own.alias("key"), F.lit(False).alias("asks")))
        rows += [F.struct(own.bitwiseXOR(F.lit(1 << b).cast("long")).alias("key"), F.lit(True).alias("asks")) for b in range(WIDTH)]
    return fps.select(fp, F.explode(F.array(*rows)).alias("r")).select("r.key", "fp", "r.asks")


def _segment(key):
    """The segment at which the chain of a key starts."""
    return (key >> (2 * WIDTH)) & (SEGMENTS - 1)


def _near(a: np.ndarray, b: np.ndarray, segment: np.ndarray | int) -> np.ndarray:
    """Which pairs pass the chain's third step and then the full check; the key grants the first two."""
    x = a ^ b
    turn = (np.asarray(segment) * WIDTH).astype(np.uint64)
    ring = (x >> turn) | (x << ((np.uint64(BITS) - turn) & np.uint64(63)))
    third = np.bitwise_count(ring & np.uint64((1 << (3 * WIDTH)) - 1)) <= 3 * BUDGET // SEGMENTS
    return third & (np.bitwise_count(x) <= BUDGET)


def _forest(own: np.ndarray, asking: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links between `own` and (`own` and `asking`) connect."""
    nodes = np.concatenate([own, asking])
    label = np.arange(len(nodes))
    step = max(1, (1 << 20) // max(1, len(own)))
    while True:
        before = label.copy()
        for at in range(0, len(nodes), step):
            near = _near(nodes[at : at + step, None], own[None, :], segment)
            least = np.where(near, label[None, : len(own)], len(nodes)).min(axis=1, initial=len(nodes))
            np.minimum(label[at : at + step], least, out=label[at : at + step])
            back = np.where(near, label[at : at + step, None], len(nodes)).min(axis=0, initial=len(nodes))
            np.minimum(label[: len(own)], back, out=label[: len(own)])
        label = np.minimum(label, label[label])
        if (label == before).all():
            break
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges of the links of every key and part; rows come sorted by both."""

    def edges(keys, parts, fps, asks):
        cut = np.flatnonzero((np.diff(keys) != 0) | (np.diff(parts) != 0)) + 1
        first, size = np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [len(keys)]]))
        stored = np.add.reduceat(~asks, first)
        a, b = [], []
        # Two rows, by far the most keys, are one comparison; all of them together.
        two = first[(size == 2) & (stored > 0)]
        near = _near(fps[two], fps[two + 1], _segment(keys[two]))
        a.append(fps[two][near])
        b.append(fps[two + 1][near])
        for at, n in zip(first[(size > 2) & (stored > 0)].tolist(), size[(size > 2) & (stored > 0)].tolist(), strict=True):
            group, asking = fps[at : at + n], asks[at : at + n]
            x, y = _forest(group[~asking], group[asking], _segment(int(keys[at])))
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys, parts, fps = (batch.column(n).to_numpy() for n in ("key", "part", "fp"))
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        held.append((keys, parts, fps.view(np.uint64), asks))
        if (held[0][0][0], held[0][1][0]) != (keys[-1], parts[-1]) or len(held) == 1:
            keys, parts, fps, asks = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(keys, keys[-1], "left"))
            last += int(np.searchsorted(parts[last:], parts[-1], "left"))
            if last:
                yield edges(keys[:last], parts[:last], fps[:last], asks[:last])
            held = [(keys[last:], parts[last:], fps[last:], asks[last:])]
    if held:
        yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _large_keys(rows: DataFrame) -> DataFrame:
    """The keys under which more than KEY_ROWS fingerprints are stored or, but for as many, ask."""
    stored = rows.where("not asks").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # Who asks for a key is stored under one of its WIDTH neighbours, so that only neighbours of fairly large keys are asked for by many.
    heavy = stored.where(f"n > {KEY_ROWS // WIDTH}").checkpoint()
    around = F.explode(F.array(*(F.col("key").bitwiseXOR(F.lit(1 << b).cast("long")) for b in range(WIDTH))))
    asked = heavy.select(around.alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))
    return heavy.unionAll(asked).where(f"n > {KEY_ROWS}").select("key").distinct().checkpoint()


def _cliques(fps: DataFrame) -> DataFrame:
    """Edges between fingerprints that agree in all but three neighbouring bits; no group has more than eight."""
    masks = [~(7 << at) % (1 << BITS) for at in range(0, BITS, 3)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    parts = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("rest")) for i, m in enumerate(signed))))
    groups = fps.select("fp", parts.alias("p")).groupBy("p.i", "p.rest").agg(F.min("fp").alias("b"), F.collect_list("fp").alias("all")).where("size(all) > 1")
    return groups.select(F.explode("all").alias("a"), "b").where("a <> b")


def _dealt(hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, part, fp, asks) rows of large keys, dealt in parts of bounded size, and the edges found on the way."""
    cliques = _cliques(hot.select("fp").distinct()).checkpoint()
    label = components(cliques).select(F.col("node").alias("fp"), F.col("root").alias("label"))
    turn = F.shiftrightunsigned("key", 2 * WIDTH).cast("int") * WIDTH
    ring = F.call_function("shiftrightunsigned", F.col("fp"), turn).bitwiseOR(F.call_function("shiftleft", F.col("fp"), BITS - turn))
    piece = [F.shiftrightunsigned(ring, 2 * WIDTH + sum(PIECES[:i])).bitwiseAND(F.lit((1 << w) - 1).cast("long")) for i, w in enumerate(PIECES)]
    choices = combinations(range(len(PIECES)), len(PIECES) - BUDGET)
    subs = [reduce(lambda x, p: F.shiftleft(x, 7).bitwiseOR(p), (piece[i] for i in chosen), F.lit(n).cast("long")) for n, chosen in enumerate(choices)]
    rows = hot.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp")).select("key", "fp", "asks", "label", F.explode(F.array(*subs)).alias("sub"))
    rows = rows.checkpoint()
    by_label = rows.groupBy("key", "sub", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("asks")).alias("stored"))
    sizes = by_label.groupBy("key", "sub").agg(F.sum("n").alias("n"), F.sum("stored").alias("stored"), F.max("n").alias("most"), F.max_by("label", F.struct("n", "label")).alias("largest"))
    sizes = sizes.where("stored > 0 and most < n").select("key", "sub", "largest", F.ceil(F.col("n") / KEY_ROWS).alias("blocks"), F.ceil((F.col("n") - F.col("most")) / KEY_ROWS).alias("few"))
    met = rows.join(sizes, ["key", "sub"])
    mine, fews = F.pmod(F.xxhash64("fp"), F.col("blocks")), F.pmod(F.xxhash64("fp", F.lit(1)), F.col("few"))
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    as_any = F.transform(up_to("few"), lambda f: F.struct(f.alias("f"), mine.alias("a"), F.lit(True).alias("asks")))
    as_few = F.transform(up_to("blocks"), lambda a: F.struct(fews.alias("f"), a.alias("a"), F.lit(False).alias("asks")))
    places = F.when(F.col("label") == F.col("largest"), as_any).otherwise(F.concat(as_any, as_few))
    met = met.select("key", "sub", "fp", F.explode(places).alias("p"))
    part = F.shiftleft("sub", 44).bitwiseOR(F.shiftleft("p.f", 22)).bitwiseOR(F.col("p.a"))
    return met.select("key", part.alias("part"), "fp", "p.asks"), cliques


def linked(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect just what links of at most BUDGET bits connect."""
    rows = _keyed(fps).withColumn("part", F.lit(0).cast("long")).select("key", "part", "fp", "asks")
    large, found = _large_keys(rows), None
    if n := large.count():
        large = F.broadcast(large) if n <= BROADCAST_KEYS else large
        hot, cliques = _dealt(rows.join(large, "key", "left_semi"))
        rows, found = rows.join(large, "key", "left_anti").unionByName(hot), cliques
    edges = rows.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_links, "a long, b long")
    return edges if found is None else edges.unionByName(found)


def label_components(made: DataFrame, id_col: str) -> DataFrame:
    """Adds `root` (a fingerprint of the component) and `component_id` to rows that have `fp`."""
    least = made.groupBy("fp").agg(F.min(id_col).alias("least")).checkpoint()
    joined = components(linked(least.select("fp")))
    joined = joined.unionAll(joined.select(F.col("root").alias("node"), "root")).distinct()
    first = joined.join(least, joined["node"] == least["fp"]).groupBy("root").agg(F.min("least").alias("first"))
    named = joined.join(first, "root").select(F.col("node").alias("fp"), "root", "first")
    named = least.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("first")).alias("component_id")
    )
    # Written out, so that both sides of the join are plain shuffles, of which a hot fingerprint's part can be split.
    return made.join(named.checkpoint(), "fp")


def hex_of(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint and component_id (the least id reachable over links) of each row."""
    with_checkpoints(docs.sparkSession)
    made = fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id"]).checkpoint()
    return label_components(made, "id").select(F.col("id").alias(id_col), hex_of("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that with the least id, then the least hash of its text, then of the whole row.

    Null ids count as least. Rows that are equal in all of this are repeated as a whole, and one of them is kept.
    """
    with_checkpoints(docs.sparkSession)
    keys = fresh(docs.columns, ["some", "id", "hash", "row"])
    made_of = [F.col(id_col).isNotNull(), F.coalesce(id_col, F.lit(0)), F.xxhash64(text_col), F.xxhash64(*docs.columns)]
    made_of = [c.alias(k) for c, k in zip(made_of, keys, strict=True)]
    narrow = docs.select(*made_of, F.col(text_col).alias("text")).toDF("some", "id", "hash", "row", "text")
    made = fingerprints(narrow, ["some", "id", "hash", "row"]).checkpoint()
    chosen = label_components(made, "id").groupBy("root").agg(F.min(F.struct("some", "id", "hash", "row")).alias("k"))
    chosen = chosen.select("k.*").toDF(*keys)
    return docs.select("*", *made_of).join(chosen, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)

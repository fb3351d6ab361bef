"""Benchmark decontamination by winnowing.

Words of a text become k-gram hashes; the least hash of each window of `span` words is its fingerprint, on both
sides. Two texts that share `span` consecutive words share a whole window of grams, hence its fingerprint, so the
windows of a document whose fingerprint is one of the benchmark's hold every shared span. Neighbouring windows mostly
share their fingerprint, which is then looked up once. A hit is extended to the whole window by a hash of 128 bits over
its words, and hits that overlap make longer spans. Items of fewer words are one window of their own length.

The documents are read once, map-only: fingerprints and then windows are looked up in two bit maps of FILTER_BITS
bits, whatever the size of the benchmark. What passes, (row, place, window), is joined to the benchmark's distinct windows:
broadcast if there are BROADCAST_WINDOWS at most, else by a shuffle, whose large keys adaptive execution splits. Windows
with the same items are one class, so that a document's items are looked up by its classes, not by its hits. The benchmark
never passes through the driver.

Edge cases: null or wordless texts have no words, no hits and no items; items without words never
occur; rows that repeat an item_id are one item; items with a null id mark words but are not counted; an empty
benchmark leaves every document clean; extra columns are ignored or carried along as they are; no ties arise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.arrowmap import filter_rows, fresh, map_texts
from gleanspark.llm.components import with_checkpoints

#: Windows of a benchmark (16 bytes each) that are broadcast at most.
BROADCAST_WINDOWS = 1_000_000
FILTER_BITS = 1 << 24
MEMO_WORDS = 300_000
#: Any shared run of `span` words holds a window of `span - GRAM + 1` grams.
GRAM = 5
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_NONE = np.uint64(2**64 - 1)
_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def words_of(text: str) -> list[bytes]:
    """The words of the contract, A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split() if text else []


class _Hashes(dict):
    """Hashes of words, above 0."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word) or 1
        return found

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes of all words, each text closed by a 0; where each text begins; how many words it has)."""
        if len(self) > MEMO_WORDS:
            self.clear()
        split = [words_of(t or "") for t in texts]
        n = np.fromiter(map(len, split), np.int64, len(split))
        starts = np.cumsum(n + 1) - (n + 1)
        ids = np.zeros(int((n + 1).sum()), np.uint64)
        for words, first in zip(split, starts.tolist(), strict=True):
            ids[first : first + len(words)] = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return ids, starts, n


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def run_hashes(ids: np.ndarray, at: np.ndarray, k: int, step: np.uint64) -> np.ndarray:
    """A hash of the k words from each place on."""
    out = np.full(len(at), k, np.uint64)
    for j in range(k):
        out = out * step + ids[at + j]
    return _mixed(out)


def whole_runs(ids: np.ndarray, k: int) -> np.ndarray:
    """Places from which k words of one text follow."""
    if len(ids) < k:
        return np.empty(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(ids == 0)])
    return np.flatnonzero(ends[k:] == ends[: len(ids) - k + 1])


def fingerprints(ids: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """The least gram hash of the window at each place."""
    if not len(at):
        return np.empty(0, np.uint64)
    n = len(ids) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for j in range(GRAM):
        grams = grams * _STEPS[0] + ids[j : j + n]
    grams = _mixed(grams)
    least = grams[: len(ids) - span + 1].copy()
    for j in range(1, span - GRAM + 1):
        np.minimum(least, grams[j : j + len(least)], out=least)
    return least[at]


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class Seen:
    """What may be in a benchmark: its lengths of short items, and bit maps of fingerprints and windows."""

    def __init__(self, span: int, lengths: list[int], prints: np.ndarray, windows: np.ndarray):
        self.span, self.lengths, self.prints, self.windows = span, lengths, prints, windows

    def candidates(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, words, hash, second hash) of the windows that may be in the benchmark."""
        made = []
        for length in self.lengths:
            at = whole_runs(ids, length)
            if length == self.span and len(at):
                prints = fingerprints(ids, at, self.span)
                new = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
                at = at[np.repeat(_in(self.prints, prints[new]), np.diff([*new.tolist(), len(at)]))]
            hashes = run_hashes(ids, at, length, _STEPS[0])
            kept = _in(self.windows, hashes)
            at, hashes = at[kept], hashes[kept]
            made.append((at, np.full(len(at), length), hashes, run_hashes(ids, at, length, _STEPS[1])))
        return tuple(np.concatenate(x) for x in zip(*made, strict=True)) if made else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def windows_of(benchmark: DataFrame, span: int, item_col: str, text_col: str) -> DataFrame:
    """(item, n, w, v, print) of every window of every item, written out."""
    with_checkpoints(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids, _, (n,) = hashes.of([text])
                if n:
                    k = min(int(n), span)
                    at = whole_runs(ids, k)
                    prints = fingerprints(ids, at, span) if k == span else np.zeros(len(at), np.uint64)
                    columns = [pa.array([name] * len(at), pa.string()), pa.array(np.full(len(at), k), pa.int32()), _signed(run_hashes(ids, at, k, _STEPS[0])), _signed(run_hashes(ids, at, k, _STEPS[1])), _signed(prints)]
                    yield pa.RecordBatch.from_arrays(columns, names=["item", "n", "w", "v", "print"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "item string, n int, w long, v long, print long").distinct().checkpoint()


def _bit_map(hashes: DataFrame) -> np.ndarray:
    """The bit map of a column `h`: at most FILTER_BITS / 64 numbers reach the driver."""
    place = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    words = hashes.groupBy(F.shiftrightunsigned(place, 6).alias("i")).agg(F.bit_or(bit).alias("x")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("i").to_numpy()] = words.column("x").to_numpy()
    return bits.view(np.uint64)


def _seen(windows: DataFrame, span: int) -> Seen:
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())
    return Seen(span, lengths, _bit_map(windows.where(F.col("n") == span).select(F.col("print").alias("h"))), _bit_map(windows.select(F.col("w").alias("h"))))


def _marks(docs: DataFrame, keep: list[str], text_col: str, seen: Seen) -> DataFrame:
    """`keep`, n_words and the candidates of each text; map-only."""
    sent = docs.sparkSession.sparkContext.broadcast(seen)

    def start() -> Callable:
        hashes = _Hashes()

        def work(texts: list[str | None]) -> dict:
            ids, starts, n = hashes.of(texts)
            at, length, w, v = sent.value.candidates(ids)
            order = np.argsort(at, kind="stable")
            at, length, w, v = at[order], length[order], w[order], v[order]
            doc = np.searchsorted(starts, at, "right") - 1
            ends = np.searchsorted(doc, np.arange(len(texts) + 1), "left")
            made = pa.StructArray.from_arrays([pa.array(at - starts[doc]), pa.array(length, pa.int32()), _signed(w), _signed(v)], names=["at", "n", "w", "v"])
            return {"n_words": pa.array(n), "windows": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)}

        return work

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "n_words long, windows array<struct<at: long, n: int, w: long, v: long>>"])
    return map_texts(docs, keep, text_col, schema, start)


def _whole(windows: DataFrame) -> DataFrame:
    """The distinct windows (w, v) with their class: a number that windows with the same items share."""
    named = F.col("item").isNotNull()
    same = windows.groupBy("w", "v").agg(*(F.sum(F.when(named, F.xxhash64("item", F.lit(i)).cast("decimal(20,0)"))).alias(f"s{i}") for i in (0, 1)), F.count("item").alias("items"))
    return same.select("w", "v", F.when(F.col("items") > 0, F.xxhash64("s0", "s1", "items")).alias("class"))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated of each document row."""
    windows = windows_of(benchmark, span, item_col, "text")
    whole = _whole(windows).checkpoint()
    items = windows.join(whole, ["w", "v"]).where("class is not null and item is not null").select("class", "item").distinct()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _marks(named, ["id"], "text", _seen(windows, span)).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    asked = rows.where("size(windows) > 0").select("row", F.explode("windows").alias("x")).select("row", "x.*")
    hits = asked.join(F.broadcast(whole) if whole.count() <= BROADCAST_WINDOWS else whole, ["w", "v"])
    # Places in order; each covers what those before it have not.
    spans = F.sort_array(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("end"))))
    begin = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    add = lambda s, x: F.struct(F.greatest(s["end"], x["end"]).alias("end"), (s["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(s["end"], x["at"]))).alias("n"))
    covered = hits.groupBy("row").agg(spans.alias("spans")).select("row", F.aggregate("spans", begin, add)["n"].alias("n_hit"))
    names = hits.where("class is not null").select("row", "class").distinct().join(items, "class")
    names = names.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("names"))
    made = rows.select("row", "id", "n_words").join(covered, "row", "left").join(names, "row", "left")
    n_hit, found = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("names", F.array().cast("array<string>"))
    return made.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(found).cast("long").alias("n_items"), F.sha2(F.array_join(found, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows in which no benchmark window occurs, as they are.

    With a benchmark of BROADCAST_WINDOWS at most this is map-only; with a larger one the texts in which windows occur are
    found by a join, and rows with the hash of such a text go.
    """
    windows = windows_of(benchmark, span, item_col, "text")
    whole, seen = windows.select("w", "v").distinct(), _seen(windows, span)
    if whole.count() <= BROADCAST_WINDOWS:
        table = whole.toArrow()
        pairs = np.stack([table.column(c).to_numpy() for c in ("w", "v")], axis=1)
        sent = docs.sparkSession.sparkContext.broadcast((seen, pairs[np.lexsort(pairs.T)]))

        def start():
            hashes, (seen, pairs) = _Hashes(), sent.value
            known = set(map(tuple, pairs.tolist()))

            def accepts(texts):
                ids, starts, _ = hashes.of(texts)
                at, _, w, v = seen.candidates(ids)
                real = np.fromiter((x in known for x in zip(w.view(np.int64).tolist(), v.view(np.int64).tolist(), strict=True)), bool, len(at))
                clean = np.ones(len(texts), bool)
                clean[np.searchsorted(starts, at[real], "right") - 1] = False
                return clean.tolist()

            return accepts

        return filter_rows(docs, text_col, start)
    keys = fresh(docs.columns, ["key", "key2"])
    made_of = [F.xxhash64(text_col).alias(keys[0]), F.xxhash64(F.col(text_col), F.lit(1)).alias(keys[1])]
    texts = docs.select(*made_of, F.col(text_col).alias("text")).toDF("key", "key2", "text")
    asked = _marks(texts, ["key", "key2"], "text", seen).where("size(windows) > 0").select("key", "key2", F.explode("windows").alias("x")).select("key", "key2", "x.w", "x.v").distinct()
    bad = asked.join(whole, ["w", "v"], "left_semi").select("key", "key2").distinct().toDF(*keys)
    return docs.select("*", *made_of).join(bad, keys, "left_anti").select(*docs.columns)


#: The words, windows and hits of the contract, spelled out for DuckDB.
ORACLE_SQL = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (SELECT id AS item_id, w, least(10, len(w)) AS m FROM words WHERE side = 'b' AND len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS gram
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
grams AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS gram
  FROM (SELECT id AS doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM words, (SELECT DISTINCT m FROM items) WHERE side = 'd' AND len(w) >= m)),
hits AS (SELECT doc_id, item_id, i, m FROM grams JOIN windows USING (m, gram)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered ON id = covered.doc_id LEFT JOIN named ON id = named.doc_id WHERE side = 'd'"""

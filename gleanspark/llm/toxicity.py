"""Toxicity by a factorization machine over hashed terms.

Terms are words, and beginnings of words with how many distinct words of the text share them, hashed.
The machine has a weight for each term, and a vector for each whose inner products weigh pairs of terms in one
document. Both start at nothing (vectors near it) and are fitted together, so that what two terms say together
is learned as a pair: without the pairs, most toxic documents of the tables at hand would be missed.

It is fitted to a bounded sample of labelled rows (SAMPLE_ROWS, the first by the hash of their id), whose terms
stay on the executors. Terms are chosen there in two steps: those that tell the classes apart by themselves (TERMS
at most, each with a gain of LEAST_GAIN), then those that tell them apart beside these (PAIR_TERMS at most): for
which the slope of the loss by the term's vector, when a machine of the first terms has been fitted, is
LEAST_SLOPE times what chance gives. Only the chosen terms of the sample reach the driver. Labels are learned only
from ids whose crc32 is not 2 modulo 4; the score depends on the text alone. Every text is then scored, map-only.

Edge cases: a null text counts as empty and gets the score of no terms; a null id is not held out; a labelled id
with several labels has the greatest, with several texts the one with the least hash; texts of the same terms teach
once, by the least id; null labels teach nothing; terms of equal gain are taken by their hash; without a label of each
class the score is the smoothed share of toxic labels; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.arrowmap import filter_rows, map_texts
from gleanspark.llm.components import with_checkpoints

SAMPLE_ROWS, TERMS, PAIR_TERMS, FACTORS, EPOCHS, FIRST_EPOCHS = 12_000, 4096, 1024, 4, 100, 20
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
MEMO_WORDS = 200_000
_NOTHING: tuple[list, list] = ([], [])
_WORD = re.compile(r"[^\W\d_]+")
_BITS = 22
MULTIPLES = 3
#: The log-likelihood gain that a term needs on the sample to be kept for itself, and the square of its slope, in
#: units of its variance, to be kept for its pairs. A term needs LEAST_ROWS rows for either.
LEAST_GAIN, LEAST_SLOPE, LEAST_ROWS = 10.0, 25.0, 3
#: Size of the vectors at the start; how much single weights and vectors shrink.
SPREAD, SINGLE_DECAY, PAIR_DECAY = 0.1, 2e-3, 2e-4


def _hash(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) >> (32 - _BITS)


def _beginnings(word: str) -> list[str]:
    """The word's proper beginnings of four to eight letters."""
    return [word[:n] for n in range(4, min(9, len(word)))]


def _length_term(words: int) -> int:
    """A term for the number of distinct words, by powers of two, so that pairs with it can weigh density."""
    return _hash(f"n {min(16, words.bit_length())}")


def terms_of(text: str) -> set[int]:
    """Hashes of a text's terms: its words, and how many (1, 2, 3 or more) distinct ones share a beginning."""
    words = set(_WORD.findall(text.lower()))
    shared = Counter(b for w in words for b in _beginnings(w))
    return {_length_term(len(words))} | {_hash(f"w {w}") for w in words} | {_hash(f"{i} {b}") for b, n in shared.items() for i in range(1, min(n, MULTIPLES) + 1)}


@dataclass
class Machine:
    """`hashes` of the terms kept, ascending; `pair` has a vector for each."""

    hashes: np.ndarray
    bias: float
    single: np.ndarray
    pair: np.ndarray

    def raw(self, rows: list[list[int]]) -> np.ndarray:
        """Log-odds of documents given as lists of term numbers."""
        ids, at = _flat(rows)
        v = _sums(self.pair[ids], at)
        pairs = 0.5 * (v**2 - _sums(self.pair[ids] ** 2, at)).sum(axis=1)
        return self.bias + _sums(self.single[ids], at) + pairs


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return np.fromiter((i for r in rows for i in r), np.int64, int(at[-1])), at


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def _lengths() -> list[int]:
    """The terms that are always kept: those of the number of words."""
    return [_hash(f"n {i}") for i in range(17)]


def fit(hashes: np.ndarray, rows: list[list[int]], labels: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """Fits a machine of the terms `hashes` to documents given as lists of their numbers."""
    n, toxic = len(labels), labels.sum()
    prior = float(np.log((toxic + 0.5) / (n - toxic + 0.5)))
    if not 0 < toxic < n:
        return Machine(np.empty(0, np.int64), prior, np.empty(0), np.empty((0, FACTORS)))
    model = Machine(hashes, prior, np.zeros(len(hashes)), np.random.default_rng(7).normal(0, SPREAD, (len(hashes), FACTORS)))
    _descend(model, rows, labels.astype(float), epochs)
    return model


def _descend(model: Machine, rows: list[list[int]], labels: np.ndarray, epochs: int, rate: float = 0.05, size: int = 256) -> None:
    """Adagrad on the logistic loss, in batches of documents; the order is fixed."""
    rng = np.random.default_rng(11)
    g_single, g_pair = np.full(len(model.single), 1e-2), np.full(model.pair.shape, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for first in range(0, len(order), size):
            batch = order[first : first + size]
            ids, at = _flat([rows[i] for i in batch])
            vectors = model.pair[ids]
            v = _sums(vectors, at)
            raw = model.bias + _sums(model.single[ids], at) + 0.5 * (v**2 - _sums(vectors**2, at)).sum(axis=1)
            slope = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]
            model.bias -= rate * float(slope.mean())
            per = np.repeat(slope, np.diff(at))
            touched, inverse = np.unique(ids, return_inverse=True)
            step = np.bincount(inverse, per) / len(batch) + SINGLE_DECAY * model.single[touched]
            g_single[touched] += step**2
            model.single[touched] -= rate * step / np.sqrt(g_single[touched])
            grads = per[:, None] * (np.repeat(v, np.diff(at), axis=0) - vectors)
            step = np.stack([np.bincount(inverse, grads[:, f]) for f in range(FACTORS)], axis=1) / len(batch) + PAIR_DECAY * model.pair[touched]
            g_pair[touched] += step**2
            model.pair[touched] -= rate * step / np.sqrt(g_pair[touched])


def _fold(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, label, terms) of at most SAMPLE_ROWS labelled documents outside the held-out fold, copies left out; written out."""
    known = labels.where(F.col(label_col).isNotNull() & (_fold(id_col) != HELD_OUT)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("id", "label", "t.text")

    def start():
        return lambda texts: {"terms": pa.array([sorted(terms_of(t)) for t in texts], pa.list_(pa.int32()))}

    made = map_texts(texts, ["id", "label"], "text", f"id {dict(docs.dtypes)[id_col]}, label int, terms array<int>", start)
    first = F.min(F.struct("id", "label", "terms")).alias("r")
    return made.groupBy(F.xxhash64("terms").alias("same"), F.size("terms").alias("size")).agg(first).select("r.*").checkpoint()


def _telling(sample: DataFrame, n: int, toxic: int) -> list[int]:
    """The terms with the greatest gain in log-likelihood of the labels."""
    part = lambda seen, all_: F.when(seen > 0, seen * F.log(seen / all_)).otherwise(0.0)
    d, t = F.col("d").cast("double"), F.col("t").cast("double")
    counts = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("d"), F.sum("label").alias("t"))
    gain = F.round(part(t, d * toxic / n) + part(d - t, d * (n - toxic) / n), 6)
    best = counts.where(d >= LEAST_ROWS).select("term", gain.alias("gain")).where(F.col("gain") >= LEAST_GAIN)
    return [r["term"] for r in best.orderBy(F.desc("gain"), "term").limit(TERMS).collect()]


def _numbered(sample: DataFrame, hashes: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
    """(numbers of the chosen terms, label) of each row of the sample, by id."""

    def run(batches):
        for batch in batches:
            held, at = _held(batch.column("terms"), hashes)
            numbers = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(held, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), numbers], names=["id", "label", "numbers"])

    made = sample.mapInArrow(run, f"id {dict(sample.dtypes)['id']}, label int, numbers array<int>").toArrow().sort_by("id")
    return made.column("numbers").to_pylist(), made.column("label").to_numpy()


def _held(terms: pa.ListArray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the chosen terms of all rows, and where each row begins and the last ends."""
    flat, ends = terms.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *pc.list_value_length(terms).to_pylist()])
    number = np.searchsorted(hashes, flat)
    chosen = hashes[np.minimum(number, len(hashes) - 1)] == flat
    return number[chosen], np.concatenate([[0], np.cumsum(chosen)])[ends]


def _telling_in_pairs(sample: DataFrame, model: Machine) -> list[int]:
    """Terms that are not in the machine, but whose vector would follow the slope of its loss most surely."""
    names = [f"g{i}" for i in range(FACTORS)]

    def run(batches):
        for batch in batches:
            held, at = _held(batch.column("terms"), model.hashes)
            vectors = model.pair[held]
            v = _sums(vectors, at)
            raw = model.bias + _sums(model.single[held], at) + 0.5 * (v**2 - _sums(vectors**2, at)).sum(axis=1)
            slope = batch.column("label").to_numpy() - 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            row = np.repeat(np.arange(len(slope)), pc.list_value_length(batch.column("terms")).to_numpy())
            terms, inverse = np.unique(batch.column("terms").flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            pull = slope[:, None] * v
            sums = [np.bincount(inverse, pull[row, i], len(terms)) for i in range(FACTORS)]
            spread = np.bincount(inverse, (pull**2).sum(axis=1)[row], len(terms))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (terms.astype(np.int32), *sums, spread, np.bincount(inverse, minlength=len(terms)))], names=["term", *names, "spread", "d"])

    made = sample.mapInArrow(run, f"term int, {', '.join(f'{n} double' for n in names)}, spread double, d long").groupBy("term").agg(*(F.sum(c).alias(c) for c in (*names, "spread", "d")))
    squares = sum((F.col(n) * F.col(n) for n in names), F.lit(0.0))
    surest = made.where(F.col("d") >= LEAST_ROWS).select("term", F.round(squares / F.col("spread"), 6).alias("z")).where(F.col("z") >= LEAST_SLOPE)
    known = set(model.hashes.tolist())
    # The machine's own terms are TERMS and 17 at most, so that enough is asked for.
    best = surest.orderBy(F.desc("z"), "term").limit(PAIR_TERMS + len(known)).collect()
    return [r["term"] for r in best if r["term"] not in known][:PAIR_TERMS]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Machine:
    """Fits the machine to at most SAMPLE_ROWS labelled documents outside the held-out fold."""
    with_checkpoints(docs.sparkSession)
    sample = _sample(docs, labels, id_col, text_col, label_col)
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < n:
        return fit(np.empty(0, np.int64), [], np.repeat([1, 0], [toxic, n - toxic]))
    first = np.union1d(_telling(sample, n, toxic), _lengths()).astype(np.int64)
    more = _telling_in_pairs(sample, fit(first, *_numbered(sample, first), FIRST_EPOCHS))
    hashes = np.union1d(first, more).astype(np.int64)
    return fit(hashes, *_numbered(sample, hashes))


def scorer(model: Machine) -> Callable[[list], np.ndarray]:
    """A function from texts to scores, which remembers the kept terms of words it has met."""
    number = {h: i for i, h in enumerate(model.hashes.tolist())}
    memo: dict[str, tuple[list, list]] = {}

    def kept(terms) -> list[int]:
        return [number[h] for t in terms if (h := _hash(t)) in number]

    def about(word: str) -> tuple[list, list]:
        """The word's own terms, and its beginnings of which any multiple is kept."""
        beginnings = [b for b in _beginnings(word) if kept(f"{i} {b}" for i in range(1, MULTIPLES + 1))]
        own = kept([f"w {word}"])
        found = memo[word] = (own, beginnings) if own or beginnings else _NOTHING
        return found

    def score(texts: list) -> np.ndarray:
        if len(memo) > MEMO_WORDS:
            memo.clear()
        known, rows = memo.get, []
        for text in texts:
            row, shared = set(), Counter()
            words = set(_WORD.findall((text or "").lower()))
            row.add(number.get(_length_term(len(words)), -1))
            for word in words:
                own, beginnings = known(word) or about(word)
                row.update(own)
                shared.update(beginnings)
            for b, n in shared.items():
                row.update(kept(f"{i} {b}" for i in range(1, min(n, MULTIPLES) + 1)))
            rows.append(sorted(row - {-1}))
        return 1 / (1 + np.exp(-np.clip(model.raw(rows), -30, 30)))

    return score


def score_toxicity(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted of each row."""

    def start():
        score = scorer(model)

        def work(texts):
            scores = pa.array(score(texts))
            return {"score": scores, "predicted": pc.cast(pc.greater_equal(scores, THRESHOLD), pa.int32())}

        return work

    made = map_texts(docs, [id_col], text_col, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double, predicted int", start)
    return made.select(id_col, F.coalesce(_fold(id_col) == HELD_OUT, F.lit(False)).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, model: Machine, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, as they are."""

    def start():
        score = scorer(model)
        return lambda texts: (score(texts) < THRESHOLD).tolist()

    return filter_rows(docs, text_col, start)

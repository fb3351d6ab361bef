"""Language-model scores by logistic context mixing of bit predictors.

Tokens are words with A-Z lower-cased, then one end. A word among the HEAD most frequent training words, met twice or more, is
a path of bits in a Huffman code; any other is the path of an escape. Each bit is predicted in several contexts,
whatever its depth: the code's node alone; hashed with the word before, with both words before, with the endings of both.
A further predictor follows the last place in the same document where the two words before stood, and so adapts as
the document is read. Predictions are log-odds, added with weights that a gate picks by depth and by how long that
last predictor has been right; a final table by gate and prediction refines the result. How far the contexts are trusted
against the nodes alone follows, token by token, from how both did for the last RECENT tokens of the same document.

After an escape, a word is one that was met before, as likely as its share of such training words, or is spelled byte by
byte, each bit mixed in the same way from contexts of two, three and five bytes. And before words are read one
by one, a whole piece of about 16 words can be foretold by what followed the last words in other documents (see
`passages`). Every step depends on earlier words only, so probabilities multiply to the text's, and those of all texts add up to 1 at most.

What is learned covers every training document (crc32 of the id not 0 modulo 10). The counts of words and the table of
passages are exact, grow with the input and are joined. The hashed contexts share 2^TABLE_BITS slots a table, whatever the
input: they are for what is frequent. Tasks, COUNTING_TASKS for each core, add up tables and send them in compressed segments,
which are summed by segment. The mixers are then fitted to all training documents in one online pass by task, those of spelled words to each
distinct word; each bit is predicted from the counts of all others; the tasks' weights are averaged by the bits that each gate has seen, their
tables added. A training document does not count for itself in passages nor in words outside the head.

The base score needs every word's exact count: those of the HEAD words go to all tasks, a bounded table; the
rest is joined by word.

Edge cases: a null text counts as empty: one token, the end; a null id is not held out; repeated rows and ids
keep their rows; without training documents every word is unknown and bits are as good as even; an empty table
gives an empty result; extra columns are ignored; words of one class of counts enter the head together or not at all.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.arrowmap import map_texts, slices, trim
from gleanspark.llm.components import with_checkpoints
from gleanspark.llm.passages import Pieces, chances, predictions

FOLDS, HELD_OUT = 10, 0
HEAD = 1 << 17
TABLE_BITS = 22
WORD_TABLES, BYTE_TABLES = ("before", "two", "endings"), ("bytes2", "bytes3", "bytes5")
TABLES = (*WORD_TABLES, *BYTE_TABLES)
#: The name under which the follower's counts travel with the tables.
TRUST = "trust"
SEGMENT = 1 << 16
#: Tasks for each core that count tables; every task sends tables of a fixed size.
COUNTING_TASKS = 1
CHUNK = 1 << 14
MEMO_WORDS = 300_000
FLUSH_WORDS = 300_000
SLICE_BYTES = 3_000_000
_ONE = np.uint32(1)
#: The slots of so many bits in a row, read in one context, lie side by side.
BLOCK = 4
#: Log-odds are kept as whole numbers of this fraction, so that tables stay near the processor.
ODDS_STEP = np.float32(1 / 12)
DEPTHS, RUNS, BUCKETS, LIMIT, FINE = 16, 5, 33, 16, 16
#: Tokens of a document by which the contexts are trusted, and how much one of them counts at most.
RECENT, MOST_AHEAD = 16, 6.0
_MIX = np.uint32(0x9E3779B1)


class Sent:
    """A value that is compressed on its way to the workers: its tables have a fixed size, but may hold little."""

    def __init__(self, value):
        self.value = value

    def __getstate__(self) -> bytes:
        return zlib.compress(pickle.dumps(self.value, 5), 1)

    def __setstate__(self, state: bytes) -> None:
        self.value = pickle.loads(zlib.decompress(state))


def fold(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def split_words(texts: pa.Array | list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """`words_of` all texts, one after another, and how many each has."""
    if isinstance(texts, list):
        texts = pa.array([None if t is None else t.encode("utf-8", "surrogatepass") for t in texts], pa.binary()).view(pa.string())
    parts = pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(texts), ""))
    words, cuts = parts.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())])
    # White space at either end of a text leaves an empty word there.
    there = np.diff(_buffers(words)[1]) > 0
    if there.all():
        return words, np.diff(cuts)
    return words.filter(pa.array(there)), np.diff(np.concatenate([[0], np.cumsum(there)])[cuts])


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all words, where each begins and the last ends)."""
    _, places, data = words.buffers()
    cuts = np.frombuffer(places, np.int32)[words.offset : words.offset + len(words) + 1] if places else np.zeros(1, np.int32)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if data else np.empty(0, np.uint8), cuts.astype(np.int64) - cuts[0]


def huffman_lengths(counts: np.ndarray) -> np.ndarray:
    """Code lengths for counts in descending order."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.int64)
    weight = [*counts[::-1].tolist()]
    merged: list[int] = []
    parent = [0] * (2 * n - 1)
    leaf = node = 0
    for new in range(n, 2 * n - 1):
        total = 0
        for _ in range(2):
            if node >= len(merged) or (leaf < n and weight[leaf] <= merged[node]):
                total += weight[leaf]
                parent[leaf] = new
                leaf += 1
            else:
                total += merged[node]
                parent[n + node] = new
                node += 1
        merged.append(total)
    depth = [0] * (2 * n - 1)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[parent[i]] + 1
    return np.array(depth[:n][::-1])


@dataclass
class Code:
    """The head's words and their paths. The symbols after the last word are the end and the escape."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    #: How many of the tokens outside the head are words that stand once.
    once: int = 0

    def __post_init__(self):
        n = len(self.words)
        self.end, self.escape, self.start = n, n + 1, n + 2
        order = np.argsort(-self.counts, kind="stable")
        lengths = np.empty(n + 2, np.int64)
        lengths[order] = huffman_lengths(np.maximum(self.counts[order], 1))
        # Canonical codes, left-aligned in 64 bits: sorted by length, each follows the last.
        by = np.argsort(lengths, kind="stable")
        step = np.uint64(1) << (np.uint64(64) - lengths[by].astype(np.uint64))
        aligned = np.empty(n + 2, np.uint64)
        aligned[by] = np.cumsum(step) - step
        self.lengths, self.aligned = lengths, aligned
        self.at = np.cumsum(lengths) - lengths
        who = np.repeat(np.arange(n + 2), lengths)
        k = np.arange(int(lengths.sum())) - self.at[who]
        self.bits = ((aligned[who] >> (np.uint64(63) - k.astype(np.uint64))) & np.uint64(1)).astype(np.uint8)
        prefix = np.where(k > 0, aligned[who] >> (np.uint64(64) - np.maximum(k, 1).astype(np.uint64)), np.uint64(0)) + (np.uint64(1) << k.astype(np.uint64))
        nodes, self.path = np.unique(prefix, return_inverse=True)
        #: Node and bit of each step of each path, as 2 * node + bit.
        self.steps = (self.path * 2 + self.bits).astype(np.int32)
        weight = np.maximum(self.counts, 1)[who].astype(float)
        ones = np.bincount(self.path, weight * self.bits, minlength=len(nodes))
        both = np.bincount(self.path, weight, minlength=len(nodes))
        self.plain = np.log((ones + 0.1) / (both - ones + 0.1)).astype(np.float32)
        share = 1 / (1 + np.exp(-self.plain.astype(np.float64)))
        #: log10 probability of each symbol by the nodes of its path alone.
        self.alone = np.add.reduceat(np.log10(np.where(self.bits == 1, share[self.path], 1 - share[self.path])), self.at)
        self.number = {w: i for i, w in enumerate(self.words)}
        self.names = pa.array(self.words, pa.binary()).view(pa.string())
        self.ending = np.array([_ending(w) for w in self.words] + [1, 2, 3], np.uint32)
        self.log_counts = np.log10(self.counts + 0.1)
        #: How likely a word outside the head is one that was met before.
        self.met = 1 - (self.once + 0.5) / (int(self.counts[-1]) + 1)


def _ending(word: bytes) -> int:
    return int.from_bytes(word[-2:], "little") + 4


def _hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a 32-bit hash above all numbers of the head, `_ending`) of each word."""
    if not len(words):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    flat, cuts = _buffers(words)
    flat, first, sizes = flat.astype(np.uint32), cuts[:-1], np.diff(cuts)

    def mixed(x):
        x = x * np.uint32(0x85EBCA6B)
        return (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)

    place = (np.arange(len(flat)) - np.repeat(first, sizes)).astype(np.uint32)
    names = np.add.reduceat(mixed(flat + place * _MIX), first, dtype=np.uint32) + mixed(sizes.astype(np.uint32) * _MIX) | np.uint32(1 << 31)
    last = first + sizes - 1
    one = flat[last]
    two = flat[np.maximum(last - 1, 0)]
    return names, np.where(sizes > 1, two | one << np.uint32(8), one) + np.uint32(4)


class Block:
    """Where the slots of up to BLOCK bits in a row begin, in each table, for the tokens (or bytes) at `rows` of the source's order.

    A context and the node where the block begins choose 2^BLOCK slots side by side and how they are permuted, so that
    all slots are used alike; the bits that have been read since choose one of them.
    """

    def __init__(self, rows: slice, node: np.ndarray):
        self.rows, self.node, self.bases = rows, node.astype(np.uint32) * np.uint32(0x85EBCA6B), {}

    def base(self, table: str, contexts: dict[str, np.ndarray]) -> np.ndarray:
        if table not in self.bases:
            x = (contexts[table][self.rows] ^ self.node) * _MIX
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            self.bases[table] = (x >> np.uint32(32 - TABLE_BITS)).astype(np.int64)
        return self.bases[table]


class Column(NamedTuple):
    """One bit of many tokens (or bytes): those at `rows` of the source's order, all at one depth."""

    rows: slice
    node: np.ndarray
    bits: np.ndarray
    #: One gate for all, or one for each.
    gate: int | np.ndarray
    #: 1 or -1 for the bit that the follower expects, 0 for none; None if none expects any.
    sign: np.ndarray | None
    run: int
    block: Block
    #: The bits since the block began, below a 1.
    inside: np.ndarray

    def slots(self, table: str, contexts: dict[str, np.ndarray]) -> np.ndarray:
        return self.block.base(table, contexts)[: len(self.inside)] ^ self.inside


class Stream:
    """The tokens of some documents, with all contexts, one document after another."""

    def __init__(self, code: Code, texts: pa.Array | list[str | None], follow: bool = True):
        self.code = code
        words, sizes = split_words(texts)
        words = words.dictionary_encode()
        number = pc.index_in(words.dictionary, code.names)
        #: The words outside the head, numbered as they come after the code's symbols.
        self.outside = words.dictionary.filter(number.is_null())
        number = pc.fill_null(number, -1).to_numpy().astype(np.int64)
        number[number < 0] = np.arange(len(self.outside)) + code.start + 1
        self.sizes = sizes = sizes + 1
        self.first = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        token = np.full(n, code.end)
        inner = np.ones(n, bool)
        inner[self.first + sizes - 1] = False
        token[inner] = number[words.indices.to_numpy()]
        second = self.first[sizes > 1] + 1

        def before(values, start):
            one, two = np.empty_like(values), np.empty_like(values)
            one[1:], two[2:] = values[:-1], values[:-2]
            one[self.first] = two[self.first] = two[second] = start
            return one, two

        self.token, self.symbol = token, np.minimum(token, code.escape)
        # Numbers of rare words differ between slices, so a hash of the word stands for them.
        rare_names, rare_endings = _hashes(self.outside)
        self.names = np.concatenate([np.arange(code.start + 1, dtype=np.uint32), rare_names])[token]
        endings = np.concatenate([code.ending, rare_endings])[token]
        self.before = one, two = before(self.names, np.uint32(code.start))
        last, last_two = before(endings, code.ending[code.start])
        contexts = {
            "before": (one + np.uint32(1)) * np.uint32(0xC2B2AE35),
            "two": ((one + np.uint32(2)) * np.uint32(0x27D4EB2F)) ^ ((two + np.uint32(3)) * np.uint32(0x165667B1)),
            "endings": ((last + np.uint32(5)) * np.uint32(0xB5297A4D)) ^ ((last_two + np.uint32(7)) * np.uint32(0x68E31DA4)),
        }
        self.run, self.shared = np.zeros(n, np.int16), None
        if follow:
            self._follow(np.repeat(np.arange(len(sizes)), sizes), *before(token, code.start))
        # Tokens of one run by falling length, so that those that have a bit at some depth stand together.
        length = code.lengths[self.symbol]
        self.order = np.argsort(self.run * np.int16(64) - length.astype(np.int16), kind="stable")
        self.length, self.at = length[self.order], code.at[self.symbol][self.order]
        self.contexts = {k: v[self.order] for k, v in contexts.items()}
        self.run = self.run[self.order]
        self.shared = None if self.shared is None else self.shared[self.order]

    @property
    def rare(self) -> list[bytes]:
        return self.outside.view(pa.binary()).to_pylist()

    @cached_property
    def pieces(self) -> Pieces:
        return Pieces(self.names, *self.before, self.first)

    def _follow(self, doc, one, two) -> None:
        """What followed the last time that the two tokens before stood in this document, and for how long that has been right."""
        n = len(self.token)
        key = (one.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (two.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        # Places sorted by key and then by place, as the low bits of one number; what meets by chance is told apart below.
        bits = np.uint64(max(1, n - 1).bit_length())
        mixed = (key ^ (key >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
        mixed = np.sort(mixed >> bits << bits | np.arange(n, dtype=np.uint64))
        near = np.flatnonzero((mixed[1:] ^ mixed[:-1]) >> bits == 0)
        low = (np.uint64(1) << bits) - np.uint64(1)
        a, b = (mixed[near] & low).astype(np.int64), (mixed[near + 1] & low).astype(np.int64)
        same = (one[a] == one[b]) & (two[a] == two[b]) & (doc[a] == doc[b])
        # The places that have a guess, and the guess.
        at, guess = b[same], self.token[a[same]]
        right = np.zeros(n, bool)
        right[at] = guess == self.token[at]
        wrong_at = np.maximum.accumulate(np.where(right, -1, np.arange(n)))
        run = at - 1 - np.where(at > 0, wrong_at[at - 1], -1)
        self.run[at] = 1 + (run > 0) + (run > 3) + (run > 15)
        code = self.code
        differ = code.aligned[np.minimum(guess, code.escape)] ^ code.aligned[self.symbol[at]]
        shared = np.where(differ == 0, 64, 63 - np.floor(np.log2(np.maximum(differ, 1).astype(np.float64))).astype(np.int64))
        # Rounding of a 64-bit number to a float can reach the next power of two.
        shared = np.where((differ != 0) & (np.right_shift(differ, np.minimum(63 - shared, 63).astype(np.uint64)) == 0), shared + 1, shared)
        self.shared = np.full(n, -1, np.int8)
        self.shared[at] = np.minimum(shared, 63)

    def columns(self):
        """All bits of all words, CHUNK tokens and one depth at a time."""
        cuts = np.searchsorted(self.run, np.arange(RUNS + 1))
        for run in range(RUNS):
            for lo in range(int(cuts[run]), int(cuts[run + 1]), CHUNK):
                length = self.length[lo : min(int(cuts[run + 1]), lo + CHUNK)]
                left = np.searchsorted(-length, -np.arange(int(length[0])), "left")
                for depth, n in enumerate(left.tolist()):
                    rows = slice(lo, lo + n)
                    step = self.code.steps.take(self.at[rows] + depth, mode="clip")
                    node = step >> 1
                    if depth % BLOCK == 0:
                        block, inside = Block(rows, node), np.ones(n, np.int64)
                    else:
                        inside = inside[:n] << 1 | bits[:n]
                    bits, gate, sign = step & 1, min(depth, DEPTHS - 1), None
                    if run:
                        shared = self.shared[rows]
                        sign = ((depth < shared).view(np.int8) - (depth == shared).view(np.int8)) * (2 * bits - 1)
                        gate = gate + (sign != 0) * np.int64(run * DEPTHS)
                    yield Column(rows, node, bits, gate, sign, run, block, inside)


class Spelling:
    """Bits of words spelled out, each closed by a space."""

    def __init__(self, words: list[bytes]):
        flat = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint32)
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        self.first = np.cumsum(sizes) - sizes
        inside = np.arange(len(flat)) - np.repeat(self.first, sizes)
        back, h = {}, np.zeros(len(flat), np.uint32)
        for j in range(1, 6):
            byte = np.concatenate([np.zeros(j, np.uint32), flat[:-j]])[: len(flat)] + np.uint32(1)
            h = h * np.uint32(0x01000193) + byte * (inside >= j).astype(np.uint32)
            back[j] = (h + np.uint32(j)) * np.uint32(0xC2B2AE35)
        inside = np.minimum(inside, 3)
        self.order = np.argsort(inside.astype(np.int8), kind="stable")
        self.contexts = {f"bytes{j}": back[j][self.order] for j in (2, 3, 5)}
        self.flat, self.cuts = flat[self.order], np.concatenate([[0], np.cumsum(np.bincount(inside, minlength=4))])

    def columns(self):
        """All bits of all bytes; those at one place of a word (0, 1, 2, or later) and one depth at a time."""
        for place in range(4):
            for lo in range(int(self.cuts[place]), int(self.cuts[place + 1]), CHUNK):
                rows = slice(lo, min(int(self.cuts[place + 1]), lo + CHUNK))
                byte = self.flat[rows]
                for depth in range(8):
                    node = byte >> np.uint32(8 - depth) | np.uint32(1 << depth)
                    top = 1 << depth % BLOCK
                    if top == 1:
                        block = Block(rows, node)
                    inside = (node & np.uint32(top - 1) | np.uint32(top)).astype(np.int64)
                    yield Column(rows, node, (byte >> np.uint32(7 - depth) & np.uint32(1)).astype(np.int32), depth * 4 + place, None, 0, block, inside)


def _counted(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) sums of the texts' words by task; the null word is the end."""

    def run(batches):
        counts, size, ends = [], 0, 0
        for batch in batches:
            for part in slices(batch, text_col):
                ends += part.num_rows
                found = split_words(part.column(text_col))[0].value_counts()
                counts.append(pa.table([found.field("values"), found.field("counts")], names=["word", "n"]))
                size += len(found)
                if size > FLUSH_WORDS:
                    counts = [_summed(counts)]
                    size = counts[0].num_rows
                    if size > FLUSH_WORDS:
                        yield from counts.pop().to_batches()
                        size = 0
        if counts:
            yield from _summed(counts).to_batches()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([ends], pa.int64())], names=["word", "n"])
        del counts
        trim()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def _summed(counts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])


def head_of(counts: DataFrame, limit: int = HEAD) -> Code:
    """The code of the most frequent words: all whose count is in a class that, with those above, fits the limit.

    Words met once stay out: how often they stand is how often a word is new, which the escape has to learn.
    """
    rank = F.floor(F.log2("n") * 64)
    total, distinct, ends, once = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.count_if(F.col("word").isNotNull() & (F.col("n") == 1))).first()
    words = counts.where("word is not null and n > 1")
    sizes = words.groupBy(rank.alias("r")).count().orderBy(F.desc("r")).collect()
    least, held = None, 0
    for r in sizes:
        held += r["count"]
        if held > limit:
            break
        least = r["r"]
    if least is None:
        named = [], []
    else:
        kept = words.where(rank >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
        named = [w.encode() for w in kept.column("word").to_pylist()], kept.column("n").to_pylist()
    rest = (total or 0) - (ends or 0) - sum(named[1])
    return Code(named[0], np.array([*named[1], ends or 0, rest], np.int64), total or 0, distinct, once)


class _Counts:
    """Tables of how often bits were 0 and 1 in each hashed context."""

    def __init__(self, names):
        self.tables = {t: np.zeros(2 << TABLE_BITS, np.uint32) for t in names}
        #: How often the follower was right and how often it guessed, by run.
        self.trust = np.zeros((2, RUNS))
        self.empty = True

    def add(self, source) -> None:
        self.empty = False
        for column in source.columns():
            if column.run:
                self.trust[:, column.run] += np.count_nonzero(column.sign == 2 * column.bits - 1), np.count_nonzero(column.sign)
            for t, table in self.tables.items():
                np.add.at(table, column.slots(t, source.contexts) * 2 + column.bits, _ONE)

    def out(self):
        if not self.empty:
            yield from _packed({(t, i): x[at : at + SEGMENT] for t, x in self.tables.items() for i, at in enumerate(range(0, 2 << TABLE_BITS, SEGMENT))} | {(TRUST, 0): self.trust.ravel()})


class Tables(NamedTuple):
    """The sums of all tasks: log-odds for scoring; for learning, those that are left without one bit, a 0 or a 1 in turn; the follower's trust."""

    odds: dict[str, np.ndarray]
    others: dict[str, np.ndarray]
    trust: np.ndarray

    @classmethod
    def empty(cls) -> Tables:
        size = 1 << TABLE_BITS
        return cls({t: np.zeros(size, np.int8) for t in TABLES}, {t: np.zeros(2 * size, np.int8) for t in TABLES}, np.zeros((2, RUNS)))

    def put(self, table: str, at: int, counts: np.ndarray) -> None:
        """Takes counts of 0 and 1 in turn, from place `at` on."""
        zero, one = counts[0::2].astype(np.float64), counts[1::2].astype(np.float64)
        zeros, ones = np.log(zero + 0.3), np.log(one + 0.3)
        self.odds[table][at : at + len(zero)] = _steps(ones - zeros)
        others = self.others[table][2 * at : 2 * (at + len(zero))]
        others[0::2] = _steps(ones - np.log(np.maximum(zero - 1, 0) + 0.3))
        others[1::2] = _steps(np.log(np.maximum(one - 1, 0) + 0.3) - zeros)


def _steps(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(odds / ODDS_STEP), -127, 127)


def _tables(docs: DataFrame, text_col: str, counts: DataFrame, code: Broadcast) -> Tables:
    """For every hashed context, how often bits were 0 and 1: of words over all documents, of bytes over all distinct rare words."""

    def of_texts(batches):
        counted = _Counts(WORD_TABLES)
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                counted.add(Stream(code.value.value, part.column(text_col)))
        yield from counted.out()
        del counted
        trim()

    def of_words(batches):
        counted, known = _Counts(BYTE_TABLES), code.value.value.number
        for batch in batches:
            rare = [w for w in (w.encode() for w in batch.column("word").to_pylist()) if w not in known]
            if rare:
                counted.add(Spelling(rare))
        yield from counted.out()
        del counted
        trim()

    def total(batches):
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for t, i, data in zip(*(batch.column(c).to_pylist() for c in ("t", "segment", "data")), strict=True):
                part = np.frombuffer(zlib.decompress(data), np.float64 if t == TRUST else np.uint32)
                if (t, i) in sums:
                    sums[t, i] += part
                else:
                    sums[t, i] = part.astype(np.float64)
        yield from _packed({k: v if k[0] == TRUST else v.astype(np.float32) for k, v in sums.items()})

    schema = "t string, segment int, data binary"
    tasks = COUNTING_TASKS * docs.sparkSession.sparkContext.defaultParallelism
    made = docs.select(text_col).coalesce(tasks).mapInArrow(of_texts, schema).unionAll(counts.where("word is not null").select("word").coalesce(max(1, tasks // 8)).mapInArrow(of_words, schema))
    summed = made.repartition("t", "segment").mapInArrow(total, schema).toArrow()
    tables = Tables.empty()
    for t, i, data in zip(*(summed.column(c) for c in ("t", "segment", "data")), strict=True):
        raw = zlib.decompress(data.as_py())
        if t.as_py() == TRUST:
            tables.trust[:] = np.frombuffer(raw, np.float64).reshape(2, RUNS)
        else:
            tables.put(t.as_py(), i.as_py() * SEGMENT // 2, np.frombuffer(raw, np.float32))
    return tables


def _packed(segments: dict):
    items = [(k, v) for k, v in segments.items() if v.any()]
    for at in range(0, len(items), 16):
        some = items[at : at + 16]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in some], pa.string()), pa.array([k[1] for k, _ in some], pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for _, v in some], pa.binary())],
            names=["t", "segment", "data"],
        )


class Mixer:
    """Weights by gate over the inputs, a bias by gate, and the table that refines their sum."""

    def __init__(self, inputs: int, gates: int):
        self.weights = np.full((inputs, gates), 0.35, np.float32)
        self.bias = np.zeros(gates, np.float32)
        self.seen = np.full((gates, BUCKETS), 4.0)
        self.ones = self.seen / (1 + np.exp(-(np.arange(BUCKETS) - BUCKETS // 2) / 2))
        self.logs = self._logs()

    def sum(self, inputs: np.ndarray, gate: int | np.ndarray) -> np.ndarray:
        if isinstance(gate, int):
            x = self.weights[: len(inputs), gate] @ inputs + self.bias[gate]
        else:
            x = self.bias.take(gate, mode="clip")
            for i, value in enumerate(inputs):
                x += self.weights[i].take(gate, mode="clip") * value
        return np.clip(x, -LIMIT, LIMIT, out=x)

    def costs(self, x, gate, bits) -> np.ndarray:
        """log10 probability of each bit, looked up by gate and by the sum to the nearest FINE-th."""
        at = ((x + np.float32(LIMIT)) * np.float32(FINE) + np.float32(0.5)).astype(np.int64)
        return self.logs.take((gate * (2 * LIMIT * FINE + 1) + at) * 2 + bits, mode="clip")

    def _logs(self) -> np.ndarray:
        """For each gate, sum and bit: log10 of the mean of the mixed probability and the learned table's."""
        x = np.arange(2 * LIMIT * FINE + 1) / FINE - LIMIT
        learned = np.clip(self.ones / self.seen, 1e-4, 1 - 1e-4)
        own = np.stack([np.interp(x * 2 + BUCKETS // 2, np.arange(BUCKETS), row) for row in learned])
        p = 0.5 / (1 + np.exp(-x)) + 0.5 * own
        return np.log10(np.stack([1 - p, p], axis=-1)).astype(np.float32).ravel()

    def learn(self, inputs: np.ndarray, gate: int, bits: np.ndarray, rate: float = 0.02, size: int = 2048) -> None:
        """One online pass over bits of one gate, in steps of `size`."""
        w, bias, sums, wanted = self.weights[: len(inputs), gate].copy(), self.bias[gate], np.empty(len(bits), np.float32), bits.astype(np.float32)
        for a in range(0, len(bits), size):
            y, part, x = wanted[a : a + size], inputs[:, a : a + size], sums[a : a + size]
            np.matmul(w, part, out=x)
            x += bias
            np.clip(x, -LIMIT, LIMIT, out=x)
            error = np.exp(-x)
            error += 1
            np.divide(-1, error, out=error)
            error += y
            error *= np.float32(rate / np.sqrt(len(y)))
            bias += np.float32(0.1) * error.sum()
            w += part @ error
        self.weights[: len(inputs), gate], self.bias[gate] = w, bias
        # Each sum is shared between the two cells beside it.
        place = np.clip(sums * 2 + BUCKETS // 2, 0, BUCKETS - 1.001)
        low = place.astype(np.int64)
        cell = low * 2 + bits
        upper = np.bincount(cell, place - low, 2 * BUCKETS).reshape(BUCKETS, 2)
        lower = np.bincount(cell, minlength=2 * BUCKETS).reshape(BUCKETS, 2) - upper
        lower[1:] += upper[:-1]
        self.seen[gate] += lower.sum(axis=1)
        self.ones[gate] += lower[:, 1]

    def rows(self, bits: np.ndarray) -> np.ndarray:
        """What was learned from so many bits by gate, a row each; rows of several passes add up."""
        new = Mixer(*self.weights.shape)
        return np.concatenate([bits[:, None], (self.weights * bits).T, (self.bias * bits)[:, None], self.seen - new.seen, self.ones - new.ones], axis=1)

    def take(self, gate: int, row: np.ndarray) -> None:
        """Weights averaged over passes, and the refinement table of all, from a sum of `rows`."""
        inputs = len(self.weights)
        self.weights[:, gate] = row[1 : 1 + inputs] / row[0]
        self.bias[gate] = row[1 + inputs] / row[0]
        self.seen[gate] += row[2 + inputs : 2 + inputs + BUCKETS]
        self.ones[gate] += row[2 + inputs + BUCKETS :]


class Model:
    def __init__(self, code: Code, odds: dict[str, np.ndarray], trust: np.ndarray):
        self.code, self.odds = code, odds
        right, guessed = trust[0] + 1, trust[1] + 2
        self.follow = np.log(right / (guessed - right)).astype(np.float32)
        self.mixers = {"words": Mixer(2 + len(WORD_TABLES), RUNS * DEPTHS), "bytes": Mixer(len(BYTE_TABLES), 8 * 4)}

    def inputs(self, source, column: Column, look) -> np.ndarray:
        """The predictors' log-odds, a row each; `look(table, slots)` gives those of hashed contexts in steps."""
        words = isinstance(source, Stream)
        tables = WORD_TABLES if words else BYTE_TABLES
        made = np.empty((words + len(tables) + (column.sign is not None), len(column.bits)), np.float32)
        if words:
            np.take(self.code.plain, column.node, out=made[0], mode="clip")
        for i, t in enumerate(tables):
            np.multiply(look(t, column.slots(t, source.contexts)), ODDS_STEP, out=made[words + i], casting="same_kind")
        if column.sign is not None:
            np.multiply(column.sign, self.follow[column.run], out=made[-1], casting="same_kind")
        return made

    def costs(self, source) -> np.ndarray:
        """log10 probability of each token's path, or of each byte."""
        mixer = self.mixers["words" if isinstance(source, Stream) else "bytes"]
        look, total = (lambda t, slots: self.odds[t].take(slots, mode="clip")), np.zeros(len(source.order))
        for column in source.columns():
            total[column.rows] += mixer.costs(mixer.sum(self.inputs(source, column, look), column.gate), column.gate, column.bits)
        out = np.empty(len(total))
        out[source.order] = total
        return self.weighed(source, out) if isinstance(source, Stream) else out

    @staticmethod
    def weighed(stream: Stream, mixed: np.ndarray) -> np.ndarray:
        """log10 of the mean of each token's mixed probability and that of its path alone, weighed by how well both did for the last RECENT tokens of the document."""
        alone = stream.code.alone[stream.symbol]
        better = (mixed - alone) * np.log(10)
        ahead = np.concatenate([[0.0], np.cumsum(np.clip(better, -MOST_AHEAD, MOST_AHEAD))])
        at = np.arange(len(mixed))
        since = ahead[at] - ahead[np.maximum(np.repeat(stream.first, stream.sizes), at - RECENT)]
        trust = 1 / (1 + np.exp(-since))
        # A path's own probability is taken out, so that neither becomes too small for a double.
        return alone + np.log10(1 - trust + trust * np.exp(better))

    def spellings(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word's bytes."""
        spelling = Spelling(words)
        return np.add.reduceat(self.costs(spelling), spelling.first)

    def spelled(self, words: list[bytes], memo: dict[bytes, float]) -> list[float]:
        """`spellings`, of which `memo` keeps some."""
        if new := [w for w in words if w not in memo]:
            if len(memo) > MEMO_WORDS:
                memo.clear()
                new = words
            memo.update(zip(new, self.spellings(new).tolist(), strict=True))
        return [memo[w] for w in words]


class Learner:
    """One online pass of the mixers over training documents; each bit is predicted from the counts of all others."""

    def __init__(self, code: Code, tables: Tables):
        self.model, self.others = Model(code, tables.odds, tables.trust), tables.others
        self.bits = {kind: np.zeros(m.weights.shape[1]) for kind, m in self.model.mixers.items()}

    def add(self, texts: pa.Array | list[str | None]) -> None:
        """Learns the bits of all words of the head, ends and escapes."""
        self._learn("words", Stream(self.model.code, texts))

    def spell(self, words: list[bytes]) -> None:
        """Learns the bits of spelled words; spelling is for new words, so each distinct one counts once."""
        if words:
            self._learn("bytes", Spelling(words))

    def _learn(self, kind: str, source) -> None:
        mixer, seen = self.model.mixers[kind], self.bits[kind]
        for column in source.columns():
            inputs = self.model.inputs(source, column, lambda t, slots: self.others[t].take(slots * 2 + column.bits, mode="clip"))  # noqa: B023
            if isinstance(column.gate, int):
                parts = [(column.gate, slice(None))]
            else:
                parts = [(int(column.gate[at[0]]), at) for at in (np.flatnonzero(column.sign == 0), np.flatnonzero(column.sign)) if len(at)]
            for gate, at in parts:
                mixer.learn(inputs[:, at], gate, column.bits[at])
                seen[gate] += len(column.bits[at])

    def rows(self):
        """(kind, gate, numbers) of every gate that has seen a bit."""
        for kind, mixer in self.model.mixers.items():
            rows = mixer.rows(self.bits[kind])
            yield from ((kind, gate, rows[gate]) for gate in np.flatnonzero(self.bits[kind]).tolist())


def _fitted(code: Code, tables: Tables, rows) -> Model:
    """The model whose mixers have learned the sums of `Learner.rows`."""
    model = Model(code, tables.odds, tables.trust)
    for kind, gate, row in rows:
        model.mixers[kind].take(gate, row)
    for mixer in model.mixers.values():
        mixer.logs = mixer._logs()
    return model


def fit(code: Code, counts: dict[str, np.ndarray], texts: list[str]) -> Model:
    """Learns the mixers from training texts in one pass, with counts of 0 and 1 in turn by table."""
    counted, tables, stream = _Counts(()), Tables.empty(), Stream(code, texts)
    for t, x in counts.items():
        tables.put(t, 0, x)
    counted.add(stream)
    tables.trust[:] = counted.trust
    learner = Learner(code, tables)
    learner.add(texts)
    learner.spell(stream.rare)
    return _fitted(code, tables, learner.rows())


def _learned(docs: DataFrame, text_col: str, counts: DataFrame, code: Broadcast, tables: Tables) -> list[tuple[str, int, np.ndarray]]:
    """The sums of `Learner.rows` of one pass by task over all documents and all distinct words outside the head."""
    sent = docs.sparkSession.sparkContext.broadcast(Sent(tables))

    def of_texts(batches):
        learner = None
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                learner = learner or Learner(code.value.value, sent.value.value)
                learner.add(part.column(text_col))
        yield from out(learner.rows() if learner else ())
        del learner
        trim()

    def of_words(batches):
        learner = None
        for batch in batches:
            learner = learner or Learner(code.value.value, sent.value.value)
            learner.spell([w for w in (w.encode() for w in batch.column("word").to_pylist()) if w not in learner.model.code.number])
        yield from out(learner.rows() if learner else ())
        del learner
        trim()

    def total(batches):
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for kind, gate, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "gate", "data")), strict=True):
                row = np.frombuffer(data, np.float64)
                sums[kind, gate] = sums[kind, gate] + row if (kind, gate) in sums else row
        yield from out((*k, row) for k, row in sums.items())

    def out(rows):
        if rows := list(rows):
            kinds, gates, data = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(gates, pa.int32()), pa.array([x.tobytes() for x in data], pa.binary())], names=["kind", "gate", "data"])

    schema = "kind string, gate int, data binary"
    made = docs.select(text_col).mapInArrow(of_texts, schema).unionAll(counts.where("word is not null").select("word").mapInArrow(of_words, schema))
    made = made.repartition("kind", "gate").mapInArrow(total, schema).toArrow()
    sent.unpersist()
    return [(kind.as_py(), gate.as_py(), np.frombuffer(data.as_py(), np.float64)) for kind, gate, data in zip(*made.columns, strict=True)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """(the counts of all training words, the model)."""
    with_checkpoints(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    used = docs.select(id_col, text_col).where(F.coalesce(fold(id_col), F.lit(-1)) != HELD_OUT)
    counts = _counted(used, text_col).checkpoint()
    code = head_of(counts)
    sent = context.broadcast(Sent(code))
    tables = _tables(used, text_col, counts, sent)
    model = _fitted(code, tables, _learned(used, text_col, counts, sent, tables))
    return counts, model


#: What `_scored` makes of each text.
_SCORED = (
    "n_bytes long, n_tokens long, head_known long, head_base double, cost double, pieces array<struct<place: long, name: long, first: boolean, cost: float>>, "
    "rest array<struct<piece: int, word: string, n: int, own: int, spelled: float>>"
)


def _scored(model: Model):
    """A function from texts to their columns: sums over words of the head and bits, pieces, words outside the head by piece."""
    end_known, memo = bool(model.code.counts[-2] > 0), {}

    def work(texts: list[str | None]) -> dict:
        code, stream = model.code, Stream(model.code, texts)
        pieces = stream.pieces
        costs = model.costs(stream)
        rare = np.flatnonzero(stream.token > code.start)
        is_rare = np.zeros(len(stream.token), bool)
        is_rare[rare] = True
        head = np.where(is_rare, 0, stream.token)
        known = ~is_rare & ((head != code.end) | end_known)
        # Words outside the head, once for each piece, with how often they stand in it and in the whole text.
        word = stream.token[rare] - code.start - 1
        pairs, times = np.unique(pieces.of[rare] << 32 | word, return_counts=True)
        piece, word = pairs >> 32, pairs & 0xFFFFFFFF
        whole, inverse = np.unique(pieces.doc[piece] << 32 | word, return_inverse=True)
        own = np.bincount(inverse, times, len(whole)).astype(np.int64)[inverse]
        begins = np.searchsorted(pieces.doc, np.arange(len(texts) + 1), "left")
        spelled = np.array(model.spelled(stream.rare, memo))[word] if len(word) else np.empty(0)
        words = stream.outside.take(pa.array(word, pa.int64()))
        rest = pa.StructArray.from_arrays(
            [pa.array(piece - begins[pieces.doc[piece]], pa.int32()), words, pa.array(times, pa.int32()), pa.array(own, pa.int32()), pa.array(spelled.astype(np.float32))], names=["piece", "word", "n", "own", "spelled"]
        )
        made = pa.StructArray.from_arrays(
            [pa.array(pieces.place.view(np.int64)), pa.array(pieces.name.view(np.int64)), pa.array(pieces.firsts()), pa.array(np.add.reduceat(costs, pieces.start).astype(np.float32))], names=["place", "name", "first", "cost"]
        )
        ends = np.searchsorted(pieces.doc[piece], np.arange(len(texts) + 1), "left")
        return {
            "n_bytes": pa.array([len((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
            "n_tokens": pa.array(stream.sizes, pa.int64()),
            "head_known": pa.array(np.add.reduceat(known, stream.first), pa.int64()),
            "head_base": pa.array(np.add.reduceat(code.log_counts[head] * ~is_rare, stream.first), pa.float64()),
            "cost": pa.array(np.add.reduceat(costs, stream.first), pa.float64()),
            "pieces": pa.ListArray.from_arrays(pa.array(begins, pa.int32()), made),
            "rest": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest),
        }

    return work


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each row."""
    counts, model = train(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(Sent(model))
    code = model.code
    log_total, outside = float(np.log10(code.total + 0.1 * (code.distinct + 1))), float(code.counts[-1])
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = map_texts(named, ["id"], "text", f"id {dict(docs.dtypes)[id_col]}, {_SCORED}", lambda: _scored(sent.value.value))
    held_out = F.coalesce(fold("id") == HELD_OUT, F.lit(False))
    scored = scored.withColumn("held_out", held_out).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    pieces = scored.select("row", (~F.col("held_out")).alias("taught"), F.posexplode("pieces").alias("piece", "p")).select("row", "piece", "taught", "p.*").where("place <> 0")
    predicted = predictions(pieces).checkpoint()
    likely = F.array(*(F.struct(F.lit(wrong).alias("wrong"), F.lit(right).alias("right")) for wrong, right in chances(predicted)))
    chance = F.get(likely, F.col("class"))
    chosen = F.when(F.col("right"), chance["right"] - F.col("cost").cast("double")).otherwise(chance["wrong"])
    none = F.lit(0.0)
    rare = scored.select("row", "held_out", F.explode("rest").alias("r")).select("row", "held_out", "r.*").join(counts.withColumnRenamed("n", "met"), "word", "left")
    met = F.coalesce("met", F.lit(0))
    others = F.greatest(met - F.when(F.col("held_out"), 0).otherwise(F.col("own")), F.lit(0))
    share = F.lit(code.met) * others / F.lit(max(1.0, outside)) + F.lit(1 - code.met) * F.pow(F.lit(10.0), F.col("spelled").cast("double"))
    # What is too unlikely for a double is taken as spelled.
    spelled = F.col("n") * F.when(share > 0, F.log10(share)).otherwise(F.log10(F.lit(1 - code.met)) + F.col("spelled"))
    rare = rare.select(
        "row", "piece", F.lit(None).cast("boolean").alias("right"), none.alias("chosen"), spelled.alias("spelled"), (F.col("n") * F.log10(met + 0.1)).alias("base"), F.when(met > 0, F.col("n")).otherwise(0).cast("long").alias("known")
    )
    both = rare.unionByName(predicted.select("row", "piece", "right", chosen.alias("chosen"), none.alias("spelled"), none.alias("base"), F.lit(0).cast("long").alias("known"))).repartition("row")
    by_piece = both.groupBy("row", "piece").agg(F.coalesce(F.bool_or("right"), F.lit(False)).alias("right"), *(F.sum(c).alias(c) for c in ("chosen", "spelled", "base", "known")))
    # The words of a piece that was predicted cost nothing of their own.
    more = by_piece.groupBy("row").agg(F.sum(F.col("chosen") + F.when(F.col("right"), 0.0).otherwise(F.col("spelled"))).alias("more"), F.sum("base").alias("base"), F.sum("known").alias("known"))
    whole = scored.drop("rest", "pieces").join(more, "row", "left")
    score = F.col("cost") + F.coalesce("more", none)
    return whole.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(code.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("base", none) - F.col("n_tokens") * F.lit(log_total)).alias("base_score"),
        score.alias("score"),
        F.when(F.col("n_bytes") > 0, -score / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"),
    )

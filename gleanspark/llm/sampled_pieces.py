"""Sampled SentencePiece segmentations without replacement, and their decoding.

A text's lattice has an edge for every vocabulary piece that matches at a character. Pieces are weighed
by the rank that the model file gives them (Zipf's law, as the vocabulary's scores are ranks), and a
segmentation's probability is its share of the total weight of all segmentations of the text. Draws are
made by perturbed A* search: the whole space gets a Gumbel value; a segmentation is drawn from the space
with the best value, and what is left of the space is cut into the sets of segmentations that leave the
drawn one at each of its edges, each with its own Gumbel value below that of the space it came from. The
sets wait in the queue, the best is cut next, and so the first k draws are the Gumbel top k: distinct, and
distributed as draws without replacement. With the best value that is left, kappa, a draw's inclusion
score is the chance that its perturbed value exceeds kappa, 1 - exp(-exp(log_prob - kappa)).

No piece reaches across a run of spaces that starts a word or across a newline, so lattices are built for
distinct words of a slice of rows, and all words of the slice walk through them together. Random numbers
are hashes of row key, draw and place, so a row gives the same draws in any run, task or slice.

Edge cases: a null or empty text has no pieces and one segmentation, the empty one, with log_prob 0 and
inclusion 1; a text with fewer segmentations than `draws` gives as many as it has; equal keys and texts
give equal draws; a null key seeds like the text "null"; characters that are no pieces become bytes; equal
values, which draws of 64 bits all but rule out, go to the set made first; a model with pieces that reach across words, which
lattices of words cannot hold, is refused with a ValueError; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanspark.llm.arrowmap import slices, trim

DRAWS = 2
SPACE = "▁"
SLICE_BYTES = 2_000_000
#: Words of the first slice that stay at most, and words whose edges are sought at a time.
KEPT_WORDS, STEP_WORDS = 100_000, 30_000
_WORDS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
_STEP = np.uint64(0x9E3779B97F4A7C15)
SLOT_BITS = 17


def _uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), hashed from 64-bit keys."""
    x = keys * _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _running(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Running sums from each place of `at` to the next, each by itself, so that they do not depend on what stands before."""
    out, sizes = np.array(values, np.float64), np.diff(at)
    if len(sizes) and sizes.max() > 64:  # few and long: paths of documents
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            np.cumsum(values[a:b], out=out[a:b])
        return out
    for j in range(1, int(sizes.max(initial=1))):  # many and short: edges of states
        here = at[:-1][sizes > j] + j
        out[here] += out[here - 1]
    return out


def _slots_of(hashes: np.ndarray) -> list[np.ndarray]:
    """Tables from a hash's upper bits to its place; what finds its slot taken goes to the next table."""
    tables, rest = [], np.arange(len(hashes))
    slots = (hashes * _STEP >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    while len(rest):
        table = np.full(1 << SLOT_BITS, -1, np.int32)
        table[slots[rest]] = rest
        tables.append(table)
        rest = rest[table[slots[rest]] != rest]
    return tables


class Pieces:
    """The vocabulary of a model file: strings, weights and bytes."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        text = {i: model.id_to_piece(i) for i in normal}
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in text.values()):
            raise ValueError("pieces of this model reach across words")
        self.logs = np.full(n, -np.log(2.0 * n))
        self.logs[normal] = -np.log(2.0 - np.array([model.get_score(i) for i in normal]))
        self.bytes_at = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        surface = [b""] * n
        for i, p in text.items():
            surface[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes_at.tolist()):
            surface[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array(list(map(len, surface)))
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.by_length = {}
        for length in sorted({len(p) for p in text.values()}):
            ids = np.array([i for i in normal if len(text[i]) == length])
            chars = np.asfortranarray([list(map(ord, text[i])) for i in ids.tolist()], np.uint32)
            hashes = np.zeros(len(ids), np.uint64)
            for j in range(length):
                hashes = hashes * _STEP + chars[:, j] + np.uint64(1)
            self.by_length[length] = hashes, ids, chars, _slots_of(hashes)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that pieces stand for, the leading space included."""
        sizes = self.surface_size[ids]
        shift = self.surface_at[ids] - (np.cumsum(sizes) - sizes)
        return self.surface[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()


@lru_cache(maxsize=1)
def pieces_of(model_file: str) -> Pieces:
    return Pieces(model_file)


class Lattice:
    """All edges of distinct words; those that leave a character stand together, the longest first."""

    def __init__(self, words: list[str], pieces: Pieces):
        sizes = np.array(list(map(len, words)), np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(chars)
        left = np.repeat(self.ends, sizes) - np.arange(n)
        # Edges of each length; a key of (characters left, character, shorter last) brings them in order.
        rank = (left * n + np.arange(n)) * 32 + 31
        keys, piece, logs = [], [], []
        hashes, held = np.zeros(n, np.uint64), np.arange(n)
        for size in range(1, max(pieces.by_length) + 1):
            more = left[held] >= size
            hashes, held = hashes[more], held[more]
            hashes = hashes * _STEP + chars[held + (size - 1)] + np.uint64(1)
            if size not in pieces.by_length:
                continue
            known, ids, text, tables = pieces.by_length[size]
            slots = (hashes * _STEP >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            maybe, found = [], []
            for table in tables:
                place = table.take(slots, mode="clip")
                here = np.flatnonzero(place >= 0)
                place = place.take(here, mode="clip")
                same = known.take(place, mode="clip") == hashes.take(here, mode="clip")
                maybe.append(held.take(here[same], mode="clip"))
                found.append(place[same])
            maybe, found = np.concatenate(maybe), np.concatenate(found)
            same = np.ones(len(maybe), bool)
            for j in range(size):
                same &= chars.take(maybe + j, mode="clip") == text[:, j].take(found, mode="clip")
            if not same.all():
                maybe, found = maybe[same], found[same]
            if size == 1:
                lone = np.ones(n, bool)
                lone[maybe] = False
            keys.append(rank.take(maybe, mode="clip") - size)
            piece.append(ids.take(found, mode="clip"))
            logs.append(pieces.logs.take(piece[-1], mode="clip"))
        # What is no piece becomes bytes.
        lone = np.flatnonzero(lone)
        code = chars[lone]
        self.bytes_of = np.ones(n, np.int8)
        self.bytes_of[lone] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        keys, piece = np.concatenate([*keys, rank[lone] - 1]), np.concatenate([*piece, np.full(len(lone), -1)])
        logs = np.concatenate([*logs, self.bytes_of[lone] * (2 * pieces.logs.min())])
        order = np.argsort(keys)
        keys, self.piece, logs = keys.take(order, mode="clip"), piece.astype(np.int32).take(order, mode="clip"), logs.take(order, mode="clip")
        length = 31 - (keys & 31)
        at = (keys >> 5) % n
        del keys, order, piece, rank, hashes, held
        # Total weight of what follows each character, from the words' ends backwards.
        beta, share = np.zeros(n + 1), np.empty(len(at))
        begins = np.flatnonzero(np.diff(at, prepend=-1))
        self.first = np.zeros(n + 1, np.int64)
        self.first[at[begins]] = begins
        self.out = np.zeros(n + 1, np.int64)
        self.out[at[begins]] = np.diff(begins, append=len(at))
        levels = left[at]
        cuts = np.flatnonzero(np.diff(levels, prepend=0))
        follows = np.where(length < levels, at + length, n)  # beta[n] stays 0 for a word's end
        marks = np.searchsorted(begins, [*cuts.tolist(), len(at)])
        for i, (a, b) in enumerate(zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)], strict=True)):
            total = logs[a:b] + beta.take(follows[a:b], mode="clip")
            own = begins[marks[i] : marks[i + 1]]
            weight = np.logaddexp.reduceat(total, own - a)
            beta[at.take(own, mode="clip")] = weight
            share[a:b] = total - np.repeat(weight, np.diff(own, append=b))
        del levels, follows, logs
        self.length, self.log = length.astype(np.int8), np.minimum(share, 0.0, out=share)
        p = np.exp(self.log)
        self.below = _running(p, np.append(begins, len(at))).astype(np.float32)
        self.below[np.append(begins[1:], len(at)) - 1] = 1.0
        single = self.out.take(at, mode="clip") == 1
        self.log[single] = 0.0
        with np.errstate(divide="ignore"):
            self.log_other = np.log(-np.expm1(np.minimum(self.log, -1e-15))).astype(np.float32)
        self.log_other[single] = -np.inf
        self.chars, self.left = chars, np.append(left, 0)

    @staticmethod
    def of(words: list[str], pieces: Pieces) -> list[Lattice]:
        """Lattices of STEP_WORDS words each, which bounds the memory of the search for edges."""
        return [Lattice(words[at : at + STEP_WORDS], pieces) for at in range(0, len(words), STEP_WORDS)]

    @staticmethod
    def joined(parts: list[Lattice]) -> Lattice:
        """Several lattices as one, their words in this order."""
        if len(parts) == 1:
            return parts[0]
        made = object.__new__(Lattice)
        places = np.cumsum([0, *(len(p.chars) for p in parts[:-1])]).tolist()
        edges = np.cumsum([0, *(len(p.log) for p in parts[:-1])]).tolist()
        for name in ("piece", "length", "below", "log", "log_other", "bytes_of", "chars"):
            setattr(made, name, np.concatenate([getattr(p, name) for p in parts]))
        for name, shifts, end in (("starts", places, None), ("ends", places, None), ("first", edges, -1), ("out", [0] * len(parts), -1), ("left", [0] * len(parts), -1)):
            setattr(made, name, np.concatenate([getattr(p, name)[:end] + s for p, s in zip(parts, shifts, strict=True)] + ([[0]] if end else [])))
        return made

    def walk(self, states: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Draws the rest of each word from its state on: (edges, their states, edges of each word)."""
        live, now, steps = np.arange(len(states)), states, []
        counts = np.zeros(len(states), np.int64)
        keys = keys.copy()
        while len(live):
            edge, u = self.first.take(now, mode="clip"), _uniform(keys)
            turn = np.flatnonzero(u >= self.below.take(edge, mode="clip"))
            while len(turn):
                edge[turn] += 1
                turn = turn[u[turn] >= self.below[edge[turn]]]
            steps.append((live, edge, now))
            counts[live] += 1
            size = self.length.take(edge, mode="clip")
            more = self.left.take(now, mode="clip") > size
            live, now, keys = live[more], (now + size)[more], (keys + np.uint64(1))[more]
        at = np.cumsum(counts) - counts
        edges, places = np.empty(int(counts.sum()), np.int64), np.empty(int(counts.sum()), np.int64)
        for i, (who, edge, now) in enumerate(steps):
            edges[at[who] + i] = edge
            places[at[who] + i] = now
        return edges, places, counts

    def ids(self, edges: np.ndarray, states: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """(token ids, tokens of each edge)."""
        piece = self.piece.take(edges, mode="clip")
        spelled = np.flatnonzero(piece < 0)
        width = np.ones(len(edges), np.int64)
        width[spelled] = self.bytes_of[states[spelled]]
        ids = np.repeat(piece, width)
        if len(spelled):
            at = np.cumsum(width) - width
            code, at, size = self.chars[states[spelled]], at[spelled], width[spelled]
            for j in range(4):
                some = np.flatnonzero(size > j)
                c, w = code[some].astype(np.int64), size[some]
                rest = (c >> (6 * (w - 1 - j))) & 0x3F | 0x80
                head = np.where(w == 1, c, np.where(w == 2, 0xC0 | c >> 6, np.where(w == 3, 0xE0 | c >> 12, 0xF0 | c >> 18)))
                ids[at[some] + j] = pieces.bytes_at[head if j == 0 else rest]
        return ids, width


def _seed(key) -> int:
    return int.from_bytes(hashlib.blake2b(str("null" if key is None else key).encode(), digest_size=8).digest(), "little")


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _below(value: float, mass: float, u: float) -> float:
    """A Gumbel value of a set with this log mass, given that it is below `value`."""
    a, b = -value, math.log(-math.log(u)) - mass
    return -(max(a, b) + math.log1p(math.exp(-abs(a - b))))


class _Path:
    """One draw of every text of a slice: edges, their states and words, and the queue of sets left behind."""

    def __init__(self, edges, states, words, at):
        self.edges, self.states, self.words, self.at = edges, states, words, at
        self.value = np.empty(0)


class Sampler:
    def __init__(self, model_file: str, draws: int = DRAWS):
        self.pieces, self.draws = pieces_of(model_file), draws
        #: Words that the first slice has more than once, and their lattice, which later slices share.
        self.known, self.kept = _Numbers(), None

    def __call__(self, keys: list, texts: list[str | None]):
        """Yields (row, draw, ids, log_prob, value, log_inclusion) for the texts, in no set order."""
        split = [_WORDS.findall(f"{SPACE}{t}".replace(" ", SPACE)) if t else [] for t in texts]
        if self.kept is None:
            common = [w for w, n in Counter(chain.from_iterable(split)).most_common(KEPT_WORDS) if n > 1]
            self.known, self.kept = _Numbers(zip(common, range(len(common)), strict=True)), Lattice.of(common, self.pieces)
        index = _Numbers(self.known)
        sizes = np.array(list(map(len, split)), np.int64)
        number = np.fromiter(map(index.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        full = np.flatnonzero(sizes)
        seeds = np.array(list(map(_seed, keys)), np.uint64)
        for row in np.flatnonzero(sizes == 0).tolist():
            yield row, 1, np.empty(0, np.int64), 0.0, -np.log(-np.log(_uniform(seeds[row : row + 1])))[0], 0.0
        if not len(full):
            return
        lattice = Lattice.joined([*self.kept, *Lattice.of(list(index)[len(self.known) :], self.pieces)])
        if len(self.kept) > 1:
            self.kept = [Lattice.joined(self.kept)]
        ends = np.cumsum(sizes)
        yield from _Search(lattice, self.pieces, lattice.starts[number], (ends - sizes)[full], ends[full], seeds[full], self.draws).run(full)


class _Search:
    def __init__(self, lattice, pieces, states, first, end, seeds, draws):
        self.lattice, self.pieces, self.states, self.first, self.end, self.seeds, self.draws = lattice, pieces, states, first, end, seeds, draws
        self.paths: list[_Path] = []
        #: Sets left at a branch that was taken before: (value, path, place, edges taken) by row.
        self.again: list[list[tuple]] = [[] for _ in seeds]

    def _keys(self, rows: np.ndarray, draw: int, places: np.ndarray) -> np.ndarray:
        x = self.seeds[rows] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(draw)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) + (places.astype(np.uint64) << np.uint64(20))

    def _words(self, rows, draw, words, states):
        """Walks words (numbers within the slice) of rows from the given states on."""
        return self.lattice.walk(states, self._keys(rows, draw, words - self.first[rows]))

    def run(self, names: np.ndarray):
        n = len(self.seeds)
        rows = np.repeat(np.arange(n), self.end - self.first)
        words = np.arange(int(self.first[0]), int(self.end[-1])) if n else np.empty(0, np.int64)
        edges, states, counts = self._words(rows, 1, words, self.states[words])
        at = np.concatenate([[0], np.cumsum(counts)])[np.append(self.first, self.end[-1]) - self.first[0]]
        values = -np.log(-np.log(_uniform(self._keys(np.arange(n), 0, np.zeros(n, np.int64)))))
        path = _Path(edges, states, np.repeat(words, counts), at)
        emitted = [self._emit(path, np.arange(n), values, 1)]
        self._cut(path, np.arange(n), values, np.zeros(n, np.int64), 1)
        for draw in range(2, self.draws + 1):
            chosen = [(row, *top) for row in range(n) if (top := self._pop(row)) is not None]
            if not chosen:
                break
            path, rows, values, places = self._branch(chosen, draw)
            emitted.append(self._emit(path, rows, values, draw))
            self._cut(path, rows, values, places + 1, draw)
        kappa = np.array([self._top(row)[0] for row in range(n)])
        for draw, (rows, ids, at, logs, values) in enumerate(emitted, 1):
            gap = logs - kappa[rows]
            # log(1 - exp(-exp(gap))), whose leading term is gap itself where that is small.
            inclusion = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.clip(gap, -30, 30)))))
            for i, row in enumerate(rows.tolist()):
                yield int(names[row]), draw, ids[at[i] : at[i + 1]], float(logs[i]), float(values[i]), float(min(0.0, inclusion[i]))

    def _emit(self, path, rows, values, draw):
        ids, width = self.lattice.ids(path.edges, path.states, self.pieces)
        at = np.concatenate([[0], np.cumsum(width)])[path.at]
        logs = np.add.reduceat(self.lattice.log.take(path.edges, mode="clip"), path.at[:-1])
        return rows, ids.astype(np.int32), at, logs, values

    def _cut(self, path, rows, values, free, draw) -> None:
        """Values for the sets that leave a path at each edge from `free` on."""
        sizes = np.diff(path.at)
        log = self.lattice.log.take(path.edges, mode="clip")
        run = _running(log, path.at) - log
        mass = run + self.lattice.log_other.take(path.edges, mode="clip")
        place = np.arange(len(log)) - np.repeat(path.at[:-1], sizes)
        mass[place < np.repeat(free, sizes)] = -np.inf
        u = _uniform(self._keys(np.repeat(rows, sizes), 1000 + draw, place))
        with np.errstate(divide="ignore"):
            path.value = -np.logaddexp(-np.repeat(values, sizes), np.log(-np.log(u)) - mass)
        path.log_before = run
        path.row = dict(zip(rows.tolist(), range(len(rows)), strict=True))
        top = np.maximum.reduceat(path.value, path.at[:-1])
        path.top = top
        self.paths.append(path)

    def _top(self, row: int) -> tuple[float, int, int]:
        """(value, path, place) of the best set left; path -1 - i for one of `again`."""
        best = (-np.inf, 0, 0)
        for q, path in enumerate(self.paths):
            i = path.row.get(row)
            if i is not None and path.top[i] > best[0]:
                best = (float(path.top[i]), q, -1)
        for j, (value, *_) in enumerate(self.again[row]):
            if value > best[0]:
                best = (value, -1 - j, -1)
        return best

    def _pop(self, row: int):
        value, q, _ = self._top(row)
        if value == -np.inf:
            return None
        if q < 0:
            _, path, place, taken = self.again[row].pop(-1 - q)
            return value, path, place, taken
        path = self.paths[q]
        i = path.row[row]
        own = path.value[path.at[i] : path.at[i + 1]]
        place = int(own.argmax())
        own[place] = -np.inf
        path.top[i] = own.max()
        return value, q, place, [int(path.edges[path.at[i] + place])]

    @staticmethod
    def _picked(out: list[tuple[int, float]], u: float) -> tuple[int, float]:
        """(one of weighted edges, drawn by u; what the others weigh)."""
        left = u * sum(w for _, w in out)
        edge = out[-1][0]
        for e, w in out:
            left -= w
            if left < 0:
                edge = e
                break
        return edge, sum(w for e, w in out if e != edge)

    def _branch(self, chosen, draw):
        """Draws a segmentation from each chosen set."""
        lattice, heads, spans = self.lattice, [], []
        rows, values, places = (np.array(x) for x in zip(*((c[0], c[1], c[3]) for c in chosen), strict=True))
        u = _uniform(self._keys(rows, 2000 + draw, np.zeros(len(rows), np.int64)))
        again = _uniform(self._keys(rows, 3000 + draw, np.zeros(len(rows), np.int64)))
        for (row, value, q, place, taken), x, y in zip(chosen, u.tolist(), again.tolist(), strict=True):
            path = self.paths[q]
            at = int(path.at[path.row[row]])
            state, word = int(path.states[at + place]), int(path.words[at + place])
            start = int(lattice.first[state])
            logs = lattice.log[start : start + int(lattice.out[state])].tolist()
            out = [(start + i, math.exp(log)) for i, log in enumerate(logs) if start + i not in taken]
            edge, others = self._picked(out, x)
            if others > 0:
                mass = float(path.log_before[at + place]) + math.log(others)
                self.again[row].append((_below(value, mass, y), len(self.paths), place, [*taken, edge]))
            after = state + int(lattice.length[edge])
            heads.append((path, at, place, edge, state, word))
            spans.append((word, after) if lattice.left[state] > lattice.length[edge] else (word + 1, -1))
        ends = self.end[rows]
        sizes = np.maximum(0, ends - np.array([w for w, _ in spans]))
        words = np.concatenate([np.arange(w, e) for (w, _), e in zip(spans, ends.tolist(), strict=True)])
        states = self.states[words]
        cut = np.cumsum(sizes) - sizes
        for (_, after), at in zip(spans, cut.tolist(), strict=True):
            if after >= 0:
                states[at] = after
        edges, states, counts = self._words(np.repeat(rows, sizes), draw, words, states)
        named = np.repeat(words, counts)
        total = np.concatenate([[0], np.cumsum(counts)])
        made: tuple[list, list, list] = ([], [], [])
        for (path, at, place, edge, state, word), a, size in zip(heads, cut.tolist(), sizes.tolist(), strict=True):
            x, y = int(total[a]), int(total[a + size])
            made[0].extend((path.edges[at : at + place], [edge], edges[x:y]))
            made[1].extend((path.states[at : at + place], [state], states[x:y]))
            made[2].extend((path.words[at : at + place], [word], named[x:y]))
        lengths = places + 1 + np.array([int(total[a + s] - total[a]) for a, s in zip(cut.tolist(), sizes.tolist(), strict=True)])
        joined = [np.concatenate(x).astype(np.int64) for x in made]
        return _Path(*joined, np.concatenate([[0], np.cumsum(lengths)])), rows, values, places


def sample_pieces(
    docs: DataFrame, model_file: str, draws: int = DRAWS, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """Rows (id, draw, n_tokens, log_prob, log_inclusion, round_trip, ids) for each draw of each row; map-only.

    `round_trip` tells whether the ids decode to the text (spaces for ▁, as the library has it).
    With `digest` the ids are given as ids_sha256, of their 32-bit little-endian numbers.
    """
    kind = dict(docs.dtypes)[id_col]
    last = "ids_sha256 string" if digest else "ids array<int>"
    schema = f"`{id_col}` {kind}, draw int, n_tokens long, log_prob double, log_inclusion double, round_trip boolean, {last}"
    names = [id_col, "draw", "n_tokens", "log_prob", "log_inclusion", "round_trip", last.split()[0]]

    def run(batches):
        sampler = Sampler(model_file, draws)
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                texts = part.column(text_col).to_pylist()
                plain = [f" {t}".replace(SPACE, " ").encode() if t else b"" for t in texts]
                out = [
                    (row, draw, len(ids), log, inclusion, sampler.pieces.decode(ids) == plain[row], hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest() if digest else ids)
                    for row, draw, ids, log, _, inclusion in sampler(part.column(id_col).to_pylist(), texts)
                ]
                rows, *columns = zip(*out, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.string() if digest else pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(id_col).take(pa.array(rows)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)
        del sampler
        trim()

    return docs.select(*dict.fromkeys([id_col, text_col])).mapInArrow(run, schema)

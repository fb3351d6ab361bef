import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward

from gleanspark.llm import context_mixing, passages
from gleanspark.llm.context_mixing import BYTE_TABLES, WORD_TABLES, Code, Spelling, Stream, fit, huffman_lengths, score_documents, words_of


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 == 0


def base(rows):
    train = Counter()
    for i, text in rows:
        if not held_out(i):
            train.update([*words_of(text), None])
    total, distinct = sum(train.values()), len(train)
    out = {}
    for i, text in rows:
        tokens = [*words_of(text), None]
        score = sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out[i] = held_out(i), len(tokens), sum(train[t] > 0 for t in tokens), total, score
    return out


@pytest.mark.parametrize("head", [context_mixing.HEAD, 300])
def test_base_columns_and_gain(spark, monkeypatch, head):
    monkeypatch.setattr(context_mixing.head_of, "__defaults__", (head,))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, got = base(rows), {r.doc_id: r for r in score_documents(docs).collect()}
    for i, (out, tokens, known, total, score) in want.items():
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (out, tokens, known, total)
        assert math.isclose(got[i].base_score, score, rel_tol=1e-9)
    fresh = [r for r in got.values() if r.held_out]
    if head > 300:
        assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)
    assert all(r.score < 0 for r in got.values())


def small(more=()):
    texts = [*more] + ["the cat sat on the mat", "the dog sat on the cat", "a cat a cat a cat a cat", "zebra on a mat"] * 3
    counts = Counter(w for t in texts for w in words_of(t))
    head = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:6]
    rest = sum(counts.values()) - sum(n for _, n in head)
    code = Code([w for w, _ in head], np.array([*(n for _, n in head), len(texts), rest]), sum(counts.values()) + len(texts), len(counts) + 1)
    words, spelled = context_mixing._Counts(WORD_TABLES), context_mixing._Counts(BYTE_TABLES)
    words.add(Stream(code, texts, follow=False))
    rare = [(w, n) for w, n in counts.items() if w not in code.number]
    spelled.add(Spelling([w for w, _ in rare]))
    return fit(code, words.tables | spelled.tables, texts), code


def test_probabilities_add_up():
    """After any start, the head's words, the end and the escape share a probability of 1."""
    model, code = small()
    for start in ("", "the", "the cat sat on the", "zebra q", "a cat a cat a"):
        total = 0.0
        for last in [*(w.decode() for w in code.words), "", "unheardof"]:
            stream = Stream(code, [f"{start} {last}"])
            costs = model.costs(stream)
            at = len(words_of(start))
            total += 10.0 ** costs[at]
        assert math.isclose(total, 1, abs_tol=1e-5), start
    # So do the bytes at each place of a rare word.
    for start in (b"", b"ze", b"cat-like"):
        ends = [Spelling([start + bytes([b])]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)] + [Spelling([start])] + [Spelling([start + b"\t"]), *(Spelling([start + bytes([b])]) for b in range(10, 14))]
        assert math.isclose(sum(10.0 ** float(model.costs(s)[len(start)]) for s in ends), 1, abs_tol=1e-4)


def test_codes_are_whole_and_prefix_free():
    rng = np.random.default_rng(2)
    for n in (2, 3, 17, 400):
        counts = np.sort(rng.integers(1, 10**6, n))[::-1]
        assert sum(2.0 ** -huffman_lengths(counts)) == 1
    _, code = small()
    paths = [tuple(code.bits[a : a + n]) for a, n in zip(code.at.tolist(), code.lengths.tolist(), strict=True)]
    assert all(a != b[: len(a)] for a, b in itertools.permutations(paths, 2))


def test_follower_sees_the_past_only():
    model, code = small()
    a, b = (model.costs(Stream(code, [f"the cat sat on the cat {end}"])) for end in ("sat on a mat", "a a a a a"))
    assert np.allclose(a[:6], b[:6]) and np.isfinite(a).all()
    alone = model.costs(Stream(code, ["a cat"]))
    assert np.allclose(model.costs(Stream(code, ["the dog sat", "a cat", "q"]))[4:7], alone, rtol=1e-5)


def test_repetition_becomes_cheap():
    rng = np.random.default_rng(5)
    words = "the cat sat on mat dog a".split()
    model, code = small([" ".join([*rng.choice(words, 6)] * 20) for _ in range(60)])
    costs = model.costs(Stream(code, ["the cat sat on " * 30]))
    assert costs[80:110].mean() > costs[:4].mean() / 2


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = score_documents(docs).collect()
    assert len(rows) == 11 and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    one = [r for r in rows if r.doc_id == 1][0]
    assert (one.n_tokens, one.bits_per_byte) == (1, None)
    assert len({(r.n_tokens, r.n_known, r.base_score) for r in rows if r.doc_id == 4}) == 1
    assert score_documents(docs.limit(0)).count() == 0
    unseen = score_documents(docs.where("doc_id = 4").selectExpr("10L AS doc_id", "text")) if held_out(10) else None
    lonely = next(i for i in range(1000) if held_out(i))
    unseen = unseen or score_documents(docs.where("doc_id = 4").selectExpr(f"{lonely}L AS doc_id", "text"))
    assert [(r.n_known, r.train_tokens) for r in unseen.collect()] == [(0, 0)] * 2


def test_every_bit_is_asked_in_every_context():
    """Deep bits too: of a long code, the last bits tell two rare words apart by the word before."""
    counts = [2**k for k in range(17, 0, -1)]
    words = [b"w%d" % k for k in range(len(counts))]
    code = Code(words, np.array([*counts, 3, 1]), sum(counts) + 4, len(words) + 2)
    deep = [w.decode() for w in sorted(words, key=lambda w: code.lengths[code.number[w]])[-2:]]
    texts = [f"w0 {deep[0]}", f"w1 {deep[1]}"] * 40
    counted, stream = context_mixing._Counts(WORD_TABLES), Stream(code, texts)
    assert code.lengths[stream.symbol].max() > 14
    counted.add(stream)
    bits = int(code.lengths[stream.symbol].sum())
    assert {t: int(x.sum()) for t, x in counted.tables.items()} == dict.fromkeys(("before", "two", "endings"), bits)
    model = fit(code, counted.tables | {t: np.zeros(2 << context_mixing.TABLE_BITS, np.uint32) for t in context_mixing.BYTE_TABLES}, texts)
    for column in stream.columns():
        assert all(len(x) == len(column.bits) for x in model.inputs(stream, column, lambda t, slots: slots))
    right, wrong = (model.costs(Stream(code, [f"{a} {deep[0]}"]))[1] for a in ("w0", "w1"))
    assert right > wrong


def test_mixers_learn_from_every_training_document(spark):
    """More documents than a sample would hold, and long ones, each bit once."""
    rng = np.random.default_rng(7)
    names = [f"w{int(k)}" for k in rng.zipf(1.5, 40_000) % 900]
    rows = [(i, " ".join(names[i * 9 : i * 9 + 9])) for i in range(400)] + [(1000 + i, " ".join(names[i * 9000 : i * 9000 + 9000])) for i in range(3)]
    used = [t for i, t in rows if not held_out(i)]
    assert len(used) > 300 and max(map(len, used)) > 20_000
    _, model = context_mixing.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    code = model.code
    stream = Stream(code, used)
    seen = {kind: m.seen.sum() - 4 * m.seen.size for kind, m in model.mixers.items()}
    assert math.isclose(seen["words"], code.lengths[stream.symbol].sum(), rel_tol=1e-6)
    assert stream.rare and math.isclose(seen["bytes"], 8 * sum(len(w) + 1 for w in stream.rare), rel_tol=1e-6)


def plain_scores(rows, model):
    """Scores by loops over documents, pieces and words; only bits are left to the model."""
    code, memo = model.code, {}
    parts, counts = {}, Counter()
    for i, text in rows:
        stream = Stream(code, [text])
        costs, pieces = model.costs(stream), stream.pieces
        words = [*words_of(text), None]
        cuts = [*pieces.start.tolist(), len(words)]
        parts[i] = [(int(pieces.place[k]), int(pieces.name[k]), words[a:b], sum(costs[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        if not held_out(i):
            counts.update(words)
    followed: dict = {}
    for i, _ in rows:
        if not held_out(i):
            for place, name in {p[:2] for p in parts[i] if p[0]}:
                followed.setdefault(place, Counter())[name] += 1
    signed = lambda x: x - 2**64 if x >> 63 else x

    def events(i):
        last = []
        for k, (place, name, _, _) in enumerate(parts[i]):
            best = sorted(((n, signed(s), s) for s, n in followed.get(place, {}).items()), reverse=True)[:2] if place else []
            own = [(n - (not held_out(i) and s == name), -r, s) for r, (n, _, s) in enumerate(best)]
            if not own or max(own)[0] < 1:
                continue
            n, _, s = max(own)
            rival = len(own) > 1 and min(own)[0] > 0
            run = 0
            if last and last[-1] == (k - 1, True):
                run = 2 if len(last) > 1 and last[-2] == (k - 2, True) else 1
            last.append((k, s == name))
            yield k, s == name, (min(n, 4), rival, run)

    told = {i: list(events(i)) for i, _ in rows}
    right, all_ = Counter(), Counter()
    for i, _ in rows:
        for _, ok, kind in told[i]:
            if not held_out(i):
                all_[kind] += 1
                right[kind] += ok
    out, outside = {}, float(code.counts[-1])
    for i, _ in rows:
        own, foretold, score = Counter(w for p in parts[i] for w in p[2]), {k: (ok, kind) for k, ok, kind in told[i]}, 0.0
        for k, (_, _, words, cost) in enumerate(parts[i]):
            ok, kind = foretold.get(k, (None, None))
            if ok:
                score += math.log10((right[kind] + 0.5) / (all_[kind] + 1))
                continue
            if ok is False:
                score += math.log10((all_[kind] - right[kind] + 0.5) / (all_[kind] + 1))
            score += cost
            for w in words:
                if w is not None and w not in code.number:
                    others = max(0, counts[w] - (0 if held_out(i) else own[w]))
                    score += math.log10(code.met * others / outside + (1 - code.met) * 10 ** model.spelled([w], memo)[0])
        out[i] = score
    return out


def test_scores_equal_plain_loops(spark, monkeypatch):
    """Passages, words outside the head and sums, on documents with copies, copies in part and repeats."""
    monkeypatch.setattr(context_mixing.head_of, "__defaults__", (400,))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, (_, t) in enumerate(rows[:60])] + [(20_000 + i, (t or "")[: len(t or "") // 2] + " " + (rows[i + 3][1] or "")) for i, (_, t) in enumerate(rows[:40])] + [(30_000, rows[5][1] * 2), (30_001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, model = context_mixing.train(docs)
    monkeypatch.setattr(context_mixing, "train", lambda *a, plain=context_mixing.train: (plain(*a)[0], model))
    got, want = {r.doc_id: r.score for r in score_documents(docs).collect()}, plain_scores(rows, model)
    assert set(got) == set(want)
    for i, score in want.items():
        assert math.isclose(got[i], score, rel_tol=1e-6), i
    assert len({r for r in got.values()}) > 200


def test_copies_score_apart(spark):
    """A document that occurs twice costs far less than it would alone; a document that occurs once does not count for itself."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 600").dropDuplicates(["text"])
    chosen = [r.doc_id for r in docs.where("doc_id % 11 = 3").collect()]
    twice = docs.unionByName(docs.where(docs.doc_id.isin(chosen)).withColumn("doc_id", docs.doc_id + 10**6))
    once, more = ({r.doc_id: r.bits_per_byte for r in score_documents(d).collect()} for d in (docs, twice))
    fell = [more[i] / once[i] for i in chosen if once[i] > 1]
    assert len(fell) > 30 and np.quantile(fell, 0.9) < 0.6
    others = [more[i] / once[i] for i in once if i not in chosen]
    assert np.quantile(others, 0.1) > 0.9


def test_pieces_are_cut_alike():
    """Copies inside other texts have the same pieces, but for the first and the last."""
    rng = np.random.default_rng(3)
    _, code = small()
    text = " ".join(f"w{x}" for x in rng.integers(0, 500, 400))
    a, b = (Stream(code, [t]).pieces for t in (text, f"some other words first {text} and more"))
    shared = set(zip(a.place.tolist(), a.name.tolist())) & set(zip(b.place.tolist(), b.name.tolist()))
    assert len(shared) >= len(a.name) - 3 and len(a.name) > 10
    assert a.start[0] == 0 and a.place[0] == 0 and (a.place[1:] != 0).all()
    one = Stream(code, ["", None, "a"]).pieces
    assert len(one.start) >= 3 and one.place[0] == one.place[1] == 0 and passages.CLASSES == 30


def test_words_are_split_alike():
    """Columns and plain Python agree on white space at the ends and inside, on what only Unicode calls a space, and on cut arrays."""
    rng = np.random.default_rng(11)
    signs = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", " ", "\x00", "A", "Zz", "Ä", "\U0001f600"]
    texts = ["", None, " ", "\n a", "a \t", *("".join(rng.choice(signs, rng.integers(0, 9))) for _ in range(500))]
    for given, want in ((texts, texts), (pa.array(texts), texts), (pa.array(texts)[7:300], texts[7:300]), (["\ud800 a"], ["\ud800 a"]), ([], [])):
        words, sizes = context_mixing.split_words(given)
        split = [words_of(t) for t in want]
        assert words.view(pa.binary()).to_pylist() == [w for s in split for w in s]
        assert sizes.tolist() == [len(s) for s in split]


def test_bits_in_a_row_share_a_block():
    """Four bits in a row, read in one context, ask slots side by side, each another one; blocks use all their slots alike."""
    _, code = small()
    rng = np.random.default_rng(13)
    sources = Stream(code, [" ".join(rng.choice([*(w.decode() for w in code.words), "q"], 300)) for _ in range(20)]), Spelling([b"%d" % x for x in rng.integers(0, 10**9, 3000)])
    for source, tables in zip(sources, (WORD_TABLES, BYTE_TABLES), strict=True):
        for table in tables:
            asked = [[] for _ in source.order]
            for column in source.columns():
                for i, slot in zip(range(column.rows.start, column.rows.start + len(column.bits)), column.slots(table, source.contexts).tolist(), strict=True):
                    asked[i].append(slot)
            blocks = [a[k : k + 4] for a in asked for k in range(0, len(a), 4)]
            assert all(len({s >> 4 for s in b}) == 1 and len(set(b)) == len(b) for b in blocks)
            used = np.bincount([s & 15 for b in {tuple(b) for b in blocks} for s in b], minlength=16)
            assert (used > 0).all()


def test_learning_leaves_one_bit_out():
    tables, counts = context_mixing.Tables.empty(), np.array([3, 5, 0, 1, 70_000, 2, 1, 0], np.float32)
    tables.put("two", 8, counts)
    odds = lambda one, zero: max(-127, round(math.log((one + 0.3) / (zero + 0.3)) * 12))
    assert tables.odds["two"][8:12].tolist() == [odds(5, 3), odds(1, 0), odds(2, 70_000), odds(0, 1)]
    left = tables.others["two"][16:24].tolist()
    assert left[:2] == [odds(5, 2), odds(4, 3)] and left[3] == odds(0, 0) and left[4:7] == [odds(2, 69_999), odds(1, 70_000), odds(0, 0)]

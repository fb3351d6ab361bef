import itertools
import math

import numpy as np
import public_tokenizers
import sentencepiece
from fixtures import AWKWARD, awkward, rows_of

from gleanspark.llm.sampled_pieces import SPACE, Sampler, pieces_of, sample_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def segmentations(text):
    """Every way to cut a text into pieces, with its share of the total weight."""
    logs, known = pieces_of(MODEL).logs, {library.id_to_piece(i): i for i in range(259, 32000)}
    flat = SPACE + text.replace(" ", SPACE)
    ways = {}
    for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, len(flat)), k) for k in range(len(flat))):
        parts = [flat[a:b] for a, b in itertools.pairwise([0, *cuts, len(flat)])]
        if all(p in known for p in parts):
            ways[tuple(known[p] for p in parts)] = math.exp(sum(logs[known[p]] for p in parts))
    total = sum(ways.values())
    return {w: x / total for w, x in ways.items()}


def test_draws_follow_the_lattice_without_replacement():
    text, n = "ab cat", 30_000
    exact = segmentations(text)
    assert len(exact) > 8
    draws = Sampler(MODEL, 3)(list(range(n)), [text] * n)
    got = [{} for _ in range(n)]
    first, second = dict.fromkeys(exact, 0), dict.fromkeys(exact, 0)
    estimate = np.zeros(n)
    for row, draw, ids, log, value, inclusion in draws:
        way = tuple(ids.tolist())
        assert math.isclose(log, math.log(exact[way]), abs_tol=1e-6) and inclusion <= 0
        got[row][draw] = way, value
        if draw < 3:
            (first if draw == 1 else second)[way] += 1
        estimate[row] += math.exp(log - inclusion) * len(way)
    assert all(len({w for w, _ in g.values()}) == 3 and g[1][1] >= g[2][1] >= g[3][1] for g in got)
    for way, p in exact.items():
        assert abs(first[way] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-4
        after = sum(q * p / (1 - q) for other, q in exact.items() if other != way)
        assert abs(second[way] / n - after) < 4 * math.sqrt(after * (1 - after) / n) + 1e-4
    # Weighing by inclusion gives unbiased estimates.
    want = sum(p * len(w) for w, p in exact.items())
    assert abs(estimate.mean() - want) < 5 * estimate.std() / math.sqrt(n)


def test_all_segmentations_when_there_are_few():
    exact = segmentations("of a")
    out = list(Sampler(MODEL, len(exact) + 5)([1], ["of a"]))
    assert {tuple(o[2].tolist()) for o in out} == set(exact) and len(out) == len(exact)
    assert all(o[5] == 0 for o in out)


def test_round_trip_of_awkward_texts():
    texts = [t for _, t, *_ in AWKWARD] + ["<s> a\r\n\tb  c", "\x00é🙂ཀ\n", " ", "  lead", "日本語" * 30, "ÿ​͸"]
    keys = list(range(len(texts)))
    for row, draw, ids, *_ in Sampler(MODEL, 2)(keys, texts):
        assert library.decode(ids.tolist()) == (texts[row] or ""), (row, draw)


def test_draws_do_not_depend_on_neighbours():
    texts = ["some words here", "and others", "some more words\nthere"]
    together = {(r, d): (i.tolist(), *x) for r, d, i, *x in Sampler(MODEL, 2)([5, 6, 7], texts)}
    for at, (key, text) in enumerate(zip([5, 6, 7], texts, strict=True)):
        for _, d, i, *x in Sampler(MODEL, 2)([key], [text]):
            assert together[at, d] == (i.tolist(), *x)


def test_scores_alone_equal_those_in_a_slice(spark):
    """To the last digit, on whole documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()]
    keys, texts = zip(*rows, strict=True)
    together = {(keys[r], d): (i.tolist(), *x) for r, d, i, *x in Sampler(MODEL, 2)(list(keys), list(texts))}
    alone = {(key, d): (i.tolist(), *x) for key, text in rows for _, d, i, *x in Sampler(MODEL, 2)([key], [text])}
    assert together == alone


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = sample_pieces(docs, MODEL, 2)
    rows = got.collect()
    assert all(r.round_trip for r in rows) and {r.draw for r in rows} == {1, 2}
    assert [r.n_tokens for r in rows if r.doc_id == 1] == [0]
    assert sample_pieces(docs.limit(0), MODEL).count() == 0
    assert [r[:6] for r in rows_of(got.drop("ids"))] == [r[:6] for r in rows_of(sample_pieces(docs, MODEL, 2, digest=True))]


def test_the_registered_query_returns_the_segmentations(spark):
    from gleanspark.llm.queries import op10_sampled_pieces

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op10_sampled_pieces(spark, folder).collect():
        assert len(r.ids) == r.n_tokens
        assert r.round_trip == (library.decode(list(r.ids)) == texts[r.doc_id].replace(SPACE, " "))

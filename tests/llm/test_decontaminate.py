import hashlib
import random
import re

from fixtures import awkward

from gleanspark.llm import decontaminate
from gleanspark.llm.decontaminate import drop_contaminated, mark_contaminated

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
lower = lambda t: (t or "").encode().lower().decode()


def brute(text, items, span=10):
    words, hit, names = WORD.findall(lower(text)), set(), set()
    for name, item in items:
        w = WORD.findall(lower(item))
        m = min(span, len(w))
        windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                names |= {str(name)} if name is not None else set()
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def made(seed, n_docs=120, n_items=25, vocabulary=6):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha Béta gamma9 δ eps ζ".split()[:vocabulary])
    items = [(i % 20, " ".join(word() for _ in range(rng.choice([0, 1, 2, 4, 9, 10, 11, 14, 30])))) for i in range(n_items)]
    items += [(77, None), (None, "alpha alpha alpha"), (78, items[5][1])]
    docs = []
    for i in range(n_docs):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        if rng.random() < 0.5:
            a = rng.choice(items)[1] or ""
            w = a.split()
            parts.append(", ".join(w[rng.randint(0, 2) :]).upper())
        docs.append((i, ". ".join(parts), "en", "s", 0))
    return docs, items


def check(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in mark_contaminated(awkward(spark, docs), bench).collect()}
    assert got == {d[0]: brute(d[1], items) for d in docs}


def test_equals_brute_force(spark):
    for seed in range(4):
        check(spark, *made(seed, vocabulary=2 + seed))


def test_large_benchmarks_are_joined(spark, monkeypatch):
    """More windows than are broadcast, and bit maps that let most windows pass."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 3)
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 64)
    docs, items = made(9)
    check(spark, docs, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = drop_contaminated(awkward(spark, docs + docs[:5]), bench).collect()
    assert sorted(r.doc_id for r in kept) == sorted(d[0] for d in docs + docs[:5] if not brute(d[1], items)[-1])


def test_one_passage_in_many_items_and_documents(spark):
    """Rows grow with hits, not with hits times items."""
    passage = " ".join(f"p{i}" for i in range(14))
    items = [(i, f"x{i} {passage} y{i}") for i in range(400)]
    docs = [(i, f"a{i} {passage} b{i}" if i % 3 else f"c{i}", "en", "s", 0) for i in range(600)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in mark_contaminated(awkward(spark, docs), bench).collect()}
    assert got == {i: (14, 400) if i % 3 else (0, 0) for i in range(600)}


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "the cat sat on the mat it was happy then"), (2, "word " * 12), (3, None)], "item_id long, text string")
    docs = awkward(spark)
    got = {r.doc_id: r for r in mark_contaminated(docs, bench).collect()}
    assert got[4].n_hit == 10 and got[7].n_hit == 30_000 and got[1].n_words == got[1].n_hit == 0
    kept = drop_contaminated(docs, bench)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 8, 9] and kept.columns == docs.columns
    empty = bench.limit(0)
    assert not any(r.contaminated for r in mark_contaminated(docs, empty).collect())
    assert mark_contaminated(docs.limit(0), bench).count() == 0

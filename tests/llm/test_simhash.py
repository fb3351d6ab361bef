import random

import numpy as np
import pytest
import xxhash
from fixtures import awkward
from pyspark.sql import functions as F

from gleanspark.llm import simhash
from gleanspark.llm.components import components
from gleanspark.llm.simhash import fingerprint, keep_one, linked, near_duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def near(fps):
    return [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]


def cluster(rng, size, spread):
    base = rng.getrandbits(64)
    return {base ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randint(0, spread))}) for _ in range(size)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_contracts():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50):
        text = "\t".join(rng.choice(["A", "b", "É", "c d", "🙂"]) for _ in range(n))
        assert fingerprint(text) == signed(plain_fingerprint(text))
    assert fingerprint(None) == fingerprint(" \n") == 0


@pytest.mark.parametrize("key_rows", [4096, 8])
def test_links_equal_brute_force(spark, monkeypatch, key_rows):
    monkeypatch.setattr(simhash, "KEY_ROWS", key_rows)
    rng = random.Random(key_rows)
    fps = sorted(set().union(*(cluster(rng, rng.choice([1, 2, 5, 60]), rng.choice([2, 4, 7])) for _ in range(40))))
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in linked(df).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges) and len(edges) < 80 * len(fps)
    assert roots(fps, edges) == roots(fps, near(fps))


def plain_labels(fps):
    """The least index reachable from each fingerprint, by sweeps over all pairs."""
    fps, label = np.array(fps, np.uint64), np.arange(len(fps))
    while True:
        before = label.copy()
        for at in range(0, len(fps), 1000):
            near_ = np.bitwise_count(fps[at : at + 1000, None] ^ fps[None, :]) <= 3
            label[at : at + 1000] = np.where(near_, label[None, :], len(fps)).min(axis=1)
        label = label[label]
        if (label == before).all():
            return label


@pytest.mark.parametrize("asked_by_many", [False, True])
def test_hot_keys_are_dealt(spark, monkeypatch, asked_by_many):
    """Thousands of fingerprints share half of their bits: some at random, some around a few centres; no part is large."""
    monkeypatch.setattr(simhash, "KEY_ROWS", 256)
    rng = random.Random(9)
    fps = {0xABCD1234 << 32 | rng.getrandbits(32) for _ in range(5000)}
    for width, size in ((9, 400), (14, 2500)):
        centre, bits = 0xABCD1234 << 32 | rng.getrandbits(32), rng.sample(range(32), width)
        fps |= {centre ^ sum(1 << b for b in bits if rng.random() < 0.5) for _ in range(size)}
    if asked_by_many:  # few are stored under the keys that these ask for
        fps |= {f ^ 1 << 33 for f in rng.sample(sorted(fps), 20)}
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    rows = simhash._keyed(df).withColumn("part", F.lit(0).cast("long"))
    large = simhash._large_keys(rows.select("key", "part", "fp", "asks"))
    dealt, _ = simhash._dealt(rows.join(large, "key", "left_semi").select("key", "part", "fp", "asks"))
    sizes = dealt.groupBy("key", "part").count().agg(F.max("count")).first()[0]
    assert large.count() > 10 and sizes < 4 * 256
    edges = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in linked(df).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges)
    label = plain_labels(fps)
    assert roots(fps, edges) == {f: fps[i] for f, i in zip(fps, label.tolist(), strict=True)}


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    plain = [e for e in edges if None not in e]
    want = roots(sorted({n for e in plain for n in e}), plain)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = roots(sorted(fps), links)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()} == {d: (f"{fps[d]:016x}", want[d]) for d in fps}
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == sorted(set(want.values()))


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = near_duplicates(docs)
    ids = {(r.doc_id, r.component_id) for r in got.collect()}
    assert got.count() == 11 and {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, 1)} <= ids
    assert near_duplicates(docs.limit(0)).count() == 0
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "7", "8", "9", "None", "None"]
    assert keep_one(docs.limit(0)).count() == 0
    assert kept.where(F.col("doc_id") == 4).count() == 1


def test_rows_of_one_text_that_differ_elsewhere(spark):
    """One row of a group stays, the same one however the rows come."""
    rows = [(1, "a b c d", x) for x in "qwertz"] + [(2, "a b c d", "z")]
    made = [keep_one(spark.createDataFrame(r, "doc_id long, text string, _row string").repartition(n)).collect() for r, n in ((rows, 1), (rows[::-1], 4))]
    assert made[0] == made[1] and len(made[0]) == 1 and made[0][0].doc_id == 1

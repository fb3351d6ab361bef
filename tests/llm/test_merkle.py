import random

import duckdb
from fixtures import awkward, rows_of
from pyspark.sql import functions as F

from gleanspark.llm import merkle
from gleanspark.llm.merkle import changes, fingerprint_documents, likeness, with_next, with_tree


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 7)
    rng = random.Random(2)
    ids = sorted(rng.sample(range(-10**12, 10**12), 150)) + [5, 6, 7]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "none")], "doc_id long, text string").repartition(5)
    got = {r.text: r.next_text for r in with_next(df, "doc_id", "text").collect()}
    order = [f"t{i}" for i in sorted(ids, reverse=True)] + ["none"]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_equals_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    got = fingerprint_documents(spark.read.parquet(path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({merkle.oracle_sql()})").fetchall()
    assert rows_of(got) == sorted(want, key=repr)


def test_trees_tell_edits(spark):
    a = "One. Two is here.\n\nThree, a line.\nFour.\n\nFive."
    pairs = [(a, a), (a, a.replace("Four", "4")), (a, "Nothing of it"), ("", ""), ("", "x"), (a, a + "\n"), (a, a.replace("One", "1").replace("Five", "5"))]
    df = with_tree(with_tree(spark.createDataFrame(pairs, "a string, b string"), "a", "x"), "b", "y")
    rows = df.select("a", "b", likeness(F.col("x"), F.col("y")).alias("near"), changes(F.col("x"), F.col("y")).alias("at"), (F.col("x.root") == F.col("y.root")).alias("same")).collect()
    seen = {(r.a, r.b): (round(r.near, 3), [tuple(x) for x in r.at], r.same) for r in rows}
    assert seen[a, a] == (1.0, [], True) and seen["", ""] == (1.0, [], True)
    assert seen[pairs[1]] == (0.8, [(1, 1)], False) and seen[pairs[2]] == (0.0, [(0, 0), (1, 0), (1, 1), (2, 0)], False)
    assert seen["", "x"] == (0.0, [(0, 0)], False) and seen[a, a + "\n"] == (1.0, [(2, 1)], False)
    assert seen[pairs[6]][1] == [(0, 0), (2, 0)]


def test_hot_and_text_ids(spark, monkeypatch):
    """Many rows without an id or of one id are parted by their texts; ids may be texts."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", 8)
    rows = [(None, f"n{i}") for i in range(300)] + [(7, f"s{i}") for i in range(300)] + [(i, f"t{i}") for i in range(8, 40)] + [(7, "again")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = with_next(df, "doc_id", "text")
    got = [(r.id, r.text, r.next_text) for r in made.collect()]
    assert len(got) == len(rows)
    hashed = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]), reverse=True)
    assert sorted(got, key=repr) == sorted(((*r, n[1]) for r, n in zip(order, order[1:] + order[:1], strict=True)), key=repr)
    named = spark.createDataFrame([("b", "1"), ("a", "2"), (None, "3"), ("c", "4")], "doc_id string, text string")
    assert {r.text: r.next_text for r in with_next(named, "doc_id", "text").collect()} == {"4": "1", "1": "2", "2": "3", "3": "4"}


def test_stays_in_the_jvm(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = fingerprint_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("Python", "Arrow", "Pandas")) and "SinglePartition" not in plan


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = fingerprint_documents(docs).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_chars == 0 and by[4][0].fingerprint == by[5][0].fingerprint == by[4][1].fingerprint
    assert by[5][0].near_next == 1.0 and by[5][0].near_edited > 0.3
    assert fingerprint_documents(docs.limit(0)).count() == 0
    one = fingerprint_documents(docs.where("doc_id = 5")).first()
    assert one.near_next == 1.0

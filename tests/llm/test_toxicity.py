import itertools
import zlib

import numpy as np
from fixtures import awkward

from gleanspark.llm.toxicity import THRESHOLD, Machine, _hash, drop_toxic, score_toxicity, scorer, terms_of, train


def table(spark, name, sf="sf0.1"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    rows = score_toxicity(docs, train(docs, labels)).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    assert ((rows.score >= THRESHOLD) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    rows = rows[rows.held_out]
    caught = rows.predicted[rows.toxic == 1].mean()
    wrong = rows.predicted[rows.toxic == 0].mean()
    assert caught > 0.9 and wrong < 0.01


def test_held_out_labels_are_not_read(spark):
    docs, labels = table(spark, "documents", "sf0.001"), table(spark, "labels", "sf0.001")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = train(docs, labels), train(docs, flipped)
    assert (a.hashes == b.hashes).all() and np.array_equal(a.single, b.single) and np.array_equal(a.pair, b.pair)


def trained(spark, texts, labels):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return train(docs, spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"))


def without_pairs(model):
    return Machine(model.hashes, model.bias, model.single, np.zeros_like(model.pair))


def test_pairs_are_learned(spark):
    """Neither word tells anything alone; both together are toxic. Without the pairs the machine misses them."""
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        texts.append(" ".join(["insult"] * a + ["group"] * b + [f"w{chr(97 + x)}" for x in rng.integers(0, 20, 3)]))
        labels.append(int(a and b))
    model = trained(spark, texts, labels)
    both, one, other = scorer(model)(["insult group wa wb wc", "insult wa wb wc", "group wa wb wc"])
    assert both > 0.8 and one < 0.3 and other < 0.3
    assert (scorer(model)(texts) > 0.5).astype(int).tolist() == labels
    plain = scorer(without_pairs(model))(texts)
    assert (plain[np.array(labels) == 1] >= THRESHOLD).mean() < 0.5


def test_terms_are_chosen_by_their_pairs(spark):
    """A group's name is as frequent in toxic texts as elsewhere, but not beside the insult."""
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(4000):
        insult, group = i % 10 == 0, rng.random() < 0.4
        toxic = group if insult else (not group and rng.random() < 0.12)
        texts.append(" ".join((["insult"] if insult else []) + (["group"] if group else []) + (["villain"] if toxic and not insult else []) + [f"w{'abcdefghijklmnopqrstuvwxyz'[x]}" for x in rng.integers(0, 26, 4)]))
        labels.append(int(toxic))
    model = trained(spark, texts, labels)
    assert _hash("w group") in model.hashes
    caught = scorer(model)(["insult group wa wb", "insult wa wb", "group wa wb", "villain wa"])
    assert (caught >= THRESHOLD).tolist() == [True, False, False, True]


def test_the_tables_need_the_pairs(spark):
    """Held-out recall falls when the pairs are zeroed."""
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = train(docs, labels)
    rows = docs.join(labels, "doc_id").where("crc32(cast(doc_id AS string)) % 4 = 2 AND toxic = 1").collect()
    found = [(scorer(m)([r.text for r in rows]) >= THRESHOLD).mean() for m in (model, without_pairs(model))]
    assert found[0] > 0.9 and found[1] < 0.5


def test_scores_equal_a_plain_sum(spark):
    """The scorer, which remembers words, against all terms and all pairs summed one by one."""
    docs, labels = table(spark, "documents", "sf0.01"), table(spark, "labels", "sf0.01")
    model = train(docs, labels)
    number = {h: i for i, h in enumerate(model.hashes.tolist())}
    texts = [r.text for r in docs.limit(150).collect()] + ["", None]
    for text, score in zip(texts, scorer(model)(texts), strict=True):
        held = sorted(number[h] for h in terms_of(text or "") if h in number)
        raw = model.bias + sum(model.single[i] for i in held) + sum(model.pair[i] @ model.pair[j] for i, j in itertools.combinations(held, 2))
        assert abs(score - 1 / (1 + np.exp(-raw))) < 1e-9


def test_one_of_several_texts_teaches(spark):
    """Which text of a repeated id teaches does not depend on the order of rows."""
    rows = [(i % 40, f"{'bad' if i % 4 == 0 else 'good'} w{chr(97 + i % 26)} x{i}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    made = [train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 5))]
    assert np.array_equal(made[0].hashes, made[1].hashes) and np.array_equal(made[0].pair, made[1].pair)


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (1, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = train(docs, labels)
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == 11 and not any(r.held_out for r in rows if r.doc_id is None)
    assert drop_toxic(docs, model).columns == docs.columns
    none = train(docs.limit(0), labels)
    assert score_toxicity(docs.limit(0), none).count() == 0 and score_toxicity(docs, none).count() == 11
    assert train(docs, labels.limit(0)).hashes.size == 0

import public_tokenizers
from fixtures import awkward
from test_decontaminate import brute as contaminated
from test_secret_scan import brute as secrets
from test_simhash import near, plain_fingerprint, roots

import corpus_pipeline
from gleanspark.llm import toxicity
from gleanspark.llm.sampled_pieces import Sampler
from gleanspark.llm.secret_scan import SecretScanner, redact

FOLDER = "/root/testdata/sf0.01"


def test_equals_a_plain_version(spark):
    docs, labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    score = toxicity.scorer(toxicity.train(docs, labels))
    kept = {i: t for i, t in rows.items() if score([t])[0] < toxicity.THRESHOLD}
    assert len(kept) < len(rows)
    fps = {i: plain_fingerprint(t) for i, t in kept.items()}
    top = roots(sorted(set(fps.values())), near(sorted(set(fps.values()))))
    least = {}
    for i in sorted(kept):
        least.setdefault(top[fps[i]], i)
    one = {i: kept[i] for i in least.values()}
    assert len(one) < len(kept)
    clean = {i: t for i, t in one.items() if not contaminated(t, items)[4]}
    assert len(clean) < len(one)
    scan = SecretScanner()
    final = {i: redact(t, scan(t)) for i, t in clean.items()}
    assert not any(secrets(t) for t in final.values()) and any(secrets(t) for t in clean.values())
    ids = list(final)
    want = {(ids[row], draw): tokens.tolist() for row, draw, tokens, *_ in Sampler(public_tokenizers.path("piece_bpe_32k.model"))(ids, list(final.values()))}
    got = {(r.doc_id, r.draw): r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(50)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name


def tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_awkward_and_empty_tables(spark, tmp_path):
    """Null columns, empty and long texts, repeated rows and clashing names go through all stages; so do tables without rows."""
    docs = awkward(spark)
    rows = corpus_pipeline.run(spark, tables(spark, tmp_path / "awkward", docs)).collect()
    # Texts without words are one group; those of ids 4 and 5 are copies.
    assert {r.doc_id for r in rows} == {None, 4, 7, 8, 9} and all(r.round_trip for r in rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, str(tmp_path / "awkward"))
        assert made.columns == docs.columns and made.count() >= 5, name
    folder = tables(spark, tmp_path / "empty", docs.limit(0))
    assert corpus_pipeline.run(spark, folder).count() == 0
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/none").collect()} <= {None, 4, 7, 8, 9}

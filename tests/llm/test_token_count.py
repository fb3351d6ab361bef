import random

import public_tokenizers
import sentencepiece
from fixtures import AWKWARD, awkward, rows_of

from gleanspark.llm.token_count import PieceCounter, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library():
    count, library, rng = PieceCounter(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(5)
    assert count.splits and len(count.single) > 20_000
    bits = [" ", "  ", "\n", "\n\n", "\t", "\r", "▁", "the", "The", "ing", "e", "日本", "🙂", "é", "<s>", "</s>", "<unk>", "<0x0A>", "http://x.y", "0", "12", "ﬁ", "​", "\x00", "();\r", "%%%"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(3000)] + [t or "" for _, t, *_ in AWKWARD]
    assert count(texts) == [len(library.encode(t)) for t in texts]


def test_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: (len(r.text.encode()), n := len(library.encode(r.text)), n > 4096) for r in docs.collect()}
    assert {r.doc_id: tuple(r)[1:] for r in count_tokens(docs, MODEL).collect()} == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = count_tokens(docs, MODEL)
    assert got.count() == 11 and rows_of(got)[0][0] == 1 and rows_of(got)[0][1:] == (0, 0, False)
    assert count_tokens(docs.limit(0), MODEL).count() == 0

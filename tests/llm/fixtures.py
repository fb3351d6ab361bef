"""Awkward document rows that every operator on texts must take."""

AWKWARD = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 4),
    (4, "The cat sat on the mat.\nIt was happy.\n\nThen it left.", "en", None, 52),
    (4, "The cat sat on the mat.\nIt was happy.\n\nThen it left.", "en", None, 52),
    (5, "The cat sat on the mat.\nIt was happy.\n\nThen it left.", "en", "b", 52),
    (None, "one two", "en", "b", 7),
    (None, None, None, None, None),
    (7, "word " * 30_000, "en", "hot", 150_000),
    (8, "naïve café — ÀÉ 日本語テキスト 🙂🙂 ſK", "xx", "hot", 30),
    (9, "x" * 70_000, "xx", "hot", 70_000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves, and their relatives.
CLASHES = {
    n: "lit"
    for n in (
        "score fp key root spans fingerprint n_words label a b h bucket word n c part asks sub id hash some row _row _id _none _hash _text _label _fold _least first node least i p f terms numbers "
        "gram item hit words range copy next_text edited own new next nodes pieces closes top is_top held_out predicted n_tokens n_known train_tokens base_score bits_per_byte rest times rare_base "
        "rare_known head_known head_base n_bytes over_limit n_hit n_items items_sha256 contaminated n_assign n_access n_hex base_sha256 component_id draw ids pos seg ctx begin place blocks few largest"
    ).split()
}


def awkward(spark, rows=AWKWARD):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(v) for n, v in CLASHES.items()})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections, in built-in functions only.

Sections are parted by blank lines, paragraphs by newlines; a paragraph's leaves are runs of up to 64
characters that end after sentence marks. A paragraph's node hashes its leaves' hashes, a section's its
paragraphs' and the root its sections', so equal texts, and only those, have equal roots; where roots
differ, comparing nodes from the top leads to the paragraphs that changed. Two trees are as alike as
the share of distinct leaf hashes they have in common, 2 |A and B| / (|A| + |B|).

The edited text takes its second half from the next document by descending id. Neighbours meet by range:
ids, and within an id hashes of texts, are cut at bounds from a sample of SAMPLE_ROWS keys for each range, into ranges of about
RANGE_ROWS rows, RANGES at most, so that what the driver holds is bounded; the sample moves bounds only, never
results. Each range also gets a copy of the row before it. Texts are shuffled once, no window spans the table, and a window
keeps one row in memory, so that ranges of more rows only take longer.

Edge cases: a null text counts as empty; two texts without leaves are wholly alike; null ids come after
all others; ids of any type that can be ordered are fine; rows of one id are ordered by the hash of their text, descending, and
such as are repeated as a whole stand in one range; the only row of a table is its own neighbour; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS, RANGES, SAMPLE_ROWS = 512, 8192, 20
PIECE = r"[^.!?]{1,64}[.!?]*|[.!?]+"


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(children, ","), 256)


def with_tree(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Adds the struct `name` of a text that is not null: root, sections (their nodes), paragraphs (those of each section), leaves."""
    pieces, nodes = f"{name}_pieces", f"{name}_nodes"
    paragraphs = lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), F.md5))
    df = df.withColumn(pieces, F.transform(F.split(text_col, "\n\n", -1), paragraphs))
    df = df.withColumn(nodes, F.transform(pieces, lambda s: F.transform(s, _node)))
    df = df.withColumn(f"{name}_sections", F.transform(nodes, _node))
    tree = F.struct(
        _node(F.col(f"{name}_sections")).alias("root"),
        F.col(f"{name}_sections").alias("sections"),
        F.col(nodes).alias("paragraphs"),
        F.array_distinct(F.flatten(F.flatten(pieces))).alias("leaves"),
    )
    return df.withColumn(name, tree).drop(pieces, nodes, f"{name}_sections")


def likeness(a: Column, b: Column) -> Column:
    """Share of common leaves of two trees, 0 to 1."""
    leaves = F.size(a["leaves"]) + F.size(b["leaves"])
    return F.when(leaves == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a["leaves"], b["leaves"])) / leaves)


def _differing(a: Column, b: Column) -> Column:
    """Places at which two lists of nodes differ, those that only one of them has included."""
    last = F.greatest(F.size(a), F.size(b)) - 1
    return F.filter(F.sequence(F.lit(0), last), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))


def changes(a: Column, b: Column) -> Column:
    """Where two trees differ, as (section, paragraph in it) in order: from the root down, into those sections alone whose nodes differ."""
    none = F.array().cast("array<string>")
    inside = lambda t, i: F.coalesce(F.get(t["paragraphs"], i), none)
    of = lambda i: F.transform(_differing(inside(a, i), inside(b, i)), lambda j: F.struct(i.cast("long").alias("section"), j.cast("long").alias("paragraph")))
    found = F.flatten(F.transform(_differing(a["sections"], b["sections"]), of))
    return F.when(a["root"] == b["root"], F.array().cast("array<struct<section: bigint, paragraph: bigint>>")).otherwise(found)


def _under(key: tuple[Column, ...], bounds: list[tuple]) -> Column:
    """How many of the sorted bounds are less than the key, by halving."""
    arrays = [F.lit(list(x)) for x in zip(*bounds, strict=True)]

    def less(i):
        out = F.lit(False)
        for part, array in reversed(list(zip(key, arrays, strict=True))):
            bound = F.get(array, i)
            out = (bound < part) | ((bound == part) & out)
        return out

    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & F.coalesce(less(at + step - 1), F.lit(False)), at + step).otherwise(at))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next_text) of each row, the next one by descending id and the first one after the last."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    none = F.lit("") if dict(rows.dtypes)["id"] == "string" else F.lit(0).cast(dict(rows.dtypes)["id"])
    # Ascending, null ids first; what is next in descending order stands before.
    rows = rows.withColumns({"some": F.col("id").isNotNull(), "key": F.coalesce("id", none), "hash": F.xxhash64("text")})
    names = ("some", "key", "hash")
    n = rows.count()
    ranges = max(1, min(RANGES, math.ceil(n / RANGE_ROWS)))
    kept = max(1, n // (ranges * SAMPLE_ROWS))
    sample = rows.select(*names).where(F.pmod(F.xxhash64("key", "hash", F.lit(7)), F.lit(kept)) == 0).distinct().orderBy(F.xxhash64(*names)).limit(2 * RANGES * SAMPLE_ROWS) if ranges > 1 else None
    found = sorted(tuple(r) for r in sample.collect()) if sample is not None else []
    bounds = [found[i * len(found) // ranges] for i in range(1, ranges)] if len(found) >= ranges else found
    rows = rows.withColumn("range", _under(tuple(F.col(c) for c in names), sorted(set(bounds))) if bounds else F.lit(0))
    tops = rows.groupBy("range").agg(F.max(F.struct(*names)).alias("top")).orderBy("range").collect()
    # The last row of each range also opens the range after it; that of the last range opens the first.
    opens = [(*r["top"], tops[(i + 1) % len(tops)]["range"]) for i, r in enumerate(tops)]
    kinds = dict(rows.dtypes)
    opening = spark.createDataFrame(opens, f"some boolean, key {kinds['key']}, hash long, opens int")
    here = F.struct(F.col("range"), F.lit(False).alias("copy"))
    places = F.when(F.col("opens").isNotNull(), F.array(here, F.struct(F.col("opens").alias("range"), F.lit(True).alias("copy")))).otherwise(F.array(here))
    dealt = rows.join(F.broadcast(opening), list(names), "left").select("id", "text", *names, F.explode(places).alias("r")).select("id", "text", *names, "r.range", "r.copy")
    order = Window.partitionBy("range").orderBy(F.desc("copy"), *names)
    return dealt.withColumn("next_text", F.lag("text").over(order)).where("not copy").select("id", "text", "next_text")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, their likeness, and that to the next document."""
    df = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    df = df.withColumn("edited", edited)
    for text, name in (("text", "own"), ("edited", "new"), ("next_text", "next")):
        df = with_tree(df, text, name)
    own, new, following = F.col("own"), F.col("new"), F.col("next")
    df = df.withColumn("changes", changes(own, new))
    return df.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        own["root"].alias("fingerprint"),
        new["root"].alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"),
        likeness(own, following).alias("near_next"),
        F.size(own["sections"]).cast("long").alias("n_sections"),
        F.get("changes", 0)["section"].alias("first_section"),
        F.get("changes", 0)["paragraph"].alias("first_paragraph"),
        F.size("changes").cast("long").alias("n_changed"),
    )


def _tree_sql(text: str, name: str) -> str:
    pieces = f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: list_transform(regexp_extract_all(p, '{PIECE}'), lambda x: md5(x))))"
    return f"{pieces} AS {name}_pieces"


def _node_sql(children: str) -> str:
    return f"sha256(coalesce(array_to_string({children}, ','), ''))"


def oracle_sql() -> str:
    names = ("own", "new", "next")
    nodes = ", ".join(f"list_transform({n}_pieces, lambda s: list_transform(s, lambda p: {_node_sql('p')})) AS {n}_nodes" for n in names)
    tops = ", ".join(f"list_transform({n}_nodes, lambda s: {_node_sql('s')}) AS {n}_sections, {n}_nodes AS {n}_paragraphs, list_distinct(flatten(flatten({n}_pieces))) AS {n}_leaves" for n in names)
    like = lambda b: f"CASE WHEN len(own_leaves) + len({b}_leaves) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(own_leaves, {b}_leaves)) / (len(own_leaves) + len({b}_leaves)) END"
    own, new = _node_sql("own_sections"), _node_sql("new_sections")
    return f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM documents),
edited AS (SELECT *, length(text) AS n_chars, substring(text, 1, length(text) - length(text) // 2) || substring(next_text, 1, length(text) // 2) AS edited FROM ordered),
trees AS (SELECT *, {_tree_sql('text', 'own')}, {_tree_sql('edited', 'new')}, {_tree_sql('next_text', 'next')} FROM edited),
nodes AS (SELECT *, {nodes} FROM trees),
tops AS (SELECT *, {tops} FROM nodes),
differing AS (SELECT *, flatten(list_transform(range(greatest(len(own_paragraphs), len(new_paragraphs))), lambda i: list_transform(
  list_filter(range(greatest(coalesce(len(own_paragraphs[i + 1]), 0), coalesce(len(new_paragraphs[i + 1]), 0))), lambda j: own_paragraphs[i + 1][j + 1] IS DISTINCT FROM new_paragraphs[i + 1][j + 1]),
  lambda j: {{'section': i, 'paragraph': j}}))) AS changes FROM tops)
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {own} AS fingerprint, {new} AS edited_fingerprint,
       {like('new')} AS near_edited, {like('next')} AS near_next, len(own_sections)::BIGINT AS n_sections,
       changes[1].section AS first_section, changes[1].paragraph AS first_paragraph, len(changes)::BIGINT AS n_changed
FROM differing"""

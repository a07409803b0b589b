"""Document fingerprints: Merkle trees over passages, paragraphs and sections, with DataFrame functions only.

A paragraph is a line; its passages end at a punctuation mark that white space follows, which begins the next passage, so
no character is left out; a section is a run of paragraphs that ends at one whose digest begins with 0 or 1, so an edit
moves no section border but those it touches. A passage's digest (SHA-256) is of its text, a paragraph's of its passages'
digests, a section's of its paragraphs' digests (and the cut ones of their passages), the root's of the sections'.

A fingerprint is the whole tree in order: ``root s<section> p<paragraph> l<passage> l<passage> p... s...``, with 64 hex
digits for the root and the first 16 for other nodes. Equal roots mean equal texts, different roots different ones;
descending only into branches that differ locates the edits (``changed``).

Defined results: null text is empty; an empty text has one section, paragraph and passage; likeness of two fingerprints is
twice the number of passages they share over the sum of their numbers, each counted once; repeated rows give repeated
results. A null id comes after all others; rows of equal id are ordered by their texts' hashes. Rows of one id stay
together. Texts are hashed whole, whatever their length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, partitions
from .ranks import MOST_BOUNDS, below, bounds


def _digest(column: Column) -> Column:
    return F.sha2(column, 256)


def _short(column: Column) -> Column:
    return F.substring(column, 1, 16)


def with_fingerprint(df: DataFrame, text: str, to: str) -> DataFrame:
    """Add the fingerprint of a text column that holds no null. Parents are hashed from whole digests; printed ones are cut."""
    passages = F.transform(F.split(F.col(text), "\n"), lambda p: F.transform(F.split(p, r"(?<=[.!?;:,|])(?=\s)"), _digest))
    df = df.withColumn("_p", passages)
    leaves = lambda x: F.array_join(F.transform(x, lambda s: F.concat(F.lit("l"), _short(s))), " ")
    df = df.withColumn("_p", F.transform("_p", lambda x: F.concat(_digest(F.array_join(x, " ")), F.lit(" "), leaves(x))))
    ends = lambda p: F.when(p.startswith("0") | p.startswith("1"), F.lit("/")).otherwise(F.lit(" "))
    body = F.rtrim(F.array_join(F.transform("_p", lambda p: F.concat(F.lit("p"), p, ends(p))), ""))
    df = df.withColumn("_s", F.split(F.regexp_replace(body, "/$", ""), "/"))
    printed = lambda s: F.rtrim(F.regexp_replace(s, "p([0-9a-f]{16})[0-9a-f]{48}", "p$1"))
    df = df.withColumn("_s", F.transform("_s", lambda s: F.struct(_digest(F.rtrim(s)).alias("d"), printed(s).alias("b"))))
    root = _digest(F.array_join(F.transform("_s", lambda s: s["d"]), " "))
    tree = F.array_join(F.transform("_s", lambda s: F.concat(F.lit("s"), _short(s["d"]), F.lit(" "), s["b"])), " ")
    return df.withColumn(to, F.concat(root, F.lit(" "), tree)).drop("_p", "_s")


def _nodes(fingerprint: Column, kind: str) -> Column:
    return F.array_distinct(F.filter(F.split(fingerprint, " "), lambda x: x.startswith(kind)))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1 from two fingerprints alone."""
    a, b = _nodes(one, "l"), _nodes(other, "l")
    return F.when(F.substring(one, 1, 64) == F.substring(other, 1, 64), F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def changed(one: Column, other: Column, kind: str = "p") -> Column:
    """Positions (from 0) among ``one``'s nodes of a kind (s, p or l) that ``other`` doesn't have: where it was edited."""
    own = F.filter(F.split(one, " "), lambda x: x.startswith(kind))
    theirs = _nodes(other, kind)
    return F.filter(F.transform(own, lambda x, i: F.when(~F.array_contains(theirs, x), i)), lambda i: i.isNotNull())


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """Rows with ``next_text``, the text of the next row in descending id order (after the last: the first).

    Ids are cut into ranges between approximate quantiles. Each range also gets a copy of the first row of the range
    after it (``ghost``); those are as few as the ranges. Texts are shuffled once.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("k", F.coalesce(F.col("doc_id").cast("long"), F.expr("-9223372036854775807L - 1L")))
    count = min(MOST_BOUNDS, 4 * partitions(docs.sparkSession))
    rows = rows.withColumn("bucket", below("k", bounds(rows, {"k": count})["k"]))
    heads = {r["bucket"]: r["head"] for r in rows.groupBy("bucket").agg(F.max("k").alias("head")).collect()}  # at most MOST_BOUNDS + 1
    after = {b: a for a, b in pairwise(sorted(heads, reverse=True))} | ({max(heads): min(heads)} if heads else {})
    # the head of each range also stands at the end of the range before it in descending order
    if heads:
        literal = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
        head = F.element_at(literal(heads), F.col("bucket"))
        ghost = F.when(F.col("k") == head, F.element_at(literal(after), F.col("bucket")))
        places = F.filter(F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("ghost")), F.struct(ghost.alias("at"), F.lit(True).alias("ghost"))), lambda x: x["at"].isNotNull())
    else:
        places = F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("ghost")))
    rows = rows.withColumn("place", F.explode(places)).select("doc_id", "text", "k", "place.*")
    order = Window.partitionBy("at").orderBy("ghost", F.desc("k"), F.xxhash64("text"), "text")
    return rows.withColumn("next_text", F.lead("text").over(order)), order


def edited_fingerprints(docs: DataFrame, **columns) -> DataFrame:
    """Fingerprints of texts and of their edited texts, whose last half comes from the next document, and likenesses."""
    rows, order = with_next(docs, **columns)
    rows = with_fingerprint(rows, "text", "fingerprint").withColumn("next_fingerprint", F.lead("fingerprint").over(order)).filter("NOT ghost")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.expr("CAST(n_chars DIV 2 AS INT)"))
    rows = rows.withColumn("edited", F.expr("concat(left(text, CAST(n_chars AS INT) - half), left(next_text, half))"))
    rows = with_fingerprint(rows.drop("next_text"), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        changed(F.col("edited_fingerprint"), F.col("fingerprint"), "s").alias("edited_sections"),
    )

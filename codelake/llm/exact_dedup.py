"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import BLANKS, stored

#: Normalised characters that the second refinement hashes.
PREFIX = 256
#: Surviving lengths, or (length, prefix) groups, that are sent to every task, at 16 bytes each; more are joined by shuffle.
GROUPS_TO_SEND = 100_000


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def repeated(frame: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has."""
    return frame.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1").select(*keys)


def surviving_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """(length, prefix hash) groups of two rows or more, found on two numbers per document."""
    body = normalised(F.col(text))
    marks = stored(docs.select(F.length(body).alias("norm_length"), F.xxhash64(F.substring(body, 1, PREFIX)).alias("prefix_hash")), "exact-marks")
    lengths = stored(repeated(marks, "norm_length"), "exact-lengths")
    if lengths.count() <= GROUPS_TO_SEND:  # a length that many rows have is then no shuffle key
        lengths = F.broadcast(lengths)
    return stored(repeated(marks.join(lengths, "norm_length", "left_semi"), "norm_length", "prefix_hash"), "exact-groups")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting ASCII white space. Documents alone in their length, or in their
    length and prefix hash, are settled by two numbers; only the others' full texts are hashed (SHA-256), grouped and
    given a row to keep: most code points in the original, then smallest key. text_sha256 is null for the settled ones
    unless ``digest_all`` asks for every digest. Counting by group is combined before the shuffle, and the groups are
    joined back as a stored table, so that a group holding a third of the rows is split by the adaptive skew join.

    Null and empty texts are equal. A null key sorts last. Rows that repeat both key and text get the same
    answer; :func:`drop_exact_duplicates` leaves one of them. An empty table gives an empty result.
    """
    body = normalised(F.col(text))
    groups = surviving_groups(docs, text)
    few = groups.count() <= GROUPS_TO_SEND
    rows = docs.select(
        F.col(key).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"),
        F.length(body).alias("norm_length"), F.xxhash64(F.substring(body, 1, PREFIX)).alias("prefix_hash"), body.alias("body"))
    marked = groups.withColumn("again", F.lit(True))
    if few:  # the texts stay where they are
        found = rows.join(F.broadcast(marked), ["norm_length", "prefix_hash"], "left")
        full = F.col("again") | F.lit(digest_all)
        found = found.select("doc_id", "chars", F.col("again").isNotNull().alias("again"), F.when(full, F.sha2("body", 256)).alias("text_sha256"))
    else:  # the digest travels, not the text
        found = rows.withColumn("text_sha256", F.sha2("body", 256)).drop("body").join(marked, ["norm_length", "prefix_hash"], "left")
        found = found.select("doc_id", "chars", F.col("again").isNotNull().alias("again"),
                             F.when(F.col("again") | F.lit(digest_all), F.col("text_sha256")).alias("text_sha256"))
    found = stored(found, "exact-hashes")
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id")))
    equal = stored(found.where("again").groupBy(F.col("text_sha256").alias("group_sha")).agg(
        best.alias("best"), F.count("*").alias("rows")).where("rows > 1").select("group_sha", F.col("best.doc_id").alias("best_id"), "rows"), "exact-equal")
    joined = found.join(equal, F.col("text_sha256") == F.col("group_sha"), "left")
    alone = F.col("rows").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("best_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that another one stands for; all columns stay.

    Only documents that are not kept travel to the join, so most texts meet a small table. Of rows that repeat both
    key and text one stays: they are told apart by a digest and only they are shuffled.
    """
    answers = stored(exact_duplicates(docs, key, text), "exact-answers")
    named = answers.where(F.col("text_sha256").isNotNull()).groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(
        F.bool_or("kept").alias("kept"), F.count("*").alias("rows"))
    dropped = stored(named.where(~F.col("kept")).select("__id", "__sha"), "exact-dropped")
    again = stored(named.where("kept and rows > 1").select("__id", "__sha"), "exact-again")
    signed = docs.withColumn("__text_sha", F.sha2(normalised(F.col(text)), 256))
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__text_sha") == F.col("__sha"))
    left = signed.join(dropped, same, "left_anti")
    if not again.isEmpty():
        once = left.join(again, same, "left_semi").dropDuplicates([key, "__text_sha"])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.drop("__text_sha")

"""Quality rules by cross-document line frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import BLANKS, WORD, stored

#: A line is furniture on a host if more distinct documents have it, whatever its length and the host's size.
LINE_DOCS = 10
#: Least words, and least share of its words, that a document must keep.
LEFT_WORDS, LEFT_SHARE = 50, 0.5
SYMBOLS = "#*$%&|<>"
#: Low bits of a packed number that hold a position in the text.
PLACE_BITS = 31


def words_of(text: Column) -> Column:
    blank = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.filter(F.split(blank, " ", -1), lambda w: w != F.lit(""))


def windows_of(words: Column) -> Column:
    """One 64-bit hash for each three words in a row, by position."""
    count = F.size(words)
    places = F.when(count >= 3, F.sequence(F.lit(0), count - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def places_met_again(hashes: Column, places: Column, shift: int) -> Column:
    """Of ``places``, those whose hash agrees with another's in 33 bits, ascending by hash; native long sort."""
    mask = (1 << PLACE_BITS) - 1
    packed = F.sort_array(F.transform(places, lambda i: F.shiftleft(F.shiftrightunsigned(F.get(hashes, i), shift), PLACE_BITS).bitwiseOR(i.cast("long"))))
    return bound(packed, lambda p: F.transform(
        F.filter(F.transform(p, lambda x, k: F.when(
            (F.shiftrightunsigned(x.bitwiseXOR(F.coalesce(F.get(p, k - 1), F.bitwise_not(x))), PLACE_BITS) == 0)
            | (F.shiftrightunsigned(x.bitwiseXOR(F.coalesce(F.get(p, k + 1), F.bitwise_not(x))), PLACE_BITS) == 0), x)), lambda x: x.isNotNull()),
        lambda x: x.bitwiseAND(F.lit(mask)).cast("int")))


def words_in_repeats(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more, first ones included.

    Windows that share the high 33 bits of their hash are looked for first; what is left must also share the low 33
    bits, so that all 64 agree. Covered words follow from the gaps between such windows.
    """
    def covered(hashes):
        high = places_met_again(hashes, F.sequence(F.lit(0), F.size(hashes) - 1), PLACE_BITS)
        both = F.sort_array(bound(high, lambda h: F.when(F.size(h) > 0, places_met_again(hashes, h, 0)).otherwise(h)))
        return bound(both, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b))

    return bound(windows_of(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def facts(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document, text no longer needed: counts, and hash and words of each line."""
    body = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), body.alias("body"))
    told = read.select("doc_id", "host", "body", bound(words_of(F.col("body")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        words_in_repeats(w).cast("long").alias("n_repeat_words"))).alias("w"))
    plain = F.trim(F.regexp_replace(F.lower("body"), r"[\x20\x09\x0B-\x0D]+", " "))
    # the same text on two rows is one document when lines are counted
    return told.select(
        "doc_id", "host", "w.*", F.xxhash64("body").alias("text_hash"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound(F.filter(F.split("body", "\n", -1), lambda x: x.rlike(WORD)),
              lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        bound(F.filter(F.transform(F.split(plain, "\n", -1), F.trim), lambda x: x != F.lit("")),
              lambda x: F.transform(x, lambda y: F.struct(F.xxhash64(y).alias("hash"), (F.length(y) - F.length(F.translate(y, " ", "")) + 1).alias("words")))).alias("lines"))


def line_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", line_docs: int = LINE_DOCS,
               left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE) -> DataFrame:
    """One row per document with its counts and the verdict: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, words_left.

    A line (lower case, runs of blanks as one) of any length that more than ``line_docs`` distinct texts of a host have
    is removed from all its documents; the limit is the same on a host of any size. A document is depleted, and
    rejected, if fewer than ``left_words`` words or than ``left_share`` of its words are left. Copies of a text count as
    one document, so being copied depletes nobody.

    Lines are counted with sums made before the shuffle and joined back as a stored table: the adaptive skew
    join splits a line that a third of all documents have. Null and empty texts have no words and fail the base rule; a
    null host is a host of its own; rows with the same key and text get the same answer; very long texts are hashed line
    by line; an empty table gives an empty result.
    """
    known = stored(facts(docs, key, text, host).withColumn("row_no", F.monotonically_increasing_id()), "line-facts")
    one = known.groupBy("host", "text_hash").agg(F.min("row_no").alias("row_no"))
    lines = known.join(one.select("row_no"), "row_no", "left_semi").select(
        "host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    often = stored(lines.groupBy("host", "hash").agg(F.count("*").alias("docs")).where(F.col("docs") > line_docs).select(
        F.col("host").alias("its_host"), F.col("hash").alias("its_hash")), "line-often")
    every = known.select("row_no", "host", F.explode("lines").alias("line")).select("row_no", "host", "line.hash", "line.words")
    gone = every.join(often, F.col("host").eqNullSafe(F.col("its_host")) & (F.col("hash") == F.col("its_hash"))).groupBy("row_no").agg(
        F.sum("words").alias("gone"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    depleted = (left < left_words) | (left < F.col("n_words") * left_share)
    return known.drop("lines").join(gone, "row_no", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), left.alias("words_left"))

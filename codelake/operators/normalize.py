"""Corpus jobs that rewrite code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.functions import code as C
from codelake.functions import text as T
from codelake.operators.dedup import dedup_exact
from codelake.operators.skew import lookup_join


def preprocess_corpus(
    df: DataFrame, text: str = "text", docstrings: bool = True, whitespace: bool = True
) -> DataFrame:
    """TXT-6: adds processed_code, steps and error.

    The steps cannot fail on text, so an error is recorded only for a missing text.
    """
    steps = ["comments_removed"]
    code = T.strip_comments_scan(F.col(text))
    if docstrings:
        code = C.code_facts(code, "no_docstrings")["no_docstrings"]
        steps.append("docstrings_removed")
    out = df.withColumn("processed_code", code)
    if whitespace:
        out = out.withColumn("processed_code", T.normalize_whitespace(F.col("processed_code")))
        steps.append("whitespace_normalized")
    missing = F.col(text).isNull()
    return out.withColumns({
        "steps": F.when(missing, F.array().cast("array<string>")).otherwise(F.array(*[F.lit(s) for s in steps])),
        "error": F.when(missing, F.lit("text is missing")),
    })


def normalized_text(df: DataFrame, text: str = "text", to: str = "text_norm") -> DataFrame:
    """TXT-2, TXT-7 and TXT-5 in turn."""
    bare = F.coalesce(C.strip_comments_tok(F.col(text)), T.strip_comments_fallback(F.col(text)))
    out = df.withColumn("_bare", bare)
    renamed = C.code_facts(F.col("_bare"), "renamed")["renamed"]
    return out.withColumn(to, T.collapse_blank_lines(renamed)).drop("_bare")


def tidy_corpus(df: DataFrame, text: str = "text", to: str = "tidy") -> DataFrame:
    """TXT-2 and TXT-5, light variant: unreadable texts keep their comments; then a tidy layout."""
    bare = F.coalesce(C.strip_comments_tok(F.col(text)), F.col(text))
    return df.withColumn("_bare", bare).withColumn(to, T.tidy_layout(F.col("_bare"))).drop("_bare")


def normalize_corpus(df: DataFrame, order: str, text: str = "text") -> DataFrame:
    """NRM-1: normalised text with its hash and sizes, first row per hash.

    Equal texts normalise alike, so only the first row of each raw text is read by
    Python; the survivors are the same as when all rows were.
    """
    raw = df.where(F.col(text).isNotNull()).withColumn("_raw", F.sha2(text, 256))
    distinct = dedup_exact(raw, "_raw", order).drop("_raw")
    normal = normalized_text(distinct, text).withColumns({
        "text_norm_sha1": F.sha1("text_norm"),
        "n_chars_norm": T.n_chars(F.col("text_norm")),
        "n_lines_norm": T.n_lines(F.col("text_norm")),
    })
    return dedup_exact(normal, "text_norm_sha1", order)


def with_facts(df: DataFrame, *wanted: str, text: str = "text") -> DataFrame:
    """Parse-derived columns, with the interpreter they depend on."""
    facts = df.withColumn("_facts", C.code_facts(F.col(text), *wanted))
    return facts.select(*df.columns, "_facts.*", F.lit(C.PYTHON_VERSION).alias("python_version"))


def with_facts_shared(df: DataFrame, key: str, *wanted: str, text: str = "text") -> DataFrame:
    """UDF-2: as ``with_facts``, but each distinct text is parsed once in the whole cluster.

    Pays when texts repeat a lot: it shuffles the texts' hashes, joins the facts back on
    them and deals hot texts over several tasks.
    """
    hashed = df.withColumn("_text_hash", F.sha2(text, 256))
    first = dedup_exact(hashed.select("_text_hash", text, key), "_text_hash", key)
    facts = first.select("_text_hash", C.code_facts(F.col(text), *wanted).alias("_facts"))
    joined = lookup_join(hashed, facts, ["_text_hash"], spread=[key], how="left")
    return joined.select(*df.columns, "_facts.*", F.lit(C.PYTHON_VERSION).alias("python_version"))


def partition_parseable(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """FLT-6: rows Python can parse, and (total, valid, invalid, success_rate)."""
    checked = df.withColumn("parse_ok", C.code_facts(F.col(text), "parse_ok")["parse_ok"])
    total = F.count(F.lit(1))
    valid = F.count_if("parse_ok")
    report = checked.agg(
        total.alias("total"), valid.alias("valid"), (total - valid).alias("invalid"),
        F.when(total > 0, valid / total * 100).otherwise(F.lit(0.0)).alias("success_rate"))
    return checked.where("parse_ok").drop("parse_ok"), report


def code_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """AGG-7: functions, classes and lines per text; lines are counted even where nothing parses."""
    facts = df.withColumn("_facts", C.code_facts(F.col(text), "n_functions", "n_classes"))
    lines = F.size(F.split(text, "\n", -1))
    return facts.select(*df.columns, "_facts.*", lines.alias("n_lines"))


def mark_corpus(
    df: DataFrame, text: str = "text", keep_comments: bool = False, normalize_literals: bool = True,
    fold_returns: bool = True, to: str = "marked",
) -> DataFrame:
    """TXT-8: layout-marked text; unreadable texts get newline marks only."""
    marked = C.mark_structure(F.col(text), keep_comments, normalize_literals)
    return df.withColumn(to, F.coalesce(marked, T.mark_newlines(F.col(text), fold_returns)))

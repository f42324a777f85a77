"""Column resolution, row filters and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.functions import text as T
from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators.ranking import position, take_first, with_quantile_bucket

# Text columns by priority, per family of inputs.
TEXT_PRIORITY = {
    "text": ("text",),
    "corpus": ("text", "text_norm"),
    "corpus_or_pairs": ("text", "text_norm", "text_a"),
    "processed": ("processed_code", "code", "text"),
}
STATUS_PRIORITY = ("status", "Status", "judge_status")


def find_column(df: DataFrame, candidates: tuple[str, ...], containing: tuple[str, ...] = ()) -> str | None:
    """First candidate present, else the first column whose name contains one of ``containing``."""
    present = [c for c in candidates if c in df.columns]
    similar = [c for c in df.columns if any(part in c.lower() for part in containing)]
    return next(iter(present + similar), None)


def resolve_text(df: DataFrame, family: str = "processed", to: str | None = None, guess: bool = False) -> DataFrame:
    """PRJ-1: rename the text column found by priority to ``to``."""
    found = find_column(df, TEXT_PRIORITY[family], ("code", "text") if guess else ())
    if found is None:
        raise ValueError(f"no text column among {df.columns}")
    return df.withColumnRenamed(found, to or TEXT_PRIORITY[family][0])


def require_columns(df: DataFrame, names: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """PRJ-1: rename first, then match ``names`` whatever their case; missing names are an error."""
    df = df.withColumnsRenamed({a: b for a, b in (renames or {}).items() if b not in df.columns})
    by_lower = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in by_lower]
    if missing:
        raise ValueError(f"missing columns {missing} in {df.columns}")
    return df.withColumnsRenamed({by_lower[n.lower()]: n for n in names})


def with_row_problem(df: DataFrame, order: str, dense: bool = True) -> DataFrame:
    """PRJ-2: rows without a problem become their own problem.

    ``dense`` numbers rows 0, 1, ... by a unique number; otherwise the order key
    itself names the problem and no shuffle is needed.
    """
    if "problem_id" in df.columns:
        return df
    if not dense:
        return df.withColumn("problem_id", F.col(order).cast("string"))
    bucketed = with_quantile_bucket(df, order, "_range")
    numbered = position(bucketed, "problem_id", [F.col(order)], F.col("_range")).drop("_range")
    return numbered.withColumn("problem_id", F.col("problem_id").cast("string"))


def export_pairs(df: DataFrame) -> DataFrame:
    """PRJ-3."""
    return df.select(
        F.col("code1_processed").alias("text1"), F.col("code2_processed").alias("text2"),
        F.col("similar").alias("labels"))


def problem_ids(spark, start: int, stop: int) -> DataFrame:
    """FLT-1: generated ids p00000, p00001, ..."""
    return spark.range(start, stop).select(F.format_string("p%05d", "id").alias("problem_id"))


def filter_problems(df: DataFrame, ids: DataFrame | list[str]) -> DataFrame:
    """FLT-1: membership in a short list, or in a table of any size."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select("problem_id"), "problem_id", "left_semi")
    return df.where(F.col("problem_id").isin(*ids))


def filter_language(df: DataFrame, language: str = "Python") -> DataFrame:
    """FLT-2."""
    return df.where(F.col("language") == language)


def normalized_status(df: DataFrame, column: str) -> Column:
    """FLT-3: whole number 4, AC and ACCEPTED in any case are AC; other text is upper-cased."""
    value = F.col(column)
    if dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.when(value == 4, "AC").otherwise(value.cast("string")), F.lit(""))
    tidy = F.upper(T.trim(value.cast("string")))
    return F.coalesce(F.when(tidy.isin("AC", "ACCEPTED"), "AC").otherwise(tidy), F.lit(""))


def filter_accepted(df: DataFrame, exact: bool = False) -> DataFrame:
    """FLT-3: ``exact`` keeps 'Accepted' and drops the column; frames without a status pass."""
    if exact:
        return df.where("status = 'Accepted'").drop("status") if "status" in df.columns else df
    column = find_column(df, STATUS_PRIORITY)
    return df if column is None else df.where(normalized_status(df, column) == "AC")


def drop_null_text(df: DataFrame, column: str) -> DataFrame:
    """FLT-4, corpora."""
    return df.dropna(subset=[column])


def fill_empty(df: DataFrame, *columns: str) -> DataFrame:
    """FLT-4, pairs."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def usable_text(df: DataFrame, text: str = "processed_code", error: str = "error") -> DataFrame:
    """FLT-5: text with something in it and no recorded error."""
    return df.where(~T.is_blank(F.col(text)) & (F.coalesce(F.col(error), F.lit("")) == ""))


def sample_n(df: DataFrame, n: int, seed, key: str) -> DataFrame:
    """FLT-7: exactly ``n`` rows by seeded draw, or all rows when there are no more."""
    draw = draw_key(seed, key)
    return take_first(df, [draw, F.col(key)], draw_bucket(draw), lambda size: n)


def seeded_shuffle(df: DataFrame, seed, key: str) -> DataFrame:
    """SRT-1."""
    return df.orderBy(draw_key(seed, key), key)


def keep_by_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """JOIN-4."""
    return df.join(ids.select(on), on, "left_semi")


def drop_by_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """JOIN-3."""
    return df.join(ids.select(on), on, "left_anti")


def attach_predictions(sample: DataFrame, predictions: DataFrame) -> DataFrame:
    """JOIN-7: predicted labels by pair id."""
    return sample.select("pair_id").join(predictions.select("pair_id", "similar"), "pair_id")


def union_examples(*parts: DataFrame) -> DataFrame:
    """SET-1."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import share_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, folds: int, fold: int, key: str = "doc_id",
                    text: str = "text", longest: int | None = None) -> DataFrame:
    """text and label (0 or 1) of about ``most`` documents per label, drawn by a hash of the key.

    Only rows whose crc32 of the key is not ``fold`` modulo ``folds`` take part. The draw is made on the label table,
    so that the join gets a small bounded side; ``longest`` leaves texts of more characters out of the sample.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (share_of(F.col("doc_id"), folds) != fold)).select(
        F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("label")).dropDuplicates(["__id"])
    counts = {r["label"]: r["rows"] for r in rows.groupBy("label").agg(F.count("*").alias("rows")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("__id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("label") == 1, F.lit(most / max(counts.get(1, 1), 1))).otherwise(F.lit(most / max(counts.get(0, 1), 1)))
    chosen = rows.where(draw < rate)
    found = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    if longest:
        found = found.where(F.length("text") <= longest)
    return found.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")

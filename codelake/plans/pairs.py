"""From labelled pairs to scored and judged predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelake.functions import text as T
from codelake.operators import dedup, evaluate, normalize, score, splits
from codelake.operators.pairs import attach_code, build_pairs
from codelake.operators.stats import label_distribution
from codelake.session import durable
from codelake.sources.corpus import read_source_tree, write_submission


def processed_pairs(pairs: DataFrame, source: str = "train_csv") -> DataFrame:
    """Both codes of labelled pairs preprocessed, with the source columns of a table built from files."""
    for side in ("1", "2"):
        done = normalize.preprocess_corpus(pairs, f"code{side}")
        pairs = done.withColumnRenamed("processed_code", f"code{side}_processed").drop("steps", "error")
    return pairs.withColumns({"source1": F.lit(source), "source2": F.lit(source)})


def pairs_from_tree(
    spark: SparkSession, root: str, cap: int = 250, ratio: float = 1.0, seed=42,
    max_problems: int | None = None, max_files: int | None = None,
) -> DataFrame:
    """Labelled, preprocessed pairs of the files below ``root/<problem>/``."""
    files = normalize.preprocess_corpus(read_source_tree(spark, root, max_problems, max_files), "code")
    files = durable(files.select("problem_id", "file_path", "processed_code"))  # ids first, texts at the end
    drawn = build_pairs(files, "file_path", cap, ratio, seed)
    named = attach_code(drawn, files, "file_path", "processed_code")
    return named.withColumnsRenamed({
        "id1": "source1", "id2": "source2", "code1": "code1_processed", "code2": "code2_processed"})


def predict_and_submit(
    model: score.PairModel, pairs: DataFrame, folder: str, label: str, threshold: float = 0.5,
    code1: str = "code1", code2: str = "code2",
) -> tuple[str, DataFrame]:
    """Score test pairs and write the submission; returns its path and the label distribution."""
    tokens = pairs.select("pair_id", T.words(F.col(code1)).alias("_t1"), T.words(F.col(code2)).alias("_t2"))
    predicted = durable(model.score(tokens, "_t1", "_t2", threshold).select("pair_id", "similar"))
    return write_submission(predicted, folder, label), label_distribution(predicted)


@dataclass
class Judged:
    model: score.PairModel
    validation: DataFrame
    metrics: DataFrame


def train_and_judge(
    pairs: DataFrame, key: str, ratio: float = 0.1, seed=42, code1: str = "code1", code2: str = "code2"
) -> Judged:
    """Pair dedup, stratified split, fit, score the validation part and judge it."""
    unique = durable(dedup.dedup_pairs(pairs, key, code1, code2))  # split, fit and score all read it
    parts = splits.split_stratified(unique, "similar", key, ratio, seed).withColumns({
        "_t1": T.words(F.col(code1)), "_t2": T.words(F.col(code2))})
    model = score.fit_pair_model(parts.where("split = 'train'"), "_t1", "_t2")
    held = parts.where("split = 'validation'").withColumn("label", F.col("similar"))
    scored = model.score(held, "_t1", "_t2").drop("_t1", "_t2")
    return Judged(model, scored, evaluate.classification_metrics(scored, "label", "similar"))


def judge_retrieval(
    vectors: DataFrame, row_number: str, a: str, b: str, pair_type: str, batch_size: int, tau: float = 0.1
) -> DataFrame:
    """Batches, in-batch scores, mean loss and retrieval metrics in one row."""
    batched = evaluate.with_batches(vectors, row_number, batch_size)
    loss = evaluate.weighted_info_nce(batched, a, b, pair_type, tau).agg(F.avg("loss")).scalar()
    return evaluate.retrieval_metrics(batched, a, b).withColumn("loss", loss)

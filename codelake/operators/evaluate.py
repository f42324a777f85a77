"""Scores, classification metrics and retrieval metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.operators.ranking import running_before, with_quantile_bucket

# Loss weights by pair type, the smallest temperature, and twentieths as cut-offs.
WEIGHTS = {"hard_negative": 1.5, "semi_hard_negative": 1.3}
MIN_TAU = 0.001
THRESHOLDS = 20


def dot(a, b) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def unit(vector) -> Column:
    """L2-normalised copy."""
    norm = F.sqrt(dot(vector, vector))
    return F.transform(vector, lambda x: x.cast("double") / norm)


def score_cosine(df: DataFrame, a: str, b: str, tau: float = 0.1) -> DataFrame:
    """SCR-1: sigmoid of the scaled dot product, and the label at one half."""
    scaled = dot(a, b) / F.lit(float(max(tau, MIN_TAU)))
    return df.withColumn("score", 1 / (1 + F.exp(-scaled))).withColumn("similar", (F.col("score") >= 0.5).cast("int"))


def softmax(logits: str) -> Column:
    top = F.array_max(logits).cast("double")
    powers = F.transform(logits, lambda x: F.exp(x.cast("double") - top))
    total = F.aggregate(powers, F.lit(0.0), lambda s, p: s + p)
    return F.transform(powers, lambda p: p / total)


def predict_threshold(df: DataFrame, logits: str, threshold: float = 0.5) -> DataFrame:
    """SCR-2: probability of class 1 against a threshold."""
    return df.withColumn("probability", softmax(logits)[1]).withColumn(
        "similar", (F.col("probability") >= threshold).cast("int"))


def predict_argmax(df: DataFrame, logits: str) -> DataFrame:
    """SCR-2: the most likely class (first among equals) and its probability."""
    probabilities = softmax(logits)
    best = F.array_position(logits, F.array_max(logits)) - 1
    return df.withColumn("similar", best.cast("int")).withColumn("probability", F.array_max(probabilities))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def classification_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """EVL-1: accuracy, binary precision / recall / F1 with zero for 0/0, and macro F1."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    # a class absent from both labels and predictions has no part in the macro average
    has_one, has_zero = (tp + fp + fn > 0).cast("int"), (tn + fn + fp > 0).cast("int")
    return confusion(df, label, predicted).select(
        "tp", "fp", "fn", "tn",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        f1_of(tp, fp, fn).alias("f1"),
        _ratio(f1_of(tp, fp, fn) + f1_of(tn, fn, fp), has_one + has_zero).alias("macro_f1"))


def batch_accuracy(df: DataFrame, batch: str, label: str, predicted: str) -> DataFrame:
    """EVL-1: mean over batches of the batch accuracy, so a short batch weighs as much."""
    hit = (F.col(label) == F.col(predicted)).cast("double")
    return df.groupBy(batch).agg(F.avg(hit).alias("_acc")).agg(
        F.avg("_acc").alias("accuracy"), F.count(F.lit(1)).alias("batches"))


def threshold_sweep(df: DataFrame, label: str, score: str) -> DataFrame:
    """EVL-2: F1 at .05, .10, ... .95 from one 20-bin histogram of the scores."""
    steps = range(1, THRESHOLDS)
    passed = sum(((F.col(score) >= F.lit(k / THRESHOLDS)).cast("int") for k in steps), F.lit(0))
    bins = df.groupBy(passed.alias("passed")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    totals = [
        F.struct(
            F.lit(k).alias("k"),
            F.sum(F.when(F.col("passed") >= k, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("passed") >= k, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(F.col("passed") < k, F.col("pos")).otherwise(0)).alias("fn"))
        for k in steps
    ]
    rows = bins.agg(F.array(*totals).alias("rows")).select(F.inline("rows"))
    return rows.select(
        (F.col("k") / THRESHOLDS).alias("threshold"), "tp", "fp", "fn",
        f1_of(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def best_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """EVL-2: the lowest threshold among those with the largest F1."""
    return threshold_sweep(df, label, score).orderBy(F.desc("f1"), "threshold").limit(1)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """EVL-3: rank-sum area with average ranks for ties; NaN when one class is missing."""
    points = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    bucketed = with_quantile_bucket(points, "score", "_range")
    ranked = running_before(bucketed, F.col("_range"), "score", {"neg": "neg_below"})
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2))
    both = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.when(both > 0, wins / both).otherwise(F.lit(float("nan"))).alias("auc"))


#: Rows and columns of a square of a batch's similarity matrix.
TILE = 512


def with_batches(df: DataFrame, row_number: str, batch_size: int) -> DataFrame:
    """Consecutive rows in batches: ``batch`` and the place ``row`` within it."""
    return df.withColumn("batch", F.floor(F.col(row_number) / batch_size).cast("long")).withColumn(
        "row", (F.col(row_number) % batch_size).cast("int"))


def _batch_side(df: DataFrame, vector: str) -> DataFrame:
    # a batch is a few dozen rows by construction
    return df.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("row", F.col(vector).alias("vector")))).alias("side"))


def score_rows(df: DataFrame, a: str, b: str, tau: float = 1.0) -> DataFrame:
    """Each row's dot products with every ``b`` of its batch, as one array per row."""
    scores = F.transform("side", lambda s: F.struct(
        s["row"].alias("row"), (dot(F.col(a), s["vector"]) / F.lit(float(max(tau, MIN_TAU)))).alias("score")))
    return df.join(_batch_side(df, b), "batch").withColumn("scores", scores).drop("side")


def similarity_matrix(df: DataFrame, a: str, b: str, tile: int = TILE, tau: float = 1.0) -> DataFrame:
    """JOIN-8: (batch, row, col, score) for every pair of a batch, of any size.

    A batch's matrix is cut into squares of ``tile`` rows and columns; each row goes to the squares of its stripe, where
    it meets ``tile`` others. So a large batch is spread over many tasks, and none holds more than a stripe of one square.
    """
    squares = df.groupBy("batch").agg(F.floor(F.max("row") / tile).alias("_last"))
    placed = df.join(squares, "batch")
    across = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))
    own = F.floor(F.col("row") / tile)
    left = placed.select("batch", "row", F.col(a).alias("_a"), own.alias("_down"), across.alias("_across"))
    right = placed.select("batch", F.col("row").alias("col"), F.col(b).alias("_b"), own.alias("_across"), across.alias("_down"))
    score = dot(F.col("_a"), F.col("_b")) / F.lit(float(max(tau, MIN_TAU)))
    return left.join(right, ["batch", "_down", "_across"]).select("batch", "row", "col", score.alias("score"))


def rank_candidates(df: DataFrame, a: str, b: str) -> DataFrame:
    """WIN-3: one-based place of the row's own item by descending score, earlier rows first among equals."""
    scored = score_rows(df, a, b)
    own = F.element_at(F.filter("scores", lambda s: s["row"] == F.col("row")), 1)["score"]
    ahead = F.filter("scores", lambda s: (s["score"] > F.col("own")) | (
        (s["score"] == F.col("own")) & (s["row"] < F.col("row"))))
    return scored.withColumn("own", own).withColumn("rank", F.size(ahead) + 1).drop("own", "scores")


def retrieval_metrics(df: DataFrame, a: str, b: str, ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """EVL-4: recall@k, MRR and in-batch accuracy, averaged per batch and then over batches."""
    ranked = rank_candidates(df, a, b)
    hits = [F.avg((F.col("rank") <= k).cast("double")).alias(f"recall_at_{k}") for k in ks]
    per_batch = ranked.groupBy("batch").agg(
        *hits, F.avg(1 / F.col("rank")).alias("mrr"),
        F.avg((F.col("rank") == 1).cast("double")).alias("accuracy"))
    return per_batch.agg(*[F.avg(c).alias(c) for c in per_batch.columns if c != "batch"])


def _log_sum_exp(scores: Column) -> Column:
    top = F.array_max(scores)
    return top + F.log(F.aggregate(scores, F.lit(0.0), lambda s, x: s + F.exp(x - top)))


def weighted_info_nce(df: DataFrame, a: str, b: str, pair_type: str, tau: float) -> DataFrame:
    """EVL-5: symmetric cross-entropy against the own item, weighted by pair type; one row per batch."""
    def losses(x, y, name):
        scored = score_rows(df.select("batch", "row", a, b), x, y, tau)
        scores = F.transform("scores", lambda s: s["score"])
        own = F.element_at(F.filter("scores", lambda s: s["row"] == F.col("row")), 1)["score"]
        return scored.select("batch", "row", (_log_sum_exp(scores) - own).alias(name))

    weight = F.lit(1.0)
    for kind, value in WEIGHTS.items():
        weight = F.when(F.col(pair_type) == kind, F.lit(value)).otherwise(weight)
    both = df.select("batch", "row", weight.alias("weight")).join(losses(a, b, "across"), ["batch", "row"]).join(
        losses(b, a, "down"), ["batch", "row"])
    return both.groupBy("batch").agg(
        F.avg((F.col("across") + F.col("down")) / 2 * F.col("weight")).alias("loss"))


def experiment_summary(runs: dict[str, tuple[int, DataFrame]]) -> DataFrame:
    """EVL-6: one row per model with its maximum length and metrics."""
    rows = [
        metrics.select(F.lit(name).alias("model"), F.lit(length).alias("max_length"), "*")
        for name, (length, metrics) in runs.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out

"""SCR-3: a pair classifier from Spark ML parts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.session import durable

#: Buckets of words of one pair.
BUCKETS = 1 << 16


def _jaccard(a: str, b: str) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def _weights(size: int) -> Pipeline:
    """Sparse counts of a pair's marked words in ``size`` buckets, weighted by how few pairs have them; then the Jaccard."""
    return Pipeline(stages=[
        HashingTF(inputCol="_marked", outputCol="_tf", numFeatures=size, binary=True),
        IDF(inputCol="_tf", outputCol="_idf"),
        VectorAssembler(inputCols=["_idf", "_jaccard"], outputCol="features"),
    ])


class PairModel:
    """Pair features (words of one side, words of both, Jaccard) under a logistic regression."""

    def __init__(self, size: int, idf: PipelineModel, classifier):
        self.size, self.idf, self.classifier = size, idf, classifier

    def features(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        return _features(pairs, a, b, self.idf)

    def score(self, pairs: DataFrame, a: str, b: str, threshold: float = 0.5) -> DataFrame:
        scored = self.classifier.transform(self.features(pairs, a, b))
        probability = vector_to_array("probability")[1]
        kept = [c for c in pairs.columns if c != "similar"]
        return scored.select(*kept, probability.alias("score"), (probability >= threshold).cast("int").alias("similar"))


def _marked(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Words of both sides (their product) and of one side (their difference), each marked as such; null sides count as empty."""
    one, two = (F.coalesce(F.col(c), F.array().cast("array<string>")) for c in (a, b))
    sides = pairs.withColumns({"_one": one, "_two": two})
    both = F.transform(F.array_intersect("_one", "_two"), lambda t: F.concat(F.lit("= "), t))
    either = F.array_union(F.array_except("_one", "_two"), F.array_except("_two", "_one"))
    marked = F.concat(both, F.transform(either, lambda t: F.concat(F.lit("x "), t)))
    return sides.withColumns({"_marked": marked, "_jaccard": _jaccard("_one", "_two")}).drop("_one", "_two")


def _features(pairs: DataFrame, a: str, b: str, idf: PipelineModel) -> DataFrame:
    return idf.transform(_marked(pairs, a, b)).drop("_marked", "_jaccard", "_tf", "_idf")


def fit_pair_model(pairs: DataFrame, a: str, b: str, label: str = "similar", size: int = BUCKETS) -> PairModel:
    """Fit on token-array columns ``a`` and ``b``. Features stay sparse from the words to the regression."""
    pairs = durable(pairs.select(a, b, label))  # the fits read it again and again
    idf = _weights(size).fit(_marked(pairs, a, b))
    rows = durable(_features(pairs, a, b, idf).select("features", F.col(label).cast("double").alias(label)))
    classifier = LogisticRegression(featuresCol="features", labelCol=label, regParam=0.01, maxIter=15, tol=1e-4)
    return PairModel(size, idf, classifier.fit(rows))

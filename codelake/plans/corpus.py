"""From raw submissions to the deduplicated pretraining table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.functions import code as C
from codelake.functions import text as T
from codelake.operators import dedup, normalize, select, stats
from codelake.operators.vocab import word_counts
from codelake.session import durable

FINAL = [
    "submission_id", "user_id", "problem_id", "language", "status", "original_index", "original_code",
    "processed_code", "code_length",
]


@dataclass
class Prepared:
    """Tables of one run, all read from one stored parse of the corpus."""

    parsed: DataFrame
    processed: DataFrame
    kept: DataFrame
    final: DataFrame

    def words(self) -> DataFrame:
        return word_counts(self.final, T.words(F.col("processed_code")))

    def stages(self) -> DataFrame:
        """AGG-4 over the stages: parsed, processed without error, kept by the dedup."""
        parsed = stats.stage_rates(self.parsed, parse=F.col("parse_ok"))
        cleaned = stats.stage_rates(self.processed, preprocess=F.col("error").isNull())
        total = self.processed.agg(F.count(F.lit(1))).scalar()
        kept = self.kept.agg(F.count(F.lit(1)).alias("passed")).select(
            F.lit("dedup").alias("stage"), total.alias("total"), "passed",
            (total - F.col("passed")).alias("failed"),
            stats.percent(F.col("passed"), total).alias("success_rate"))
        return parsed.unionByName(cleaned).unionByName(kept)

    def problems(self, listed: DataFrame) -> DataFrame:
        """JOIN-6 over the listed problems."""
        return stats.before_after_by_problem(
            listed, self.parsed.where("parse_ok"), self.final, "code_length")

    def report(self, listed: DataFrame) -> DataFrame:
        """SRC-8 rows of the whole run."""
        totals = self.final.agg(
            F.count(F.lit(1)).alias("total_samples"), F.count_distinct("problem_id").alias("problems_count"),
            F.coalesce(F.avg("code_length"), F.lit(0.0)).alias("avg_code_length"),
            F.coalesce(F.sum("code_length"), F.lit(0)).alias("total_code_length"))
        return (
            stats.report_rows("final", totals)
            .unionByName(stats.report_rows("stage", self.stages(), "stage"))
            .unionByName(stats.report_rows("problem", self.problems(listed), "problem_id"))
        )


def prepare_corpus(df: DataFrame, order: str = "submission_id", listed: DataFrame | None = None) -> Prepared:
    """Filter by problem, parse check, preprocess, structural dedup, usable text, final columns."""
    for column in ("user_id", "language", "status"):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    if listed is not None:
        df = select.filter_problems(df, listed)
    checked = df.withColumn("parse_ok", C.code_facts(F.col("text"), "parse_ok")["parse_ok"])
    hash_of_processed = C.code_facts(F.col("processed_code"), "structure_sha256")["structure_sha256"]
    # dedup, vocabulary and statistics all need the parse, which is the costly step
    parsed = durable(normalize.preprocess_corpus(checked).withColumn("structure_sha256", hash_of_processed))
    processed = parsed.where("parse_ok")
    kept = dedup.dedup_structural(processed, order)
    final = select.usable_text(kept).withColumns({
        "original_index": F.col(order),
        "original_code": F.col("text"),
        "code_length": T.n_chars(F.col("processed_code")),
    }).select(*FINAL)
    return Prepared(parsed, processed, kept, final)

"""Reading and writing corpora, pairs, source trees, vocabularies and reports."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from codelake.functions import text as T
from codelake.operators.ranking import first_n_per_group
from codelake.operators.select import require_columns

RAW_CORPUS = ST.StructType([
    ST.StructField(name, ST.LongType() if name in {"code_bytes", "date", "n_chars", "n_lines"} else ST.StringType())
    for name in (
        "submission_id", "problem_id", "text", "code_sha1", "code_bytes", "language", "status", "date",
        "user_id", "n_chars", "n_lines")
])
# Code cells hold newlines, commas and doubled quotes, and blanks at their ends matter.
CSV = {
    "header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_corpus(
    spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | str | None = None,
    schema: ST.StructType | None = None,
) -> DataFrame:
    """SRC-1: columns and filters reach the Parquet scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_pairs(spark: SparkSession, path: str, names: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """SRC-2: Parquet by suffix, else CSV with multi-line cells; codes are never null."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.options(**CSV).csv(path)
    df = require_columns(df, names, renames)
    codes = [n for n in names if n not in ("similar", "pair_id")]
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in codes})
    return df.withColumn("similar", F.col("similar").cast("int")) if "similar" in names else df


def write_pairs(df: DataFrame, path: str) -> None:
    df.write.options(**{**CSV, "quoteAll": True, "emptyValue": ""}).csv(path)


def write_source_tree(df: DataFrame, root: str, problem: str, name: str, content: str) -> DataFrame:
    """SRC-3's other side: one file per row, ``root/<problem>/<name>``, written where the rows lie; (path, size) of each.

    ``root`` is a folder or URI that every task reaches; ``content`` a string, written as UTF-8, or bytes. Names are unique within a problem.
    A task that runs again writes the same files again. Rows with a null in any of the columns write nothing.
    """
    rows = df.select(F.col(problem).cast("string").alias("folder"), F.col(name).cast("string").alias("name"),
                     F.col(content).cast("binary").alias("content")).dropna()

    def write(batches):
        target, base = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        for batch in batches:
            paths, sizes = [], []
            for folder, file, data in zip(*(batch.column(c).to_pylist() for c in ("folder", "name", "content"))):
                target.create_dir(f"{base}/{folder}", recursive=True)
                with target.open_output_stream(f"{base}/{folder}/{file}") as out:
                    out.write(data)
                paths.append(f"{folder}/{file}")
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])

    return rows.mapInArrow(write, "path string, size long")


def read_source_tree(
    spark: SparkSession, root: str, max_problems: int | None = None, max_files: int | None = None
) -> DataFrame:
    """SRC-3: ``root/<problem>/*.py`` as (problem_id, file_path, code); both caps follow name order.

    Names alone decide the caps: paths are listed without contents, and only the kept files are opened. Files of no length give
    no row: Spark's scans pass over them.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.py")
    files = reader.load(root)
    parts = F.split("path", "/")
    depth = F.size(F.split(F.regexp_replace(F.lit(root), "/+$", ""), "/"))
    below = F.size(F.split(F.regexp_extract("path", r"^(?:file:/*)?(/.*)$", 1), "/")) - depth
    named = files.where(below == 2).withColumn("problem_id", F.element_at(parts, -2))
    kept = named.select("problem_id", "path")
    if max_problems is not None:
        first = kept.select("problem_id").distinct().orderBy("problem_id").limit(max_problems)
        kept = kept.join(first, "problem_id", "left_semi")
    if max_files is not None:
        kept = first_n_per_group(kept, ["problem_id"], [F.col("path")], max_files)
    if max_problems is not None or max_files is not None:
        paths = [r["path"] for r in kept.select("path").collect()]  # the file listing, which the driver holds anyway
        chosen = reader.load(paths) if paths else files.limit(0)
        named = chosen.withColumn("problem_id", F.element_at(parts, -2))
    code = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    # text-mode reading turns every line ending into a newline
    code = F.regexp_replace(code, r"\r\n?", "\n")
    return named.select("problem_id", F.col("path").alias("file_path"), code.alias("code"))


def write_corpus(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """SRC-4."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """SRC-5: the stored table, else build it and store it unless it is empty."""
    if _exists(spark, path):
        return spark.read.parquet(path)
    built = build()
    if built.isEmpty():
        return built
    write_corpus(built, path, mode="errorifexists")
    return spark.read.parquet(path)


def submission(df: DataFrame) -> DataFrame:
    return df.select("pair_id", F.col("similar").cast("int").alias("similar"))


def write_submission(df: DataFrame, folder: str, label: str, now: datetime | None = None) -> str:
    """SRC-6: CSV of pair_id, similar in pair order, in a folder named by label and time."""
    path = f"{folder}/submission_{label}_{(now or datetime.now()):%Y%m%d_%H%M%S}.csv"
    submission(df).orderBy("pair_id").write.option("header", True).csv(path)
    return path


def text_corpus(df: DataFrame, text: str, newlines: str = "space") -> DataFrame:
    """SRC-7: one document per line; the ``strip`` policy skips empty documents."""
    lines = df.select(T.one_line(F.col(text), newlines).alias("value")).where(F.col("value").isNotNull())
    return lines.where(F.length("value") > 0) if newlines == "strip" else lines


def write_text_corpus(df: DataFrame, text: str, path: str, newlines: str = "space") -> None:
    text_corpus(df, text, newlines).write.text(path)


def write_stats(rows: DataFrame, path: str) -> None:
    """SRC-8: report rows (section, item, metric, value) as JSON and as ordered text lines."""
    rows.write.json(f"{path}/json")
    report_lines(rows).write.text(f"{path}/report")


def report_lines(rows: DataFrame) -> DataFrame:
    line = F.concat(
        F.lit("["), F.col("section"), F.lit("] "),
        F.when(F.length("item") > 0, F.concat(F.col("item"), F.lit(" "))).otherwise(F.lit("")),
        F.col("metric"), F.lit(": "), F.format_number("value", 2))
    return rows.orderBy("section", "item", "metric").select(line.alias("value"))


def write_vocab(vocab: DataFrame, path: str, merges: DataFrame | None = None) -> None:
    """SRC-9: Parquet or JSON by suffix; merges beside the vocabulary."""
    def put(df, to):
        df.write.json(to) if path.endswith(".json") else df.write.parquet(to)

    put(vocab, f"{path}/vocab")
    if merges is not None:
        put(merges, f"{path}/merges")


def read_vocab(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    """SRC-9: (vocab, merges or None); a missing vocabulary is an error."""
    form = "json" if path.endswith(".json") else "parquet"
    try:
        vocab = spark.read.format(form).load(f"{path}/vocab")
    except AnalysisException as missing:
        raise FileNotFoundError(f"no vocabulary at {path}") from missing
    columns = [c for c in ("piece", "id", "score") if c in vocab.columns]
    vocab = vocab.select(*columns).withColumn("id", F.col("id").cast("int"))
    try:
        merges = spark.read.format(form).load(f"{path}/merges").select("rank", "left", "right")
    except AnalysisException:
        merges = None
    return vocab, merges


def documents_as_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The text corpus of the test tables: sources are problems, labels are judgements."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = labels.select("doc_id", F.when(F.col("quality") == 1, "Accepted").otherwise("Wrong Answer").alias("status"))
    return documents.join(judged, "doc_id", "left").select(
        F.col("doc_id").alias("submission_id"), F.col("source").alias("problem_id"),
        F.col("lang").alias("language"), "status", "text")


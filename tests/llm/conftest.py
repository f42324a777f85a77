import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("ids", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("kept", T.StringType()),
])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])

LONG = " ".join(f"w{i % 977} und{i % 31}" for i in range(30_000))
ODD = [
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b\x0c\r ", "en", None),
    (5, LONG, "de", "b"),
    (6, LONG + " ", "de", "b"),
    (7, "The quick brown fox jumps over the lazy dog again and again.", "en", "a"),
    (7, "The quick brown fox jumps over the lazy dog again and again.", "en", "a"),
    (None, "Thequick brown fox jumps over the lazy dog again and again.", None, "a"),
    (None, "a row without a key", "en", "c"),
    (-8, "日本語 text \U0001F600 é É ß  double  blanks\n\n\nlines\ttabs", "fr", "c"),
    (9, "x" * 70_000, "en", "c"),
    (10, "12 34 . , !", "en", "d"),
]


def rows_of(values):
    return [(i, t, lang, s, None, "ids", 7, "kept") for i, t, lang, s in values]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(ODD), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}

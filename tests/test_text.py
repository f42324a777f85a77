"""Native text functions against plain Python on odd inputs."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from codelake.functions import code as C
from codelake.functions import text as T
from codelake.operators import vocab

ODD = ["", " ", "\n", "a\n", "a\n\nb", "\ta", "a\tb", "ab\t\tc\r\td", "x \u00a0\t", "x\x1c", "a\r\nb\rc", "\x0b\x0cb", "é\u3000 ",
       "a\u2028b", "\n\n", "a \n \t\n\nb", "\u00a0x\u2003", "a\x85b", "tail\n \n"]


def random_lines(n, letters, seed=1, size=14):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(size))) for _ in range(n)]


def run(spark, texts, make):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    return [r.out for r in rows.select("i", make(F.col("t")).alias("out")).orderBy("i").collect()]


def cut_line(line):
    quote = None
    for at, char in enumerate(line):
        if quote:
            if char == quote and (at == 0 or line[at - 1] != "\\"):
                quote = None
        elif char in "'\"":
            quote = char
        elif char == "#":
            return line[:at].rstrip()
    return line.rstrip()


def test_comment_scan(spark):
    texts = random_lines(4000, "a#'\"\\ \n\r\t\u2028") + ODD + ["x = 'a#b' # c", '"""\n# in block\n"""', "# \n'#'#'"]
    wanted = ["\n".join(cut_line(line) for line in t.split("\n")) for t in texts]
    assert run(spark, texts, T.strip_comments_scan) == wanted


def test_comment_fallback(spark):
    def plain(text):
        lines = []
        for line in text.splitlines():
            head, mark, _ = line.partition("#")
            even = head.count('"') % 2 == 0 and head.count("'") % 2 == 0
            lines.append(head.rstrip() if mark and even else line)
        return "\n".join(lines)

    texts = random_lines(2000, "a#'\" \n\r\x0b\x85\u2029") + ODD
    assert run(spark, texts, T.strip_comments_fallback) == [plain(t) for t in texts]


def test_whitespace(spark):
    def plain(text):
        lines = (line.expandtabs(4).rstrip() for line in text.split("\n"))
        return "\n".join(line for line in lines if line)

    texts = random_lines(2000, "ab\t\t \n\r\x1d\u00a0") + ODD
    wanted = [plain(t) for t in texts]
    assert run(spark, texts, T.normalize_whitespace) == wanted
    assert run(spark, wanted, T.normalize_whitespace) == wanted


def test_lines_trim_and_blank(spark):
    texts = random_lines(1000, "a \n\r\x0c\x1e\x85\u2029") + ODD
    assert run(spark, texts, T.split_lines) == [t.splitlines() for t in texts]
    assert run(spark, texts, T.trim) == [t.strip() for t in texts]
    assert run(spark, texts, T.is_blank) == [not t.strip() for t in texts]
    assert run(spark, texts, T.n_lines) == [t.count("\n") + 1 if t else 0 for t in texts]
    assert run(spark, texts, T.squeeze) == [" ".join(t.split()) for t in texts]
    assert run(spark, texts, T.words_by_space) == [t.split() for t in texts]


def test_collapse_and_tidy(spark):
    import re

    texts = random_lines(1000, "a \n\n\t\x1c") + ODD
    assert run(spark, texts, T.collapse_blank_lines) == [re.sub(r"\n\s*\n+", "\n\n", t) for t in texts]
    wanted = [
        re.sub(r"\n{3,}", "\n\n", "\n".join(line.rstrip() for line in t.replace("\t", "    ").splitlines())) for t in texts]
    assert run(spark, texts, T.tidy_layout) == wanted


def test_words(spark):
    import re

    texts = ["a_b+=c1", "é tä 12.5", "x==y  'q'", "", "日本 x"]
    assert run(spark, texts, T.words) == [re.findall(r"\w+|[^\w\s]+", t) for t in texts]
    assert run(spark, ["ab12, c"], T.words_punct_digits) == [["ab", "1", "2", ",", "c"]]
    assert run(spark, ["it's  a 1x"], T.words_with_space) == [["it", "'s", " ", " a", " 1", "x"]]


@pytest.mark.parametrize("token, role", [
    ("[CLS]", 6), ("[UNK]", 6), ("def", 2), ("DEF", 2), ("12", 5), ("1.5", 5), ("1.", 3), ("'a", 5), ('"x"', 5), ("'", 3),
    ("**=", 4), ("->", 4), ("(", 4), ("name", 3), ("", 3)])
def test_roles(spark, token, role):
    assert run(spark, [token], T.role_of) == [role]


def test_batches_of_few_bytes(spark):
    """What a task's Python holds of long texts does not grow with their number."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    texts = spark.range(400).repartition(1).select(F.repeat(F.lit("é" * 100), 100).alias("text"))
    normal = C.unicode_normalize(F.col("text"), "NFD", strip_accents=True)

    @F.pandas_udf("int")
    def rows(t: pd.Series) -> pd.Series:
        return pd.Series([len(t)] * len(t))

    assert texts.where(normal == "e" * 10_000).count() == 400
    assert texts.select(rows("text").alias("n")).agg(F.max("n")).first()[0] <= 110
    spark.conf.set(key, "1m")
    vocab.decode_lists(F.col("ids"), ["a"], "chars")
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)

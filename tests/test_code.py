"""Jobs that parse code: hand-written cases."""

import ast

import pytest
from pyspark.sql import functions as F

from codelake.functions import code as C
from codelake.functions import text as T
from codelake.operators import normalize

RENAMED = [
    ("def f(n):\n    return f(n - 1)", "def func1(v1):\n    return f(v1 - 1)"),
    ("y = 1\nx = y", "g1 = 1\ng2 = y"),
    ("y = 1\nx = y + 1", "g1 = 1\ng2 = g1 + 1"),
    ("import os\nos.x()\na = os", "import os\nos.x()\ng1 = os"),
    ("import os\nos = 3\nprint(os)", "import os\ng1 = 3\nprint(os)"),
    ("a = 1\na.b.c()", "g1 = 1\ng1.b.c()"),
    ("a = 1\na.b()", "g1 = 1\na.b()"),
    ("a = 1\nx = a.b", "g1 = 1\ng2 = g1.b"),
    ("a = 1\nx = a.b.c", "g1 = 1\ng2 = a.b.c"),
    ("print = 2\nprint(1)", "g1 = 2\nprint(1)"),
    ("r = [x for x in y]", "g2 = [x for g1 in y]"),
    # an inner function's aliases start over, so its own v1 hides the outer one on read
    ("def o(a):\n    def i(b):\n        return a + b\n    return i", "def func1(v1):\n\n    def func2(v1):\n        return v1 + v1\n    return i"),
    ("class A:\n    k = 1", "class Cls1:\n    v1 = 1"),
    ("async def f(q):\n    return q", "async def f(q):\n    return q"),
    ("for i in range(3):\n    print(i)", "for g1 in range(3):\n    print(g1)"),
    ("x, (y, z) = t", "g1, (g2, g3) = t"),
    ("from a import b as c\nc()", "from a import b as c\nc()"),
    ("def f(*p, k=1, **q):\n    return p, k, q", "def func1(*v2, v1=1, **v3):\n    return (v2, v1, v3)"),
    ("def broken(", "def broken("),
]


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "t string").select(make(F.col("t")).alias("out")).first().out


def test_renaming(spark):
    rows = spark.createDataFrame(list(enumerate(t for t, _ in RENAMED)), "i int, t string")
    found = rows.select("i", C.code_facts(F.col("t"), "renamed")["renamed"].alias("out")).orderBy("i").collect()
    assert [r.out for r in found] == [wanted for _, wanted in RENAMED]


def test_docstring_only_def_stops_parsing(spark):
    out = one(spark, 'def f():\n    "doc"\n', lambda c: C.code_facts(c, "no_docstrings")["no_docstrings"])
    with pytest.raises(SyntaxError):
        ast.parse(out)
    assert one(spark, out, lambda c: C.code_facts(c, "structure_sha256")["structure_sha256"]) is None


def test_structure_ignores_names(spark):
    def hashed(text):
        return one(spark, text, lambda c: C.code_facts(c, "structure_sha256")["structure_sha256"])

    assert hashed("def f(a):\n    return len(a)") == hashed("def g(zz):  # x\n    return sum(zz)")
    assert hashed("a.x") != hashed("a.y")
    assert hashed("f(k=1)") != hashed("f(j=1)")
    assert hashed("x = 1") != hashed("x = 2")
    assert hashed("def f(*, a): pass") != hashed("def f(*, b): pass")


def test_marks(spark):
    def marked(text, **options):
        rows = spark.createDataFrame([(text,)], "text string")
        return normalize.mark_corpus(rows, **options).first().marked

    assert marked("if x:\n  y = 'a' # c\n") == (
        "if x : <newline> <indent> y = <str> <newline> <dedent>")
    assert marked("x = 1 # c\n", keep_comments=True, normalize_literals=False) == "x = 1 # c <newline>"
    assert marked("(\r\nx\ry") == "( <newline> x <newline> y"
    assert marked("(\r\nx", fold_returns=False) == "( <newline> x"


def test_comment_tokens_and_fallback(spark):
    def bare(text):
        return one(spark, text, lambda c: F.coalesce(C.strip_comments_tok(c), T.strip_comments_fallback(c)))

    assert "#" not in bare("x = 1 # c\n")
    assert bare("( 'a#b' # c\nz") == "( 'a#b' # c\nz"  # the first mark sits in an open quote
    assert bare("( # c\nz") == "(\nz"


def test_shared_facts_equal_plain_facts(spark):
    rows = spark.createDataFrame([(i, f"x = {i % 3}") for i in range(200)] + [(200, "x ="), (201, None)], "id int, text string")
    plain = {tuple(r) for r in normalize.with_facts(rows, "parse_ok", "dump_md5").collect()}
    shared = {tuple(r) for r in normalize.with_facts_shared(rows, "id", "parse_ok", "dump_md5").collect()}
    assert plain == shared


def test_unicode_forms(spark):
    import unicodedata

    text = "ﬁ é Ａ"
    assert one(spark, text, C.unicode_normalize) == unicodedata.normalize("NFKC", text)
    assert one(spark, "é", lambda c: C.unicode_normalize(c, "NFD", strip_accents=True)) == "e"


ODD_NAMES = [
    "def f1(a1, b2=a3, *c4, **d5):\n    'doc a1'\n    x1 = y2.z3(k4=a1)\n    return f'{x1=} {a1:>{b2}} x1', x1 . real1\n",
    "import m1.n2 as o3\nfrom p4 import q5\nclass C1(B2):\n    'p1' 'q2'\n    def g1(self, v1):\n        global h1\n        h1 = v1 = g1 = self.v1\n",
    "v1 = v2 = 1.e5 + 0x1f + 1if a1 else 2j", "Kz__0__zK = a1", "é1 = a1", "'\\x41' + a1", "a1 = (", "def f1(a1, a1): pass", "f(a1=1, a1=2)",
    "def f1():\n    'only'\n", "match m1:\n    case C1(x1=y1): pass", "# a1\nv1'a1'", "lambda a1: (a1, [b1 for b1 in a1])", "1.a1", "", "async def w1(q1):\n    async with q1 as r1: await r1",
]


def test_facts_of_names_put_back():
    """Facts by the form without names are those of the text as it is."""
    wanted, known = tuple(C.FACTS), {}
    for text in [*ODD_NAMES, *ODD_NAMES]:
        plain = C._raw_facts_of(text, wanted)
        for name, made in C.DIGESTS.items():
            if name in plain:
                plain[name] = made(plain[name].encode()).hexdigest()
        assert C._facts_of(text, wanted, known) == plain, text


def test_programs_that_differ_in_names_are_parsed_once(monkeypatch):
    """The parser keeps every name it has read for good: what a worker holds must not grow with the programs."""
    seen, known, parse = set(), {}, C.ast.parse
    monkeypatch.setattr(C.ast, "parse", lambda text: seen.add(text) or parse(text))
    for n in range(500):
        found = C._facts_of(f"def f{n}(a{n}):\n    return a{n} * 2", ("renamed", "no_docstrings", "structure_sha256"), known)
        assert found["no_docstrings"] == f"def f{n}(a{n}):\n    return a{n} * 2" and "v1 * 2" in found["renamed"]
    assert len(seen) == 1

"""Source code rendered from the orders table: one small program per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelake.session import dealt

RENDER = """
select o_orderkey as submission_id, {fmt}('p%05d', o_custkey % 11) as problem_id,
 replace(case when o_orderkey % 50 = 0 then {fmt}('def f%d(:~    return 1~', o_orderkey)
  else {fmt}('def f%d(a%d):~    # order %s~    if a%d > %d:~        return a%d * %d~    return "p%d"~',
   o_orderkey, o_orderkey, o_orderpriority, o_orderkey, o_custkey % 3,
   o_orderkey, o_custkey % 5, o_custkey % 2) end, '~', chr(10)) as text,
 case when o_orderstatus = 'F' then 'Accepted' else 'Wrong Answer' end as status
from {orders}
"""


def render_sql(orders: str, fmt: str) -> str:
    return RENDER.format(orders=orders, fmt=fmt)


def generated_code(spark: SparkSession, folder: str) -> DataFrame:
    """(submission_id, problem_id, text, status); every fiftieth program cannot be parsed."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    orders = dealt(orders, "o_orderkey")  # rendering and parsing cost far more than reading
    return spark.sql(render_sql("{orders}", "format_string"), orders=orders).withColumn(
        "language", F.lit("Python"))


#: Statements that a program of many shapes has or lacks, by the bits of its customer's number.
SHAPES = (
    "import os.path as p{k}~from math import sqrt, floor as f{k}~",
    "@staticmethod~def d{k}(x, *rest, y=3, **more):~    return [i for i in rest if i != x]~",
    "class C{k}(dict):~    size = {{}}~    def get(self, key):~        try:~            return self[key]~        except KeyError as e:~            raise ValueError(key) from e~",
    "def outer{k}(a):~    def inner(b):~        nonlocal a~        a += b~        return lambda z: z * a~    return inner~",
    "async def wait{k}(q):~    async with q as w:~        await w.done()~",
    "while True:~    for i, j in enumerate(range({k})):~        if i % 2 == 0 and j > 1:~            continue~        else:~            break~    pass~",
    "t{k} = (1, 2.5, -3)~u{k} = f'{{t{k}[0]:>4}} of {{len(t{k})}}'~assert t{k}, 'none'~",
    "with open('f{k}') as h:~    print(*sorted(set(h), key=str.lower), sep='; ')~",
    "del globals()['x{k}']~s{k} = {{x: y for x, y in zip('ab', 'cd')}}~",
)


def shapes_sql(orders: str, fmt: str) -> str:
    """Programs of 512 shapes, from imports and decorators to nested scopes; every fiftieth cannot be parsed."""
    def piece(bit: int, code: str) -> str:
        code = code.replace("'", "''").replace("%", "%%")
        times = code.count("{k}")
        code = code.replace("{{", "{").replace("}}", "}").replace("{k}", "%d")
        return f"case when (o_custkey // {1 << bit}) % 2 = 1 then {fmt}('{code}'{', o_orderkey' * times}) else '' end"

    body = ", ".join(piece(bit, code) for bit, code in enumerate(SHAPES))
    whole = f"""select o_orderkey as submission_id, {fmt}('p%05d', o_custkey % 11) as problem_id,
 replace(concat('last = 0~', {body}, case when o_orderkey % 50 = 0 then 'def (:~' else '' end), '~', chr(10)) as text from {orders}"""
    return whole if fmt == "printf" else whole.replace(" // ", " div ")


def generated_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """(submission_id, problem_id, text) of programs of many shapes."""
    orders = dealt(spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey"), "o_orderkey")
    rendered = shapes_sql("@orders", "format_string").replace("{", "{{").replace("}", "}}")
    return spark.sql(rendered.replace("@orders", "{orders}"), orders=orders)

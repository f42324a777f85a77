"""Pairs mined from the generated programs."""

import ast

from pyspark.sql import functions as F

from codelake.catalog.base import CODE, key_sql, query
from codelake.operators import normalize, pairs, similar
from codelake.session import durable
from codelake.sources.generated import SHAPES, generated_code, generated_shapes

CAP = 250


def slots_sql(name: str, groups: str, by: str, cap: int, seed) -> str:
    """Numbers of the chosen pairs: one draw from each of min(cap, total) equal stretches."""
    return f"""
{name}_m as (select *, least(total, {cap})::BIGINT as m from ({groups}) where total > 0),
{name}_s as (select *, unnest(range(0, m)) as slot from {name}_m),
{name}_e as (select *, slot * (total // m) + (slot * (total % m)) // m as low,
  (slot + 1) * (total // m) + ((slot + 1) * (total % m)) // m as high from {name}_s),
{name} as (select *, low + {key_sql(seed, by, 'slot')} % (high - low) as number from {name}_e)"""


def positions_sql(name: str, rows: str, by: str, seed) -> str:
    return f"""{name} as (select {by}, submission_id, row_number() over (
 partition by {by} order by {key_sql(seed, 'submission_id')}, submission_id) - 1 as pos from {rows})"""


def same_group_sql(name: str, rows: str, by: str, seed) -> str:
    groups = f"select {by}, count(*) as n, count(*)::BIGINT * (count(*) - 1) // 2 as total from {rows} group by {by}"
    return f"""{slots_sql(name + '_n', groups, by, CAP, seed)}, {positions_sql(name + '_p', rows, by, seed)},
{name} as (select c.{by}, least(a.submission_id, b.submission_id) as id1, greatest(a.submission_id, b.submission_id) as id2
 from {name}_n c join {name}_p a on a.{by} = c.{by} and a.pos = number % n
 join {name}_p b on b.{by} = c.{by} and b.pos = (number % n + number // n + 1) % n)"""


POSITIVE = same_group_sql("positive", "code", "problem_id", 42)


@query("join1_positive_pairs", f"with {CODE}, {POSITIVE} select problem_id, id1, id2 from positive")
def positive_pairs(spark, folder):
    return pairs.positive_pairs(generated_code(spark, folder), "submission_id", CAP)


NEGATIVE = f"""
placed as (select submission_id, problem_id, row_number() over (
 order by {key_sql('42:position', 'submission_id')}, submission_id) - 1 as pos from code),
need as (select floor(count(*) * 0.8::DOUBLE)::BIGINT as need, (select count(*) from code) as total from positive),
slots as (select unnest(range(0, (select 3 * need + 1000 from need))) as slot),
draws as (select slot, {key_sql('42:a', 'slot')} % total as i, {key_sql('42:b', 'slot')} % total as j from slots, need),
negative as (select slot, a.submission_id as id1, b.submission_id as id2, a.problem_id as problem1, b.problem_id as problem2
 from draws join placed a on a.pos = i join placed b on b.pos = j where a.problem_id <> b.problem_id
 order by slot limit (select need from need))"""


@query("join2_negative_pairs", f"with {CODE}, {POSITIVE}, {NEGATIVE} select slot, problem1, problem2, id1, id2 from negative")
def negative_pairs(spark, folder):
    return pairs.negative_pairs(generated_code(spark, folder), "submission_id", CAP, 0.8)


@query("join1_join2_build_pairs", f"""
with {CODE}, {POSITIVE}, {NEGATIVE},
ids as (select id1, id2, 1 as s from positive union all select id1, id2, 0 from negative)
select i.id1, i.id2, s as "similar", a.text as code1, b.text as code2 from ids i
join code a on a.submission_id = id1 join code b on b.submission_id = id2""")
def build_pairs(spark, folder):
    code = generated_code(spark, folder)
    return pairs.attach_code(pairs.build_pairs(code, "submission_id", CAP, 0.8), code, "submission_id", "text")


HARD = f"""
accepted as (select * from code where status = 'Accepted'), wrong as (select * from code where status = 'Wrong Answer'),
{slots_sql('hard_n', '''select a.problem_id, n_right, n_left * n_right as total from
 (select problem_id, count(*) as n_left from accepted group by problem_id) a join
 (select problem_id, count(*) as n_right from wrong group by problem_id) b on a.problem_id = b.problem_id''',
 'problem_id', CAP, '42:h')},
{positions_sql('hard_a', 'accepted', 'problem_id', '42:h')}, {positions_sql('hard_b', 'wrong', 'problem_id', '42:h')},
hard as (select a.submission_id as id1, b.submission_id as id2 from hard_n c
 join hard_a a on a.problem_id = c.problem_id and a.pos = number // n_right
 join hard_b b on b.problem_id = c.problem_id and b.pos = number % n_right)"""


@query("join9_mine_pairs_by_status", f"""
with {CODE}, {HARD}, {same_group_sql('same', 'accepted', 'problem_id', '42:p')}
select id1, id2, 'positive' as pair_type from same union all select id1, id2, 'hard_negative' from hard""")
def mine_pairs_by_status(spark, folder):
    code = generated_code(spark, folder).withColumn("structure_sha256", F.lit(None).cast("string"))
    return pairs.mine_pairs(code, "submission_id", CAP)


# The constants of a generated program decide its structure; unparseable ones have none.
FIRSTS = """shaped as (select c.submission_id, problem_id, o_custkey % 3 as a, o_custkey % 5 as b, o_custkey % 2 as d
 from code c join orders o on o_orderkey = c.submission_id where o_orderkey % 50 <> 0),
firsts as (select a, b, d, problem_id, min(submission_id) as id from shaped group by all)"""


@query("join9_structures_across_problems", f"""
with {CODE}, {FIRSTS}
select a.problem_id as problem1, b.problem_id as problem2, a.id as id1, b.id as id2 from firsts a join firsts b
on a.a = b.a and a.b = b.b and a.d = b.d and a.id < b.id""")
def structures_across_problems(spark, folder):
    code = normalize.with_facts(generated_code(spark, folder), "structure_sha256").where(
        "structure_sha256 IS NOT NULL")
    firsts = durable(code.groupBy("structure_sha256", "problem_id").agg(F.min("submission_id").alias("submission_id")))
    # eleven problems share a structure at most: the cap is never reached, so all pairs come out
    mined = pairs.positive_pairs(firsts, "submission_id", CAP, "42:s", by="structure_sha256")
    names = firsts.select("submission_id", "problem_id")
    return mined.join(names.toDF("id1", "problem1"), "id1").join(names.toDF("id2", "problem2"), "id2").select(
        "problem1", "problem2", "id1", "id2")


@query("join9_mine_pairs", f"""
with {CODE}, {HARD}, {same_group_sql('same', 'accepted', 'problem_id', '42:p')}, {FIRSTS}
select id1, id2, 'positive' as pair_type from same union all select id1, id2, 'hard_negative' from hard
union all select a.id, b.id, 'semi_hard_negative' from firsts a join firsts b
 on a.a = b.a and a.b = b.b and a.d = b.d and a.id < b.id""")
def mine_pairs(spark, folder):
    code = normalize.with_facts(generated_code(spark, folder), "structure_sha256")
    return pairs.mine_pairs(code, "submission_id", CAP)


def gram_names(code: str) -> str:
    """The node-type n-grams of one statement of the generated shapes, as a list for SQL."""
    found, todo = set(), [(ast.parse(code.replace("~", "\n").format(k=1)), "", "")]
    while todo:
        node, parent, grandparent = todo.pop()
        name = type(node).__name__
        found.add(f"{name}<{parent}<{grandparent}")
        todo += [(child, name, parent) for child in ast.iter_child_nodes(node)]
    return "[" + ",".join(f"'{g}'" for g in sorted(found)) + "]"


# All pairs of shapes are compared here: a shape's n-grams are those of its statements.
ALL_SHAPES = f"""shapes as (select o_orderkey as id, o_custkey % {1 << len(SHAPES)} as shape, o_custkey % 11 as problem from orders where o_orderkey % 50 <> 0),
kinds as (select shape, min(id) as id, count(*) as members from shapes group by shape),
grams as (select *, list_distinct(flatten([{gram_names('last = 0~')},
 {', '.join(f'case when (shape // {1 << bit}) % 2 = 1 then {gram_names(code)} else [] end' for bit, code in enumerate(SHAPES))}])) as grams from kinds),
sets as (select list_sort(grams) as grams, min(id) as id, sum(members)::BIGINT as members from grams group by 1)"""


@query("join9_similar_structures", f"""
with {ALL_SHAPES}, met as (select a.id as x, b.id as y, a.members as m, b.members as n, len(list_intersect(a.grams, b.grams)) as shared,
 len(a.grams) + len(b.grams) as sizes from sets a join sets b on a.id < b.id)
select x as id1, y as id2, m as members1, n as members2, shared::INTEGER as shared, (sizes - shared)::INTEGER as total from met
where shared >= (sizes - shared) * 0.8::DOUBLE""")
def similar_structures(spark, folder):
    shapes, _ = similar.structures(generated_shapes(spark, folder), "submission_id")
    found = similar.similar_structures(shapes)
    names = shapes.select("structure", "first", "members")
    for side in ("1", "2"):
        found = found.join(names.toDF(f"structure{side}", f"first{side}", f"_members{side}"), f"structure{side}")
    swap = F.col("first1") > F.col("first2")
    return found.select(
        F.least("first1", "first2").alias("id1"), F.greatest("first1", "first2").alias("id2"),
        F.when(swap, F.col("_members2")).otherwise(F.col("_members1")).alias("members1"),
        F.when(swap, F.col("_members1")).otherwise(F.col("_members2")).alias("members2"), "shared", "total")


@query("join9_similar_members", f"""
with {ALL_SHAPES} select s.id as submission_id, 'p' || lpad(s.problem::VARCHAR, 5, '0') as problem_id, t.id as first
from shapes s join grams g on g.shape = s.shape join sets t on t.grams = list_sort(g.grams)""")
def similar_members(spark, folder):
    """Every program that parses, with the first one of its structure: no structure loses rows."""
    shapes, members = similar.structures(generated_shapes(spark, folder), "submission_id")
    return members.join(shapes.select("structure", "first"), "structure").select("submission_id", "problem_id", "first")


@query("join9_similar_pairs")
def similar_program_pairs(spark, folder):
    shapes, members = similar.structures(generated_shapes(spark, folder), "submission_id")
    return similar.similar_pairs(similar.similar_structures(shapes), members, "submission_id")

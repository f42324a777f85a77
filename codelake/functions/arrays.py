"""Token sequences: truncation, pair layout, padding, masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codelake.functions.keys import draw_digest, draw_word

IGNORE = -100


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def truncate(ids, length, side: str = "right") -> Column:
    """At most ``length`` ids; ``left`` truncation keeps the tail."""
    ids, length = _col(ids), length if isinstance(length, Column) else F.lit(length)
    kept = F.least(length, F.size(ids))
    start = F.lit(1) if side == "right" else F.size(ids) - kept + 1
    return F.slice(ids, start, kept)


def encode_single(ids, max_len: int, cls: int | None = None, sep: int | None = None, side: str = "right") -> Column:
    """ENC-1: truncated ids, between two special ids when they are given."""
    if cls is None:
        return truncate(ids, max_len, side)
    return F.concat(F.array(F.lit(cls)), truncate(ids, max_len - 2, side), F.array(F.lit(sep)))


def pair_budget(size_a: Column, size_b: Column, budget: int) -> tuple[Column, Column]:
    """Room for both sides: the shorter keeps up to half, the other takes what is left."""
    half = budget // 2
    a_short = size_a <= size_b
    shorter = F.least(F.least(size_a, size_b), F.lit(half))
    keep_a = F.when(size_a + size_b <= budget, size_a).when(a_short, shorter).otherwise(budget - shorter)
    keep_b = F.when(size_a + size_b <= budget, size_b).when(a_short, budget - shorter).otherwise(shorter)
    return keep_a, keep_b


def encode_pair(
    a, b, max_len: int, specials: tuple[int, ...] = (), side: str = "right", strategy: str = "longest_first"
) -> tuple[Column, Column]:
    """ENC-2: (input ids, segment ids) of two sequences.

    ``specials`` is empty (no separators), (cls, sep) for ``cls a sep b sep``, or
    (cls, sep, sep2) for ``cls a sep sep2 b sep``. ``cut_right`` joins both sides
    whole and cuts the result; ``longest_first`` shares the room between them.
    """
    a, b = _col(a), _col(b)
    if strategy == "longest_first":
        keep_a, keep_b = pair_budget(F.size(a), F.size(b), max_len - (len(specials) + 1 if specials else 0))
        a, b = truncate(a, keep_a, side), truncate(b, keep_b, side)

    def fixed(*ids):
        return F.array(*[F.lit(i) for i in ids]) if ids else F.array().cast("array<int>")

    head = fixed(*specials[:1])
    middle = fixed(*specials[1:])
    tail = fixed(*specials[1:2])
    first, second = F.concat(head, a, middle), F.concat(b, tail)
    ids = F.concat(first, second)
    segments = F.concat(F.array_repeat(F.lit(0), F.size(first)), F.array_repeat(F.lit(1), F.size(second)))
    if strategy == "cut_right":
        ids, segments = truncate(ids, max_len), truncate(segments, max_len)
    return ids, segments


def round_up(size: Column, step: int = 8) -> Column:
    return (F.ceil(size / step) * step).cast("int")


def pad(ids, length, value: int = 0) -> Column:
    """ENC-3: fill with ``value`` up to ``length``; never cuts."""
    ids, length = _col(ids), length if isinstance(length, Column) else F.lit(length)
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(length - F.size(ids), F.lit(0))))


def attention_mask(ids, pad_id: int = 0) -> Column:
    return F.transform(_col(ids), lambda x: (x != pad_id).cast("int"))


SHARE_UNIT = 2**32


def mask_mlm(ids, seed, key, vocab_size: int, mask_id: int, protected: tuple[int, ...], p: float = 0.15) -> Column:
    """ENC-4: struct array (input, label): 80% mask, 10% random, 10% unchanged among the chosen.

    ``protected`` ids are never chosen: only the pad id in one rule, all special ids
    in the other. Labels are -100 where nothing was chosen.
    """
    def share(x):
        return int(round(x * SHARE_UNIT))

    def drawn(x, i):
        return F.struct(x.alias("x"), draw_digest(seed, _col(key), i).alias("digest"))

    def outcome(t):
        choose, how, which = (draw_word(t["digest"], place) for place in range(3))
        chosen = ~t["x"].isin(*protected) & (choose < share(p))
        random_id = F.pmod(which, F.lit(vocab_size)).cast("int")
        replaced = F.when(how < share(0.8), F.lit(mask_id)).when(how < share(0.9), random_id)
        return F.struct(
            F.when(chosen, F.coalesce(replaced, t["x"])).otherwise(t["x"]).alias("input"),
            F.when(chosen, t["x"]).otherwise(F.lit(IGNORE)).alias("label"))

    return F.transform(F.transform(_col(ids), drawn), outcome)


def rtd_labels(original, replaced, attention, specials: tuple[int, ...]) -> Column:
    """ENC-5: 1 where an id was replaced, -100 at padding and special ids."""
    changed = F.zip_with(_col(original), _col(replaced), lambda o, r: F.when(
        o.isin(*specials), F.lit(IGNORE)).otherwise((o != r).cast("int")))
    return F.zip_with(changed, _col(attention), lambda c, m: F.when(m == 0, F.lit(IGNORE)).otherwise(c))


def role_labels(roles, inputs, pad_id: int = 0) -> Column:
    """ENC-6: roles of the unmasked tokens, -100 at padding."""
    return F.zip_with(_col(roles), _col(inputs), lambda r, x: F.when(x == pad_id, F.lit(IGNORE)).otherwise(r))

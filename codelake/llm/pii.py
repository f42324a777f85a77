"""Personal data: fixed rules, and bootstrapped contexts that discover what the rules miss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import stored
from codelake.llm.line_rules import bound

#: Kinds in the order of the digest.
KINDS = ("email", "ip", "card", "phone")
#: The same matches as the rules' plain patterns, leftmost and greedy, but without trying a run's later characters once
#: its first has failed: a match begins at the start of its run or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a pattern to be tried.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: A word of another kind of identifier: four digits or more, or an @.
CANDIDATE = r"(?<![^\x20\x09-\x0D])(?:(?=(?:[^0-9\x20\x09-\x0D]*+[0-9]){4})|(?=[^@\x20\x09-\x0D]*+@))[^\x20\x09-\x0D]++"
#: What of a text before an entity has its last two words: these, and what directly precedes the entity.
LAST = r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){0,2}[^\x20\x09-\x0D]*+$"
#: The first word after what directly follows an entity.
NEXT = r"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)"
#: Rounds of scoring; confidence and distinct instances that a pattern must reach.
ROUNDS, CONFIDENCE, SUPPORT = 3, 0.6, 5
#: Starts are summed in blocks of this many matches.
BLOCK = 64
#: Kinds of patterns: two words before, one before, one after, and the shape of the instance itself.
TWO, BEFORE, AFTER, SHAPE = "two", "before", "after", "shape"
#: Views of an instance that are judged by one another.
VIEWS = {"left": (TWO, BEFORE), "right": (AFTER,), "form": (SHAPE,)}
SPANS = "array<struct<start:int,end:int,match:string,context:string,after:string>>"


def context_of(last: Column) -> Column:
    """The last two words of a text as a pattern; empty if there are fewer."""
    words = F.filter(F.split(F.lower(last), r"[\x20\x09-\x0D]+", -1), lambda w: w != F.lit(""))
    return bound(words, lambda w: F.when(F.size(w) >= 2, F.concat_ws(" ", F.slice(w, -2, 2))).otherwise(F.lit("")))


def sums_before(sizes: Column) -> Column:
    """For each entry of an array of whole numbers, the sum of those before it, summed within blocks and over blocks."""
    none = F.array().cast("array<int>")

    def running(values):
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(values, start, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def by_blocks(values):
        count = F.ceil(F.size(values) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
        return bound(blocks, lambda parts: bound(
            running(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))),
            lambda leads: F.flatten(F.transform(parts, lambda p, b: F.transform(running(p), lambda x: x + F.get(leads, b))))))

    return bound(sizes, lambda v: F.when(F.size(v) == 0, none).when(F.size(v) <= BLOCK, running(v)).otherwise(by_blocks(v)))


def found(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, context, after) of a pattern's matches, in code points, end exclusive.

    The context is the two words before the match, ``after`` the word after it, both read up to two matches away.
    Identifiers in them, which differ each time, stand as ``@``.
    """
    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))

    def near(array, i):
        return F.coalesce(F.get(array, i), F.lit(""))

    def spans(b):
        gaps, hits = b["gaps"], b["hits"]
        steps = F.transform(hits, lambda hit, i: F.length(F.get(gaps, i)) + F.length(hit))

        def entry(lead, i):
            hit, gap = F.get(hits, i), F.get(gaps, i)
            before = F.concat(near(hits, i - 2), near(gaps, i - 1), near(hits, i - 1), gap)
            before = F.regexp_replace(F.regexp_extract(before, LAST, 0), CANDIDATE, "@")
            after = F.regexp_extract(F.concat(near(gaps, i + 1), near(hits, i + 1), near(gaps, i + 2)), NEXT, 1)
            start = lead + F.length(gap)
            return F.struct(
                start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("match"), context_of(before).alias("context"),
                F.regexp_replace(F.lower(after), CANDIDATE, "@").alias("after"))

        return F.when(F.size(hits) > 0, F.transform(sums_before(steps), entry)).otherwise(F.array().cast(SPANS))

    return bound(both, spans)


def luhn(number: Column) -> Column:
    """Whether the digits of a card number add up: from the right, every second one doubled, its digits summed."""
    places = F.sequence(F.lit(1), F.length(number))

    def worth(i):
        digit = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(double - F.when(double > 9, F.lit(9)).otherwise(F.lit(0)))

    return F.aggregate(places, F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def entities(text: Column, kind: str) -> Column:
    gate = F.contains(text, F.lit(GATES[kind])) if kind == "email" else text.rlike(GATES[kind])
    none = F.array().cast(SPANS)
    return F.when(gate, F.filter(found(text, PATTERNS[kind]), lambda s: valid(kind, s["match"]))).otherwise(none)


def read(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document without its text: the spans of each kind, and candidate words outside of them."""
    body = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    base = body.select("doc_id", "body", *[entities(F.col("body"), k).alias(k) for k in KINDS])
    words = F.when(F.col("body").rlike("[0-9@]"), found(F.col("body"), CANDIDATE)).otherwise(F.array().cast(SPANS))
    free = F.filter("words", lambda w: ~F.greatest(*[touched(F.col(k), w) for k in KINDS]))
    return base.select("doc_id", *KINDS, words.alias("words")).select("doc_id", *KINDS, free.alias("other"))


def touched(spans: Column, word: Column) -> Column:
    """Whether a span of one kind, which are in order and apart, overlaps a word: the last that starts before its end, found by halving."""
    steps = F.sequence(F.ceil(F.log2(F.size(spans))).cast("int"), F.lit(0), F.lit(-1))

    def further(at, k):
        there = at + F.pow(F.lit(2), k).cast("int")
        return F.when((there < F.size(spans)) & (F.get(spans, there)["start"] < word["end"]), there).otherwise(at)

    last = F.aggregate(steps, F.lit(-1), further, lambda at: F.coalesce(F.get(spans, F.when(at >= 0, at))["end"] > word["start"], F.lit(False)))
    return F.when(F.size(spans) > 0, last).otherwise(F.lit(False))


def shape_of(match: Column) -> Column:
    """The kinds of characters in an instance (letters, capitals, digits, each mark) and its length, end marks left out."""
    core = F.regexp_replace(match, r"[.,;:!?)]+$", "")
    signs = F.regexp_replace(F.regexp_replace(core, "[0-9]", "0"), r"\p{Lu}", "A")
    return F.concat_ws(" ", F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace(signs, r"\p{Ll}", "a"), ""))), ""), F.length(core).cast("string"))


def patterns_of(span: Column) -> Column:
    """The patterns that an instance stands in, as (kind, pattern); without a word on a side, there is none for it."""
    one = F.substring_index(span["context"], " ", -1)
    all_four = F.array(*[F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(kind + " "), word).alias("pattern"), (word != "").alias("there"))
                         for kind, word in ((TWO, span["context"]), (BEFORE, one), (AFTER, span["after"]), (SHAPE, shape_of(span["match"])))])
    return F.filter(all_four, lambda p: p["there"])


def edges(known: DataFrame) -> DataFrame:
    """Distinct (pattern, kind, instance, seed): which patterns met which entities; an entity found by a rule is a seed."""
    seeds = known.select(F.explode(F.concat(*KINDS)).alias("s"), F.lit(True).alias("seed"))
    others = known.select(F.explode("other").alias("s"), F.lit(False).alias("seed"))
    each = seeds.unionAll(others).select(F.xxhash64("s.match").alias("instance"), "seed", F.explode(patterns_of(F.col("s"))).alias("p"))
    return each.groupBy(F.col("p.pattern").alias("pattern"), F.col("p.kind").alias("kind"), "instance").agg(F.bool_or("seed").alias("seed"))


def judged(links: DataFrame, scores: DataFrame | None, support: int) -> DataFrame:
    """pattern, kind, confidence: one round. Without ``scores`` only seeds count.

    An instance that is no seed is judged by the best pattern of the other views (words before, word after, shape),
    so that no pattern backs itself. What no such pattern knows counts as 0 where a pattern has two seeds, and not at
    all where it has fewer; a pattern with fewer than ``support`` instances, or two known ones, has no confidence.
    """
    evidence = F.when(F.col("seed"), F.lit(1.0))
    if scores is not None:
        view = {v: F.max(F.when(F.col("kind").isin(*kinds), F.col("confidence"))) for v, kinds in VIEWS.items()}
        views = links.join(scores.select("pattern", "confidence"), "pattern").groupBy("instance").agg(*[m.alias(v) for v, m in view.items()])
        links = links.join(views, "instance", "left")
        others = [F.when(~F.col("kind").isin(*kinds), F.col(v)) for v, kinds in VIEWS.items()]
        evidence = evidence.otherwise(F.greatest(*others))
    met = links.groupBy("pattern", "kind").agg(
        F.count("*").alias("instances"), F.sum(F.col("seed").cast("int")).alias("seeds"), F.count(evidence).alias("known"), F.sum(evidence).alias("total"))
    return met.where((F.col("instances") >= support) & (F.col("known") >= 2)).select(
        "pattern", "kind", (F.col("total") / F.when(F.col("seeds") >= 2, F.col("instances")).otherwise(F.col("known"))).alias("confidence"))


def confident_patterns(links: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """Patterns worth trusting, by rounds over the graph of patterns and instances: see :func:`judged`.

    After ``rounds`` rounds the instances that trusted patterns point to (see :func:`pointed`) are believed as seeds are,
    and all begins again, until no further pattern is trusted: a context without any seed is reached through
    instances that it shares, or through their shape.
    """
    links = stored(links, "pii-links")
    believed, many = links, 0
    while True:
        scores = stored(judged(believed, None, support), "pii-scores")
        for _ in range(rounds):
            scores = stored(judged(believed, scores, support), "pii-scores")
        trusted = stored(scores.where(F.col("confidence") >= confidence).select("pattern"), "pii-trusted-patterns")
        found = trusted.count()
        if found <= many:
            return trusted
        many = found
        shared = pointed(links.join(trusted, "pattern", "left_semi"), "instance").withColumn("shared", F.lit(True))
        believed = stored(links.join(shared, "instance", "left").select(
            "pattern", "kind", "instance", (F.col("seed") | F.coalesce("shared", F.lit(False))).alias("seed")), "pii-believed")


def pointed(links: DataFrame, *names: str) -> DataFrame:
    """What enough trusted patterns point to: the two words before, or two of the word before, the word after and the shape."""
    kinds = links.groupBy(*names).agg(*[F.max((F.col("kind") == k).cast("int")).alias(f"by_{k}") for k in (TWO, BEFORE, AFTER, SHAPE)])
    enough = (F.col(f"by_{TWO}") == 1) | (F.col(f"by_{BEFORE}") + F.col(f"by_{AFTER}") + F.col(f"by_{SHAPE}") >= 2)
    return kinds.where(enough).select(*names)


def spelled(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the spans of each kind by the rules, and ``found``: words that high-confidence patterns point to.

    The rules' spans are seeds, whatever their kind. Lexical patterns are the two words before an instance, the word before,
    the word after and the instance's shape; patterns and the entities they met form a graph whose scores go back and
    forth a few rounds on aggregated rows. A word with four digits or an @ is added as kind ``found`` if its two words
    before are trusted, or two of the three other patterns; the rules' spans stay as they are. Each text is read once: all
    rounds run on a stored table of spans. A pattern that a third of all entities have is summed before its shuffle.

    Null counts as empty: no spans. Keys may be null or repeat; repeated rows get equal answers. A text's matches are
    placed by sums over blocks of ``BLOCK``, so a text with many thousands of them takes little more than its share. An
    empty table gives an empty result.
    """
    known = stored(read(docs, key, text).withColumn("row_no", F.monotonically_increasing_id()), "pii-read")
    trusted = stored(confident_patterns(edges(known)), "pii-trusted")
    words = known.select("row_no", F.explode("other").alias("s")).select("row_no", "s", F.explode(patterns_of(F.col("s"))).alias("p"))
    kept = pointed(words.select("row_no", "s", "p.kind", "p.pattern").join(trusted, "pattern", "left_semi"), "row_no", "s")
    hits = kept.groupBy("row_no").agg(F.sort_array(F.collect_list("s")).alias("found"))
    return known.join(hits, "row_no", "left").select(
        "doc_id", *KINDS, F.coalesce("found", F.array().cast(SPANS)).alias("found"))


def span_texts(spans: DataFrame) -> DataFrame:
    """Counts of the rules' spans by kind, the SHA-256 of their spelling, and all spans spelled kind:start:end."""
    base = F.concat(*[spelled(k, F.col(k)) for k in KINDS])
    return spans.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat(base, spelled("found", F.col("found")))).alias("spans"))

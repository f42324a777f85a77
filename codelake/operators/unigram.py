"""VOC-4: unigram vocabularies by expectation maximisation over word counts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.operators.ranking import position, take_first, with_quantile_bucket
from codelake.operators.skew import lookup_join
from codelake.operators.vocab import each_word_once, held
from codelake.session import durable, shuffles_freed, small_batches

SHRINK = 0.75
TOP_WEIGHT = 65535
SPARE = 1.1
UNKNOWN_PENALTY = 10.0
#: The score of a span that is no piece, and how many spans a task weighs at a time.
NONE, BLOCK = -1e30, 500_000
#: Bits of a code point, the low ones of a key (node, next character).
CHAR_BITS = 21
#: Pieces that tasks hold to count longer ones, different sums that a task holds, and ranges by which sums are added up for each task that makes them.
MOST_NODES, HELD_SUMS, RANGES = 16_000_000, 2_000_000, 16
#: Characters of a task, where there are more than this for each core.
TASK_CHARS = 1 << 27


def capped_vocab_size(vocab_size: int, n_texts: int) -> int:
    """An optional cap by the corpus: half the texts, at least 200, never above 2000."""
    return min(vocab_size, max(n_texts // 2, 200), 2000)


def substrings(counts: DataFrame, max_piece_length: int, heaviest: int | None = None) -> DataFrame:
    """(piece, freq): how often each substring of up to ``max_piece_length`` characters occurs.

    A row per place in a word, with what stands there; equal ones are summed before a row per length is made of
    them. No array of a word's substrings is built. With ``heaviest``, the longer ones are those that occur twice and are no
    lighter, by length x frequency, than the heaviest so many, of which :func:`heavy_substrings` shuffles little.
    """
    if heaviest is not None:
        found = heavy_substrings(counts, max_piece_length, heaviest)
        if found is not None:
            return found
    size = F.length("word")
    places = counts.where(size > 0).select("freq", "word", F.explode(F.sequence(F.lit(1), size)).alias("at"))
    stretches = places.select("freq", F.substr("word", "at", F.lit(max_piece_length)).alias("stretch")).groupBy("stretch").agg(F.sum("freq").alias("freq"))
    lengths = F.explode(F.sequence(F.lit(1), F.length("stretch"))).alias("n")
    return stretches.select("freq", "stretch", lengths).select("freq", F.left("stretch", "n").alias("piece")).groupBy("piece").agg(F.sum("freq").alias("freq"))


def heavy_substrings(counts: DataFrame, longest: int, heaviest: int) -> DataFrame | None:
    """:func:`substrings` cut at a weight; none if tasks cannot hold the pieces that may be above it.

    A substring occurs no more often than the parts of it, and weighs ``longest`` times its frequency at most. So lengths are counted
    one after another, each time only where both parts shorter by one occur often enough to be, or to be in, one of the heaviest:
    as often as the lightest of the heaviest counted so far asks for. ``counts`` is read once for each length.
    """
    steps, freqs, weights, least = [], [], np.zeros(0, np.int64), 1
    ranges = RANGES * counts.rdd.getNumPartitions()
    while len(steps) < longest:
        grown = _children(counts, steps, least, MOST_NODES - sum(map(len, steps)), ranges)
        if grown is None:
            return None
        keys, freq = grown
        if steps:
            weights = np.sort(np.concatenate([weights, freq * (len(steps) + 1)]))
            weights = weights[max(len(weights) - heaviest, 0):]
        least = 2
        if len(weights) == heaviest > 0:
            least = max(least, -(-int(weights[0]) // longest))
        kept = (freq >= least) | (not steps)
        if not kept.any():
            break
        steps.append(keys[kept])
        freqs.append(freq[kept])
    lightest = int(weights[0]) if len(weights) == heaviest > 0 else 0
    pieces, found = [], []
    for length, freq in enumerate(freqs, 1):
        nodes = np.flatnonzero((freq * length >= lightest) | (length == 1))
        pieces += _spelled(steps[:length], nodes)
        found.append(freq[nodes])
    table = pd.DataFrame({"piece": pieces, "freq": np.concatenate(found or [weights])})
    return counts.sparkSession.createDataFrame(table, "piece string, freq long")


def _spelled(steps: list[np.ndarray], nodes: np.ndarray) -> list[str]:
    """The pieces that end at nodes of the last of ``steps``."""
    chars = np.empty((len(nodes), len(steps)), np.uint32)
    for depth in range(len(steps) - 1, -1, -1):
        keys = steps[depth][nodes]
        chars[:, depth], nodes = keys & (1 << CHAR_BITS) - 1, keys >> CHAR_BITS
    text, length = chars.tobytes().decode("utf-32-le", "surrogatepass"), len(steps)
    return [text[i:i + length] for i in range(0, len(text), length)]


def _reached(steps: list[np.ndarray], chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, node) of the places where a piece as long as ``steps`` stands; ``left`` characters of its word stand at each place."""
    at, node = np.flatnonzero(left[:max(len(left) - len(steps) + 1, 0)] >= max(len(steps), 1)), 0
    for depth, keys in enumerate(steps):
        wanted = node << CHAR_BITS | chars[at + depth]
        node = _numbers(keys, wanted)
        live = node >= 0
        at, node = at[live], node[live]
    return at, node


def _numbers(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted one in sorted keys, -1 if none; looked up in order, which takes a fraction of the time in many keys."""
    order = np.argsort(wanted)
    wanted, found = wanted[order], np.empty(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found[order] = np.where(keys[at] == wanted, at, -1)
    return found


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def _children(counts: DataFrame, steps: list[np.ndarray], least: int, most: int, ranges: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(key, freq) by key of the pieces longer by one than ``steps`` that occur ``least`` times; none if there are more than ``most``.

    ``steps`` are as in :func:`trie_of`. Only pieces are counted whose parts shorter by one are both there; sums meet by ``ranges`` of nodes.
    """
    sent, depth, nodes = counts.sparkSession.sparkContext.broadcast(steps), len(steps), len(steps[-1]) if steps else 1
    edges = np.unique(np.arange(1, ranges) * nodes // ranges) << CHAR_BITS

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, parts, size = sent.value, [], 0
        for batch in batches:
            words = batch["word"].tolist()
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            chars, freq = code_points(words), np.repeat(batch["freq"].to_numpy(np.int64), sizes)
            left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(chars))
            for start in range(0, len(chars), BLOCK):
                block = slice(start, start + BLOCK + depth + 1)
                at, node = _reached(steps, chars[block], left[block])
                if depth:
                    whole = left[block][at] > depth
                    # the next place is there too, as long as it is the next one of those found
                    whole[:-1] &= at[1:] == at[:-1] + 1
                    whole[-1:] = False
                    at, node = at[whole], node[whole]
                inside = at < BLOCK
                at, node = at[inside], node[inside] if depth else 0
                parts.append(_summed([(node << CHAR_BITS | chars[block][at + depth], freq[block][at])]))
                size += len(parts[-1][0])
            if size > 2 * HELD_SUMS:
                parts = [_summed(parts)]
                size = len(parts[0][0])
                if size > HELD_SUMS:
                    yield packed(*parts.pop())
                    size = 0
        if parts:
            yield packed(*_summed(parts))

    def packed(keys: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        """A row per range of nodes that has keys: the steps from key to key, and the sums."""
        ends = np.searchsorted(keys, np.append(edges, np.iinfo(np.int64).max))
        cuts = [(i, start, end) for i, (start, end) in enumerate(zip([0, *ends], ends)) if start < end]
        rows = [(i, np.diff(keys[start:end], prepend=0).tobytes(), n[start:end].tobytes()) for i, start, end in cuts]
        return pd.DataFrame(rows, columns=["range", "keys", "n"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        keys, n = _summed([(np.cumsum(np.frombuffer(k, np.int64)), np.frombuffer(m, np.int64)) for k, m in zip(rows["keys"], rows["n"])])
        return pd.DataFrame({"key": keys[n >= least], "n": n[n >= least]})

    parts = counts.select("word", "freq").mapInPandas(partial, "range int, keys binary, n binary")
    found = parts.groupBy("range").applyInPandas(total, "key long, n long").limit(most + 1).toArrow()
    sent.destroy()
    if len(found) > most:
        return None
    keys, freq = found["key"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], freq[order]


def seed_pieces(counts: DataFrame, max_piece_length: int, seed_size: int) -> DataFrame:
    """(piece, weight): all characters, and the heaviest repeated substrings by length x frequency."""
    found = durable(substrings(counts, max_piece_length, seed_size).where((F.col("freq") >= 2) | (F.length("piece") == 1)))
    length = F.length("piece")
    single = found.where(length == 1).select("piece", F.col("freq").cast("double").alias("weight"))
    longer = (
        found.where((length > 1) & (F.col("freq") >= 2))
        .select("piece", (F.col("freq") * length).alias("weight"))
    )
    # the cut falls among heavy pieces, where few share a weight
    order, bucket = [-F.col("weight"), F.col("piece")], -F.least(F.col("weight"), F.lit(TOP_WEIGHT))
    heaviest = take_first(longer, order, bucket, lambda total: seed_size)
    return single.unionByName(heaviest.withColumn("weight", F.col("weight").cast("double")))


def _arcs(word: str, logp: dict, longest: int, floor: float):
    """(start, end, score) of every known piece in the word; unknown characters at a penalty."""
    for start in range(len(word)):
        for end in range(start + 1, min(len(word), start + longest) + 1):
            score = logp.get(word[start:end])
            if score is not None:
                yield start, end, score
            elif end == start + 1:
                yield start, end, floor


def best_path(word: str, logp: dict, longest: int, floor: float, without: str | None = None) -> list[str]:
    """The likeliest segmentation, optionally not using one piece."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for start, end, score in _arcs(word, logp, longest, floor):
        if word[start:end] != without and best[start][0] + score > best[end][0]:
            best[end] = (best[start][0] + score, start)
    if best[-1][0] == -math.inf:
        return []
    cuts = [len(word)]
    while cuts[-1]:
        cuts.append(best[cuts[-1]][1])
    return [word[a:b] for b, a in zip(cuts, cuts[1:])][::-1]


def _log_add(a: float, b: float) -> float:
    high, low = max(a, b), min(a, b)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def expected_uses(word: str, logp: dict, longest: int, floor: float) -> Iterator[tuple[str, float]]:
    """Expected number of uses of each piece over all segmentations of a word."""
    arcs = list(_arcs(word, logp, longest, floor))
    before = [0.0] + [-math.inf] * len(word)
    after = [-math.inf] * len(word) + [0.0]
    for start, end, score in arcs:
        before[end] = _log_add(before[end], before[start] + score)
    for start, end, score in reversed(arcs):
        after[start] = _log_add(after[start], after[end] + score)
    for start, end, score in arcs:
        yield word[start:end], math.exp(before[start] + score + after[end] - before[-1])


def _piece_sums(counts: DataFrame, uses) -> dict[str, float]:
    """Sum ``uses(word)`` weighted by frequency: partial sums per task, then one shuffle.

    The result has at most as many rows as the vocabulary being trained.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = Counter()
            for word, freq in zip(batch["word"], batch["freq"]):
                for piece, n in uses(word):
                    sums[piece] += n * freq
            yield pd.DataFrame({"piece": list(sums), "n": [float(n) for n in sums.values()]})

    parts = counts.select("word", "freq").mapInPandas(partial, "piece string, n double")
    return {row.piece: row.n for row in parts.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def _digamma(x: float) -> float:
    shift = 0.0
    while x < 7:
        shift -= 1 / x
        x += 1
    x -= 0.5
    inverse = 1 / (x * x)
    return shift + math.log(x) + inverse * (1 / 24 - inverse * (7 / 960 - inverse * 31 / 8064))


def _floor(logp: dict) -> float:
    return min(logp.values()) - UNKNOWN_PENALTY


def maximise(counts: DataFrame, logp: dict) -> dict:
    """One round with a model that tasks can hold: expected uses, drop pieces used less than half a time, new log probabilities."""
    longest, floor = max(map(len, logp)), _floor(logp)
    sums = _piece_sums(counts, lambda word: expected_uses(word, logp, longest, floor))
    kept = {p: n for p, n in sums.items() if p in logp and n >= 0.5}
    total = _digamma(sum(kept.values()))
    return {p: _digamma(n) - total for p, n in kept.items()}


def arcs(counts: DataFrame, model: DataFrame, longest: int) -> DataFrame:
    """(word, freq, piece): for each word the pieces of the model that occur in it."""
    size = F.length("word")
    places = counts.where(size > 0).select("word", "freq", F.explode(F.sequence(F.lit(1), size)).alias("at"))
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("at") + 1))).alias("n")
    spans = places.select("word", "freq", "at", lengths).select("word", "freq", F.substr("word", "at", "n").alias("piece"))
    return lookup_join(spans, model.select("piece"), ["piece"], spread=["word"]).distinct()


def uses(known: DataFrame, model: DataFrame, longest: int, floor: float, spread: Callable) -> DataFrame:
    """(piece, n): ``spread(word, pieces, longest, floor)`` of each word, by frequency, summed.

    The pieces of each word of :func:`arcs` come to it by a join: a task holds the pieces of the words of a batch, not the model.
    """
    scored = lookup_join(known, model, ["piece"], spread=["word"])
    words = scored.groupBy("word", "freq").agg(F.collect_list("piece").alias("pieces"), F.collect_list("score").alias("scores"))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = Counter()
            for word, freq, pieces, scores in zip(batch["word"], batch["freq"], batch["pieces"], batch["scores"]):
                for piece, n in spread(word, dict(zip(pieces, scores)), longest, floor):
                    sums[piece] += n * freq
            yield pd.DataFrame({"piece": list(sums), "n": [float(n) for n in sums.values()]})

    return words.mapInPandas(partial, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))


def path_uses(word: str, logp: dict, longest: int, floor: float) -> Iterator[tuple[str, float]]:
    return ((piece, 1.0) for piece in best_path(word, logp, longest, floor))


def maximised(known: DataFrame, model: DataFrame, longest: int) -> DataFrame:
    """As :func:`maximise`, with the model as a table (piece, score) of any size."""
    found = uses(known, model, longest, floor_of(model), expected_uses)
    kept = durable(found.join(model.select("piece"), "piece", "left_semi").where("n >= 0.5"))
    total = _digamma(kept.agg(F.sum("n")).first()[0] or 1.0)

    @F.pandas_udf("double")
    def score(n: pd.Series) -> pd.Series:
        return n.map(_digamma) - total

    return durable(kept.select("piece", score("n").alias("score")))


def floor_of(model: DataFrame) -> float:
    return (model.agg(F.min("score")).first()[0] or 0.0) - UNKNOWN_PENALTY


def spelled_otherwise(model: DataFrame, longest: int, floor: float) -> DataFrame:
    """(piece, other): for each longer piece how the rest of the model would spell it; none where it cannot."""
    words = model.where(F.length("piece") > 1).select(F.col("piece").alias("word"), F.lit(1).alias("freq"))
    scored = lookup_join(arcs(words, model, longest), model, ["piece"], spread=["word"])
    inside = scored.groupBy("word").agg(F.collect_list("piece").alias("pieces"), F.collect_list("score").alias("scores"))

    @F.pandas_udf("array<string>")
    def spelled(word: pd.Series, pieces: pd.Series, scores: pd.Series) -> pd.Series:
        return pd.Series([best_path(w, dict(zip(p, s)), longest, floor, without=w) for w, p, s in zip(word, pieces, scores)])

    return inside.select(F.col("word").alias("piece"), spelled("word", "pieces", "scores").alias("other")).where(F.size("other") > 0)


def losses(known: DataFrame, model: DataFrame, longest: int) -> DataFrame:
    """(piece, score, loss): what the corpus likelihood loses with each piece; null for those that must stay.

    A piece that is not used loses nothing and is not here; a character, or a piece that the others cannot spell, stays.
    """
    floor = floor_of(model)
    used = durable(uses(known, model, longest, floor, path_uses))
    total = used.agg(F.sum("n")).first()[0] or 1.0
    others = durable(spelled_otherwise(model, longest, floor).join(used, "piece", "left"))
    after = F.log(F.lit(total) + F.col("n") * (F.size("other") - 1))
    parts = others.where("n > 0").select("piece", "n", after.alias("after"), F.explode("other").alias("part"))
    named = used.select(F.col("piece").alias("part"), F.col("n").alias("part_n"))
    priced = lookup_join(parts, named, ["part"], spread=["piece"], how="left")
    instead = F.sum(F.log(F.coalesce("part_n", F.lit(0.0)) + F.col("n")) - F.col("after"))
    loss = (F.first("n") / total) * (F.log(F.first("n") / total) - instead)
    lost = priced.groupBy("piece").agg(loss.alias("loss"))
    judged = model.join(others.select("piece", F.lit(True).alias("can_go")), "piece", "left").join(lost, "piece", "left")
    return judged.where("loss IS NOT NULL OR can_go IS NULL").select("piece", "score", "loss")


def trie_of(pieces: list[str], numbers: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Numbered pieces as a trie of arrays, by which a task finds all pieces in a block of words at once: (steps, ends).

    ``steps[k]`` has the sorted keys (node of the first k characters, next character), ``ends[k]`` the piece that each ends, -1 if
    none. It grows with the pieces, not with the words: at most 16 bytes for each character of a piece.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(sizes) - sizes
    chars, node, steps, ends = code_points(pieces), np.zeros(len(pieces), np.int64), [], []
    for depth in range(int(sizes.max(initial=0))):
        longer = np.flatnonzero(sizes > depth)
        keys, at = np.unique(node[longer] << CHAR_BITS | chars[starts[longer] + depth], return_inverse=True)
        node[longer] = at
        last = sizes[longer] == depth + 1
        steps.append(keys)
        ends.append(np.full(len(keys), -1, np.int64))
        ends[-1][at[last]] = numbers[longer[last]]
    return steps, ends


def spans_of(trie: tuple[list[np.ndarray], list[np.ndarray]], chars: np.ndarray) -> np.ndarray:
    """From characters (place, word), -1 past a word's end: the piece (place, length - 1, word) at each place, -1 if none."""
    deep, width = min(len(trie[0]), len(chars)), chars.shape[1]
    found = np.full((len(chars), deep, width), -1, np.int64)
    flat = chars.ravel()
    at = np.flatnonzero(flat >= 0)
    node = np.zeros(len(at), np.int64)
    for depth, steps, ends in zip(range(deep), *trie):
        ahead = at + depth * width
        inside = ahead < len(flat)
        inside[inside] = flat[ahead[inside]] >= 0
        at, node, ahead = at[inside], node[inside], ahead[inside]
        node = _numbers(steps, node << CHAR_BITS | flat[ahead])
        live = node >= 0
        at, node = at[live], node[live]
        found[at // width, depth, at % width] = ends[node]
    return found


def code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def blocks(words: list[str], deep: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(order, sizes, characters) of words of like sizes, shortest first; characters by (place, word), -1 past an end."""
    every = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(every, kind="stable")
    order = order[every[order] > 0]
    while len(order):
        cells = every[order] * np.arange(1, len(order) + 1) * np.minimum(every[order], deep)
        take = max(int(np.searchsorted(cells, BLOCK, side="right")), 1)
        now, order = order[:take], order[take:]
        sizes = every[now]
        chars = np.full((take, int(sizes[-1])), -1, np.int64)
        chars[np.arange(sizes[-1]) < sizes[:, None]] = code_points([words[i] for i in now])
        yield now, sizes, np.ascontiguousarray(chars.T)


def _steps_of(scores: np.ndarray, spans: np.ndarray) -> np.ndarray:
    return np.where(spans >= 0, scores[spans], NONE)


def _by_end(steps: np.ndarray) -> np.ndarray:
    """The scores of spans by (end - 1, length - 1, word) instead of by their start."""
    out = np.full_like(steps, NONE)
    for k in range(steps.shape[1]):
        out[k:, k] = steps[:len(steps) - k, k]
    return out


def expected_of(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`expected_uses` of a block of words, shortest first: the expectation of each span."""
    top, deep, n = steps.shape
    ends, before = _by_end(steps), np.full((deep + top, n), NONE)  # place t is row t + deep - 1
    before[deep - 1] = 0
    for t in range(1, top + 1):
        a = np.searchsorted(sizes, t)
        ways = before[t - 1:t - 1 + deep, a:][::-1] + ends[t - 1, :, a:]
        most = ways.max(axis=0)
        before[t + deep - 1, a:] = most + np.log(np.exp(ways - most).sum(axis=0))
    after, out = np.full((top + deep, n), NONE), np.zeros_like(steps)
    after[sizes, np.arange(n)] = 0
    whole = before[sizes + deep - 1, np.arange(n)]
    for t in range(top - 1, -1, -1):
        a = np.searchsorted(sizes, t, side="right")
        ways = steps[t, :, a:] + after[t + 1:t + 1 + deep, a:]
        most = ways.max(axis=0)
        odds = np.exp(ways - most)
        after[t, a:] = most + np.log(odds.sum(axis=0))
        out[t, :, a:] = odds * np.exp(most + before[t + deep - 1, a:] - whole[a:])
    return out


def best_of(steps: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`best_path` of a block of words, shortest first: (word, place, length - 1) of one span of each word at a time, the last first."""
    top, deep, n = steps.shape
    ends, before = _by_end(steps)[:, ::-1], np.full((deep + top, n), NONE)
    before[deep - 1] = 0
    chosen = np.zeros((top, n), np.int64)
    for t in range(1, top + 1):
        a = np.searchsorted(sizes, t)
        ways = before[t - 1:t - 1 + deep, a:] + ends[t - 1, :, a:]  # of equal ways the longest piece, as there
        chosen[t - 1, a:] = pick = ways.argmax(axis=0)
        before[t + deep - 1, a:] = ways[pick, np.arange(n - a)]
    word, at = np.arange(n), sizes.copy()
    while len(word):
        length = deep - 1 - chosen[at - 1, word]
        at = at - length - 1
        yield word, at, length
        word, at = word[at > 0], at[at > 0]


@dataclass
class Model:
    """The pieces of a model in training, by number in the order of their names, and their scores.

    ``alive`` are those that are still in it; a character that is not has the lowest score less a penalty. All of this is bounded by
    the size of the seed, whatever the corpus is.
    """

    pieces: list[str]
    single: np.ndarray
    alive: np.ndarray
    score: np.ndarray

    def __post_init__(self):
        self.trim()

    def trim(self) -> None:
        """Drop what is not alive from the trie."""
        kept = np.flatnonzero(self.alive | self.single)
        self.trie = trie_of([self.pieces[i] for i in kept], kept)

    def scores(self) -> np.ndarray:
        floor = self.score[self.alive].min(initial=0.0) - UNKNOWN_PENALTY
        return np.where(self.alive, self.score, np.where(self.single, floor, NONE))


def _sums(counts: DataFrame, model: Model, best: bool) -> np.ndarray:
    """Uses of each piece over the corpus, expected ones or those on the likeliest paths: a sum per task, then one shuffle."""
    sent, size = counts.sparkSession.sparkContext.broadcast((model.trie, model.scores())), len(model.pieces)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (trie, scores), sums = sent.value, np.zeros(size)
        for batch in batches:
            freq, words = batch["freq"].to_numpy(np.float64), batch["word"].tolist()
            for now, sizes, chars in blocks(words, len(trie[0])):
                spans = spans_of(trie, chars)
                steps = _steps_of(scores, spans)
                if best:
                    for word, at, length in best_of(steps, sizes):
                        np.add.at(sums, spans[at, length, word], freq[now[word]])
                else:
                    some = spans >= 0
                    np.add.at(sums, spans[some], (expected_of(steps, sizes) * freq[now])[some])
        used = np.flatnonzero(sums)
        yield pd.DataFrame({"piece": used, "n": sums[used]})

    parts = counts.select("word", "freq").mapInPandas(partial, "piece long, n double")
    found = parts.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    sent.destroy()
    sums = np.zeros(size)
    sums[found["piece"].to_numpy()] = found["n"].to_numpy()
    return sums


def _maximise(counts: DataFrame, model: Model) -> None:
    """:func:`maximised` for a model of arrays."""
    sums = _sums(counts, model, best=False)
    model.alive &= sums >= 0.5
    total = _digamma(sums[model.alive].sum() or 1.0)
    model.score = np.where(model.alive, _digammas(np.where(model.alive, sums, 1.0)) - total, NONE)


def _digammas(x: np.ndarray) -> np.ndarray:
    x, shift = x.astype(np.float64), np.zeros(len(x))
    for _ in range(7):
        low = x < 7
        shift[low] -= 1 / x[low]
        x[low] += 1
    x -= 0.5
    inverse = 1 / (x * x)
    return shift + np.log(x) + inverse * (1 / 24 - inverse * (7 / 960 - inverse * 31 / 8064))


def _losses(numbered: DataFrame, model: Model, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, loss) of :func:`losses`, of the longer pieces that are used. ``numbered`` has (number, piece)."""
    total = used.sum() or 1.0
    sent = numbered.sparkSession.sparkContext.broadcast((model.trie, model.scores(), used, model.alive))

    def lost(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, scores, used, alive = sent.value
        for batch in batches:
            numbers = batch["number"].to_numpy()
            wanted = alive[numbers] & (used[numbers] > 0)
            numbers, words = numbers[wanted], batch["piece"][wanted].tolist()
            for now, sizes, chars in blocks(words, len(trie[0])):
                spans = spans_of(trie, chars)
                steps, n = _steps_of(scores, spans), used[numbers[now]]
                steps[0, sizes - 1, np.arange(len(now))] = NONE  # not by itself
                parts, instead = np.zeros(len(now)), np.zeros(len(now))
                for word, at, length in best_of(steps, sizes):
                    parts[word] += 1
                    instead[word] += np.log(used[spans[at, length, word]] + n[word])
                instead -= parts * np.log(total + n * (parts - 1))
                yield pd.DataFrame({"piece": numbers[now], "loss": n / total * (np.log(n / total) - instead)})

    found = numbered.select("number", "piece").where(F.length("piece") > 1).mapInPandas(lost, "piece long, loss double").toArrow()
    sent.destroy()
    return found["piece"].to_numpy(), found["loss"].to_numpy()


def _prune(counts: DataFrame, numbered: DataFrame, model: Model, target: int) -> None:
    """Keep the characters and the pieces whose loss is largest: ``target`` or ``SHRINK`` of all, whichever is more."""
    number, loss = _losses(numbered, model, _sums(counts, model, best=True))
    room = max(target, int(model.alive.sum() * SHRINK)) - int((model.alive & model.single).sum())
    kept = number[np.lexsort((number, -loss))[:max(room, 0)]]
    alive = model.alive & model.single
    alive[kept] = True
    model.alive = alive
    model.trim()


def covered_letters(weights: dict[str, float], coverage: float) -> set[str]:
    kept, room = set(), coverage * sum(weights.values())
    for letter, weight in sorted(weights.items(), key=lambda item: (-item[1], item[0])):
        if room <= 0:
            break
        kept.add(letter)
        room -= weight
    return kept


def learn_unigram(
    counts: DataFrame, vocab_size: int, specials: list[str] = (), max_piece_length: int = 16,
    seed_size: int = 1_000_000, rounds: int = 2, coverage: float = 1.0,
) -> list[tuple[str, float]]:
    """(piece, log probability) in id order: specials at 0, then pieces from likely to unlikely.

    The most frequent characters that make up ``coverage`` of the corpus always get a
    piece, other characters none. The word table never leaves Spark; the model, bounded by ``seed_size`` and the number of
    characters, is sent to the tasks as arrays, so that a round reads the words once and shuffles one sum per piece and task.
    """
    with shuffles_freed(counts.sparkSession):
        return _learned(counts, vocab_size, list(specials), max_piece_length, seed_size, rounds, coverage)


def _in_few_tasks(counts: DataFrame) -> DataFrame:
    """Words in a task for each core, or as many times that as many words need: each task adds a sum per piece to a round's shuffle."""
    chars = counts.agg(F.sum(F.length("word").cast("long"))).first()[0] or 0
    cores = counts.sparkSession.sparkContext.defaultParallelism
    return counts.coalesce(cores * max(-(-chars // (TASK_CHARS * cores)), 1))


def _learned(
    counts: DataFrame, vocab_size: int, specials: list[str], max_piece_length: int, seed_size: int, rounds: int, coverage: float,
) -> list[tuple[str, float]]:
    small_batches()
    counts = _in_few_tasks(durable(counts.where(F.length("word") > 0).select("word", "freq")))
    seeds = durable(seed_pieces(counts, max_piece_length, seed_size))
    weights = {row.piece: row.weight for row in seeds.where(F.length("piece") == 1).collect()}
    letters = covered_letters(weights, coverage)
    rare = "".join(sorted(set(weights) - letters))
    if rare:  # the characters stay, as what words are spelled with at a penalty
        seeds = seeds.where((F.length("piece") == 1) | (F.translate("piece", rare, "") == F.col("piece")))
    placed = position(with_quantile_bucket(seeds, "piece", "_at"), "number", [F.col("piece")], F.col("_at"))
    numbered = durable(placed.select("number", "piece", "weight"))
    held = numbered.toArrow().sort_by("number")
    pieces, weight = held["piece"].to_pylist(), held["weight"].to_numpy()
    single = np.fromiter((len(p) == 1 for p in pieces), bool, len(pieces))
    alive = np.fromiter((len(p) > 1 or p in letters for p in pieces), bool, len(pieces))
    whole = weight[alive].sum() or 1.0
    model = Model(pieces, single, alive, np.log(weight) - math.log(whole))
    wanted, size = max(vocab_size - len(specials), len(letters)), 0
    while pieces:
        for _ in range(rounds):
            _maximise(counts, model)
        before, size = size, int(model.alive.sum())
        if size <= wanted * SPARE or size == before:
            break
        _prune(counts, numbered, model, int(wanted * SPARE))
        size = int(model.alive.sum())
    lowest = model.score[model.alive].min(initial=0.0)
    number = np.flatnonzero(model.alive)
    best = number[np.lexsort((number, -model.score[number]))]
    kept = {pieces[i]: float(model.score[i]) for i in number if single[i]}
    chosen = {piece: kept.get(piece, float(lowest)) for piece in letters}
    for i in best:
        if len(chosen) >= wanted:
            break
        chosen[pieces[i]] = float(model.score[i])
    ordered = sorted(chosen.items(), key=lambda item: (-item[1], item[0]))
    return [(s, 0.0) for s in specials] + ordered


def unigram_lists(words: Column, model: list[tuple[str, float]], specials: list[str], unknown: int) -> Column:
    """The ids of each word of a list by likeliest segmentation; the tasks hold the model, bounded by the vocabulary size."""
    held([piece for piece, _ in model])
    ids = {piece: i for i, (piece, _) in enumerate(model)}
    logp = {piece: score for piece, score in model if piece not in specials}
    longest, floor = max(map(len, logp)), _floor(logp)

    def of_distinct(distinct):
        return [[ids.get(p, unknown) for p in best_path(word, logp, longest, floor)] for word in distinct]

    return each_word_once(of_distinct, words)


def encode_words_unigram(words: DataFrame, model: list[tuple[str, float]], specials: list[str], unknown: int) -> DataFrame:
    """(word, ids) by likeliest segmentation."""
    return words.select("word", F.element_at(unigram_lists(F.array("word"), model, specials, unknown), 1).alias("ids"))


def model_table(spark, model: list[tuple[str, float]]) -> DataFrame:
    rows = [(piece, i, float(score)) for i, (piece, score) in enumerate(model)]
    return spark.createDataFrame(rows, "piece string, id int, score double")


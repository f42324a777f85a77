"""Subword vocabularies learned from distributed word counts.

The learned state (vocabulary and merges) is bounded by ``vocab_size`` and lives on
the driver; the word table, which grows with the corpus, never leaves Spark.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators.ranking import position
from codelake.session import discard, durable, small_batches, spread

CANDIDATES = 512
MOST_CANDIDATES = 65_536
# Most distinct stretches, and symbols in them, that a round brings to the driver.
STRETCHES = 100_000
STRETCH_SYMBOLS = 2_000_000
# Most pieces that a task holds to encode or decode; for larger tables join with encode.lookup_pieces.
MOST_PIECES = 1_000_000
FAR = np.iinfo(np.int64).max
# Ids up to which pairs are looked up in a square table.
SQUARE = 1000

# Special pieces of each configuration, in id order.
SPECIALS = {
    "roberta": ["<s>", "<pad>", "</s>", "<unk>", "<mask>"],
    "bert": ["[PAD]", "[CLS]", "[SEP]", "[MASK]", "[UNK]"],
    "wordpiece": ["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]", "[INDENT]", "[DEDENT]", "[NEWLINE]", "[EOF]"],
    "code_bytes": ["<unk>", "<s>", "</s>", "<pad>", "<mask>", "<indent>", "<dedent>", "<newline>", "<eof>"],
    "marked": [
        "<pad>", "<s>", "</s>", "<mask>", "<unk>", "<nl>", "<py>", "<indent>", "<dedent>", "<newline>", "<str>", "<num>"],
    "sentence": ["<pad>", "<unk>", "<s>", "</s>", "<indent>", "<dedent>", "<newline>"],
}
DEFAULT_IDS = {"pad": 0, "unk": 1, "cls": 2, "sep": 3, "mask": 4}


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """VOC-1: (word, freq); a frequent word leaves each map task as one row."""
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def byte_alphabet() -> list[str]:
    """One printable character per byte: itself where printable, else the next from code point 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def byte_text(text: Column) -> Column:
    """One printable character per UTF-8 byte, as one string."""
    other = [(chr(b), c) for b, c in enumerate(byte_alphabet()) if chr(b) != c]
    return F.translate(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), *map("".join, zip(*other)))


def byte_characters(text: Column) -> Column:
    """One printable character per UTF-8 byte."""
    return F.regexp_extract_all(byte_text(text), F.lit("(?s)(.)"), 1)


def initial_symbols(word: Column, kind: str) -> Column:
    """Characters, ``##``-continued characters, or byte characters of a word."""
    if kind == "bytes":
        return byte_characters(word)
    chars = F.regexp_extract_all(word, F.lit("(?s)(.)"), 1)
    if kind == "wordpiece":
        return F.transform(chars, lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit("##"), c)))
    return chars


@dataclass
class Merges:
    """A learned vocabulary: pieces in id order, merges in rank order, and the words as ids."""

    pieces: list[str]
    merges: list[tuple[int, int, int]]
    words: DataFrame
    kind: str
    rounds: int

    def vocab(self, spark) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.pieces)), "id int, piece string").select("piece", "id")

    def merge_table(self, spark) -> DataFrame:
        rows = [(rank, self.pieces[a], self.pieces[b]) for rank, (a, b, _) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")


def _joined(left: str, right: str, kind: str) -> str:
    return left + (right.removeprefix("##") if kind == "wordpiece" else right)


def merges_up_to(
    stretches: list[list[int]], freqs: list[int], last: tuple[int, int, int], make: Callable, room: int,
) -> list[tuple[int, int, int]]:
    """One-at-a-time merging within the stretches, as far as no pair outside of them can come first.

    ``last`` is (-count, a, b) of the lowest ranked pair that links stretches; every pair outside
    ranks below it. A new piece is made of one pair only, so a pair that holds new pieces occurs
    either in stretches alone or outside alone. There its count is at most that of the outer pair
    it grew from, and on equal counts its larger ids lose. A merge that makes a piece known
    before breaks this argument and ends the run.
    """
    counts, places = Counter(), defaultdict(set)
    for i, (symbols, freq) in enumerate(zip(stretches, freqs)):
        for pair in zip(symbols, symbols[1:]):
            counts[pair] += freq
            places[pair].add(i)
    heap = [(-n, *pair) for pair, n in counts.items()]
    heapify(heap)
    merges = []
    while heap and len(merges) < room:
        rank = heappop(heap)
        pair = rank[1:]
        if rank > last:
            break
        if -rank[0] != counts[pair]:
            continue
        made, fresh = make(*pair)
        merges.append((*pair, made))
        if not fresh:
            break
        changed = set()
        for i in places.pop(pair):
            old, freq = stretches[i], freqs[i]
            new = stretches[i] = replaced(old, pair, made)
            for p in zip(old, old[1:]):
                counts[p] -= freq
                changed.add(p)
            for p in zip(new, new[1:]):
                counts[p] += freq
                changed.add(p)
                places[p].add(i)
        for p in changed:
            if counts[p] > 0:
                heappush(heap, (-counts[p], *p))
    return merges


def replaced(symbols: list[int], pair: tuple[int, int], made: int) -> list[int]:
    """``symbols`` with each occurrence of ``pair``, from the left, written as ``made``."""
    out, at = [], 0
    while at < len(symbols):
        if tuple(symbols[at:at + 2]) == pair:
            out.append(made)
            at += 2
        else:
            out.append(symbols[at])
            at += 1
    return out


def _pair_keys(left, right):
    return (left.astype(np.int64) << 32) | right.astype(np.int64)


class PairTable:
    """Pair of ids -> its place in a list of pairs, ``FAR`` for others: a square while ids are small, else a binary search."""

    def __init__(self, pairs: np.ndarray):
        pairs = np.asarray(pairs, dtype=np.int64).reshape(-1, 2)
        self.side = int(pairs.max(initial=-1)) + 1
        if self.side <= SQUARE:
            self.square = np.full((self.side + 1) ** 2, FAR)
            self.square[pairs[:, 0] * (self.side + 1) + pairs[:, 1]] = np.arange(len(pairs))
            return
        keys = _pair_keys(pairs[:, 0], pairs[:, 1])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if self.side <= SQUARE:
            return self.square[np.minimum(left, self.side) * (self.side + 1) + np.minimum(right, self.side)]
        pairs = _pair_keys(left, right)
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.order[at], FAR)


def _tables(runs) -> list[tuple[PairTable, np.ndarray]]:
    """What a task needs of runs of merges: made once for all of its blocks."""
    made = [np.array(run, dtype=np.int64).reshape(-1, 3) for run in runs]
    return [(PairTable(run[:, :2]), run[:, 2]) for run in made]


def _merge_runs(values, offsets, runs):
    """Apply runs of merges, in order, to a batch of words given as one flat id array.

    Within a run each word takes its earliest merge, all words at once, until none applies;
    words without a merge leave the loop.
    """
    return _merge_tables(values, offsets, _tables(runs))


def _merge_tables(values, offsets, tables):
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for table, made in tables:
        finished = []
        while len(values):
            rank = table.places(values[:-1], values[1:])
            rank[word[:-1] != word[1:]] = FAR
            rank = np.append(rank, FAR)
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(word)))
            live = np.repeat(best < FAR, sizes)
            finished.append((values[~live], word[~live]))
            values, word, rank = values[live], word[live], rank[live]
            best = np.repeat(best[best < FAR], sizes[best < FAR])
            # only a pair of equal symbols can match at neighbouring places: every other one is taken, from the left
            hits = np.flatnonzero(rank == best)
            count = np.arange(len(hits))
            first = np.maximum.accumulate(np.where(np.diff(hits, prepend=-2) > 1, count, 0))
            hits = hits[(count - first) % 2 == 0]
            values[hits] = made[rank[hits]]
            kept = np.ones(len(values), dtype=bool)
            kept[hits + 1] = False
            values, word = values[kept], word[kept]
        if finished:
            values, word = (np.concatenate(part) for part in zip(*finished))
            back = np.argsort(word, kind="stable")
            values, word = values[back], word[back]
    ends = np.cumsum(np.bincount(word, minlength=len(offsets) - 1))
    return values, np.concatenate([[0], ends]), word


def _codes(words: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The first symbols of words as numbers, twice a byte or code point, plus one where ``##`` goes before, and how many each word has."""
    binary = words.cast(pa.large_binary())
    at = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset:binary.offset + len(binary) + 1]
    data = memoryview(binary.buffers()[2] or b"")[at[0]:at[-1]] if len(binary) else b""
    if kind == "bytes":
        return np.frombuffer(data, np.uint8).astype(np.int64) << 1, np.diff(at)
    codes = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), "<u4").astype(np.int64) << 1
    sizes = np.asarray(pc.utf8_length(words), dtype=np.int64)
    if kind == "wordpiece":
        codes += 1
        codes[(np.cumsum(sizes) - sizes)[sizes > 0]] -= 1
    return codes, sizes


def _symbol(code: int, kind: str) -> str:
    if kind == "bytes":
        return byte_alphabet()[code >> 1]
    return ("##" if code & 1 else "") + chr(code >> 1)


def _alphabet(words: DataFrame, kind: str) -> list[int]:
    """The codes that occur, as many as there are characters."""
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.empty(0, dtype=np.int64)
        for batch in batches:
            known = np.union1d(known, _codes(batch.column("word"), kind)[0])
        yield pa.RecordBatch.from_pydict({"code": pa.array(known, pa.int64())})

    return sorted(r.code for r in words.select("word").mapInArrow(seen, "code long").distinct().collect())


def _ids_of(known: dict[int, int]) -> Callable:
    """Codes -> ids."""
    codes = np.array(sorted(known), dtype=np.int64)
    ids = np.array([known[c] for c in sorted(known)], dtype=np.int64)
    return lambda found: ids[np.searchsorted(codes, found)] if len(codes) else found


# A row of the packed word table: the ids of many words one after the other, each word's size and frequency. Words of one symbol are left out.
BLOCK = "symbols binary, sizes binary, freqs binary"
BLOCK_SYMBOLS = 1 << 18


def _block(values, sizes, freqs) -> pa.RecordBatch:
    several = sizes > 1
    values, sizes, freqs = values[np.repeat(several, sizes)], sizes[several], freqs[several]
    wide = int(values.max(initial=0)) > 0xFFFF
    packed = [values.astype("<u4" if wide else "<u2"), sizes.astype("<u4"), freqs.astype("<i8")]
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in packed], names=["symbols", "sizes", "freqs"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, sizes and frequencies of the words of each block."""
    for batch in batches:
        for symbols, sizes, freqs in zip(*(batch.column(name) for name in ("symbols", "sizes", "freqs"))):
            sizes = np.frombuffer(sizes.as_py(), "<u4").astype(np.int64)
            if len(sizes):
                data = symbols.as_py()
                values = np.frombuffer(data, "<u2" if len(data) == 2 * sizes.sum() else "<u4").astype(np.int64)
                yield values, sizes, np.frombuffer(freqs.as_py(), "<i8")


def _packed(words: DataFrame, kind: str, known: dict[int, int]) -> DataFrame:
    """The word table as blocks of ids."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = _ids_of(known), [], 0
        for batch in batches:
            codes, sizes = _codes(batch.column("word"), kind)
            held.append((number(codes), sizes, np.asarray(batch.column("freq"), dtype=np.int64)))
            n += len(codes)
            if n >= BLOCK_SYMBOLS:
                yield _block(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if held:
            yield _block(*map(np.concatenate, zip(*held)))

    small_batches()
    return words.select("word", "freq").mapInArrow(pack, BLOCK)


def _spelled(words: DataFrame, kind: str, known: dict[int, int], runs: list) -> DataFrame:
    """(word, ids) of the word table after all runs."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tables = _ids_of(known), _tables(runs)
        for batch in batches:
            codes, sizes = _codes(batch.column("word"), kind)
            values, offsets, _ = _merge_tables(number(codes), np.concatenate([[0], np.cumsum(sizes)]), tables)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), lists], names=["word", "ids"])

    return words.select("word").mapInArrow(spell, "word string, ids array<int>")


def _inside(values, sizes) -> np.ndarray:
    """Whether a symbol and the next one are of one word."""
    inside = np.ones(len(values) - 1, dtype=bool)
    inside[np.cumsum(sizes)[:-1] - 1] = False
    return inside


# Sums that a task holds before it passes them on.
HELD_SUMS = 1 << 20


class Sums:
    """Frequencies by a number, added up over the blocks of a task."""

    def __init__(self):
        self.parts, self.n = [], 0

    def add(self, keys: np.ndarray, freqs: np.ndarray) -> None:
        self.parts.append(pa.table({"key": keys, "n": freqs}))
        self.n += len(keys)
        if self.n > 2 * HELD_SUMS:
            self.parts = [self.summed()]
            self.n = len(self.parts[0])

    def summed(self) -> pa.Table:
        return pa.concat_tables(self.parts).group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    def taken(self, most: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The sums, of which none is kept, if they are more than ``most``."""
        if self.n <= most:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        table, self.parts, self.n = self.summed(), [], 0
        return np.asarray(table["key"]), np.asarray(table["n"])


def _pair_counts(state: DataFrame) -> DataFrame:
    """(a, b, n) of adjacent symbols, summed per task before the shuffle."""
    def rows(keys, sums):
        return pa.RecordBatch.from_pydict({
            "a": (keys >> 32).astype(np.int32), "b": (keys & 0xFFFFFFFF).astype(np.int32), "n": sums})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for values, sizes, freqs in _blocks(batches):
            inside = _inside(values, sizes)
            sums.add(_pair_keys(values[:-1][inside], values[1:][inside]), np.repeat(freqs, sizes - 1))
            yield rows(*sums.taken(HELD_SUMS))
        yield rows(*sums.taken())

    parts = state.mapInArrow(count, "a int, b int, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _stretches(state: DataFrame, chosen: list[tuple[int, int]]) -> DataFrame:
    """(symbols, freq): the longest parts of words whose neighbours are all ``chosen`` pairs, each distinct part once.

    Parts that fit into one number are summed per task before the shuffle.
    """
    def rows(flat, size, freqs):
        offsets = np.arange(len(freqs) + 1) * size if np.isscalar(size) else np.concatenate([[0], np.cumsum(size)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays([lists, pa.array(freqs, pa.int64())], names=["symbols", "freq"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = PairTable(chosen), defaultdict(Sums)
        bits = int(np.max(chosen)).bit_length() or 1

        def unpacked(size, keys, freqs):
            return rows((keys[:, None] >> bits * np.arange(size) & ((1 << bits) - 1)).ravel(), size, freqs)

        for values, sizes, freqs in _blocks(batches):
            linked = (table.places(values[:-1], values[1:]) < FAR) & _inside(values, sizes)
            edges = np.diff(linked.astype(np.int8), prepend=0, append=0)
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
            lengths, freq = ends - starts, np.repeat(freqs, sizes)[starts]
            short = lengths * bits < 64
            for size in np.unique(lengths[short]).tolist():
                of = lengths == size
                places = bits * np.arange(size)
                sums[size].add((values[starts[of][:, None] + np.arange(size)] << places).sum(axis=1), freq[of])
                yield unpacked(size, *sums[size].taken(HELD_SUMS // 8))
            if not short.all():
                inner = np.zeros(len(values) + 1, dtype=np.int64)
                np.add.at(inner, starts[~short], 1)
                np.add.at(inner, ends[~short], -1)
                yield rows(values[np.cumsum(inner)[:-1] > 0], lengths[~short], freq[~short])
        for size, held in sums.items():
            yield unpacked(size, *held.taken())

    parts = state.mapInArrow(cut, "symbols array<int>, freq long")
    return parts.groupBy("symbols").agg(F.sum("freq").alias("freq"))


def _advance(state: DataFrame, runs: list) -> DataFrame:
    """The packed word table after ``runs``."""
    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(runs)
        for values, sizes, freqs in _blocks(batches):
            values, offsets, _ = _merge_tables(values, np.concatenate([[0], np.cumsum(sizes)]), tables)
            yield _block(values, np.diff(offsets), freqs)

    return state.mapInArrow(advance, BLOCK)


def learn_bpe(
    counts: DataFrame, vocab_size: int, min_frequency: int = 2, specials: list[str] = (), kind: str = "chars",
    all_bytes: bool = False, one_per_round: bool = False,
) -> Merges:
    """VOC-2, and VOC-3 with kind ``wordpiece``: merge the most frequent adjacent pair until full.

    Equal counts are ordered by the ids of the pair. A round counts pairs over the word table, cuts
    words to the stretches that the top pairs link, and merges in these, of which the driver holds at
    most ``STRETCHES`` distinct ones: with too many, fewer pairs are taken. The result is that of
    one merge at a time. ``all_bytes`` puts every byte character in the alphabet, seen or not.
    """
    spark = counts.sparkSession
    words = spread(durable(counts.select("word", "freq").where(F.col("word").isNotNull())), "word")
    codes = _alphabet(words, kind)  # bounded by the number of characters there are
    seen = {_symbol(c, kind) for c in codes}
    alphabet = sorted((seen | set(byte_alphabet()) if all_bytes else seen) - set(specials))
    pieces = [*specials, *alphabet]
    known = {piece: i for i, piece in enumerate(pieces)}
    first = {c: known[_symbol(c, kind)] for c in codes}
    state = durable(_packed(words, kind, first))
    merges, runs, rounds, reach = [], [], 0, 1 if one_per_round else CANDIDATES

    def make(a, b):
        piece = _joined(pieces[a], pieces[b], kind)
        if piece in known:
            return known[piece], False
        known[piece] = len(pieces)
        pieces.append(piece)
        return known[piece], True

    while len(pieces) < vocab_size:
        top = (
            _pair_counts(state).where(F.col("n") >= max(min_frequency, 1))
            .orderBy(F.desc("n"), "a", "b").limit(reach).collect()
        )
        if not top:
            break
        while True:
            parts = _stretches(state, [(r.a, r.b) for r in top])
            if len(top) == 1:
                n, symbols, held = 0, 0, parts.toArrow()
                break
            parts = durable(parts)
            n, symbols = parts.agg(F.count(F.lit(1)), F.sum(F.size("symbols"))).first()
            if n <= STRETCHES and symbols <= STRETCH_SYMBOLS:
                held = parts.toArrow()
                discard(parts)
                break
            discard(parts)
            # far too many stretches call for far fewer pairs; how many there are steers the work, not the result
            over = max(n / STRETCHES, symbols / STRETCH_SYMBOLS)
            top = top[: max(len(top) >> 1 + int(np.log2(over) / 4), 1)]
            reach = len(top)
        last = (-top[-1].n, top[-1].a, top[-1].b)
        run = merges_up_to(
            held["symbols"].to_pylist(), held["freq"].to_pylist(), last, make,
            1 if one_per_round else vocab_size - len(pieces))
        merges += run
        # a merge into a piece known before applies after all others
        fresh = [run[:-1], run[-1:]] if len(run) > 1 else [run]
        runs += fresh
        rounds += 1
        if not one_per_round and n < STRETCHES // 4 and symbols < STRETCH_SYMBOLS // 4:
            reach = min(reach * 2, MOST_CANDIDATES)
        if len(pieces) < vocab_size:
            before, state = state, durable(_advance(state, fresh))
            discard(before)
    discard(state)
    return Merges(pieces, merges, _spelled(words, kind, first, runs), kind, rounds)


def learn_wordpiece(counts: DataFrame, vocab_size: int, min_frequency: int = 2, specials: list[str] = ()) -> Merges:
    """VOC-3: merges over ``##``-continued symbols."""
    return learn_bpe(counts, vocab_size, min_frequency, specials, kind="wordpiece")


def held(pieces: list[str]) -> list[str]:
    """``pieces``, if they are few enough to be sent to every task."""
    if len(pieces) > MOST_PIECES:
        raise ValueError(f"{len(pieces)} pieces are over {MOST_PIECES}; use encode.lookup_pieces")
    return pieces


# Words that a task remembers the ids of.
HELD_WORDS = 200_000


def nested(lists: pa.Array, items: pa.Array, null: bool = False) -> pa.Array:
    """``items`` in place of the items of ``lists``; null lists become empty, or stay null."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, items, mask=lists.is_null() if null and lists.null_count else None)


def each_word_once(encode_distinct: Callable, words: Column) -> Column:
    """array<array<int>>: each distinct word of an Arrow batch is encoded once, and not again while a task remembers it; null lists become empty."""
    small_batches()

    @F.arrow_udf("array<array<int>>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = {}
        for lists in batches:
            found = lists.flatten().dictionary_encode()
            distinct = found.dictionary.to_pylist()
            if len(known) > HELD_WORDS:
                known.clear()
            new = [word for word in distinct if word not in known]
            known.update(zip(new, encode_distinct(new)))
            ids = pa.array([known[word] for word in distinct], pa.list_(pa.int32()))
            yield nested(lists, ids.take(found.indices))

    return encoded(words)


def encode_lists(words: Column, model: Merges, unknown: int | None = None) -> Column:
    """ENC-1 with a learned vocabulary: the ids of each word of a list, without a shuffle.

    The tasks hold the pieces and merges, at most ``vocab_size`` of each. Symbols without
    a piece become ``unknown``, or go if that is None.
    """
    known = {piece: i for i, piece in enumerate(held(model.pieces))}
    merges, kind, tables = np.array(model.merges, dtype=np.int64).reshape(-1, 3), model.kind, []

    def of_distinct(distinct):
        if len(merges) and not tables:  # once a task
            tables.extend(_tables([merges]))
        codes, sizes = _codes(pa.array(distinct, pa.string()), kind)
        seen, place = np.unique(codes, return_inverse=True)
        ids = [known.get(_symbol(c, kind), unknown) for c in seen.tolist()]
        flat = np.array([-1 if i is None else i for i in ids], dtype=np.int64)[place]
        word = np.repeat(np.arange(len(sizes)), sizes)[flat >= 0]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(sizes)))])
        values, offsets, _ = _merge_tables(flat[flat >= 0], offsets, tables)
        values, offsets = values.tolist(), offsets.tolist()
        return [values[a:b] for a, b in zip(offsets, offsets[1:])]

    return each_word_once(of_distinct, words)


def encode_words(words: DataFrame, model: Merges, unknown: int | None = None) -> DataFrame:
    """(word, ids) for any words."""
    return words.select("word", F.element_at(encode_lists(F.array("word"), model, unknown), 1).alias("ids"))


def longest_match_lists(words: Column, pieces: list[str], unknown: int, max_chars: int | None = None) -> Column:
    """The ids of each word of a list by longest match from the left with ``##`` continuations; all or unknown.

    With ``max_chars``, longer words are unknown.
    """
    known = {piece: i for i, piece in enumerate(held(pieces))}
    longest = max(map(len, pieces), default=0)

    def matched(word):
        if max_chars is not None and len(word) > max_chars:
            return [unknown]
        ids, at = [], 0
        while at < len(word):
            prefix = "##" if at else ""
            ends = range(min(len(word), at + longest), at, -1)
            end = next((e for e in ends if prefix + word[at:e] in known), None)
            if end is None:
                return [unknown]
            ids.append(known[prefix + word[at:end]])
            at = end
        return ids

    return each_word_once(lambda distinct: map(matched, distinct), words)


def encode_words_longest_match(
    words: DataFrame, pieces: list[str], unknown: int, max_chars: int | None = None
) -> DataFrame:
    """(word, ids) by longest match."""
    ids = longest_match_lists(F.array("word"), pieces, unknown, max_chars)
    return words.select("word", F.element_at(ids, 1).alias("ids"))


def decode_lists(ids: Column, pieces: list[str], kind: str) -> Column:
    """ENC-7 for :func:`encode_lists`: the words back from their ids, without a shuffle."""
    small_batches()
    pieces = held(pieces)
    if kind == "bytes":
        bytes_of = {c: b for b, c in enumerate(byte_alphabet())}
        inner = [bytes(bytes_of[c] for c in p) if bytes_of.keys() >= set(p) else None for p in pieces]
    else:
        inner = [(p.removeprefix("##") if kind == "wordpiece" else p).encode() for p in pieces]
    # what a piece gives at the start of a word, then what it gives within one
    parts = [p.encode() for p in pieces] + inner if kind == "wordpiece" else inner

    def texts(words: pa.Array) -> pa.Array:
        sizes = np.asarray(pc.list_value_length(words), dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.asarray(words.flatten(), dtype=np.int64)
        if kind == "wordpiece":
            within = np.ones(len(ids), dtype=bool)
            within[at[:-1][sizes > 0]] = False
            ids = ids + within * len(pieces)
        found = pa.array(parts, pa.binary()).take(pa.array(ids))
        if found.null_count:
            raise ValueError("a piece of other than byte characters")
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(found), dtype=np.int64))])[at].astype(np.int32)
        joined = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), found.buffers()[2] or pa.py_buffer(b"")])
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # some word is not UTF-8
            return pa.array([t.decode("utf-8", "replace") for t in joined.to_pylist()], pa.string())

    @F.arrow_udf("array<string>")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield nested(lists, texts(lists.flatten()), null=True)

    return decoded(ids)


def word_vocab(counts: DataFrame, specials: list[str], min_frequency: int = 1) -> DataFrame:
    """A whole-word vocabulary (piece, id): specials first, then words in their seeded order."""
    words = counts.where(F.col("freq") >= min_frequency).where(~F.col("word").isin(*specials))
    draw = draw_key("vocab", "word")
    placed = position(words.select("word"), "id", [draw, F.col("word")], draw_bucket(draw))
    fixed = counts.sparkSession.createDataFrame(list(enumerate(specials)), "id int, piece string")
    return durable(fixed.select("piece", "id").unionByName(
        placed.select(F.col("word").alias("piece"), (F.col("id") + len(specials)).cast("int").alias("id"))))


def vocab_report(vocab: DataFrame, names: dict[str, str], top: int = 10) -> DataFrame:
    """VOC-5: size, special-piece ids (display defaults where absent) and the first pieces."""
    total = vocab.agg(F.count(F.lit(1)).alias("id")).select(
        F.lit("size").alias("item"), F.lit("").alias("piece"), F.col("id").cast("long").alias("id"))
    found = vocab.where(F.col("piece").isin(*names.values())).agg(*[
        F.coalesce(F.max(F.when(F.col("piece") == piece, F.col("id"))), F.lit(DEFAULT_IDS.get(role))).alias(role)
        for role, piece in names.items()])
    special = found.select(F.inline(F.array(*[
        F.struct(F.lit(role).alias("item"), F.lit(piece).alias("piece"), F.col(role).cast("long").alias("id"))
        for role, piece in names.items()])))
    sample = vocab.orderBy("id").limit(top).select(
        F.lit("sample").alias("item"), "piece", F.col("id").cast("long").alias("id"))
    return total.unionByName(special).unionByName(sample)


def extend_vocab(vocab: DataFrame, specials: list[str]) -> DataFrame:
    """VOC-6: append the special pieces that are not there yet, with the next ids."""
    spark = vocab.sparkSession
    wanted = spark.createDataFrame(list(enumerate(specials)), "_order int, piece string")
    missing = wanted.join(vocab.select("piece").where(F.col("piece").isin(*specials)), "piece", "left_anti")
    last = F.coalesce(vocab.agg(F.max("id")).scalar(), F.lit(-1))
    added = missing.select(
        "piece", (last + F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_order"))).cast("int").alias("id"))
    return vocab.select("piece", "id").unionByName(added)

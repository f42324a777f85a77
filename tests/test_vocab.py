"""Learned vocabularies against public tokenizer libraries."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers, trainers

from codelake.functions import text as T
from codelake.operators import unigram, vocab
from codelake.plans.vocabularies import learn


@pytest.fixture(scope="module")
def texts(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").repartition(8).persist()


@pytest.fixture(scope="module")
def corpus(texts):
    return [r.text for r in texts.collect()]


def counted(texts, words):
    return vocab.word_counts(texts, words).persist()


def test_bpe_equals_library(spark, texts, corpus):
    tool = Tokenizer(models.BPE(unk_token="[UNK]"))
    tool.pre_tokenizer = pre_tokenizers.Whitespace()
    tool.train_from_iterator(corpus, trainers.BpeTrainer(
        vocab_size=190, min_frequency=2, special_tokens=vocab.SPECIALS["bert"], show_progress=False))
    counts = counted(texts, T.words(F.col("text")))
    model = vocab.learn_bpe(counts, 190, 2, vocab.SPECIALS["bert"])
    assert {p: i for i, p in enumerate(model.pieces)} == tool.get_vocab()
    assert model.rounds < len(model.merges)
    words = counts.orderBy("word").limit(400).select("word")
    again = {r.word: r.ids for r in vocab.encode_words(words, model).collect()}
    kept = {r.word: r.ids for r in model.words.join(words, "word").collect()}
    for word, ids in again.items():
        assert ids == kept[word] == tool.encode(word).ids


def test_one_merge_per_round_gives_the_same(spark, texts):
    counts = counted(texts, T.words(F.col("text")))
    some = vocab.learn_bpe(counts, 110, 2, ["<unk>"])
    single = vocab.learn_bpe(counts, 110, 2, ["<unk>"], one_per_round=True)
    assert some.merges == single.merges


def test_byte_bpe_equals_library(spark, texts, corpus):
    tool = Tokenizer(models.BPE())
    tool.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tool.decoder = decoders.ByteLevel()
    tool.train_from_iterator(corpus, trainers.BpeTrainer(
        vocab_size=300, min_frequency=2, special_tokens=vocab.SPECIALS["roberta"],
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False))
    model = vocab.learn_bpe(
        counted(texts, T.words_with_space(F.col("text"))), 300, 2, vocab.SPECIALS["roberta"], kind="bytes",
        all_bytes=True)
    assert {p: i for i, p in enumerate(model.pieces)} == tool.get_vocab()


def test_self_pairs_merge_from_the_left(spark):
    counts = spark.createDataFrame([("aaaaa", 9), ("aab", 4), ("bcb", 2)], "word string, freq long")
    tool = Tokenizer(models.BPE())
    tool.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tool.train_from_iterator(["aaaaa"] * 9 + ["aab"] * 4 + ["bcb"] * 2, trainers.BpeTrainer(
        vocab_size=9, min_frequency=2, show_progress=False))
    model = vocab.learn_bpe(counts, 9, 2)
    assert {p: i for i, p in enumerate(model.pieces)} == tool.get_vocab()


def test_wordpiece(spark):
    counts = spark.createDataFrame([("unhappy", 11), ("happy", 8), ("unha", 3)], "word string, freq long")
    model = vocab.learn_wordpiece(counts, 20, 2, ["[UNK]"])
    pieces = set(model.pieces)
    assert "happy" in pieces or "##happy" in pieces
    coded = vocab.encode_words_longest_match(spark.createDataFrame([("happy",), ("zzz",)], "word string"), model.pieces, 0)
    found = {r.word: r.ids for r in coded.collect()}
    assert "".join(model.pieces[i].removeprefix("##") for i in found["happy"]) == "happy"
    assert found["zzz"] == [0]


def test_unigram_covers_and_improves(spark, texts):
    counts = counted(texts, T.words(F.col("text"))).orderBy(F.desc("freq"), "word").limit(400)
    table = [(r.word, r.freq) for r in counts.collect()]

    def likelihood(logp):
        floor, longest = min(logp.values()) - 10, max(map(len, logp))
        return sum(n * sum(logp.get(p, floor) for p in unigram.best_path(w, logp, longest, floor)) for w, n in table)

    seeds = {r.piece: r.weight for r in unigram.seed_pieces(counts, 8, 2000).collect()}
    whole = math.log(sum(seeds.values()))
    first = unigram.maximise(counts, {p: math.log(w) - whole for p, w in seeds.items()})
    second = unigram.maximise(counts, first)
    assert likelihood(second) >= likelihood(first)
    model = unigram.learn_unigram(counts, 150, ["<unk>"], max_piece_length=8, seed_size=2000)
    assert model[0] == ("<unk>", 0.0) and len(model) == 150
    letters = {c for w, _ in table for c in w}
    assert letters <= {p for p, _ in model}
    coded = unigram.encode_words_unigram(counts.select("word"), model, ["<unk>"], 0)
    assert all("".join(model[i][0] for i in r.ids) == r.word for r in coded.collect())


def test_expected_uses_by_brute_force():
    logp = {"a": -1.0, "b": -1.5, "ab": -1.2, "ba": -2.0}

    def paths(word):
        if not word:
            yield []
        for piece in logp:
            if word.startswith(piece):
                for rest in paths(word[len(piece):]):
                    yield [piece, *rest]

    word = "abab"
    weights = [(p, math.exp(sum(logp[x] for x in p))) for p in paths(word)]
    total = sum(w for _, w in weights)
    wanted = {x: sum(w * p.count(x) for p, w in weights) / total for x in logp}
    found = dict.fromkeys(logp, 0.0)
    for piece, n in unigram.expected_uses(word, logp, 2, -99.0):
        found[piece] += n
    assert all(abs(found[x] - wanted[x]) < 1e-9 for x in logp)
    best = max(weights, key=lambda item: item[1])[0]
    assert unigram.best_path(word, logp, 2, -99.0) == best


def test_capped_size():
    assert unigram.capped_vocab_size(32000, 100) == 200
    assert unigram.capped_vocab_size(32000, 1000) == 500
    assert unigram.capped_vocab_size(32000, 10**6) == 2000


def library(name, corpus, size):
    """The same configuration in the public library, trained on whole texts or on lines."""
    sequence, special = pre_tokenizers.Sequence, vocab.SPECIALS
    punct, digits = pre_tokenizers.Punctuation(), pre_tokenizers.Digits(individual_digits=True)
    accents = normalizers.Sequence([normalizers.NFD(), normalizers.StripAccents()])
    lines = [line for text in corpus for line in (text + "\n").splitlines(keepends=True)]
    alphabet = pre_tokenizers.ByteLevel.alphabet()
    model, normal, splitter, specials, first, texts = {
        "roberta_bytes": (models.BPE(), None, pre_tokenizers.ByteLevel(add_prefix_space=False), special["roberta"], alphabet, lines),
        "bert_words": (models.BPE(), normalizers.NFKC(), pre_tokenizers.Whitespace(), special["bert"], [], corpus),
        "code_bytes": (models.BPE(), accents, sequence([pre_tokenizers.ByteLevel(add_prefix_space=False), punct, digits]),
                       special["code_bytes"], alphabet, corpus),
        "marked_bytes": (models.BPE(), None, pre_tokenizers.ByteLevel(), special["marked"], [], lines),
    }[name]
    tool = Tokenizer(model)
    if normal is not None:
        tool.normalizer = normal
    tool.pre_tokenizer = splitter
    tool.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=size, min_frequency=2, special_tokens=specials, initial_alphabet=first, show_progress=False))
    return tool.get_vocab()


@pytest.mark.parametrize("name", ["roberta_bytes", "bert_words", "code_bytes", "marked_bytes"])
def test_configurations_equal_library(spark, name):
    odd = ["x = 'é'  # ﬁ 12\n\tif a<b:\n      y+=1\n", "don't  stop!\nx==y and z\n", "日本 a1b2\n"] * 3
    rows = spark.createDataFrame(list(enumerate(odd)), "id int, text string")
    model = learn(rows, "text", name, vocab_size=300, marked=False)
    assert {p: i for i, p in enumerate(model.pieces)} == library(name, odd, 300)


def test_splitters_equal_library(spark):
    texts = ["a>b 12, c²", "x=(y)$ «q» _z", "ä1b"]
    tool = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Punctuation(), pre_tokenizers.Digits(individual_digits=True)])
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = rows.select("i", T.words_punct_digits(F.col("t")).alias("w")).orderBy("i").collect()
    assert [r.w for r in found] == [[w for w, _ in tool.pre_tokenize_str(t)] for t in texts]


def test_few_stretches_on_the_driver_give_the_same(spark, texts, monkeypatch):
    counts = counted(texts, T.words(F.col("text")))
    whole = vocab.learn_bpe(counts, 400, 2, ["<unk>"])
    monkeypatch.setattr(vocab, "STRETCHES", 40)
    monkeypatch.setattr(vocab, "CANDIDATES", 64)
    few = vocab.learn_bpe(counts, 400, 2, ["<unk>"])
    assert few.merges == whole.merges and few.rounds > whole.rounds


def test_two_thousand_pieces_equal_library(spark, texts, corpus):
    tool = Tokenizer(models.BPE())
    tool.pre_tokenizer = pre_tokenizers.Whitespace()
    tool.train_from_iterator(corpus, trainers.BpeTrainer(
        vocab_size=2000, min_frequency=2, special_tokens=vocab.SPECIALS["bert"], show_progress=False))
    model = vocab.learn_bpe(counted(texts, T.words(F.col("text"))), 2000, 2, vocab.SPECIALS["bert"])
    assert {p: i for i, p in enumerate(model.pieces)} == tool.get_vocab()


def test_runs_merge_as_one_at_a_time():
    draw = random.Random(5)
    for _ in range(300):
        words = [[draw.randrange(3) for _ in range(draw.randrange(0, 9))] for _ in range(draw.randrange(1, 6))]
        merges = []
        for made in range(3, 3 + draw.randrange(1, 6)):
            pair = draw.randrange(made), draw.randrange(made)
            if pair not in [m[:2] for m in merges]:
                merges.append((*pair, made))
        wanted = words
        for a, b, made in merges:
            wanted = [vocab.replaced(w, (a, b), made) for w in wanted]
        flat = np.array([s for w in words for s in w], dtype=np.int64)
        offsets = np.cumsum([0, *map(len, words)])
        values, offsets, word = vocab._merge_runs(flat, offsets, [merges])
        assert [values[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == wanted
        assert word.tolist() == [i for i, w in enumerate(wanted) for _ in w]


def test_unigram_tables_against_a_plain_lattice(spark):
    words = {"banana": 5, "bandana": 3, "ananas": 4, "nab": 2, "é": 1, "abba": 2, "an": 9}
    counts = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(3)
    plain = Counter()
    for word, freq in words.items():
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + 4) + 1):
                plain[word[i:j]] += freq
    assert {r.piece: r.freq for r in unigram.substrings(counts, 4).collect()} == plain
    logp = {p: math.log(n / 500) for p, n in plain.items() if n > 2 or len(p) == 1}
    model = spark.createDataFrame(list(logp.items()), "piece string, score double")
    known = unigram.arcs(counts, model, 4).cache()

    def segmentations(word):
        if not word:
            yield ()
        for n in range(1, min(4, len(word)) + 1):
            if word[:n] in logp:
                yield from ((word[:n], *rest) for rest in segmentations(word[n:]))

    expected, best = Counter(), Counter()
    for word, freq in words.items():
        ways = list(segmentations(word))
        odds = [math.exp(sum(logp[p] for p in w)) for w in ways]
        for way, odd in zip(ways, odds):
            for piece in way:
                expected[piece] += freq * odd / sum(odds)
        for piece in ways[odds.index(max(odds))]:
            best[piece] += freq
    found = {r.piece: r.n for r in unigram.uses(known, model, 4, -99.0, unigram.expected_uses).collect()}
    assert found.keys() == expected.keys() and all(found[p] == pytest.approx(expected[p]) for p in found)
    step = {r.piece: r.score for r in unigram.maximised(known, model, 4).collect()}
    assert step == pytest.approx(unigram.maximise(counts, logp))
    total = sum(best.values())
    for r in unigram.losses(known, model, 4).collect():
        ways = [w for w in segmentations(r.piece) if w != (r.piece,)]
        if len(r.piece) == 1 or not ways:
            assert r.loss is None
            continue
        used, other = best[r.piece], max(ways, key=lambda w: sum(logp[p] for p in w))
        after = math.log(total + used * (len(other) - 1))
        instead = sum(math.log(best[p] + used) - after for p in other)
        assert r.loss == pytest.approx(used / total * (math.log(used / total) - instead))


def test_unigram_against_the_library(spark, texts):
    """A vocabulary of the same size spells the same words in no more pieces than the library's plus a twentieth, and shares over half of them."""
    counts = counted(texts, T.words(F.col("text"))).orderBy(F.desc("freq"), "word").limit(1500)
    table = [(r.word, r.freq) for r in counts.collect()]
    ours = unigram.learn_unigram(counts, 400, ["<unk>"], max_piece_length=8)
    tool = Tokenizer(models.Unigram())
    tool.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tool.train_from_iterator((" ".join([w] * n) for w, n in table), trainers.UnigramTrainer(
        vocab_size=400, special_tokens=["<unk>"], unk_token="<unk>", max_piece_length=8, show_progress=False))
    logp = dict(ours[1:])
    mine = sum(n * len(unigram.best_path(w, logp, 8, -99.0)) for w, n in table)
    theirs = sum(n * len(tool.encode(w).tokens) for w, n in table)
    letters = {c for w, _ in table for c in w}
    assert letters <= set(logp) and letters <= set(tool.get_vocab())
    assert mine <= 1.05 * theirs
    assert len(set(logp) & set(tool.get_vocab())) >= 0.5 * len(logp)


def test_unigram_arrays_against_tables(spark):
    """The training rounds on arrays give what the tables give, for words of unlike sizes and characters outside of the model."""
    words = {"banana": 5, "bandana" * 9: 3, "ananas": 4, "nab": 2, "é𝄞a": 1, "abba": 2, "an": 9, "a\u0000b": 1}
    counts = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(3)
    plain = {r.piece: r.freq for r in unigram.substrings(counts, 4).collect()}
    pieces = sorted(p for p, n in plain.items() if n > 2 or len(p) == 1)
    single = np.array([len(p) == 1 for p in pieces])
    alive = np.array([p not in ("é", "b") for p in pieces])
    score = np.array([math.log(plain[p] / 500) for p in pieces])
    model = unigram.Model(pieces, single, alive, score)
    numbered = spark.createDataFrame(list(enumerate(pieces)), "number long, piece string")
    table = spark.createDataFrame([(p, float(s)) for p, s, a in zip(pieces, score, alive) if a], "piece string, score double")
    known, floor = unigram.arcs(counts, table, 4).cache(), unigram.floor_of(table)
    for best, spread in ((False, unigram.expected_uses), (True, unigram.path_uses)):
        used = unigram._sums(counts, model, best)
        want = {r.piece: r.n for r in unigram.uses(known, table, 4, floor, spread).collect()}
        assert {p: n for p, n in zip(pieces, used) if n} == pytest.approx(want)
    number, loss = unigram._losses(numbered, model, used)
    want = {r.piece: r.loss for r in unigram.losses(known, table, 4).collect() if r.loss is not None}
    assert {pieces[i]: x for i, x in zip(number, loss)} == pytest.approx(want)
    step = {r.piece: r.score for r in unigram.maximised(known, table, 4).collect()}
    unigram._maximise(counts, model)
    assert {p: s for p, s, a in zip(pieces, model.score, model.alive) if a} == pytest.approx(step)


def test_unigram_rounds_store_no_tables(spark, texts, monkeypatch):
    """However many rounds there are, what the training writes is the words and the seeds."""
    stored = []
    monkeypatch.setattr(unigram, "durable", lambda df: stored.append(df) or df.cache())
    counts = counted(texts, T.words(F.col("text"))).orderBy(F.desc("freq"), "word").limit(300)
    assert len(unigram.learn_unigram(counts, 120, ["<unk>"], max_piece_length=6)) == 120
    assert len(stored) <= 4
    assert unigram.learn_unigram(counts.limit(0), 120, ["<unk>"]) == [("<unk>", 0.0)]


def test_packed_words_shrink_and_give_plain_counts_and_stretches(spark):
    """Words of one symbol leave the table, and sums per task are those of plain loops, with many blocks and with long stretches."""
    draw = random.Random(3)
    words = {"".join(draw.choice("abcd") for _ in range(draw.randrange(1, 40))): draw.randrange(1, 9) for _ in range(400)}
    counts = spark.createDataFrame(list(words.items()), "word string, freq long")
    known = {ord(c) << 1: i for i, c in enumerate("abcd")}
    state = vocab._packed(counts, "chars", known)
    merged = vocab._advance(state, [[(0, 1, 4), (4, 4, 5)], [(2, 3, 6)]])
    plain = [(vocab.replaced(vocab.replaced(vocab.replaced(["abcd".index(c) for c in w], (0, 1), 4), (4, 4), 5), (2, 3), 6), n) for w, n in words.items()]
    pairs = Counter()
    for symbols, n in plain:
        for pair in zip(symbols, symbols[1:]):
            pairs[pair] += n
    assert {(r.a, r.b): r.n for r in vocab._pair_counts(merged).collect()} == pairs
    sizes = [int(s) for r in merged.collect() for s in np.frombuffer(r.sizes, "<u4")]
    assert sorted(sizes) == sorted(len(s) for s, _ in plain if len(s) > 1)
    for chosen in ([(0, 2), (2, 0), (3, 3)], sorted(pairs)):
        stretches = Counter()
        for symbols, n in plain:
            part = symbols[:1]
            for a, b in zip(symbols, symbols[1:]):
                if (a, b) not in chosen:
                    stretches[tuple(part)] += n * (len(part) > 1)
                    part = []
                part.append(b)
            stretches[tuple(part)] += n * (len(part) > 1)
        assert {tuple(r.symbols): r.freq for r in vocab._stretches(merged, chosen).collect()} == +stretches


def test_one_round_keeps_one_word_table(spark, monkeypatch):
    """A table of an earlier round is deleted, and a round reads words that its predecessor has merged."""
    gone, counts = [], spark.createDataFrame([("abab", 5), ("abc", 3), ("bcbc", 2), ("x", 9)], "word string, freq long")
    discard = vocab.discard
    monkeypatch.setattr(vocab, "discard", lambda df: (gone.append(df.inputFiles()[0]), discard(df)))
    model = vocab.learn_bpe(counts, 8, 2, one_per_round=True)
    assert model.rounds == 4 and len(gone) >= 4
    assert {r.word: [model.pieces[i] for i in r.ids] for r in model.words.collect()}["x"] == ["x"]


def test_byte_text_and_distinct_words_cut_again(spark):
    odd = "".join(map(chr, range(0x500))) + "日本😀"
    rows = spark.createDataFrame([(odd,), ("a1 a1",)], "text string")
    alphabet = vocab.byte_alphabet()
    assert [r.t for r in rows.select(vocab.byte_text(F.col("text")).alias("t")).collect()] == ["".join(alphabet[b] for b in t.encode()) for t in (odd, "a1 a1")]
    # a task's share of narrow rows has a largest size, whatever the file's size
    from codelake.session import dealt
    assert dealt(spark.range(1000), "id", 10).rdd.getNumPartitions() == 100


def test_lists_of_many_batches_encode_and_decode_like_single_words(spark, monkeypatch):
    """Null lists, unknown symbols, broken characters, and words met again after a task has forgotten them."""
    monkeypatch.setattr(vocab, "HELD_WORDS", 1)
    counts = spark.createDataFrame([("é日", 4), ("aab", 3)], "word string, freq long")
    model = vocab.learn_bpe(counts, 8, 2, ["<unk>"], "bytes")
    rows = spark.createDataFrame([(1, ["é日", "zab", ""]), (2, None), (3, []), (4, ["zab", "é日"])], "id int, words array<string>")
    coded = rows.select("id", vocab.encode_lists(F.col("words"), model, unknown=0).alias("ids"))
    single = {r.word: r.ids for r in vocab.encode_words(spark.createDataFrame([("é日",), ("zab",), ("",)], "word string"), model, 0).collect()}
    assert {r.id: r.ids for r in coded.collect()} == {1: [single["é日"], single["zab"], []], 2: [], 3: [], 4: [single["zab"], single["é日"]]}
    assert single["zab"][0] == 0 and 0 not in single["é日"]
    back = {r.id: r.t for r in coded.select("id", vocab.decode_lists(F.col("ids"), model.pieces, "bytes").alias("t")).collect()}
    assert back == {1: ["é日", "<unk>ab", ""], 2: [], 3: [], 4: ["<unk>ab", "é日"]}
    lone = spark.createDataFrame([([[0], [1, 0]],), (None,)], "ids array<array<int>>")
    pieces = [vocab.byte_alphabet()[b] for b in (0xE9, 0x41)]
    assert [r.t for r in lone.select(vocab.decode_lists(F.col("ids"), pieces, "bytes").alias("t")).collect()] == [["�", "A�"], None]
    words = [r.t for r in lone.select(vocab.decode_lists(F.col("ids"), ["##x", "##y"], "wordpiece").alias("t")).collect()]
    assert words == [["##x", "##yx"], None]


@pytest.mark.parametrize("block, held, most", [(500_000, 2_000_000, 16_000_000), (7, 10, 16_000_000), (500_000, 2_000_000, 40)])
def test_heavy_substrings_are_the_heaviest_of_all(spark, monkeypatch, block, held, most):
    """Cut into small blocks, with sums given up early, and where tasks cannot hold the pieces: the heaviest, and their exact frequencies."""
    monkeypatch.setattr(unigram, "BLOCK", block)
    monkeypatch.setattr(unigram, "HELD_SUMS", held)
    monkeypatch.setattr(unigram, "MOST_NODES", most)
    draw = random.Random(5)
    words = {"".join(draw.choice("aab𝄞\u0000é") for _ in range(draw.randrange(1, 30))): draw.randrange(1, 4) for _ in range(150)}
    words |= {"solitary": 1, "": 5, "abab" * 12: 2}
    counts = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(3)
    plain = Counter()
    for word, freq in words.items():
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + 6) + 1):
                plain[word[i:j]] += freq
    ranked = sorted((-n * len(p), p) for p, n in plain.items() if len(p) > 1 and n >= 2)
    for size in (0, 20, len(ranked) + 1):
        wanted = {p: float(-w) for w, p in ranked[:size]} | {p: float(n) for p, n in plain.items() if len(p) == 1}
        seeds = {r.piece: r.weight for r in unigram.seed_pieces(counts, 6, size).collect()}
        assert seeds == wanted
        found = {r.piece: r.freq for r in unigram.substrings(counts, 6, size).collect()}
        assert all(plain[p] == n for p, n in found.items()) and wanted.keys() <= found.keys()
    few = unigram.heavy_substrings(counts, 6, 20)
    assert (few is None) == (most == 40)
    if few is not None:
        assert {r.piece for r in few.collect()} == {p for w, p in ranked if w <= ranked[19][0]} | {p for p in plain if len(p) == 1}
    assert unigram.heavy_substrings(counts.limit(0), 6, 20).count() == 0


def test_unigram_learning_leaves_and_moves_little(spark, monkeypatch):
    """Sentences with a number each: a shuffle has sums of pieces that may become seeds, no row per place, and its files go with it."""
    spark.sparkContext._jvm.System.gc()
    code = spark.range(20_000).select(F.format_string("▁return▁value%d▁*▁other%d", "id", "id").alias("word"), F.lit(1).cast("long").alias("freq"))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))

    moved, before = [], shuffled()
    held = unigram.durable

    def stored(df):
        out = held(df)
        moved.append(shuffled() - before)
        return out

    monkeypatch.setattr(unigram, "durable", stored)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert len(unigram.learn_unigram(code, 300, ["<unk>"], seed_size=2000)) == 300
    assert spark.conf.get(key) == "false"
    time.sleep(2)  # files are deleted a moment later
    assert max(moved) < 2_000_000 and shuffled() - before < 1_000_000

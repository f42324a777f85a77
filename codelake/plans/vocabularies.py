"""The vocabulary configurations: normalisation, splitting, specials and sizes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.functions import code as C
from codelake.functions import text as T
from codelake.operators import unigram, vocab
from codelake.operators.normalize import mark_corpus


def _line_words(text: Column, prefix_space: bool) -> Column:
    """Byte-level words of each line, its newline included."""
    def prefixed(line):
        return F.when(F.startswith(line, F.lit(" ")), line).otherwise(F.concat(F.lit(" "), line))

    lines = T.lines_with_ends(text)
    return F.flatten(F.transform(lines, lambda line: T.words_with_space(prefixed(line) if prefix_space else line)))


def _split_bytes(word: Column) -> Column:
    """A byte-level word as byte characters, cut again at punctuation and numerals."""
    return T.split_punct_digits(vocab.byte_text(word))


def _sentences(text: Column) -> Column:
    """Lines as one unsplit word each, blanks written as U+2581 with one in front."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(T.squeeze(line)) > 0)
    return F.transform(lines, lambda line: F.concat(
        F.lit("\u2581"), F.replace(T.squeeze(line), F.lit(" "), F.lit("\u2581"))))


@dataclass(frozen=True)
class Configuration:
    vocab_size: int
    specials: str
    words: Callable[[Column], Column]
    #: Cuts each distinct word again.
    parts: Callable[[Column], Column] | None = None
    kind: str = "chars"
    all_bytes: bool = False
    marked: bool = False
    normalize: Callable[[Column], Column] = field(default=lambda text: text)
    options: dict = field(default_factory=dict)


def _unaccented(text: Column) -> Column:
    return C.unicode_normalize(text, "NFD", strip_accents=True)


# Sizes, special pieces and rules of each configuration.
CONFIGURATIONS = {
    "roberta_bytes": Configuration(50265, "roberta", lambda t: _line_words(t, False), kind="bytes", all_bytes=True),
    "bert_words": Configuration(32000, "bert", T.words, normalize=lambda t: C.unicode_normalize(t, "NFKC")),
    "code_bytes": Configuration(32000, "code_bytes", T.words_with_space, _split_bytes, all_bytes=True, normalize=_unaccented),
    "marked_bytes": Configuration(32000, "marked", lambda t: _line_words(t, True), kind="bytes", marked=True),
    "wordpiece": Configuration(32000, "wordpiece", T.words_punct_digits, kind="wordpiece", normalize=_unaccented),
    "marked_unigram": Configuration(
        32000, "marked", T.words, kind="unigram", marked=True, options={"max_piece_length": 16}),
    "sentence_unigram": Configuration(
        32000, "sentence", _sentences, kind="unigram", normalize=lambda t: C.unicode_normalize(t, "NFKC"),
        options={"max_piece_length": 16, "coverage": 0.9995}),
}


@dataclass
class Unigram:
    """A unigram vocabulary with the piece order of its ids."""

    model: list[tuple[str, float]]

    @property
    def pieces(self) -> list[str]:
        return [piece for piece, _ in self.model]

    def vocab(self, spark) -> DataFrame:
        return unigram.model_table(spark, self.model)


def learn(
    df: DataFrame, text: str, name: str, vocab_size: int | None = None, marked: bool | None = None,
    cap_by_texts: bool = False,
):
    """VOC-2, VOC-3, VOC-4: learn one configuration on a text column.

    ``marked`` says whether layout marks are put in first; by default as configured.
    ``cap_by_texts`` holds the size to half the number of texts, between 200 and 2000.
    """
    chosen = CONFIGURATIONS[name]
    size = vocab_size or chosen.vocab_size
    rows = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull())
    if chosen.marked if marked is None else marked:
        rows = mark_corpus(rows, to="text")
    if cap_by_texts:
        size = unigram.capped_vocab_size(size, rows.count())
    normal = rows.select(chosen.normalize(F.col("text")).alias("text"))
    counts = vocab.word_counts(normal, chosen.words(F.col("text")))
    if chosen.parts:
        counts = counts.select(F.explode(chosen.parts(F.col("word"))).alias("word"), "freq").groupBy("word").agg(F.sum("freq").alias("freq"))
    specials = vocab.SPECIALS[chosen.specials]
    if chosen.kind == "unigram":
        return Unigram(unigram.learn_unigram(counts, size, specials, **chosen.options))
    return vocab.learn_bpe(counts, size, 2, specials, chosen.kind, all_bytes=chosen.all_bytes)

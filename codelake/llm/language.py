"""Language identification by prediction by partial matching."""

from __future__ import annotations

import io
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import map_batches, share_of, texts_of

#: Documents per language that the model is fitted on, by expectation: a hash draw picks them.
DOCS_PER_LANGUAGE = 500
#: Longest context in bytes, and how often a language must have met a context for it to be a node.
ORDER, LEAST = 3, 8
#: Languages that one part of a model has: a task holds the trees of one part at a time.
LANGUAGES = 32
#: Bytes that the score's message has at most: it would be 1 for any longer text.
MESSAGE = 32
#: Bytes that are scored at a time.
SLAB = 1 << 18
LETTER = re.compile(r"[^\W\d_]")


def training_rows(docs: DataFrame, key: str, text: str, lang: str, folds: int, fold: int, most: int) -> DataFrame:
    """lang, text of the bounded sample: rows outside the fold, drawn by hash at each language's own rate."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (share_of(F.col(key), folds) != fold))
    counts = rows.groupBy(F.col(lang).alias("its_lang")).agg(F.count("*").alias("rows"))
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col(key).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(F.broadcast(counts), F.col(lang) == F.col("its_lang")).where(draw * F.col("rows") < most).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram, uses: runs of ORDER + 1 bytes, as numbers; a text is preceded by line feeds."""
    def run(batch):
        langs = np.array(batch.column("lang").to_pylist())
        texts = np.array([t.encode("utf-8", "replace") for t in texts_of(batch)], dtype=object)
        for lang in np.unique(langs):
            grams = np.concatenate([grams_of(t) for t in texts[langs == lang]])
            gram, uses = np.unique(grams, return_counts=True)
            yield {"lang": [lang] * len(gram), "gram": pa.array(gram.astype(np.int64)), "uses": pa.array(uses.astype(np.int64))}

    return map_batches(rows, run, "lang string,gram long,uses long").groupBy("lang", "gram").agg(F.sum("uses").alias("uses"))


def grams_of(data: bytes) -> np.ndarray:
    b = np.frombuffer(b"\n" * ORDER + data, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, fold: int = 2,
        most: int = DOCS_PER_LANGUAGE, part: int = LANGUAGES) -> list[bytes]:
    """The frozen model, in parts of at most ``part`` languages: see :func:`frozen`.

    It is fitted on rows whose crc32 of the key is not ``fold`` modulo ``folds``, about ``most`` per language. The
    driver holds the byte counts of that sample, which grow with the number of languages alone.
    """
    counts = gram_counts(training_rows(docs, key, text, lang, folds, fold, most)).toPandas()
    langs, grams, uses = counts["lang"].to_numpy(object), counts["gram"].to_numpy(np.int64), counts["uses"].to_numpy(np.int64)
    names = sorted(set(langs.tolist()))
    return [frozen(langs, grams, uses, names[a:a + part]) for a in range(0, max(len(names), 1), part)]


def frozen(langs: np.ndarray, grams: np.ndarray, uses: np.ndarray, only: list[str] | None = None) -> bytes:
    """Context trees as arrays: for each node (context of up to ORDER bytes) and next byte, bits per language.

    A byte that followed the context n times of N, with d distinct followers, costs -log2(n / (N + d)). Any other first
    escapes at -log2(d / (N + d)), then costs what it does after the context without its oldest byte; below the
    empty context all 256 bytes are equal. A language that never met a context passes on to the shorter one free of charge.

    ``only`` names the languages whose trees are kept. Nodes are those of all languages whichever are kept, so code lengths from
    several parts compare as those of one model do.
    """
    every = sorted(set(langs.tolist()))
    names = every if only is None else sorted(only)
    at = {name: i for i, name in enumerate(every)}
    which = np.array([at[x] for x in langs.tolist()], np.int64)
    first = at[names[0]] if names else 0  # kept languages are neighbours in name order
    parts = [(grams >> 8 * k) & 255 for k in range(ORDER + 1)]  # parts[0] is the last byte
    seen = np.unique(np.concatenate(parts)) if len(grams) else np.empty(0, np.int64)
    kind = np.zeros(256, np.int64)  # 0: a byte that no text had
    kind[seen] = np.arange(1, len(seen) + 1)
    a, count = len(seen) + 1, max(len(names), 1)
    parts = [kind[p] for p in parts]
    table, row = np.full((1, a, count), 1 / 256), np.zeros(1, np.int64)  # nodes so far; the node of each context
    for order in range(ORDER + 1):
        context = sum((parts[k + 1] * a ** k for k in range(order)), np.zeros(len(grams), np.int64))
        ids, place = np.unique(context, return_inverse=True)
        pairs, pair = np.unique(place * max(len(every), 1) + which, return_inverse=True)
        met = np.bincount(pair, weights=uses, minlength=len(pairs))
        good = np.zeros(len(ids), bool)
        good[pairs[met >= LEAST] // max(len(every), 1)] = True
        use = good[place] & (which >= first) & (which < first + count)
        place, ids = (np.cumsum(good) - 1)[place], ids[good]
        follow = np.zeros((len(ids), a, count))
        np.add.at(follow, (place[use], parts[0][use], which[use] - first), uses[use])
        whole, kinds = follow.sum(axis=1, keepdims=True), (follow > 0).sum(axis=1, keepdims=True)
        row = row[np.arange(a ** order) % a ** max(order - 1, 0)].copy()
        escape = np.where(whole > 0, kinds / np.maximum(whole + kinds, 1), 1)
        new = np.where(follow > 0, follow / np.maximum(whole + kinds, 1), escape * table[row[ids]])
        row[ids] = len(table) + np.arange(len(ids))
        table = np.concatenate([table, new])
    out = io.BytesIO()
    np.savez_compressed(out, names=np.array(names), kind=kind, rows=row.astype(np.int32), bits=(-np.log2(table)).astype(np.float32))
    return out.getvalue()


@lru_cache(maxsize=64)
def names_of(model: bytes) -> list[str]:
    with np.load(io.BytesIO(model)) as file:
        return file["names"].tolist()


@lru_cache(maxsize=1)
def loaded(model: bytes):
    with np.load(io.BytesIO(model)) as file:
        names, kind, rows, bits = (file[k] for k in ("names", "kind", "rows", "bits"))
    return names.tolist(), kind.astype(np.int32), rows, bits


def code_lengths(model: bytes, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language's tree. Texts are taken a slab of bytes at a time, long ones in parts."""
    names, kind, rows, bits = loaded(model)
    a, total = bits.shape[1], np.zeros((len(texts), bits.shape[2]))
    table = bits.reshape(-1, bits.shape[2])
    slab, owners, size = [], [], 0

    def flush():
        if not slab:
            return
        b = kind[np.frombuffer(b"".join(slab), np.uint8)]
        context = b[:-3] * (a * a) + b[1:-2] * a + b[2:-1]
        cost = table[rows[context] * np.int64(a) + b[3:]]
        sizes = np.fromiter(map(len, slab), np.int64, len(slab))
        starts = np.cumsum(sizes) - sizes  # the first positions of a part code its lead, which costs nothing
        keep = np.ones(len(b), bool)
        for k in range(ORDER):
            keep[starts + k] = False
        cost *= keep[3:, None]
        np.add.at(total, owners, np.add.reduceat(cost, np.maximum(starts - 3, 0), axis=0, dtype=np.float64))

    for i, text in enumerate(texts):
        text = b"\n" * ORDER + text
        for at in range(0, len(text) - ORDER, SLAB):
            part = text[at:at + SLAB + ORDER]
            slab.append(part)
            owners.append(i)
            size += len(part)
            if size >= SLAB:
                flush()
                slab, owners, size = [], [], 0
    flush()
    return total


def predict(docs: DataFrame, model: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: the language whose tree codes the text shortest, and its share of belief.

    The score compares the languages' mean code lengths over a message of at most 32 bytes. Null texts, and texts without
    a letter, are ``und`` with score 0; so is everything if no language was learned. Of equal code lengths the
    first language by code point wins. Parts of the model are scored in turn and their code lengths compared, so there is no
    largest number of languages. Keys may be null or repeat. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        texts, parts = texts_of(batch), sent.value
        names = [name for part in parts for name in names_of(part)]
        known = [bool(names) and bool(LETTER.search(t)) for t in texts]
        raw = [t.encode("utf-8", "replace") if k else b"" for t, k in zip(texts, known)]
        bits = np.concatenate([code_lengths(part, raw) for part in parts], axis=1)
        sizes = np.maximum([len(r) for r in raw], 1)
        gap = (bits - bits.min(axis=1, keepdims=True)) * (np.minimum(sizes, MESSAGE) / sizes)[:, None]
        score = 1 / np.exp2(-gap).sum(axis=1)
        best = bits.argmin(axis=1)
        yield {"doc_id": batch.column("doc_id"), "lang_pred": [names[b] if k else "und" for b, k in zip(best, known)],
               "score": pa.array(np.where(known, score, 0.0))}

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), run,
                       "doc_id long,lang_pred string,score double")

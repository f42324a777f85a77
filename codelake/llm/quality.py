"""Quality classifier: nearest labelled neighbours in a latent semantic space vote by similarity."""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import few_rows, map_batches, share_of, texts_of
from codelake.llm.labelled import labelled_sample

#: Labelled documents per class that the space is fitted on and that vote, by expectation.
DOCS_PER_LABEL = 1500
#: Hash buckets of words and of marks, latent dimensions, voters, and how much similarity counts.
WORDS, MARKS, DIMENSIONS, NEIGHBOURS, SHARPNESS = 3584, 512, 48, 25, 8
#: What marks weigh against words.
MARK_WEIGHT = 1.5
#: Documents whose cosines are computed at once.
BLOCK = 256
#: Score from which a document counts as good.
ACCEPT = 0.3
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of a text and their weights before the documents' frequencies are known.

    Words count by the logarithm of their uses. Marks (runs of punctuation, and words that repeat the one before, are
    all capitals, capitalised, digits or long) count by the root of their share of the tokens.
    """
    tokens = TOKEN.findall(text)
    if not tokens:
        return np.empty(0, np.int64), np.empty(0)
    uses = Counter(tokens)
    marks: Counter = Counter()
    places, weights = [], []
    for token, n in uses.items():
        if token[0].isalpha():
            places.append(zlib.crc32(token.lower().encode()) % WORDS)
            weights.append(1 + np.log(n))
            if token.isupper() and len(token) > 1:
                marks["=capitals"] += n
            elif token[0].isupper():
                marks["=capital"] += n
            if len(token) > 15:
                marks["=long"] += n
        else:
            marks["=digits" if token.isdigit() else token[:4]] += n
    marks["=again"] = sum(map(eq, tokens, tokens[1:]))
    for mark, n in marks.items():
        if n:
            places.append(WORDS + zlib.crc32(mark.encode()) % MARKS)
            weights.append(np.sqrt(n / len(tokens)))
    return np.array(places, np.int64), np.array(weights)


def rows_of(texts: list[str], rarity: np.ndarray | None) -> np.ndarray:
    """Term matrix: words by frequency and rarity in rows of length 1, marks by weight beside them."""
    out = np.zeros((len(texts), WORDS + MARKS), np.float32)
    for row, text in zip(out, texts):
        place, weight = terms(text)
        np.add.at(row, place, weight)
    if rarity is not None:
        out[:, :WORDS] *= rarity
        out[:, :WORDS] /= np.maximum(np.linalg.norm(out[:, :WORDS], axis=1, keepdims=True), 1e-9)
        out[:, WORDS:] *= MARK_WEIGHT
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def trained(texts: list[str], labels: np.ndarray, seed: int = 7) -> bytes:
    """Rarity of words, the latent space (leading right singular vectors of the term matrix), and the voters' vectors."""
    out = io.BytesIO()
    if len(texts):
        counts = np.zeros(WORDS)
        for text in texts:
            place = np.unique(terms(text)[0])
            counts[place[place < WORDS]] += 1
        rarity = np.log((len(texts) + 1) / (counts + 1)) + 0.1
        x = rows_of(texts, rarity)
        base = np.linalg.qr(x.T @ (x @ np.random.default_rng(seed).standard_normal((x.shape[1], DIMENSIONS + 16), np.float32)))[0]
        for _ in range(3):
            base = np.linalg.qr(x.T @ (x @ base))[0]
        _, _, turn = np.linalg.svd(x @ base, full_matrices=False)
        space = (base @ turn[:DIMENSIONS].T).astype(np.float32)
        np.savez(out, rarity=rarity.astype(np.float32), space=space, voters=unit(x @ space), labels=labels.astype(np.float32))
    else:
        np.savez(out, rarity=np.ones(WORDS, np.float32), space=np.zeros((WORDS + MARKS, DIMENSIONS), np.float32),
                 voters=np.zeros((0, DIMENSIONS), np.float32), labels=np.zeros(0, np.float32))
    return out.getvalue()


@lru_cache(maxsize=2)
def loaded(model: bytes):
    with np.load(io.BytesIO(model)) as file:
        return tuple(file[k] for k in ("rarity", "space", "voters", "labels"))


def scores(model: bytes, texts: list[str]) -> np.ndarray:
    """For each text the weighted share of label 1 among its nearest voters; one block of cosines at a time."""
    rarity, space, voters, labels = loaded(model)
    out = np.full(len(texts), 0.5)
    if len(voters):
        k = min(NEIGHBOURS, len(voters))
        for a in range(0, len(texts), BLOCK):
            cosine = unit(rows_of(texts[a:a + BLOCK], rarity) @ space) @ voters.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3) ** SHARPNESS
            out[a:a + BLOCK] = (weight * labels[near]).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, most: int = DOCS_PER_LABEL,
        key: str = "doc_id", text: str = "text") -> bytes:
    """The space and the voters, fitted on a bounded sample of labelled documents outside the fold."""
    rows = labelled_sample(docs, labels, label, most, folds, fold, key, text).toPandas().sort_values("doc_id")
    return trained([t or "" for t in rows["text"]], rows["label"].to_numpy())


def quality(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text.

    All cosines with the broadcast voters are computed; the nearest ones vote, weighted by similarity. The voters are a
    bounded sample (``DOCS_PER_LABEL``), so what is broadcast does not grow. Null and empty texts have no terms: all
    voters are as near, and the first of them vote. Without any labelled document every score is 0.5. Keys may be
    null or repeat. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        yield {"doc_id": batch.column("doc_id"), "score": pa.array(scores(sent.value, texts_of(batch)))}

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long,score double")


def keep_good(docs: DataFrame, model: bytes, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The documents that score at least ``accept``, with all their columns: rows are dropped in the Arrow batches."""
    few_rows(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(sent.value, texts_of(batch, text)) >= accept))

    return docs.mapInArrow(run, docs.schema)


def held_out(key, folds: int, fold: int):
    return share_of(key, folds) == fold

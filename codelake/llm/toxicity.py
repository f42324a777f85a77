"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks."""

from __future__ import annotations

import io
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import map_batches, texts_of
from codelake.llm.labelled import labelled_sample

#: Labelled documents per class that the machine is fitted on, by expectation, and their longest text.
DOCS_PER_LABEL, LONGEST = 1500, 4000
#: Kinds of characters: 0 white space, 1-26 ASCII letters of either case, 27 other digits, 28 marks, 32-63 other letters.
#: Digits that stand for letters count as these. Characters that are not seen (zero width, joined accents) are left out.
KINDS = 64
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: A subsequence has three characters; up to one may stand between neighbours, at this decay a character.
GAPS, DECAY = ((1, 1), (1, 2), (2, 1), (2, 2)), 0.6
SPAN = 4
#: A sentence is scored by its strongest stretch of this many starts of subsequences.
STRETCH = 7
#: Characters that the parts of a long text share: room for a stretch whose letters stand far apart.
SHARED = 4096
LANDMARKS, ROUNDS, PENALTY = 240, 4, 10.0
#: Machines, each with landmarks of its own draw, whose mean counts: one alone depends much on its draw.
DRAWS = 4
SLAB = 1 << 20
#: Score from which a document counts as toxic.
REJECT = 0.7


MARK, UNSEEN = 28, -1


def character_kinds() -> np.ndarray:
    """The kind of each character of the first two planes; the last entry is for all others, which are mostly ideographs."""
    kind = np.full(0x20001, MARK, np.int32)
    for i in range(26):
        kind[65 + i] = kind[97 + i] = i + 1
    kind[48:58] = 27
    for mark, letter in LEET.items():
        kind[ord(mark)] = ord(letter) - 96
    kind[[9, 10, 11, 12, 13, 32]] = 0
    for code in range(0x80, 0x20000):
        group = unicodedata.category(chr(code))
        if group == "Cf" or 0x300 <= code < 0x370 or 0xFE00 <= code < 0xFE10:
            kind[code] = UNSEEN
        elif group[0] in "LM":
            kind[code] = 32 + code % 32  # É and é are 32 apart, and so are most letters of either case
        elif group[0] == "Z" or code == 0x85:
            kind[code] = 0
        elif group[0] == "N":
            kind[code] = 27
    kind[-1] = 32
    return kind


KIND = character_kinds()
PAD = " " * (SPAN + STRETCH)


def apart(kinds: np.ndarray) -> np.ndarray:
    """Which characters only keep the letters of a word apart.

    These are marks between two letters, however many, and whatever stands between letters that are words of their own.
    """
    letters = np.flatnonzero((kinds != 0) & (kinds != MARK))
    gap = np.diff(letters) - 1
    blank = np.diff(np.cumsum(kinds == 0)[letters]) > 0
    alone = np.concatenate([[True], blank]) & np.concatenate([blank, [True]])
    drop = (gap > 0) & (~blank | (alone[:-1] & alone[1:] & (gap < len(PAD))))
    step = np.zeros(len(kinds) + 1, np.int8)
    step[letters[:-1][drop] + 1] += 1
    step[letters[1:][drop]] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) > 0


def between(kinds: np.ndarray) -> np.ndarray:
    """Every second letter of words of five or more in which these are all the same: one put between all others."""
    letters = (kinds != 0) & (kinds != MARK)
    first = letters & ~np.concatenate([[False], letters[:-1]])
    at, starts = np.flatnonzero(letters), np.flatnonzero(first)
    word = np.cumsum(first)[at] - 1
    place = at - starts[word]
    other = (place % 2 == 1) & (place > 2) & (kinds[at] != kinds[np.maximum(at - 2, 0)])
    put = (np.bincount(word, minlength=len(starts)) >= 5) & (np.bincount(word[other], minlength=len(starts)) == 0)
    out = np.zeros(len(kinds), bool)
    out[at[(place % 2 == 1) & put[word]]] = True
    return out


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of all characters, and where each text starts: with blanks of its own, so many that its stretches end before
    the next text's first character."""
    sizes = np.fromiter((len(t) + len(PAD) for t in texts), np.int64, len(texts))
    kinds, starts = KIND[np.minimum(np.frombuffer(PAD.join(["", *texts, ""]).encode("utf-32-le"), "<u4"), len(KIND) - 1)], np.cumsum(sizes) - sizes
    for left_out in (lambda k: k == UNSEEN, apart):
        kinds, starts = without(kinds, starts, left_out(kinds))
    return kinds, starts


def without(kinds: np.ndarray, starts: np.ndarray, left_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return kinds[~left_out], starts - np.concatenate([[0], np.cumsum(left_out)])[starts]


def subsequences(kinds: np.ndarray):
    """For each gap pattern: its decay and, by start, the number of the subsequence."""
    n = len(kinds) - SPAN
    first = kinds[:n] * (KINDS * KINDS)
    for a, b in GAPS:
        yield DECAY ** (a + b - 2), first + kinds[a:a + n] * KINDS + kinds[a + b:a + b + n]


def stretches(kinds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The linear function of each stretch: weights of its subsequences, by decay, summed over its starts."""
    value = sum(decay * weights[code] for decay, code in subsequences(kinds))
    run = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
    return run[STRETCH:] - run[:-STRETCH]


def strongest(kinds: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each text its highest value, with and without letters put between all others of a word."""
    plain = np.maximum.reduceat(stretches(kinds, weights), starts)
    kinds, starts = without(kinds, starts, between(kinds))
    return np.maximum(plain, np.maximum.reduceat(stretches(kinds, weights), starts))


def best_stretch(kinds: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text its highest value, and where that stretch starts."""
    value = stretches(kinds, weights)
    top = np.maximum.reduceat(value, starts)
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(value))))
    hits = np.flatnonzero(value[: len(owner)] >= top[owner])
    place = np.full(len(starts), -1)
    place[owner[hits][::-1]] = hits[::-1]
    return top, place


def features(kinds: np.ndarray, places: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Compact numbers of the subsequences in the stretches at ``places``: (stretch, start, pattern); 0 is any other."""
    n, starts = len(kinds) - SPAN, places[:, None] + np.arange(STRETCH)
    return np.stack([index[code[np.minimum(starts, n - 1)]] for _, code in subsequences(kinds)], axis=2)


DECAYS = np.array([DECAY ** (a + b - 2) for a, b in GAPS])


def kernel(left: np.ndarray, landmark_table: np.ndarray) -> np.ndarray:
    """Kernel of stretches (as compact subsequences) with all landmarks, a block at a time."""
    out = np.empty((len(left), landmark_table.shape[1]))
    for a in range(0, len(left), 500):
        out[a:a + 500] = np.einsum("ispl,p->il", landmark_table[left[a:a + 500]], DECAYS, optimize=True)
    return out


def machine(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 30) -> np.ndarray:
    """Linear support vector machine (squared hinge, classes of equal weight) by Newton steps; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign, cost = np.where(y == 1, 1.0, -1.0), np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * penalty * len(y) / 100
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    for _ in range(steps):
        inside = sign * (x @ w) < 1
        part = x[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + part.T @ x[inside], part.T @ sign[inside])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def trained(texts: list[bytes], labels: np.ndarray, landmarks: int = LANDMARKS, rounds: int = ROUNDS, seed: int = 7,
            draws: int = DRAWS) -> bytes:
    """Fit on labelled documents, whose sentences share their label only if it is 0.

    A toxic document's label holds for its strongest stretch alone. The first guess of that weighs subsequences by
    how much more often toxic documents have them; then, round by round, landmarks are drawn from the strongest
    stretches, the machine is fitted on Nyström features of toxic documents' strongest stretches against harmless
    documents' strongest and random ones, and strongest stretches are looked for again. As the kernel is an inner
    product over subsequences, landmarks and machine fold into one weight per subsequence. This is done ``draws`` times;
    the mean counts of those that fit the sample at most twice as badly as the best, as some draws miss the insults.
    """
    out = io.BytesIO()
    if not (labels == 1).any() or not (labels == 0).any():
        np.savez(out, weights=np.zeros(KINDS ** 3, np.float32), scale=np.array([0.0, 0.0 if not len(labels) else 20.0 * labels.mean() - 10.0]))
        return out.getvalue()
    kinds, starts = joined([t.decode("utf-8", "replace") for t in texts])
    random = np.random.default_rng(seed)
    room = np.diff(np.append(starts, len(kinds)))
    sizes, owner = room - len(PAD), np.repeat(np.arange(len(texts)), room)
    has = np.zeros((2, KINDS ** 3))
    for _, code in subsequences(kinds):
        pairs = np.unique(owner[: len(code)] * np.int64(KINDS ** 3) + code)
        for label in (0, 1):
            has[label] += np.bincount(pairs[labels[pairs // KINDS ** 3] == label] % KINDS ** 3, minlength=KINDS ** 3)
    share = (has + 1) / (np.array([[(labels == 0).sum()], [(labels == 1).sum()]]) * len(GAPS) + 2)
    guess, found = np.maximum(np.log(share[1] / share[0]), 0) * (has[1] >= 5), []
    harmless, toxic = np.flatnonzero(labels == 0), np.flatnonzero(labels == 1)
    for turn in range(draws * rounds):
        if turn % rounds == 0:
            weights, pool = guess, []
        _, place = best_stretch(kinds, starts, weights)
        pool.append(place[harmless])
        pool.append(starts[harmless] + len(PAD) + (random.random(len(harmless)) * np.maximum(sizes[harmless] - SPAN, 1)).astype(np.int64))
        negative = np.unique(np.concatenate(pool))
        positive = place[toxic]
        chosen = np.concatenate([random.choice(positive, min(len(positive), landmarks * 3 // 4), replace=False),
                                 random.choice(negative, min(len(negative), landmarks // 4), replace=False)])
        codes = np.unique(np.concatenate([code[np.minimum(chosen[:, None] + np.arange(STRETCH), len(code) - 1)].ravel() for _, code in subsequences(kinds)]))
        index = np.zeros(KINDS ** 3, np.int64)
        index[codes] = np.arange(1, len(codes) + 1)
        own = features(kinds, chosen, index)
        table = np.zeros((len(codes) + 1, len(chosen)))
        np.add.at(table, (own.reshape(len(chosen), -1), np.arange(len(chosen))[:, None]), np.tile(DECAYS, STRETCH))
        table[0] = 0
        values, vectors = np.linalg.eigh(kernel(own, table))
        keep = values > values.max() * 1e-6
        root = vectors[:, keep] / np.sqrt(values[keep])
        at = np.concatenate([positive, negative])
        y = np.r_[np.ones(len(positive)), np.zeros(len(negative))]
        w = machine(kernel(features(kinds, at, index), table) @ root, y)
        weights = np.zeros(KINDS ** 3)
        weights[codes] = (table @ (root @ w[:-1]))[1:]
        if turn % rounds == rounds - 1:
            found.append((loss(strongest(kinds, starts, weights), labels), weights))
    least = min(x for x, _ in found)
    total = np.mean([w for x, w in found if x <= 2 * least], axis=0)
    np.savez(out, weights=total.astype(np.float32), scale=np.array(logistic(strongest(kinds, starts, total), labels)))
    return out.getvalue()


def logistic(value: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn a value into a probability, classes of equal weight, slightly smoothed."""
    x, (pos, neg) = np.stack([value, np.ones(len(value))], axis=1), ((labels == 1).sum(), (labels == 0).sum())
    target = np.where(labels == 1, 1 - 1 / (pos + 2), 1 / (neg + 2))
    weight, w = np.where(labels == 1, 0.5 / pos, 0.5 / neg), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (target - p)) - 1e-4 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 4 / max(abs(step).max(), 1e-9))
    return float(w[0]), float(w[1])


def loss(value: np.ndarray, labels: np.ndarray) -> float:
    """Logarithmic loss of the fitted probability, classes of equal weight."""
    slope, offset = logistic(value, labels)
    each = np.logaddexp(0, np.where(labels == 1, -1, 1) * (value * slope + offset))
    return float(each[labels == 1].mean() + each[labels == 0].mean()) / 2


@lru_cache(maxsize=2)
def loaded(model: bytes):
    with np.load(io.BytesIO(model)) as file:
        return file["weights"], file["scale"]


def scores(model: bytes, texts: list[bytes]) -> np.ndarray:
    weights, scale = loaded(model)
    top = np.full(len(texts), -np.inf)
    slab, owners, size = [], [], 0

    def flush():
        if slab:
            np.maximum.at(top, owners, strongest(*joined(slab), weights))

    for i, text in enumerate(t.decode("utf-8", "replace") for t in texts):
        for at in range(0, max(len(text), 1), SLAB):  # parts of a long text share a stretch's length
            part = text[max(at - SHARED, 0):at + SLAB]
            slab.append(part)
            owners.append(i)
            size += len(part)
            if size >= SLAB:
                flush()
                slab, owners, size = [], [], 0
    flush()
    return 1 / (1 + np.exp(-np.clip(top * scale[0] + scale[1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, fold: int = 1, most: int = DOCS_PER_LABEL,
        longest: int = LONGEST, key: str = "doc_id", text: str = "text") -> bytes:
    """The machine, fitted on a bounded sample of labelled documents outside the fold."""
    rows = labelled_sample(docs, labels, label, most, folds, fold, key, text, longest).toPandas().sort_values("doc_id")
    return trained([t.encode("utf-8", "replace") for t in rows["text"]], rows["label"].to_numpy(np.int64))


def toxicity(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every whole text: how likely its strongest stretch makes it toxic.

    Null and empty texts are scored as blanks. A model fitted without one of the classes gives every text the same
    score. Keys may be null or repeat. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        found = scores(sent.value, [t.encode("utf-8", "replace") for t in texts_of(batch)])
        yield {"doc_id": batch.column("doc_id"), "score": pa.array(found)}

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long,score double")

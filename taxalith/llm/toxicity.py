"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams (of ``<word>``, hashed into a fixed table), a window's
vector the mean over its words, and a two-class linear softmax reads it; embeddings and softmax weights are trained
together by full-batch gradient steps with momentum, scaled to the largest entry, so that an n-gram moves by how much of
the classes it explains; n-grams that hardly any row has stay at zero. A document is as toxic as its most toxic window of ``WINDOW`` words: training starts from the
mean over all windows and then follows each document's strongest windows. Unseen misspellings share n-gram vectors with the
words seen. A held-back fifth of the training rows calibrates the logit (bias and slope), so that 0.7 is a usable cut.

Labels are learnt from a bounded sample (``max_rows`` labelled rows per class, smallest hash of the id first) in one task;
an id with both labels counts as toxic. Null and empty texts are one empty window: their score is that of the bias alone. A
null or repeated id, and a repeated row, is scored like any other, rows of equal text alike. Very long texts are scored whole.
An empty table gives no rows; with no labels every score is 0.5, so that nothing is rejected. ``without_toxic`` keeps all
columns as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, columns, crc_mod, labelled, release, slices, table, text_of, trained_in_task

BUCKETS, DIM, SMALLEST, LARGEST, WINDOW = 1 << 18, 8, 3, 6, 6
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
CACHE, GROUP = 200_000, 256
SEED, FOLD = 7, 25
PRIME, MIX, SHIFT = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15), np.uint64(46)


class Model(NamedTuple):
    """weights: per bucket, the difference of the two classes' logits; slope and bias turn a window's mean into log odds."""

    weights: np.ndarray
    slope: float
    bias: float


def gram_table(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams (each ``<word>``'s, and the word itself), the word each belongs to, and their number by word.

    Punctuation at a word's edges doesn't count unless the word is nothing else.
    """
    marked = [f"<{w.strip(EDGES) or w}>" for w in words]
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(n)), n)
    at = np.concatenate(([0], np.cumsum(n)))
    left = at[word + 1] - np.arange(len(code))
    rolled, ids, owners = np.zeros(len(code), np.uint64), [], []
    for k in range(1, min(LARGEST, len(code)) + 1):
        rolled[: len(code) - k + 1] = rolled[: len(code) - k + 1] * PRIME + code[k - 1 :] if k > 1 else code
        if k >= SMALLEST:
            fits = np.flatnonzero(left >= k)
            ids.append(((rolled[fits] + np.uint64(k)) * MIX) >> SHIFT)
            owners.append(word[fits])
    place = np.arange(len(code)) - at[word]
    powers = np.cumprod(np.concatenate(([1], np.full(int(n.max(initial=1)), int(PRIME), np.uint64))).astype(np.uint64))
    whole = np.add.reduceat(code * powers[place], at[:-1]) if len(n) else np.zeros(0, np.uint64)
    ids.append((whole * MIX) >> SHIFT)
    owners.append(np.arange(len(n)))
    owner = np.concatenate(owners)
    return np.concatenate(ids).astype(np.int64), owner, np.bincount(owner, minlength=len(n))


def grams_in_parts(words: list[str], size: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """gram_table of many words, part by part and in 32-bit numbers, which takes less room."""
    parts = []
    for i in range(0, len(words), size):
        bucket, owner, n = gram_table(words[i : i + size])
        parts.append((bucket.astype(np.int32), (owner + i).astype(np.int32), n.astype(np.int32)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def summed(place: np.ndarray, values: Callable[[slice], np.ndarray], n: int, size: int = 100_000) -> np.ndarray:
    """np.bincount(place, values, n) in the same order of additions, with the values made part by part, which takes less room."""
    out = np.zeros(n)
    for i in range(0, len(place), size):
        np.add.at(out, place[i : i + size].astype(np.intp), values(slice(i, i + size)))
    return out


def train(texts: list[str], labels: list[int], epochs: int = 80, warm: int = 30, rate: float = 0.3, decay: float = 0.03) -> Model:
    """Fits embeddings and softmax together. One class only, or no rows: every score is that class's smoothed share."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max() or not any(map(words_of, texts)):
        p = (y.sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(BUCKETS, np.float32), 0.0, float(np.log(p / (1 - p))))
    known: dict[str, int] = {}
    bags = [np.fromiter((known.setdefault(w, len(known)) for w in words_of(t)), np.int32) for t in texts]
    del texts
    bucket, owner, gram_n = grams_in_parts(list(known))
    known.clear()
    spread = np.zeros(len(gram_n))
    for b in bags:
        spread[np.unique(b)] += 1
    used = np.flatnonzero(summed(bucket, lambda s: spread[owner[s]], BUCKETS) >= np.clip(len(y) / 100, 5, 40))
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    gram = place[bucket]
    del bucket
    often = gram >= 0
    gram, owner = gram[often], owner[often]
    del often
    token = np.concatenate(bags)
    sizes = np.array([len(b) for b in bags])
    del bags
    windows = np.maximum(1, -(-sizes // WINDOW))
    doc_of_window = np.repeat(np.arange(len(y), dtype=np.int32), windows)
    first = np.concatenate(([0], np.cumsum(windows)[:-1]))
    window_n = np.clip(sizes[doc_of_window] - (np.arange(len(doc_of_window)) - first[doc_of_window]) * WINDOW, 0, WINDOW)
    window_of_token = np.repeat(np.arange(len(window_n), dtype=np.int32), window_n)
    share = 1 / np.maximum(1, window_n)
    rng = np.random.default_rng(SEED)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))[used]
    soft = rng.normal(0, 0.5, (DIM, 2))
    bias = np.zeros(2)
    held = rng.random(len(y)) < 0.2
    weight = np.where(y == 1, 0.5 / max(1, (y[~held] == 1).sum()), 0.5 / max(1, (y[~held] == 0).sum())) * ~held
    speed = [np.zeros_like(p) for p in (emb, soft, bias)]

    def logits() -> tuple[np.ndarray, np.ndarray]:
        per_gram = emb @ (soft[:, 1] - soft[:, 0])
        per_word = summed(owner, lambda s: per_gram[gram[s]], len(gram_n)) / gram_n
        return per_gram, summed(window_of_token, lambda s: per_word[token[s]], len(window_n)) * share

    for epoch in range(1, epochs + 1):
        _, per_window = logits()
        if epoch <= warm:
            focus = 1 / windows[doc_of_window]
        else:
            sharp = np.exp(np.clip((per_window - np.maximum.reduceat(per_window, first)[doc_of_window]) * 4, -40, 0))
            focus = sharp / np.add.reduceat(sharp, first)[doc_of_window]
        z = np.add.reduceat(per_window * focus, first) + bias[1] - bias[0]
        delta = (sigmoid(z) - y) * weight
        to_window = delta[doc_of_window] * focus * share
        to_word = summed(token, lambda s: to_window[window_of_token[s]], len(gram_n)) / gram_n
        to_gram = summed(gram, lambda s: to_word[owner[s]], len(used))
        lean = soft[:, 1] - soft[:, 0]
        d_lean = to_gram @ emb
        grads = (np.outer(to_gram, lean), np.stack([-d_lean, d_lean], 1), np.array([-delta.sum(), delta.sum()]))
        for p, g, v, r in zip((emb, soft, bias), grads, speed, (rate, rate / 20, rate / 20)):
            v *= 0.8
            v -= r * g / max(np.abs(g).max(initial=0), 1e-12)
            p += v
        emb *= 1 - decay
    per_gram, per_window = logits()
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = per_gram
    top = np.maximum.reduceat(per_window, first)
    if min((y[held] == 1).sum(), (y[held] == 0).sum()) < FOLD:
        held = np.ones(len(y), bool)
    slope, offset = calibrated(top[held], y[held])
    return Model(weights, slope, offset)


def calibrated(z: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and bias of a logistic fit of y on z, by damped Newton steps with a small ridge on the scaled slope."""
    mid, wide = z.mean(), z.std() + 1e-9
    x = np.stack([(z - mid) / wide, np.ones_like(z)], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) + np.array([0.05, 0]) * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.05, 1e-6])
        step = np.linalg.solve(h, g)
        w -= step / max(1, np.abs(step).max())
    return float(max(w[0], 0) / wide), float(w[1] - w[0] * mid / wide)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > CACHE:
            self.known.clear()
        gram, owner, n = gram_table(new := list(words - self.known.keys()))
        self.known.update(zip(new, (np.bincount(owner, self.model.weights[gram], len(n)) / np.maximum(n, 1)).tolist()))

    def __call__(self, texts: list[str | None]) -> list[float]:
        """Scores of whole texts, looked up in groups so that a group's new words are hashed together."""
        out = []
        for i in range(0, len(texts), GROUP):
            lists = [words_of(t) for t in texts[i : i + GROUP]]
            self.learn(set().union(*lists))
            for words in lists:
                if not words:
                    out.append(float(sigmoid(self.model.bias)))
                    continue
                each = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
                at = np.arange(0, len(words), WINDOW)
                mean = np.add.reduceat(each, at) / np.minimum(WINDOW, len(words) - at)
                out.append(float(sigmoid(self.model.slope * mean.max() + self.model.bias)))
        return out


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 3000) -> Model:
    """Learns from at most max_rows labelled rows of each class outside fold 1 of 3, in one task."""
    return Model(*trained_in_task(labelled(documents, labels, "toxic", max_rows, SEED), train))


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score(documents: DataFrame, model: Model, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from cut up) of every row's whole text."""

    def rows(batches):
        scorer = Scorer(model)
        for ids, held, texts in columns(batches, "doc_id", "held_out", "text"):
            s = scorer(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "held_out": held, "score": s, "predicted": [int(x >= cut) for x in s]}, schema=arrow_schema(SCORES))
        scorer.known.clear()
        release()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), text_of(documents).alias("text")).mapInArrow(rows, SCORES)


def toxic_documents(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(documents, table(spark, sf_dir, "labels")))


def without_toxic(documents: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """documents whose score stays below cut, with all their columns."""
    model = fit(documents, labels)

    def rows(batches):
        scorer = Scorer(model)
        for batch in slices(batches):
            s = scorer(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield batch.filter(pa.array([x < cut for x in s], pa.bool_()))
        scorer.known.clear()
        release()

    return documents.mapInArrow(rows, documents.schema)

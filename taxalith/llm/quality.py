"""Quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates.

A text is two parallel token streams: its lower-cased words, and the words' shapes (runs of upper case, lower case, digits
and each other sign, at most two long; a word equal to the one before is ``=``). Words of more than ``LONG`` characters or
of a script without spaces are cut into pieces: signs of such scripts one by one, other runs of a class up to ``RUN`` long. Unigrams and bigrams of both streams are
hashed into a fixed table; a feature's value is ``SCALE`` times its share of the text's words, so the score is a sparse dot
product. FTRL-proximal updates (per-coordinate rates, L1 and L2) run over a bounded sample of labelled rows (``max_rows``
per class, smallest hash of the id first) in one task; an id with both labels counts as good. Null and empty texts hold no
features: their score is that of the bias. A null or repeated id, and a repeated row, is scored like any other, rows of equal
text alike. Very long texts are scored whole. An empty table gives no rows; with no labels every score is 0.5.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, bounded, columns, crc_mod, labelled, table, text_of, trained_in_task

BITS, SCALE, CACHE, SEED = 20, 10.0, 200_000, 11
SHIFT = np.uint64(64 - BITS)
MIX = np.uint64(0x9E3779B97F4A7C15)
SAME = zlib.crc32(b"=")
CLASSES = re.compile(r"[^\W\d_]+|\d+|_+|\W", re.UNICODE)
LONG, RUN = 64, 16
#: Thai, Lao, Tibetan, Burmese, Khmer, kana and Chinese characters.
_BARE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
BARE = re.compile(f"[{_BARE}]")
PIECES = re.compile(rf"[{_BARE}]|[^\W\d_{_BARE}]{{1,{RUN}}}|\d{{1,{RUN}}}|_{{1,{RUN}}}|\W")


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def shape(word: str) -> str:
    """Character classes in order of a word, each run at most two long."""
    out = []
    for run in CLASSES.findall(word):
        if run[0].isalpha():
            sign = "A" if run.isupper() else "a" if run.islower() else "Aa"
            sign = sign * 2 if len(run) > 1 and len(sign) == 1 else sign
        else:
            sign = "0" if run[0].isdigit() else run[0]
        if out[-2:] != [sign, sign]:
            out.append(sign)
    return "".join(out)


def coded(word: str) -> int:
    """Hash of the lower-cased word in the high half, of its shape in the low half."""
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) << 32 | zlib.crc32(shape(word).encode("utf-8", "surrogatepass"))


def words_of(text: str) -> list[str]:
    """Words between spaces, and the pieces of those that are long or hold signs of a script without spaces."""
    words = text.split()
    bare = not text.isascii() and BARE.search(text) is not None
    if bare or len(max(words, key=len, default="")) > LONG:
        return [p for w in words for p in (PIECES.findall(w) if len(w) > LONG or bare and BARE.search(w) else (w,))]
    return words


class Features:
    def __init__(self):
        self.known: dict[str, int] = {}

    def code(self, word: str) -> int:
        got = self.known.get(word)
        if got is None:
            bounded(self.known, CACHE)
            got = self.known[word] = coded(word)
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, int]:
        """Table places of all n-gram occurrences of a text, and its number of words."""
        words = words_of(text or "")
        if not words:
            return np.zeros(0, np.int64), 0
        try:
            both = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            both = np.fromiter(map(self.code, words), np.uint64, len(words))
        word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        form[1:][both[1:] == both[:-1]] = SAME
        keys = np.concatenate([word * np.uint64(2) + np.uint64(1), (form + np.uint64(1 << 40)) * np.uint64(2), ((word[:-1] * np.uint64(0x85EBCA6B)) ^ word[1:]) + np.uint64(1 << 50), ((form[:-1] * np.uint64(0xC2B2AE35)) ^ form[1:]) + np.uint64(1 << 51)])
        return ((keys * MIX) >> SHIFT).astype(np.int64), len(words)


def train(texts: list[str], labels: list[int], alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 3) -> Model:
    """FTRL-proximal over the rows in seeded order; the last weight is the bias. No rows: every score is 0.5."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    features, rows = Features(), []
    for text, label in zip(texts, labels):
        at, words = features(text)
        at, count = np.unique(at, return_counts=True)
        rows.append((np.append(at, size), np.append(count * (SCALE / max(1, words)), 1.0), label))

    def weights(at):
        got = z[at]
        w = -(got - np.sign(got) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(got) <= l1, 0.0, w)

    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, label = rows[i]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -40, 40))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.features = model, Features()

    def __call__(self, text: str | None) -> float:
        at, words = self.features(text)
        dot = self.model.bias + SCALE * float(self.model.weights[at].sum(dtype=np.float64)) / max(1, words)
        return float(1 / (1 + np.exp(-np.clip(dot, -40, 40))))


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 3000) -> Model:
    """Learns from at most max_rows labelled rows of each class outside fold 1 of 3, in one task."""
    return Model(*trained_in_task(labelled(documents, labels, "quality", max_rows, SEED), train))


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score(documents: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from cut up) of every row's whole text."""

    def rows(batches):
        scorer = Scorer(model)
        for ids, held, texts in columns(batches, "doc_id", "held_out", "text"):
            s = [scorer(t) for t in texts]
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "held_out": held, "score": s, "predicted": [int(x >= cut) for x in s]}, schema=arrow_schema(SCORES))

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), text_of(documents).alias("text")).mapInArrow(rows, SCORES)


def quality_documents(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(documents, table(spark, sf_dir, "labels")))

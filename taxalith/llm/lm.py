"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

P(w | h) = a(b) c(h w) / c(h) + b(b) c(w) / N + g(b) / (V + 1), where the three weights depend on the bucket b of the
context's frequency (its binary logarithm). They are learnt by expectation-maximisation on held-out counts: every training
token is scored by the counts of all others (each count less one, bucket by the context's count less one), which is the
deleted estimate with one token a fold. Counts cover all training documents: those with crc32 of the id mod 10 not 0.

Words and bigrams are 64-bit hashes. Batches of documents are encoded once and staged; their distinct words and bigrams go
to parts of the key space and come back with totals (see ``exchange``), so what is gathered grows with the corpus, no task
holds a frequent word's rows, and the driver sees only sums over a bounded grid of (bucket, estimate, estimate).

Tokens are the words of a text, A-Z lower-cased, and one end; the first word's context is an end. Null and empty texts are an
end alone. A null id is in no fold and so in training. Repeated rows count and are scored as often as they come; ties do not
arise. Very long texts are scored whole. With no training tokens every probability is uniform; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, columns, crc_mod, release, staged, table, text_of, unstage
from taxalith.llm.exchange import REQUESTS, answered, by_batch, met, part_bits, planes, requests, totals_of, unplanes

FOLDS, BATCH_CHARS, ROUNDS, STEP, FLOOR = 10, 2_500_000, 60, 8, -12.0
END = np.uint64(0)
BATCHES = "batch long, doc_ids array<long>, held array<boolean>, sizes array<int>, tokens binary, words binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
CELLS = "bucket int, bigram int, unigram int, n double, p2 double, p1 double"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def encoded(documents: DataFrame) -> DataFrame:
    """Batches of about BATCH_CHARS characters: each token's place in the batch's vocabulary, and that vocabulary's hashes."""

    def rows(batches):
        import itertools

        from pyspark import TaskContext

        number = itertools.count(TaskContext.get().partitionId() << 32)
        schema = arrow_schema(BATCHES)

        def flush():
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in known), np.uint64, len(known))
            values = (next(number), ids, held, sizes, planes(np.concatenate(tokens)), planes(hashes))
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(schema.names, values)}, schema=schema)

        ids, held, sizes, tokens, chars, known = [], [], [], [], 0, {b"": 0}
        for keys, outs, texts in columns(batches, "doc_id", "held_out", "text"):
            for key, out, text in zip(keys, outs, texts):
                words = words_of(text)
                place = np.zeros(len(words) + 1, np.uint32)
                for w in words:
                    if w not in known:
                        known[w] = len(known)
                place[:-1] = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
                ids.append(key)
                held.append(out)
                sizes.append(len(place))
                tokens.append(place)
                chars += len(text)
                if chars >= BATCH_CHARS:
                    yield flush()
                    ids, held, sizes, tokens, chars, known = [], [], [], [], 0, {b"": 0}
        if ids:
            yield flush()

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod(F.col("doc_id"), FOLDS) == 0).alias("held_out"), text_of(documents).alias("text"))
    return chosen.mapInArrow(rows, BATCHES)


class Batch:
    """A batch's arrays: word and context place by token, and its distinct words and bigrams in the order of their keys."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        get = lambda n: batch.column(batch.schema.get_field_index(n))[i]
        self.number = get("batch").as_py()
        self.ids, self.held = get("doc_ids").as_py(), np.array(get("held").as_py(), bool)
        self.sizes = np.array(get("sizes").as_py(), np.int64)
        self.word = unplanes(get("tokens").as_py(), np.uint32)
        hashes = unplanes(get("words").as_py(), np.uint64)
        starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.starts = starts
        self.context = np.roll(self.word, 1)
        self.context[starts] = 0
        self.training = np.repeat(~self.held, self.sizes)
        self.words, place = np.unique(hashes, return_inverse=True)
        self.word_place = place.astype(np.int32)
        mixed = ((hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))[self.context]
        mixed += (hashes * np.uint64(0x94D049BB133111EB))[self.word]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        self.bigrams, place = np.unique(mixed, return_inverse=True)
        self.bigram_place = place.astype(np.int32)

    def asked(self, bits: int) -> list[tuple]:
        word = np.bincount(self.word_place[self.word[self.training]], minlength=len(self.words))
        bigram = np.bincount(self.bigram_place[self.training], minlength=len(self.bigrams))
        return requests(self.number, self.words, word, bits) + requests(self.number, self.bigrams, bigram, bits, 1 << bits)

    def counts(self, replies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(h w), c(h), c(w) of every token."""
        totals = totals_of(replies).astype(np.float64)
        word = totals[: len(self.words)][self.word_place]
        return totals[len(self.words) :][self.bigram_place], word[self.context], word[self.word]


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Batch, list[bytes]]]:
    for batch in batches:
        at = batch.schema.get_field_index("replies")
        for i in range(batch.num_rows):
            yield Batch(batch, i), batch.column(at)[i].as_py() if at >= 0 else []  # the caller's batch goes before the next one comes
    release()


def buckets(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else one more than the binary logarithm."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def grid(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.rint(np.log10(np.maximum(p, 10.0**FLOOR)) * STEP), FLOOR * STEP - 1).astype(np.int64)


def cells(joined: DataFrame, tokens: int, kinds: int) -> DataFrame:
    """Held-out counts: by bucket and grid cell, how many training tokens lie there and the sums of their estimates."""

    def rows(batches):
        schema = arrow_schema(CELLS)
        for b, replies in each(batches):
            c2, ch, cw = (c[b.training] - 1 for c in b.counts(replies))
            p2 = np.where(ch > 0, np.maximum(c2, 0) / np.maximum(ch, 1), 0.0)
            p1 = np.maximum(cw, 0) / max(1, tokens - 1)
            del b, replies, c2, cw
            key = (buckets(np.maximum(ch, 0)) * 1000 - grid(p2)) * 1000 - grid(p1)
            key, place = np.unique(key, return_inverse=True)
            sums = [np.bincount(place, w, len(key)) for w in (np.ones(len(place)), p2, p1)]
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, (key // 1_000_000, key // 1000 % 1000, key % 1000, *sums))), schema=schema)

    return joined.mapInArrow(rows, CELLS).groupBy("bucket", "bigram", "unigram").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1"))


def weights(rows: list, kinds: int) -> dict[int, tuple[float, float, float]]:
    """Mixture weights by bucket, by expectation-maximisation from equal parts; bucket 0 has no bigram part."""
    out = {}
    for bucket in {r.bucket for r in rows}:
        own = [r for r in rows if r.bucket == bucket]
        n = np.array([r.n for r in own])
        parts = np.stack([np.array([r.p2 for r in own]) / n, np.array([r.p1 for r in own]) / n, np.full(len(own), 1 / (kinds + 1))])
        w = np.array([1 / 3, 1 / 3, 1 / 3]) if bucket else np.array([0, 0.5, 0.5])
        for _ in range(ROUNDS):
            share = w[:, None] * parts
            w = (share / share.sum(0) * n).sum(1) / n.sum()
        w = np.maximum(w, [0 if not bucket else 1e-6, 1e-6, 1e-6])
        out[bucket] = tuple((w / w.sum()).tolist())
    return out


def lm_scores(documents: DataFrame) -> DataFrame:
    """One row per document with its counts, the add-0.1 unigram score and the model's log10 probability."""
    stored = staged(encoded(documents))
    size = stored.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).first().n or 0
    bits = part_bits(size)

    def ask(batches):
        schema = arrow_schema(REQUESTS)
        for b, _ in each(batches):
            asked = b.asked(bits)
            del b
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in asked] for i, n in enumerate(schema.names)}, schema=schema)

    replies = staged(answered(stored.mapInArrow(ask, REQUESTS)))
    kinds, tokens = met(replies, 1 << bits)
    joined = staged(stored.join(by_batch(replies), "batch"))
    unstage(stored, replies)
    mixture = weights(cells(joined, tokens, kinds).collect(), kinds)
    last = (0.0, 0.5, 0.5)
    by_bucket = np.array([mixture.get(b) or mixture.get(max((x for x in mixture if 0 < x < b), default=0)) or last for b in range(70)])
    by_bucket[0] = mixture.get(0, (0.0, *by_bucket[1][1:] / max(by_bucket[1][1:].sum(), 1e-12)))

    def score(batches):
        schema = arrow_schema(SCORES)
        for b, got in each(batches):
            c2, ch, cw = b.counts(got)
            w = by_bucket[buckets(ch)]
            p = w[:, 0] * c2 / np.maximum(ch, 1) + w[:, 1] * cw / max(1, tokens) + w[:, 2] / (kinds + 1)
            base = np.log10((cw + 0.1) / (tokens + 0.1 * (kinds + 1)))
            known, base, full = (np.add.reduceat(x, b.starts) for x in ((cw > 0).astype(np.int64), base, np.log10(p)))
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, (b.ids, b.held, b.sizes, known, np.full(len(b.ids), tokens), base, full))), schema=schema)
            del b, got, c2, ch, cw, w, p, known, base, full

    return joined.mapInArrow(score, SCORES)


def score_documents(spark, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))

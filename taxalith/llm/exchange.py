"""Totals of 64-bit keys over all of the data, sent back to those who asked.

Batches of documents ask for their distinct keys: one request row per batch and part of the key space, with the sorted keys
and what the batch adds to each. A part's requests meet in one task, which sums and replies with one row per request. A key
that is frequent comes once from each batch, so no part is larger than the others, and nothing goes through the driver.
Keys travel as differences of sorted numbers, and all numbers byte by byte in planes, which compress well.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import large_given_back, release

REQUESTS = "part long, batch long, keys binary, adds binary"
REPLIES = "batch long, part long, totals binary, keys_met long, sum_met long"
#: Keys that a part holds on average at most.
PART = 1_000_000


def planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def part_bits(keys: int) -> int:
    """So many leading bits of a key name its part that parts hold PART of the keys on average."""
    return max(0, (max(1, -(-keys // PART)) - 1).bit_length())


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each part starts in sorted keys, and their end."""
    if not bits:
        return np.array([0, len(keys)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def requests(batch: int, keys: np.ndarray, adds: np.ndarray, bits: int, first: int = 0) -> list[tuple]:
    """Request rows of sorted distinct keys; first: number of the first part."""
    edges = cuts(keys, bits).tolist()
    return [(first + i, batch, planes(np.diff(keys[a:b], prepend=np.uint64(0))), planes(adds[a:b].astype(np.uint32))) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


def _answer(part: pd.DataFrame) -> pd.DataFrame:
    large_given_back()
    release()  # what the part before left
    keys = [np.cumsum(unplanes(k, np.uint64)) for k in part["keys"]]
    ends = np.cumsum([len(k) for k in keys])
    together, place = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    adds = np.concatenate([unplanes(a, np.uint32) for a in part["adds"]])
    totals = np.bincount(place, adds, len(together)).astype(np.uint64)
    back = [planes(totals[p]) for p in np.split(place, ends[:-1])]
    none = [0] * len(back)
    return pd.DataFrame({"batch": [*part["batch"], -1], "part": [*part["part"], part["part"].iloc[0]], "totals": [*back, b""], "keys_met": [*none, np.count_nonzero(totals)], "sum_met": [*none, totals.sum(dtype=np.int64)]})


def answered(asked: DataFrame) -> DataFrame:
    """Replies to all requests; rows of batch -1 hold each part's number of keys with a total and the sum of totals."""
    return asked.groupBy("part").applyInPandas(_answer, REPLIES)


def met(replies: DataFrame, parts: int) -> tuple[int, int]:
    """Over the first parts: how many keys have a total, and the sum of totals."""
    got = replies.filter((F.col("batch") == -1) & (F.col("part") < parts)).agg(F.sum("keys_met").alias("keys"), F.sum("sum_met").alias("sums")).first()
    return got.keys or 0, got.sums or 0


def by_batch(replies: DataFrame) -> DataFrame:
    """A row per batch with its replies in the order of parts."""
    real = replies.filter("batch >= 0")
    return real.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("part", "totals"))).alias("replies")).select("batch", F.col("replies.totals").alias("replies"))


def totals_of(replies: list[bytes]) -> np.ndarray:
    return np.concatenate([unplanes(r, np.uint64) for r in replies]) if replies else np.zeros(0, np.uint64)

"""Best-fit packing of documents into sequences by a linear grouping scheme.

Token lengths are at most ``CAPACITY``, so a histogram of them is a complete and bounded description of the packing
problem. On it the driver plans: lengths over a part of ``CAPACITY`` (each of ``1 / LARGE`` is tried) are put into groups of equal cardinality and rounded up to
their group's largest; the few sizes that remain make a configuration programme, solved by column generation (knapsack
pricing) and rounded down; the groups' actual lengths, largest first, take the rounded places; what is left and all small
lengths go by decreasing length into the fullest sequence that holds them. Sequences that look alike are handled as one
run, so the plan has a bounded number of rows (at most a few for each length and configuration), whatever the corpus.
Executors number the pieces of each length, in salted buckets so that no task holds a whole length, and look their place up.

Null texts are empty; an empty document is its end token alone. Longer documents are cut into pieces of ``CAPACITY`` tokens,
of which the first may be shorter. Repeated rows are packed as often as they come, null ids like others; which of equal pieces
stands where makes no difference. Very long texts are encoded whole. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, columns, staged, table, text_of

CAPACITY, GROUPS, CACHE, END, PROBE = 2048, 24, 600_000, 0, 200
SIGNS = (".", ",")
#: Lengths over a capacity's fraction of these count as large; the plan with the fewest sequences is kept.
LARGE = (4, 3, 2)
ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]| [ \n]|\n ")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids as little-endian 32-bit bytes. Words between single spaces are looked up: the tokenizer splits there anyhow.

    A text that holds one of the tokenizer's added tokens goes through ``tokenizers`` as a whole.
    ``tokenizers`` defines the ids. New words go through ``tiktoken`` over the same vocabulary's ranks, which encodes a word
    ten times as fast; each encoder compares the first ``PROBE`` of them with ``tokenizers`` and stays with that if they differ.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.probe = PROBE
        try:
            with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        except FileNotFoundError:
            self.fast = None
        self.signs = {c: self.encode(c) for c in SIGNS}

    def defined(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if self.fast and self.probe:
            self.probe -= 1
            if self.fast.encode_ordinary(text) != self.defined(text):
                self.fast = None
        return self.packed(self.fast.encode_ordinary(text) if self.fast else self.defined(text))

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        """A word behind a space. Letters alone are one unit of the tokenizer's first split, and so is a sign after them."""
        if self.fast and not self.probe:
            if word.isalpha():
                return self.packed(self.fast._core_bpe.encode_single_piece(b" " + word.encode()))
            if word[-1:] in SIGNS and word[:-1].isalpha():
                head = self.known.get(word[:-1])
                if head is None:
                    head = self.known[word[:-1]] = self.word(word[:-1])
                return head + self.signs[word[-1]]
        return self.encode(f" {word}")

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > CACHE:
            self.known.clear()
        for w in words:
            if w not in self.known:
                self.known[w] = self.word(w)

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        for i in range(0, len(texts), 128):
            plain = {}
            for j in range(i, min(i + 128, len(texts))):
                t = texts[j]
                if any(x in t for x in self.special):
                    out[j] = self.packed(self.defined(t))
                elif t and (t[0] == " " or t[-1] == " " or ODD.search(t)):
                    out[j] = self.encode(t)
                elif t:
                    first, *rest = t.split(" ")
                    plain[j] = first, rest
            self.learn(set().union(*(rest for _, rest in plain.values())))
            for j, (first, rest) in plain.items():
                out[j] = self.encode(first) + b"".join(map(self.known.__getitem__, rest))
        return out


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document's tokens with an end token, cut into pieces; ids themselves stay behind, their crc32 goes along."""
    path = path or tokenizer_path()

    def rows(batches):
        encoder, end = Encoder(path), END.to_bytes(4, "little")
        for ids, texts in columns(batches, "doc_id", "text"):
            out = ([], [], [], [], [])
            for key, data in zip(ids, encoder(texts)):
                data += end
                n = len(data) // 4
                at, piece = 0, 0
                while at < n:
                    step = (n - at) % capacity or capacity
                    for column, value in zip(out, (key, piece, at, step, zlib.crc32(data[4 * at : 4 * (at + step)]))):
                        column.append(value)
                    at, piece = at + step, piece + 1
            schema = arrow_schema(PIECES)
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, out)), schema=schema)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(documents).alias("text")).mapInArrow(rows, PIECES)


class Place(NamedTuple):
    """Pieces rank_start.. (n of them) of a length: per_bin in each sequence from bin_start on, the first at offset."""

    length: int
    rank_start: int
    n: int
    bin_start: int
    per_bin: int
    offset: int


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Places by size and how often, meeting at most the demand: the linear programme's basis, rounded down."""
    k = len(sizes)
    s, m = np.asarray(sizes), np.asarray(demand, float)
    basis = np.diag([float(capacity // x) for x in sizes])
    order = np.argsort(s)
    for _ in range(60 * k):
        inverse = np.linalg.inv(basis)
        x = inverse @ m
        dual = inverse.sum(0)
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        values, small = dual[order], s[order]
        for c in range(int(small[0]), capacity + 1):
            fits = np.searchsorted(small, c, "right")
            gain = best[c - small[:fits]] + values[:fits]
            i = int(gain.argmax())
            if gain[i] > best[c - 1] + 1e-12:
                best[c], last[c] = gain[i], order[i]
            else:
                best[c] = best[c - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
                continue
            column[last[c]] += 1
            c -= int(s[last[c]])
        move = inverse @ column
        ratio = np.where(move > 1e-9, np.maximum(x, 0) / np.where(move > 1e-9, move, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    x = np.linalg.solve(basis, m)
    return [(basis[:, j].astype(int).tolist(), int(x[j] + 1e-6)) for j in range(k) if x[j] + 1e-6 >= 1]


def planned(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[Place], int]:
    """Places for all pieces of a histogram of lengths, and the number of sequences: the best over all thresholds."""
    return min((grouped(counts, capacity, groups, part) for part in LARGE), key=lambda plan: plan[1])


def grouped(counts: dict[int, int], capacity: int, groups: int, part: int) -> tuple[list[Place], int]:
    """The linear grouping scheme for one threshold, capacity / part."""
    counts = {length: n for length, n in counts.items() if n > 0}
    large = sorted((x for x in counts if capacity // part < x < capacity), reverse=True)
    total = sum(counts[x] for x in large)
    used = dict.fromkeys(counts, 0)
    runs: list[list[list[int]]] = []
    room = 0
    for x in large:
        n = counts[x]
        while n:
            if not room:
                runs.append([])
                room = -(-total // groups)
            take = min(n, room)
            runs[-1].append([x, used[x], take])
            used[x] += take
            n, room = n - take, room - take
    sizes, demand = [r[0][0] for r in runs], [sum(t[2] for t in r) for r in runs]
    merged: dict[int, int] = {}
    for i, x in enumerate(sizes):
        if i and x == sizes[i - 1]:
            runs[merged[x]] += runs[i]
            demand[merged[x]] += demand[i]
            runs[i] = []
        else:
            merged[x] = i
    kept = [i for i in range(len(runs)) if runs[i]]
    runs, sizes, demand = [runs[i] for i in kept], [sizes[i] for i in kept], [demand[i] for i in kept]
    places, bins = [], 0
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rests: list[int] = []

    def leave(rest: int, start: int, n: int) -> None:
        if rest and n:
            if not open_[rest]:
                insort(rests, rest)
            open_[rest].append((start, n))

    for config, n in configurations(sizes, demand, capacity) if sizes else []:
        slots = [g for g, k in enumerate(config) for _ in range(k)]
        taken = []
        for g in slots:
            need, got = n, []
            while need:
                run = runs[g][0]
                k = min(need, run[2])
                got.append((run[0], run[1], k))
                run[1], run[2], need = run[1] + k, run[2] - k, need - k
                if not run[2]:
                    runs[g].pop(0)
            taken.append(got)
        edges = sorted({0, n} | {int(e) for got in taken for e in np.cumsum([k for _, _, k in got])})
        for a, b in zip(edges, edges[1:]):
            offset = 0
            for got in taken:
                at = 0
                for x, rank, k in got:
                    if at <= a < at + k:
                        places.append(Place(x, rank + a - at, b - a, bins + a, 1, offset))
                        offset += x
                        break
                    at += k
            leave(capacity - offset, bins + a, b - a)
        bins += n
    left: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for group in runs:
        for x, rank, k in group:
            left[x].append((rank, k))
    for x in counts:
        if x not in large:
            left[x].append((0, counts[x]))
    for x in sorted(left, reverse=True):
        for rank, n in left[x]:
            while n:
                i = bisect_left(rests, x)
                if i < len(rests):
                    rest = rests[i]
                    start, many = open_[rest].pop()
                    if not open_[rest]:
                        rests.pop(i)
                else:
                    rest, per = capacity, capacity // x
                    start, many = bins, -(-n // per)
                    bins += many
                per = rest // x
                full = min(many, n // per)
                if full:
                    places.append(Place(x, rank, full * per, start, per, capacity - rest))
                    leave(rest - per * x, start, full)
                    rank, n = rank + full * per, n - full * per
                if n and full < many:
                    places.append(Place(x, rank, n, start + full, n, capacity - rest))
                    leave(rest - n * x, start + full, 1)
                    n, full = 0, full + 1
                leave(rest, start + full, many - full)
    return places, bins


PLAN = "p_length long, rank_start long, n long, bin_start long, per_bin long, place_offset long"


def packed(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = documents.sparkSession
    cut = staged(pieces(documents, path, capacity))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places, _ = planned(counts, capacity, groups)
    salts = min(4096, max(8, sum(counts.values()) // 512))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("s_length").orderBy("s_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy(F.col("length").alias("s_length"), F.col("salt").alias("s_salt")).agg(F.count("*").alias("many"))
    firsts = firsts.select("s_length", "s_salt", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("within", F.row_number().over(inside) - 1)
    ranked = ranked.join(firsts, (F.col("length") == F.col("s_length")) & (F.col("salt") == F.col("s_salt"))).withColumn("rank", F.col("first") + F.col("within"))
    plan = F.broadcast(spark.createDataFrame([tuple(p) for p in places], PLAN))
    at = F.col("rank") - F.col("rank_start")
    out = ranked.join(plan, (F.col("length") == F.col("p_length")) & (at >= 0) & (at < F.col("n")))
    whole = F.expr("(rank - rank_start) div per_bin")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("bin_start") + whole).alias("sequence_id"), (F.col("place_offset") + (at - whole * F.col("per_bin")) * F.col("length")).alias("offset"))


def pack_documents(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))

"""Exact top-k inner products by the three-phase uniform threshold.

Every vector's components are dealt into ``LISTS`` groups; a group's partial inner products are one local score list of a
query, and each group's components are a stored table of their own. Phase 1 gathers each list's k highest local scores per
query, resolves those entries exactly, and takes the k-th best of them as a lower bound t of the answer. Phase 2 sends each
query's cutoff t / lists back to the lists: an entry whose local scores are all below it sums to less than t and can't be
among the k best, whatever the signs, so only entries at the cutoff or above are collected. Phase 3 resolves the collected
entries from their partial scores in all lists, and keeps the k best.

Vectors are packed into blocks of ``BLOCK`` rows. Query blocks, with their cutoffs, are broadcast while they have at most
``SENT`` bytes; beyond that, pairs of blocks meet by a keyed join. A task merges what it finds for a query before it emits it,
so phase 1 emits at most k rows for each query, list and task. Components become floor(256 x); vectors that are null, empty
or hold null or non-finite components take no part, nor do rows without an id; vectors meet those of their own length only.
Rows that share an id are one item repeated: none is a candidate of its own query; otherwise each counts, ties going to the
smaller id. Local scores are doubles; beyond 2**53, where they may be rounded, the cutoff is lowered by the largest error,
partial scores are exact integers, and sums beyond a long are an error. An empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, staged, table, unstage

K, LISTS, BLOCK, EVERY, UNIT = 5, 2, 1024, 50, 256.0
#: Bytes of query blocks that are broadcast at most, and query blocks that a task holds merged scores of at most.
SENT, HELD = 32 << 20, 64
EXACT = 2.0**53


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and x (256 times the components, as doubles) of the rows that take part."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    chosen = vectors.filter("vec_id is not null and size(embedding) > 0").filter(fine)
    return chosen.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(v.cast("double") * UNIT).cast("double")).alias("x"))


def list_blocks(rows: DataFrame, lists: int, size: int = BLOCK) -> tuple[DataFrame, int]:
    """The lists' tables, staged: list, block, dim, ids and flat, the list's components of about size vectors of one length.

    Beside them the number of block ids.
    """
    many = max(1, -(-rows.count() // size))
    keyed = rows.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(many)).alias("block"), F.size("x").alias("dim"))
    keyed = keyed.agg(F.collect_list(F.struct("vec_id", "x")).alias("rows"))

    def part(i: int) -> Column:
        begin, end = (F.floor(F.col("dim") * j / lists).cast("int") for j in (i, i + 1))
        return F.struct(F.lit(i).alias("list"), F.flatten(F.transform("rows.x", lambda x: F.slice(x, begin + 1, end - begin))).alias("flat"))

    each = keyed.select("block", "dim", F.col("rows.vec_id").alias("ids"), F.explode(F.array(*map(part, range(lists)))).alias("part"))
    return staged(each.select("part.list", "block", "dim", "ids", "part.flat").filter("size(flat) > 0")), many


def paired(queries: tuple[DataFrame, int], candidates: tuple[DataFrame, int], sent: int) -> DataFrame:
    """Each list's query blocks (columns with q_ before) beside its candidate blocks of the same vector length."""
    (left, lefts), (right, rights) = queries, candidates
    size = left.agg(F.sum(F.size("flat") + F.size("ids"))).first()[0] or 0
    left = left.select("list", "dim", *(F.col(c).alias(f"q_{c}") for c in left.columns if c not in ("list", "dim")))
    if size * 8 <= sent:
        return right.join(F.broadcast(left), ["list", "dim"])
    # Each pair of blocks has a key of its own, so that no task sees more than two blocks at once.
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rights - 1).cast("long"))))
    right = right.withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lefts - 1).cast("long"))))
    return left.join(right, ["list", "dim", "q_block", "block"])


def _column(batch: pa.RecordBatch, name: str, i: int):
    return batch.column(batch.schema.get_field_index(name))[i]


def _matrices(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    q_ids, q, ids, v = (_column(batch, n, i).values.to_numpy(zero_copy_only=False) for n in ("q_ids", "q_flat", "ids", "flat"))
    return q_ids, q.reshape(len(q_ids), -1), ids, v.reshape(len(ids), -1)


def rounding(q: np.ndarray, v: np.ndarray) -> float:
    """How far a local score, as a double, may be from the exact one."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    return 0.0 if largest < EXACT else largest * q.shape[1] * 2.0**-51


def products(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, float]:
    """Local scores of all queries and vectors of two blocks, and how far they may be from the exact ones."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num(q @ v.T, nan=0.0), rounding(q, v)


PLACES = "dim int, q_block long, q_place int, block long, place int"
ENTRIES = f"list int, {PLACES}, local double"
EXACT_SCORES = f"list int, {PLACES}, query_id long, vec_id long, score long"


def heads(pairs: DataFrame, k: int) -> DataFrame:
    """Phase 1: the k highest entries of each list and query that a task has met, by place in their blocks."""

    def rows(batches):
        schema = arrow_schema(ENTRIES)

        def flush(key):
            score, block, place = best.pop(key)
            q, i = np.nonzero(score > -np.inf)
            values = [np.full(len(q), key[0]), np.full(len(q), key[1]), np.full(len(q), key[2]), q, block[q, i], place[q, i], score[q, i]]
            return pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) for x, f in zip(values, schema)], schema=schema)

        best: dict[tuple, tuple] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(_column(batch, n, i).as_py() for n in ("list", "dim", "q_block"))
                q_ids, q, ids, v = _matrices(batch, i)
                score = products(q, v)[0]
                score[q_ids[:, None] == ids[None, :]] = -np.inf
                place = np.broadcast_to(np.arange(len(ids)), score.shape)
                block = np.full(score.shape, _column(batch, "block", i).as_py())
                if key in best:
                    score, block, place = (np.concatenate(x, 1) for x in zip(best.pop(key), (score, block, place)))
                if score.shape[1] > k:
                    at = np.argpartition(score, -k, axis=1)[:, -k:]
                    score, block, place = (np.take_along_axis(x, at, 1) for x in (score, block, place))
                best[key] = score, block, place
                if len(best) > HELD:
                    yield flush(next(iter(best)))
        for key in list(best):
            yield flush(key)

    found = pairs.drop("q_cuts").mapInArrow(rows, ENTRIES)
    order = Window.partitionBy("list", "dim", "q_block", "q_place").orderBy(F.desc("local"))
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("n")


def collected(pairs: DataFrame) -> DataFrame:
    """Phase 2: all entries at their query's cutoff or above, by place in their blocks. No cutoff: all."""

    def rows(batches):
        schema = arrow_schema(ENTRIES)
        for batch in batches:
            for i in range(batch.num_rows):
                key = [_column(batch, n, i).as_py() for n in ("list", "dim", "q_block")]
                q_ids, q, ids, v = _matrices(batch, i)
                cut = np.array([-np.inf if c is None else c for c in _column(batch, "q_cuts", i).as_py()], float)
                score, error = products(q, v)
                at, place = np.nonzero((score >= cut[:, None] - error) & (q_ids[:, None] != ids[None, :]))
                values = [*(np.full(len(at), x) for x in key), at, np.full(len(at), _column(batch, "block", i).as_py()), place, score[at, place]]
                yield pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) for x, f in zip(values, schema)], schema=schema)

    return pairs.mapInArrow(rows, ENTRIES)


def resolved(entries: DataFrame, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Exact scores of entries, from their partial scores in all lists: the places, query_id, vec_id and score."""
    asked = entries.select("dim", "q_block", "q_place", "block", "place").distinct()
    asked = asked.groupBy("dim", "q_block", "block").agg(F.collect_list(F.struct("q_place", "place")).alias("places"))
    asked = asked.select("dim", "q_block", "block", "places.q_place", "places.place").join(candidates, ["dim", "block"])
    left = queries.select("list", "dim", *(F.col(c).alias(f"q_{c}") for c in ("block", "ids", "flat")))

    def rows(batches):
        schema = arrow_schema(EXACT_SCORES)
        for batch in batches:
            for i in range(batch.num_rows):
                part, dim, q_block, block = (_column(batch, n, i).as_py() for n in ("list", "dim", "q_block", "block"))
                at, place = (_column(batch, n, i).values.to_numpy() for n in ("q_place", "place"))
                q_ids, q, ids, v = _matrices(batch, i)
                if rounding(q, v):
                    score = [sum(int(x) * int(y) for x, y in zip(q[a], v[b])) for a, b in zip(at, place)]
                else:
                    score = np.einsum("ij,ij->i", q[at], v[place]).astype(np.int64)
                values = [np.full(len(at), part), np.full(len(at), dim), np.full(len(at), q_block), at, np.full(len(at), block), place, q_ids[at], ids[place], score]
                yield pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) for x, f in zip(values, schema)], schema=schema)

    partial = asked.join(left, ["list", "dim", "q_block"]).mapInArrow(rows, EXACT_SCORES)
    return partial.groupBy("dim", "q_block", "q_place", "block", "place", "query_id", "vec_id").agg(F.sum("score").alias("score"))


def with_cutoffs(queries: DataFrame, known: DataFrame, k: int, lists: int) -> DataFrame:
    """Query blocks with, by place, the k-th best known score over the number of lists, null where fewer are known."""
    order = Window.partitionBy("dim", "q_block", "q_place").orderBy(F.desc("score"))
    bounds = known.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k)
    cut = F.struct("q_place", (F.col("score") / F.least("dim", F.lit(lists))).alias("cut"))
    bounds = bounds.groupBy("dim", F.col("q_block").alias("block")).agg(F.map_from_entries(F.collect_list(cut)).alias("by_place"))
    cuts = F.transform(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.try_element_at("by_place", i))
    return queries.join(bounds, ["dim", "block"], "left").withColumn("cuts", cuts).drop("by_place")


def phases(vectors: DataFrame, k: int = K, every: int = EVERY, lists: int = LISTS, sent: int = SENT) -> tuple[DataFrame, DataFrame]:
    """What phase 2 collects, staged, and the exact scores of it."""
    rows = usable(vectors)
    queries, candidates = list_blocks(rows.filter(F.pmod("vec_id", F.lit(every)) == 0), lists), list_blocks(rows, lists)
    first = staged(heads(paired(queries, candidates, sent), k))
    known = resolved(first, queries[0], candidates[0])
    cut = staged(with_cutoffs(queries[0], known, k, lists))
    unstage(first)
    entries = staged(collected(paired((cut, queries[1]), candidates, sent)))
    return entries, resolved(entries, queries[0], candidates[0])


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, lists: int = LISTS, sent: int = SENT) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best among all other rows."""
    _, found = phases(vectors, k, every, lists, sent)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))

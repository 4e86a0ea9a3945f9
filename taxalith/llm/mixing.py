"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

``fill`` clamps every source whose proportional share exceeds its maximum number of epochs and deals the excess out again
by weight until no share exceeds its cap. A source's documents are then all repeated as often as its target holds the whole
source, and for the rest they are taken in the order of a seeded hash until the rest is used up; the document at that place
is taken in part, so every source's taken words equal its target rounded to a word. Each document is so taken at most
``epochs`` times. Nothing depends on partitions or row order: reruns agree, and equal rows are interchangeable.

Null and empty texts hold no words; null sources are one source, last in order; a null id is an id like another. A source
without words has target 0. Repeated rows are counted together at the cut and all taken alike; very long texts are counted
whole; an empty table gives no rows. The only data on the driver are one row per source. The place of the cut is found from
sums by hash bucket, so no task orders a whole source.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxalith.llm.common import staged, table, text_of

WEIGHTS, SHARE, EPOCHS, SEED = (5, 2, 1), 1.5, 2, 20
#: Up to so many sources, and 64 rows a bucket, the plan's tables are bounded and broadcast.
SOURCES = 1000
WORD = r"[^\x20\x09-\x0D]+"


def fill(sizes: list[int], weights: list[float], total: float, epochs: float) -> list[float]:
    """Targets by weight that sum to total (or to all caps, if those are less), none above epochs times its size."""
    caps, out = [epochs * s for s in sizes], [0.0] * len(sizes)
    open_, left = {i for i, c in enumerate(caps) if c > 0 and weights[i] > 0}, min(float(total), float(sum(caps)))
    while open_:
        unit = left / math.fsum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * unit >= caps[i]}
        if not over:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = float(caps[i])
        left -= math.fsum(caps[i] for i in over)
        open_ -= over
    return out


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def sized(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """documents with size and place, the seeded hash that orders a source's documents."""
    text = text_of(documents)
    return documents.withColumns({"size": n_words(text), "place": F.xxhash64(F.lit(seed), F.col("doc_id"), text)})


def planned(rows: DataFrame, small: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """rows (source, place, size and others) with source_size, target and taken (words, repeats counted).

    small: a staged table with source, place and size of the same rows.
    """
    spark = rows.sparkSession
    by_source = small.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).collect()
    by_source = sorted(by_source, key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r.source_size or 0) for r in by_source]
    targets = fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), epochs)
    many = sum(r.rows for r in by_source)
    buckets = min(1 << 16, max(16, many // 64))
    plan = []
    for r, size, target in zip(by_source, sizes, targets):
        words = round(target)
        whole = words // size if size else 0
        plan.append((r.source, size, target, whole, words - whole * size))
    kind = rows.schema["source"].dataType.simpleString()
    plan = spark.createDataFrame(plan, f"source {kind}, source_size long, target double, _whole long, _rest long")
    bucket = F.pmod("place", F.lit(buckets))
    order = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = small.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("words"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    hold = F.broadcast if len(sizes) <= SOURCES and many <= 64 * (1 << 16) else (lambda df: df)
    cut = sums.join(hold(plan), sums["source"].eqNullSafe(plan["source"])).select(plan["*"], "_bucket", "_before", "words")
    cut = cut.filter("_rest > 0 and _before < _rest and _before + words >= _rest")
    cut = cut.select(F.col("source").alias("_cut_source"), F.col("_bucket").alias("_cut"), "_before")
    at_cut = small.withColumn("_bucket", bucket).join(cut, small["source"].eqNullSafe(cut["_cut_source"]) & (F.col("_bucket") == F.col("_cut")))
    line = at_cut.groupBy("_cut_source", "_cut", "_before", "place", "size").agg(F.count("*").alias("_same"))
    inside = Window.partitionBy("_cut_source").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("_upto", F.col("_before") + F.coalesce(F.sum(F.col("size") * F.col("_same")).over(inside), F.lit(0)))
    return _with_taken(rows, plan, cut, line, bucket, hold)


def _with_taken(rows: DataFrame, plan: DataFrame, cut: DataFrame, line: DataFrame, bucket: Column, hold: Callable) -> DataFrame:
    """Joins the small tables back: buckets before the cut are taken whole, in the cut's bucket each row has its place."""
    plan = plan.withColumnRenamed("source", "_plan_source")
    out = rows.join(hold(plan), rows["source"].eqNullSafe(plan["_plan_source"]))
    out = out.join(hold(cut), out["source"].eqNullSafe(cut["_cut_source"]), "left").withColumn("_bucket", bucket)
    renamed = {"_cut_source": "_line_source", "place": "_line_place", "size": "_line_size", "_upto": "_upto", "_same": "_same"}
    line = line.select(*(F.col(a).alias(b) for a, b in renamed.items()))
    same = out["source"].eqNullSafe(line["_line_source"]) & (out["place"] == line["_line_place"]) & (out["size"] == line["_line_size"])
    out = out.join(hold(line), same & (out["_bucket"] == out["_cut"]), "left")
    part = F.when(F.col("_rest") <= 0, 0).when(F.col("_bucket") < F.col("_cut"), F.col("size")).when(F.col("_bucket") > F.col("_cut"), 0)
    room = F.greatest(F.lit(0), F.least(F.col("size") * F.col("_same"), F.col("_rest") - F.col("_upto")))
    part = part.otherwise(F.coalesce(F.floor(room / F.col("_same")), F.lit(0)))
    taken = F.col("size") * F.col("_whole") + F.coalesce(part, F.lit(0))
    return out.select(*rows.columns, "source_size", "target", taken.cast("long").alias("taken"))


def mixed(documents: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself, with the columns of documents, whatever their names: a row for each repetition of a document.

    A partly taken document's row holds its first words, as many as the plan takes; n_chars follows where there is one.
    """
    names = documents.columns
    rows = sized(documents.select("doc_id", "source", "text", F.struct("*").alias("row")), seed)
    plan = planned(rows, staged(rows.select("source", "place", "size")), **options)
    copies = F.expr("cast(if(size = 0, 0, ceil(taken / size)) as int)")
    out = plan.withColumn("copies", copies).filter("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), 0), 1, words.cast("int")), "")
    out = out.withColumn("text", F.when(words < F.col("size"), cut).otherwise(F.col("text")))
    new = {"text": F.col("text")}
    if "n_chars" in names:
        new["n_chars"] = F.length("text").cast(documents.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in names))


def mix_plan(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = staged(sized(documents).select("doc_id", "source", "place", "size"))
    return planned(rows, rows).select("doc_id", "size", "source_size", "target", "taken")

"""Interval joins by bins of a fixed width, so that a group's intervals need not meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1000


def _binned(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn("bin", F.explode(F.sequence(F.expr(f"`start` div {width}"), F.expr(f"`end` div {width}"))))


def overlaps(left: DataFrame, right: DataFrame, width: int = WIDTH) -> DataFrame:
    """Pairs of (id, grp, start, end) rows of one group that share a place, ends included; right's columns get ``r_``.

    A pair meets in several bins and is kept in the one where its overlap starts.
    """
    r = _binned(right, width).select(*[F.col(c).alias(f"r_{c}") for c in right.columns], F.col("bin").alias("r_bin"))
    met = _binned(left, width).join(r, (F.col("grp") == F.col("r_grp")) & (F.col("bin") == F.col("r_bin")))
    first = F.expr(f"greatest(`start`, r_start) div {width}")
    return met.filter((F.col("start") <= F.col("r_end")) & (F.col("r_start") <= F.col("end")) & (F.col("bin") == first)).drop("bin", "r_bin")


def overlap_counts(genes: DataFrame, reads: DataFrame, width: int = WIDTH) -> DataFrame:
    """Reads and bases that overlap each gene; a read counts in every gene it touches."""
    met = overlaps(genes, reads, width)
    inside = F.least("end", "r_end") - F.greatest("start", "r_start")
    return met.groupBy("id").agg(F.count("*").alias("reads"), F.sum(inside).alias("bases"))


def without_overlap(left: DataFrame, right: DataFrame, width: int = WIDTH) -> DataFrame:
    return left.join(overlaps(left, right, width).select("id"), "id", "left_anti")


def best_overlap(left: DataFrame, right: DataFrame, least: float = 0.75, width: int = WIDTH) -> DataFrame:
    """Each left row's partner of greatest overlap, if it covers over least of the left row or lies within it."""
    met = overlaps(left, right, width).withColumn("both", F.least("end", "r_end") - F.greatest("start", "r_start") + 1)
    best = met.groupBy("id", "start", "end").agg(F.min(F.struct((-F.col("both")).alias("k"), F.col("r_id"), F.col("r_start"), F.col("r_end"))).alias("w"))
    share = -F.col("w.k") / (F.col("end") - F.col("start") + 1)
    return best.filter((share > least) | ((F.col("w.r_start") >= F.col("start")) & (F.col("w.r_end") <= F.col("end")))).select("id", F.col("w.r_id").alias("partner"), F.round(share, 6).alias("overlap"))


def merged(intervals: DataFrame) -> DataFrame:
    """Islands of overlapping or touching intervals (grp, start, end)."""
    order = Window.partitionBy("grp").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("new", F.when(F.col("start") <= reach + 1, 0).otherwise(1))
    island = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy("grp", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def uncovered(intervals: DataFrame, spans: DataFrame) -> DataFrame:
    """Places of each span (grp, length) that no interval covers."""
    covered = merged(intervals).groupBy("grp").agg(F.sum(F.col("end") - F.col("start") + 1).alias("covered"))
    return spans.join(covered, "grp", "left").select("grp", (F.col("length") - F.coalesce("covered", F.lit(0))).alias("uncovered"))

"""Consensus taxonomy of members with disparity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxalith.params import DEFAULTS, Params


def _votes(members: DataFrame, ranks: list[str]) -> DataFrame:
    """group, depth, rank, taxon, n, second, assigned, total: the leading taxon of each group at each rank."""
    total = members.groupBy("group").agg(F.count("*").alias("total"))
    long = members.select("group", F.inline(F.array(*[F.struct(F.lit(i).alias("depth"), F.lit(r).alias("rank"), F.col(r).alias("taxon")) for i, r in enumerate(ranks)]))).filter("taxon is not null")
    counts = long.groupBy("group", "depth", "rank", "taxon").agg(F.count("*").alias("n"))
    w = Window.partitionBy("group", "depth").orderBy(F.desc("n"), "taxon")
    led = counts.withColumns({"place": F.row_number().over(w), "second": F.coalesce(F.lead("n").over(w), F.lit(0)), "assigned": F.sum("n").over(Window.partitionBy("group", "depth"))})
    return led.filter("place = 1").drop("place").join(total, "group")


def all_ranks(members: DataFrame, ranks: list[str]) -> DataFrame:
    """Shares and disparity of the leading taxon at every rank: assigned members that differ, over assigned ones."""
    v = _votes(members, ranks)
    return v.select("group", "rank", "taxon", F.round(F.col("n") / F.col("assigned") * 100, 4).alias("perc_assigned"), F.round(F.col("n") / F.col("total") * 100, 4).alias("perc_total"), F.col("total").alias("n_members"), F.round((F.col("assigned") - F.col("n")) / F.col("assigned"), 6).alias("disparity"))


def consensus(members: DataFrame, ranks: list[str], of_rank: float | None = None, of_all: float | None = None, least: int | None = None, stop_at_failure: bool = False, denominator: str = "rank", p: Params = DEFAULTS) -> DataFrame:
    """group, rank, taxon, disparity, n_members: the deepest accepted rank of members (group and a column per rank, top first).

    A rank is accepted if its leader holds the shares of assigned and all members and leads strictly. ``stop_at_failure``
    (bins) ends at the first rank that isn't accepted. ``denominator='any'`` divides by members assigned at any rank.
    """
    of_rank = p.consensus_of_rank if of_rank is None else of_rank
    of_all = p.consensus_of_all if of_all is None else of_all
    least = p.consensus_genes if least is None else least
    v = _votes(members, ranks)
    if denominator == "any":
        known = members.filter(F.coalesce(*ranks).isNotNull()).groupBy("group").agg(F.count("*").alias("known"))
        v = v.join(known, "group").withColumn("base", F.col("known"))
    else:
        v = v.withColumn("base", F.col("assigned"))
    fine = (F.col("n") / F.col("base") >= of_rank) & (F.col("n") / F.col("total") >= of_all) & (F.col("n") >= least) & (F.col("n") > F.col("second"))
    v = v.withColumn("fine", fine)
    if stop_at_failure:
        run = Window.partitionBy("group").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        v = v.withColumn("fine", F.min("fine").over(run) & (F.count("*").over(run) == F.col("depth") + 1))
    best = v.filter("fine").groupBy("group").agg(F.max_by(F.struct("rank", "taxon", "n", "assigned", "total"), "depth").alias("w"))
    return best.select("group", "w.rank", "w.taxon", F.round((F.col("w.assigned") - F.col("w.n")) / F.col("w.assigned"), 6).alias("disparity"), F.col("w.total").alias("n_members"))


def disparity_as_coded(members: DataFrame, rank: str, taxon: str) -> DataFrame:
    """1 / (1 + how many members stand before the first one that differs, by member id), 0 if none differs."""
    order = Window.partitionBy("group").orderBy("member")
    marked = members.withColumns({"before": F.row_number().over(order) - 1, "differs": F.col(rank).isNotNull() & (F.col(rank) != F.col(taxon))})
    return marked.groupBy("group").agg(F.coalesce(1 / (1 + F.min(F.when(F.col("differs"), F.col("before")))), F.lit(0.0)).alias("disparity"))


def taxa_profile(members: DataFrame, ranks: list[str], least: float = 1.0) -> DataFrame:
    """Percentage of a group's members per (rank, taxon), from least per cent up."""
    total = members.groupBy("group").agg(F.count("*").alias("total"))
    long = members.select("group", F.inline(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("taxon")) for r in ranks]))).filter("taxon is not null")
    return long.groupBy("group", "rank", "taxon").agg(F.count("*").alias("n")).join(total, "group").withColumn("percent", F.round(F.col("n") * 100 / F.col("total"), 4)).filter(F.col("percent") >= least).select("group", "rank", "taxon", "percent")


def prefer_filtered(filtered: DataFrame, unfiltered: DataFrame, kingdoms=("Bacteria", "Archaea")) -> DataFrame:
    """The filtered lineage where either one's top rank is among kingdoms, else the unfiltered one (key, top, lineage)."""
    f, u = filtered.select("key", F.col("top").alias("f_top"), F.col("lineage").alias("f_lineage")), unfiltered.select("key", F.col("top").alias("u_top"), F.col("lineage").alias("u_lineage"))
    take = F.col("f_top").isin(*kingdoms) | F.col("u_top").isin(*kingdoms)
    return f.join(u, "key", "full").select("key", F.when(F.coalesce(take, F.lit(False)), F.col("f_lineage")).otherwise(F.col("u_lineage")).alias("lineage"))


def eukaryote_override(filtered: DataFrame, unfiltered: DataFrame, kingdom: str = "k_Eukaryota") -> DataFrame:
    """(key, lineage) where the unfiltered lineage stands in for the filtered one if it holds the kingdom."""
    other = unfiltered.filter(F.array_contains(F.split("lineage", ";"), kingdom)).select("key", F.col("lineage").alias("own"))
    return filtered.join(other, "key", "full").select("key", F.coalesce("own", "lineage").alias("lineage"))


def lineage_lca(a: list[str], b: list[str], supports: tuple[str, str] | None = None) -> list[Column]:
    """The common lineage of two, rank by rank: the taxon where both agree, with the lesser of two supports, else
    ``unmapped`` if one of them is, or ``unclassified``. a, b: columns by rank; supports: array columns of bootstrap values.
    """
    out = []
    for i, (x, y) in enumerate(zip(a, b)):
        same = F.col(x)
        if supports:
            least = F.least(*(F.coalesce(F.get(s, F.lit(i)), F.lit(0)) for s in supports))
            either = F.greatest(*(F.coalesce(F.get(s, F.lit(i)), F.lit(0)) for s in supports))
            same = F.when(either == 0, same).otherwise(F.concat(same, F.lit("("), least.cast("string"), F.lit(")")))
        unlike = F.when(F.col(x).contains("unmapped") | F.col(y).contains("unmapped"), "unmapped").otherwise("unclassified")
        out.append(F.when(F.col(x) == F.col(y), same).otherwise(unlike))
    return out


def bin_consensus(members: DataFrame, ranks: list[str], p: Params = DEFAULTS) -> DataFrame:
    """The consensus of a bin's contigs, with the shares asked of bins, down to the first rank that isn't accepted."""
    return consensus(members, ranks, p.bin_of_rank, p.bin_of_all, stop_at_failure=True, p=p)

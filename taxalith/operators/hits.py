"""Votes and choices over ranked hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxalith.params import DEFAULTS, RANK_IDENTITY, Params


def valid_hits(hits: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Hits (query, subject, score, identity, hit_order) close to the query's first hit, one row per subject.

    A subject counts with its best score and identity, and votes with the last identity seen. Further columns depend on the
    subject alone. One shuffle by query: the windows and the grouping by (query, subject) share its partitioning.
    """
    more = [c for c in hits.columns if c not in ("query", "subject", "score", "identity", "hit_order")]
    by_query = Window.partitionBy("query").orderBy("hit_order")
    by_subject = Window.partitionBy("query", "subject").orderBy("hit_order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = hits.withColumns({"ref_score": F.first("score").over(by_query), "ref_identity": F.first("identity").over(by_query)})
    seen = {"best_score": F.max("score").over(by_subject), "best_identity": F.max("identity").over(by_subject), "last_identity": F.last("identity").over(by_subject)}
    marked = marked.withColumns(seen | {"place": F.row_number().over(Window.partitionBy("query", "subject").orderBy("hit_order"))})
    close = (F.col("best_score") > F.col("ref_score") * p.score_ratio) & (F.col("ref_identity") - F.col("best_identity") <= p.identity_gap)
    return marked.filter(close & (F.col("place") == 1)).select("query", "subject", F.col("best_score").alias("score"), F.col("best_identity").alias("identity"), "last_identity", *more)


def lca_vote(hits: DataFrame, taxa: DataFrame, ranks: dict[str, float] = RANK_IDENTITY, p: Params = DEFAULTS, identity: bool = True, least_identity: float = 0.0) -> DataFrame:
    """query, rank, taxon: the deepest rank at which enough valid hits agree.

    taxa: subject and a column per rank. ranks: identity each needs, deepest first. The top taxon of a rank must have at
    least valid - flex * valid votes and the least number of hits, and no tie. identity=False: no rank needs any (the result
    without filter); least_identity: hits below it don't count at all (reads). Subjects are looked up first, so that all of
    a query's steps share one shuffle.
    """
    names, floor = list(ranks), dict(ranks) if identity else dict.fromkeys(ranks, 0.0)
    known = hits.filter(F.col("identity") >= least_identity) if least_identity else hits
    known = valid_hits(known.join(taxa.select("subject", *names, F.lit(True).alias("known")), "subject", "left"), p).filter("known")
    top = names[-1]
    voter = F.when(F.col(top).isNotNull() & (F.col("last_identity") >= floor[top]), 1)
    each = known.withColumn("valid", F.count(voter).over(Window.partitionBy("query"))).filter("valid > 0")
    levels = [F.struct(F.lit(i).alias("depth"), F.lit(r).alias("rank"), F.lit(float(floor[r])).alias("least"), F.col(r).alias("taxon")) for i, r in enumerate(names)]
    long = each.select("query", "valid", "last_identity", F.inline(F.array(*levels))).filter("taxon is not null and last_identity >= least")
    votes = long.groupBy("query", "valid", "depth", "rank", "taxon").agg(F.count("*").alias("n"))
    at_rank = Window.partitionBy("query", "depth")
    votes = votes.withColumns({"best": F.max("n").over(at_rank)}).withColumn("ties", F.count(F.when(F.col("n") == F.col("best"), 1)).over(at_rank))
    required = F.col("valid") - p.lca_flex * F.col("valid")
    enough = F.when(F.col("valid") == 1, 1).otherwise(p.lca_min_hits)
    won = votes.filter((F.col("n") == F.col("best")) & (F.col("ties") == 1) & (F.col("n") >= required) & (F.col("n") >= enough))
    return won.groupBy("query").agg(F.min_by(F.struct("rank", "taxon", F.col("n").alias("votes")), "depth").alias("w")).select("query", "w.rank", "w.taxon", "w.votes")


def with_lineage(votes: DataFrame, parents: DataFrame) -> DataFrame:
    """Votes (query, rank, taxon) whose taxon is among parents (taxon, lineage), with its lineage; the others go."""
    return votes.join(parents.select("taxon", "lineage"), "taxon").select(*votes.columns, "lineage")


def best_hit(hits: DataFrame) -> DataFrame:
    first = Window.partitionBy("query").orderBy("hit_order")
    return hits.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place")


def besthit_bestaver(hits: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """query, besthit, bestaver from hits (query, fun, score, overlap, hit_order).

    bestaver is the function with the best mean of its first hits, if it leads the second by more than the gap. Everything
    is read off one pass over a query's functions.
    """
    rank = Window.partitionBy("query", "fun").orderBy("hit_order")
    fine = hits.filter(F.col("overlap") >= p.min_overlap).withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= p.best_hits)
    means = fine.groupBy("query", "fun").agg(F.avg("score").alias("mean"), F.min("hit_order").alias("first"))
    order = Window.partitionBy("query").orderBy(F.desc("mean"), "fun")
    led = means.withColumns({"place": F.row_number().over(order), "second": F.coalesce(F.lead("mean").over(order), F.lit(0.0))})
    leads = (F.col("place") == 1) & ((F.col("mean") - F.col("second")) / F.col("mean") > p.best_gap)
    return led.groupBy("query").agg(F.min_by("fun", "first").alias("besthit"), F.max(F.when(leads, F.col("fun"))).alias("bestaver"))


def topk_mean(hits: DataFrame, k: int) -> DataFrame:
    """Mean score of each (query, fun)'s first k hits."""
    rank = Window.partitionBy("query", "fun").orderBy("hit_order")
    return hits.withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= k).groupBy("query", "fun").agg(F.avg("score").alias("mean_score"), F.count("*").alias("n"))


def reciprocal_best(hits: DataFrame) -> DataFrame:
    """Pairs (a, b) that are each other's best partner in hits (a, b, score); ties go to the smaller partner."""
    forward = hits.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "b"))).filter("r = 1").drop("r")
    back = hits.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("score"), "a"))).filter("r = 1").select("a", "b")
    return forward.join(back, ["a", "b"], "left_semi")


def distinct_subjects(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query").agg(F.count_distinct("subject").alias("n_hits"))


def amino_acid_identity(hits: DataFrame, genes: DataFrame) -> DataFrame:
    """a, b, orthologs, aai, sd and orthologous fraction of each pair of genomes.

    hits (a, b, a_gene, b_gene, identity, score) between genes of genomes a < b, genes (genome, n). Orthologs are reciprocal
    best hits; aai is their mean identity, the fraction their share of the smaller genome's genes.
    """
    def best(own: str, other: str) -> DataFrame:
        order = Window.partitionBy("a", "b", own).orderBy(F.desc("score"), other)
        return hits.withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r")

    keys = ["a", "b", "a_gene", "b_gene"]
    both = best("a_gene", "b_gene").join(best("b_gene", "a_gene").select(*keys), keys, "left_semi")
    found = both.groupBy("a", "b").agg(F.count("*").alias("orthologs"), F.avg("identity").alias("aai"), F.stddev_pop("identity").alias("sd"))
    sizes = [genes.select(F.col("genome").alias(g), F.col("n").alias(f"{g}_n")) for g in ("a", "b")]
    found = found.join(sizes[0], "a").join(sizes[1], "b")
    return found.select("a", "b", "orthologs", "aai", "sd", (F.col("orthologs") * 100.0 / F.least("a_n", "b_n")).alias("fraction"))

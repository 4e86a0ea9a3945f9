"""Normalised abundances, roll-ups and function coverage over tidy (feature, sample, reads, bases, length) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gene_counts(alignments: DataFrame) -> DataFrame:
    return alignments.groupBy("feature", "sample").agg(F.sum("reads").alias("reads"), F.sum("bases").alias("bases"), F.max("length").alias("length"))


def with_totals(rows: DataFrame, sample: str = "sample", **sums) -> DataFrame:
    """rows with each sample's totals, by a partial aggregation and a join: no task holds all rows of a sample."""
    return rows.join(rows.groupBy(sample).agg(*(F.sum(value).alias(name) for name, value in sums.items())), sample)


def tpm(counts: DataFrame) -> DataFrame:
    """Adds rpkm, coverage and tpm; features without length or samples without reads have 0."""
    rate = F.coalesce(F.try_divide(F.col("reads"), F.col("length")), F.lit(0.0))
    out = with_totals(counts, _total="reads", _rates=rate)
    rpkm = F.try_divide(F.col("reads") * 1e9, F.col("length") * F.col("_total"))
    shares = {"rpkm": rpkm, "coverage": F.try_divide(F.col("bases"), F.col("length")), "tpm": F.try_divide(rate * 1e6, F.col("_rates"))}
    return out.select("feature", "sample", "reads", "bases", "length", *(F.coalesce(v, F.lit(0.0)).alias(k) for k, v in shares.items()))


def share(counts: DataFrame) -> DataFrame:
    """Each feature's percentage of its sample's reads."""
    return with_totals(counts, _total="reads").select("feature", "sample", "reads", F.try_divide(F.col("reads") * 100.0, F.col("_total")).alias("percent"))


def funcover(genes: DataFrame, taxa: list[str] = (), within: Column | None = None) -> DataFrame:
    """Function coverage of genes (fun array, sample, reads, bases, length): every function of a gene gets its full counts.

    copies counts genes with bases; tpm uses the mean length; a column distinct_<rank> counts taxa for each rank in taxa.
    within: only genes for which it holds (those of a taxon, say) are counted, while the totals use all of them.
    """
    totals = genes.groupBy("sample").agg(F.sum("reads").alias("_total"))
    each = (genes if within is None else genes.filter(within)).withColumn("fun", F.explode("fun"))
    copies = F.count(F.when(F.col("bases") > 0, 1)).alias("copies")
    sums = [F.sum(c).alias(c) for c in ("length", "reads", "bases")]
    agg = each.groupBy("fun", "sample").agg(copies, *sums, *[F.count_distinct(t).alias(f"distinct_{t}") for t in taxa])
    rate = F.coalesce(F.try_divide(F.col("reads"), F.try_divide(F.col("length"), F.col("copies"))), F.lit(0.0))
    agg = with_totals(agg.join(totals, "sample"), _rates=rate)
    own = ("fun", "sample", "copies", "length", "reads", "bases", *(f"distinct_{t}" for t in taxa))
    rpkm = F.try_divide(F.col("reads") * 1e9, F.col("length") * F.col("_total"))
    return agg.select(*own, rpkm.alias("rpkm"), F.try_divide(F.col("bases"), F.col("length")).alias("coverage"), F.try_divide(rate * 1e6, F.col("_rates")).alias("tpm"))


def split_counts(genes: DataFrame) -> DataFrame:
    """Function totals where a gene's reads, bases and length are divided among its functions, copies are not."""
    n = F.size("fun")
    each = genes.select("sample", F.explode("fun").alias("fun"), *[(F.col(c) / n).alias(c) for c in ("reads", "bases", "length")])
    return each.groupBy("fun", "sample").agg(F.sum("reads").alias("reads"), F.sum("bases").alias("bases"), F.sum("length").alias("length"), F.count("*").alias("copies"))


def copy_number(coverage: DataFrame, markers: list[str]) -> DataFrame:
    """Coverage over the sample's median coverage of the marker functions; null if a marker's coverage is 0 or none is there."""
    base = coverage.filter(F.col("fun").isin(*markers)).groupBy("sample").agg(F.when(F.min("coverage") > 0, F.median("coverage")).alias("base"))
    return coverage.join(base, "sample", "left").select("fun", "sample", F.try_divide("coverage", "base").alias("copy_number"))


def rollup_paths(members: DataFrame, ranks: list[str], sums: list[str]) -> DataFrame:
    """Sums over every leading path of a lineage: rank, path and the sums.

    A null rank ends the lineage: a member counts at the ranks above its first gap, and one without a top rank not at all.
    """
    known = F.array(*ranks)
    upto = F.array_position(F.transform(known, lambda x: x.isNull()), F.lit(True))
    depth = F.when(upto > 0, upto - 1).otherwise(F.lit(len(ranks))).cast("int")
    paths = F.when(depth > 0, F.transform(F.sequence(F.lit(1), depth), lambda i: F.array_join(F.slice(known, 1, i), ";")))
    each = members.select(*sums, F.posexplode(paths).alias("depth", "path"))
    names = F.array(*[F.lit(r) for r in ranks])
    return each.groupBy("depth", "path").agg(*[F.sum(s).alias(s) for s in sums]).withColumn("rank", F.element_at(names, F.col("depth") + 1)).drop("depth")


def taxa_percent(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """taxon, sample, reads, percent of the sample's total reads, and an Unmapped row for what is missing."""
    own = counts.groupBy("taxon", "sample").agg(F.sum("reads").alias("reads"))
    mapped = own.groupBy("sample").agg(F.sum("reads").alias("mapped"))
    missing = totals.join(mapped, "sample", "left").select(F.lit("Unmapped").alias("taxon"), "sample", (F.col("total") - F.coalesce("mapped", F.lit(0))).alias("reads"))
    return own.unionByName(missing).join(totals, "sample").select("taxon", "sample", "reads", F.try_divide(F.col("reads") * 100.0, F.col("total")).alias("percent"))


def bin_abundance(contigs: DataFrame, totals: DataFrame) -> DataFrame:
    """Bins' reads, bases, length, coverage and coverage per million reads; contigs without a bin are ``No bin``."""
    own = contigs.groupBy(F.coalesce("bin", F.lit("No bin")).alias("bin"), "sample").agg(F.sum("reads").alias("reads"), F.sum("bases").alias("bases"), F.sum("length").alias("length"))
    own = own.join(totals, "sample").withColumn("coverage", F.try_divide("bases", "length"))
    return own.select("bin", "sample", "reads", "bases", "length", F.try_divide(F.col("reads") * 100.0, F.col("total")).alias("percent"), "coverage", F.try_divide("coverage", F.col("total") / 1e6).alias("cpm"))


def collapsed(taxa: DataFrame, prefix_only: bool = True) -> DataFrame:
    """Partial classifications summed into one ``Unclassified`` row per sample."""
    partial = F.col("taxon").startswith("Unclassified ") if prefix_only else F.col("taxon").rlike("[Uu]nclassified")
    return taxa.groupBy(F.when(partial, "Unclassified").otherwise(F.col("taxon")).alias("taxon"), "sample").agg(F.sum("reads").alias("reads"))


def trusted(genes: DataFrame, column: str, mode: str = "mask") -> DataFrame:
    """Only annotations marked ``*`` count: others become Unclassified (mask) or their rows go (skip)."""
    star = F.col(column).endswith("*")
    if mode == "skip":
        return genes.filter(F.col(column).isNull() | star)
    return genes.withColumn(column, F.when(star, F.col(column)).otherwise("Unclassified"))


def pivoted(long: DataFrame, feature: str, sample: str, value: str, samples: list[str]) -> DataFrame:
    """The wide table of a tidy one; what is missing is 0."""
    return long.groupBy(feature).pivot(sample, samples).agg(F.sum(value)).na.fill(0)

"""Mapping statistics, function tables, run statistics and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.operators.abundance import with_totals
from taxalith.operators.ranking import n_percent
from taxalith.params import SENTINELS


def contig_coverage(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    """contig, sample, reads, bases, length, coverage, rpkm, tpm from alignments (sample, contig, seq_len) and lengths.

    Bases are those of whole reads, not of their aligned parts; unmapped reads (null contig) count nowhere.
    """
    own = alignments.filter("contig is not null").groupBy("contig", "sample").agg(F.count("*").alias("reads"), F.sum("seq_len").alias("bases"))
    rate = F.col("reads") / F.col("length")
    out = with_totals(own.join(contigs.select("contig", "length"), "contig"), _reads="reads", _rates=rate)
    values = {"coverage": F.col("bases") / F.col("length"), "rpkm": F.col("reads") * 1e9 / (F.col("length") * F.col("_reads")), "tpm": rate * 1e6 / F.col("_rates")}
    return out.select("contig", "sample", "reads", "bases", "length", *(v.alias(k) for k, v in values.items()))


def mapping_statistics(alignments: DataFrame) -> DataFrame:
    """sample, total and mapped reads, per cent mapped, total bases; low: under half of them mapped."""
    mapped = F.count(F.when(F.col("contig").isNotNull(), 1))
    percent = mapped * 100.0 / F.count("*")
    return alignments.groupBy("sample").agg(F.count("*").alias("total_reads"), mapped.alias("mapped_reads"), percent.alias("percent"), F.sum("seq_len").alias("total_bases"), (percent < 50).alias("low"))


def function_table(genes: DataFrame, separator: str = ";", unclassified: bool = True) -> DataFrame:
    """fun, sample, reads, bases, coverage, tpm, tpm_rescaled, copies of genes (fun, sample, reads, bases, coverage, tpm).

    fun holds one function or several; those share a gene's amounts, while each counts a copy where the gene has reads. tpm is
    the sum of the genes' own; rescaled to a million by sample.
    """
    parts = F.filter(F.split(F.coalesce("fun", F.lit("Unclassified")), separator, -1), lambda x: x != "")
    many = F.size(parts)
    shares = [(F.col(c) / many).alias(c) for c in ("reads", "bases", "coverage", "tpm")]
    each = genes.select("sample", F.explode(parts).alias("fun"), (F.col("reads") > 0).cast("int").alias("copies"), *shares)
    if not unclassified:
        each = each.filter("fun != 'Unclassified'")
    own = each.groupBy("fun", "sample").agg(*(F.sum(c).alias(c) for c in ("reads", "bases", "coverage", "tpm", "copies")))
    out = with_totals(own, _tpm="tpm")
    return out.select(*own.columns, F.coalesce(F.try_divide(F.col("tpm") * 1e6, F.col("_tpm")), F.lit(0.0)).alias("tpm_rescaled"))


def split_function_table(genes: DataFrame, reference: str | None = None, unclassified: bool = True) -> DataFrame:
    """fun, sample, reads (rounded), bases, coverage, length, copies, tpm, copy_number of genes with an array fun.

    A gene's amounts and length are divided among its functions, copies are not; tpm from reads over the mean length in
    kilobases. copy_number: coverage over that of the reference function in the sample.
    """
    many = F.size("fun")
    shares = [(F.col(c) / many).alias(c) for c in ("reads", "bases", "length")] + [(F.col("bases") / F.col("length") / many).alias("coverage")]
    each = genes.select("sample", F.explode("fun").alias("fun"), *shares)
    if not unclassified:
        each = each.filter("fun != 'Unclassified'")
    own = each.groupBy("fun", "sample").agg(*(F.sum(c).alias(c) for c in ("reads", "bases", "length", "coverage")), F.count("*").alias("copies"))
    rate = F.coalesce(F.try_divide(F.col("reads"), F.col("length") / F.col("copies") / 1000), F.lit(0.0))
    out = with_totals(own, _rates=rate)
    base = own.filter(F.col("fun") == F.lit(reference)).select("sample", F.col("coverage").alias("_base"))
    out = out.join(base, "sample", "left")
    tpm = F.coalesce(F.try_divide(rate * 1e6, F.col("_rates")), F.lit(0.0))
    return out.select("fun", "sample", F.round("reads").alias("reads"), "bases", "length", "coverage", "copies", tpm.alias("tpm"), F.try_divide("coverage", "_base").alias("copy_number"))


def with_no_cds(taxa: DataFrame, no_cds: DataFrame, mode: str = "separate") -> DataFrame:
    """taxon, sample, reads with the reads of contigs without genes (sample, reads): as ``No CDS``, among Unclassified, or not."""
    if mode not in ("separate", "merged", "ignored"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != "ignored":
        label = "No CDS" if mode == "separate" else "Unclassified"
        taxa = taxa.unionByName(no_cds.select(F.lit(label).alias("taxon"), "sample", "reads"))
    return taxa.groupBy("taxon", "sample").agg(F.sum("reads").alias("reads"))


def without_sentinels(rows: DataFrame, column: str = "feature", names: tuple[str, ...] = SENTINELS) -> DataFrame:
    return rows.filter(~F.coalesce(F.col(column), F.lit("")).isin(*names))


def _long(section: str, wide: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for c in wide.columns]
    return wide.select(F.lit(section).alias("section"), F.inline(F.array(*pairs)))


def run_statistics(contigs: DataFrame, orfs: DataFrame, bins: DataFrame, ranks: list[str], functions: list[str]) -> DataFrame:
    """section, metric and value of a run.

    contigs (length, disparity, rank columns), orfs (rank and function columns), bins (completeness, contamination).
    """
    if_ = lambda test: F.count(F.when(test, 1))
    d, comp, cont = F.col("disparity"), F.col("completeness"), F.col("contamination")
    of_contigs = contigs.agg(
        F.count("*").alias("contigs"), F.sum("length").alias("bases"), F.max("length").alias("longest"), F.min("length").alias("shortest"),
        *(if_(F.col(r).isNotNull()).alias(f"at {r}") for r in ranks),
        if_(d == 0).alias("congruent"), if_(d > 0).alias("disparate"), if_(d >= 0.1).alias("disparity >= 0.1"), if_(d >= 0.25).alias("disparity >= 0.25"),
    )
    of_orfs = orfs.agg(
        F.count("*").alias("orfs"),
        *(if_(F.col(r).isNotNull()).alias(f"at {r}") for r in ranks),
        *(if_(F.col(f).isNotNull()).alias(f"with {f}") for f in functions),
        *(if_(F.col(f).endswith("*")).alias(f"trusted {f}") for f in functions),
    )
    of_bins = bins.agg(
        F.count("*").alias("bins"), *(if_(comp >= n).alias(f"complete >= {n}") for n in (50, 75, 90)),
        if_(cont < 10).alias("contaminated < 10"), if_(cont >= 50).alias("contaminated >= 50"),
        if_((comp >= 90) & (cont < 10)).alias("high quality"), if_((comp >= 75) & (cont < 10)).alias("good quality"),
    )
    return reduce(DataFrame.unionByName, [_long(n, w) for n, w in (("contigs", of_contigs), ("orfs", of_orfs), ("bins", of_bins))])


def project_summary(genes: DataFrame, totals: DataFrame, contigs: DataFrame, rank: str) -> DataFrame:
    """sample, reads in genes and their share of all reads (sample, total), taxa at a rank and the most abundant one.

    genes (sample, reads, contig, rank column), contigs (contig, length): beside them N50 and N90 of all contigs.
    """
    own = genes.groupBy("sample").agg(F.sum("reads").alias("reads"))
    by_taxon = without_sentinels(genes.filter(F.col(rank).isNotNull()), rank).groupBy("sample", rank).agg(F.sum("reads").alias("r"))
    top = by_taxon.groupBy("sample").agg(F.count("*").alias("taxa"), F.min(F.struct((-F.col("r")).alias("k"), F.col(rank).alias("name"))).alias("w"))
    lengths = contigs.select(F.lit(1).alias("grp"), "length")
    n50, n90 = ((r.n_length if (r := n_percent(lengths, p).first()) else 0) for p in (50, 90))
    out = totals.join(own, "sample", "left").join(top, "sample", "left")
    return out.select("sample", F.coalesce("reads", F.lit(0)).alias("reads"), (F.coalesce("reads", F.lit(0)) * 100.0 / F.col("total")).alias("percent"), F.coalesce("taxa", F.lit(0)).alias("taxa"), F.col("w.name").alias("dominant"), F.lit(n50).alias("n50"), F.lit(n90).alias("n90"))

"""Projects: base tables with lazily derived ones, subsets and combinations."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxalith.operators import abundance
from taxalith.operators.query import select, subset_by_pattern


@dataclass(frozen=True)
class Project:
    """orfs (orf, contig, length, fun array and rank columns), counts (orf, sample, reads, bases), contigs (contig, bin, ranks)."""

    name: str
    orfs: DataFrame
    counts: DataFrame
    contigs: DataFrame
    ranks: list[str] = field(default_factory=list)

    @classmethod
    def load(cls, spark: SparkSession, path: str, name: str, ranks: list[str]) -> Project:
        return cls(name, *(spark.read.parquet(f"{path}/{t}") for t in ("orfs", "counts", "contigs")), ranks)

    def save(self, path: str) -> None:
        for t in ("orfs", "counts", "contigs"):
            getattr(self, t).write.mode("overwrite").parquet(f"{path}/{t}")

    # derived tables: always of what the project holds now
    def genes(self) -> DataFrame:
        return self.counts.join(self.orfs, "orf")

    def functions(self) -> DataFrame:
        return abundance.funcover(self.genes().select("fun", "sample", "reads", "bases", "length"))

    def taxa(self, rank: str) -> DataFrame:
        return self.genes().groupBy(F.col(rank).alias("taxon"), "sample").agg(F.sum("reads").alias("reads"))

    def tpm(self) -> DataFrame:
        return abundance.tpm(self.genes().select(F.col("orf").alias("feature"), "sample", "reads", "bases", "length"))

    # subsets restrict every table
    def subset_orfs(self, keys: DataFrame, allow_empty: bool = False) -> Project:
        keys = keys.select("orf").distinct()
        orfs = self.orfs.join(keys, "orf", "left_semi")
        if not allow_empty and orfs.isEmpty():
            raise ValueError("the subset holds no ORF")
        return replace(self, orfs=orfs, counts=self.counts.join(keys, "orf", "left_semi"), contigs=self.contigs.join(orfs.select("contig").distinct(), "contig", "left_semi"))

    def subset_query(self, query: str, allow_empty: bool = False) -> Project:
        return self.subset_orfs(select(self.orfs, query, taxa={r.upper(): r for r in self.ranks}, functions={"FUN": ["fun"]}), allow_empty)

    def subset_fun(self, pattern: str, columns: list[str], **options) -> Project:
        return self.subset_orfs(subset_by_pattern(self.orfs, pattern, columns, **options))

    def subset_tax(self, rank: str, taxa: list[str], allow_empty: bool = False) -> Project:
        return self.subset_contigs(self.contigs.filter(F.col(rank).isin(*taxa)), allow_empty)

    def subset_contigs(self, keys: DataFrame, allow_empty: bool = False) -> Project:
        return self.subset_orfs(self.orfs.join(keys.select("contig").distinct(), "contig", "left_semi"), allow_empty)

    def subset_bins(self, bins: list[str], allow_empty: bool = False) -> Project:
        return self.subset_contigs(self.contigs.filter(F.col("bin").isin(*bins)), allow_empty)

    def subset_random(self, n: int, seed: int = 0) -> Project:
        return self.subset_orfs(self.orfs.orderBy(F.xxhash64("orf", F.lit(seed)), "orf").limit(n))

    def subset_samples(self, names: list[str]) -> Project:
        """Only these samples; ORFs without reads in them go."""
        counts = self.counts.filter(F.col("sample").isin(*names))
        kept = counts.groupBy("orf").agg(F.sum("reads").alias("r")).filter("r > 0")
        return replace(self, counts=counts).subset_orfs(kept)

    def rename_samples(self, names: dict[str, str]) -> Project:
        renamed = reduce(lambda c, kv: c.when(F.col("sample") == kv[0], kv[1]), names.items(), F.when(F.lit(False), "")).otherwise(F.col("sample"))
        return replace(self, counts=self.counts.withColumn("sample", renamed))


def union_by_priority(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All rows of the frames; of a key that several hold, the first frame's."""
    marked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("_p", F.lit(i)) for i, f in enumerate(frames)])
    return marked.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_p"))).filter("_r = 1").drop("_p", "_r")


def combine_subsets(*projects: Project) -> Project:
    """The union of subsets of one project; derived tables follow."""
    first = projects[0]
    return replace(first, orfs=union_by_priority([p.orfs for p in projects], ["orf"]), counts=union_by_priority([p.counts for p in projects], ["orf", "sample"]), contigs=union_by_priority([p.contigs for p in projects], ["contig"]))


def combine_tables(tables: list[DataFrame]) -> DataFrame:
    """Long feature tables (feature, sample, value) of several projects; a sample in two of them is an error."""
    names = [t.select("sample").distinct() for t in tables]
    twice = reduce(DataFrame.unionByName, names).groupBy("sample").count().filter("count > 1")
    if bad := twice.limit(5).collect():
        raise ValueError(f"samples in several tables: {[r.sample for r in bad]}")
    return reduce(DataFrame.unionByName, tables)


def completed(tax: DataFrame, keys: DataFrame, label: str = "Unclassified") -> DataFrame:
    """(key, taxon) with a labelled row for every key that has none."""
    return tax.unionByName(keys.join(tax, "key", "left_anti").select("key", F.lit(label).alias("taxon")))

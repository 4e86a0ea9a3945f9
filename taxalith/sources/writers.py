"""Sinks: feature tables and the exchange formats of other tools."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.operators.abundance import pivoted
from taxalith.params import DEFAULTS


def feature_table(long: DataFrame, path: str, samples: list[str], feature: str = "feature", sample: str = "sample", value: str = "value") -> None:
    """One sorted TSV, an empty first header cell, a column per sample."""
    wide = pivoted(long, feature, sample, value, samples).orderBy(feature)
    wide.withColumnRenamed(feature, " ").coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)


def stamp(funcover: DataFrame, samples: list[str], least_reads: int = DEFAULTS.min_reads_exported) -> DataFrame:
    """Functions with enough reads, a column of reads for each sample."""
    enough = funcover.groupBy("fun").agg(F.sum("reads").alias("t")).filter(F.col("t") >= least_reads).select("fun")
    return pivoted(funcover.join(enough, "fun", "left_semi"), "fun", "sample", "reads", samples)


def stamp_profile(funcover: DataFrame, classes: DataFrame, samples: list[str]) -> DataFrame:
    """Every function's reads by sample, behind its class and name (fun, class, name); unknown ones are ``Unclassified``."""
    counts = pivoted(funcover, "fun", "sample", "reads", samples)
    named = classes.dropDuplicates(["fun"]).select("fun", "class", "name")
    out = counts.join(named, "fun", "left").na.fill("Unclassified", ["class"]).withColumn("name", F.coalesce("name", "fun"))
    return out.select("class", "name", "fun", *samples)


def clade_report(taxa: DataFrame, ranks: list[str], least_percent: float = 0.01) -> DataFrame:
    """sample, path, percent, clade and direct reads: direct are a clade's reads less its children's."""
    each = taxa.select("sample", "reads", F.posexplode(F.array(*[F.concat_ws(";", *ranks[: i + 1]) for i in range(len(ranks))])).alias("depth", "path"), F.size(F.array_compact(F.array(*ranks))).alias("known")).filter("depth < known")
    clade = each.groupBy("sample", "depth", "path").agg(F.sum("reads").alias("clade_reads"), F.sum(F.when(F.col("depth") == F.col("known") - 1, F.col("reads")).otherwise(0)).alias("direct_reads"))
    total = taxa.groupBy("sample").agg(F.sum("reads").alias("total"))
    names = F.array(*[F.lit(r[:1].upper()) for r in ranks])
    out = clade.join(total, "sample").withColumn("percent", F.col("clade_reads") * 100.0 / F.col("total")).filter(F.col("percent") >= least_percent)
    return out.select("sample", F.round("percent", 4).alias("percent"), "clade_reads", "direct_reads", F.element_at(names, F.col("depth") + 1).alias("rank"), "path")


def krona(taxa: DataFrame, ranks: list[str]) -> DataFrame:
    return taxa.filter("reads > 0").select("sample", "reads", F.concat_ws("\t", *ranks).alias("taxonomy"))


def ipath(genes: DataFrame, colours: dict[str, str], default: str = "#ff0000", taxon: str | None = None) -> DataFrame:
    """Functions present, optionally within a taxon's lineage, with a colour."""
    chosen = genes.filter(F.col("lineage").rlike(taxon)) if taxon else genes
    paint = reduce(lambda c, kv: c.when(F.col("fun") == kv[0], kv[1]), colours.items(), F.when(F.lit(False), "")).otherwise(default)
    return chosen.select(F.explode("fun").alias("fun")).distinct().withColumn("colour", paint)


def itol_bins(bins: DataFrame, completeness: float, contamination: float) -> DataFrame:
    return bins.filter((F.col("completeness") >= completeness) & (F.col("contamination") <= contamination))


def fasta(seqs: DataFrame, path: str) -> None:
    """Writes id and seq as FASTA; ValueError for ids that come twice."""
    if bad := seqs.groupBy("id").count().filter("count > 1").limit(5).collect():
        raise ValueError(f"repeated ids: {[r.id for r in bad]}")
    seqs.select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").text(path)


def binned_change(values: DataFrame, edges: list[float]) -> DataFrame:
    """Interval number of each value among ascending edges, as colours for a map."""
    return values.withColumn("interval", reduce(lambda a, e: a + F.when(F.col("log2fc") >= e, 1).otherwise(0), edges, F.lit(0)))


def newick(edges: list[tuple[str, str]]) -> str:
    """The tree of (parent, child) edges; ValueError if a node has two parents or there is no single root."""
    parent: dict[str, str] = {}
    for p, c in edges:
        if parent.setdefault(c, p) != p:
            raise ValueError(f"{c} has several parents")
    children: dict[str, list[str]] = {}
    for c, p in sorted(parent.items()):
        children.setdefault(p, []).append(c)
    roots = sorted(set(children) - set(parent))
    if len(roots) != 1:
        raise ValueError(f"{len(roots)} roots")

    def text(n: str) -> str:
        return (f"({','.join(map(text, children[n]))})" if n in children else "") + n

    return text(roots[0]) + ";"

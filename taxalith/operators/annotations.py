"""Annotations of genes: lists, dictionaries, wide tables, and choices between sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SOURCES: dict[str, DataFrame] = {}
_OPERATORS: dict[str, Callable] = {}


def register_annotation_source(name: str, hits: DataFrame) -> None:
    """Adds a function database: its hits (query, fun, score, overlap, hit_order)."""
    _SOURCES[name] = hits


def register_operator(name: str, operator: Callable) -> None:
    """Adds an operator that ``operator`` finds by name."""
    _OPERATORS[name] = operator


def operator(name: str) -> Callable:
    return _OPERATORS[name]


def annotation_sources(names: list[str] | None = None) -> DataFrame:
    """The hits of the named sources, of all by default, with a column db."""
    chosen = [_SOURCES[n].withColumn("db", F.lit(n)) for n in (names or sorted(_SOURCES))]
    if not chosen:
        raise ValueError("no annotation source is registered")
    return reduce(DataFrame.unionByName, chosen)


def contig_of(orf: Column) -> Column:
    """The contig's name within an ORF's: what stands before ``_start-end`` or ``|number``."""
    return F.regexp_replace(orf, r"(_\d+-\d+|\|\d+)$", "")


def family_list(domains: DataFrame) -> DataFrame:
    """orf and its distinct families (orf, accession, name), sorted, as ``accession [name]`` joined by ``;``."""
    label = F.concat("accession", F.coalesce(F.concat(F.lit(" ["), "name", F.lit("]")), F.lit("")))
    return domains.groupBy("orf").agg(F.array_join(F.sort_array(F.collect_set(label)), ";").alias("families"))


def annotation_summary(annotations: DataFrame) -> DataFrame:
    """fun, how many genes (orf, fun) have it, and their names in order."""
    genes = annotations.select("fun", "orf").distinct()
    return genes.groupBy("fun").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("orf")), ";").alias("orfs"))


def described(rows: DataFrame, dictionary: DataFrame, key: str = "fun") -> DataFrame:
    """rows with name, function and path of their function from a dictionary (id, name, function, path); unknown: empty."""
    known = dictionary.dropDuplicates(["id"]).select(F.col("id").alias(key), "name", "function", "path")
    return rows.join(known, key, "left").na.fill("", ["name", "function", "path"])


def containing(genes: DataFrame, functions: DataFrame, part: str) -> DataFrame:
    """Distinct entities of genes (entity, gene) with a function (gene, fun) that contains part."""
    return genes.join(functions.filter(F.col("fun").contains(part)), "gene").select("entity").distinct()


def by_read(orfs: DataFrame, found: DataFrame) -> DataFrame:
    """ORFs (orf, read) that are found (id), whose read is, or that share a read with a found ORF."""
    ids = found.select("id").distinct()
    named = orfs.join(ids, orfs["orf"] == ids["id"], "left_semi").select("read")
    reads = named.unionByName(ids.select(F.col("id").alias("read"))).distinct()
    return orfs.join(reads, "read", "left_semi")


def wide(long: DataFrame, key: str, samples: list[str], measures: dict[str, str]) -> DataFrame:
    """One row per key with a column for each measure and sample, 0 where there is none; measures: column to title."""
    sums = [F.sum(c).alias(title) for c, title in measures.items()]
    out = long.groupBy(key).pivot("sample", samples).agg(*sums)
    names = {f"{s}_{t}" if len(measures) > 1 else s: f"{t} {s}" for s in samples for t in measures.values()}
    return out.select(key, *(F.coalesce(F.col(f"`{a}`"), F.lit(0)).alias(b) for a, b in names.items()))


def orf_table(orfs: DataFrame, counts: DataFrame, samples: list[str], measures: dict[str, str], **annotations: DataFrame) -> DataFrame:
    """The wide table of all ORFs of orfs (orf and own columns): their contig, each annotation (orf, and columns), measures.

    Annotations of ORFs that aren't there are dropped; ORFs without one have nulls, and 0 reads where they have none.
    """
    out = orfs.withColumn("contig", contig_of(F.col("orf")))
    for name, table in annotations.items():
        columns = [c for c in table.columns if c != "orf"]
        own = table.dropDuplicates(["orf"]).select("orf", *(F.col(c).alias(name if len(columns) == 1 else f"{name} {c}") for c in columns))
        out = out.join(own, "orf", "left")
    return out.join(wide(counts, "orf", samples, measures), "orf", "left").na.fill(0, [f"{t} {s}" for t in measures.values() for s in samples])


def contig_table(lineages: DataFrame, coverage: DataFrame, bins: DataFrame, samples: list[str], measures: dict[str, str]) -> DataFrame:
    """The wide table of every contig that any of the tables holds: lineage columns, measures by sample, and its bins."""
    keys = reduce(DataFrame.unionByName, [t.select("contig") for t in (lineages, coverage, bins)]).distinct()
    named = bins.groupBy("contig").agg(F.array_join(F.sort_array(F.collect_set("bin")), ";").alias("bins"))
    out = keys.join(lineages.dropDuplicates(["contig"]), "contig", "left").join(wide(coverage, "contig", samples, measures), "contig", "left")
    return out.join(named, "contig", "left").na.fill(0, [f"{t} {s}" for t in measures.values() for s in samples])


def enzymes(genes: DataFrame, numbers: DataFrame) -> DataFrame:
    """Each gene's (gene, fun) enzyme numbers, from pairs (fun, ec)."""
    return genes.join(numbers.select("fun", "ec").distinct(), "fun").select("gene", "fun", "ec")


def merged_predictions(predicted: DataFrame, found: DataFrame, annotated: DataFrame) -> DataFrame:
    """Predicted genes (orf, ...) that are annotated (orf), and all found by alignment, which win where both hold a name."""
    kept = predicted.join(annotated.select("orf").distinct(), "orf", "left_semi").join(found.select("orf"), "orf", "left_anti")
    return kept.withColumn("method", F.lit("predicted")).unionByName(found.withColumn("method", F.lit("aligned")))


def models_matching(models: DataFrame, patterns: list[str]) -> DataFrame:
    """Models (name, accession, description) that match any of the patterns, or none of those that start with ``!``."""
    out = [p for p in patterns if p.startswith("!")]
    if out and len(out) < len(patterns):
        raise ValueError("patterns to include and to exclude can't be mixed")
    any_of = lambda p: reduce(lambda a, b: a | b, [F.coalesce(F.col(c).rlike(p), F.lit(False)) for c in ("name", "accession", "description")])
    hit = reduce(lambda a, b: a | b, [any_of(p.removeprefix("!")) for p in patterns], F.lit(False))
    return models.filter(~hit if out else hit)


def of_taxa(entries: DataFrame, lineages: DataFrame, taxa: list[str], exclude: bool = False) -> DataFrame:
    """Entries (entry, species) of a database with a species whose lineage (species, taxon) holds one of taxa.

    exclude: those with a species outside of taxa instead, so an entry of several species goes only if all are listed.
    """
    listed = lineages.filter(F.col("taxon").isin(*taxa)).select("species").distinct()
    hit = entries.join(listed, "species", "left_anti" if exclude else "left_semi").select("entry").distinct()
    return entries.join(hit, "entry", "left_semi")


def host_split(reads: DataFrame, mapped: DataFrame, key: str = "read") -> tuple[DataFrame, DataFrame]:
    """Reads that do not map to a host, and those that do."""
    host = mapped.select(key).distinct()
    return reads.join(host, key, "left_anti"), reads.join(host, key, "left_semi")


def first_alignments(alignments: DataFrame) -> DataFrame:
    """Of each read's (read, line, ...) alignments in a sample the first one."""
    order = Window.partitionBy("sample", "read").orderBy("line")
    return alignments.withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r")


def numbered(contigs: DataFrame, prefix: str, order: list) -> DataFrame:
    """Contigs renamed to prefix_1, prefix_2, ... in an order, with their old name as old.

    Places come from counts by range: rows are dealt out by the order, so no task holds all of them.
    """
    dealt = contigs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = dealt.withColumn("row", F.monotonically_increasing_id())
    sizes = placed.groupBy("part").agg(F.count("*").alias("many"), F.min("row").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "first", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.col("row") - F.col("first") + 1
    renamed = placed.join(starts, "part").withColumn("new", F.concat(F.lit(f"{prefix}_"), number.cast("string")))
    return renamed.select("new", F.col("contig").alias("old"), *(c for c in contigs.columns if c != "contig"))


def by_position(genes: DataFrame) -> DataFrame:
    """Genes (contig, start, end) in the order of their contig's number, then of their places."""
    number = F.regexp_extract("contig", r"(\d+)$", 1).try_cast("long")
    return genes.orderBy(number.asc_nulls_last(), "contig", "start", "end")

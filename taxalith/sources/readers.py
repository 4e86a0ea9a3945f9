"""Readers of the tabular and sequence formats; every one returns a typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

M8 = "query string, subject string, identity double, alen int, mismatches int, gaps int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
FUN = "query string, qlen int, subject string, slen int, identity double, alen int, evalue double, bitscore double, qstart int, qend int, sstart int, send int"
SAM = "read string, flag int, contig string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string"
GFF = "contig string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """TAB-separated rows; blank lines and # comments are skipped, quotes are characters like others."""
    return spark.read.csv(path, sep="\t", comment="#", schema=schema, quote="")


def with_header(spark: SparkSession, path: str) -> DataFrame:
    """A table whose first line is a comment and whose second holds the names."""
    head = spark.read.text(path).filter("value not like '#%'").first().value
    names = [n or "feature" for n in head.split("\t")]
    lines = spark.read.text(path).filter((F.col("value") != head) & ~F.col("value").startswith("#") & (F.col("value") != ""))
    fields = F.split("value", "\t", -1)
    return lines.select(*(F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(names)))


def samples(spark: SparkSession, path: str) -> DataFrame:
    """sample, file, pair, flags; ValueError where a label is unknown or a sample has no pair1."""
    df = tsv(spark, path, "sample string, file string, pair string, flags string")
    df = df.select(*[F.regexp_replace(c, "\r", "").alias(c) for c in df.columns])
    if bad := df.filter("pair not in ('pair1', 'pair2') or pair is null or sample rlike '\\\\s' or file is null").limit(5).collect():
        raise ValueError(f"bad rows in {path}: {bad}")
    if bad := df.join(df.filter("pair = 'pair1'").select("sample").distinct(), "sample", "left_anti").limit(5).collect():
        raise ValueError(f"samples without pair1: {[r.sample for r in bad]}")
    return df


def ordered_hits(spark: SparkSession, path: str, schema: str = M8) -> DataFrame:
    """Hits with hit_order, their place in the file, by file name where there are several.

    Files are read in splits whose places are known: the block's start, and the row within it.
    """
    rows = tsv(spark, path, schema).select("*", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("row"))
    places = rows.groupBy("file", "block").agg(F.min("row").alias("first"), F.count("*").alias("many"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = places.withColumn("start", F.coalesce(F.sum("many").over(before), F.lit(0))).drop("many")
    return rows.join(starts, ["file", "block"]).withColumn("hit_order", F.col("start") + F.col("row") - F.col("first")).drop("file", "block", "row", "first", "start")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id (up to the first space), description and sequence of each record, gzip aware."""
    records = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("r")).filter("trim(r) <> ''")
    head = F.split("r", "\n", 2)
    return records.select(F.split(head[0], r"[ \t\r]")[0].alias("id"), F.rtrim(head[0], F.lit("\r")).alias("description"), F.regexp_replace(F.coalesce(F.get(head, F.lit(1)), F.lit("")), r"\s", "").alias("seq"))


def fastq_count(spark: SparkSession, path: str) -> int:
    lines = spark.read.text(path)
    return lines.filter("value like '>%'").count() if lines.first().value.startswith(">") else lines.count() // 4


def gff(spark: SparkSession, path: str) -> DataFrame:
    """id, contig, start, end, strand, length; the first row of a repeated id stays, swapped ends are put right."""
    rows = tsv(spark, path, GFF).withColumn("id", F.regexp_extract("attributes", "ID=([^;]+)", 1)).withColumn("line", F.monotonically_increasing_id())
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("line"))).filter("r = 1")
    lo, hi = F.least("start", "end"), F.greatest("start", "end")
    return first.select("id", "contig", "type", lo.alias("start"), hi.alias("end"), "strand", (hi - lo + 1).alias("length"))


def domtblout(spark: SparkSession, path: str) -> DataFrame:
    """orf and accession without its version."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter("value not like '#%' and trim(value) <> ''").select(parts[0].alias("orf"), F.regexp_replace(parts[4], r"\.\d+$", "").alias("accession"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments; unmapped reads have a null contig."""
    rows = spark.read.csv(path, sep="\t", comment="@", schema=SAM, quote="")
    return rows.withColumn("contig", F.nullif("contig", F.lit("*")))


def vcf_alleles(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """sample, locus, allele, n from the AD field of each sample's column."""
    fixed = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format"]
    rows = tsv(spark, path, ", ".join(f"`{c}` string" for c in [*fixed, *names]))
    alleles = F.concat(F.array("ref"), F.split("alt", ","))
    place = F.array_position(F.split("format", ":"), F.lit("AD")).cast("int")
    long = rows.select("chrom", "pos", alleles.alias("alleles"), place.alias("place"), F.inline(F.array(*[F.struct(F.lit(n).alias("sample"), F.col(f"`{n}`").alias("v")) for n in names])))
    counts = F.split(F.element_at(F.split("v", ":"), F.col("place")), ",")
    return long.filter("place > 0").select("sample", F.concat_ws(":", "chrom", "pos").alias("locus"), F.explode(F.arrays_zip("alleles", counts.alias("n"))).alias("x")).select("sample", "locus", F.col("x.alleles").alias("allele"), F.col("x.n").cast("long").alias("n"))

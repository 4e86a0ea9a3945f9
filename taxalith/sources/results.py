"""Result folders of a finished analysis: wide tables as long ones, projects, and projects of feature tables only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxalith.functions.names import RANK_LETTERS, made_unique
from taxalith.operators.abundance import with_totals
from taxalith.params import RANKS
from taxalith.project import Project

#: Prefixes of an ORF table's columns by sample, and the measure that each holds. Fixed values.
MEASURES = {"Raw read count ": "reads", "Raw base count ": "bases", "Coverage ": "coverage", "TPM ": "tpm"}
#: Ways to filter taxa, names of function tables and of counts that are known by another name. Fixed values.
TAX_MODES = ("allfilter", "prokfilter", "nofilter")
METHODS, COUNTS = {"KO": "KEGG"}, {"copyNumber": "copy_number"}


def names_in(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """Names of a folder's files; no file is opened, and the folder may be in any store that Spark reads."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return sorted(r.path.rsplit("/", 1)[-1] for r in found.collect())


def rows_of(spark: SparkSession, path: str, skip: int = 0) -> tuple[list[str], DataFrame]:
    """A TAB-separated table's names, which stand after so many lines, and its rows as an array ``f`` of fields.

    Names may lack the first one, of the row names; quotes are characters like others.
    """
    lines = spark.read.text(path).filter("value != ''")
    top = [r.value.rstrip("\r") for r in lines.limit(skip + 2).collect()]
    if len(top) <= skip:
        raise ValueError(f"{path} holds no table")
    names = top[skip].split("\t")
    width = len(top[skip + 1].split("\t")) if skip + 1 < len(top) else len(names)
    body = lines.filter(~F.rtrim("value", F.lit("\r")).isin(*top[: skip + 1])).select(F.split(F.rtrim("value", F.lit("\r")), "\t", -1).alias("f"))
    return (["", *names] if width == len(names) + 1 else names), body


def _text(place: int) -> Column:
    """A field, null where it is empty or missing."""
    return F.nullif(F.get("f", F.lit(place)), F.lit(""))


def matrix(spark: SparkSession, path: str) -> DataFrame:
    """feature, sample, value of a table with a feature a row and a sample a column."""
    names, rows = rows_of(spark, path)
    samples = F.array(*(F.lit(n) for n in names[1:])) if len(names) > 1 else F.array().cast("array<string>")
    each = rows.select(F.col("f")[0].alias("feature"), F.posexplode(F.slice("f", 2, max(1, len(names) - 1))))
    return each.select("feature", F.get(samples, F.col("pos")).alias("sample"), F.expr("try_cast(col as double)").alias("value")).filter("sample is not null")


def _taxonomy(spark: SparkSession, path: str, key: str) -> DataFrame:
    names, rows = rows_of(spark, path)
    ranks = [n.lower() for n in names[1:]]
    return rows.select(F.col("f")[0].alias(key), *(_text(i).alias(n) for i, n in enumerate(ranks, 1)))


def load_project(spark: SparkSession, path: str, name: str, tax_mode: str = "allfilter", function: str = "KEGG ID") -> Project:
    """A project of the ORF table, and of the contig table, the bins of contigs and the taxonomies where they exist.

    function: the ORF table's column of annotations, whose parts are set apart by ``;`` and may end with ``*`` (best average).
    Taxonomies come from ``results/tables``; without them, ORFs have no ranks. A contig in no bin has a null one; of several
    bins, by several methods, it has the first by name.
    """
    if tax_mode not in TAX_MODES:
        raise ValueError(f"tax_mode is one of {TAX_MODES}")
    top = set(names_in(spark, f"{path}/results", f"*.{name}.*"))
    orf_file, contig_file, bin_file = f"13.{name}.orftable", f"19.{name}.contigtable", f"18.{name}.bintable"
    if orf_file not in top:
        raise ValueError(f"{path}/results holds no {orf_file}")
    names, rows = rows_of(spark, f"{path}/results/{orf_file}", skip=1)
    place = {n: i for i, n in enumerate(names)}
    parts = F.filter(F.split(F.coalesce(_text(place[function]), F.lit("")), ";") if function in place else F.array().cast("array<string>"), lambda x: x != "")
    orfs = rows.select(
        F.col("f")[0].alias("orf"),
        _text(place["Contig ID"]).alias("contig"),
        F.expr(f"try_cast(get(f, {place['Length NT']}) as long)").alias("length"),
        F.array_distinct(F.transform(parts, lambda x: F.rtrim(F.trim(x), F.lit("*")))).alias("fun"),
    )
    samples = [n.removeprefix("Raw read count ") for n in names if n.startswith("Raw read count ")]

    def number(measure: str, sample: str) -> Column:
        i = place.get(measure + sample)
        return F.lit(None).cast("double") if i is None else F.expr(f"try_cast(get(f, {i}) as double)")

    by_sample = [F.struct(F.lit(s).alias("sample"), *(number(m, s).alias(k) for m, k in MEASURES.items())) for s in samples]
    counts = rows.select(F.col("f")[0].alias("orf"), F.inline(F.array(*by_sample))).withColumns({c: F.col(c).cast("long") for c in ("reads", "bases")})

    tables = set()
    if any(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/results").select("path").filter(F.col("path").contains("/tables/")).take(1)):
        tables = set(names_in(spark, f"{path}/results/tables", f"{name}.*"))
    contigs = orfs.select("contig").filter("contig is not null").distinct()
    if contig_file in top:
        contigs = rows_of(spark, f"{path}/results/{contig_file}", skip=1)[1].select(F.col("f")[0].alias("contig"))
    if bin_file in top:
        columns, inside = rows_of(spark, f"{path}/intermediate/18.{name}.contigsinbins", skip=1)
        at = columns.index("Bin ID") if "Bin ID" in columns else len(columns) - 1
        contigs = contigs.join(inside.groupBy(F.col("f")[0].alias("contig")).agg(F.min(_text(at)).alias("bin")), "contig", "left")
    else:
        contigs = contigs.withColumn("bin", F.lit(None).cast("string"))
    ranks: list[str] = []
    if f"{name}.orf.tax.{tax_mode}.tsv" in tables:
        taxa = _taxonomy(spark, f"{path}/results/tables/{name}.orf.tax.{tax_mode}.tsv", "orf")
        ranks, orfs = taxa.columns[1:], orfs.join(taxa, "orf", "left")
    if f"{name}.contig.tax.{tax_mode}.tsv" in tables:
        contigs = contigs.join(_taxonomy(spark, f"{path}/results/tables/{name}.contig.tax.{tax_mode}.tsv", "contig"), "contig", "left")
    return Project(name, orfs, counts, contigs, ranks)


@dataclass(frozen=True)
class Lite:
    """Feature tables of a project: taxa, functions, names and totals, all long."""

    name: str
    #: rank, lineage, taxon (its last name, made unique within the rank), sample, reads, percent
    taxa: DataFrame
    #: method, count, feature, sample, value
    functions: DataFrame
    #: method, feature, name, path
    names: DataFrame
    #: sample, reads
    totals: DataFrame


def _union(frames: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for f in frames:
        out = out.unionByName(f)
    return out


def load_lite(spark: SparkSession, path: str, tax_mode: str = "allfilter") -> Lite:
    """A folder of feature tables, whose names say the project, the rank or method, and the count."""
    if tax_mode not in TAX_MODES:
        raise ValueError(f"tax_mode is one of {TAX_MODES}")
    files = names_in(spark, path, "*.tsv")
    ending = ".superkingdom.allfilter.abund.tsv"
    name = next((f.removesuffix(ending) for f in files if f.endswith(ending)), None)
    if name is None:
        raise ValueError(f"{path} holds no feature tables")
    taxa = []
    for rank in RANKS:
        long = matrix(spark, f"{path}/{name}.{rank}.{tax_mode}.abund.tsv").withColumnsRenamed({"feature": "lineage", "value": "reads"})
        prefix = f"^{RANK_LETTERS[rank]}_" if rank == RANKS[0] else f"^.*?;{RANK_LETTERS[rank]}_"
        short = long.select("lineage").distinct().withColumn("taxon", F.regexp_replace("lineage", prefix, ""))
        # Two lineages may end with one name.
        long = long.join(made_unique(short, "taxon", ["lineage"]), "lineage")
        long = with_totals(long, _total="reads").withColumn("percent", F.try_divide(F.col("reads") * 100, F.col("_total")))
        taxa.append(long.select(F.lit(rank).alias("rank"), "lineage", "taxon", "sample", "reads", "percent"))
    parts = [f.removeprefix(f"{name}.").removesuffix(".tsv").split(".") for f in files if f.startswith(f"{name}.")]
    methods = [p[0] for p in parts if len(p) == 2 and p[1] == "abund"]
    functions, names = [], []
    for method, count in (p for p in parts if len(p) == 2 and p[0] in methods):
        file, known = f"{path}/{name}.{method}.{count}.tsv", F.lit(METHODS.get(method, method)).alias("method")
        if count == "names":
            columns, rows = rows_of(spark, file)
            said = [_text(columns.index(c)) if c in columns else F.lit(None).cast("string") for c in ("Name", "Path")]
            names.append(rows.select(known, F.col("f")[0].alias("feature"), said[0].alias("name"), said[1].alias("path")))
        else:
            functions.append(matrix(spark, file).select(known, F.lit(COUNTS.get(count, count)).alias("count"), "feature", "sample", "value"))
    totals = taxa[0].groupBy("sample").agg(F.sum("reads").alias("reads"))
    every = taxa[0]
    for more in taxa[1:]:
        every = every.unionByName(more)
    return Lite(
        name,
        every,
        _union(functions, spark, "method string, count string, feature string, sample string, value double"),
        _union(names, spark, "method string, feature string, name string, path string"),
        totals,
    )


def sqlite(spark: SparkSession, path: str, query: str, schema: str) -> DataFrame:
    """Rows of a query over SQLite files of up to 2 GB (what one binary value holds), one task a file, in batches."""

    def rows(batches):
        import sqlite3

        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        form = to_arrow_schema(StructType.fromJson(fields))
        for batch in batches:
            for data in batch.column(0):
                with sqlite3.connect(":memory:") as base:
                    base.deserialize(data.as_buffer().to_pybytes())
                    cursor = base.execute(query)
                    while part := cursor.fetchmany(10_000):
                        columns = [pa.array(x, f.type) for x, f in zip(zip(*part), form)]
                        yield pa.RecordBatch.from_arrays(columns, schema=form)

    fields = spark.createDataFrame([], schema).schema.jsonValue()
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, schema)

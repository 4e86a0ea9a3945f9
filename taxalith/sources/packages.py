"""Projects as files: configuration, zip packages, several projects at once, bundles for community analysis."""

from __future__ import annotations

import os
import re
import zipfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxalith.operators.statistics import without_sentinels
from taxalith.project import Project, combine_tables


def conf(text: str) -> dict[str, str]:
    """Settings of lines ``$name = "value";``, where values may hold other settings' names, at any depth.

    Comments, other lines and names that aren't set stay as they are; a setting that holds itself is an error.
    """
    raw = {m[1]: m[2].strip().strip("'\"") for m in re.finditer(r"^\s*\$(\w+)\s*=\s*(.*?);?\s*(?:#.*)?$", text, re.M)}

    def value(name: str, seen: tuple[str, ...]) -> str:
        if name in seen:
            raise ValueError(f"${name} holds itself")
        return re.sub(r"\$\{?(\w+)\}?", lambda m: value(m[1], (*seen, name)) if m[1] in raw else m[0], raw[name])

    return {name: value(name, ()) for name in raw}


def zipped(folder: str, target: str, endings: tuple[str, ...] = ()) -> list[str]:
    """Packs a local folder's files, or those of some endings, and returns their names within the package."""
    names = []
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as package:
        for top, _, files in sorted(os.walk(folder)):
            for f in sorted(files):
                path = os.path.join(top, f)
                if (not endings or f.endswith(endings)) and os.path.abspath(path) != os.path.abspath(target):
                    names.append(os.path.relpath(path, folder))
                    package.write(path, names[-1])
    return names


def member(spark: SparkSession, package: str, name: str, separator: str = "\t") -> DataFrame:
    """A table of strings from a zip package: the header's names, lines with ``#`` before it skipped.

    The package may be in any store that Spark reads; one task unpacks the member and hands its lines out.
    """
    def lines(batches):
        import io

        import pyarrow as pa

        for batch in batches:
            for data in batch.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(data)) as package, io.TextIOWrapper(package.open(name), "utf-8") as text:
                    while part := text.readlines(1 << 20):
                        yield pa.RecordBatch.from_pydict({"value": [x.rstrip("\r\n") for x in part]})

    rows = spark.read.format("binaryFile").load(package).select("content").mapInArrow(lines, "value string").filter("value != '' and value not like '#%'")
    head = rows.first().value
    fields = F.split("value", separator, -1)
    return rows.filter(F.col("value") != head).select(*(F.get(fields, F.lit(i)).alias(n or "feature") for i, n in enumerate(head.split(separator))))


def load_many(spark: SparkSession, paths: dict[str, str], ranks: list[str]) -> dict[str, Project]:
    """Projects by name from their folders."""
    return {name: Project.load(spark, path, name, ranks) for name, path in paths.items()}


def combined_functions(projects: dict[str, Project], values: tuple[str, ...] = ("reads", "bases", "tpm", "coverage")) -> DataFrame:
    """fun, sample and the values that all projects' function tables hold, of all of them; a sample in two is an error."""
    tables = [p.functions() for p in projects.values()]
    common = [v for v in values if all(v in t.columns for t in tables)]
    combine_tables([t.select(F.col("fun").alias("feature"), "sample", F.lit(0).alias("value")) for t in tables])
    return reduce(DataFrame.unionByName, [t.select("fun", "sample", *common) for t in tables])


def community_bundle(long: DataFrame, lineages: DataFrame, metadata: DataFrame, ranks: list[str], samples: list[str], unclassified: bool = True, unmapped: bool = False, partial: str = "keep") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts (a row per feature, a column per sample), ranks by feature, and samples' metadata, which agree in their keys.

    long (feature, sample, value); lineages (feature, ranks); metadata (sample, ...). unmapped and unclassified rows go unless
    asked for. partial: ``Unclassified X`` stays, is summed as ``Unclassified`` (merge), or goes (drop).
    """
    gone = tuple(n for n, stays in (("Unclassified", unclassified), ("Unmapped", unmapped)) if not stays)
    rows = without_sentinels(long, names=(*gone, "")) if gone else long
    some = F.col("feature").startswith("Unclassified ")
    if partial == "merge":
        rows = rows.withColumn("feature", F.when(some, "Unclassified").otherwise(F.col("feature")))
    elif partial == "drop":
        rows = rows.filter(~some)
    elif partial != "keep":
        raise ValueError(f"unknown choice {partial!r}")
    rows = rows.filter(F.col("sample").isin(*samples))
    counts = rows.groupBy("feature").pivot("sample", samples).agg(F.sum("value")).na.fill(0)
    taxa = counts.select("feature").join(lineages.dropDuplicates(["feature"]).select("feature", *ranks), "feature", "left")
    return counts, taxa, metadata.filter(F.col("sample").isin(*samples))

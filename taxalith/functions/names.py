"""Names: ranks, taxa, annotations, units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks and the letter that stands for each in a lineage, longer names first. Fixed values.
RANK_LETTERS = {"superkingdom": "k", "phylum": "p", "class": "c", "order": "o", "family": "f", "genus": "g", "species": "s"}
GTDB = ("d__", "p__", "c__", "o__", "f__", "g__", "s__")
UNITS = (("Tb", 10**12), ("Gb", 10**9), ("Mb", 10**6), ("kb", 10**3))


def lettered(lineage: Column) -> Column:
    """``superkingdom:X;phylum:Y;subphylum:Z`` as ``k_X;p_Y;n_Z``: ranks below and between the main ones are n."""
    out = F.regexp_replace(lineage, r"(^|;)(sub|infra|super(?!kingdom))\w+:", "$1n_")
    for rank, letter in RANK_LETTERS.items():
        out = F.regexp_replace(out, rf"(^|;){rank}:", f"$1{letter}_")
    return F.regexp_replace(out, r"(^|;)[^;:_]+:", "$1n_")


def without_empty(lineage: Column) -> Column:
    """A lineage without ranks that have no name."""
    return F.regexp_replace(F.regexp_replace(lineage, r";\w?_(?=;|$)", ""), r"^\w?_(;|$)", "")


def gtdb_taxa(ranks: list[Column]) -> list[Column]:
    """Names without their prefix; a missing one is ``Unclassified`` and the last name known above it."""
    names = [F.regexp_replace(F.coalesce(c, F.lit("")), f"^{p}", "") for c, p in zip(ranks, GTDB)]
    out = []
    for i, name in enumerate(names):
        above = [F.nullif(n, F.lit("")) for n in reversed(names[:i])]
        last = F.regexp_replace(F.coalesce(*above, F.lit("")), "^Unclassified", "") if above else F.lit("")
        out.append(F.when(name != "", name).otherwise(F.concat(F.lit("Unclassified "), last)))
    return out


def made_unique(rows: DataFrame, name: str, order: list) -> DataFrame:
    """Rows whose repeated names get .1, .2, ... from the second one on."""
    place = F.row_number().over(Window.partitionBy(name).orderBy(*order)) - 1
    marked = rows.withColumn("_place", place)
    return marked.withColumn(name, F.when(F.col("_place") > 0, F.concat_ws(".", name, F.col("_place").cast("string"))).otherwise(F.col(name))).drop("_place")


def families(value: Column) -> Column:
    """Parts of a list like ``PF1 [a; b];PF2 [c]``, which ends each part with a bracket."""
    parts = F.filter(F.split(value, r"\];", -1), lambda x: x != "")
    return F.transform(parts, lambda x: F.when(x.endswith("]") | ~x.contains("["), x).otherwise(F.concat(x, F.lit("]"))))


def human(bases: Column) -> Column:
    """A whole number of bases with two digits and the largest unit that it reaches."""
    number = bases.cast("decimal(20,0)")
    shown = lambda size, unit: F.concat(F.round(number / F.lit(size).cast("decimal(13,0)"), 2).cast("string"), F.lit(f" {unit}"))
    out = shown(1, "b")
    for unit, size in reversed(UNITS):
        out = F.when(bases >= size, shown(size, unit)).otherwise(out)
    return out


def marker_sets(text: Column) -> Column:
    """An array of marker lists from text like ``[set(['a', 'b']), set(['c'])]`` or JSON with single quotes."""
    plain = F.regexp_replace(F.regexp_replace(text, r"set\(|\)", ""), "'", '"')
    return F.from_json(plain, "array<array<string>>")

"""Lineages: ranked strings, missing ranks, prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxalith.params import RANKS


def at_rank(lineage: Column, prefix: str) -> Column:
    """The taxon of one rank in ``k_X;p_Y;...``; null where the rank is missing."""
    return F.nullif(F.regexp_extract(lineage, rf"(?:^|;){prefix}_([^;]*)", 1), F.lit(""))


def filled(ranks: list[Column], names: tuple[str, ...] = RANKS) -> list[Column]:
    """Gaps above a known rank become ``X (no <rank> in NCBI)`` after the next known deeper rank; gaps below the last known
    one ``Unclassified X``; a lineage without any rank is ``Unclassified`` throughout."""
    out = []
    for i, (column, name) in enumerate(zip(ranks, names)):
        deeper = F.coalesce(*ranks[i + 1 :], F.lit(None).cast("string"))
        above = F.coalesce(*reversed(ranks[:i]), F.lit(None).cast("string"))
        below = F.concat(F.lit("Unclassified "), above)
        out.append(F.coalesce(column, F.concat(deeper, F.lit(f" (no {name} in NCBI)")), below, F.lit("Unclassified")))
    return out


def prefixes(ranks: list[Column]) -> Column:
    """All leading paths of a list of ranks, shortest first, as ``a;b;c``."""
    return F.array(*[F.concat_ws(";", *ranks[: i + 1]) for i in range(len(ranks))])


def normalised_species(name: Column) -> Column:
    """Viruses keep their name, Candidatus species three words, bacterium ones theirs, all others two words."""
    words = F.split(name, " ")
    two, three = (F.array_join(F.slice(words, 1, n), " ") for n in (2, 3))
    return F.when(F.lower(name).contains("virus"), name).when(name.startswith("Candidatus "), three).when(F.lower(name).contains("bacterium"), name).otherwise(two)

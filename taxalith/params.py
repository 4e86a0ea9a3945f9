"""Defaults that the operators' semantics depend on."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    score_ratio: float = 0.8
    identity_gap: float = 10.0
    lca_flex: float = 0.2
    lca_min_hits: int = 2
    best_gap: float = 0.1
    best_hits: int = 3
    min_overlap: float = 30.0
    consensus_genes: int = 1
    consensus_of_rank: float = 0.7
    consensus_of_all: float = 0.5
    bin_of_rank: float = 0.6
    bin_of_all: float = 0.3
    min_reads_exported: int = 200
    max_disparity: float = 0.1
    pathway_fraction: float = 0.1
    pathway_number: int = 2


DEFAULTS = Params()

#: Identity that a hit must reach to vote at a rank, deepest rank first. Fixed values.
RANK_IDENTITY = {"species": 85, "genus": 60, "family": 55, "order": 50, "class": 46, "phylum": 42, "superkingdom": 40}
RANKS = ("superkingdom", "phylum", "class", "order", "family", "genus", "species")
SENTINELS = ("Unclassified", "Unmapped", "No CDS", "No bin")

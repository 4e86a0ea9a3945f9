"""Operators whose result depends on the order of steps within a group; a group is a read, a contig or a bin."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse_hits(hits: DataFrame, least_identity: float = 20.0, least_length: int = 0, share: float = 0.8, most: int = 50) -> DataFrame:
    """Clusters of a query's hits (query, subject, start, end, frame, score, identity) that overlap, by frame.

    Hits go in order of place; one joins the running cluster if share of it or of the cluster is common, and only extends
    the cluster's end. A cluster's hits are listed best first, ``subject|score|identity``.
    """

    def per_query(g: pd.DataFrame) -> pd.DataFrame:
        g = g.assign(lo=g[["start", "end"]].min(axis=1), hi=g[["start", "end"]].max(axis=1))
        g = g[(g.identity >= least_identity) & (g.hi - g.lo + 1 >= least_length)].sort_values(["lo", "hi", "subject"])
        cluster, number, lo, hi = [], -1, 0, -1
        for a, b in zip(g.lo, g.hi):
            common = min(b, hi) - max(a, lo) + 1
            if number >= 0 and common > 0 and (common >= share * (b - a + 1) or common >= share * (hi - lo + 1)):
                hi = max(hi, b)
            else:
                number, lo, hi = number + 1, a, b
            cluster.append(number)
        out = []
        for (c, frame), part in g.assign(cluster=cluster).groupby(["cluster", "frame"]):
            part = part.sort_values(["score", "subject"], ascending=[False, True]).head(most)
            out.append((g["query"].iloc[0], int(c), int(frame), int(part.lo.min()), int(part.hi.max()), ";".join(f"{s}|{b:g}|{i:g}" for s, b, i in zip(part.subject, part.score, part.identity))))
        return pd.DataFrame(out, columns=["query", "cluster", "frame", "start", "end", "hits"])

    return hits.groupBy("query").applyInPandas(per_query, "query string, cluster int, frame int, start long, end long, hits string")


def merge_hits(hits: DataFrame, share: float = 0.5) -> DataFrame:
    """Merges a contig's hits (contig, start, end, subjects array) that share subjects, longest first, until nothing changes."""

    def per_contig(g: pd.DataFrame) -> pd.DataFrame:
        rows = [[a, b, set(s)] for a, b, s in zip(g.start, g.end, g.subjects)]
        changed = True
        while changed:
            changed = False
            rows.sort(key=lambda r: (r[0] - r[1], r[0]))
            for i in range(len(rows)):
                for j in range(i + 1, len(rows)):
                    common = len(rows[i][2] & rows[j][2])
                    if common and common / min(len(rows[i][2]), len(rows[j][2])) >= share:
                        rows[i] = [min(rows[i][0], rows[j][0]), max(rows[i][1], rows[j][1]), rows[i][2]]
                        del rows[j]
                        changed = True
                        break
                if changed:
                    break
        return pd.DataFrame([(g.contig.iloc[0], a, b, sorted(s)) for a, b, s in rows], columns=["contig", "start", "end", "subjects"])

    return hits.groupBy("contig").applyInPandas(per_contig, "contig string, start long, end long, subjects array<string>")


def fewest_pathways(families: DataFrame, pathways: DataFrame, fraction: float = 0.1, number: int = 2) -> DataFrame:
    """grp, pathway, found, total, reported: the fewest pathways that explain every observed family of a group.

    Exact branch and bound on what dominance leaves, ties by name; a pathway is reported if it is chosen and enough of it is found.
    """
    sets = pathways.groupBy("pathway").agg(F.collect_set("family").alias("all"))
    met = families.join(pathways, "family").groupBy("grp", "pathway").agg(F.collect_set("family").alias("got")).join(sets, "pathway")

    def per_group(g: pd.DataFrame) -> pd.DataFrame:
        got = {p: frozenset(x) for p, x in zip(g.pathway, g.got)}
        chosen = smallest_cover(got)
        total = dict(zip(g.pathway, g["all"].map(len)))
        rows = [(g.grp.iloc[0], p, len(got[p]), total[p], p in chosen and (len(got[p]) / total[p] >= fraction or len(got[p]) >= number)) for p in sorted(got)]
        return pd.DataFrame(rows, columns=["grp", "pathway", "found", "total", "reported"])

    return met.groupBy("grp").applyInPandas(per_group, "grp string, pathway string, found int, total int, reported boolean")


def smallest_cover(sets: dict[str, frozenset]) -> set[str]:
    """A smallest choice of sets with the same union; dominated sets are dropped before the search."""
    names = sorted(sets, key=lambda p: (-len(sets[p]), p))
    kept: list[str] = []
    for p in names:
        if not any(sets[p] <= sets[q] for q in kept):
            kept.append(p)
    everything = frozenset().union(*sets.values()) if sets else frozenset()
    best: list[list[str]] = [list(kept)]

    def search(chosen: list[str], left: frozenset) -> None:
        if not left:
            if len(chosen) < len(best[0]):
                best[0] = list(chosen)
            return
        widest = max(len(sets[p] & left) for p in kept)
        if len(chosen) + -(-len(left) // widest) >= len(best[0]):
            return
        family = min(left, key=lambda f: (sum(f in sets[p] for p in kept), f))
        for p in sorted((p for p in kept if family in sets[p]), key=lambda p: (-len(sets[p] & left), p)):
            search([*chosen, p], left - sets[p])

    search([], everything)
    return set(best[0])


def select_bins(members: DataFrame, markers: DataFrame, set_size: int, threshold: float = 0.5, most: int = 1000) -> list[tuple[str, float]]:
    """The best-scoring bins of which none shares a contig, in the order chosen: (bin, score).

    score = unique / size - 0.6 duplicated / unique - 0.5 extra / size. Each round scores all bins that are left in one
    query, takes the best one and removes its contigs from the others.
    """
    chosen: list[tuple[str, float]] = []
    left = members.select("bin", "contig")
    for _ in range(most):
        counts = left.join(markers, "contig").groupBy("bin", "marker").agg(F.count("*").alias("n"))
        scores = counts.groupBy("bin").agg(F.count("*").alias("u"), F.count(F.when(F.col("n") > 1, 1)).alias("d"), F.sum(F.col("n") - 1).alias("x"))
        best = scores.select("bin", (F.col("u") / set_size - 0.6 * F.col("d") / F.col("u") - 0.5 * F.col("x") / set_size).alias("score")).orderBy(F.desc("score"), "bin").first()
        if best is None or best.score <= min(0.0, threshold) or best.score < threshold:
            break
        chosen.append((best.bin, best.score))
        taken = members.filter(F.col("bin") == best.bin).select("contig")
        left = left.filter(F.col("bin") != best.bin).join(taken, "contig", "left_anti")
    return chosen

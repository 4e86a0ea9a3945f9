"""Variation: synonymous and other changes in genes, identity of repeated markers, genes whose pairs of letters stand out."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxalith.functions import sequence as S

#: The standard genetic code: amino acids of the codons in the order TTT, TTC, TTA, TTG, TCT, ... Fixed values.
LETTERS = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODE = dict(zip(map("".join, product(LETTERS, repeat=3)), AMINO_ACIDS))
PAIRS = list(map("".join, product("ACGT", repeat=2)))


def _changes(codon: str, place: int) -> dict[str, bool]:
    """Letters that a codon's place may change to without a stop, and whether the amino acid stays."""
    changed = {x: codon[:place] + x + codon[place + 1 :] for x in LETTERS if x != codon[place]}
    return {x: CODE[c] == CODE[codon] for x, c in changed.items() if CODE[c] != "*"}


def _by_codon(value) -> Column:
    """A map from codons that aren't stops to a value."""
    known = [c for c in CODE if CODE[c] != "*"]
    return F.create_map(*(F.lit(x) for c in known for x in (c, value(c))))


def _sites(codon: Column, same: bool) -> Column:
    """How many single changes of a codon keep its amino acid, or change it; stops and codons of other letters have none."""
    many = _by_codon(lambda c: sum(kept is same for j in range(3) for kept in _changes(c, j).values()))
    return F.coalesce(F.try_element_at(many, codon), F.lit(0))


def _put(codon: Column, place: Column, letter: Column) -> Column:
    return F.concat(F.substring(codon, F.lit(1), place), letter, F.substring(codon, place + 2, F.lit(3)))


def pn_ps(genes: DataFrame, alleles: DataFrame) -> DataFrame:
    """sample, gene, pn, ps (changes seen that alter the amino acid, or don't), tn, ts (possible ones), ratio (pn/tn)/(ps/ts).

    genes (gene, contig, start, strand, seq: from its first place on the contig's forward strand, 1 the contig's first);
    alleles (sample, contig, pos, allele of one letter, n). Codons follow the sample's most frequent letters: the gene's own
    on ties, else the first by name. The start codon, stops, changes to stops, codons of other letters and a last part of
    a codon don't count. A row for each gene and sample with alleles within the gene's codons; the ratio is null where ps, ts
    or tn is 0.
    """
    plus = F.col("strand") == "+"
    sense = F.when(plus, F.upper("seq")).otherwise(S.reverse_complement(F.upper("seq")))
    many = F.expr("length(seq) div 3")
    codons = genes.withColumn("sense", sense).withColumn("size", F.length("seq")).filter("size >= 6")
    codons = codons.select("gene", "contig", "start", "size", "strand", "sense", F.explode(F.sequence(F.lit(1), many - 1)).alias("i"))
    codons = codons.withColumn("codon", F.substring("sense", F.col("i") * 3 + 1, F.lit(3))).drop("sense")
    whole = codons.groupBy("gene").agg(F.sum(_sites(F.col("codon"), False)).alias("tn"), F.sum(_sites(F.col("codon"), True)).alias("ts"))

    step = F.col("i") * 3 + F.col("j")
    places = codons.withColumn("j", F.explode(F.array(*map(F.lit, range(3)))))
    places = places.withColumn("pos", F.col("start") + F.when(plus, step).otherwise(F.col("size") - 1 - step))
    seen = alleles.filter("n > 0").groupBy("sample", "contig", "pos", "allele").agg(F.sum("n").alias("n"))
    met = places.select("contig", "pos", "gene", "i", "j", "codon", "strand").join(seen, ["contig", "pos"])
    met = met.withColumn("letter", F.when(plus, F.upper("allele")).otherwise(S.reverse_complement(F.upper("allele"))))
    own = F.substring("codon", F.col("j") + 1, F.lit(1))
    # Of the most frequent letters the gene's own comes first.
    order = F.struct((-F.col("n")).alias("n"), (F.col("letter") != own).alias("other"), F.col("allele"), F.col("letter"))
    site = met.groupBy("sample", "gene", "i", "codon", "j").agg(F.min(order).alias("most"), F.collect_set("letter").alias("letters"))
    found = F.map_from_entries(F.collect_list(F.struct("j", F.struct(F.col("most.letter").alias("letter"), "letters"))))
    touched = site.groupBy("sample", "gene", "i", "codon").agg(found.alias("sites"))
    now = F.col("codon")
    for j in range(3):
        letter = F.coalesce(F.try_element_at("sites", F.lit(j))["letter"], F.substring(F.col("codon"), j + 1, 1))
        now = _put(now, F.lit(j), letter)
    touched = touched.withColumn("now", now)

    def changed(same: bool) -> Column:
        total = F.lit(0)
        for j in range(3):
            options = _by_codon(lambda c, j=j: "".join(x for x, kept in _changes(c, j).items() if kept is same))
            letters = F.coalesce(F.try_element_at("sites", F.lit(j))["letters"], F.array().cast("array<string>"))
            known = F.coalesce(F.try_element_at(options, F.col("now")), F.lit(""))
            total += F.size(F.filter(letters, lambda x: F.contains(known, x)))
        return total

    sums = {"pn": changed(False), "ps": changed(True)}
    for name, same in (("tn", False), ("ts", True)):
        sums[f"d{name}"] = _sites(F.col("now"), same) - _sites(F.col("codon"), same)
    out = touched.groupBy("sample", "gene").agg(*(F.sum(v).alias(k) for k, v in sums.items())).join(whole, "gene")
    tn, ts = F.col("tn") + F.col("dtn"), F.col("ts") + F.col("dts")
    ratio = F.try_divide(F.try_divide(F.col("pn"), tn), F.try_divide(F.col("ps"), ts))
    return out.select("sample", "gene", "pn", "ps", tn.alias("tn"), ts.alias("ts"), ratio.alias("ratio"))


def aligned_identity(left: Column, right: Column) -> Column:
    """Share of equal letters of two aligned sequences of one length, without places that either lacks at the ends.

    A gap on both sides counts as no place; 0 where nothing is left, null if lengths differ.
    """
    a, b = (F.filter(F.split(c, ""), lambda x: x != "") for c in (left, right))
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    held = F.transform(pairs, lambda p: (p["x"] != "-") & (p["y"] != "-"))
    first, last = F.array_position(held, True), F.size(held) + 1 - F.array_position(F.reverse(held), True)
    inner = F.slice(pairs, F.greatest(first, F.lit(1)).cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int"))
    counted = F.filter(inner, lambda p: ~((p["x"] == "-") & (p["y"] == "-")))
    equal = F.size(F.filter(counted, lambda p: p["x"] == p["y"]))
    share = F.when(F.array_contains(held, True), F.coalesce(F.try_divide(equal, F.size(counted)), F.lit(0.0))).otherwise(F.lit(0.0))
    return F.when(F.length(left) == F.length(right), share)


def strain_heterogeneity(copies: DataFrame, identity: float = 0.9) -> DataFrame:
    """bin, pairs, close, heterogeneity: per cent of pairs of a marker's copies (bin, marker, id, seq) above an identity."""
    left = copies.select("bin", "marker", F.col("id").alias("a"), F.col("seq").alias("x"))
    right = copies.select("bin", "marker", F.col("id").alias("b"), F.col("seq").alias("y"))
    pairs = left.join(right, ["bin", "marker"]).filter("a < b").select("bin", aligned_identity(F.col("x"), F.col("y")).alias("identity"))
    out = pairs.groupBy("bin").agg(F.count("*").alias("pairs"), F.count_if(F.col("identity") > identity).alias("close"))
    return out.withColumn("heterogeneity", F.col("close") * 100 / F.col("pairs"))


def bridging_pairs(genes: DataFrame) -> DataFrame:
    """genome, gene and how often each of 16 pairs stands at a codon's third place and the next one's first.

    genes (genome, gene, seq); a gene without such a pair has no row.
    """
    found = F.regexp_extract_all("seq", F.lit("(?s)..(?=(..).)."), F.lit(1))
    each = genes.select("genome", "gene", F.explode(found).alias("pair")).withColumn("pair", F.upper("pair"))
    return each.groupBy("genome", "gene").pivot("pair", PAIRS).count().na.fill(0).filter(" + ".join(f"`{p}`" for p in PAIRS) + " > 0")


def _bias(counts: pd.Series) -> np.ndarray:
    """How many deviations each pair's count is from what its letters' counts let expect, but for the last pair.

    0 without deviation.
    """
    c = np.stack(counts.to_numpy()).astype(float).reshape(-1, 4, 4)
    total, first, second = c.sum((1, 2))[:, None, None], c.sum(2)[:, :, None], c.sum(1)[:, None, :]
    mean = first * second / total
    spread = np.sqrt(mean * (1 - np.minimum(first, second) / total) * (total - np.maximum(first, second)) / np.maximum(total - 1, 1))
    return np.divide(c - mean, spread, out=np.zeros_like(c), where=spread > 0).reshape(len(c), -1)[:, :-1]


def hotelling(pairs: DataFrame) -> DataFrame:
    """genome, gene, t2: how far a gene's bias of bridging pairs is from its genome's, by the genes' own covariance.

    pairs as bridging_pairs gives them. The covariance is of all pairs but the last and is summed on the cluster, one row a
    genome; where it can't be inverted its pseudo-inverse stands in. Genomes of one gene have a t2 of null.
    """
    m = len(PAIRS) - 1

    @F.pandas_udf("array<double>")
    def away(gene: pd.Series, genome: pd.Series) -> pd.Series:
        return pd.Series(list(_bias(gene) - _bias(genome)))

    @F.pandas_udf("array<double>")
    def inverse(n: pd.Series, s: pd.Series) -> pd.Series:
        def one(many, upper):
            if many < 2:
                return None
            full = np.zeros((m, m))
            full[np.triu_indices(m)] = np.asarray(upper, float) / (many - 1)
            return np.linalg.pinv(full + np.triu(full, 1).T, hermitian=True).ravel()

        return pd.Series([one(*x) for x in zip(n, s)])

    @F.pandas_udf("double")
    def form(x: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else float(a @ np.reshape(b, (m, m)) @ a) for a, b in zip(x, v)], dtype=object)

    genes = pairs.select("genome", "gene", F.array(*(F.col(p).cast("double") for p in PAIRS)).alias("c"))
    whole = pairs.groupBy("genome").agg(F.array(*(F.sum(p).cast("double") for p in PAIRS)).alias("w"))
    each = genes.join(whole, "genome").select("genome", "gene", away("c", "w").alias("x"))
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(m) for j in range(i, m)]
    sums = each.groupBy("genome").agg(F.count("*").alias("n"), F.array(*products).alias("s"))
    met = each.join(sums.select("genome", inverse("n", "s").alias("v")), "genome")
    return met.select("genome", "gene", form("x", "v").alias("t2"))

"""Secondary analytics: markers, k-mers, diversity, scaffolds, sequencing depth, taxonomy checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxalith.operators.abundance import with_totals

from taxalith.functions import sequence as S


def completeness(counts: DataFrame, sets: DataFrame) -> DataFrame:
    """grp, completeness, contamination from marker counts (grp, marker, n) and marker sets (set_id, marker)."""
    sizes = sets.withColumn("size", F.count("*").over(Window.partitionBy("set_id")))
    many = sets.agg(F.count_distinct("set_id")).first()[0]
    met = counts.filter("n > 0").join(sizes, "marker")
    extra = F.sum((F.col("n") - 1) / F.col("size")) * 100 / many
    return met.groupBy("grp").agg((F.sum(1 / F.col("size")) * 100 / many).alias("completeness"), extra.alias("contamination"))


def approved(counts: DataFrame, markers: int, missing: int, multiple: int) -> DataFrame:
    """Groups with at most so many markers missing and so many present more than once."""
    agg = counts.filter("n > 0").groupBy("grp").agg(F.count("*").alias("present"), F.count(F.when(F.col("n") > 1, 1)).alias("multicopy"))
    return agg.filter((F.lit(markers) - F.col("present") <= missing) & (F.col("multicopy") <= multiple)).select("grp", "present", "multicopy")


def kmer_profile(seqs: DataFrame, k: int) -> DataFrame:
    """id, kmer (the smaller of it and its reverse complement), n and share, of sequences of ACGT."""
    runs = seqs.select("id", F.explode(F.regexp_extract_all(F.upper("seq"), F.lit(f"[ACGT]{{{k},}}"), F.lit(0))).alias("run"))
    each = runs.select("id", F.explode(F.regexp_extract_all("run", F.lit(f"(?=(.{{{k}}}))"), 1)).alias("w"))
    return word_profile(each.select("id", S.canonical(F.col("w")).alias("kmer")))


def word_profile(words: DataFrame) -> DataFrame:
    counts = words.groupBy("id", "kmer").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("id")))


def profile_distance(profile: DataFrame, pairs: DataFrame) -> DataFrame:
    """Manhattan distance of two ids' profiles for each (a, b) of pairs."""
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1.0).alias("sign")), F.struct(F.col("b").alias("id"), F.lit(-1.0).alias("sign")))).alias("s"), "a", "b").select("a", "b", "s.id", "s.sign")
    each = sides.join(profile, "id").groupBy("a", "b", "kmer").agg(F.abs(F.sum(F.col("sign") * F.col("share"))).alias("d"))
    return each.groupBy("a", "b").agg(F.sum("d").alias("distance"))


def jaccard_pairs(words: DataFrame, least: float = 0.0) -> DataFrame:
    """a < b and the Jaccard similarity of the word sets of (id, word), for ids that share a word."""
    own = words.select("id", "word").distinct()
    sizes = own.groupBy("id").agg(F.count("*").alias("n"))
    both = own.alias("x").join(own.alias("y"), "word").filter("x.id < y.id").groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("shared"))
    out = both.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
    return out.select("a", "b", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard")).filter(F.col("jaccard") >= least)


def community_profile(mapped: DataFrame) -> DataFrame:
    """sample, bin, reads, size -> % mapped of the sample, and % of the community by reads over size among bins."""
    binned = F.when(F.col("bin") != "unbinned", F.col("reads"))
    rate = F.try_divide(binned, F.col("size"))
    out = with_totals(mapped, _reads="reads", _binned=binned, _rates=rate)
    community = F.try_divide(rate * 100.0, F.col("_rates")) * F.try_divide(F.col("_binned") * 1.0, F.col("_reads"))
    return out.select("sample", "bin", F.try_divide(F.col("reads") * 100.0, F.col("_reads")).alias("percent_mapped"), community.alias("percent_community"))


def nucleotide_diversity(alleles: DataFrame) -> DataFrame:
    """sample, locus, allele, n -> sum over loci of n/(n-1) (1 - sum p^2), and the number of loci with two reads or more."""
    site = alleles.groupBy("sample", "locus").agg(F.sum("n").alias("depth"), F.sum(F.col("n") * F.col("n")).alias("squares")).filter("depth > 1")
    pi = (1 - F.col("squares") / (F.col("depth") * F.col("depth"))) * F.col("depth") / (F.col("depth") - 1)
    return site.groupBy("sample").agg(F.sum(pi).alias("pi"), F.count("*").alias("loci"))


def fst(alleles: DataFrame) -> DataFrame:
    """a < b, fst = 1 - mean within diversity / between diversity over loci that both samples cover."""
    f = alleles.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("sample", "locus")))
    within = f.groupBy("sample", "locus").agg((1 - F.sum(F.col("p") * F.col("p"))).alias("h"))
    same = f.alias("x").join(f.alias("y"), ["locus", "allele"]).filter("x.sample < y.sample").groupBy(F.col("x.sample").alias("a"), F.col("y.sample").alias("b"), "locus").agg(F.sum(F.col("x.p") * F.col("y.p")).alias("same"))
    covered = within.alias("x").join(within.alias("y"), "locus").filter("x.sample < y.sample").select(F.col("x.sample").alias("a"), F.col("y.sample").alias("b"), "locus", ((F.col("x.h") + F.col("y.h")) / 2).alias("inside"))
    both = covered.join(same, ["a", "b", "locus"], "left").groupBy("a", "b").agg(F.sum("inside").alias("inside"), F.sum(1 - F.coalesce("same", F.lit(0.0))).alias("between"))
    return both.select("a", "b", (1 - F.try_divide("inside", "between")).alias("fst"))


def scaffold_edges(links: DataFrame, least: int) -> DataFrame:
    """Contig pairs (either order) by how many read pairs support them."""
    return links.filter("a <> b").groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.count("*").alias("support")).filter(F.col("support") >= least)


def orientation_counts(links: DataFrame) -> DataFrame:
    """Read pairs between contigs by orientation: inward, outward or in line."""
    kind = F.when(F.col("a_strand") == F.col("b_strand"), "inline").when(F.col("a_strand") == "+", "inward").otherwise("outward")
    return links.groupBy("a", "b", kind.alias("orientation")).agg(F.count("*").alias("n"))


def sequencing_depth(otus: DataFrame, coverage: float, rank: int, reads_each: float = 1.0) -> DataFrame:
    """Bases to sequence so that the rank-th most abundant OTU (otu, abundance, size) reaches a coverage, and the share seen.

    share = 100 (1 - exp(-coverage)); unobserved = singletons / sequences.
    """
    w = Window.orderBy(F.desc("abundance"), F.desc("size"), "otu")
    total = otus.agg(F.sum("abundance").alias("total"), F.sum(F.col("abundance") * F.col("size")).alias("bases"), F.count(F.when(F.col("abundance") == 1, 1)).alias("singles"))
    nth = otus.orderBy(F.desc("abundance"), F.desc("size"), "otu").limit(rank).withColumn("place", F.row_number().over(w)).filter(F.col("place") == rank)
    return nth.crossJoin(total).select("otu", "place", (F.lit(coverage) * F.col("bases") / F.col("abundance")).alias("depth"), (F.lit(100.0) * (1 - F.exp(F.lit(-coverage)))).alias("percent_seen"), (F.col("singles") / F.col("total")).alias("unobserved"))


def inconsistent_taxa(lineages: DataFrame, ranks: list[str]) -> DataFrame:
    """Taxa that have more than one parent."""
    steps = F.array(*[F.struct(F.lit(c).alias("rank"), F.col(p).alias("parent"), F.col(c).alias("taxon")) for p, c in zip(ranks, ranks[1:])])
    each = lineages.select(F.inline(steps)).filter("taxon is not null and parent is not null").distinct()
    return each.groupBy("rank", "taxon").agg(F.count("*").alias("parents")).filter("parents > 1")


def duplicate_sequences(seqs: DataFrame) -> DataFrame:
    """Sequences that stand under several ids: digest, how many, the first id."""
    return seqs.groupBy(F.md5("seq").alias("digest")).agg(F.count("*").alias("n"), F.min("id").alias("first_id")).filter("n > 1")


def majority_cluster(parts: DataFrame) -> DataFrame:
    """Each contig's cluster by majority of its parts (contig, cluster); ties to the smaller cluster."""
    counts = parts.groupBy("contig", "cluster").agg(F.count("*").alias("n"))
    return counts.groupBy("contig").agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("cluster"))).alias("w")).select("contig", F.col("w.cluster").alias("cluster"), (-F.col("w.k")).alias("votes"))


def bin_comparison(left: DataFrame, right: DataFrame) -> DataFrame:
    """Shared bases of each pair of bins of two binnings (bin, contig, length), with percentages of either."""
    size = lambda df, n: df.groupBy("bin").agg(F.sum("length").alias(n)).withColumnRenamed("bin", n[:1])
    both = left.select(F.col("bin").alias("a"), "contig", "length").join(right.select(F.col("bin").alias("b"), "contig"), "contig").groupBy("a", "b").agg(F.sum("length").alias("shared"))
    return both.join(size(left, "a_size"), "a").join(size(right, "b_size"), "b").select("a", "b", "shared", (F.col("shared") * 100 / F.col("a_size")).alias("percent_a"), (F.col("shared") * 100 / F.col("b_size")).alias("percent_b"))


def windowed_coverage(reads: DataFrame, width: int) -> DataFrame:
    """Bases of reads (grp, start, end) by window of width places."""
    first, last = F.expr(f"`start` div {width}"), F.expr(f"`end` div {width}")
    each = reads.withColumn("w", F.explode(F.sequence(first, last)))
    inside = F.least(F.col("end"), (F.col("w") + 1) * width - 1) - F.greatest(F.col("start"), F.col("w") * width) + 1
    return each.groupBy("grp", "w").agg(F.sum(inside).alias("bases"))


def best_domains(hits: DataFrame) -> DataFrame:
    """Domain hits (orf, clan, hit, start, end, evalue) without those that overlap a better one of the same clan."""
    a, b = hits.alias("a"), hits.alias("b")
    worse = a.join(b, (F.col("a.orf") == F.col("b.orf")) & (F.col("a.clan") == F.col("b.clan")) & (F.col("a.start") <= F.col("b.end")) & (F.col("b.start") <= F.col("a.end")) & ((F.col("b.evalue") < F.col("a.evalue")) | ((F.col("b.evalue") == F.col("a.evalue")) & (F.col("b.hit") < F.col("a.hit")))))
    return hits.join(worse.select("a.orf", "a.hit").distinct(), ["orf", "hit"], "left_anti")


def usage(parts: DataFrame) -> DataFrame:
    """id, part, n and its share of the id's parts, from (id, parts array): codons, amino acids or k-mers."""
    counts = parts.select("id", F.explode("parts").alias("part")).groupBy("id", "part").agg(F.count("*").alias("n"))
    return with_totals(counts, "id", _total="n").select("id", "part", "n", (F.col("n") / F.col("_total")).alias("share"))


def dissimilarity(profiles: DataFrame, pairs: DataFrame, metric: str = "manhattan") -> DataFrame:
    """a, b and the distance of their profiles (id, part, share); parts that one of them lacks count as 0 there."""
    norms = profiles.groupBy("id").agg(F.sum("share").alias("s"), F.sum(F.col("share") * F.col("share")).alias("q"))
    left = profiles.select(F.col("id").alias("a"), "part", F.col("share").alias("x"))
    right = profiles.select(F.col("id").alias("b"), "part", F.col("share").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, ["b", "part"])
    both = both.groupBy("a", "b").agg(F.sum(F.least("x", "y")).alias("least"), F.sum(F.col("x") * F.col("y")).alias("dot"))
    named = [norms.select(F.col("id").alias(k), F.col("s").alias(f"{k}_s"), F.col("q").alias(f"{k}_q")) for k in ("a", "b")]
    met = pairs.select("a", "b").join(both, ["a", "b"], "left").na.fill(0.0).join(named[0], "a").join(named[1], "b")
    total = F.col("a_s") + F.col("b_s")
    metrics = {
        "manhattan": total - 2 * F.col("least"),
        "braycurtis": F.try_divide(total - 2 * F.col("least"), total),
        "euclidean": F.sqrt(F.greatest(F.lit(0.0), F.col("a_q") + F.col("b_q") - 2 * F.col("dot"))),
        "cosine": 1 - F.try_divide(F.col("dot"), F.sqrt(F.col("a_q") * F.col("b_q"))),
    }
    return met.select("a", "b", metrics[metric].alias("distance"))


def usage_outliers(genes: DataFrame, deviations: float = 2.0) -> DataFrame:
    """Genes (genome, gene, part, n) whose usage is far from their genome's: Manhattan distance over mean plus deviations."""
    whole = genes.groupBy("genome", "part").agg(F.sum("n").alias("n"))
    whole = with_totals(whole, "genome", _total="n").select("genome", "part", (F.col("n") / F.col("_total")).alias("p"))
    sizes = genes.groupBy("genome", "gene").agg(F.sum("n").alias("size"))
    met = genes.join(sizes, ["genome", "gene"]).join(whole, ["genome", "part"])
    # Shares sum to 1 on both sides, so the distance is 2 less twice what they have in common.
    near = met.groupBy("genome", "gene").agg((2 - 2 * F.sum(F.least(F.col("n") / F.col("size"), "p"))).alias("distance"))
    spread = near.groupBy("genome").agg(F.avg("distance").alias("mean"), F.stddev_pop("distance").alias("sd"))
    far = near.join(spread, "genome").filter(F.col("distance") > F.col("mean") + deviations * F.col("sd"))
    return far.select("genome", "gene", "distance")


def dinucleotide_odds(sequences: DataFrame) -> DataFrame:
    """pair and its odds over (id, seq): the pair's share over the product of its letters' shares."""
    letters = sequences.select(F.explode(F.filter(F.split("seq", ""), lambda x: x != "")).alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    pairs = sequences.filter("length(seq) > 1").select(F.explode(F.transform(F.sequence(F.lit(1), F.length("seq") - 1), lambda i: F.substring("seq", i, F.lit(2)))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    all_letters, all_pairs = (df.agg(F.sum("n")).first()[0] or 0 for df in (letters, pairs))
    one, two = (letters.select(F.col("x").alias(k), (F.col("n") / F.lit(all_letters)).alias(f"{k}_share")) for k in ("first", "second"))
    met = pairs.withColumns({"first": F.substring("pair", 1, 1), "second": F.substring("pair", 2, 1)}).join(one, "first").join(two, "second")
    return met.select("pair", "n", (F.col("n") / F.lit(all_pairs) / (F.col("first_share") * F.col("second_share"))).alias("odds"))


def insert_size(pairs: DataFrame, percent: float = 0.95) -> DataFrame:
    """sample and the percentile of the insert sizes of read pairs (sample, insert), which bounds the scaffold's edges."""
    return pairs.filter("insert > 0").groupBy("sample").agg(F.percentile("insert", F.lit(percent)).alias("insert_size"))

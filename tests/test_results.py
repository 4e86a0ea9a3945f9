import random
import sqlite3
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from taxalith.operators import bins, trees, variation
from taxalith.sources import results


def write(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join("\t".join(map(str, r)) for r in rows) + "\n")


def test_project_of_result_tables(spark, tmp_path):
    head = ["ORF ID", "Contig ID", "Length NT", "KEGG ID", "TPM s1", "Coverage s1", "Raw read count s1", "Raw base count s1", "Raw read count s2"]
    write(tmp_path / "results/13.p.orftable", ["# made by x"], head, ["c1_1-9", "c1", 9, "K1*;K2", 1.5, 0.5, 4, 40, 2], ["c2_1-6", "c2", 6, "", 0, 0, 0, 0, ""])
    bare = results.load_project(spark, str(tmp_path), "p")
    assert sorted(r.contig for r in bare.contigs.collect()) == ["c1", "c2"] and bare.ranks == []
    write(tmp_path / "results/19.p.contigtable", ["# x"], ["Contig ID", "Tax"], ["c1", "x"], ["c2", "y"])
    write(tmp_path / "results/18.p.bintable", ["# x"], ["Bin ID"], ["b"])
    write(tmp_path / "intermediate/18.p.contigsinbins", ["# x"], ["# Contig", "Method", "Bin ID"], ["c1", "m", "b"])
    write(tmp_path / "results/tables/p.orf.tax.allfilter.tsv", ["superkingdom", "phylum"], ["c1_1-9", "B", ""])
    p = results.load_project(spark, str(tmp_path), "p")
    assert p.ranks == ["superkingdom", "phylum"]
    got = {r.orf: (r.contig, r.length, r.fun, r.superkingdom, r.phylum) for r in p.orfs.collect()}
    assert got == {"c1_1-9": ("c1", 9, ["K1", "K2"], "B", None), "c2_1-6": ("c2", 6, [], None, None)}
    assert {(r.orf, r.sample, r.reads, r.bases, r.tpm) for r in p.counts.collect()} == {("c1_1-9", "s1", 4, 40, 1.5), ("c1_1-9", "s2", 2, None, None), ("c2_1-6", "s1", 0, 0, 0.0), ("c2_1-6", "s2", None, None, None)}
    assert {(r.contig, r.bin) for r in p.contigs.collect()} == {("c1", "b"), ("c2", None)}
    assert [r.orf for r in p.subset_bins(["b"]).orfs.collect()] == ["c1_1-9"]
    for bad in ({"tax_mode": "x"}, {"name": "q"}):
        with pytest.raises(ValueError):
            results.load_project(spark, str(tmp_path), **({"name": "p"} | bad))


def test_lite_of_feature_tables(spark, tmp_path):
    for i, rank in enumerate(results.RANKS):
        lineages = [";".join(f"{results.RANK_LETTERS[r]}_{x}" for r in results.RANKS[:i] if True) + (";" if i else "") + f"{results.RANK_LETTERS[rank]}_S" for x in "AB"]
        write(tmp_path / f"p.{rank}.allfilter.abund.tsv", ["", "s1", "s2"], *([x, 1 + k, 0] for k, x in enumerate(dict.fromkeys(lineages))))
    write(tmp_path / "p.KO.abund.tsv", ["s1", "s2"], ["K1", 5, 6])
    write(tmp_path / "p.KO.copyNumber.tsv", ["s1", "s2"], ["K1", 0.5, "NA"])
    write(tmp_path / "p.KO.names.tsv", ["Name", "Path"], ["K1", "one 'x'", "A; B"])
    lite = results.load_lite(spark, str(tmp_path))
    assert lite.name == "p"
    taxa = {(r.rank, r.taxon, r.sample): (r.reads, r.percent) for r in lite.taxa.collect()}
    assert taxa["species", "S", "s1"] == (1.0, pytest.approx(100 / 3)) and taxa["species", "S.1", "s1"] == (2.0, pytest.approx(200 / 3))
    assert taxa["species", "S", "s2"] == (0.0, None) and taxa["superkingdom", "S", "s1"] == (1.0, 100.0)
    assert {tuple(r) for r in lite.functions.collect()} == {("KEGG", "abund", "K1", "s1", 5.0), ("KEGG", "abund", "K1", "s2", 6.0), ("KEGG", "copy_number", "K1", "s1", 0.5), ("KEGG", "copy_number", "K1", "s2", None)}
    assert [tuple(r) for r in lite.names.collect()] == [("KEGG", "K1", "one 'x'", "A; B")]
    assert {tuple(r) for r in lite.totals.collect()} == {("s1", 1.0), ("s2", 0.0)}
    with pytest.raises(ValueError):
        results.load_lite(spark, str(tmp_path), "other")


def test_sqlite_rows(spark, tmp_path):
    base = sqlite3.connect(tmp_path / "x.db")
    base.execute("create table t (a text, b integer)")
    base.executemany("insert into t values (?, ?)", [(str(i), i if i % 3 else None) for i in range(25_000)])
    base.commit()
    base.close()
    df = results.sqlite(spark, str(tmp_path / "x.db"), "select a, b from t", "a string, b long")
    assert df.agg(F.count("*"), F.count("b"), F.max("b")).first()[:] == (25_000, 16_666, 24_998)
    assert results.sqlite(spark, str(tmp_path / "x.db"), "select a, b from t where b < 0", "a string, b long").count() == 0


def plain_pn_ps(genes, alleles):
    flip = str.maketrans("ACGT", "TGCA")
    at = defaultdict(lambda: defaultdict(dict))
    for s, c, p, x, n in alleles:
        at[s][c, p][x] = n
    out = {}
    for sample, sites in at.items():
        for gene, contig, start, strand, seq in genes:
            sense = seq if strand == "+" else seq.translate(flip)[::-1]
            total, any_here = dict(pn=0, ps=0, tn=0, ts=0), False
            for i in range(3, len(seq) // 3 * 3, 3):
                places = [start + (i + j if strand == "+" else len(seq) - 1 - i - j) for j in range(3)]
                seen = [{(x if strand == "+" else x.translate(flip)): (n, x) for x, n in sites.get((contig, p), {}).items()} for p in places]
                any_here |= any(seen)
                codon = "".join(min(found, key=lambda x: (-found[x][0], x != own, found[x][1])) if found else own for own, found in zip(sense[i : i + 3], seen))
                if variation.CODE[codon] == "*":
                    continue
                for j in range(3):
                    for x in "ACGT":
                        changed = variation.CODE[codon[:j] + x + codon[j + 1 :]]
                        if x != codon[j] and changed != "*":
                            kind = "s" if changed == variation.CODE[codon] else "n"
                            total["t" + kind] += 1
                            total["p" + kind] += x in seen[j]
            if any_here:
                out[sample, gene] = tuple(total.values())
    return out


def test_pn_ps_against_a_plain_one(spark):
    rng = random.Random(5)
    contigs = {c: "".join(rng.choice("ACGT") for _ in range(120)) for c in "xy"}
    genes = [(f"{c}{k}", c, s, strand, contigs[c][s - 1 : s - 1 + size]) for c in "xy" for k, (s, strand, size) in enumerate([(1, "+", 30), (20, "-", 33), (60, "-", 41), (70, "+", 7)])]
    alleles = [(s, c, p, x, rng.randint(1, 4)) for s in "st" for c in "xy" for p in rng.sample(range(1, 121), 50) for x in rng.sample("ACGT", rng.randint(1, 3))]
    out = variation.pn_ps(spark.createDataFrame(genes, "gene string, contig string, start int, strand string, seq string"), spark.createDataFrame(alleles, "sample string, contig string, pos int, allele string, n int"))
    rows = out.collect()
    assert {(r.sample, r.gene): (r.pn, r.ps, r.tn, r.ts) for r in rows} == plain_pn_ps(genes, alleles)
    for r in rows:
        want = (r.pn / r.tn) / (r.ps / r.ts) if r.tn and r.ts and r.ps else None
        assert r.ratio == (pytest.approx(want) if want is not None else None)


def test_identity_of_aligned_copies(spark):
    pairs = [("--abcd-", "xaabce-", 0.75), ("ab", "--", 0.0), ("a-c", "a-c", 1.0), ("ab", "a", None), ("", "", 0.0), ("a-cd", "ab-d", 0.5)]
    df = spark.createDataFrame(pairs, "x string, y string, want double").select("want", variation.aligned_identity(F.col("x"), F.col("y")).alias("got"))
    assert all(r.want == r.got for r in df.collect()), df.collect()
    copies = spark.createDataFrame([("b", "m", 1, "aaaa"), ("b", "m", 2, "aaaa"), ("b", "m", 3, "aacc"), ("b", "n", 4, "aaaa"), ("c", "m", 5, "aaaa")], "bin string, marker string, id int, seq string")
    assert [tuple(r) for r in variation.strain_heterogeneity(copies).collect()] == [("b", 3, 1, pytest.approx(100 / 3))]


def test_hotelling_against_a_plain_one(spark):
    np = pytest.importorskip("numpy")
    rng = random.Random(2)
    genes = [("g", f"{i:02}", "".join(rng.choice("ACGTacgt") for _ in range(rng.randint(150, 300)))) for i in range(40)] + [("h", "only", "ACGTACGTACGT"), ("h2", "short", "ACG")]
    pairs = variation.bridging_pairs(spark.createDataFrame(genes, "genome string, gene string, seq string"))
    got = {(r.genome, r.gene): r.t2 for r in variation.hotelling(pairs).collect()}
    assert got.pop(("h", "only")) is None and len(got) == 40

    def bias(c):
        total, first, second = c.sum(), c.sum(1), c.sum(0)
        mean = np.outer(first, second) / total
        var = mean * (1 - np.minimum.outer(first, second) / total) * (total - np.maximum.outer(first, second)) / (total - 1)
        return np.divide(c - mean, np.sqrt(var), out=np.zeros((4, 4)), where=var > 0).ravel()[:15]

    counts = np.zeros((40, 4, 4))
    for k, (_, _, seq) in enumerate(genes[:40]):
        for i in range(2, len(seq) - 2, 3):
            a, b = seq[i : i + 2].upper()
            counts[k]["ACGT".index(a), "ACGT".index(b)] += 1
    x = np.array([bias(c) for c in counts]) - bias(counts.sum(0))
    want = np.einsum("ki,ij,kj->k", x, np.linalg.inv(x.T @ x / 39), x)
    assert [got["g", f"{i:02}"] for i in range(40)] == pytest.approx(list(want), rel=1e-6)


def test_trees_of_distances(spark):
    rows = [("a", "b", 2.0), ("a", "c", 6.0), ("b", "c", 8.0), ("a", "d", 9.0), ("b", "d", 10.0), ("c", "d", 4.0)]
    df = spark.createDataFrame(rows, "a string, b string, value double")
    assert trees.clustered(df, "single") == "((a:2.00,b:2.00):4.00,(c:4.00,d:4.00):2.00);"
    assert trees.clustered(df, "complete") == "((a:2.00,b:2.00):8.00,(c:4.00,d:4.00):6.00);"
    assert trees.clustered(df, "average") == "((a:2.00,b:2.00):6.25,(c:4.00,d:4.00):4.25);"
    assert trees.clustered(df.withColumn("value", 100 - F.col("value")), similarity=True) == trees.clustered(df)
    with pytest.raises(ValueError):
        trees.clustered(df, most=3)
    with pytest.raises(ValueError):
        trees.clustered(df.filter("value < 9"))


def test_union_of_binnings(spark):
    members = [("x", "1", "a", 60), ("x", "1", "b", 40), ("x", "2", "c", 50), ("y", "1", "a", 60), ("y", "1", "d", 10), ("y", "2", "c", 50), ("y", "2", "e", 60), ("y", "3", "f", 5), ("z", "1", "a", 60), ("z", "1", "b", 30)]
    quality = [("x", "1", 80.0, 10.0), ("x", "2", 50.0, 0.0), ("y", "1", 90.0, 0.0), ("y", "2", 99.0, 0.0), ("y", "3", 5.0, 0.0), ("z", "1", 70.0, 0.0)]
    m = spark.createDataFrame(members, "binning string, bin string, contig string, length int")
    q = spark.createDataFrame(quality, "binning string, bin string, completeness double, contamination double")
    assert [tuple(r) for r in bins.united(m, q, ["x", "y", "z"]).collect()] == [("y", "1"), ("x", "2"), ("y", "2"), ("y", "3")]
    assert [tuple(r) for r in bins.united(m, q, ["x", "y", "z"], completeness=50).collect()] == [("y", "1"), ("x", "2"), ("y", "2")]

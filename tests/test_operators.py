import pytest
from pyspark.sql import functions as F

from taxalith.functions import lineage as L
from taxalith.functions import sequence as S
from taxalith.operators import abundance, consensus, genomes, grouped, hits, intervals, query, ranking
from taxalith.plans import catalog
from taxalith.sources import readers, writers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lca_stops_at_the_deepest_rank_that_enough_hits_share(spark):
    h = spark.createDataFrame([("q", f"s{i}", 100.0 - i, x, i) for i, x in enumerate((75.2, 71.3, 70.4, 68.0, 60.2))], "query string, subject string, score double, identity double, hit_order int")
    t = spark.createDataFrame([(f"s{i}", g, "F", "B") for i, g in enumerate("abcde")], "subject string, genus string, family string, superkingdom string")
    assert rows(hits.lca_vote(h, t, {"genus": 60, "family": 55, "superkingdom": 40})) == [("q", "family", "F", 4)]


def test_consensus_denominators(spark):
    m = [("c", "Ent", "Esch")] * 3 + [("c", "Ent", None), ("c", None, None), ("c", "Oth", None)]
    df = spark.createDataFrame(m, "group string, family string, genus string")
    assert [r.taxon for r in consensus.consensus(df, ["family", "genus"]).collect()] == ["Esch"]
    assert [r.taxon for r in consensus.consensus(df, ["family", "genus"], denominator="any").collect()] == ["Ent"]
    assert consensus.all_ranks(df, ["family"]).first().disparity == 0.2


def test_missing_ranks(spark):
    df = spark.createDataFrame([(None, None, "Trich", None), ("K", None, None, None), (None,) * 4], "k string, p string, o string, f string")
    got = [tuple(r) for r in df.select(*L.filled([F.col(c) for c in "kpof"], ("kingdom", "phylum", "order", "family"))).collect()]
    assert got == [("Trich (no kingdom in NCBI)", "Trich (no phylum in NCBI)", "Trich", "Unclassified Trich"), ("K",) + ("Unclassified K",) * 3, ("Unclassified",) * 4]


def test_tpm_sums_to_a_million(spark):
    c = spark.createDataFrame([("a", "s", 10, 5.0, 100), ("b", "s", 0, 0.0, 50), ("c", "s", 7, 9.0, 10)], "feature string, sample string, reads long, bases double, length long")
    assert abs(sum(r.tpm for r in abundance.tpm(c).collect()) - 1e6) < 1e-6


@pytest.mark.parametrize("bad", ["A == x AND B == y OR C == z", "(A == x", "A == x)", "A ~ x", "A == x AND", ""])
def test_bad_queries(bad):
    with pytest.raises(query.QueryError):
        query.parse(bad)


def test_query_tree():
    got = query.parse("(PHYLUM IN [a, b] AND CLASS != c) OR CLASS IN [d] OR (S1 > 0.5 AND S2 < 1)")
    assert got.operator == "OR" and [getattr(c, "operator") for c in got.children] == ["AND", "IN", "AND"]
    assert got.children[0].children[0] == query.Leaf("PHYLUM", "IN", ("a", "b"))


def test_intervals_match_brute_force(spark):
    import random

    rng = random.Random(1)
    make = lambda p: [(f"{p}{i}", "g", a := rng.randrange(500), a + rng.randrange(1, 90)) for i in range(60)]
    a, b = make("a"), make("b")
    schema = "id string, grp string, start long, end long"
    got = rows(intervals.overlap_counts(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 37))
    want = []
    for x in a:
        met = [min(x[3], y[3]) - max(x[2], y[2]) for y in b if x[2] <= y[3] and y[2] <= x[3]]
        if met:
            want.append((x[0], len(met), sum(met)))
    assert got == sorted(want)


def test_marker_and_bin_queries_read_every_row(spark, tmp_path):
    d = str(tmp_path)
    orders = [(c, f"{p}-X") for c in (1, 2) for p in range(1, 6)] + [(2, "1-X"), (3, "5-X")]
    spark.createDataFrame(orders, "o_custkey long, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    lines = [(1, 1, "A", "F"), (1, 2, "R", "F"), (1, 2, "R", "O"), (2, 7, "A", "F"), (2, 7, "A", "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    q = catalog.queries()
    got = {r.grp: (round(r.completeness, 2), round(r.contamination, 2)) for r in q["completeness_contamination"](spark, d).collect()}
    assert got == {1: (100.0, 0.0), 2: (100.0, 25.0), 3: (16.67, 0.0)}
    assert {(r.grp, r.present, r.multicopy) for r in q["scg_approval"](spark, d).collect()} == {(1, 5, 0), (2, 5, 1)}
    assert {(r.a, r.b, r.shared, r.percent_a, r.percent_b) for r in q["bin_comparison"](spark, d).collect()} == {("A", "F", 3, 100.0, 75.0), ("R", "F", 1, 50.0, 25.0), ("R", "O", 1, 50.0, 100.0)}


def test_kmer_queries_take_canonical_kmers_and_all_pairs(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, "aaaat"), (2, None), (3, "TTTTNACGT xé"), (4, "acg")], "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, "AAAA"), (3, "TTTT"), (7, "CCCC GGGG"), (9, "none")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    q = catalog.queries()
    assert rows(q["kmer_profile"](spark, d)) == [(1, "AAAA", 1, 0.5), (1, "AAAT", 1, 0.5), (3, "AAAA", 1, 0.5), (3, "ACGT", 1, 0.5)]
    assert rows(q["kmer_distance"](spark, d)) == [(1, 3, 0.0), (1, 7, 2.0), (3, 7, 2.0)]


def test_n50_duplicates_cover_and_kmers(spark):
    df = spark.createDataFrame([("g", n) for n in (1, 1, 2, 2, 2, 2, 10)], "grp string, length long")
    assert ranking.n_percent(df, 50).first().n_length == 10
    s = spark.createDataFrame([("x", "AACC"), ("y", "AAAA"), ("z", "GGGG")], "id string, seq string")
    p = genomes.kmer_profile(s, 2)
    assert {(r.kmer, round(r.share, 4)) for r in p.filter("id = 'x'").collect()} == {("AA", 0.3333), ("AC", 0.3333), ("CC", 0.3333)}
    pair = spark.createDataFrame([("y", "z")], "a string, b string")
    assert genomes.profile_distance(p, pair).first().distance == 2.0
    assert genomes.duplicate_sequences(s.unionByName(s.limit(1))).count() == 1


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ACGTacgtNnUu", 10, "5S10M2I3D4N6M5S")], "seq string, pos int, cigar string")
    got = df.select(S.count_of(F.col("seq"), "GC"), S.reverse_complement(F.lit("AACG")), S.reference_end(F.col("pos"), F.col("cigar")), S.masked(F.lit("ACGTA"), F.lit(2), F.lit(3))).first()
    assert tuple(got) == (4, "CGTT", 10 + 10 + 3 + 4 + 6 - 2, "ANNTA")


def test_grouped_operators(spark):
    assert grouped.smallest_cover({"a": frozenset("xy"), "b": frozenset("yz"), "c": frozenset("xyz"), "d": frozenset("w")}) == {"c", "d"}
    h = spark.createDataFrame([("c", 1, 100, ["a", "b"]), ("c", 90, 200, ["b"]), ("c", 500, 600, ["z"])], "contig string, start long, end long, subjects array<string>")
    assert [(r.start, r.end) for r in grouped.merge_hits(h).orderBy("start").collect()] == [(1, 200), (500, 600)]
    c = spark.createDataFrame([("q", "s1", 1, 100, 1, 50.0, 90.0), ("q", "s2", 5, 100, 1, 60.0, 80.0), ("q", "s3", 300, 400, 1, 10.0, 70.0), ("q", "s4", 300, 400, 1, 10.0, 5.0)], "query string, subject string, start long, end long, frame int, score double, identity double")
    assert [r.hits for r in grouped.collapse_hits(c).orderBy("start").collect()] == ["s2|60|80;s1|50|90", "s3|10|70"]
    members = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), ("y", 3), ("z", 3)], "bin string, contig int")
    markers = spark.createDataFrame([(1, "m1"), (2, "m2"), (3, "m3")], "contig int, marker string")
    assert [b for b, _ in grouped.select_bins(members, markers, 3, 0.3)] == ["x", "y"]


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "s.fa").write_text(">a one\nACG\nT\n>b\nGG\n")
    assert rows(readers.fasta(spark, str(tmp_path / "s.fa")).select("id", "seq")) == [("a", "ACGT"), ("b", "GG")]
    (tmp_path / "g.gff").write_text("#c\nk\tp\tCDS\t9\t2\t.\t+\t0\tID=k_2-9;x\nk\tp\tCDS\t9\t2\t.\t+\t0\tID=k_2-9\n")
    assert rows(readers.gff(spark, str(tmp_path / "g.gff")).select("id", "start", "length")) == [("k_2-9", 2, 8)]
    (tmp_path / "smp").write_text("a\tf1\tpair1\na\tf2\tpair2\n")
    assert readers.samples(spark, str(tmp_path / "smp")).count() == 2
    (tmp_path / "bad").write_text("a\tf1\tpair2\n")
    with pytest.raises(ValueError):
        readers.samples(spark, str(tmp_path / "bad"))
    (tmp_path / "v.vcf").write_text("#h\nc\t5\t.\tA\tG\t.\t.\t.\tGT:AD\t0/1:3,4\n")
    assert rows(readers.vcf_alleles(spark, str(tmp_path / "v.vcf"), ["s"])) == [("s", "c:5", "A", 3), ("s", "c:5", "G", 4)]
    assert writers.newick([("r", "a"), ("r", "b"), ("a", "c")]) == "((c)a,b)r;"
    with pytest.raises(ValueError):
        writers.newick([("r", "a"), ("b", "a")])


def test_project_subsets(spark):
    from taxalith.project import Project, combine_subsets

    orfs = spark.createDataFrame([("o1", "c1", 90, ["K1"], "P"), ("o2", "c1", 60, ["K2"], "P"), ("o3", "c2", 30, ["K1"], "Q")], "orf string, contig string, length long, fun array<string>, phylum string")
    counts = spark.createDataFrame([(o, s, 3, 5.0) for o in ("o1", "o2", "o3") for s in ("x", "y")], "orf string, sample string, reads long, bases double")
    contigs = spark.createDataFrame([("c1", "b1", "P"), ("c2", "b2", "Q")], "contig string, bin string, phylum string")
    p = Project("t", orfs, counts, contigs, ["phylum"])
    a, b = p.subset_query("FUN CONTAINS K2"), p.subset_tax("phylum", ["Q"])
    assert rows(a.orfs.select("orf")) == [("o2",)] and rows(b.contigs.select("contig")) == [("c2",)]
    assert rows(combine_subsets(a, b).orfs.select("orf")) == [("o2",), ("o3",)]
    with pytest.raises(ValueError):
        p.subset_bins(["none"])
    assert p.subset_samples(["x"]).counts.count() == 3

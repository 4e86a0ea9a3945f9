"""Cases that once gave wrong answers, and small cases of operators without a query."""

import pytest
from pyspark.sql import functions as F

from taxalith.functions import names
from taxalith.functions import sequence as S
from taxalith.operators import abundance, annotations, bins, consensus, ranking, statistics
from taxalith.plans import catalog, registry
from taxalith.project import Project
from taxalith.sources import packages, readers, writers


def test_ignored_features_are_not_in_other(spark):
    long = spark.createDataFrame([("Unmapped", "s", 100), ("a", "s", 5), ("b", "s", 3), ("c", "s", 2)], "feature string, sample string, value long")
    got = {r.feature: r.value for r in ranking.most_abundant(long, 1, ignore=("Unmapped",)).collect()}
    assert got == {"a": 5, "Other": 5}
    assert {r.feature for r in ranking.most_abundant(long, items=("b", "x"), extra=("c",), others=False).collect()} == {"b", "c"}


def test_rollup_ends_at_the_first_gap(spark):
    rows = spark.createDataFrame([("B", None, None, 1), ("B", None, "x", 1), (None, "q", "y", 1), ("B", "P", "z", 1)], "k string, p string, c string, n long")
    got = {(r["rank"], r.path): r.n for r in abundance.rollup_paths(rows, ["k", "p", "c"], ["n"]).collect()}
    assert got == {("k", "B"): 3, ("p", "B;P"): 1, ("c", "B;P;z"): 1}


def test_consensus_takes_zero_shares(spark):
    members = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "c"), (1, "d")], "group long, r string")
    assert consensus.consensus(members, ["r"]).count() == 0
    assert consensus.consensus(members, ["r"], of_rank=0.0, of_all=0.0).first().taxon == "a"


def test_readers_keep_quotes_and_empty_first_cells(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('# note\n"a\tb"\tc\n\n5\'\td\te\n')
    assert [tuple(r) for r in readers.tsv(spark, str(path), "x string, y string, z string").collect()] == [('"a', 'b"', "c"), ("5'", "d", "e")]
    path.write_text("# note\n\ts1\ts2\n\t1\t2\nf\t3\t\n")
    rows = readers.with_header(spark, str(path)).collect()
    assert [r.asDict() for r in rows] == [{"feature": "", "s1": "1", "s2": "2"}, {"feature": "f", "s1": "3", "s2": ""}]


def test_hits_are_in_file_order(spark, tmp_path):
    for name, first in (("b.m8", 3), ("a.m8", 0)):
        lines = [f"q{i}\ts\t{i}\t1\t0\t0\t1\t2\t1\t2\t0.1\t9" for i in range(first, first + 3)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = readers.ordered_hits(spark, str(tmp_path)).collect()
    assert sorted((r.hit_order, r.identity) for r in rows) == [(i, float(i)) for i in range(6)]


def test_names(spark):
    row = spark.createDataFrame([(5, "superkingdom:A;subphylum:B;genus:C", "PF1 [a; b];PF2 [c]", "[set(['x', 'y']), set(['z'])]")], "n long, l string, f string, m string")
    got = row.select(names.lettered(F.col("l")).alias("l"), names.families(F.col("f")).alias("f"), names.marker_sets(F.col("m")).alias("m"), names.human(F.col("n") * 1_234_567).alias("h"), names.without_empty(F.lit("k_A;_;p_;g_B")).alias("w")).first()
    assert got.l == "k_A;n_B;g_C" and got.f == ["PF1 [a; b]", "PF2 [c]"] and got.m == [["x", "y"], ["z"]] and got.h == "6.17 Mb" and got.w == "k_A;g_B"
    assert row.select(S.part(F.lit("ACGTAC"), F.lit(2), F.lit(4), F.lit("-")).alias("p"), S.codons(F.lit("AAACCCG")).alias("c")).first() == ("ACG", ["AAA", "CCC"])


def test_sources_models_and_registration(spark):
    hits = spark.createDataFrame([("q", "f", 1.0, 50.0, 1)], "query string, fun string, score double, overlap double, hit_order long")
    annotations.register_annotation_source("own", hits)
    annotations.register_operator("twice", lambda df: df.union(df))
    assert annotations.operator("twice")(annotations.annotation_sources(["own"])).filter("db = 'own'").count() == 2
    models = spark.createDataFrame([("a", "PF1", None)], "name string, accession string, description string")
    assert annotations.models_matching(models, ["^PF"]).count() == 1 and annotations.models_matching(models, ["!^PF"]).count() == 0
    with pytest.raises(ValueError):
        annotations.models_matching(models, ["a", "!b"])
    with pytest.raises(ValueError):
        assert "tpm_by_feature" in catalog.queries()
        registry.register("tpm_by_feature", lambda spark, d: None)


def test_numbered_is_one_order_over_partitions(spark):
    df = spark.range(5000).select(F.concat(F.lit("x"), "id").alias("contig"), (F.col("id") * 7919 % 5003).alias("length")).repartition(7)
    got = {r.old: int(r.new.split("_")[1]) for r in annotations.numbered(df, "c", [F.desc("length"), F.asc("contig")]).collect()}
    want = sorted(((-(i * 7919 % 5003), f"x{i}") for i in range(5000)))
    assert got == {name: i + 1 for i, (_, name) in enumerate(want)}


def test_empty_tables(spark):
    contigs = spark.createDataFrame([], "bin string, contig string, length long, gc double")
    assert bins.bin_statistics(contigs).count() == 0
    genes = spark.createDataFrame([], "fun string, sample string, reads long, bases double, coverage double, tpm double")
    assert statistics.function_table(genes).count() == 0
    assert bins.chosen(spark.createDataFrame([("b", 90.0, 1.0)], "bin string, completeness double, contamination double"), names=[]).count() == 0


def test_conf_and_packages(spark, tmp_path):
    got = packages.conf('# note\n$base = "/x";\n$dir = "$base/y"; # more\n$file="${dir}/z_$other";\n')
    assert got == {"base": "/x", "dir": "/x/y", "file": "/x/y/z_$other"}
    with pytest.raises(ValueError):
        packages.conf("$a = $b;\n$b = $a;")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.tsv").write_text('# note\n\ts1\n"a\t1\nb\t2\n')
    (tmp_path / "in" / "other.txt").write_text("x")
    assert packages.zipped(str(tmp_path / "in"), str(tmp_path / "p.zip"), (".tsv",)) == ["t.tsv"]
    assert [r.asDict() for r in packages.member(spark, str(tmp_path / "p.zip"), "t.tsv").collect()] == [{"feature": '"a', "s1": "1"}, {"feature": "b", "s1": "2"}]


def test_projects_of_several_folders(spark, tmp_path):
    for name in ("one", "two"):
        orfs = spark.createDataFrame([(f"{name}_1-9", "c", 9, ["f"], "g")], "orf string, contig string, length long, fun array<string>, genus string")
        counts = spark.createDataFrame([(f"{name}_1-9", name, 4, 40.0)], "orf string, sample string, reads long, bases double")
        contigs = spark.createDataFrame([("c", "b", "g")], "contig string, bin string, genus string")
        Project(name, orfs, counts, contigs, ["genus"]).save(str(tmp_path / name))
    loaded = packages.load_many(spark, {n: str(tmp_path / n) for n in ("one", "two")}, ["genus"])
    assert sorted((r.fun, r.sample, r.reads) for r in packages.combined_functions(loaded).collect()) == [("f", "one", 4), ("f", "two", 4)]
    with pytest.raises(ValueError):
        packages.combined_functions({"a": loaded["one"], "b": loaded["one"]})


def test_stamp_profile(spark):
    cover = spark.createDataFrame([("f", "a", 5), ("g", "a", 1), ("g", "b", 2)], "fun string, sample string, reads long")
    classes = spark.createDataFrame([("f", "C", "F")], "fun string, class string, name string")
    rows = writers.stamp_profile(cover, classes, ["a", "b"]).collect()
    assert sorted(map(tuple, rows)) == [("C", "F", "f", 5, 0), ("Unclassified", "g", "g", 1, 2)]
    assert [tuple(r) for r in writers.stamp(cover, ["a", "b"], 4).collect()] == [("f", 5, 0)]


def test_shared_markers_of_pieces_without_shuffled_pairs(spark, monkeypatch):
    monkeypatch.setattr(bins, "PIECE", 3, raising=False)
    rows = [(b, c, m) for b in (1, None) for c in range(20) for m in "pqrs" if (c * 7 + ord(m)) % 3 or c > 14] + [(1, 4, "q"), (1, None, "p"), (1, 5, None), (2, 4, "q"), (2, 30, "z")]
    out = bins.shared_markers(spark.createDataFrame(rows, "bin long, contig long, marker string"))
    own = {}
    for b, c, m in rows:
        if None not in (b, c, m):
            own.setdefault((b, c), set()).add(m)
    want = [(b, x, y, len(own[b, x] & own[b, y])) for b, x in own for d, y in own if b == d and x < y and own[b, x] & own[b, y]]
    assert out.columns == ["bin", "a", "b", "shared"] and sorted(map(tuple, out.collect())) == sorted(want)
    plan = out._jdf.queryExecution().sparkPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Join")] and "Exchange" not in plan[plan.index("AdaptiveSparkPlan") :].split("Join")[0]

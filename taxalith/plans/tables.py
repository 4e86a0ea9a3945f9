"""Queries of bins, mapping statistics, function tables and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxalith.operators import abundance, bins, consensus, ranking, statistics
from taxalith.operators.query import select_entities
from taxalith.plans.registry import rounded, sql, table
from taxalith.sources import packages

_GC = "(length(text) - length(translate(text, 'GCgc', ''))) * 100.0 / greatest(length(text), 1)"


def _contigs(spark, d):
    """Documents are contigs, binned by language and source."""
    text = F.coalesce("text", F.lit(""))
    gc = F.expr("(length(text) - length(translate(text, 'GCgc', ''))) * 100D / greatest(length(text), 1)")
    named = table(spark, d, "documents").withColumn("text", text)
    return named.select(F.concat_ws("/", "lang", "source").alias("bin"), F.col("doc_id").alias("contig"), F.length("text").alias("length"), gc.alias("gc"))


_CONTIGS = f"""k as (
  select concat_ws('/', lang, source) bin, doc_id contig, length(text) as length, {_GC} gc from (select doc_id, lang, source, coalesce(text, '') as text from documents)
)"""


@sql(f"""
with {_CONTIGS}, g as (select bin, sum(l_quantity) coding from lineitem join k on l_partkey = contig group by 1),
m as (select bin, string_agg(n_name, '|' order by n_name) markers from nation join k on n_nationkey = contig group by 1)
select k.bin, count(*) contigs, cast(sum(length) as bigint) size, round(sum(gc * length) / sum(length), 4) gc, max(length) longest,
  round(coalesce(any_value(coding), 0) / sum(length), 4) density, coalesce(any_value(markers), '') markers
from k left join g on k.bin = g.bin left join m on k.bin = m.bin group by 1""")
def bin_statistics(spark, d):
    genes = table(spark, d, "lineitem").select(F.col("l_partkey").alias("contig"), F.col("l_quantity").alias("length"))
    markers = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("contig"), F.col("n_name").alias("name"))
    return rounded(bins.bin_statistics(_contigs(spark, d), genes, markers))


@sql("""
with m as (
  select case when l_suppkey % 5 = 0 then null else 'b' || l_suppkey % 5 end bin, l_returnflag sample, count(*) reads, sum(l_quantity) bases, sum(l_linenumber) as length
  from lineitem group by 1, 2
), b as (select *, reads * 1.0 / length rate from m where bin is not null)
select bin, sample, reads, round(bases / length, 4) coverage, round(reads * 1e9 / (length * sum(reads) over (partition by sample)), 4) rpkm,
  round(rate * 1e6 / sum(rate) over (partition by sample), 4) tpm from b""")
def bin_rates(spark, d):
    bin_ = F.expr("if(l_suppkey % 5 = 0, null, concat('b', l_suppkey % 5))")
    rows = table(spark, d, "lineitem").select(bin_.alias("bin"), F.col("l_returnflag").alias("sample"), F.lit(1).alias("reads"), F.col("l_quantity").alias("bases"), F.col("l_linenumber").alias("length"))
    return rounded(bins.bin_rates(rows))


@sql("""
with c as (
  select o_custkey contig, count(*) n, count(distinct o_orderpriority) p, case when max(o_totalprice) > 100000 then max(o_orderpriority) else 'Unknown' end lineage
  from orders group by 1
), e as (select contig, n n_genes, (p - 1) / 40.0 disparity, lineage from c)
select contig, n_genes, round(disparity, 4) disparity, lineage from e
where n_genes >= 1 and disparity <= 0.1 and not (n_genes <= 1 and lineage = 'Unknown') and contig not in (select s_suppkey from supplier)""")
def contigs_to_bin(spark, d):
    lineage = F.when(F.max("o_totalprice") > 100000, F.max("o_orderpriority")).otherwise("Unknown")
    own = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("contig")).agg(F.count("*").alias("n_genes"), ((F.count_distinct("o_orderpriority") - 1) / 40.0).alias("disparity"), lineage.alias("lineage"))
    return rounded(bins.eligible(own, table(spark, d, "supplier").select(F.col("s_suppkey").alias("contig"))))


@sql("""
select c_custkey bin, c_mktsegment genus, round(c_acctbal / 100, 4) completeness, round(abs(c_acctbal) / 1000, 4) contamination from customer
where c_mktsegment in ('BUILDING', 'MACHINERY') and c_acctbal / 100 >= 50 and abs(c_acctbal) / 1000 <= 8""")
def bins_chosen(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("bin"), F.col("c_mktsegment").alias("genus"), (F.col("c_acctbal") / 100).alias("completeness"), (F.abs("c_acctbal") / 1000).alias("contamination"))
    return rounded(bins.chosen(rows, rank="genus", taxa=["BUILDING", "MACHINERY"], completeness=50, contamination=8))


@sql("""
with m as (select distinct c_nationkey bin, o_custkey contig, o_orderpriority marker from orders join customer on o_custkey = c_custkey)
select cast(x.bin as bigint) bin, x.contig a, y.contig b, count(*) shared from m x join m y on x.bin = y.bin and x.marker = y.marker and x.contig < y.contig group by all""")
def contigs_sharing_markers(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rounded(bins.shared_markers(rows.select(F.col("c_nationkey").alias("bin"), F.col("o_custkey").alias("contig"), F.col("o_orderpriority").alias("marker"))))


@sql("select l_partkey contig, count(distinct l_returnflag) n, string_agg(distinct l_returnflag, ';' order by l_returnflag) bins from lineitem group by 1 having count(distinct l_returnflag) > 1")
def contigs_twice_binned(spark, d):
    return rounded(bins.twice_binned(table(spark, d, "lineitem").select(F.col("l_partkey").alias("contig"), F.col("l_returnflag").alias("bin"))))


@sql("select c_custkey contig, round(c_acctbal, 4) length from customer where c_acctbal >= 1000 and c_custkey not in (select o_custkey from orders)")
def contigs_unbinned(spark, d):
    contigs = table(spark, d, "customer").select(F.col("c_custkey").alias("contig"), F.col("c_acctbal").alias("length"))
    return rounded(bins.unbinned(contigs, table(spark, d, "orders").select(F.col("o_custkey").alias("contig")), 1000))


@sql("""
with b as (select c_nationkey bin, quantile_cont(c_acctbal, 0.05) least, quantile_cont(c_acctbal, 0.95) most from customer group by 1)
select cast(bin as bigint) bin, c_custkey contig, round(c_acctbal, 4) gc, round(least, 4) least, round(most, 4) as most
from customer join b on c_nationkey = bin where c_acctbal < least or c_acctbal > most""")
def bin_outliers(spark, d):
    return rounded(bins.outliers(table(spark, d, "customer").select(F.col("c_nationkey").alias("bin"), F.col("c_custkey").alias("contig"), F.col("c_acctbal").alias("gc"))))


def _alignments(spark, d):
    contig = F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("sample"), contig.alias("contig"), F.col("l_quantity").alias("seq_len"))


@sql("""
with a as (select l_partkey contig, l_returnflag sample, count(*) reads, sum(l_quantity) bases from lineitem where l_linestatus = 'F' group by 1, 2),
c as (select a.*, p_size as length, reads * 1.0 / p_size rate from a join part on contig = p_partkey)
select contig, sample, reads, round(bases, 4) bases, cast(length as bigint) length, round(bases / length, 4) coverage,
  round(reads * 1e9 / (length * sum(reads) over (partition by sample)), 4) rpkm, round(rate * 1e6 / sum(rate) over (partition by sample), 4) tpm from c""")
def contig_coverage(spark, d):
    return rounded(statistics.contig_coverage(_alignments(spark, d), table(spark, d, "part").select(F.col("p_partkey").alias("contig"), F.col("p_size").alias("length"))))


@sql("""
select l_returnflag sample, count(*) total_reads, count(*) filter (l_linestatus = 'F') mapped_reads, round(count(*) filter (l_linestatus = 'F') * 100.0 / count(*), 4) "percent",
  round(sum(l_quantity), 4) total_bases, count(*) filter (l_linestatus = 'F') * 100.0 / count(*) < 50 low from lineitem group by 1""")
def mapping_statistics(spark, d):
    return rounded(statistics.mapping_statistics(_alignments(spark, d)))


_GENES = "g as (select l_partkey gene, l_returnflag sample, count(*) reads, sum(l_quantity) bases, any_value(p_name) as name, any_value(p_size) as length, any_value(p_brand) brand from lineitem join part on l_partkey = p_partkey group by 1, 2)"


def _genes(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sums = (F.count("*").alias("reads"), F.sum("l_quantity").alias("bases"), F.first("p_name").alias("name"), F.first("p_size").alias("length"), F.first("p_brand").alias("brand"))
    return rows.groupBy(F.col("l_partkey").alias("gene"), F.col("l_returnflag").alias("sample")).agg(*sums)


@sql(f"""
with {_GENES}, t as (select *, reads * 1e6 / length / sum(reads * 1.0 / length) over (partition by sample) tpm, bases / length cov from g),
e as (select sample, unnest(string_split(name, ' ')) fun, reads / len(string_split(name, ' ')) r, bases / len(string_split(name, ' ')) b, cov / len(string_split(name, ' ')) c, tpm / len(string_split(name, ' ')) t from t),
s as (select fun, sample, sum(r) reads, sum(b) bases, sum(c) coverage, sum(t) tpm, count(*) copies from e group by 1, 2)
select fun, sample, round(reads, 4) reads, round(bases, 4) bases, round(coverage, 4) coverage, round(tpm, 4) tpm, copies, round(tpm * 1e6 / sum(tpm) over (partition by sample), 4) tpm_rescaled from s""")
def function_table(spark, d):
    rates = abundance.tpm(_genes(spark, d).select(F.col("gene").alias("feature"), "sample", "reads", "bases", "length")).select(F.col("feature").alias("gene"), "sample", "coverage", "tpm")
    genes = _genes(spark, d).join(rates, ["gene", "sample"]).select("sample", F.col("name").alias("fun"), "reads", "bases", "coverage", "tpm")
    return rounded(statistics.function_table(genes, " "))


@sql(f"""
with {_GENES}, e as (select sample, unnest(string_split(name, ' ')) fun, len(string_split(name, ' ')) n, reads, bases, length from g),
s as (select fun, sample, sum(reads / n) reads, sum(bases / n) bases, sum(length / n) as length, sum(bases / length / n) coverage, count(*) copies from e group by 1, 2),
r as (select *, reads / (length / copies / 1000) rate from s)
select r.fun, r.sample, round(r.reads) reads, round(r.bases, 4) bases, round(r.length, 4) as length, round(r.coverage, 4) coverage, r.copies,
  round(r.rate * 1e6 / sum(r.rate) over (partition by r.sample), 4) tpm, round(r.coverage / k.coverage, 4) copy_number
from r left join s k on k.sample = r.sample and k.fun = 'ring'""")
def split_function_table(spark, d):
    return rounded(statistics.split_function_table(_genes(spark, d).withColumn("fun", F.split("name", " ")), "ring"))


@sql(f"""
with {_GENES}, t as (select sample, sum(reads) total from g group by 1),
e as (select sample, unnest(string_split(name, ' ')) fun, reads, bases, length from g where brand = 'Brand#2'),
s as (select fun, sample, count(*) copies, sum(length) as length, sum(reads) reads, sum(bases) bases from e group by 1, 2),
r as (select s.*, total, reads / (length / copies) rate from s join t using (sample))
select fun, sample, copies, cast(length as bigint) length, cast(reads as bigint) reads, round(bases, 4) bases, round(reads * 1e9 / (length * total), 4) rpkm,
  round(bases / length, 4) coverage, round(rate * 1e6 / sum(rate) over (partition by sample), 4) tpm from r""")
def funcover_of_taxon(spark, d):
    genes = _genes(spark, d).withColumn("fun", F.split("name", " "))
    return rounded(abundance.funcover(genes, within=F.col("brand") == "Brand#2"))


@sql("""
with c as (
  select 'contigs' section, unnest(['contigs', 'bases', 'longest', 'shortest', 'at r', 'at n', 'congruent', 'disparate', 'disparity >= 0.1', 'disparity >= 0.25']) metric,
    unnest([count(*), sum(o_orderkey), max(o_orderkey), min(o_orderkey), count(r), count(n), count(*) filter (d = 0), count(*) filter (d > 0), count(*) filter (d >= 0.1), count(*) filter (d >= 0.25)]) as value
  from (select o_orderkey, o_orderstatus r, case when o_totalprice > 50000 then o_orderpriority end n, case when o_totalprice < 100000 then 0 else o_totalprice / 1e6 end d from orders)
), o as (
  select 'orfs' section, unnest(['orfs', 'at r', 'at n', 'with f', 'trusted f']) metric, unnest([count(*), count(p_type), count(case when p_size > 10 then p_brand end), count(p_name), count(*) filter (p_size > 20)]) as value from part
), b as (
  select 'bins' section, unnest(['bins', 'complete >= 50', 'complete >= 75', 'complete >= 90', 'contaminated < 10', 'contaminated >= 50', 'high quality', 'good quality']) metric,
    unnest([count(*), count(*) filter (x >= 50), count(*) filter (x >= 75), count(*) filter (x >= 90), count(*) filter (y < 10), count(*) filter (y >= 50), count(*) filter (x >= 90 and y < 10), count(*) filter (x >= 75 and y < 10)]) as value
  from (select c_acctbal / 100 x, abs(c_acctbal) / 150 y from customer)
)
select section, metric, cast(value as double) as value from (select * from c union all select * from o union all select * from b)""")
def run_statistics(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("length"), F.col("o_orderstatus").alias("r"), F.expr("if(o_totalprice > 50000, o_orderpriority, null)").alias("n"), F.expr("if(o_totalprice < 100000, 0, o_totalprice / 1e6)").alias("disparity"))
    orfs = table(spark, d, "part").select(F.col("p_type").alias("r"), F.expr("if(p_size > 10, p_brand, null)").alias("n"), F.expr("if(p_size > 20, concat(p_name, '*'), p_name)").alias("f"))
    quality = table(spark, d, "customer").select((F.col("c_acctbal") / 100).alias("completeness"), (F.abs("c_acctbal") / 150).alias("contamination"))
    return rounded(statistics.run_statistics(orders, orfs, quality, ["r", "n"], ["f"]))


@sql(f"""
with {_GENES}, t as (select l_returnflag sample, count(*) * 2 total from lineitem group by 1), o as (select sample, sum(reads) reads from g group by 1),
x as (select sample, brand, sum(reads) r from g where brand is not null group by 1, 2), w as (select sample, count(*) taxa, first(brand order by r desc, brand) dominant from x group by 1),
l as (select p_size n, sum(p_size) over (order by p_size desc rows unbounded preceding) upto, sum(p_size) over () total from part)
select t.sample, cast(reads as bigint) reads, round(reads * 100.0 / total, 4) "percent", taxa, dominant,
  (select cast(max(n) as bigint) from l where upto >= total * 0.5) n50, (select cast(max(n) as bigint) from l where upto >= total * 0.9) n90
from t join o using (sample) join w using (sample)""")
def project_summary(spark, d):
    totals = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample")).agg((F.count("*") * 2).alias("total"))
    contigs = table(spark, d, "part").select(F.col("p_partkey").alias("contig"), F.col("p_size").alias("length"))
    return rounded(statistics.project_summary(_genes(spark, d), totals, contigs, "brand"))


_LONG = "l as (select p_brand feature, l_returnflag || l_linestatus sample, sum(l_quantity) as value from lineitem join part on l_partkey = p_partkey group by 1, 2)"


def _long(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("p_brand").alias("feature"), F.concat("l_returnflag", "l_linestatus").alias("sample")).agg(F.sum("l_quantity").alias("value"))


@sql(f"""
with {_LONG}, k as (select * from l where feature <> 'Brand#1'), t as (select feature from k group by 1 order by sum(value) desc, feature limit 2),
n as (select case when feature in (select feature from t) or feature = 'Brand#5' then feature else 'Other' end feature, sample, sum(value) as value from k group by 1, 2)
select feature, sample, round(value * 100 / sum(value) over (partition by sample), 4) as value from n""")
def most_abundant_ignoring(spark, d):
    return rounded(ranking.most_abundant(_long(spark, d), 2, ignore=("Brand#1",), extra=("Brand#5",), rescale=True))


@sql("""
with e as (select r_name, case when c_acctbal >= 0 then n_name end n, c_mktsegment m, c_acctbal from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select 'r_name' as rank, r_name path, count(*) size from e group by 2 union all select 'n_name', r_name || ';' || n, count(*) from e where n is not null group by 2
union all select 'c_mktsegment', r_name || ';' || n || ';' || m, count(*) from e where n is not null group by 2""")
def rollup_with_gaps(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("n_name", F.when(F.col("c_acctbal") >= 0, F.col("n_name"))).withColumn("size", F.lit(1))
    return rounded(abundance.rollup_paths(rows, ["r_name", "n_name", "c_mktsegment"], ["size"])).select("rank", "path", "size")


@sql("""
with v as (select o_custkey grp, o_orderpriority taxon, count(*) n from orders group by 1, 2), t as (select grp, sum(n) total, max(n) best, count(*) filter (n = 0) z from v group by 1),
x as (select v.*, t.total, t.best, count(*) over (partition by v.grp, v.n) ties from v join t using (grp))
select grp as "group", 'priority' as rank, taxon, round((total - n) / total, 6) disparity, cast(total as bigint) n_members from x where n = best and ties = 1""")
def consensus_without_shares(spark, d):
    members = table(spark, d, "orders").select(F.col("o_custkey").alias("group"), F.col("o_orderpriority").alias("priority"))
    return rounded(consensus.consensus(members, ["priority"], of_rank=0.0, of_all=0.0, least=0), 6)


@sql("""
with r as (select lang grp, n_chars, sum(n_chars) over (partition by lang order by n_chars desc, doc_id rows unbounded preceding) upto, sum(n_chars) over (partition by lang) total from documents)
select grp, count(*) filter (upto - n_chars < total * 0.5) l_count from r group by 1""")
def l50(spark, d):
    return rounded(ranking.l_count(table(spark, d, "documents").select(F.col("lang").alias("grp"), F.col("n_chars").alias("length")), 50))


@sql("""
with e as (
  select l_orderkey entity, bool_or(list_contains(string_split(p_name, ' '), 'ring')) a, bool_or(l_quantity > 45) b, bool_or(p_brand = 'Brand#1') c
  from lineitem join part on l_partkey = p_partkey group by 1
) select entity from e where (a and b) or c""")
def entities_by_sets(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("l_orderkey").alias("entity"), F.split("p_name", " ").alias("fun"), F.col("l_quantity").alias("s1"), F.col("p_brand").alias("genus"))
    query = "(FUN == ring AND s1 > 45) OR GENUS == Brand#1"
    return select_entities(rows, "entity", query, taxa={"GENUS": "genus"}, functions={"FUN": ["fun"]}, samples={"s1": "s1"})


@sql("""
with v as (select o_custkey grp, o_orderstatus taxon, count(*) n from orders group by 1, 2),
t as (select grp, sum(n) total, max(n) best from v group by 1), x as (select v.*, total, best, count(*) over (partition by v.grp, n) ties from v join t using (grp))
select grp as "group", 'status' as rank, taxon, round((total - n) / total, 6) disparity, cast(total as bigint) n_members
from x where n = best and ties = 1 and n / total >= 0.6""")
def bin_consensus_defaults(spark, d):
    members = table(spark, d, "orders").select(F.col("o_custkey").alias("group"), F.col("o_orderstatus").alias("status"))
    return rounded(consensus.bin_consensus(members, ["status"]), 6)


@sql(f"""
with {_LONG}, r as (select case when feature = 'Brand#1' then 'Unclassified' else feature end feature, sample, value from l where feature <> 'Brand#2' and sample in ('AF', 'RF'))
select feature, round(coalesce(sum(value) filter (sample = 'AF'), 0), 4) "AF", round(coalesce(sum(value) filter (sample = 'RF'), 0), 4) "RF",
  case when feature <> 'Unclassified' then 'of ' || feature end genus from r group by 1""")
def community_bundle(spark, d):
    """The bundle's counts beside its ranks; one brand plays a partial classification, another the unmapped reads."""
    long = _long(spark, d).replace({"Brand#1": "Unclassified Brand#1", "Brand#2": "Unmapped"}, subset=["feature"])
    lineages = table(spark, d, "part").select(F.col("p_brand").alias("feature"), F.concat(F.lit("of "), "p_brand").alias("genus"))
    counts, taxa, _ = packages.community_bundle(long, lineages, long.select("sample").distinct(), ["genus"], ["AF", "RF"], partial="merge")
    return rounded(counts.join(taxa, "feature"))

"""Named queries: every operator over the driver's tables in an analogous role, with the SQL that says the same.

Roles: lineitem rows are reads of a gene (part) in a sample (return flag) or hits of a query (order) to a subject (part);
region > nation > segment is a lineage; orders vote for their customer; events are intervals; documents are contigs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxalith.functions import lineage as L
from taxalith.functions import sequence as S
from taxalith.operators import abundance, consensus, genomes, grouped, hits, intervals, query, ranking
from taxalith.project import combine_tables, completed, union_by_priority
from taxalith.sources import writers
from taxalith.streaming.abundance import windowed_counts
from taxalith.plans.registry import oracle_sql, queries, rounded as _rounded, sql, table as _t  # noqa: F401

def _counts(spark, d: str, feature: str = "l_partkey") -> DataFrame:
    reads = _t(spark, d, "lineitem").join(_t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_brand", "p_type"), "l_partkey")
    return reads.groupBy(F.col(feature).alias("feature"), F.col("l_returnflag").alias("sample")).agg(F.count("*").alias("reads"), F.sum("l_quantity").alias("bases"), F.max("p_size").cast("long").alias("length"))


_COUNTS = "select l_partkey feature, l_returnflag sample, count(*) reads, sum(l_quantity) bases, max(p_size) length from lineitem join part on l_partkey = p_partkey group by 1, 2"


@sql(f"with c as ({_COUNTS}) select feature, sample, reads, cast(round(bases, 4) as double) bases, cast(length as bigint) length, round(reads * 1e9 / (length * sum(reads) over (partition by sample)), 4) rpkm, round(bases / length, 4) coverage, round(reads / length * 1e6 / sum(reads / length) over (partition by sample), 4) tpm from (select feature, sample, reads, bases, cast(length as double) length from c)")
def tpm_by_feature(spark, d):
    return _rounded(abundance.tpm(_counts(spark, d)))


@sql("select l_suppkey feature, l_returnflag sample, count(*) reads, round(count(*) * 100.0 / sum(count(*)) over (partition by l_returnflag), 4) \"percent\" from lineitem group by 1, 2")
def bin_share(spark, d):
    reads = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("feature"), F.col("l_returnflag").alias("sample")).agg(F.count("*").alias("reads"))
    return _rounded(abundance.share(reads))


def _genes(spark, d):
    part = _t(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.split("p_name", " ").alias("fun"), F.col("p_size").cast("long").alias("length"), "p_brand")
    reads = _t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("gene"), F.col("l_returnflag").alias("sample")).agg(F.count("*").alias("reads"), F.sum("l_quantity").alias("bases"))
    return reads.join(part, "gene")


_GENES = "genes as (select l_partkey gene, l_returnflag sample, count(*) reads, sum(l_quantity) bases, string_split(any_value(p_name), ' ') fun, cast(any_value(p_size) as bigint) length, any_value(p_brand) p_brand from lineitem join part on l_partkey = p_partkey group by 1, 2)"


@sql(f"with {_GENES}, t as (select sample, sum(reads) total from genes group by 1), e as (select unnest(fun) fun, sample, reads, bases, length, p_brand from genes), g as (select fun, sample, count(*) copies, sum(length) length, sum(reads) reads, sum(bases) bases, count(distinct p_brand) distinct_p_brand from e group by 1, 2) select fun, sample, copies, cast(length as bigint) length, cast(reads as bigint) reads, round(bases, 4) bases, distinct_p_brand, round(reads * 1e9 / (length * total), 4) rpkm, round(bases / length, 9) coverage, round(reads / (length / copies) * 1e6 / sum(reads / (length / copies)) over (partition by sample), 4) tpm from g join t using (sample)")
def funcover(spark, d):
    cover = abundance.funcover(_genes(spark, d), ["p_brand"])
    return _rounded(cover.withColumn("coverage", F.col("coverage").cast("decimal(38,12)"))).withColumn("coverage", F.round(F.col("coverage").cast("double"), 9))


@sql(f"with {_GENES}, e as (select unnest(fun) fun, sample, reads * 1.0 / len(fun) reads, bases / len(fun) bases, length * 1.0 / len(fun) length from genes) select fun, sample, cast(round(sum(reads), 4) as double) reads, round(sum(bases), 4) bases, cast(round(sum(length), 4) as double) length, count(*) copies from e group by 1, 2")
def function_split_counts(spark, d):
    return _rounded(abundance.split_counts(_genes(spark, d)))


@sql(f"with {_GENES}, e as (select unnest(fun) fun, sample, bases, length from genes), g as (select fun, sample, sum(bases) / sum(length) coverage from e group by 1, 2), m as (select sample, case when min(coverage) > 0 then median(coverage) end base from g where fun in ('red', 'small', 'ring', 'blue', 'large') group by 1) select fun, g.sample, round(coverage / base, 4) copy_number from g left join m on g.sample = m.sample")
def copy_number_median(spark, d):
    cover = abundance.funcover(_genes(spark, d)).select("fun", "sample", "coverage")
    return _rounded(abundance.copy_number(cover, ["red", "small", "ring", "blue", "large"]))


def _lineages(spark, d):
    nation = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return _t(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))


_LINEAGE = "customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"


@sql(f"with e as (select r_name, n_name, c_mktsegment, c_acctbal from {_LINEAGE}) select 'r_name' as rank, r_name path, count(*) size, round(sum(c_acctbal), 2) bases from e group by 1, 2 union all select 'n_name', r_name || ';' || n_name, count(*), round(sum(c_acctbal), 2) from e group by 1, 2 union all select 'c_mktsegment', r_name || ';' || n_name || ';' || c_mktsegment, count(*), round(sum(c_acctbal), 2) from e group by 1, 2")
def hierarchical_rollup(spark, d):
    rows = _lineages(spark, d).select("r_name", "n_name", "c_mktsegment", F.lit(1).alias("size"), F.col("c_acctbal").alias("bases"))
    return _rounded(abundance.rollup_paths(rows, ["r_name", "n_name", "c_mktsegment"], ["size", "bases"]), 2).select("rank", "path", "size", "bases")


@sql("with c as (select o_orderpriority taxon, o_orderstatus sample, count(*) reads from orders where o_totalprice > 50000 group by 1, 2), t as (select o_orderstatus sample, count(*) total from orders group by 1), u as (select * from c union all select 'Unmapped', t.sample, total - coalesce((select sum(reads) from c where c.sample = t.sample), 0) from t) select taxon, u.sample, cast(reads as bigint) reads, round(reads * 100.0 / total, 4) \"percent\" from u join t on u.sample = t.sample")
def taxa_percent_unmapped(spark, d):
    orders = _t(spark, d, "orders").select(F.col("o_orderpriority").alias("taxon"), F.col("o_orderstatus").alias("sample"), "o_totalprice")
    counts = orders.filter("o_totalprice > 50000").groupBy("taxon", "sample").agg(F.count("*").alias("reads"))
    return _rounded(abundance.taxa_percent(counts, orders.groupBy("sample").agg(F.count("*").alias("total"))))


@sql("with c as (select case when l_suppkey % 3 = 0 then 'No bin' else cast(l_suppkey % 7 as varchar) end bin, l_returnflag sample, count(*) reads, sum(l_quantity) bases, sum(l_linenumber) length from lineitem group by 1, 2), t as (select l_returnflag sample, count(*) total from lineitem group by 1) select bin, c.sample, reads, round(bases, 4) bases, cast(length as bigint) length, round(reads * 100.0 / total, 4) \"percent\", round(bases / length, 4) coverage, round(bases / length / (total / 1e6), 4) cpm from c join t on c.sample = t.sample")
def bin_abundance(spark, d):
    rows = _t(spark, d, "lineitem").select(F.expr("if(l_suppkey % 3 = 0, null, cast(l_suppkey % 7 as string))").alias("bin"), F.col("l_returnflag").alias("sample"), F.lit(1).alias("reads"), F.col("l_quantity").alias("bases"), F.col("l_linenumber").alias("length"))
    return _rounded(abundance.bin_abundance(rows, rows.groupBy("sample").agg(F.count("*").alias("total"))))


def _long(spark, d):
    return _t(spark, d, "lineitem").join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("feature"), F.concat("l_returnflag", "l_linestatus").alias("sample")).agg(F.sum("l_quantity").alias("value"))


_LONG = "l as (select p_brand feature, l_returnflag || l_linestatus sample, sum(l_quantity) value from lineitem join part on l_partkey = p_partkey group by 1, 2)"


@sql(f"with {_LONG}, t as (select feature from l group by 1 order by sum(value) desc, feature limit 10) select case when feature in (select feature from t) then feature else 'Other' end feature, sample, round(sum(value), 2) as value from l group by 1, 2")
def most_abundant_others(spark, d):
    return _rounded(ranking.most_abundant(_long(spark, d), 10), 2)


@sql(f"with {_LONG} select feature, round(stddev_samp(value) / avg(value), 6) cv from l group by 1 having stddev_samp(value) is not null order by stddev_samp(value) / avg(value) desc, feature limit 15")
def most_variable_cv(spark, d):
    return _rounded(ranking.most_variable(_long(spark, d), 15), 6)


@sql(f"with {_LONG} select feature, round(min(value), 2) least, round(max(value), 2) as most, round(median(value), 2) middle from l group by 1")
def row_min_max_median(spark, d):
    return _rounded(ranking.row_stats(_long(spark, d)), 2)


@sql("with c as (select lang grp, cast(n_chars as bigint) length, sum(n_chars) over (partition by lang order by n_chars desc) upto, sum(n_chars) over (partition by lang) total from documents) select grp, max(case when upto >= total * 0.5 then length end) n50, max(case when upto >= total * 0.9 then length end) n90 from c group by 1")
def n50_n90(spark, d):
    lengths = _t(spark, d, "documents").select(F.col("lang").alias("grp"), F.col("n_chars").alias("length"))
    n = [ranking.n_percent(lengths, p).withColumnRenamed("n_length", f"n{p}") for p in (50, 90)]
    return n[0].join(n[1], "grp")


@sql("select lang, count(*) n, cast(sum(n_chars) as bigint) total, cast(min(n_chars) as bigint) least, cast(max(n_chars) as bigint) as most, round(avg(n_chars), 4) mean, count(*) filter (where n_chars >= 1000) long_ones from documents group by 1")
def length_stats(spark, d):
    c = F.col("n_chars")
    return _rounded(_t(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum(c).alias("total"), F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean"), F.count(F.when(c >= 1000, 1)).alias("long_ones")))


def _hits(spark, d):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rows = _t(spark, d, "lineitem").withColumn("hit_order", F.row_number().over(order))
    return rows.join(_t(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_type"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("subject"), F.col("p_brand").alias("fun"), F.col("l_extendedprice").alias("score"), (F.col("l_quantity") * 2).alias("identity"), (F.col("l_quantity") * 100 / 50).alias("overlap"), "hit_order", "p_type")


_HITS = "hits as (select l_orderkey query, l_partkey subject, p_brand fun, l_extendedprice score, l_quantity * 2 identity, l_quantity * 100 / 50 overlap, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) hit_order, p_type from lineitem join part on l_partkey = p_partkey)"


@sql(f"with {_HITS} select query, subject, fun, round(score, 2) score from hits where hit_order = 1")
def best_hit(spark, d):
    return _rounded(hits.best_hit(_hits(spark, d)).select("query", "subject", "fun", "score"), 2)


@sql(f"with {_HITS} select query, count(distinct subject) n_hits from hits group by 1")
def distinct_subjects(spark, d):
    return hits.distinct_subjects(_hits(spark, d))


@sql(f"with {_HITS}, f as (select * from hits where overlap >= 30), b as (select query, arg_min(fun, hit_order) besthit from f group by 1), k as (select *, row_number() over (partition by query, fun order by hit_order) p from f), m as (select query, fun, avg(score) mean from k where p <= 3 group by 1, 2), r as (select *, row_number() over (partition by query order by mean desc, fun) place, coalesce(lead(mean) over (partition by query order by mean desc, fun), 0) second_one from m) select b.query, besthit, case when (mean - second_one) / mean > 0.1 then fun end bestaver from b join r on b.query = r.query where place = 1")
def besthit_bestaver(spark, d):
    return hits.besthit_bestaver(_hits(spark, d))


@sql(f"with {_HITS}, k as (select *, row_number() over (partition by query, fun order by hit_order) p from hits) select query, fun, round(avg(score), 6) mean_score, count(*) n from k where p <= 3 group by 1, 2")
def topk_hits_mean(spark, d):
    return _rounded(hits.topk_mean(_hits(spark, d), 3), 6)


@sql(f"""with {_HITS}, r as (select *, first_value(score) over (partition by query order by hit_order) rs, first_value(identity) over (partition by query order by hit_order) ri from hits),
v as (select query, subject, max(score) score, max(identity) identity, arg_max(identity, hit_order) last_identity, any_value(rs) rs, any_value(ri) ri, any_value(fun) brand, any_value(p_type) kind from r group by 1, 2),
h as (select *, count(*) filter (where last_identity >= 20) over (partition by query) valid from v where score > rs * 0.8 and ri - identity <= 10),
x as (select query, valid, 0 depth, 'brand' as rank, brand taxon from h where last_identity >= 60 union all select query, valid, 1, 'kind', kind from h where last_identity >= 20),
c as (select query, valid, depth, rank, taxon, count(*) n from x group by all), w as (select *, max(n) over (partition by query, depth) best from c),
t as (select *, count(*) filter (where n = best) over (partition by query, depth) ties from w),
q as (select *, row_number() over (partition by query order by depth) p from t where n = best and ties = 1 and n >= valid - 0.2 * valid and n >= case when valid = 1 then 1 else 2 end and valid > 0)
select query, rank, taxon, n votes from q where p = 1""")
def lca_vote(spark, d):
    taxa = _t(spark, d, "part").select(F.col("p_partkey").alias("subject"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))
    return hits.lca_vote(_hits(spark, d), taxa, {"brand": 60, "kind": 20})


def _members(spark, d, group="o_custkey"):
    return _t(spark, d, "orders").select(F.col(group).alias("group"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), F.col("o_orderkey").alias("member"))


def _consensus_sql(of_rank: float, of_all: float, stop: bool, group: str = "o_custkey") -> str:
    run = "where fine and (depth = 0 or first_fine)" if stop else "where fine"
    return f"""with m as (select {group} as g, o_orderstatus status, case when o_orderpriority <> '5-LOW' then o_orderpriority end priority from orders), t as (select g, count(*) total from m group by 1),
x as (select g, 0 depth, 'status' as rank, status taxon from m union all select g, 1, 'priority', priority from m where priority is not null), c as (select g, depth, rank, taxon, count(*) n from x group by all),
l as (select *, row_number() over (partition by g, depth order by n desc, taxon) p, coalesce(lead(n) over (partition by g, depth order by n desc, taxon), 0) second_one, sum(n) over (partition by g, depth) assigned from c),
f as (select l.*, total, n / assigned >= {of_rank} and n / total >= {of_all} and n > second_one fine from l join t on l.g = t.g where p = 1), s as (select *, max(case when depth = 0 then fine end) over (partition by g) first_fine from f),
o as (select *, row_number() over (partition by g order by depth desc) q from s {run}) select g as "group", rank, taxon, round((assigned - n) / assigned, 6) disparity, total n_members from o where q = 1"""


@sql(_consensus_sql(0.7, 0.5, False))
def contig_consensus(spark, d):
    return consensus.consensus(_members(spark, d), ["status", "priority"])


@sql(_consensus_sql(0.6, 0.3, True))
def bin_consensus_disparity(spark, d):
    return consensus.consensus(_members(spark, d), ["status", "priority"], 0.6, 0.3, stop_at_failure=True)


@sql("with m as (select o_custkey g, o_orderstatus taxon from orders), c as (select g, taxon, count(*) n, sum(count(*)) over (partition by g) total from m group by 1, 2), l as (select *, row_number() over (partition by g order by n desc, taxon) p from c) select g as \"group\", 'status' as rank, taxon, round(n / total * 100, 4) perc_assigned, round(n / total * 100, 4) perc_total, cast(total as bigint) n_members, round((total - n) / total, 6) disparity from l where p = 1")
def all_ranks_table(spark, d):
    return consensus.all_ranks(_members(spark, d), ["status"])


@sql("select o_custkey as \"group\", 'status' as rank, o_orderstatus taxon, round(count(*) * 100 / sum(count(*)) over (partition by o_custkey), 4) \"percent\" from orders group by o_custkey, o_orderstatus")
def taxa_profile(spark, d):
    return consensus.taxa_profile(_members(spark, d), ["status"])


@sql("select o_orderkey as key, case when o_orderstatus in ('F', 'O') or (o_totalprice > 100000 and o_orderstatus = 'P') then o_orderstatus || ';' || o_orderpriority else o_orderpriority end lineage from orders")
def prokfilter_choice(spark, d):
    o = _t(spark, d, "orders")
    filtered = o.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("top"), F.concat_ws(";", "o_orderstatus", "o_orderpriority").alias("lineage"))
    unfiltered = o.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_totalprice") > 100000, "F").alias("top"), F.col("o_orderpriority").alias("lineage"))
    return consensus.prefer_filtered(filtered, unfiltered, ("F", "O"))


@sql("with l as (select p_partkey key, case when p_size % 3 = 0 then p_brand end a, case when p_size % 5 = 0 then p_type end b, case when p_size % 2 = 0 then p_name end c from part) select key, coalesce(a, coalesce(b, c) || ' (no a in NCBI)', 'Unclassified') a, coalesce(b, c || ' (no b in NCBI)', 'Unclassified ' || a, 'Unclassified') b, coalesce(c, 'Unclassified ' || coalesce(b, a), 'Unclassified') c from l")
def missing_rank_fill(spark, d):
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("key"), F.expr("if(p_size % 3 = 0, p_brand, null)").alias("a"), F.expr("if(p_size % 5 = 0, p_type, null)").alias("b"), F.expr("if(p_size % 2 = 0, p_name, null)").alias("c"))
    filled = L.filled([F.col("a"), F.col("b"), F.col("c")], ("a", "b", "c"))
    return p.select("key", *[f.alias(n) for f, n in zip(filled, "abc")])


def _intervals(spark, d, test: str):
    e = _t(spark, d, "events").filter(test)
    start = F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2020-01-01 00:00:00"))
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("grp"), start.alias("start"), (start + F.floor(F.abs("value") * 20) + 600).cast("long").alias("end"))


def _interval_sql(name: str, test: str) -> str:
    return f"{name} as (select event_id id, user_id grp, cast(floor(epoch(ts)) - 1577836800 as bigint) s, cast(floor(epoch(ts)) - 1577836800 + floor(abs(value) * 20) + 600 as bigint) e from events where {test})"


_IV = f"with {_interval_sql('g', 'event_id % 2 = 0')}, {_interval_sql('r', 'event_id % 2 = 1')} "


@sql(_IV + "select g.id, count(*) reads, cast(sum(least(g.e, r.e) - greatest(g.s, r.s)) as bigint) bases from g join r on g.grp = r.grp and g.s <= r.e and r.s <= g.e group by 1")
def interval_overlap_counts(spark, d):
    return intervals.overlap_counts(_intervals(spark, d, "event_id % 2 = 0"), _intervals(spark, d, "event_id % 2 = 1"), 20000)


@sql(_IV + "select id, grp, s as start, e as \"end\" from g where not exists (select 1 from r where g.grp = r.grp and g.s <= r.e and r.s <= g.e)")
def interval_antijoin(spark, d):
    return intervals.without_overlap(_intervals(spark, d, "event_id % 2 = 0"), _intervals(spark, d, "event_id % 2 = 1"), 20000)


@sql(f"with {_interval_sql('i', 'true')}, o as (select *, max(e) over (partition by grp order by s, e rows between unbounded preceding and 1 preceding) reach from i), n as (select *, sum(case when s <= reach + 1 then 0 else 1 end) over (partition by grp order by s, e rows unbounded preceding) island from o), m as (select grp, island, max(e) - min(s) + 1 n from n group by 1, 2), c as (select grp, sum(n) covered from m group by 1) select grp, cast(200000000 - covered as bigint) uncovered from c")
def uncovered_bases(spark, d):
    i = _intervals(spark, d, "true")
    return intervals.uncovered(i, i.select("grp").distinct().withColumn("length", F.lit(200_000_000)))


@sql("with f as (select c_custkey % 50 grp, c_nationkey family from customer), p as (select n_regionkey pathway, n_nationkey family from nation), t as (select pathway, count(*) total from p group by 1), x as (select grp, pathway, count(distinct f.family) found from f join p on f.family = p.family group by 1, 2) select cast(grp as varchar) grp, cast(x.pathway as varchar) pathway, found, total, found / total >= 0.1 or found >= 2 reported from x join t on x.pathway = t.pathway")
def pathway_report(spark, d):
    families = _t(spark, d, "customer").select((F.col("c_custkey") % 50).cast("string").alias("grp"), F.col("c_nationkey").alias("family")).distinct()
    pathways = _t(spark, d, "nation").select(F.col("n_regionkey").cast("string").alias("pathway"), F.col("n_nationkey").alias("family"))
    return _rounded(grouped.fewest_pathways(families, pathways))


_TAXA = {"BRAND": "p_brand", "TYPE": "p_type"}


def _parts(spark, d):
    return _t(spark, d, "part").withColumn("fun", F.split("p_name", " "))


@sql("select p_partkey from part where p_brand in ('Brand#11', 'Brand#12', 'Brand#3') and (p_size > 20 or p_type <> 'ECONOMY')")
def query_and_or(spark, d):
    return query.select(_parts(spark, d), "BRAND IN [Brand#11, Brand#12, Brand#3] AND (SIZE > 20 OR TYPE != ECONOMY)", taxa=_TAXA, samples={"SIZE": "p_size"}).select("p_partkey")


@sql("select p_partkey from part where len(list_filter(string_split(p_name, ' '), lambda x: contains(x, 'ed'))) > 0 or p_retailprice >= 1500")
def query_contains(spark, d):
    return query.select(_parts(spark, d), "FUN CONTAINS ed OR PRICE >= 1500", functions={"FUN": ["fun"]}, samples={"PRICE": "p_retailprice"}).select("p_partkey")


@sql("select p_partkey, p_name from part where regexp_matches(p_name, '(?i)RING|blue') or regexp_matches(p_type, '(?i)RING|blue')")
def subset_pattern(spark, d):
    return query.subset_by_pattern(_t(spark, d, "part"), "RING|blue", ["p_name", "p_type"]).select("p_partkey", "p_name")


@sql("select o_orderkey, round(o_totalprice, 2) o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def subset_semi(spark, d):
    c = _t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    return _rounded(_t(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_totalprice"), 2)


@sql("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 350000)")
def subset_anti(spark, d):
    return _t(spark, d, "customer").join(_t(spark, d, "orders").filter("o_totalprice > 350000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@sql("select p_brand feature, cast(sum(case when l_returnflag = 'A' then l_quantity else 0 end) as double) a, cast(sum(case when l_returnflag = 'N' then l_quantity else 0 end) as double) n, cast(sum(case when l_returnflag = 'R' then l_quantity else 0 end) as double) r from lineitem join part on l_partkey = p_partkey group by 1")
def pivot_feature_sample(spark, d):
    long = _t(spark, d, "lineitem").join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("feature"), F.lower("l_returnflag").alias("sample"), F.col("l_quantity").alias("value"))
    return abundance.pivoted(long, "feature", "sample", "value", ["a", "n", "r"])


@sql("select l_suppkey feature, l_returnflag sample, count(*) as value from lineitem where l_returnflag in ('A', 'N') group by 1, 2")
def combine_projects(spark, d):
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("feature"), F.col("l_returnflag").alias("sample")).agg(F.count("*").alias("value"))
    return combine_tables([rows.filter(F.col("sample") == s) for s in ("A", "N")])


@sql("select p_partkey, case when p_size > 25 then 'first' else 'second' end origin from part where p_size > 25 or p_size % 2 = 0")
def union_dedupe_priority(spark, d):
    p = _t(spark, d, "part")
    return union_by_priority([p.filter("p_size > 25").select("p_partkey", F.lit("first").alias("origin")), p.filter("p_size % 2 = 0").select("p_partkey", F.lit("second").alias("origin"))], ["p_partkey"])


@sql("select c_custkey as key, coalesce((select min(o_orderpriority) from orders where o_custkey = c_custkey), 'Unclassified') taxon from customer")
def key_completion(spark, d):
    tax = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderpriority").alias("taxon"))
    return completed(tax, _t(spark, d, "customer").select(F.col("c_custkey").alias("key")))


@sql("select o_orderstatus section, count(*) n, count(*) filter (where o_totalprice >= 100000) hi, count(*) filter (where o_totalprice < 50000) lo, count(distinct o_custkey) customers from orders group by 1")
def run_stats(spark, d):
    c = F.col("o_totalprice")
    return _t(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("section")).agg(F.count("*").alias("n"), F.count_if(c >= 100000).alias("hi"), F.count_if(c < 50000).alias("lo"), F.count_distinct("o_custkey").alias("customers"))


@sql(f"with {_LONG}, r as (select *, row_number() over (partition by sample order by value desc, feature) p from l where feature not in ('Brand#11')) select sample, feature, round(value, 2) as value from r where p = 1")
def dominant_per_rank(spark, d):
    return _rounded(ranking.dominant(_long(spark, d), ("Brand#11",)), 2)


@sql(f"with e as (select r_name, n_name, count(*) n from {_LINEAGE} group by 1, 2), t as (select sum(n) total from e) select 'all' as sample, round(sum(n) * 100.0 / any_value(total), 4) \"percent\", cast(sum(n) as bigint) clade_reads, cast(0 as bigint) direct_reads, 'R' as rank, r_name path from e, t group by r_name union all select 'all', round(n * 100.0 / total, 4), n, n, 'N', r_name || ';' || n_name from e, t")
def pavian_clade_counts(spark, d):
    taxa = _lineages(spark, d).groupBy("r_name", "n_name").agg(F.count("*").alias("reads")).withColumn("sample", F.lit("all"))
    return _rounded(writers.clade_report(taxa, ["r_name", "n_name"]))


@sql("select doc_id, round((length(text) - length(translate(text, 'GCgc', ''))) * 100.0 / length(text), 4) gc from documents where length(text) > 0")
def gc_percent(spark, d):
    return _rounded(_t(spark, d, "documents").filter("length(text) > 0").select("doc_id", S.gc_percent(F.col("text")).alias("gc")))


def _words(spark, d):
    return _t(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.explode(F.split(F.lower("text"), " ")).alias("kmer"))


_WORDS = "w as (select item_id id, unnest(string_split(lower(text), ' ')) kmer from benchmark)"


def _kmers_sql(table: str, key: str) -> str:
    """CTE f: id, kmer, n and share of canonical 4-mers; runs of ACGT first, as only their windows count."""
    return f"u as (select {key} id, unnest(regexp_extract_all(upper(text), '[ACGT]{{4,}}')) run from {table}), v as (select id, run, unnest(range(1, length(run) - 2)) i from u), w as (select id, least(substr(run, i, 4), reverse(translate(substr(run, i, 4), 'ACGT', 'TGCA'))) kmer from v), f as (select id, kmer, count(*) n, count(*) / sum(count(*)) over (partition by id) share from w group by 1, 2)"


@sql(f"with {_kmers_sql('documents', 'doc_id')} select id, kmer, n, round(share, 6) share from f")
def kmer_profile(spark, d):
    return _rounded(genomes.kmer_profile(_t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq")), 4), 6)


@sql(f"with {_kmers_sql('benchmark', 'item_id')}, q as (select x.id a, y.id b from (select distinct id from f) x join (select distinct id from f) y on x.id < y.id), e as (select a, b, kmer, abs(sum(case when id = a then share else -share end)) x from q join f on a = id or b = id group by 1, 2, 3) select a, b, round(sum(x), 6) distance from e group by 1, 2")
def kmer_distance(spark, d):
    """All pairs of items of benchmark that hold a 4-mer."""
    profile = genomes.kmer_profile(_t(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("seq")), 4)
    ids = profile.select("id").distinct()
    pairs = ids.select(F.col("id").alias("a")).join(ids.select(F.col("id").alias("b")), F.col("a") < F.col("b"))
    return _rounded(genomes.profile_distance(profile, pairs), 6)


_GROUP = "concat_ws(':', coalesce(lang, ''), coalesce(source, ''))"


@sql(f"""
with {_kmers_sql('documents', _GROUP)}, q as (select x.id a, y.id b from (select distinct id from f) x join (select distinct id from f) y on x.id < y.id),
e as (select a, b, kmer, abs(sum(case when id = a then share else -share end)) x from q join f on a = id or b = id group by 1, 2, 3)
select a, b, round(sum(x), 6) distance from e group by 1, 2""")
def kmer_distance_groups(spark, d):
    """All pairs of groups of documents by language and source that hold a 4-mer."""
    profile = genomes.kmer_profile(_t(spark, d, "documents").select(F.expr(_GROUP).alias("id"), F.col("text").alias("seq")), 4)
    ids = profile.select("id").distinct()
    pairs = ids.select(F.col("id").alias("a")).join(ids.select(F.col("id").alias("b")), F.col("a") < F.col("b"))
    return _rounded(genomes.profile_distance(profile, pairs), 6)


@sql(f"with {_WORDS}, o as (select distinct id, kmer from w), s as (select id, count(*) n from o group by 1), x as (select a.id a, b.id b, count(*) k from o a join o b on a.kmer = b.kmer and a.id < b.id group by 1, 2) select a, b, round(k / (s1.n + s2.n - k), 6) jaccard from x join s s1 on a = s1.id join s s2 on b = s2.id where k / (s1.n + s2.n - k) >= 0.1")
def jaccard_pairs(spark, d):
    return _rounded(genomes.jaccard_pairs(_words(spark, d).withColumnRenamed("kmer", "word"), 0.1), 6)


_MARK = "c as (select o_custkey grp, o_orderpriority marker, count(*) n from orders group by 1, 2), s as (select case when marker < '3' then 1 else 2 end set_id, marker from (select distinct o_orderpriority marker from orders)), z as (select *, count(*) over (partition by set_id) size from s)"


def _marker_tables(spark, d):
    o = _t(spark, d, "orders")
    counts = o.groupBy(F.col("o_custkey").alias("grp"), F.col("o_orderpriority").alias("marker")).agg(F.count("*").alias("n"))
    return counts, o.select(F.expr("if(o_orderpriority < '3', 1, 2)").alias("set_id"), F.col("o_orderpriority").alias("marker")).distinct()


@sql(f"with {_MARK}, k as (select count(distinct set_id) k from s) select cast(grp as bigint) grp, round(sum(1.0 / size) * 100 / any_value(k), 4) completeness, round(sum((n - 1.0) / size) * 100 / any_value(k), 4) contamination from c join z on c.marker = z.marker, k group by 1")
def completeness_contamination(spark, d):
    return _rounded(genomes.completeness(*_marker_tables(spark, d)))


@sql(f"with {_MARK}, m as (select count(*) k from s), a as (select grp, count(*) present, count(*) filter (where n > 1) multicopy from c group by 1) select cast(grp as bigint) grp, present, multicopy from a, m where k - present <= 1 and multicopy <= 4")
def scg_approval(spark, d):
    counts, sets = _marker_tables(spark, d)
    return _rounded(genomes.approved(counts, sets.count(), 1, 4))


@sql("with m as (select l_returnflag sample, case when l_suppkey % 4 = 0 then 'unbinned' else 'b' || cast(l_suppkey % 4 as varchar) end bin, count(*) reads, sum(l_quantity) size from lineitem group by 1, 2), r as (select *, case when bin <> 'unbinned' then reads / size end rate, sum(reads) over (partition by sample) total, sum(case when bin <> 'unbinned' then reads end) over (partition by sample) binned from m) select sample, bin, round(reads * 100.0 / total, 4) percent_mapped, round(rate * 100 / sum(rate) over (partition by sample) * binned / total, 4) percent_community from r")
def community_profile(spark, d):
    m = _t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.expr("if(l_suppkey % 4 = 0, 'unbinned', concat('b', l_suppkey % 4))").alias("bin")).agg(F.count("*").alias("reads"), F.sum("l_quantity").alias("size"))
    return _rounded(genomes.community_profile(m))


@sql("with h as (select l_partkey a, l_suppkey b, max(l_extendedprice) score from lineitem group by 1, 2), f as (select *, row_number() over (partition by a order by score desc, b) x, row_number() over (partition by b order by score desc, a) y from h) select a, b, round(score, 2) score from f where x = 1 and y = 1")
def reciprocal_best(spark, d):
    h = _t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.max("l_extendedprice").alias("score"))
    return _rounded(hits.reciprocal_best(h), 2)


def _alleles(spark, d):
    return _t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), (F.col("l_partkey") % 100).alias("locus"), F.col("l_linenumber").alias("allele")).agg(F.count("*").alias("n"))


_ALLELES = "f as (select l_returnflag sample, l_partkey % 100 locus, l_linenumber allele, count(*) n from lineitem group by 1, 2, 3)"


@sql(f"with {_ALLELES}, s as (select sample, locus, sum(n) dp, sum(n * n) sq from f group by 1, 2 having sum(n) > 1) select sample, round(sum((1 - sq / (dp * dp)) * dp / (dp - 1)), 4) pi, count(*) loci from s group by 1")
def nucleotide_diversity(spark, d):
    return _rounded(genomes.nucleotide_diversity(_alleles(spark, d)))


@sql(f"with {_ALLELES}, p as (select *, n / sum(n) over (partition by sample, locus) p from f), h as (select sample, locus, 1 - sum(p * p) h from p group by 1, 2), s as (select a.sample a, b.sample b, a.locus, sum(a.p * b.p) same from p a join p b on a.locus = b.locus and a.allele = b.allele and a.sample < b.sample group by 1, 2, 3), c as (select a.sample a, b.sample b, a.locus, (a.h + b.h) / 2 inside from h a join h b on a.locus = b.locus and a.sample < b.sample), z as (select c.a, c.b, sum(inside) i, sum(1 - coalesce(same, 0)) w from c left join s on c.a = s.a and c.b = s.b and c.locus = s.locus group by 1, 2) select a, b, round(1 - i / w, 6) fst from z")
def fst_pairs(spark, d):
    return _rounded(genomes.fst(_alleles(spark, d)), 6)


@sql("select least(l_suppkey, l_partkey % 100) x, greatest(l_suppkey, l_partkey % 100) y, count(*) support from lineitem where l_suppkey <> l_partkey % 100 group by 1, 2 having count(*) >= 3")
def scaffold_edges(spark, d):
    return genomes.scaffold_edges(_t(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 100).alias("b")), 3)


@sql("with o as (select p_brand otu, count(*) abundance, avg(l_quantity) size from lineitem join part on l_partkey = p_partkey group by 1), t as (select sum(abundance) total, sum(abundance * size) bases, count(*) filter (where abundance = 1) singles from o), r as (select *, row_number() over (order by abundance desc, size desc, otu) p from o) select otu, p place, round(5 * bases / abundance, 2) depth, round(100 * (1 - exp(-5.0)), 2) percent_seen, round(singles / total, 2) unobserved from r, t where p = 4")
def cover_depth(spark, d):
    otus = _t(spark, d, "lineitem").join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("otu")).agg(F.count("*").alias("abundance"), F.avg("l_quantity").alias("size"))
    return _rounded(genomes.sequencing_depth(otus, 5.0, 4), 2)


@sql("with n as (select item_id, text, greatest(1, length(text) // 100) k from benchmark), e as (select item_id, text, k, unnest(range(k)) w from n) select item_id, w part, substr(text, w * 100 + 1, case when w = k - 1 then length(text) else 100 end) seq from e")
def cut_windows(spark, d):
    return _rounded(_t(spark, d, "benchmark").select("item_id", F.posexplode(S.windows(F.col("text"), 100)).alias("part", "seq")))


@sql("with c as (select l_orderkey contig, l_returnflag cluster, count(*) n from lineitem group by 1, 2), r as (select *, row_number() over (partition by contig order by n desc, cluster) p from c) select contig, cluster, n votes from r where p = 1")
def merge_cluster_majority(spark, d):
    return genomes.majority_cluster(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("contig"), F.col("l_returnflag").alias("cluster")))


@sql("with e as (select distinct p_brand parent, p_type taxon from part) select 'p_type' as rank, taxon, count(*) parents from e group by 2 having count(*) > 1")
def taxonomy_consistency(spark, d):
    return genomes.inconsistent_taxa(_t(spark, d, "part"), ["p_brand", "p_type"])


@sql("select md5(text) digest, count(*) n, min(doc_id) first_id from documents group by text having count(*) > 1")
def duplicate_sequences(spark, d):
    return genomes.duplicate_sequences(_t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq")))


@sql(f"with {_LONG}, m as (select feature, median(value) filter (where sample in ('AF', 'RF')) x, median(value) filter (where sample in ('NO', 'NF')) y from l group by 1) select feature, case when x > 0 and y > 0 then round(log2(y / x), 6) end log2fc from m")
def log2fc_groups(spark, d):
    return _rounded(ranking.log2_change(_long(spark, d), ["AF", "RF"], ["NO", "NF"]), 6)


@sql("select l_returnflag a, l_linestatus b, cast(count(*) as bigint) shared, round(count(*) * 100.0 / sum(count(*)) over (partition by l_returnflag), 4) percent_a, round(count(*) * 100.0 / sum(count(*)) over (partition by l_linestatus), 4) percent_b from lineitem group by 1, 2")
def bin_comparison(spark, d):
    rows = _t(spark, d, "lineitem").groupBy(F.concat_ws(":", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").alias("contig"), F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b")).agg(F.count("*").alias("length"))
    return _rounded(genomes.bin_comparison(rows.select(F.col("a").alias("bin"), "contig", "length"), rows.select(F.col("b").alias("bin"), "contig", "length")))


@sql("select date_trunc('hour', ts) as start, event_type feature, count(*) reads, round(sum(value), 4) total from events group by 1, 2")
def windowed_event_counts(spark, d):
    return _rounded(windowed_counts(_t(spark, d, "events")))


@sql(f"with {_GENES}, e as (select unnest(fun) fun, sample, reads from genes), g as (select fun, sample, sum(reads) reads from e group by 1, 2), t as (select fun from g group by 1 having sum(reads) >= 200) select fun, cast(sum(case when sample = 'A' then reads else 0 end) as bigint) a, cast(sum(case when sample = 'N' then reads else 0 end) as bigint) n, cast(sum(case when sample = 'R' then reads else 0 end) as bigint) r from g where fun in (select fun from t) group by 1")
def stamp_table(spark, d):
    wide = writers.stamp(abundance.funcover(_genes(spark, d)), ["A", "N", "R"])
    return wide.select("fun", *[F.col(s).cast("long").alias(s.lower()) for s in "ANR"])


@sql(f"select 'all' as sample, count(*) reads, r_name || chr(9) || n_name taxonomy from {_LINEAGE} group by r_name, n_name")
def krona_rows(spark, d):
    return writers.krona(_lineages(spark, d).groupBy("r_name", "n_name").agg(F.count("*").alias("reads")).withColumn("sample", F.lit("all")), ["r_name", "n_name"])


@sql("with e as (select distinct unnest(string_split(p_name, ' ')) fun from part where regexp_matches(p_brand, '#1')) select fun, case fun when 'red' then '#00ff00' else '#ff0000' end colour from e")
def ipath_colours(spark, d):
    return writers.ipath(_parts(spark, d).withColumn("lineage", F.col("p_brand")), {"red": "#00ff00"}, taxon="#1")


# The queries of these modules join the same registry.
from taxalith.plans import annotations, genomics, tables  # noqa: E402, F401

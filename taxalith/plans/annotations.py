"""Queries of annotations, names and wide tables; parts are genes of contigs, brands and types their functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxalith.functions import names
from taxalith.operators import annotations as A
from taxalith.operators import consensus, hits, statistics
from taxalith.plans.registry import rounded, sql, table

_ORF = "concat('c', p_partkey, '_1-', p_size)"


def _orfs(spark, d):
    return table(spark, d, "part").withColumn("orf", F.expr(_ORF))


def _orf_counts(spark, d):
    named = table(spark, d, "lineitem").join(_orfs(spark, d).select("p_partkey", "orf"), F.col("l_partkey") == F.col("p_partkey"))
    return named.groupBy("orf", F.col("l_returnflag").alias("sample")).agg(F.count("*").alias("reads"), F.sum("l_quantity").alias("bases"))


@sql(f"""
with c as (
  select {_ORF} orf, l_returnflag sample, count(*) reads, sum(l_quantity) bases
  from lineitem join part on l_partkey = p_partkey group by 1, 2
), w as (
  select orf, sum(reads) filter (sample = 'A') ra, sum(reads) filter (sample = 'N') rn, sum(reads) filter (sample = 'R') rr,
    sum(bases) filter (sample = 'A') ba, sum(bases) filter (sample = 'N') bn, sum(bases) filter (sample = 'R') br from c group by 1
)
select {_ORF} orf, 'c' || p_partkey contig, cast(p_size as bigint) length, case when p_size > 10 then p_brand end brand, p_type "class type",
  p_name "class name", cast(coalesce(ra, 0) as bigint) "reads A", cast(coalesce(rn, 0) as bigint) "reads N", cast(coalesce(rr, 0) as bigint) "reads R",
  round(coalesce(ba, 0), 4) "bases A", round(coalesce(bn, 0), 4) "bases N", round(coalesce(br, 0), 4) "bases R"
from part left join w on {_ORF} = w.orf""")
def orf_table(spark, d):
    parts = _orfs(spark, d)
    brands = parts.filter("p_size > 10").select("orf", F.col("p_brand").alias("name"))
    classes = parts.select("orf", F.col("p_type").alias("type"), F.col("p_name").alias("name"))
    measures = {"reads": "reads", "bases": "bases"}
    orfs = parts.select("orf", F.col("p_size").alias("length"))
    return rounded(A.orf_table(orfs, _orf_counts(spark, d), ["A", "N", "R"], measures, brand=brands, **{"class": classes}))


@sql("""
with k as (select c_custkey contig from customer union select o_custkey from orders union select s_suppkey from supplier),
c as (
  select o_custkey contig, count(*) filter (o_orderstatus = 'F') f, count(*) filter (o_orderstatus = 'O') o, count(*) filter (o_orderstatus = 'P') p
  from orders group by 1
), b as (select s_suppkey contig, string_agg(distinct cast(s_nationkey as varchar), ';' order by cast(s_nationkey as varchar)) bins from supplier group by 1)
select k.contig, c_mktsegment lineage, coalesce(f, 0) "reads F", coalesce(o, 0) "reads O", coalesce(p, 0) "reads P", bins
from k left join customer on k.contig = c_custkey left join c on k.contig = c.contig left join b on k.contig = b.contig""")
def contig_table(spark, d):
    lineages = table(spark, d, "customer").select(F.col("c_custkey").alias("contig"), F.col("c_mktsegment").alias("lineage"))
    coverage = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("contig"), F.col("o_orderstatus").alias("sample")).agg(F.count("*").alias("reads"))
    bins = table(spark, d, "supplier").select(F.col("s_suppkey").alias("contig"), F.col("s_nationkey").cast("string").alias("bin"))
    return rounded(A.contig_table(lineages, coverage, bins, ["F", "O", "P"], {"reads": "reads"}))


@sql("""
select l_orderkey orf, string_agg(distinct p_brand || ' [' || p_type || ']', ';' order by p_brand || ' [' || p_type || ']') families
from lineitem join part on l_partkey = p_partkey group by 1""")
def family_list(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.family_list(rows.select(F.col("l_orderkey").alias("orf"), F.col("p_brand").alias("accession"), F.col("p_type").alias("name")))


@sql(f"""
with e as (select distinct unnest(string_split(p_name, ' ')) fun, {_ORF} orf from part)
select fun, count(*) n, string_agg(orf, ';' order by orf) orfs from e group by 1""")
def annotation_summary(spark, d):
    return A.annotation_summary(_orfs(spark, d).select(F.explode(F.split("p_name", " ")).alias("fun"), "orf"))


@sql("""
select p_partkey orf, p_type fun, coalesce(r_name, '') as name, coalesce(n_name, '') as "function", case when n_nationkey is null then '' else 'path' end path
from part left join nation on p_size = n_nationkey left join region on n_regionkey = r_regionkey""")
def described_functions(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    known = nation.select(F.col("n_nationkey").alias("id"), F.col("r_name").alias("name"), F.col("n_name").alias("function"), F.lit("path").alias("path"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("orf"), F.col("p_type").alias("fun"), F.col("p_size").alias("key"))
    return A.described(rows, known, "key").drop("key")


@sql("select p_partkey gene, p_brand fun, n_name ec from part join nation on n_regionkey + 1 = cast(substr(p_brand, 7) as integer)")
def enzymes(spark, d):
    numbers = table(spark, d, "nation").select(F.concat(F.lit("Brand#"), F.col("n_regionkey") + 1).alias("fun"), F.col("n_name").alias("ec"))
    return A.enzymes(table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("fun")), numbers)


@sql("""
with f as (select s_suppkey orf, s_name as name from supplier where s_acctbal > 0)
select c_custkey orf, c_name as name, 'predicted' "method" from customer where c_custkey in (select o_custkey from orders)
  and c_custkey not in (select orf from f)
union all select orf, name, 'aligned' from f""")
def merged_predictions(spark, d):
    predicted = table(spark, d, "customer").select(F.col("c_custkey").alias("orf"), F.col("c_name").alias("name"))
    found = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("orf"), F.col("s_name").alias("name"))
    return A.merged_predictions(predicted, found, table(spark, d, "orders").select(F.col("o_custkey").alias("orf")))


@sql("select distinct l_orderkey entity from lineitem join part on l_partkey = p_partkey where contains(p_name, 'ring')")
def entities_containing(spark, d):
    genes = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("entity"), F.col("l_partkey").alias("gene"))
    return A.containing(genes, table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.col("p_name").alias("fun")), "ring")


@sql("""
with f as (select p_partkey id from part where p_brand = 'Brand#3'),
r as (select l_orderkey as read from lineitem where l_partkey in (select id from f) union select id from f)
select l_orderkey as read, l_partkey orf, count(*) n from lineitem where l_orderkey in (select read from r) group by 1, 2""")
def found_by_read(spark, d):
    orfs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_partkey").alias("orf"))
    found = table(spark, d, "part").filter("p_brand = 'Brand#3'").select(F.col("p_partkey").alias("id"))
    return A.by_read(orfs, found).groupBy("read", "orf").agg(F.count("*").alias("n"))


@sql("select p_partkey as name, p_brand accession, p_type description from part where not (regexp_matches(p_type, '^ECO') or regexp_matches(p_brand, '#2$'))")
def models_excluded(spark, d):
    models = table(spark, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_brand").alias("accession"), F.col("p_type").alias("description"))
    return A.models_matching(models.withColumn("name", F.col("name").cast("string")), ["!^ECO", "!#2$"]).withColumn("name", F.col("name").cast("long"))


@sql("""
with s as (select c_custkey species from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE'))
select o_orderkey entry, o_custkey species from orders where o_custkey not in (select species from s)""")
def database_without_taxa(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lineages = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    entries = table(spark, d, "orders").select(F.col("o_orderkey").alias("entry"), F.col("o_custkey").alias("species"))
    return A.of_taxa(entries, lineages.select(F.col("c_custkey").alias("species"), F.col("r_name").alias("taxon")), ["ASIA", "EUROPE"], exclude=True)


@sql("select 'host' part, count(*) n from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0) union all select 'kept', count(*) from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def host_split(spark, d):
    reads = table(spark, d, "orders").select(F.col("o_custkey").alias("read"))
    kept, host = A.host_split(reads, table(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("read")))
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, df in (("kept", kept), ("host", host))]
    return counts[0].unionByName(counts[1])


@sql("""
select l_returnflag sample, l_partkey as read, cast(min(l_orderkey * 1000000000 + l_suppkey * 10 + l_linenumber) as bigint) line from lineitem group by 1, 2""")
def first_alignments(spark, d):
    line = F.expr("l_orderkey * 1000000000 + l_suppkey * 10 + l_linenumber")
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("read"), line.alias("line"))
    return A.first_alignments(rows)


@sql("select 'contig_' || row_number() over (order by n_chars desc, doc_id) as new, doc_id old, n_chars from documents")
def contigs_numbered(spark, d):
    contigs = table(spark, d, "documents").select(F.col("doc_id").alias("contig"), "n_chars")
    return A.numbered(contigs, "contig", [F.desc("n_chars"), F.asc("contig")])


@sql("""
with k as (select c_custkey key, r_name, n_name, c_mktsegment from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select key, case when r_name = 'ASIA' then 'k_ASIA;n_' || n_name when c_mktsegment in ('BUILDING', 'MACHINERY') then 'k_' || r_name end lineage
from k where r_name = 'ASIA' or c_mktsegment in ('BUILDING', 'MACHINERY')""")
def eukaryote_override(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("c_custkey", "key")
    filtered = rows.filter("c_mktsegment in ('BUILDING', 'MACHINERY')").select("key", F.concat(F.lit("k_"), "r_name").alias("lineage"))
    unfiltered = rows.select("key", F.concat(F.lit("k_"), "r_name", F.lit(";n_"), "n_name").alias("lineage"))
    return consensus.eukaryote_override(filtered, unfiltered, "k_ASIA")


@sql("""
select c_custkey key, case when c_mktsegment = 'BUILDING' then 'unclassified' when r_name = 'ASIA' then r_name || '(60)' else r_name end as a,
  case when c_mktsegment = 'BUILDING' then 'unmapped' when r_name = 'ASIA' then n_name || '(0)' else n_name end as b
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def lineage_lca(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    unlike, asia = F.col("c_mktsegment") == "BUILDING", F.col("r_name") == "ASIA"
    own = {"x0": F.when(unlike, "other").otherwise(F.col("r_name")), "x1": F.when(unlike, "unmapped").otherwise(F.col("n_name"))}
    support = {"s": F.when(asia, F.array(F.lit(90), F.lit(0))).otherwise(F.array(F.lit(0), F.lit(0))), "t": F.when(asia, F.array(F.lit(60), F.lit(5))).otherwise(F.array(F.lit(0), F.lit(0)))}
    a, b = consensus.lineage_lca(["r_name", "n_name"], ["x0", "x1"], ("s", "t"))
    return rows.withColumns(own | support).select(F.col("c_custkey").alias("key"), a.alias("a"), b.alias("b"))


@sql("""
select cast(n_nationkey as bigint) id, 'k_' || r_name || ';p_' || n_name || ';n_sub;s_x' lettered, 'k_' || r_name || ';p_' || n_name cleaned from nation join region on n_regionkey = r_regionkey""")
def lineage_rewriting(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    raw = F.concat(F.lit("superkingdom:"), "r_name", F.lit(";phylum:"), "n_name", F.lit(";subphylum:sub;species:x"))
    gaps = F.concat(F.lit("k_"), "r_name", F.lit(";_;p_"), "n_name", F.lit(";s_"))
    return rows.select(F.col("n_nationkey").cast("long").alias("id"), names.lettered(raw).alias("lettered"), names.without_empty(gaps).alias("cleaned"))


@sql("""
select c_custkey key, r_name d, case when c_acctbal < 0 then 'Unclassified ' || r_name else n_name end p,
  case when c_mktsegment = 'BUILDING' then 'Unclassified ' || case when c_acctbal < 0 then r_name else n_name end else c_mktsegment end c
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def gtdb_names(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    ranks = [F.concat(F.lit("d__"), "r_name"), F.when(F.col("c_acctbal") < 0, "p__").otherwise(F.concat(F.lit("p__"), "n_name")), F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("c__"), "c_mktsegment"))]
    out = names.gtdb_taxa(ranks)
    return rows.select(F.col("c_custkey").alias("key"), *(c.alias(n) for c, n in zip(out, "dpc")))


@sql("""
with r as (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) - 1 n from part)
select p_partkey, case when n > 0 then p_name || '.' || n else p_name end p_name from r""")
def names_made_unique(spark, d):
    return names.made_unique(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"])


@sql("""
with r as (select doc_id, n_chars, (n_chars + 5) // 10 h from documents)
select doc_id, case when n_chars >= 1000 then (h // 100) || '.' || lpad(cast(h % 100 as varchar), 2, '0') || ' kb' else n_chars || '.00 b' end size from r""")
def human_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", names.human(F.col("n_chars")).alias("size"))


@sql("select c_custkey id, cast(2 as bigint) n, 'F1 [' || c_mktsegment || '; x]' as first from customer")
def family_split(spark, d):
    value = F.concat(F.lit("F1 ["), "c_mktsegment", F.lit("; x];F2 [y]"))
    parts = names.families(value)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.size(parts).cast("long").alias("n"), parts[0].alias("first"))


@sql("select cast(n_nationkey as bigint) id, cast(2 as bigint) sets, n_name || ',' || r_name as first from nation join region on n_regionkey = r_regionkey")
def marker_sets(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sets = names.marker_sets(F.concat(F.lit("[set(['"), "n_name", F.lit("', '"), "r_name", F.lit("']), set(['z'])]")))
    return rows.select(F.col("n_nationkey").cast("long").alias("id"), F.size(sets).cast("long").alias("sets"), F.array_join(sets[0], ",").alias("first"))


@sql("""
with h as (
  select l_orderkey as query, l_partkey subject, l_extendedprice score, l_quantity identity, l_linenumber, l_suppkey from lineitem
), a as (select p_partkey subject, p_brand genus, p_type family from part),
o as (select *, row_number() over (order by l_linenumber, subject, l_suppkey, score, identity) hit_order from h),
m as (select *, first_value(score) over w rs, first_value(identity) over w ri from o window w as (partition by query order by hit_order)),
b as (select query, subject, max(score) score, max(identity) identity, arg_max(identity, hit_order) li, any_value(rs) rs, any_value(ri) ri from m group by 1, 2),
v as (select * from b join a using (subject) where score > rs * 0.8 and ri - identity <= 10),
n as (select *, count(*) over (partition by query) valid from v),
t as (select query, valid, 0 depth, 'genus' as rank, genus taxon from n union all select query, valid, 1, 'family', family from n),
c as (select query, valid, depth, rank, taxon, count(*) votes from t group by all),
x as (select *, max(votes) over (partition by query, depth) best, count(*) over (partition by query, depth, votes) ties from c),
w as (select * from x where votes = best and ties = 1 and votes >= valid - 0.2 * valid and votes >= case when valid = 1 then 1 else 2 end),
f as (select query, arg_min(rank, depth) as rank, arg_min(taxon, depth) taxon, arg_min(votes, depth) votes from w group by 1)
select query, rank, taxon, votes, 'of ' || taxon lineage from f where taxon <> 'Brand#1'""")
def lca_unfiltered_lineage(spark, d):
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("subject"), F.col("l_extendedprice").alias("score"), F.col("l_quantity").alias("identity"), order.alias("hit_order"))
    part = table(spark, d, "part")
    taxa = part.select(F.col("p_partkey").alias("subject"), F.col("p_brand").alias("genus"), F.col("p_type").alias("family"))
    parents = part.select(F.col("p_brand").alias("taxon")).unionByName(part.select(F.col("p_type").alias("taxon"))).distinct().filter("taxon != 'Brand#1'")
    parents = parents.withColumn("lineage", F.concat(F.lit("of "), "taxon"))
    return hits.with_lineage(hits.lca_vote(rows, taxa, {"genus": 45, "family": 40}, identity=False), parents)


@sql("""
with n as (select 'No CDS' taxon, o_orderstatus sample, count(*) reads from orders where o_totalprice < 50000 group by 1, 2),
t as (select o_orderpriority taxon, o_orderstatus sample, count(*) reads from orders where o_totalprice >= 50000 group by 1, 2)
select 'separate' as mode, * from (select * from t union all select * from n)
union all select 'merged', case when taxon = 'No CDS' then 'Unclassified' else taxon end, sample, reads from (select * from t union all select * from n)
union all select 'ignored', * from t""")
def no_cds_modes(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderpriority").alias("taxon"), F.col("o_orderstatus").alias("sample"), "o_totalprice")
    taxa = orders.filter("o_totalprice >= 50000").groupBy("taxon", "sample").agg(F.count("*").alias("reads"))
    rest = orders.filter("o_totalprice < 50000").groupBy("sample").agg(F.count("*").alias("reads"))
    out = [statistics.with_no_cds(taxa, rest, mode).withColumn("mode", F.lit(mode)) for mode in ("separate", "merged", "ignored")]
    return out[0].unionByName(out[1]).unionByName(out[2])

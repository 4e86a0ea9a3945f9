"""Queries of usage profiles, distances, identity between genomes and sequence quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxalith.functions import sequence as S
from taxalith.operators import genomes, hits, ranking, variation
from taxalith.plans.registry import rounded, sql, table

_CODONS = "c as (select item_id id, unnest([substr(text, i * 3 + 1, 3) for i in range(0, length(text) // 3)]) part from benchmark), u as (select id, part, count(*) n, count(*) * 1.0 / sum(count(*)) over (partition by id) as share from c group by 1, 2)"


def _codons(spark, d):
    return genomes.usage(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), S.codons(F.col("text")).alias("parts")))


@sql(f"with {_CODONS} select id, part, n, round(share, 6) as share from u")
def codon_usage(spark, d):
    return rounded(_codons(spark, d), 6)


#: share: per million, cut off.
@sql("with c as (select doc_id id, unnest(regexp_extract_all(coalesce(text, ''), '(?s).')) part from documents) select id, part, count(*) n, floor(cast(count(*) as double) / cast(sum(count(*)) over (partition by id) as double) * 1e6) as share from c group by 1, 2")
def letter_usage(spark, d):
    parts = S.letters(F.coalesce("text", F.lit("")))
    out = genomes.usage(table(spark, d, "documents").select(F.col("doc_id").alias("id"), parts.alias("parts")))
    return out.withColumn("share", F.floor(F.col("share") * 1e6).cast("double"))


def _distances(spark, d):
    profiles = _codons(spark, d)
    ids = profiles.select("id").distinct()
    pairs = ids.select(F.col("id").alias("a")).join(ids.select(F.col("id").alias("b")), F.col("a") < F.col("b"))
    return profiles, pairs


_PAIRS = f"""{_CODONS}, i as (select distinct id from u), p as (select x.id a, y.id b from i x join i y on x.id < y.id),
s as (select id, sum(share) s, sum(share * share) q from u group by 1),
m as (select x.id a, y.id b, sum(least(x.share, y.share)) least, sum(x.share * y.share) dot from u x join u y on x.part = y.part and x.id < y.id group by 1, 2),
f as (select p.a, p.b, coalesce(least, 0) least, coalesce(dot, 0) dot, x.q aq, y.q bq from p left join m on p.a = m.a and p.b = m.b join s x on p.a = x.id join s y on p.b = y.id)"""


@sql(f"with {_PAIRS} select a, b, round(1 - least, 4) braycurtis, round(sqrt(greatest(0, aq + bq - 2 * dot)), 4) euclidean, round(1 - dot / sqrt(aq * bq), 4) cosine from f")
def usage_dissimilarity(spark, d):
    profiles, pairs = _distances(spark, d)
    out = None
    for metric in ("braycurtis", "euclidean", "cosine"):
        one = genomes.dissimilarity(profiles, pairs, metric).withColumnRenamed("distance", metric)
        out = one if out is None else out.join(one, ["a", "b"])
    return rounded(out)


@sql(f"with {_PAIRS} select a, b, round(2 - 2 * least, 4) distance from f order by 2 - 2 * least, a, b limit 1")
def most_similar_pair(spark, d):
    return rounded(ranking.most_similar(genomes.dissimilarity(*_distances(spark, d)), "distance", largest=False))


@sql("""
with h as (
  select x.l_returnflag a, y.l_returnflag b, x.l_partkey ag, y.l_suppkey bg, max(x.l_quantity) identity, max(x.l_extendedprice) score
  from lineitem x join lineitem y on x.l_orderkey = y.l_orderkey and x.l_returnflag < y.l_returnflag group by 1, 2, 3, 4
), n as (select genome, count(*) n from (select distinct l_returnflag genome, l_partkey from lineitem) group by 1),
f as (select a, b, ag, first(bg order by score desc, bg) bg from h group by 1, 2, 3), r as (select a, b, bg, first(ag order by score desc, ag) ag from h group by 1, 2, 3),
o as (select h.* from h join f on h.a = f.a and h.b = f.b and h.ag = f.ag and h.bg = f.bg join r on h.a = r.a and h.b = r.b and h.ag = r.ag and h.bg = r.bg)
select o.a, o.b, count(*) orthologs, round(avg(identity), 4) aai, round(stddev_pop(identity), 4) sd, round(count(*) * 100.0 / least(any_value(x.n), any_value(y.n)), 4) fraction
from o join n x on o.a = x.genome join n y on o.b = y.genome group by 1, 2""")
def amino_acid_identity(spark, d):
    rows = table(spark, d, "lineitem")
    left = rows.select("l_orderkey", F.col("l_returnflag").alias("a"), F.col("l_partkey").alias("a_gene"), "l_quantity", "l_extendedprice")
    right = rows.select("l_orderkey", F.col("l_returnflag").alias("b"), F.col("l_suppkey").alias("b_gene"))
    found = left.join(right, "l_orderkey").filter("a < b").groupBy("a", "b", "a_gene", "b_gene").agg(F.max("l_quantity").alias("identity"), F.max("l_extendedprice").alias("score"))
    genes = rows.select(F.col("l_returnflag").alias("genome"), "l_partkey").distinct().groupBy("genome").agg(F.count("*").alias("n"))
    return rounded(hits.amino_acid_identity(found, genes))


@sql("""
with g as (select l_returnflag genome, l_suppkey gene, l_linenumber part, count(*) n from lineitem group by 1, 2, 3),
w as (select genome, part, sum(n) * 1.0 / sum(sum(n)) over (partition by genome) p from g group by 1, 2), s as (select genome, gene, sum(n) size from g group by 1, 2),
k as (select g.genome, g.gene, 2 - 2 * sum(least(n * 1.0 / size, p)) distance from g join s on g.genome = s.genome and g.gene = s.gene join w on g.genome = w.genome and g.part = w.part group by 1, 2),
a as (select genome, avg(distance) m, stddev_pop(distance) sd from k group by 1)
select k.genome, gene, round(distance, 4) distance from k join a on k.genome = a.genome where distance > m + 2 * sd""")
def usage_outliers(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("genome"), F.col("l_suppkey").alias("gene"), F.col("l_linenumber").alias("part")).agg(F.count("*").alias("n"))
    return rounded(genomes.usage_outliers(counts))


@sql("""
with l as (select unnest(string_split(text, '')) x from benchmark), n as (select x, count(*) * 1.0 / sum(count(*)) over () p from l group by 1),
q as (select unnest([substr(text, i, 2) for i in range(1, length(text))]) pair from benchmark), k as (select pair, count(*) n, count(*) * 1.0 / sum(count(*)) over () p from q group by 1)
select pair, k.n, round(k.p / (a.p * b.p), 4) odds from k join n a on a.x = substr(pair, 1, 1) join n b on b.x = substr(pair, 2, 1)""")
def dinucleotide_odds(spark, d):
    return rounded(genomes.dinucleotide_odds(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("seq"))))


@sql("""
with t as (select doc_id, coalesce(text, '') as text from documents), m as (
  select doc_id, length(text) n, (length(text) - length(translate(text, 'GCgc', ''))) * 100.0 / nullif(length(text), 0) gc, (length(text) - length(translate(text, 'Nn', ''))) * 100.0 / nullif(length(text), 0) u from t)
select doc_id, case when n < 100 or n > 5000 then 'length' when not (gc between 1 and 4) then 'gc' when u > 6 then 'n' end reason from m""")
def reads_filtered(spark, d):
    text = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", S.low_quality(text, 100, 5000, (1.0, 4.0), 6.0).alias("reason"))


@sql("select event_type sample, round(quantile_cont(value, 0.95), 4) insert_size from events where value > 0 group by 1")
def insert_sizes(spark, d):
    return rounded(genomes.insert_size(table(spark, d, "events").select(F.col("event_type").alias("sample"), F.col("value").alias("insert"))))


@sql("select item_id, substr(text, 3, 8) forward, reverse(translate(substr(text, 3, 8), 'ACGTUacgtu', 'TGCAAtgcaa')) backward from benchmark")
def sequence_parts(spark, d):
    text, start, end = F.col("text"), F.lit(3), F.lit(10)
    return table(spark, d, "benchmark").select("item_id", S.part(text, start, end).alias("forward"), S.part(text, start, end, F.lit("-")).alias("backward"))


#: A gene for each part, of the letters of its name, and alleles for each line of an order. The genetic code as in the operator.
_SITES = f"""code as (select substr('TCAG', a + 1, 1) || substr('TCAG', b + 1, 1) || substr('TCAG', c + 1, 1) codon, substr('{variation.AMINO_ACIDS}', a * 16 + b * 4 + c + 1, 1) aa
  from range(4) x(a), range(4) y(b), range(4) z(c)),
chg as (select k.codon, cast(j as bigint) j, x, k.aa = m.aa same from code k, range(3) p(j), (select unnest(['A', 'C', 'G', 'T']) x), code m
  where x <> substr(k.codon, j + 1, 1) and m.codon = substr(k.codon, 1, j) || x || substr(k.codon, j + 2) and k.aa <> '*' and m.aa <> '*'),
tot as (select codon, count(*) filter (where same) ts, count(*) filter (where not same) tn from chg group by 1),
gene as (select p_partkey gene, translate(lower(p_name), 'abcdefghijklmnopqrstuvwxyz ', 'ACGTACGTACGTACGTACGTACGTACG') seq, p_partkey % 2 = 0 plus from part),
sense as (select gene, plus, length(seq) size, case when plus then seq else reverse(translate(seq, 'ACGT', 'TGCA')) end s from gene),
cod as (select gene, i, substr(s, cast(i * 3 + 1 as bigint), 3) codon from (select gene, s, unnest(range(1, size // 3)) i from sense)),
al as (select l_returnflag sample, l_partkey gene, l_linenumber + l_suppkey % 17 pos, substr('ACGT', cast(1 + l_orderkey % 4 as bigint), 1) allele, count(*) n from lineitem group by 1, 2, 3, 4),
k as (select sample, gene, allele, n, case when plus then pos - 1 else size - pos end k, case when plus then allele else translate(allele, 'ACGT', 'TGCA') end letter from al join sense using (gene)),
site as (select sample, gene, k // 3 i, k % 3 j, allele, letter, n, codon, letter <> substr(codon, cast(k % 3 + 1 as bigint), 1) other from k join cod using (gene) where k >= 0 and cod.i = k // 3),
pick as (select sample, gene, i, j, any_value(codon) codon, first(letter order by n desc, other, allele) most from site group by 1, 2, 3, 4),
now as (select sample, gene, i, any_value(codon) codon, coalesce(max(most) filter (where j = 0), substr(any_value(codon), 1, 1)) || coalesce(max(most) filter (where j = 1), substr(any_value(codon), 2, 1))
  || coalesce(max(most) filter (where j = 2), substr(any_value(codon), 3, 1)) now from pick group by 1, 2, 3),
seen as (select sample, gene, count(*) filter (where not same) pn, count(*) filter (where same) ps from site join now using (sample, gene, i) join chg on chg.codon = now and chg.j = site.j and x = letter group by 1, 2),
whole as (select gene, sum(coalesce(tn, 0)) tn, sum(coalesce(ts, 0)) ts from cod left join tot using (codon) group by 1),
moved as (select sample, gene, sum(coalesce(b.tn, 0) - coalesce(a.tn, 0)) dn, sum(coalesce(b.ts, 0) - coalesce(a.ts, 0)) ds from now left join tot a on a.codon = now.codon left join tot b on b.codon = now group by 1, 2),
t as (select sample, gene, coalesce(pn, 0) pn, coalesce(ps, 0) ps, tn + dn tn, ts + ds ts from moved join whole using (gene) left join seen using (sample, gene))"""


@sql(f"""
with {_SITES}
select sample, gene, pn, ps, cast(tn as bigint) tn, cast(ts as bigint) ts, round((pn / nullif(cast(tn as double), 0)) / nullif(ps / nullif(cast(ts as double), 0), 0), 4) ratio from t""")
def gene_pn_ps(spark, d):
    name = F.translate(F.lower("p_name"), "abcdefghijklmnopqrstuvwxyz ", "ACGTACGTACGTACGTACGTACGTACG")
    genes = table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.col("p_partkey").alias("contig"), F.lit(1).alias("start"), F.expr("if(p_partkey % 2 = 0, '+', '-')").alias("strand"), name.alias("seq"))
    place = (F.col("l_linenumber") + F.col("l_suppkey") % 17).alias("pos")
    letter = F.substring(F.lit("ACGT"), (1 + F.col("l_orderkey") % 4).cast("int"), F.lit(1)).alias("allele")
    alleles = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("contig"), place, letter).agg(F.count("*").alias("n"))
    return rounded(variation.pn_ps(genes, alleles))


@sql("""
with c as (select l_orderkey bin, l_returnflag marker, l_linenumber id, lpad(cast(l_partkey as varchar), 9, '-') || '-' || lpad(cast(l_suppkey as varchar), 7, '-') seq from lineitem),
p as (select x.bin, x.seq x, y.seq y from c x join c y on x.bin = y.bin and x.marker = y.marker and x.id < y.id),
h as (select *, [i for i in range(1, length(x) + 1) if substr(x, i, 1) <> '-' and substr(y, i, 1) <> '-'] held from p),
m as (select bin, x, y, [i for i in range(list_min(held), list_max(held) + 1) if substr(x, i, 1) <> '-' or substr(y, i, 1) <> '-'] met from h),
f as (select bin, len([i for i in met if substr(x, i, 1) = substr(y, i, 1)]) * 1.0 / len(met) identity from m)
select bin, count(*) pairs, count(*) filter (where identity > 0.5) as close, round(count(*) filter (where identity > 0.5) * 100.0 / count(*), 4) heterogeneity from f group by 1""")
def strain_heterogeneity(spark, d):
    rows = table(spark, d, "lineitem")
    seq = F.concat(F.lpad(F.col("l_partkey").cast("string"), 9, "-"), F.lit("-"), F.lpad(F.col("l_suppkey").cast("string"), 7, "-"))
    copies = rows.select(F.col("l_orderkey").alias("bin"), F.col("l_returnflag").alias("marker"), F.col("l_linenumber").alias("id"), seq.alias("seq"))
    return rounded(variation.strain_heterogeneity(copies, 0.5))


_BRIDGES = "e as (select doc_id gene, text, unnest(range(3, length(text) - 1, 3)) i from documents), p as (select gene, upper(substr(text, i, 2)) pair from e)"


@sql(f"with {_BRIDGES} select gene, pair, count(*) n from p where regexp_matches(pair, '^[ACGT]{{2}}$') group by 1, 2")
def bridging_pairs(spark, d):
    pairs = variation.bridging_pairs(table(spark, d, "documents").select(F.lit(0).alias("genome"), F.col("doc_id").alias("gene"), F.col("text").alias("seq")))
    return rounded(pairs.unpivot(["gene"], variation.PAIRS, "pair", "n").filter("n > 0"))


@sql(None)
def hotelling_outliers(spark, d):
    """Documents of a language as genes of a genome; the matrix is inverted in numpy, so SQL has no such query."""
    genes = table(spark, d, "documents").select(F.col("lang").alias("genome"), F.col("doc_id").alias("gene"), F.col("text").alias("seq"))
    return rounded(variation.hotelling(variation.bridging_pairs(genes)))

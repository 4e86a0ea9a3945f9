"""Top-N, variability and length statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxalith.operators.abundance import with_totals


def most_abundant(long: DataFrame, n: int = 0, others: bool = True, ignore: tuple[str, ...] = (), rescale: bool = False, items: tuple[str, ...] = (), extra: tuple[str, ...] = ()) -> DataFrame:
    """feature, sample, value of the n features of largest sum; the rest summed as ``Other``; optionally in per cent.

    ignore: features that are left out before anything else. items: these features instead of the n largest. extra: these
    besides them, if they are there.
    """
    long = long.filter(~F.col("feature").isin(*ignore)) if ignore else long
    if items:
        top = long.select("feature").distinct().filter(F.col("feature").isin(*items))
    else:
        top = long.groupBy("feature").agg(F.sum("value").alias("s")).orderBy(F.desc("s"), "feature").limit(n).select("feature")
    if extra:
        top = top.unionByName(long.select("feature").filter(F.col("feature").isin(*extra))).distinct()
    marked = long.join(top.withColumn("top", F.lit(1)), "feature", "left")
    marked = marked if others else marked.filter("top = 1")
    out = marked.groupBy(F.when(F.col("top") == 1, F.col("feature")).otherwise("Other").alias("feature"), "sample").agg(F.sum("value").alias("value"))
    if rescale:
        out = with_totals(out, _total="value").select("feature", "sample", F.try_divide(F.col("value") * 100.0, F.col("_total")).alias("value"))
    return out


def l_count(lengths: DataFrame, percent: float) -> DataFrame:
    """grp and how many of its longest sequences reach percent of the total length (L50 for 50)."""
    counts = lengths.groupBy("grp", "length").agg(F.count("*").alias("many"))
    run = Window.partitionBy("grp").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    bases = F.col("many") * F.col("length")
    marked = counts.withColumns({"before": F.coalesce(F.sum(bases).over(run), F.lit(0)), "longer": F.coalesce(F.sum("many").over(run), F.lit(0)), "total": F.sum(bases).over(Window.partitionBy("grp"))})
    goal = F.col("total") * percent / 100
    reached = marked.filter((F.col("before") < goal) & (F.col("before") + bases >= goal))
    return reached.select("grp", (F.col("longer") + F.ceil((goal - F.col("before")) / F.col("length"))).cast("long").alias("l_count"))


def most_similar(pairs: DataFrame, value: str, largest: bool = True) -> DataFrame:
    """The pair (a, b) of greatest, or else least, value; ties go to the smaller names."""
    return pairs.orderBy(F.desc(value) if largest else F.asc(value), "a", "b").limit(1)


def most_variable(long: DataFrame, n: int) -> DataFrame:
    """The n features of largest coefficient of variation over samples."""
    cv = F.try_divide(F.stddev_samp("value"), F.avg("value"))
    return long.groupBy("feature").agg(cv.alias("cv")).filter("cv is not null").orderBy(F.desc("cv"), "feature").limit(n)


def n_percent(lengths: DataFrame, percent: float, strict: bool = False) -> DataFrame:
    """grp and the length at which the running sum of lengths, longest first, reaches percent of the total.

    Lengths are counted first, so the window runs over distinct lengths.
    """
    counts = lengths.groupBy("grp", "length").agg((F.count("*") * F.col("length")).alias("bases"))
    run = Window.partitionBy("grp").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    marked = counts.withColumns({"upto": F.sum("bases").over(run), "total": F.sum("bases").over(Window.partitionBy("grp"))})
    reached = F.col("upto") > F.col("total") * percent / 100 if strict else F.col("upto") >= F.col("total") * percent / 100
    return marked.filter(reached).groupBy("grp").agg(F.max("length").alias("n_length"))


def dominant(long: DataFrame, ignore: tuple[str, ...]) -> DataFrame:
    """The feature of largest value in each sample, sentinels aside; ties go to the smaller name."""
    best = F.min(F.struct((-F.col("value")).alias("k"), F.col("feature")))
    return long.filter(~F.col("feature").isin(*ignore)).groupBy("sample").agg(best.alias("w")).select("sample", F.col("w.feature").alias("feature"), (-F.col("w.k")).alias("value"))


def log2_change(long: DataFrame, first: list[str], second: list[str]) -> DataFrame:
    """log2 of the second group's median over the first one's, null where either is 0."""
    med = lambda g: F.median(F.when(F.col("sample").isin(*g), F.col("value")))
    both = long.groupBy("feature").agg(med(first).alias("x"), med(second).alias("y"))
    return both.select("feature", F.when((F.col("x") > 0) & (F.col("y") > 0), F.log2(F.col("y") / F.col("x"))).alias("log2fc"))


def row_stats(long: DataFrame) -> DataFrame:
    return long.groupBy("feature").agg(F.min("value").alias("least"), F.max("value").alias("most"), F.median("value").alias("middle"))

"""Line dedup: MinHash signatures of character shingles, banding, exact Jaccard verification, distributed union-find.

All of it is DataFrame functions. A line, lower-cased and without white space at its ends, is the set of its shingles of
``WIDTH`` characters that start at every character, whatever its length and words; a shorter line is one shingle. The
signature is one-permutation MinHash: the space of the shingles' 64-bit hashes is cut into bins and a band is the up to
``ROWS`` least hashes of one bin, so bands agree with probability J**ROWS; lines of few shingles have two wide bins besides.
Bands of fewer than two hashes are left out unless the line has hardly any shingles.

Equal lines are one class. Candidates are pairs of classes that share a band: first each band's lines with two leaders, one
of them chosen anew in every band; then, in bands that still hold several components, with a leader that many bands have in
common, and last all pairs whose components still differ. So large groups cost no pairs of their members, and a pair leaves
the last joins once for all its bands at a leader, and only if sizes and parities allow the similarity. A candidate is a link
if the Jaccard similarity of the whole sets, computed again from the lines, is ``PERCENT`` or more. One line of each component
stays: the one of the smallest (doc_id, line number). Blank lines are neither compared nor dropped; null and empty texts have
one blank line. Rows of the same id and text are one document, whose lines stay or go in all of its rows. A null id counts as
the largest. Very long lines are compared whole. An empty table gives no rows. Lines whose 64-bit class another line has too,
as a second hash tells, are left as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import fresh, staged, table, text_of, unstage
from taxalith.llm.graph import components

WIDTH, BINS, ROWS, FEW, WORDS, PERCENT, HELD = 12, 3, 3, 24, 16, 80, 500_000
#: The least hash of every bin.
EDGES = [i << 64 - BINS for i in range(-(1 << BINS - 1), 1 << BINS - 1)]
BLANK = " \t\r\x0b\x0c"


def shingles(line: Column) -> Column:
    """Hashes of a line's shingles at every character, repeats included; a line too short for any is one shingle.

    Characters are four bytes each, so a shingle is cut out without counting from the line's start. The array of one holds
    the coded line, which would be coded anew for every shingle otherwise.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length(line) - WIDTH, F.lit(0)) * 4 + 1, F.lit(4))
    coded = F.array(F.encode(line, "UTF-32"))
    return F.transform(coded, lambda c: F.transform(starts, lambda i: F.xxhash64(F.substring(c, i, F.lit(4 * WIDTH)))))[0]


def banded(lines: DataFrame, hashes: Column, n: Column) -> DataFrame:
    """lines with keys: their bands' keys, null where there is no band. n: the number of shingles.

    The sort, the search for the edges and the bins' least hashes are compiled: within a lambda, each slice would box all hashes
    of the line. Lambdas only handle what few lines have, and keep the keys out of one method too long to be compiled.
    """
    edges = F.array(*map(F.lit, EDGES))
    out = lines.select("*", n.alias("_n"), F.sort_array(F.concat(hashes, edges)).alias("_m"))
    places = [F.array_position("_m", F.lit(e)).cast("int").alias(f"_p{i}") for i, e in enumerate(EDGES)]
    out = out.select("*", *places, (F.size("_m") + 1).alias(f"_p{len(EDGES)}"))

    def between(begin: int, end: int, most: int | None = None) -> Column:
        size = F.col(f"_p{end}") - F.col(f"_p{begin}") - 1
        return F.slice("_m", F.col(f"_p{begin}") + 1, F.least(size, F.lit(most)) if most else size)

    out = out.select("*", *(between(i, i + 1, ROWS).alias(f"_s{i}") for i in range(len(EDGES))))

    def key(bins: int, i: int, least: Column) -> Column:
        return F.when((F.size(least) > 1) | (F.col("_n") < 4) & (F.size(least) > 0), F.xxhash64(F.lit(bins), F.lit(i), least))

    def fine(i: int) -> Column:
        """The ROWS least distinct hashes; all of a bin are looked at only where they repeat."""
        some, whole = F.col(f"_s{i}"), F.slice(F.array_distinct(between(i, i + 1)), 1, ROWS)
        repeats = reduce(Column.__or__, (F.coalesce(F.get(some, F.lit(j)) == F.get(some, F.lit(j + 1)), F.lit(False)) for j in range(ROWS - 1)))
        return F.when(repeats, key(BINS, i, whole)).otherwise(key(BINS, i, some))

    def wide(g: int) -> Column:
        half = len(EDGES) // 2
        return key(1, g, F.slice(F.array_except(between(g * half, (g + 1) * half), edges), 1, ROWS))

    each = F.array(*map(fine, range(len(EDGES))))
    more = F.transform(F.array(wide(0), wide(1)), lambda x: x)
    return out.select(*lines.columns, F.when(F.col("_n") <= FEW, F.concat(each, more)).otherwise(each).alias("keys"))


PARITIES = [f"p{i}" for i in range(WORDS)]


def with_parities(texts: DataFrame) -> DataFrame:
    """h, n (distinct shingles) and the parities of each line: bits that tell on which places an odd number of shingles fall.

    Each shingle that only one of two sets holds flips one bit, so the sets differ in no fewer shingles than bits. A word's bits
    come of the hashes of one range, cut out of the sorted ones in compiled steps; exploded hashes would each be a row.
    """
    edges = [i << 60 for i in range(1 - WORDS // 2, WORDS // 2)]
    out = texts.select("h", F.array_distinct(shingles(F.col("line"))).alias("_x"))
    out = out.select("h", F.size("_x").cast("long").alias("n"), F.sort_array(F.concat("_x", F.array(*map(F.lit, edges)))).alias("_m"))
    places = [F.lit(0), *(F.array_position("_m", F.lit(e)).cast("int") for e in edges), F.size("_m") + 1]
    out = out.select("h", "n", "_m", *(x.alias(f"_p{i}") for i, x in enumerate(places)))
    out = out.select("h", "n", *(F.slice("_m", F.col(f"_p{i}") + 1, F.col(f"_p{i + 1}") - F.col(f"_p{i}") - 1).alias(c) for i, c in enumerate(PARITIES)))

    def flipped(bits: Column, x: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int")))

    return out.select("h", "n", *(F.aggregate(c, F.lit(0).cast("long"), flipped).alias(c) for c in PARITIES))


def _stripped(line: Column) -> Column:
    """line without BLANK at its ends. Spark goes over all of a line to strip its right end, so only where there is something."""
    blank = reduce(Column.__or__, (F.endswith(line, F.lit(c)) for c in BLANK))
    return F.when(blank, F.btrim(line, F.lit(BLANK))).otherwise(F.ltrim(line, F.lit(BLANK)))


def split_lines(documents: DataFrame) -> DataFrame:
    """doc, doc_id, line_no, line (normalised), n_chars, h (its class) and h2 (a second hash); blank lines are left out."""
    rows = documents.select(text_of(documents).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    # hashed in a step of its own: beside the generator it would be done above it, for each line over its whole document
    rows = rows.select(F.xxhash64("text").alias("doc"), "doc_id", "text")
    rows = rows.select("doc", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    line = rows.filter(F.ltrim("raw", F.lit(BLANK)) != "").withColumn("line", F.lower(_stripped(F.col("raw")))).drop("raw")
    return line.withColumns({"n_chars": F.length("line").cast("long"), "h": F.xxhash64("line"), "h2": F.hash("line")})


def signatures(lines: DataFrame) -> DataFrame:
    """Lines with their band keys."""
    return banded(lines, shingles(F.col("line")), F.greatest(F.col("n_chars") - WIDTH + 1, F.lit(1)))


def _may_link(percent: int) -> Column:
    """Whether sizes and parities, one set's and the other's with b_ before, allow the similarity. Never false for links."""
    a, b = F.col("n"), F.col("b_n")
    flipped = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"b_{c}"))) for c in PARITIES), F.lit(0))
    return (a * 100 >= b * percent) & (b * 100 >= a * percent) & (flipped * (100 + percent) <= (a + b) * (100 - percent))


def _sizes() -> Column:
    return (F.col("n") + F.col("b_n")).alias("sizes")


def _hold(df: DataFrame) -> DataFrame:
    """Broadcasts a staged table of at most HELD rows of numbers."""
    return F.broadcast(df) if df.count() <= HELD else df


def class_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """h and line of the wanted classes."""
    return lines.select("h", "line").join(_hold(wanted), "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose lines' sets are similar enough; pairs: a, b and the sum of their numbers of distinct shingles, texts: h and line.

    The sets' common part is one compiled expression, which leaves repeats out.
    """
    left = texts.select(F.col("h").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("h").alias("b"), F.col("line").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect(shingles(F.col("x")), shingles(F.col("y"))))
    return both.filter(common.cast("long") * (100 + percent) >= F.col("sizes") * percent).select("a", "b")


def _pairs(*pairs: DataFrame) -> DataFrame:
    each = [p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *p.columns[2:]) for p in pairs]
    return reduce(DataFrame.unionByName, each).distinct()


def line_links(lines: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between classes of staged lines, enough of them to join every component."""
    keyed = lines.select("h", F.explode("keys").alias("key")).filter("key is not null")
    shared = keyed.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.min(F.col("h").bitwiseXOR(F.col("key"))).alias("alt"))
    shared = staged(shared.filter("lo < hi").select("key", "lo", F.col("alt").bitwiseXOR(F.col("key")).alias("any")))
    postings = staged(keyed.join(_hold(shared), "key").distinct())
    unstage(shared)
    texts = staged(class_lines(lines, staged(postings.select("h").distinct())))
    sized = staged(with_parities(texts))
    pairs = _pairs(*(postings.filter(f"h != {x}").select(F.col("h").alias("a"), F.col(x).alias("b")) for x in ("lo", "any")))
    left = sized.withColumnRenamed("h", "a")
    right = sized.select(F.col("h").alias("b"), *(F.col(c).alias(f"b_{c}") for c in ("n", *PARITIES)))
    pairs = pairs.join(left, "a").join(right, "b").filter(_may_link(percent)).select("a", "b", _sizes())
    links = staged(verified(pairs, texts, percent))
    return across(postings.select("key", "h"), links, texts, sized, percent)


def across(postings: DataFrame, links: DataFrame, texts: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """links with those between components, from bands that hold several of them.

    Each such band goes to the least (by hash) of its lines, and a line's bands that go to the same one stay together in one
    row. Lines meet there: first all with that one, which joins most of a group, then all pairs whose components differ.
    """
    rooted = postings.join(components(links), F.col("h") == F.col("node"), "left").select("key", "h", F.coalesce("root", "h").alias("root"))
    bounds = (F.min("root").alias("x"), F.max("root").alias("y"), F.min(F.xxhash64("h")).alias("at"))
    many = rooted.groupBy("key").agg(*bounds).filter("x < y").select("key", "at")
    own = staged(rooted.join(many, "key").groupBy("at", "h").agg(F.collect_list("key").alias("own")).join(sized, "h"))

    def met(named: DataFrame, others: DataFrame, apart: Column) -> DataFrame:
        others = others.select("at", F.col("h").alias("b"), F.col("root").alias("other"), *(F.col(c).alias(f"b_{c}") for c in ("own", "n", *PARITIES)))
        found = named.join(others, "at").filter(apart & _may_link(percent) & F.arrays_overlap("own", "b_own"))
        return _pairs(found.select(F.col("h").alias("a"), "b", _sizes()))

    def named(links: DataFrame) -> DataFrame:
        return own.join(components(links), F.col("h") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "h"))

    now = named(links)
    central = now.filter(F.xxhash64("h") == F.col("at"))
    links = links.unionByName(staged(verified(met(now, central, F.col("root") != F.col("other")), texts, percent)))
    now = named(links)
    return links.unionByName(staged(verified(met(now, now, F.col("root") < F.col("other")), texts, percent)))


def line_classes(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc, doc_id, line_no, n_chars, kept_doc_id, kept_line_no, keep of every line that isn't blank."""
    lines = staged(signatures(split_lines(documents)))
    roots = staged(components(line_links(lines, percent)))
    classes = lines.groupBy("h").agg(F.count("*").alias("many"), F.min("h2").alias("x"), F.max("h2").alias("y")).filter("x = y")
    classes = staged(classes.join(roots, F.col("h") == F.col("node"), "left").filter("root is not null or many > 1").select("h", "root"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no", "doc")
    first = lines.select("h", place.alias("first")).join(_hold(classes), "h").groupBy("h", "root").agg(F.min("first").alias("first"))
    first = staged(first)
    least = staged(first.filter("root is not null").groupBy("root").agg(F.min("first").alias("kept")))
    kept = staged(first.join(_hold(least), "root", "left").select("h", F.coalesce("kept", "first").alias("kept")))
    out = lines.select("doc", "doc_id", "line_no", "n_chars", "h").join(_hold(kept), "h", "left")
    own = (F.col("kept.doc") == F.col("doc")) & F.col("kept.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("kept.line_no") == F.col("line_no"))
    ids = F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("kept.doc_id"))
    numbers = F.coalesce("kept.line_no", "line_no")
    return out.select("doc", "doc_id", "line_no", "n_chars", ids.alias("kept_doc_id"), numbers.alias("kept_line_no"), (F.col("kept").isNull() | own).alias("keep"))


def without_repeats(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """documents without the lines that don't stay; those that lose all their lines go, blank documents stay.

    n_chars follows the text where there is such a column. All columns are kept, whatever their names.
    """
    ident, doc, gone = fresh(documents, "ident", "doc", "gone")
    out = line_classes(documents.select("doc_id", "text"), percent).filter("not keep")
    out = out.groupBy(F.col("doc_id").alias(ident), F.col("doc").alias(doc)).agg(F.collect_set("line_no").alias(gone))
    same = documents["doc_id"].cast("long").eqNullSafe(out[ident]) & (F.xxhash64(text_of(documents)) == out[doc])
    out = documents.join(out, same, "left")
    left = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(gone, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    out = out.withColumn("text", text).filter(F.col(gone).isNull() | (F.btrim("text", F.lit(BLANK + "\n")) != ""))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)


def document_lines(spark, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("doc")

"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Documents of one set are one class; classes are
joined. Two sets with Jaccard similarity t or more share at least ceil(t n) of each one's n elements, so under any common
order of elements their prefixes of n - ceil(t n) + l elements share l or more. That is used twice:

* screen: in the order of the hashes, with l a twentieth of the set, a class stays only if l of its prefix's elements occur
  in another class too (counted over all classes by ``exchange``);
* join: in the order of how many remaining classes hold an element, rarest first, each class takes the l for which the
  estimated cost is least: the postings its prefix meets, and the candidates that meet it l times, each to be verified.

Candidates are verified exactly, then linked and joined into components by distributed union-find. So that a large group of
copies costs no pairs of its members, candidates first come from stars: each element's postings meet one leader, chosen
anew in every of ``STARS`` rounds. Then all candidate pairs whose components still differ are verified, so no link that could
change a component is lost. The join of those bounds pairs by parities too: bits that tell on which places an odd number of a
set's elements fall, of which two sets differ in no more than in elements. No element, group or list of candidates is capped.

Null texts, empty ones and rows without an id: no shingles or links; their component is their own id. Fewer than five words
are one shingle. Repeated rows are in one class, and ties go to the smaller id. Very long texts are compared whole. An empty
table gives no rows. Words are split at ASCII white space after lower-casing A-Z.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, bounded, columns, fresh, large_given_back, release, slices, staged, table, text_of, unstage
from taxalith.llm.exchange import REQUESTS, answered, by_batch, part_bits, planes, requests, totals_of, unplanes
from taxalith.llm.graph import components

WIDTH, PERCENT, STARS, CACHE, HELD = 5, 80, 2, 200_000, 1_000_000
MIX, FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Shingler:
    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def word(self, w: bytes) -> int:
        got = self.known.get(w)
        if got is None:
            bounded(self.known, CACHE)
            got = self.known[w] = xxhash.xxh3_64_intdigest(w)
        return got

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        try:
            codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            codes = np.fromiter(map(self.word, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            mixed = (mixed ^ codes[i : len(words) - width + 1 + i]) * MIX
            mixed ^= mixed >> np.uint64(31)
        return np.unique(mixed * FOLD)


def needed(n, percent: int = PERCENT):
    """How many of a set's n elements any linked set shares."""
    return -(-n * percent // 100)


SETS = "doc_id long, key long, n long, node long, prefix binary, l int"
#: Words of 64 bits, each bit the parity of how many elements fall on it.
WORDS = 4
PARITIES = [f"p{i}" for i in range(WORDS)]
FULL = f"node long, n long, elements binary, {', '.join(f'{p} long' for p in PARITIES)}"


def screened_prefix(elements: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    n = len(elements)
    match = 1 + n // 20
    return elements[: min(n, n - needed(n, percent) + match)], min(match, needed(n, percent))


def class_of(elements: np.ndarray) -> int:
    """A set's 64-bit class, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).astype(np.int64))


def shingle_sets(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, key (of the text), n, node (class), and the screen's prefix; node is null where there are no shingles."""

    def rows(batches):
        shingles = Shingler(width)
        schema = arrow_schema(SETS)
        for ids, keys, texts in columns(batches, "doc_id", "key", "text"):
            out = []
            for ident, key, text in zip(ids, keys, texts):
                got = shingles(text)
                if not len(got):
                    out.append((ident, key, 0, None, b"", 0))
                    continue
                prefix, match = screened_prefix(got, percent)
                out.append((ident, key, len(got), class_of(got), planes(prefix), match))
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in out] for i, n in enumerate(schema.names)}, schema=schema)
        shingles.known.clear()
        release()

    return documents.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(rows, SETS)


def parities(elements: np.ndarray) -> list[int]:
    """The WORDS numbers whose bits tell on which places an odd number of elements fall.

    Each element that only one of two sets holds flips one bit, so the sets differ in no fewer elements than bits.
    """
    odd = np.bincount((elements & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def full_sets(documents: DataFrame, width: int) -> DataFrame:
    def rows(batches):
        shingles = Shingler(width)
        schema = arrow_schema(FULL)
        for ids, texts in columns(batches, "doc_id", "text"):
            got = [shingles(t) for t in texts]
            values = ([class_of(g) for g in got], [len(g) for g in got], [planes(g) for g in got], *zip(*map(parities, got)))
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, values)), schema=schema)
            del got, values
        shingles.known.clear()
        release()

    return documents.select("doc_id", "text").mapInArrow(rows, FULL)


PACKS = "batch long, nodes array<long>, ns array<long>, ls array<int>, sizes array<int>, elements binary"


def packs(sets: DataFrame, column: str, most: int = 1_000_000) -> DataFrame:
    """Batches of sets of up to about most elements: (node, n, l, elements) rows side by side."""

    def rows(batches):
        import itertools

        from pyspark import TaskContext

        large_given_back()
        number, schema = itertools.count(TaskContext.get().partitionId() << 32), arrow_schema(PACKS)

        def flush():
            values = (next(number), *([r[i] for r in held] for i in range(3)), [len(r[3]) for r in held], planes(np.concatenate([r[3] for r in held])))
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(schema.names, values)}, schema=schema)

        held, size = [], 0
        for nodes, ns, ls, data in columns(batches, "node", "n", "l", column):
            for node, n, match, d in zip(nodes, ns, ls, data):
                held.append((node, n, match, unplanes(d, np.uint64)))
                size += len(held[-1][3])
                if size >= most:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        held.clear()
        release()

    return sets.select("node", "n", "l", column).mapInArrow(rows, PACKS)


def with_totals(packed: DataFrame) -> DataFrame:
    """Packs with, by the place of each element among the pack's sorted distinct ones, in how many sets it occurs."""
    bits = part_bits(packed.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).first().n or 0)

    def ask(batches):
        schema = arrow_schema(REQUESTS)
        large_given_back()
        for batch in slices(batches):
            for number, data in zip(batch.column(0).to_pylist(), batch.column(batch.schema.get_field_index("elements")).to_pylist()):
                asked = requests(number, *np.unique(unplanes(data, np.uint64), return_counts=True), bits)
                yield pa.RecordBatch.from_pydict({n: [r[i] for r in asked] for i, n in enumerate(schema.names)}, schema=schema)
                del asked, data
        release()

    return packed.join(by_batch(answered(packed.mapInArrow(ask, REQUESTS))), "batch")


def unpacked(batches):
    """(nodes, ns, ls, starts, elements, totals) of each pack, totals by element."""
    large_given_back()
    for nodes, ns, ls, sizes, data, replies in columns(batches, "nodes", "ns", "ls", "sizes", "elements", "replies"):
        for row in zip(nodes, ns, ls, sizes, data, replies):
            elements = unplanes(row[4], np.uint64)
            _, place = np.unique(elements, return_inverse=True)
            yield row[0], row[1], row[2], np.concatenate(([0], np.cumsum(row[3]))), elements, totals_of(row[5])[place]


def survivors(packed: DataFrame) -> DataFrame:
    """Nodes of which l prefix elements occur in other sets too."""

    def rows(batches):
        for nodes, _, ls, starts, _, totals in unpacked(batches):
            shared = np.add.reduceat((totals > 1).astype(np.int64), starts[:-1])
            yield pa.RecordBatch.from_pydict({"node": [n for n, s, k in zip(nodes, shared, ls) if s >= k]}, schema=arrow_schema("node long"))

    return with_totals(packed).mapInArrow(rows, "node long")


INDEX = "element long, node long, n long, m long, l int"


def adaptive(n: int, totals: np.ndarray, percent: int) -> tuple[int, int]:
    """l and prefix length of least estimated cost, from the totals in prefix order."""
    base, met = n - needed(n, percent), np.cumsum(np.maximum(totals - 1, 0))
    ls = np.arange(1, max(2, n // 4 + 1))
    ls = ls[ls <= needed(n, percent)]
    lengths = base + ls
    cost = met[lengths - 1] + met[lengths - 1] / ls * n
    best = int(cost.argmin())
    return int(ls[best]), int(lengths[best])


def index(packed: DataFrame, percent: int) -> DataFrame:
    """Postings of every set's adaptive prefix, without elements that no other set holds.

    m: how many of the set's elements another set holds. The overlap with any set is m at most, so sets with less than they
    need drop out, and pairs are bounded by both m.
    """

    def rows(batches):
        schema = arrow_schema(INDEX)
        for nodes, ns, _, starts, elements, totals in unpacked(batches):
            out = []
            for i, (node, n) in enumerate(zip(nodes, ns)):
                own, t = elements[starts[i] : starts[i + 1]], totals[starts[i] : starts[i + 1]].astype(np.int64)
                order = np.lexsort((own, t))
                m = int(np.count_nonzero(t > 1))
                if m < needed(n, percent):
                    continue
                match, length = adaptive(n, t[order], percent)
                at = order[:length]
                at = at[t[at] > 1]
                out.append((own[at].view(np.int64), np.full(len(at), node), np.full(len(at), n), np.full(len(at), m), np.full(len(at), match)))
            yield pa.RecordBatch.from_pydict({name: np.concatenate([r[j] for r in out]) if out else [] for j, name in enumerate(schema.names)}, schema=schema)

    return with_totals(packed).mapInArrow(rows, INDEX)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b) pairs whose sets are similar enough, by counting the intersection."""

    def rows(batches):
        for a, b, left, right in columns(batches, "a", "b", "left", "right"):
            keep = []
            for x, y in zip(left, right):
                x, y = unplanes(x, np.uint64), unplanes(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_pydict({n: [v for v, k in zip(c, keep) if k] for n, c in (("a", a), ("b", b))}, schema=arrow_schema("a long, b long"))

    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(rows, "a long, b long")


def _similar_sizes(n: str, m: str, other_n: str, other_m: str, percent: int):
    """Whether the sizes, and the most that the two sets can share, allow the similarity."""
    a, b = F.col(n), F.col(other_n)
    return (a * 100 >= b * percent) & (b * 100 >= a * percent) & (F.least(m, other_m) * (100 + percent) >= (a + b) * percent)


def _differ_little(n: str, p: list[str], other_n: str, other_p: list[str], percent: int):
    """Whether the parities allow the similarity; never false for sets that are similar enough."""
    flipped = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(p, other_p)), F.lit(0))
    return flipped * (100 + percent) <= (F.col(n) + F.col(other_n)) * (100 - percent)


def stars(postings: DataFrame, seed: int, percent: int) -> DataFrame:
    """Candidates (a, b) of each element's postings with the element's leader.

    For seed 0 that is the set with the smallest share of elements of its own, to which most of a group of copies links.
    """
    own = (F.col("n") - F.col("m")) / F.col("n") if seed == 0 else F.lit(0.0)
    leader = postings.groupBy("element").agg(F.min(F.struct(own.alias("o"), F.xxhash64("node", F.lit(seed)).alias("h"), F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("m").alias("a_m"), F.col("l").alias("a_l"))).alias("x"))
    met = postings.join(leader.select("element", "x.a", "x.a_n", "x.a_m", "x.a_l"), "element").filter((F.col("a") != F.col("node")) & _similar_sizes("n", "m", "a_n", "a_m", percent))
    return met.groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("shared"), F.min(F.least("l", "a_l")).alias("l")).filter("shared >= l").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def across(postings: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates of different components, from elements that several components hold.

    Each such element goes to the least (by hash) of its sets, and a set's elements that go to the same one stay together in
    one row. Sets meet at those, so a pair leaves the join once for all elements it shares there, not once for each of them,
    and only if sizes, shared elements and parities allow the similarity.
    """
    rooted = postings.select("element", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    bounds = (F.min("root").alias("x"), F.max("root").alias("y"), F.min(F.xxhash64("node")).alias("at"))
    many = rooted.groupBy("element").agg(*bounds).filter("x < y").select("element", "at")
    together = rooted.join(many, "element").groupBy("at", "node", "root").agg(F.collect_list("element").alias("own"))
    sized = postings.groupBy("node").agg(*(F.max(c).alias(c) for c in ("n", "m", "l")))
    left = staged(together.join(sized, "node").join(sets.select("node", *PARITIES), "node"))
    theirs = [f"b_{p}" for p in PARITIES]
    right = left.select(
        "at",
        *(F.col(c).alias(f"b_{c}") for c in ("n", "m", "l", "own", *PARITIES)),
        F.col("node").alias("b"),
        F.col("root").alias("other"),
    )
    shared = F.size(F.array_intersect("own", "b_own"))
    may = _similar_sizes("n", "m", "b_n", "b_m", percent) & _differ_little("n", PARITIES, "b_n", theirs, percent)
    met = left.join(right, "at").filter((F.col("root") < F.col("other")) & may & (shared > 0))
    met = met.select(F.col("node").alias("a"), "b", shared.alias("shared"), F.least("l", "b_l").alias("l"))
    return met.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("l").alias("l")).filter("shared >= l").select("a", "b")


def _rows(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, key (hash of the text), n_shingles, component_id and stays (the first row of its component) of every row."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(documents).alias("text"))
    own = staged(shingle_sets(documents, width, percent))
    first = F.min(F.struct("doc_id", "key")).alias("first")
    classes = staged(own.filter("n > 0 and doc_id is not null").groupBy("node").agg(first))
    same = (own["node"] == classes["node"]) & (own["doc_id"] == classes["first.doc_id"]) & (own["key"] == classes["first.key"])
    firsts = own.join(classes, same).select(own["node"], "n", "l", "prefix").dropDuplicates(["node"])
    packed = staged(packs(firsts, "prefix"))
    wanted = staged(survivors(packed).join(classes, "node"))
    unstage(packed)
    ids = wanted.select(F.col("first.doc_id").alias("doc_id")).distinct()
    texts = documents.join(F.broadcast(ids) if wanted.count() <= HELD else ids, "doc_id", "left_semi")
    sets = staged(full_sets(texts, width).join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))
    packed = staged(packs(sets.withColumn("l", F.lit(0)), "elements"))
    postings = staged(index(packed, percent))
    unstage(packed)
    pairs = reduce(DataFrame.unionByName, [stars(postings, seed, percent) for seed in range(STARS)]).distinct()
    links = staged(verified(pairs, sets, percent))
    roots = staged(components(links))
    links = links.unionByName(staged(verified(across(postings, roots, sets, percent), sets, percent)))
    return _with_components(own, classes, staged(components(links)))


def _with_components(own: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the linked classes get the first row of their component, all others that of their class."""
    named = classes.join(roots, "node")
    firsts = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(firsts, "root").select("node", "component")
    ids = classes.join(named, "node", "left").select("node", F.coalesce("component", "first").alias("c"))
    out = own.select("doc_id", "key", "n", "node").join(ids, "node", "left")
    stays = F.col("c").isNull() | F.col("doc_id").isNull() | ((F.col("c.doc_id") == F.col("doc_id")) & (F.col("c.key") == F.col("key")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c.doc_id", "doc_id"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"), stays.alias("stays"))


def linked(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    return _rows(documents, width, percent).select("doc_id", "n_shingles", "component_id")


def joined(spark, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))


def one_of_each(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """documents with one row of each component: that of the least id, then the least hash of the text.

    Rows are told apart by id and text, so two unlike texts of one id are two documents. Of rows that repeat both, one stays.
    Rows without an id stay. All columns are kept, whatever their names.
    """
    rows = staged(_rows(documents, width, percent).filter("doc_id is not null"))
    marks = rows.groupBy("doc_id", "key").agg(F.every("stays").alias("stays"), (F.count("*") > 1).alias("many")).filter("many or not stays")
    marks = staged(marks)
    ident, key, stays, many = fresh(documents, "ident", "key", "stays", "many")
    marks = marks.select(F.col("doc_id").alias(ident), F.col("key").alias(key), F.col("stays").alias(stays), F.col("many").alias(many))
    own = (documents["doc_id"].cast("long") == marks[ident]) & (F.xxhash64(text_of(documents)) == marks[key])
    out = documents.join(F.broadcast(marks) if marks.count() <= HELD else marks, own, "left").filter(F.coalesce(stays, F.lit(True)))
    repeated = F.coalesce(F.col(many), F.lit(False))
    return out.filter(~repeated).select(*documents.columns).unionByName(out.filter(repeated).dropDuplicates([ident, key]).select(*documents.columns))

"""Scalar functions on sequences and alignments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of a sequence are among letters, either case."""
    return F.length(seq) - F.length(F.translate(seq, letters.upper() + letters.lower(), ""))


def gc_percent(seq: Column) -> Column:
    return F.try_divide(count_of(seq, "GC") * 100.0, F.length(seq))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTUacgtu", "TGCAAtgcaa"))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order; none for shorter sequences."""
    return F.when(F.length(seq) >= k, F.transform(F.sequence(F.lit(1), F.length(seq) - (k - 1)), lambda i: F.substring(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def canonical(kmer: Column) -> Column:
    return F.least(kmer, reverse_complement(kmer))


def windows(seq: Column, size: int) -> Column:
    """Consecutive windows; the last one takes the rest."""
    many = F.greatest(F.lit(1), F.floor(F.length(seq) / size).cast("int"))
    return F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.substring(seq, i * size + 1, F.when(i == many - 1, F.length(seq)).otherwise(F.lit(size))))


def masked(seq: Column, start: Column, end: Column) -> Column:
    """N at the 1-based, inclusive places start to end."""
    return F.overlay(seq, F.repeat(F.lit("N"), (end - start + 1).cast("int")), start, end - start + 1)


def reference_end(pos: Column, cigar: Column) -> Column:
    """Where an alignment ends: M, D and N add, I subtracts; clips don't count."""
    def total(op: str) -> Column:
        found = F.regexp_extract_all(cigar, F.lit(rf"(\d+){op}"), 1)
        return F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return pos + total("[MDN=X]") - total("I")


def split_annotation(value: Column) -> Column:
    """Parts of a ``;``-separated annotation, trailing separators ignored."""
    return F.split(F.rtrim(value, F.lit(";")), ";")


def part(seq: Column, start: Column, end: Column, strand: Column | None = None) -> Column:
    """The 1-based, inclusive places start to end; on strand ``-`` their reverse complement."""
    own = F.substring(seq, start, end - start + 1)
    return own if strand is None else F.when(strand == "-", reverse_complement(own)).otherwise(own)


def codons(seq: Column) -> Column:
    """Triplets from the first letter on; what is left at the end doesn't count."""
    many = F.floor(F.length(seq) / 3).cast("int")
    return F.when(many > 0, F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.substring(seq, i * 3 + 1, F.lit(3)))).otherwise(F.array().cast("array<string>"))


def letters(seq: Column) -> Column:
    return F.filter(F.split(seq, ""), lambda x: x != "")


def low_quality(seq: Column, least: int = 0, most: int | None = None, gc: tuple[float, float] = (0.0, 100.0), unknown: float = 100.0) -> Column:
    """Why a read is filtered: ``length``, ``gc`` or ``n`` (per cent of N), the first that holds; null if it stays."""
    size = F.length(seq)
    long = F.lit(False) if most is None else size > most
    bad = F.when((size < least) | long, "length")
    bad = bad.when(~gc_percent(seq).between(*gc), "gc")
    return bad.when(F.try_divide(count_of(seq, "N") * 100.0, size) > unknown, "n")

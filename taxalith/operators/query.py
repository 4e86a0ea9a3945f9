"""A small boolean query language: ``PHYLUM IN [A, B] AND (FUN CONTAINS x OR S1 > 0.5)``."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = ("DOES NOT CONTAIN", "NOT IN", "CONTAINS", "IN", "==", "!=", ">=", "<=", ">", "<")
_TOKEN = re.compile(r"\s*(?:(\()|(\))|(AND|OR)\b|(.+?)(?=\s+(?:AND|OR)\b|\s*[()]|$))", re.S)
_LEAF = re.compile(r"^(.*?)\s*(DOES NOT CONTAIN|NOT IN|CONTAINS|IN\b|==|!=|>=|<=|>|<)\s*(.*)$", re.S)


class QueryError(ValueError):
    pass


@dataclass(frozen=True)
class Leaf:
    subject: str
    operator: str
    value: str | tuple[str, ...]


@dataclass(frozen=True)
class Node:
    operator: str
    children: tuple


def _tokens(text: str) -> list[tuple[str, str]]:
    """Lists in brackets may hold any sign, so they are set aside first."""
    lists: list[str] = []
    text = re.sub(r"\[[^\]]*\]", lambda m: lists.append(m[0]) or f"\0{len(lists) - 1}\0", text)
    out, at = [], 0
    while at < len(text.rstrip()):
        m = _TOKEN.match(text, at)
        if not m or m.end() == at:
            raise QueryError(f"can't read the query at {text[at:]!r}")
        at = m.end()
        kind = "(" if m[1] else ")" if m[2] else "op" if m[3] else "leaf"
        out.append((kind, re.sub("\0(\\d+)\0", lambda x: lists[int(x[1])], m[0].strip())))
    return out


def parse(text: str):
    """The query's tree. AND and OR may not be mixed on one level, parentheses must balance."""
    tokens = _tokens(text)

    def level(at: int, depth: int):
        children, operator = [], None
        while at < len(tokens):
            kind, word = tokens[at]
            if kind == "(":
                child, at = level(at + 1, depth + 1)
                children.append(child)
            elif kind == ")":
                if not depth:
                    raise QueryError("unbalanced parentheses")
                return closed(children, operator), at + 1
            elif kind == "op":
                if operator not in (None, word):
                    raise QueryError("AND and OR are mixed on one level")
                operator, at = word, at + 1
            else:
                children.append(leaf(word))
                at += 1
        if depth:
            raise QueryError("unbalanced parentheses")
        return closed(children, operator), at

    return level(0, 0)[0]


def closed(children: list, operator: str | None):
    if not children or (len(children) > 1) != bool(operator):
        raise QueryError("a condition or an operator is missing")
    return children[0] if len(children) == 1 else Node(operator, tuple(children))


def leaf(text: str) -> Leaf:
    m = _LEAF.match(text)
    if not m or not m[1] or not m[3]:
        raise QueryError(f"unknown operator in {text!r}")
    value = m[3].strip()
    if m[2].strip() in ("IN", "NOT IN"):
        value = tuple(x.strip() for x in value.strip("[]").split(","))
    return Leaf(m[1].strip(), m[2].strip(), value)


def _compare(c: Column, x: Leaf) -> Column:
    tests = {"==": lambda: c == x.value, "!=": lambda: c != x.value, "IN": lambda: c.isin(*x.value), "NOT IN": lambda: ~c.isin(*x.value), "CONTAINS": lambda: c.contains(x.value), "DOES NOT CONTAIN": lambda: ~c.contains(x.value)}
    if x.operator not in tests:
        raise QueryError(f"{x.subject} can't be compared by {x.operator}")
    return tests[x.operator]()


def predicate(tree, taxa: dict[str, str], functions: dict[str, list[str]], samples: dict[str, str]) -> Column:
    """The tree as a column. taxa: subject to a column; functions: subject (FUN, FUNH) to array columns, of which any
    element may match; samples: subject to a numeric column."""
    if isinstance(tree, Node):
        parts = [predicate(c, taxa, functions, samples) for c in tree.children]
        return reduce((lambda a, b: a & b) if tree.operator == "AND" else (lambda a, b: a | b), parts)
    if tree.subject in taxa:
        return F.coalesce(_compare(F.col(taxa[tree.subject]), tree), F.lit(False))
    if tree.subject in functions:
        return reduce(lambda a, b: a | b, [F.coalesce(F.exists(c, lambda v: _compare(v, tree)), F.lit(False)) for c in functions[tree.subject]])
    if tree.subject in samples:
        c = F.col(samples[tree.subject])
        tests = {"==": c.__eq__, "!=": c.__ne__, ">": c.__gt__, "<": c.__lt__, ">=": c.__ge__, "<=": c.__le__}
        if tree.operator not in tests:
            raise QueryError(f"{tree.subject} can't be compared by {tree.operator}")
        return F.coalesce(tests[tree.operator](float(tree.value)), F.lit(False))
    raise QueryError(f"unknown subject {tree.subject}")


def select(df: DataFrame, query: str, **subjects) -> DataFrame:
    return df.filter(predicate(parse(query), subjects.get("taxa", {}), subjects.get("functions", {}), subjects.get("samples", {})))


def subset_by_pattern(df: DataFrame, pattern: str, columns: list[str], ignore_case: bool = True, fixed: bool = False) -> DataFrame:
    """Rows of which any column matches a pattern."""
    test = (lambda c: F.lower(c).contains(pattern.lower()) if ignore_case else F.col(c).contains(pattern)) if fixed else (lambda c: F.col(c).rlike(("(?i)" if ignore_case else "") + pattern))
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(test(c), F.lit(False)) for c in columns]))


def select_entities(df: DataFrame, entity: str, query: str, **subjects) -> DataFrame:
    """Entities that meet a query as sets: each condition holds for an entity if it holds for any of its rows.

    Conditions are told by one grouping, AND and OR then combine them entity by entity, so two conditions of an AND may be met
    by different rows of an entity.
    """
    tree, leaves = parse(query), []

    def flagged(node) -> Column:
        if isinstance(node, Node):
            parts = [flagged(c) for c in node.children]
            return reduce((lambda a, b: a & b) if node.operator == "AND" else (lambda a, b: a | b), parts)
        leaves.append(predicate(node, subjects.get("taxa", {}), subjects.get("functions", {}), subjects.get("samples", {})))
        return F.col(f"_c{len(leaves) - 1}")

    wanted = flagged(tree)
    flags = df.groupBy(entity).agg(*(F.bool_or(test).alias(f"_c{i}") for i, test in enumerate(leaves)))
    return flags.filter(wanted).select(entity)

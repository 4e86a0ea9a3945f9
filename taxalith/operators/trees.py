"""Trees of pairwise distances."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

#: The distance of a joined pair to another cluster, of the pair's own distances to it and its parts' sizes.
METHODS = {
    "single": lambda x, y, n, m: np.minimum(x, y),
    "complete": lambda x, y, n, m: np.maximum(x, y),
    "average": lambda x, y, n, m: (n * x + m * y) / (n + m),
    "weighted": lambda x, y, n, m: (x + y) / 2,
}


def clustered(pairs: DataFrame, method: str = "average", similarity: bool = False, largest: float = 100.0, most: int = 2000) -> str:
    """The Newick tree that joins the two nearest clusters at a time, with branch lengths of two digits.

    pairs (a, b, value): each pair of items once; similarities become largest - value. Ties go to the items first by name. The
    tree is built on the driver, so more than ``most`` items are an error, as is a pair that is missing.
    """
    items = pairs.select("a").union(pairs.select("b")).distinct().limit(most + 1).collect()
    if len(items) > most:
        raise ValueError(f"more than {most} items")
    names = sorted(r[0] for r in items)
    if not names:
        return ";"
    at = {n: i for i, n in enumerate(names)}
    d = np.full((len(names), len(names)), np.nan)
    for a, b, value in pairs.select("a", "b", "value").toLocalIterator():
        d[at[a], at[b]] = d[at[b], at[a]] = largest - value if similarity else value
    np.fill_diagonal(d, np.inf)
    if np.isnan(d).any():
        raise ValueError("a pair of items has no value")
    trees, heights, sizes = [str(n) for n in names], np.zeros(len(names)), np.ones(len(names))
    root = 0
    for _ in range(len(names) - 1):
        i, j = sorted(divmod(int(d.argmin()), len(names)))
        height = d[i, j]
        trees[i] = f"({trees[i]}:{height - heights[i]:.2f},{trees[j]}:{height - heights[j]:.2f})"
        joined = METHODS[method](d[i], d[j], sizes[i], sizes[j])
        d[i], d[:, i] = joined, joined
        d[j], d[:, j], d[i, i] = np.inf, np.inf, np.inf
        heights[i], sizes[i], root = height, sizes[i] + sizes[j], i
    return trees[root] + ";"

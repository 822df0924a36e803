"""Connected components of a link table, and spanning links inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def spanning(a: np.ndarray, b: np.ndarray, n: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a[i], b[i]) between places 0..n-1 those that join parts; ``label`` is updated in place.

    Rounds of hooking the larger label onto the smaller one; a link whose ends share a label is dropped.
    """
    out_a, out_b = [], []
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            break
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        order = np.lexsort((low, high))
        first = np.ones(len(order), bool)
        first[1:] = high[order][1:] != high[order][:-1]
        take = order[first]  # for each larger label one link, to its smallest neighbour
        out_a.append(a[take])
        out_b.append(b[take])
        parent = np.arange(n)
        parent[high[take]] = low[take]
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        label[:] = parent[label]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b): the smallest node that can be reached.

    Alternates large-star and small-star steps; each round's table is written, so it survives lost executors.
    The steps work on minima of neighbours, which are combined before the shuffle; no neighbourhood is gathered.
    """
    spark = links.sparkSession
    e = keep(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("u != v").distinct(), "links")
    for _ in range(rounds):
        # large star: every larger neighbour of u (and u's smaller ones' minimum) is linked to u's minimum
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, both.u == low.k).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # small star: u's smaller neighbours and u are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, large.u == low.k)
        new = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        new = keep(spark, new, "links")
        same = e.count() == new.count() and e.join(new, ["u", "v"], "left_anti").limit(1).count() == 0
        e = new
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # settled: every node points at its root
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

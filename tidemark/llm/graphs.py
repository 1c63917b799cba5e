"""Connected components of a link table, and blocks of pairs for long candidate lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import remove, written


def connected_components(links: DataFrame, max_rounds: int = 60) -> tuple[DataFrame, list[str]]:
    """links (a long, b long) -> (node, component), component the smallest node reachable, one row per node in links.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every round is two groupings by key with
    partial aggregation and two joins; nothing is gathered on the driver but a count and a checksum. Every half round
    is written to the shared folder, so lineage stays short and the minima join by measured size (a hot node's
    links are split by the optimiser, as both sides come from files). Also returns the paths that the caller removes.
    """
    spark = links.sparkSession

    def half(edges: DataFrame, large: bool) -> tuple[DataFrame, list[str]]:
        # Directed copies: towards every neighbour (large) or towards the smaller one only (small).
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least, p1 = written(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        moved = both.join(least, "a")
        if large:
            new = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        out, p2 = written(new.where(F.col("a") != F.col("b")).distinct(), "stars")
        remove(spark, p1)
        return out, [p2]

    edges, paths = written(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    paths, before = [paths], None
    for _ in range(max_rounds):
        for large in (True, False):
            edges, new = half(edges, large)
            remove(spark, *paths)
            paths = new
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.max("a")).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("the components didn't settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), paths


def in_block_pairs(lists: DataFrame, keys: list[str], member: str | list[str], block: int) -> DataFrame:
    """Rows of candidate lists (the rows of equal keys), once for each pair of blocks that they belong to.

    Lists of one row go, having no pairs. Lists up to `block` rows become one block pair (0, 0). Longer ones are split by a
    hash of the member (one column, or several that tell rows apart) into blocks of about that size, and every row is sent to each pair that its block is part of, so any two
    rows of a list meet, and no task has to hold more than two blocks. Adds own, lo and hi (int).
    """
    sizes, _ = written(lists.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    n = F.ceil(F.col("size") / F.lit(block)).cast("int")
    rows = lists.join(sizes, keys).withColumn("blocks", n).withColumn("own", F.pmod(F.xxhash64(*([member] if isinstance(member, str) else member)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("size", "blocks", "other")


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes by the links i-j."""
    root = np.arange(n)
    while len(i):
        # Every entry is a root here, so a hook replaces no earlier one.
        a, b = root[i], root[j]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != (r := root[root])).any():
            root = r
        keep = root[i] != root[j]
        i, j = i[keep], j[keep]
    return root


def runs(keys: list[np.ndarray]) -> np.ndarray:
    """Bounds of the runs of equal keys: 0, starts of later runs, number of rows."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.concatenate(([0], np.flatnonzero(new), [n])) if n else np.zeros(1, int)

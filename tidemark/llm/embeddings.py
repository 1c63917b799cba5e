"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are vectors of a bounded sample. Each vector is described by its nearest pivots in order of cosine,
and entered in the inverted list of each, within its label. Two vectors of a list are candidates if they share
enough of their nearest pivots; candidates are verified by their cosine in double precision. A pair that meets in
several lists is worked in that of its smallest shared pivot only.

Equal vectors are one entry with a count. Long lists are worked in blocks (graphs.in_block_pairs); a block gives
back each vector's number of links and a forest of the links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import q, remove, table, written
from tidemark.llm.graphs import connected_components, forest, in_block_pairs, runs

#: Pivots: the square root of the number of distinct vectors, within these bounds.
PIVOTS, MOST_PIVOTS = 256, 4096
#: Vectors that pivots are chosen from: so many times the pivots, those of least hash.
SAMPLE = 16
#: Nearest pivots that describe a vector, and how many of them candidates share.
NEAREST, SHARED = 12, 3
#: Entries of a block of a long list.
BLOCK = 256


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, n: int, apart: float = 0.95) -> np.ndarray:
    """Up to n rows (as units), in order, of which no two have a cosine of `apart` or more.

    A crowd of near-copies so yields one pivot: with many, which of them are nearest to a member would be chance.
    """
    x, taken = unit(sample), []
    free = np.ones(len(x), bool)
    for i in range(len(x)):
        if free[i] and len(taken) < n:
            taken.append(i)
            free &= x @ x[i] < apart
    return x[taken]


def nearest(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k pivots of largest cosine, nearest first (ties: smaller index)."""
    return np.argsort(-(unit(x) @ pivots.T), axis=1, kind="stable")[:, :k].astype(np.int32)


def usable(v: Column) -> Column:
    """Whether a vector has a direction: no null, no non-finite and not only zero components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def links_in_blocks(batches: Iterator[pa.RecordBatch], shared: int, least: float) -> Iterator[pa.RecordBatch]:
    """Rows of block pairs in order of (label, dim, pivot, lo, hi) -> (a, n) weighted numbers of links and (a, b) of a forest."""
    keys = ("label", "dim", "pivot", "lo", "hi")
    left: pa.Table | None = None

    def work(t: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, weight, own = (t[c].to_numpy() for c in ("node", "n", "own"))
        pivot, lo, hi = (t[c].to_numpy() for c in ("pivot", "lo", "hi"))
        for a, b in zip(bounds, bounds[1:]):
            m, p = b - a, int(pivot[a])
            if m < 2:
                continue
            cut = t.slice(a, m)
            near = np.asarray(cut["nearest"].combine_chunks().flatten()).reshape(m, -1)
            # Shared pivots, and shared pivots below this list's own, by products of 0/1 rows over the pivots that the block has.
            known, place = np.unique(near, return_inverse=True)
            has = np.zeros((m, len(known)), np.float32)
            np.put_along_axis(has, place.reshape(m, -1), 1, axis=1)
            pairs = has @ has.T >= min(shared, near.shape[1])
            if lower := int(np.searchsorted(known, p)):
                pairs &= has[:, :lower] @ has[:, :lower].T == 0
            if lo[a] != hi[a]:
                pairs &= own[a:b, None] != own[None, a:b]
            np.fill_diagonal(pairs, False)
            rows = np.flatnonzero(pairs.any(axis=1))
            if not len(rows):
                continue
            x = unit(np.asarray(cut["vec"].combine_chunks().flatten()).reshape(m, -1)[rows])
            ok = pairs[np.ix_(rows, rows)] & (x @ x.T >= least)
            i, j = np.nonzero(np.triu(ok, 1))
            if not len(i):
                continue
            degree = ok @ weight[a:b][rows]
            some = np.flatnonzero(degree)
            root = forest(len(rows), i, j)
            moved = np.flatnonzero(root != np.arange(len(rows)))
            names = node[a:b][rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([names[some], names[moved]])), pa.array([None] * len(some) + names[root[moved]].tolist(), pa.int64()), pa.array(degree[some].tolist() + [None] * len(moved), pa.int64())],
                names=["a", "b", "n"],
            )

    def bounds_of(t: pa.Table) -> np.ndarray:
        return runs([t[k].to_numpy() for k in keys])

    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([left, t]) if left is not None else t
            bounds = bounds_of(t)
            yield from work(t, bounds[:-1])
            left = t.slice(bounds[-2])
    if left is not None and left.num_rows:
        yield from work(left, bounds_of(left))


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98, pivots: int | None = None, k: int = NEAREST, shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """One row per row of vectors: its id, n_links (long), component_id (long), kept (boolean); the id's column keeps its name.

    Vectors of equal, non-null labels and equal length link at a cosine of `least` or more; n_links counts the other
    vectors (rows) linked directly, component_id is the smallest id reachable, kept says that it is the row's own.
    Null vectors, and those that are zero or empty or hold null or non-finite components, link with nothing, nor do those
    with a null label; they are kept. So is a row with a null id, with a null component_id. Rows of one id and different
    vectors share a component and links. Other columns don't take part, whatever their names. An
    empty table gives an empty result. The index holds every vector; its pivots, MOST_PIVOTS at most, come from a sample of at most 16 times
    their number for each length of vector, and links whose vectors share fewer than `shared` of their nearest pivots are not found (recall, measured: README).
    """
    rows = vectors.select(q(id_col).cast("long").alias("id"), q(vector_col).alias("vec"), q(label_col).cast("long").alias("label"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec"))
    nodes, p0 = written(rows.where(good).groupBy("label", "vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("vec")), "vectors", "zstd")
    links, p1 = _links(nodes, least, pivots, k, shared, block)
    spark = vectors.sparkSession
    # Several vectors of one id hang together by it.
    several = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("c"))
    degrees = links.where("n is not null").groupBy("a").agg(F.sum("n").alias("links"))
    edges = links.where("b is not null").select("a", "b")
    found, p2 = connected_components(edges)
    per_node, p3 = written(several.select("node").join(degrees, F.col("node") == F.col("a"), "left").drop("a").join(found, "node", "left").select("node", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")), "links-by-vector")
    entries = nodes.join(per_node, "node").select(F.col("label").alias("l"), F.col("vec").alias("v"), (F.col("links") + F.col("n") - 1).alias("links"), "component")
    known = rows.withColumn("good", good)
    out = known.join(entries, F.col("good") & (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    out, _ = written(out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept")), "near-vectors")
    remove(spark, p0, p1, *p2, p3)
    return out


def _links(nodes: DataFrame, least: float, pivots: int | None, k: int, shared: int, block: int) -> tuple[DataFrame, str]:
    spark = nodes.sparkSession
    n = pivots or min(MOST_PIVOTS, max(PIVOTS, math.isqrt(nodes.count())))
    by_dim: dict[int, np.ndarray] = {}
    for d in [r.dim for r in nodes.select("dim").distinct().collect()]:
        sample = nodes.where(F.col("dim") == d).orderBy(F.xxhash64("node"), "node").limit(SAMPLE * n).select("vec").toArrow()
        by_dim[d] = choose_pivots(np.asarray(sample["vec"].combine_chunks().flatten()).reshape(-1, d), n)
    sent = spark.sparkContext.broadcast(by_dim)  # n pivots for each length of vector

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            dims = whole.column(whole.schema.get_field_index("dim")).to_numpy()
            for d in np.unique(dims):
                b = pa.Table.from_batches([whole]).take(np.flatnonzero(dims == d))
                for lo in range(0, b.num_rows, 1024):
                    part = b.slice(lo, 1024).combine_chunks()
                    near = nearest(np.asarray(part["vec"].combine_chunks().flatten()).reshape(part.num_rows, -1), sent.value[d], k)
                    rep = part.take(np.repeat(np.arange(part.num_rows), near.shape[1]))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size * near.shape[1] + 1, near.shape[1], dtype=np.int32)), pa.array(np.repeat(near, near.shape[1], axis=0).ravel()))
                    rep = rep.append_column("pivot", pa.array(near.ravel())).append_column("nearest", lists)
                    yield from rep.select(["label", "dim", "pivot", "node", "n", "nearest", "vec"]).combine_chunks().to_batches()

    kind = nodes.schema["vec"].dataType.simpleString()
    lists = nodes.select("label", "vec", "node", "n", "dim").mapInArrow(entered, f"label long, dim int, pivot int, node long, n long, nearest array<int>, vec {kind}")
    lists, p = written(lists, "pivot-lists", "zstd")
    order = ["label", "dim", "pivot", "lo", "hi"]
    pairs = in_block_pairs(lists, order[:3], ["node", "vec"], block).select(*order, "own", "node", "n", "nearest", "vec")
    pairs = pairs.repartition(*order).sortWithinPartitions(*order)
    links, path = written(pairs.mapInArrow(lambda it: links_in_blocks(it, shared, least), "a long, b long, n long"), "vector-links")
    remove(spark, p)
    return links, path


def op1_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id and kept of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))

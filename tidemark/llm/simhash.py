"""SimHash near-duplicates by pivot distance tables.

Reference fingerprints are fixed 64-bit words. The table of a fingerprint holds its Hamming distances to every
reference, taken over each of five segments of the 64 bits (a reference's whole distance is the sum of its five). By
the triangle inequality two fingerprints that differ in d bits of a segment have coordinates there that differ by d at
most. So, for links at 3 bits or fewer:

- at most three segments hold a difference, hence in at least two of the five every coordinate is equal: fingerprints
  are listed under the coordinates of each of the ten pairs of segments, and every link falls into a list (exact, no cap);
- within a list, a pair is discarded when the largest coordinate difference of the segments, summed, is over 3;
- survivors are verified on the fingerprints themselves.

Equal fingerprints are one entry before any list is made. Long lists are worked in blocks (graphs.in_block_pairs), and a
block gives back a forest of its links, not its pairs.

wide_pairs searches farther with the same tables, for pairs that are verified on more than their fingerprints: eight segments, two of
which agree, find all pairs of 6 bits and most up to REACH (12).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, q, remove, table, unused, without, written
from tidemark.llm.graphs import connected_components, forest, in_block_pairs, runs

#: Bits of the five segments, from the lowest.
SEGMENTS = (13, 13, 13, 13, 12)
#: Reference fingerprints.
REFERENCES = 16
#: Entries of a block of a long list: a task holds two at a time.
BLOCK = 128
#: Wide searches: bits of the segments, those that have to agree, bits apart at most, and entries of a block.
WIDE, AGREE, REACH, WIDE_BLOCK = (8,) * 8, 2, 12, 512


def masks(segments: tuple[int, ...] = SEGMENTS) -> list[int]:
    at, out = 0, []
    for n in segments:
        out.append(((1 << n) - 1) << at)
        at += n
    return out


def references(n: int = REFERENCES) -> list[int]:
    """n fixed reference fingerprints."""
    return [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 2**32 + 9) for i in range(n)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the XXH64 values (seed 42) of all `width`-word shingles of the whole text: a bit is 1 if set in over half of them."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return fingerprint_of(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(words) - width + 1))


def fingerprint_of(h: np.ndarray) -> int:
    """SimHash of 64-bit hashes: a bit is 1 if set in over half of them."""
    set_bits = np.zeros(64, np.int64)
    for lo in range(0, len(h), 65536):
        bits = np.unpackbits(h[lo : lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits((set_bits * 2 > len(h)).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, out: str, *, text_col: str = "text", width: int = 3, keep: list[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep) and `out`, the fingerprint as a signed long. Null and wordless texts have zero."""
    bounded_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    source = docs.select(*[q(c) for c in keep], *([] if text_col in keep else [q(text_col)]))
    at = source.columns.index(text_col)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [signed(fingerprint(t.as_py(), width)) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fps, pa.int64())], names=[*keep, out])

    return source.mapInArrow(of, T.StructType([*[source.schema[c] for c in keep], T.StructField(out, T.LongType())]))


def coordinates(fp: np.ndarray, segments: tuple[int, ...] = SEGMENTS) -> np.ndarray:
    """The pivot table of fingerprints: (n, segments, references)."""
    r = np.array(references(), np.uint64)
    return np.stack([np.bitwise_count((fp[:, None] ^ r) & np.uint64(m)) for m in masks(segments)], axis=1).astype(np.int8)


def listed(fps: DataFrame) -> DataFrame:
    """fps (node, fp) under the ten lists of each: (pair, at, node, fp), `at` the hash of the pivot coordinates of two segments."""
    seg = [[F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(r))).bitwiseAND(F.lit(signed(m)))) for r in references()] for m in masks()]
    lists = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("pair"), F.xxhash64(*seg[a], *seg[b]).alias("at")) for i, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2))])
    return fps.select("node", "fp", F.explode(lists).alias("x")).select("x.pair", "x.at", "node", "fp")


def links_in_blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (pair, at, lo, hi, own, node, fp) in order of the first four -> a forest (a, b) of the links of each block pair."""
    names = ("pair", "at", "lo", "hi", "own", "node", "fp")
    left: list[np.ndarray] | None = None

    def work(x: list[np.ndarray]) -> pa.RecordBatch:
        bounds = runs(x[:4])
        run = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        fp, own, cross = x[6].view(np.uint64), x[4], x[2] != x[3]
        table_ = coordinates(fp)
        found_i, found_j = [], []
        live = np.arange(len(fp))
        for d in range(1, int(np.diff(bounds).max(initial=0))):
            live = live[live + d < len(fp)]
            live = live[run[live] == run[live + d]]
            i, j = live, live + d
            ok = ~cross[i] | (own[i] != own[j])
            i, j = i[ok], j[ok]
            for lo in range(0, len(i), 1 << 15):
                a, b = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
                near = np.abs(table_[a] - table_[b]).max(axis=2).sum(axis=1) <= bits
                a, b = a[near], b[near]
                true = np.bitwise_count(fp[a] ^ fp[b]) <= bits
                found_i.append(a[true])
                found_j.append(b[true])
        i = np.concatenate(found_i) if found_i else np.zeros(0, int)
        j = np.concatenate(found_j) if found_j else np.zeros(0, int)
        root = forest(len(fp), i, j)
        moved = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(x[5][moved]), pa.array(x[5][root[moved]])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        x = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if left is not None:
            x = [np.concatenate(p) for p in zip(left, x)]
        cut = runs(x[:4])[-2]
        left = [c[cut:] for c in x]
        if cut:
            yield work([c[:cut] for c in x])
    if left is not None and len(left[0]):
        yield work(left)


def wide_lists(fps: DataFrame) -> DataFrame:
    """fps (row, fp, size) under the lists of each: (pair, at, row, fp, total), `at` the hash of the pivot coordinates of AGREE of the wide segments, total the size."""
    seg = [F.xxhash64(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(r))).bitwiseAND(F.lit(signed(m)))) for r in references()]) for m in masks(WIDE)]
    known = fps.select("row", "fp", "size", *[s.alias(f"s{i}") for i, s in enumerate(seg)])
    lists = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("pair"), F.xxhash64(*[f"s{k}" for k in some]).alias("at")) for i, some in enumerate(combinations(range(len(WIDE)), AGREE))])
    return known.select("row", "fp", "size", F.explode(lists).alias("x")).select("x.pair", "x.at", "row", "fp", F.col("size").alias("total"))


def spanning(n: int, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Places of those of the links i-j of n nodes that span what hangs together, the nearest first."""
    root, picked = np.arange(n), [np.zeros(0, int)]
    for d in np.unique(far):
        at = np.flatnonzero(far == d)
        while len(at := at[root[i[at]] != root[j[at]]]):
            a, b = root[i[at]], root[j[at]]
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            np.minimum.at(root, hi, lo)
            hooks = np.flatnonzero(root[hi] == lo)
            picked.append(at[hooks[np.unique(hi[hooks], return_index=True)[1]]])
            while (root != (r := root[root])).any():
                root = r
    return np.concatenate(picked)


def near_in_blocks(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    """Rows (pair, at, lo, hi, own, row, fp, total) in order of the first four -> (a, b), pairs that span those REACH or fewer bits apart and of sizes not too far apart."""
    names = ("pair", "at", "lo", "hi", "own", "row", "fp", "total")
    left: list[np.ndarray] | None = None

    def work(x: list[np.ndarray]) -> pa.RecordBatch:
        bounds = runs(x[:4])
        run = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        own, fp, size, cross = x[4], x[6].view(np.uint64), x[7].astype(np.int64), x[2] != x[3]
        table_ = coordinates(fp, WIDE)
        found_i, found_j = [np.zeros(0, int)], [np.zeros(0, int)]
        live = np.arange(len(fp))
        for d in range(1, int(np.diff(bounds).max(initial=0))):
            live = live[live + d < len(fp)]
            live = live[run[live] == run[live + d]]
            for lo in range(0, len(live), 1 << 15):
                i = live[lo : lo + (1 << 15)]
                j = i + d
                ok = ~cross[i] | (own[i] != own[j])
                ok &= np.minimum(size[i], size[j]) * least.denominator >= np.maximum(size[i], size[j]) * least.numerator
                i, j = i[ok], j[ok]
                ok = np.abs(table_[i] - table_[j]).max(axis=2).sum(axis=1) <= REACH
                i, j = i[ok], j[ok]
                ok = np.bitwise_count(fp[i] ^ fp[j]) <= REACH
                found_i.append(i[ok])
                found_j.append(j[ok])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        row, node = np.unique(x[5], return_inverse=True)
        at = spanning(len(row), node[i], node[j], np.bitwise_count(fp[i] ^ fp[j]))
        a, b = x[5][i[at]], x[5][j[at]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        x = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if left is not None:
            x = [np.concatenate(p) for p in zip(left, x)]
        cut = runs(x[:4])[-2]
        left = [c[cut:] for c in x]
        if cut:
            yield work([c[:cut] for c in x])
    if left is not None and len(left[0]):
        yield work(left)


def wide_pairs(nodes: DataFrame, least: Fraction) -> tuple[DataFrame, list[str]]:
    """nodes (row, fp, size) -> (a, b), rows to verify, and the paths that the caller removes.

    Two rows can be a pair if the smaller size is `least` of the larger or more. Rows of one fingerprint are paired with their smallest row, which
    stands for them in the lists. Of the pairs in a block's lists those stay that span them, the nearest first: all rows 6 or fewer
    bits apart hang together, and most of up to REACH do.
    """
    classes, path = written(nodes.groupBy("fp").agg(F.min(F.struct("row", "size")).alias("x")).select("fp", "x.row", "x.size"), "fingerprints")
    same = nodes.select("fp", F.col("row").alias("b")).join(classes.select("fp", F.col("row").alias("a")), "fp").where("a <> b").select("a", "b")
    order = ["pair", "at", "lo", "hi"]
    blocks = in_block_pairs(wide_lists(classes), ["pair", "at"], "row", WIDE_BLOCK).select(*order, "own", "row", "fp", "total")
    near = blocks.repartition(*order).sortWithinPartitions(*order).mapInArrow(lambda it: near_in_blocks(it, least), "a long, b long")
    return same.unionByName(near), [path]


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bits: int = 3, width: int = 3, block: int = BLOCK, keep: list[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep, id_col among them) with fingerprint (16 hex digits) and component_id (long), the smallest id reachable over links of `bits` or fewer.

    bits is 3 at most (the lists are exact up to there). Columns of the two names in the input are replaced. Texts are
    whole; a null or wordless one has fingerprint zero and links like any other. A row with a null id has its
    fingerprint, but no component (null), as a link could not name it. Rows that share an id share what they link to.
    An empty table gives an empty result. The columns kept are written once with their fingerprints to the shared folder.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0 to 3")
    docs = without(docs, "fingerprint", "component_id")
    fp, component = unused(docs, "fp", "component")
    known, _ = written(fingerprints(docs, fp, text_col=text_col, width=width, keep=keep), "fingerprints", "zstd")
    slim = known.where(q(id_col).isNotNull()).select(q(id_col).cast("long").alias("id"), q(fp).alias("fp"))
    classes = components_of(slim, bits, block).select(F.col("fp").alias(fp), F.col("component").alias(component))
    joined = known.join(classes, fp, "left")
    return joined.select(
        *[q(c) for c in known.columns if c != fp],
        F.lower(F.lpad(F.hex(q(fp)), 16, "0")).alias("fingerprint"),
        F.when(q(id_col).isNotNull(), q(component)).alias("component_id"),
    )


def components_of(slim: DataFrame, bits: int = 3, block: int = BLOCK) -> DataFrame:
    """(id, fp) -> (fp, component), one row per distinct fingerprint."""
    nodes, _ = written(slim.groupBy("fp").agg(F.min("id").alias("node")), "nodes")
    # An id may stand for several texts: their fingerprints then hang together by it.
    same = slim.groupBy("id").agg(F.min("fp").alias("f"), F.max("fp").alias("g")).where("f <> g").select("id")
    lists = listed(nodes)
    pairs = in_block_pairs(lists, ["pair", "at"], "fp", block)
    order = ["pair", "at", "lo", "hi"]
    rows = pairs.select(*order, "own", "node", "fp").repartition(*order).sortWithinPartitions(*order)
    links, p1 = written(rows.mapInArrow(lambda it: links_in_blocks(it, bits), "a long, b long"), "links")
    shared_ids = slim.join(same, "id", "left_semi").join(nodes, "fp").select(F.col("id").alias("a"), F.col("node").alias("b"))
    found, p2 = connected_components(links.unionByName(shared_ids))
    out, _ = written(nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component")), "classes")
    remove(slim.sparkSession, p1, *p2)
    return out


def op4_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])

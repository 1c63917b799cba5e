"""Near-duplicates by SimHash and the Jaccard similarity of word shingles, without loss.

A text is the set of the XXH64 values of its `width`-word shingles (a text of fewer words is one shingle). Texts are first
paired by the SimHash of their sets (simhash.wide_pairs: pivot tables, up to 12 of 64 bits), and the pairs verified
on the whole sets. No number of bits is sure to reach every pair of a similarity, so what is left is looked for by the
shingles, among texts that don't hang together yet. Put the shingles of all texts in one order, those of fewest texts first. Two sets of a similarity of t or more then share a shingle among
the first n - ceil(t n) + 1 of each (n: its size), whatever the order is; with rare ones first, few others do. So:

- occurrences of shingles go to buckets by hash, packed by batch of rows; a bucket counts its shingles and sends back those
  found in several rows, and each batch puts its rows' shingles in order;
- rows are listed under the first shingles of their sets, equal sets as one row; lists of one row go;
- a pair of a list is discarded by the sizes, or if the places of the shingle leave too little to share, or (in the last step)
  if the sets' parity maps differ in more bits than the sets may in shingles;
- survivors are verified on the whole sets.

Crowds of near copies that SimHash left apart are joined first by the neighbours in each list (by size) and the list's first row; lists whose
rows then hang together already need no more pairs, and of the others only pairs across components are worked.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, q, remove, unused, without, written
from tidemark.llm.graphs import connected_components, in_block_pairs, runs
from tidemark.llm.simhash import fingerprint_of, signed, wide_pairs

#: Shingles of a bucket, about: a task holds one bucket at a time.
BUCKET = 1_000_000
#: Row keys of a batch, whose shingles are put in order together, and shingles after which a part of one is sent on.
BATCH, HELD = 4096, 1 << 19
#: Entries of a block of a long list.
BLOCK = 512
#: Pairs that a task compares at once, and by their parity maps.
CHUNK, MAPS = 1 << 16, 1 << 12
#: Bits of a parity map: enough to tell sets of up to some 2,500 shingles apart; pairs of larger ones are left to the verification.
MAP = 2048


def shingles(text: str | None, width: int) -> np.ndarray:
    """The hashes of a text's shingles, ascending, each once; none for a null or wordless text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, len(words) - width + 1))


def parity_map(s: np.ndarray) -> bytes:
    """MAP bits, each whether the number of hashes that fall on it is odd. Maps differ in as many bits as their sets do in hashes, or in fewer."""
    n = np.bincount((s % np.uint64(MAP)).astype(np.int64), minlength=MAP)
    return np.packbits((n & 1).astype(np.uint8), bitorder="little").tobytes()


def mapped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(row, text) -> (row, map): the parity maps of texts."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([parity_map(shingles(t.as_py(), width)) for t in b.column(1)], pa.binary())], names=["row", "map"])


def described(docs: DataFrame, names: tuple[str, str, str, str], text_col: str, width: int) -> DataFrame:
    """docs with a row key, the number of shingles, a hash of their set and its SimHash (none: zero), named as in names."""
    row, size, key, fp = names
    source = docs.withColumn(row, F.monotonically_increasing_id())
    at, columns = source.columns.index(text_col), [*source.columns, size, key, fp]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h, f = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.uint64), np.zeros(b.num_rows, np.int64)
            for i, t in enumerate(b.column(at)):
                s = shingles(t.as_py(), width)
                n[i], h[i], f[i] = len(s), xxhash.xxh64_intdigest(s.tobytes(), 42), signed(fingerprint_of(s))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n), pa.array(h.view(np.int64)), pa.array(f)], names=columns)

    return source.mapInArrow(of, T.StructType([*source.schema, T.StructField(size, T.IntegerType()), T.StructField(key, T.LongType()), T.StructField(fp, T.LongType())]))


def packed(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """(row, text) -> (bucket, batch, rows, hashes): the shingles of rows of a batch that fall in a bucket, as bytes."""

    def of(batch: int, rows: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(sets)
        local = np.repeat(np.array(rows, np.int64) % BATCH, [len(s) for s in sets]).astype(np.uint16)
        bucket = (h % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        h, local, bucket = h[order], local[order], bucket[order]
        bounds = runs([bucket])
        parts = list(zip(bounds, bounds[1:])) if len(h) else []
        for at in range(0, len(parts), 256):
            some = parts[at : at + 256]
            cols = [
                pa.array([int(bucket[x]) for x, _ in some], pa.int32()),
                pa.array([batch] * len(some), pa.int64()),
                pa.array([local[x:y].tobytes() for x, y in some], pa.binary()),
                pa.array([h[x:y].tobytes() for x, y in some], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["bucket", "batch", "rows", "hashes"])

    rows: list[int] = []
    sets: list[np.ndarray] = []
    held = 0
    for b in batches:
        for row, t in zip(b.column(0).to_pylist(), b.column(1)):
            if rows and (held >= HELD or rows[0] // BATCH != row // BATCH):
                yield from of(rows[0] // BATCH, rows, sets)
                rows, sets, held = [], [], 0
            rows.append(row)
            sets.append(shingles(t.as_py(), width))
            held += len(sets[-1])
    if rows:
        yield from of(rows[0] // BATCH, rows, sets)


def sizes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, size) -> (batch, rows, sizes): the sizes of a batch's rows, as bytes."""
    for b in batches:
        row, size = b.column(0).to_numpy(), b.column(1).to_numpy()
        bounds = runs([row // BATCH])
        for lo, hi in zip(bounds, bounds[1:]):
            cols = [pa.array([int(row[lo]) // BATCH]), *(pa.array([x.tobytes()], pa.binary()) for x in ((row[lo:hi] % BATCH).astype(np.uint16), size[lo:hi]))]
            yield pa.RecordBatch.from_arrays(cols, names=["batch", "rows", "sizes"])


def by_run(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows in order of key -> a table for each of its values."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        bounds = runs([b.column(key).to_numpy()])
        for lo, hi in zip(bounds, bounds[1:]):
            part = b.slice(lo, hi - lo)
            if held and held[-1].column(key)[0] != part.column(key)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of packed() in order of bucket -> (batch, rows, hashes, counts): the shingles found in several rows, with their numbers of rows."""
    for t in by_run(batches, "bucket"):
        h = np.frombuffer(b"".join(t["hashes"].to_pylist()), np.uint64)
        ends = np.cumsum([len(x) // 8 for x in t["hashes"].to_pylist()])
        order = np.argsort(h)
        bounds = runs([h[order]])
        n = np.zeros(len(h), np.int32)
        n[order] = np.repeat(np.diff(bounds), np.diff(bounds))
        for batch, rows, lo, hi in zip(t["batch"].to_pylist(), t["rows"].to_pylist(), [0, *ends[:-1]], ends):
            several = n[lo:hi] > 1
            if several.any():
                out = np.frombuffer(rows, np.uint16)[several], h[lo:hi][several], n[lo:hi][several]
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in out)], names=["batch", "rows", "hashes", "counts"])


def first_shingles(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    """Rows of counted() and sizes_of() in order of batch -> (shingle, row, size, place) of each row's first shingles, those found in one row left out."""
    for t in by_run(batches, "batch"):
        size = np.zeros(BATCH, np.int64)
        is_size = pa.compute.is_valid(t["sizes"])
        given = t.filter(is_size)
        size[np.frombuffer(b"".join(given["rows"].to_pylist()), np.uint16)] = np.frombuffer(b"".join(given["sizes"].to_pylist()), np.int32)
        lists = t.filter(pa.compute.invert(is_size))
        local = np.frombuffer(b"".join(lists["rows"].to_pylist()), np.uint16).astype(np.int64)
        h = np.frombuffer(b"".join(lists["hashes"].to_pylist()), np.uint64)
        n = np.frombuffer(b"".join(lists["counts"].to_pylist()), np.int32)
        order = np.lexsort((h, n, local))
        local, h = local[order], h[order]
        common = np.bincount(local, minlength=BATCH)
        place = (size - common)[local] + np.arange(len(h)) - (np.cumsum(common) - common)[local]
        keep = place < (size + (-size * least.numerator) // least.denominator + 1)[local]
        local = local[keep]
        if len(local):
            row = t["batch"][0].as_py() * BATCH + local
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(row), pa.array(size[local].astype(np.int32)), pa.array(place[keep].astype(np.int32))], names=["shingle", "row", "size", "place"])


def enough(size_a: np.ndarray, place_a: np.ndarray, size_b: np.ndarray, place_b: np.ndarray, least: Fraction) -> np.ndarray:
    """Whether two sets can be similar enough, if the shingle at these places is the first that they share."""
    share = np.minimum(size_a - place_a, size_b - place_b)
    return share * (least.denominator + least.numerator) >= least.numerator * (size_a + size_b)


def pairs_in_blocks(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    """Rows (shingle, lo, hi, own, row, total, place, component, map) in order of the first three -> (a, b), pairs of rows of two components to verify."""
    left: pa.Table | None = None
    keys = ("shingle", "lo", "hi")

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x = {c: t[c].to_numpy().astype(np.int64) for c in t.column_names if c != "map"}
        maps = np.frombuffer(b"".join(t["map"].to_pylist()), np.uint64).reshape(len(t), -1)
        bounds = runs([x[k] for k in keys])
        run = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        live = np.arange(len(run))
        for d in range(1, int(np.diff(bounds).max(initial=0))):
            live = live[live + d < len(run)]
            live = live[run[live] == run[live + d]]
            for lo in range(0, len(live), CHUNK):
                i = live[lo : lo + CHUNK]
                j = i + d
                ok = (x["component"][i] != x["component"][j]) & ((x["lo"][i] == x["hi"][i]) | (x["own"][i] != x["own"][j]))
                i, j = i[ok], j[ok]
                ok = enough(x["total"][i], x["place"][i], x["total"][j], x["place"][j], least)
                i, j = i[ok], j[ok]
                differ = np.zeros(len(i), np.int64)
                for at in range(0, len(i), MAPS):
                    differ[at : at + MAPS] = np.bitwise_count(maps[i[at : at + MAPS]] ^ maps[j[at : at + MAPS]]).sum(axis=1, dtype=np.int64)
                ok = differ * (least.denominator + least.numerator) <= (x["total"][i] + x["total"][j]) * (least.denominator - least.numerator)
                a, b = x["row"][i[ok]], x["row"][j[ok]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([left, t]) if left is not None else t
        cut = int(runs([t[k].to_numpy() for k in keys])[-2])
        if cut:
            yield from work(t.slice(0, cut))
        left = t.slice(cut)
    if left is not None:
        yield from work(left)


def verified(pairs: DataFrame, texts: DataFrame, width: int, least: Fraction) -> tuple[DataFrame, list[str]]:
    """Those of the pairs (a, b) whose texts (row, text) have a similarity of `least` or more."""
    pairs, p1 = written(pairs.distinct(), "pairs")
    rows = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    needed, p2 = written(texts.join(rows, "row", "left_semi"), "pair-texts", "zstd")
    side = lambda x: needed.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (a, s, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3))):
                if a != last:
                    last, x = a, shingles(s.as_py(), width)
                y = shingles(t.as_py(), width)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = shared * (least.denominator + least.numerator) >= least.numerator * (len(x) + len(y))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], names=["a", "b"])

    links, p3 = written(both.mapInArrow(of, "a long, b long"), "links")
    remove(pairs.sparkSession, p1, p2)
    return links, [p3]


def listed(docs: DataFrame, nodes: DataFrame, width: int, least: Fraction) -> tuple[DataFrame, str]:
    """docs (row, text, size) -> (shingle, row, size, place): the first shingles of the rows in nodes, where two or more rows have them."""
    buckets = max(1, (docs.agg(F.sum("size")).first()[0] or 0) // BUCKET)
    blobs = docs.select("row", "text").mapInArrow(lambda it: packed(it, width, buckets), "bucket int, batch long, rows binary, hashes binary")
    counts = blobs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(counted, "batch long, rows binary, hashes binary, counts binary")
    sizes = docs.select("row", "size").mapInArrow(sizes_of, "batch long, rows binary, sizes binary")
    batches = counts.unionByName(sizes, allowMissingColumns=True)
    out = batches.repartition("batch").sortWithinPartitions("batch").mapInArrow(lambda it: first_shingles(it, least), "shingle long, row long, size int, place int")
    return written(out.join(nodes.select("row"), "row", "left_semi").select("shingle", "row", "size", "place"), "first-shingles")


def with_component(entries: DataFrame, joined: DataFrame) -> DataFrame:
    """entries with the component of their rows, that of a row without links being itself."""
    return entries.join(joined.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))


def near_copies(docs: DataFrame, *, text_col: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """docs' columns with row (long, a key of the row) and component (long), the smallest row reachable over links.

    Texts link if the Jaccard similarity of their sets of `width`-word shingles is `least` or more (words are parted by ASCII
    white space, ASCII letters lowered); so do all texts without words, null or not. Every such link counts: what SimHash can't reach is found by
    the shingles, no list is cut, and no pair is left to chance but for equal 64-bit hashes. Ids take no part. Columns of the two names in the input are
    replaced. The columns are written once to the shared folder.
    """
    t = Fraction(str(least))
    if not 0 < t <= 1:
        raise ValueError("least must be over 0 and 1 at most")
    docs = without(docs, "row", "component")
    spark = docs.sparkSession
    bounded_batches(spark)
    size, key, fp = unused(docs, "size", "key", "fp")
    known, _ = written(described(docs, ("row", size, key, fp), text_col, width), "described", "zstd")
    slim = known.select("row", F.col(size).alias("size"), F.col(key).alias("key"), F.col(fp).alias("fp"))
    nodes, p_nodes = written(slim.groupBy("key").agg(F.min(F.struct("row", "size", "fp")).alias("x")).select("key", "x.*"), "nodes")
    texts = known.select("row", q(text_col).alias("text"))

    # Near ones by SimHash.
    pairs, p_wide = wide_pairs(nodes.select("row", "fp", "size"), t)
    near, p_near = verified(pairs, texts, width, t)
    joined, p_joined = connected_components(near)

    # The rest by shingles.
    entries, p_entries = listed(known.select("row", q(text_col).alias("text"), F.col(size).alias("size")), nodes, width, t)

    # Neighbours by size in each list and its first row.
    in_list, columns = "shingle ORDER BY size, row", ("row", "size", "place", "component")
    beside = with_component(entries, joined).selectExpr(*columns, *[f"{f}({c}) OVER (PARTITION BY {in_list}) AS {f}_{c}" for f in ("lag", "first") for c in columns])
    found = [beside.select(*columns, *[F.col(f"{f}_{c}").alias(f"o_{c}") for c in columns]) for f in ("lag", "first")]
    share = F.least(F.col("size") - F.col("place"), F.col("o_size") - F.col("o_place"))
    some = found[0].unionByName(found[1]).where((F.col("component") != F.col("o_component")) & (share * (t.denominator + t.numerator) >= (F.col("size") + F.col("o_size")) * t.numerator))
    beside, p_beside = verified(some.select(F.least("row", "o_row").alias("a"), F.greatest("row", "o_row").alias("b")), texts, width, t)
    remove(spark, *p_wide, *p_joined)
    links = near.unionByName(beside)
    joined, p_joined = connected_components(links)

    # What is left: pairs across components.
    entries, p_open = written(with_component(entries, joined), "open")
    several = entries.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("shingle")
    entries, p_several = written(entries.withColumnRenamed("size", "total").join(several, "shingle", "left_semi"), "several")
    rows, p_rows = written(entries.select("row").distinct(), "rows")
    maps, p_maps = written(texts.join(rows, "row", "left_semi").mapInArrow(lambda it: mapped(it, width), "row long, map binary"), "maps", "zstd")
    order = ["shingle", "lo", "hi"]
    blocks = in_block_pairs(entries, ["shingle"], "row", BLOCK).join(maps, "row").select(*order, "own", "row", "total", "place", "component", "map")
    pairs = blocks.repartition(*order).sortWithinPartitions(*order).mapInArrow(lambda it: pairs_in_blocks(it, t), "a long, b long")
    more, p_more = verified(pairs, texts, width, t)
    all_, p_all = connected_components(links.unionByName(more))

    classes, _ = written(slim.select("row", "key").join(nodes.select("key", F.col("row").alias("node")), "key").join(all_, "node", "left").select("row", F.coalesce("component", "node").alias("component")), "classes")
    remove(spark, p_nodes, p_entries, *p_near, *p_beside, *p_joined, p_open, p_several, p_rows, p_maps, *p_more, *p_all)
    return known.drop(size, key, fp).join(classes, "row").select(*[q(c) for c in docs.columns], "row", "component")

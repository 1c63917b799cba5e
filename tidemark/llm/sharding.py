"""Two-pass external shuffle into shards whose row counts are at most one apart.

Pass one scatters records by a seeded hash of their content into buckets that fit in memory. On large inputs it has two levels: an
exchange partition takes a run of neighbouring buckets, and its rows are sorted by bucket (Spark's external sort,
which spills), so the number of exchange partitions and of files is bounded whatever the number of buckets. Pass two reads
one bucket after the other in order of content (so the order of arrival doesn't matter), runs a seeded Fisher-Yates shuffle over it
and writes it. A row's place in the global order is its bucket's offset plus its place in the bucket; the shards cut
that order into equal runs, so no second exchange is needed.

Rows that are equal in all columns have one hash. A class of them that would overfill a bucket by itself is added up to one
row with a count, cut into runs of copies that fit, and the runs are scattered by class and number; pass two writes a run out again.
All other rows have their place by their own content alone.

Law: `rows`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, q, remove, scratch_path, table, unused, without, written

#: Bytes of text (and one a row) that a bucket holds on average.
BUCKET_BYTES = 24 << 20
#: Exchange partitions at most; with more buckets, each takes several.
PARTITIONS = 20_000


def permuted(n: int, seed: int, bucket: int) -> np.ndarray:
    """A Fisher-Yates permutation of 0..n-1 (numpy's, which swaps from the end down) from the seed and the bucket."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def shuffle_into_shards(docs: DataFrame, path: str, *, shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, partitions: int = PARTITIONS) -> DataFrame:
    """Writes all rows of docs, with their texts, to `path/shard=K` (Parquet) in a seeded global random order.

    Adds shard (int) and slot (long, gapless from 0 in each shard); columns of those names in the input are replaced,
    all others are kept. Counts of shards differ by one at most. The result depends only on the rows, the seed, the
    number of shards and bucket_bytes, never on the partitioning of the input or of the exchange.
    Null ids and texts are rows like any other (a null text has no bytes). Equal rows are interchangeable, and any number of
    them is spread over buckets. An empty table gives an empty, readable result. A document longer than a bucket is in
    its bucket whole, with what else hashes there. Columns of maps aren't hashed: rows that differ in them only share a bucket.
    Buckets are re-made by their lineage if an executor is lost; the write is committed by Spark.
    """
    spark = docs.sparkSession
    docs = without(docs, "shard", "slot")
    names = docs.columns
    b, h, n = unused(docs, "bucket", "hash", "copies")
    size = F.coalesce(F.octet_length(q(text_col)), F.lit(0)).cast("long") + F.lit(1)
    content = F.xxhash64(F.lit(seed), F.struct(*[q(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]), *[q(c).isNull() for c in (id_col, text_col)])
    total = (docs.agg(F.sum(size)).first()[0]) or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    bucket_of = lambda x: F.pmod(x, F.lit(buckets)).cast("long")

    def counted(df: DataFrame):
        """Rows, bytes and longest row of each bucket that has any; 28 bytes a bucket on the driver."""
        return df.groupBy(b).agg(F.sum(n).alias("n"), F.sum(size * q(n)).alias("bytes"), F.max(size).alias("longest")).toArrow()

    rows = docs.withColumn(h, content).withColumn(b, bucket_of(q(h))).withColumn(n, F.lit(1).cast("long"))
    found = counted(rows)
    over = found.filter(pc.greater(found["bytes"], pc.add(pc.multiply(found["longest"], 2), 2 * bucket_bytes)))
    if len(over):
        # Classes of equal rows that fill a bucket by themselves: fewer than there are buckets.
        full = spark.createDataFrame([(x,) for x in over[b].to_pylist()], "k long")
        classes = rows.join(F.broadcast(full), q(b) == F.col("k"), "left_semi").groupBy(h).agg(F.sum(size).alias("bytes")).where(F.col("bytes") > bucket_bytes).select(F.col(h).alias("hot"))
        hot = spark.createDataFrame([(x,) for x in sorted(r.hot for r in classes.collect())], "hot long")
        one = F.struct(*[q(c) for c in names])
        runs = rows.join(F.broadcast(hot), q(h) == F.col("hot"), "left_semi").groupBy(h).agg(F.first(one).alias("one"), F.count(F.lit(1)).alias(n)).select("one.*", h, n)
        fit = F.greatest(F.lit(1), F.floor(F.lit(bucket_bytes) / size)).cast("long")
        runs = runs.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), q(n) - 1, fit))).withColumn(n, F.least(fit, q(n) - F.col("at")))
        runs = runs.withColumn(h, F.xxhash64(h, "at")).select(*[q(c) for c in names], h, bucket_of(q(h)).alias(b), n)
        rows = rows.join(F.broadcast(hot), q(h) == F.col("hot"), "left_anti").select(*runs.columns).unionByName(runs)
        found = counted(rows)
    counts = np.zeros(buckets, np.int64)
    counts[found[b].to_numpy()] = found["n"].to_numpy()
    starts, n_rows = np.cumsum(counts) - counts, int(counts.sum())
    first = np.array([-(-n_rows * s // shards) for s in range(shards + 1)], np.int64)
    offsets = spark.sparkContext.broadcast(starts)  # eight bytes a bucket

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                own = batch.column(len(names)).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), batch.num_rows]
                for lo, hi in zip(cuts, cuts[1:]):
                    part = batch.slice(lo, hi - lo)
                    if held and held[-1].column(len(names))[0] != part.column(len(names))[0]:
                        yield from shuffled(held)
                        held = []
                    held.append(part)
        if held:
            yield from shuffled(held)

    def shuffled(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One bucket, in order of content."""
        whole = pa.Table.from_batches(parts)
        bucket = whole.column(len(names))[0].as_py()
        order = np.repeat(np.arange(whole.num_rows), whole.column(len(names) + 1).to_numpy())
        order = order[permuted(len(order), seed, bucket)]
        place = offsets.value[bucket] + np.arange(len(order))
        shard = np.searchsorted(first, place, side="right") - 1
        whole = whole.select(range(len(names)))
        for lo in range(0, len(order), 2048):  # bounded batches back to the JVM
            cut = slice(lo, lo + 2048)
            part = whole.take(order[cut]).combine_chunks()
            part = part.append_column("shard", pa.array(shard[cut], pa.int32())).append_column("slot", pa.array(place[cut] - first[shard[cut]], pa.int64()))
            yield from part.to_batches()

    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    tasks = min(buckets, partitions)
    ordered = rows.repartitionById(tasks, F.floor(q(b) * F.lit(tasks) / F.lit(buckets)).cast("int")).sortWithinPartitions(q(b), q(h), q(id_col), q(text_col))
    bounded_batches(spark)
    ordered.select(*[q(c) for c in names], b, n).mapInArrow(second_pass, schema).write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)


def op3_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the shards written for the whole documents table; read from the written shards."""
    path = scratch_path(spark, "shards")
    out = shuffle_into_shards(table(spark, sf_dir, "documents"), path, shards=16)
    text = F.coalesce("text", F.lit(""))
    digest = out.select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(1)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
    digest, _ = written(digest, "shard-digests")
    remove(spark, path)
    return digest

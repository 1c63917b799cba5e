"""Line dedup by a sharded minimal perfect hash.

1. Every text is split into lines; a line's key is hashed to 128 bits. The documents of each distinct hash are counted by a
   grouped aggregation (a document counts once).
2. All distinct hashes are cut into shards of bounded size by their high bits. For each shard a task builds a minimal perfect hash
   (levels of bit arrays: a key stays on the first level where nothing else hits its bit; its slot is the number of set
   bits before it) and the two compact arrays it indexes: 16-bit fingerprints and counts that stop at min_docs. That is some
   four bytes a distinct line, whatever its length.
3. Documents probe the arrays: level bits, slot, fingerprint, count; the count decides. No line is joined. If the whole
   index is within a bound, every task gets it. If not, the documents' hashes go to the shards: each shard is probed by as many
   tasks as its lines ask for (they are dealt by document, so a line that is everywhere is no hot spot), and what is common
   comes back to its document.

The documents probed are those that were counted, so every probe is for a key of the index and no answer is wrong, unless two lines agree in
128 bits. A foreign line passes as an indexed one with a chance of 2**-16.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ASCII_SPACE, bounded_batches, q, remove, table, unused, without, written

#: Distinct lines a shard holds on average: about four bytes each.
SHARD_KEYS = 1 << 20
#: Bytes of an index up to which every task gets all of it.
INDEX_BYTES = 128 << 20
#: Probes that a task of a shard takes on average, where the index is longer than that.
PROBES = 4_000_000
#: Bits a key on each level.
GAMMA = 2.0
_STRIP = ASCII_SPACE.encode()


def line_keys(text: str | None) -> list[bytes]:
    """Keys of all lines of a text: stripped of ASCII white space, A-Z lower-cased (null: one empty line)."""
    return [x.strip(_STRIP) for x in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]


def hashed(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as (n, 2) unsigned words."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)


def mixed(h: np.ndarray, level: int) -> np.ndarray:
    """64 bits of 128-bit hashes (n, 2), others for each level."""
    x = h[:, 0] ^ h[:, 1] * np.uint64(2 * level + 1) ^ np.uint64((level * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (mixed(h, 1 << 20) >> np.uint64(48)).astype(np.uint16)


def counters(min_docs: int) -> type:
    """Smallest type that holds counts up to min_docs."""
    return np.min_scalar_type(max(1, min_docs)).type


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit hashes with the arrays it indexes."""

    def __init__(self, sizes: list[int], bits: np.ndarray, prints: np.ndarray, counts: np.ndarray):
        self.sizes, self.bits, self.prints, self.counts = sizes, bits, prints, counts
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits.view(np.uint64)), dtype=np.int64)))[:-1]

    @classmethod
    def build(cls, h: np.ndarray, counts: np.ndarray) -> PerfectHash:
        """h: (n, 2), distinct; counts in the same order."""
        left, sizes, levels = h, [], []
        while len(left):
            if len(sizes) == 1000:
                raise ValueError("the hashes aren't distinct")
            m = -(-int(GAMMA * len(left) + 1) // 64) * 64
            at = (mixed(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            hits = np.bincount(at, minlength=m)
            levels.append(np.packbits(hits == 1, bitorder="little"))
            sizes.append(m)
            left = left[hits[at] != 1]
        made = cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint8), np.zeros(len(h), np.uint16), np.zeros(len(h), counts.dtype))
        slots = made.slots(h)
        made.prints[slots], made.counts[slots] = fingerprints(h), counts
        return made

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 where no level has it (an unknown hash may get any slot)."""
        out, live, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        words = self.bits.view(np.uint64)
        for level, m in enumerate(self.sizes):
            if not len(live):
                break
            at = (mixed(h[live], level) % np.uint64(m)).astype(np.int64) + base
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            rank = self.before[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[live[hit]] = rank[hit]
            live, base = live[~hit], base + m
        return out

    def count(self, h: np.ndarray) -> np.ndarray:
        """Count of each key, 0 for one that isn't indexed."""
        s = self.slots(h)
        ok = s >= 0
        ok[ok] = self.prints[s[ok]] == fingerprints(h[ok])
        return np.where(ok, self.counts[np.where(ok, s, 0)], 0) if len(self.counts) else np.zeros(len(h), np.uint8)

    def dump(self) -> dict:
        return {"sizes": self.sizes, "bits": self.bits.tobytes(), "prints": self.prints.tobytes(), "counts": self.counts.tobytes()}

    @classmethod
    def load(cls, sizes, bits, prints, counts, kind: type) -> PerfectHash:
        return cls(list(sizes), *(np.frombuffer(bytes(x), t) for x, t in ((bits, np.uint8), (prints, np.uint16), (counts, kind))))


SHARD_SCHEMA = "shard int, sizes array<long>, bits binary, prints binary, counts binary, probes long"


def shard_of(first: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the high 32 bits."""
    return ((first >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def counted(keys: list[bytes], min_chars: int) -> np.ndarray:
    """Whether keys may be dropped at all."""
    return np.fromiter((bool(k) and (min_chars <= 1 or len(k.decode("utf-8", "surrogatepass")) >= min_chars) for k in keys), bool, len(keys))


def distinct_hashes(texts: list[str | None], min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct keys of each text, number of each text's)."""
    keys = [list(dict.fromkeys(line_keys(t))) for t in texts]
    flat = [k for x in keys for k in x]
    ok = counted(flat, min_chars)
    bounds = np.cumsum([0, *map(len, keys)])
    return hashed(flat)[ok], np.diff(np.concatenate(([0], np.cumsum(ok)))[bounds])


def build_index(docs: DataFrame, *, text_col: str = "text", min_docs: int = 10, min_chars: int = 1, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int, str]:
    """(shards as rows of SHARD_SCHEMA, number of shards, their path): all distinct keys of at least min_chars code points, with the
    number of their documents, min_docs at most. probes: how many documents' keys a shard has, repeats included."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                h = distinct_hashes(b.column(0).slice(lo, 256).to_pylist(), min_chars)[0].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1])], names=["h", "f"])

    lines = docs.select(q(text_col)).mapInArrow(hashes, "h long, f long")
    known, p = written(lines.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n")), "lines")
    shards = max(1, -(-known.count() // shard_keys))
    at = F.shiftright(F.shiftrightunsigned("h", 32) * F.lit(shards), 32).cast("int")
    kind = counters(min_docs)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            s, h, f, n = (t[c].to_numpy() for c in ("shard", "h", "f", "n"))
            for k in np.unique(s):
                own = np.flatnonzero(s == k)
                own = own[np.lexsort((f[own], h[own]))]  # the same arrays whatever the order of arrival
                made = PerfectHash.build(np.stack((h[own], f[own]), axis=1).view(np.uint64), np.minimum(n[own], min_docs).astype(kind)).dump()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([made["sizes"]], pa.list_(pa.int64())), *[pa.array([made[c]], pa.binary()) for c in ("bits", "prints", "counts")], pa.array([n[own].sum()], pa.int64())], names=["shard", "sizes", "bits", "prints", "counts", "probes"])

    out, path = written(known.withColumn("shard", at).repartitionById(shards, F.col("shard")).mapInArrow(build, SHARD_SCHEMA), "perfect-hash")
    remove(docs.sparkSession, p)
    return out, shards, path


def drop_common_lines(docs: DataFrame, *, text_col: str = "text", min_docs: int = 10, min_chars: int = 1, shard_keys: int = SHARD_KEYS, index_bytes: int = INDEX_BYTES, probes: int = PROBES) -> DataFrame:
    """docs with the text freed of common lines, n_lines (long, before dropping) and n_dropped (long).

    Keys of at least min_chars code points that are found in at least min_docs documents (rows) lose all their lines in
    every document; the other lines stay as they are, joined by \\n. A null or empty text is one empty line, whose key
    is empty and never dropped: it gives an empty text. A key repeated in one document counts once. Repeated rows and
    ids are documents of their own; the id isn't used. Whole texts are taken, of any number and length of lines. Input
    columns named n_lines or n_dropped are replaced; others may have any names. An empty table gives an empty result.
    """
    docs = without(docs, "n_lines", "n_dropped")
    spark = docs.sparkSession
    bounded_batches(spark)
    index, shards, path = build_index(docs, text_col=text_col, min_docs=min_docs, min_chars=min_chars, shard_keys=shard_keys)
    length = index.agg(F.sum(F.length("bits") + F.length("prints") + F.length("counts"))).first()[0] or 0
    kind, names, at = counters(min_docs), docs.columns, docs.columns.index(text_col)
    last = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    last[text_col].nullable = True

    def freed(part: pa.RecordBatch, common_of) -> pa.RecordBatch:
        """A batch without its common lines; common_of: hashes of all lines, and how many each text has -> whether each is common."""
        texts = part.column(at).to_pylist()
        keys = [line_keys(t) for t in texts]
        flat, sizes = [k for x in keys for k in x], list(map(len, keys))
        common = common_of(hashed(flat), sizes) & counted(flat, min_chars)
        bounds = np.cumsum([0, *sizes])
        flags = [common[a:b] for a, b in zip(bounds, bounds[1:])]
        kept = ["\n".join(line for line, x in zip((t or "").split("\n"), f.tolist()) if not x) if f.any() else (t or "") for t, f in zip(texts, flags)]
        columns = list(part.columns[: len(names)])
        columns[at] = pa.array(kept, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array([int(f.sum()) for f in flags], pa.int64())], names=[*names, "n_lines", "n_dropped"])

    if length <= index_bytes:
        rows = index.collect()  # index_bytes at most
        remove(spark, path)
        sent = spark.sparkContext.broadcast([(r.shard, r.sizes, r.bits, r.prints, r.counts) for r in rows])

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {s: PerfectHash.load(*x, kind) for s, *x in sent.value}

            def common_of(h: np.ndarray, sizes: list[int]) -> np.ndarray:
                out, of = np.zeros(len(h), bool), shard_of(h[:, 0], shards)
                for s, x in known.items():
                    own = np.flatnonzero(of == s)
                    out[own] = x.count(h[own]) >= min_docs
                return out

            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    yield freed(batch.slice(lo, 256), common_of)

        return docs.mapInArrow(probe, last)

    # Hashes go to the shards. Parts of a shard: as many as its probes ask for; two numbers a shard on the driver.
    row, found = unused(docs, "row", "common")
    kept, _ = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", "zstd")
    plan = index.select("shard", F.ceil(F.col("probes") / F.lit(probes)).cast("int").alias("parts")).toArrow()
    parts = np.ones(shards, np.int64)
    parts[plan["shard"].to_numpy()] = np.maximum(1, plan["parts"].to_numpy())
    first = spark.sparkContext.broadcast((np.cumsum(parts) - parts, parts))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, n = first.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                h, each = distinct_hashes(part.column(1).to_pylist(), min_chars)
                ids = np.repeat(part.column(0).to_numpy(), each)
                of = shard_of(h[:, 0], shards)
                task = begin[of] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n[of]
                yield pa.RecordBatch.from_arrays([pa.array(task.astype(np.int32)), pa.array(ids), *[pa.array(h[:, k].view(np.int64)) for k in (0, 1)]], names=["task", "row", "h", "f"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = None, None
        for b in batches:
            shard = b.column(b.schema.get_field_index("bits"))
            for k in np.flatnonzero(shard.is_valid().to_numpy(zero_copy_only=False)):
                x = {c: b.column(b.schema.get_field_index(c))[int(k)].as_py() for c in ("task", "sizes", "bits", "prints", "counts")}
                known, of = PerfectHash.load(x["sizes"], x["bits"], x["prints"], x["counts"], kind), x["task"]
            asked = b.filter(shard.is_null())
            if asked.num_rows:
                if known is None or set(asked.column(0).to_pylist()) != {of}:
                    raise RuntimeError("a shard's probes came without it")
                h = np.stack([asked.column(k).to_numpy() for k in (2, 3)], axis=1).view(np.uint64)
                yield asked.filter(pa.array(known.count(h) >= min_docs)).select(["row", "h", "f"])

    questions = kept.select(row, q(text_col)).mapInArrow(ask, "task int, row long, h long, f long")
    begin = spark.createDataFrame([(k, a, n) for k, (a, n) in enumerate(zip(*(x.tolist() for x in first.value)))], "shard int, begin int, parts int")
    arrays = index.join(begin, "shard").withColumn("task", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("parts") - 1)))
    both = questions.unionByName(arrays.select("task", "sizes", "bits", "prints", "counts"), allowMissingColumns=True)
    both = both.repartitionById(int(parts.sum()), F.col("task")).sortWithinPartitions(F.col("bits").isNull())
    answers = both.mapInArrow(answer, "row long, h long, f long").groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("h", "f")).alias(found))
    joined = kept.join(answers, q(row) == F.col("r"), "left").select(*[q(c) for c in names], found)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [{(x["h"], x["f"]) for x in c or ()} for c in part.column(len(names)).to_pylist()]

                def common_of(h: np.ndarray, sizes: list[int]) -> np.ndarray:
                    pairs = zip(*(h[:, k].view(np.int64).tolist() for k in (0, 1)))
                    return np.fromiter((x in s for s, n in zip(sets, sizes) for x in itertools.islice(pairs, n)), bool, len(h))

                yield freed(part, common_of)

    return joined.mapInArrow(drop, last)


def op5_perfect_hash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the digest of what stays of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: The same in DuckDB.
OP5_SQL = """
WITH l AS (SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
           FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY r
"""

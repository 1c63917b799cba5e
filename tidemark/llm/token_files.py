"""Token-id files in Simple-8b coding: write in id order, read back.

A file holds the ids of a run of documents, in blocks of 256 ids (the last may be shorter). A block is a sequence of
64-bit little-endian words; a word's top four bits select how many ids it holds and of how many bits each (60 x 1,
30 x 2, 20 x 3, 15 x 4, 12 x 5, 10 x 6, 8 x 7, 7 x 8, 6 x 10, 5 x 12, 4 x 15, 3 x 20, 2 x 30, 1 x 60), the first id
lowest; the most ids that fit are taken each time. Selector 15 is the escape of an id of more than 60 bits: the rest of the word
is its place in the file's table of such ids.

    8 bytes magic | words | word offset of each block, and of the end | escaped ids
    | document ids | 1 byte each: id present | number of ids up to each document's end | 5 numbers: blocks, escapes,
    documents, ids, block size | 8 bytes magic

All numbers are unsigned 64-bit little-endian (document ids signed). Any block can be decoded alone, and many at once by whole-array operations.
"""

from __future__ import annotations

import functools
import itertools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import byte_letters, vocabulary_path
from tidemark.llm.common import bounded_batches, q, remove, scratch_path, table, written
from tidemark.llm.words import WordMemory, sliced, taken

MAGIC = b"TDM-S8B1"
BLOCK = 256
#: Ids and bits of a word by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = 60 // COUNTS
ESCAPE = 15
_WIDEST = 60


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids (uint64) -> words, word offset of each block and of the end, escaped ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    values = np.zeros((blocks, BLOCK + _WIDEST), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = ids
    values[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    width = np.full((blocks, BLOCK + _WIDEST), 99, np.int8)  # nothing reaches beyond a block
    bits = np.ones(blocks * BLOCK, np.int8)
    for shift in (32, 16, 8, 4, 2, 1):  # bit lengths by halving
        high = flat >= np.uint64(1) << np.uint64(shift)
        bits += np.where(high, shift, 0).astype(np.int8)
        flat = np.where(high, flat >> np.uint64(shift), flat)
    bits[n:] = 99
    width[:, :BLOCK] = bits.reshape(blocks, BLOCK)
    # Largest width of the next k ids, for each k that a selector has, by doubling.
    most, k, best = {1: width}, 1, np.full(width.shape, ESCAPE, np.int8)
    while k * 2 <= _WIDEST:
        m = most[k].copy()
        np.maximum(m[:, :-k], most[k][:, k:], out=m[:, :-k])
        m[:, -k:] = 99
        k *= 2
        most[k] = m
    for s in range(len(COUNTS) - 1, -1, -1):
        c = int(COUNTS[s])
        p = 1 << (c.bit_length() - 1)
        m = most[p].copy()
        if c > p:
            np.maximum(m[:, : -(c - p)], most[p][:, c - p :], out=m[:, : -(c - p)])
            m[:, -(c - p) :] = 99
        best[m <= BITS[s]] = s
    # All blocks walk from word to word together.
    ends = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    counts = np.append(COUNTS, [0, 1])
    starts, live, at = np.zeros((blocks, BLOCK), bool), np.arange(blocks), np.zeros(blocks, np.int64)
    while len(live):
        starts[live, at] = True
        at = at + counts[best[live, at]]
        more = at < ends[live]
        live, at = live[more], at[more]
    row, col = np.nonzero(starts)
    chosen = best[row, col].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (c, b) in enumerate(zip(COUNTS.tolist(), BITS.tolist())):
        own = np.flatnonzero(chosen == s)
        if len(own):
            parts = values[row[own][:, None], col[own][:, None] + np.arange(c)] << (np.arange(c) * b).astype(np.uint64)
            words[own] |= np.bitwise_or.reduce(parts, axis=1)
    own = np.flatnonzero(chosen == ESCAPE)
    words[own] |= np.arange(len(own), dtype=np.uint64)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=blocks)))).astype(np.uint64)
    return words, offsets, values[row[own], col[own]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of whole blocks."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.append(COUNTS, [0, 1])[chosen]
    at = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(at[-1], np.uint64)
    for s, (c, b) in enumerate(zip(COUNTS.tolist(), BITS.tolist())):
        own = np.flatnonzero(chosen == s)
        if len(own):
            out[at[own][:, None] + np.arange(c)] = (words[own][:, None] >> (np.arange(c) * b).astype(np.uint64)) & np.uint64((1 << b) - 1)
    own = np.flatnonzero(chosen == ESCAPE)
    if len(own):
        out[at[own]] = escapes[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a local path."""
    if re.match(r"\w+:", path):
        return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
    return pafs.LocalFileSystem(), path


class Writer:
    """Streams documents' ids into one file; what it holds beyond a part's ids are the footer's numbers."""

    #: Ids packed at once.
    PART = BLOCK * 2048

    def __init__(self, path: str):
        fs, at = filesystem(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(at)
        self.out.write(MAGIC)
        self.held, self.n_held, self.offsets, self.words, self.escapes = [], 0, [], 0, []
        self.ids, self.here, self.ends, self.n = array("q"), bytearray(), array("Q"), 0  # 17 bytes a document

    def add(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents in order: the ids of all, and the end of each one's."""
        self.ids.extend([x or 0 for x in doc_ids])
        self.here.extend([x is not None for x in doc_ids])
        self.ends.extend((ends + self.n).tolist())
        self.n += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.PART:
            self.flush(self.n_held // BLOCK * BLOCK)

    def flush(self, n: int) -> None:
        whole = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        for lo in range(0, n, self.PART):
            words, offsets, escapes = pack(whole[lo : min(n, lo + self.PART)].astype(np.uint64))
            raised = words >> np.uint64(60) == ESCAPE
            words[raised] += np.uint64(len(self.escapes))
            self.escapes += escapes.tolist()
            self.offsets.append(offsets[:-1] + np.uint64(self.words))
            self.words += len(words)
            self.out.write(words.astype("<u8").tobytes())
        self.held, self.n_held = [whole[n:]], len(whole) - n

    def close(self) -> None:
        self.flush(self.n_held)
        offsets = np.concatenate([*self.offsets, [self.words]]).astype("<u8")
        for part in (offsets, np.array(self.escapes, "<u8"), np.array(self.ids, "<i8"), np.array(self.here, np.uint8), np.array(self.ends, "<u8"), np.array([len(offsets) - 1, len(self.escapes), len(self.ids), self.n, BLOCK], "<u8")):
            self.out.write(part.tobytes())
        self.out.write(MAGIC)
        self.out.close()


def read_file(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document id, ids before it in the file, its ids) for each document, blocks decoded some thousand at a time."""
    fs, at = filesystem(path)
    with fs.open_input_file(at) as f:
        size = f.size()
        tail = f.read_at(48, size - 48)
        if tail[40:] != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no file of this format")
        blocks, n_escapes, docs, n, block = np.frombuffer(tail[:40], "<u8").astype(int).tolist()
        foot = 8 * (blocks + 1 + n_escapes + 2 * docs) + docs
        raw = f.read_at(foot, size - 48 - foot)
        cut = np.cumsum([0, 8 * (blocks + 1), 8 * n_escapes, 8 * docs, docs, 8 * docs])
        offsets, escapes, ids, here, ends = (np.frombuffer(raw[a:b], t) for a, b, t in zip(cut, cut[1:], ("<u8", "<u8", "<i8", np.uint8, "<u8")))
        held, base, decoded, start = np.zeros(0, np.uint64), 0, 0, 0
        for i in range(docs):
            end = int(ends[i])
            parts = [held]
            have = base + len(held)
            while have < end:
                to = min(blocks, decoded + 2048)
                lo, hi = int(offsets[decoded]), int(offsets[to])
                parts.append(unpack(np.frombuffer(f.read_at(8 * (hi - lo), 8 + 8 * lo), "<u8"), escapes))
                have, decoded = have + len(parts[-1]), to
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield (int(ids[i]) if here[i] else None), start, held[start - base : end - base]
            start = end
            if start - base > 1 << 18:
                held, base = held[start - base :], start


class Encoder(WordMemory):
    """The tokenizers library's ids of whole texts.

    The vocabulary's own rule cuts a text into pieces that are encoded each on its own, and it always cuts before a single space
    between two characters that aren't white space. So a text is put together from the ids of its words, remembered in
    this process; of new words the library encodes the pieces, some hundred words in one call. Texts with a special token's
    string go to the library whole. Words and ids are kept as arrays, not as Python's objects.
    """

    #: Words of one call.
    AT_ONCE = 64
    #: Signs that are a piece of their own after letters.
    SIGNS = ".,;:!?)"

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.library, self.marked = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for x in (self.library, self.marked):
            x.no_truncation()
            x.no_padding()
        # Pieces given as their bytes' letters; two bytes that UTF-8 never has end a piece and a word.
        letters = byte_letters()
        self.letters = np.array([ord(letters[b]) for b in range(256)], "<u4")
        self.piece_end, self.word_end = (self.library.token_to_id(letters[b]) for b in (0xFE, 0xFF))
        self.marked.pre_tokenizer = pre_tokenizers.Split(Regex(f"[{letters[0xFE]}{letters[0xFF]}]"), "isolated")
        # The rule by which byte-level vocabularies of this kind cut texts into pieces (a fixed value), white space spelled out.
        space = r"\t-\r \x85\p{Z}"
        self.cut = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{space}\p{{L}}\p{{N}}]+|[{space}]+(?![^{space}])|[{space}]+").findall
        self._forget()

    def _from_letters(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each) of words given as bytes with both marks; ends: where each word's bytes end."""
        cuts = [0, *ends[self.AT_ONCE - 1 :: self.AT_ONCE].tolist()]
        if len(ends) and cuts[-1] != ends[-1]:
            cuts.append(int(ends[-1]))
        found = [np.zeros(0, np.uint32)]
        for lo in range(0, len(cuts) - 1, 128):  # what the library holds of a call is many times its ids
            lines = [self.letters[data[a:b]].tobytes().decode("utf-32-le") for a, b in itertools.pairwise(cuts[lo : lo + 129])]
            found += [np.array(x.ids, np.uint32) for x in self.marked.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate(found)
        ids = ids[ids != self.piece_end]
        stops = np.flatnonzero(ids == self.word_end)
        return ids[ids != self.word_end], np.diff(stops, prepend=-1) - 1

    def _pieced(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each) of any texts, cut by the rule; each distinct piece is encoded once."""
        cut = list(map(self.cut, texts))
        number = {p: k for k, p in enumerate(dict.fromkeys(p for x in cut for p in x))}
        coded = [p.encode() + b"\xff" for p in number]
        ids, size = self._from_letters(np.frombuffer(b"".join(coded), np.uint8), np.cumsum([len(x) for x in coded], dtype=np.int64))
        at = np.fromiter((number[p] for x in cut for p in x), np.int64)
        parts = np.cumsum([0, *map(len, cut)])
        sums = np.concatenate(([0], np.cumsum(size[at])))
        return taken(ids, np.cumsum(size) - size, size, at), np.diff(sums[parts])

    def _asked(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, number of each) of words, each with the space before it.

        Letters are one piece, and a last sign another; other words are cut by the rule.
        """
        letters = pc.utf8_is_alpha(new).to_numpy(zero_copy_only=False)
        stopped = pc.is_in(pc.utf8_slice_codeunits(new, -1), value_set=pa.array(list(self.SIGNS), pa.large_string())).to_numpy(zero_copy_only=False)
        stopped &= pc.utf8_is_alpha(pc.utf8_slice_codeunits(new, 0, -1)).to_numpy(zero_copy_only=False)
        plain = letters | stopped
        own = new.filter(pa.array(plain))
        if isinstance(own, pa.ChunkedArray):
            own = own.combine_chunks()
        size, sign = pc.binary_length(own).to_numpy().astype(np.int64), stopped[plain]
        ends = np.cumsum(size + 2 + sign)
        data = np.full(ends[-1] if len(ends) else 0, 0xFF, np.uint8)
        first = ends - size - 2 - sign
        data[first] = 0x20
        offsets = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
        source = np.frombuffer(own.buffers()[2], np.uint8) if own.buffers()[2] else np.zeros(0, np.uint8)
        data[np.repeat(first + 1 - offsets[:-1] + offsets[0], size) + np.arange(size.sum())] = source[offsets[0] : offsets[-1]]
        data[ends[sign] - 2] = source[offsets[1:][sign] - 1]
        data[ends[sign] - 3] = 0xFE
        ids, n = self._from_letters(data, ends)
        other_ids, other = self._pieced([" " + x for x in new.filter(pa.array(~plain)).to_pylist()])
        count = np.zeros(len(new), np.int64)
        start = np.zeros(len(new), np.int64)
        count[plain], count[~plain] = n, other
        start[plain], start[~plain] = np.cumsum(n) - n, len(ids) + np.cumsum(other) - other
        return np.concatenate((ids, other_ids)), start, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's); a null text has none.

        Texts are split at spaces, and each distinct word's ids are looked up once and then taken for all its places. A text whose
        spaces aren't all single ones between characters that aren't white space is one word.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lists = pc.split_pattern(texts, " ")
        cut = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        found, at, heads = coded.dictionary, coded.indices.to_numpy(), cut[:-1]
        edged = pc.or_(pc.equal(found, ""), pc.or_(pc.utf8_is_space(pc.utf8_slice_codeunits(found, 0, 1)), pc.utf8_is_space(pc.utf8_slice_codeunits(found, -1)))).to_numpy(zero_copy_only=False)
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        odd = special | np.logical_or.reduceat(edged[at], heads)
        row = np.zeros(len(found), np.int32)
        row[~edged] = self._rows(found.filter(pa.array(~edged)))
        # Beside words: those that begin a text, whole texts, and nothing, which stands for the words of whole texts.
        first = np.unique(at[heads[~odd]])
        ids, size = self._pieced([*found.take(pa.array(first)).to_pylist(), *texts.filter(pa.array(odd & ~special)).to_pylist()])
        whole = [np.array(x.ids, np.uint32) for x in self.library.encode_batch_fast(texts.filter(pa.array(special)).to_pylist(), add_special_tokens=False)]
        more = [*np.split(ids, np.cumsum(size))[:-1], *whole, np.zeros(0, np.uint32)]
        kept, n_odd = len(self.start), int((odd & ~special).sum())
        place = row[at]
        place[heads[~odd]] = kept + np.searchsorted(first, at[heads[~odd]])
        if odd.any():
            place[np.repeat(odd, np.diff(cut))] = kept + len(more) - 1
            place[heads[odd & ~special]] = kept + len(first) + np.arange(n_odd)
            place[heads[special]] = kept + len(first) + n_odd + np.arange(special.sum())
        return self._put(place, cut, more)


#: Bytes of text that are encoded at once (one text at least).
BATCH_BYTES = 8 << 20


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


#: Bytes of text that a file holds on average.
FILE_BYTES = 256 << 20

MANIFEST = "part int, file string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, path: str, vocabulary: str, *, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> DataFrame:
    """Encodes every whole text, appends end_id, and writes files under `path/ids` in ascending id order; returns the manifest.

    Null ids come first; rows of one id are ordered by a hash of the text, and rows equal in both are interchangeable. The order is
    made by range partitioning on both, so a hot id is spread over files. Null and empty texts have the end id only. An
    empty table gives an empty manifest. A task writes one file, named by its attempt, as a stream; only files of
    tasks that succeeded are in the manifest (`path/manifest`, Parquet), so a lost executor's leftovers are never read. There are as many
    files as the texts' bytes ask for (FILE_BYTES each, two a core at least), or `files`. A very long text is encoded at once by one
    task. Other columns of the input, whatever their names, aren't read.
    """
    spark = docs.sparkSession
    slim = docs.select(q(id_col).cast("long").alias("id"), q(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    if not files:
        size = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        files = max(2 * spark.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    ordered = slim.repartitionByRange(files, F.col("id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    target = f"{path}/ids"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, task, w = encoder(vocabulary), TaskContext.get(), None
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.s8b"
        for batch in batches:
            for part in sliced(batch, 1, BATCH_BYTES):
                w = w or Writer(f"{target}/{name}")
                ids, ends = e.encode(part.column(1))
                if end_id is not None:
                    ids, ends = np.insert(ids, ends, end_id), ends + 1 + np.arange(len(ends))
                w.add(part.column(0).to_pylist(), ids, ends)
                pa.default_memory_pool().release_unused()
        if w:
            w.close()
            yield pa.RecordBatch.from_pylist([{"part": task.partitionId(), "file": name, "n_docs": len(w.ids), "n_ids": w.n}], schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    bounded_batches(spark)
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _located(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with the ids before each file; as many rows as files."""
    m = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return m.withColumn("before", before)


def read_token_files(spark: SparkSession, path: str, *, digest: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, and ids (array), or
    with digest=True their CRC-32 as little-endian 32-bit words (ids_crc32) in their stead. Each file is one task's."""
    located = _located(spark, path)
    n = max(1, located.count())
    target = f"{path}/ids"
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.LongType()))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for f in batch.to_pylist():
                rows, held = [], 0
                for doc_id, start, ids in read_file(f"{target}/{f['file']}"):
                    rows.append((doc_id, f["before"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64)))
                    held += 1 if digest else len(ids)
                    if held >= 1 << 20 or len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        a, b, c, d = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)] + [pa.array(d, pa.int64() if digest else pa.list_(pa.int64()))], names=schema.names)

    numbered = located.withColumn("at", F.row_number().over(Window.orderBy("part")) - 1)
    return numbered.repartitionById(n, "at").select("file", "before").mapInArrow(read, schema)


def op9_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids, read back from the files written for all documents."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary_path("byte_bpe_50k.json"), end_id=2)
    out, _ = written(read_token_files(spark, path, digest=True), "token-digests")
    remove(spark, path)
    return out

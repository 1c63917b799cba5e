"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a context tree of variable order, 5 to 0 bytes, counted from all training texts, whose grams are shuffled once. A context is
in the tree if it holds at least a fixed share of the language's bytes, so a frequent stretch has long contexts, which cover several
letters of any script, a rare one short ones, and the trees have a bounded size at any size of the corpus.

With the counts frozen, a byte's code length in a context is exactly that of PPM, method C, with exclusion: if the context
has the byte, its share of the context's counts plus distinct bytes; else the escape's share and what the next shorter context gives,
there without the bytes that the longer one has. A text's code length under a language is the sum over all its
bytes; the shortest wins, and the score is that language's posterior under equal priors.

What a shorter context gives after an escape depends on the escaping context by two numbers only (whether the byte is there or not), so
lengths are tables: of contexts with their bytes, and of contexts; a byte that no language has in a context goes one order down.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, q, remove, table, without, written
from tidemark.llm.words import sliced

#: Bytes of the longest contexts.
ORDER = 5
#: Least share of a language's bytes that a context holds, times the number of languages: so all trees of an order have 1 / MIN_SHARE contexts at most.
MIN_SHARE = 2e-6
UNKNOWN = "und"
#: Bytes scored or counted at once.
PART = 1 << 20
#: Bytes of texts that are taken from a batch together (one text at least).
TOGETHER = 4 << 20


def grams(data: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER bytes before it as one number, the byte lowest; data begins with ORDER bytes that only precede."""
    n = len(data) - ORDER
    out = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        out <<= np.uint64(8)
        out |= data[k : k + n]
    return out


def lowest(code: np.ndarray, n: int) -> np.ndarray:
    """The last n bytes of each number."""
    return code & np.uint64((1 << 8 * n) - 1)


class Lookup:
    """Places of distinct 64-bit numbers (none of them 2**64 - 1), by open addressing."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, codes: np.ndarray):
        self.shift = np.uint64(64 - max(4, (2 * len(codes)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.places = np.full(size, self.EMPTY), np.zeros(size, np.int32)
        left, at = np.arange(len(codes)), self._at(codes)
        while len(left):
            free = self.keys[at] == self.EMPTY
            self.places[at[free]] = left[free]
            self.keys[at[free]] = codes[left[free]]  # of several, the last stays in both
            more = (self.places[at] != left) | (self.keys[at] != codes[left])
            left, at = left[more], (at[more] + 1) & (size - 1)

    def __reduce__(self):
        """Only the numbers are sent, by their places; the table is several times as large."""
        full = self.keys != self.EMPTY
        codes = np.empty(np.count_nonzero(full), np.uint64)
        codes[self.places[full]] = self.keys[full]
        return Lookup, (codes,)

    def _at(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """Place of each number, -1 for unknown ones."""
        at, out = self._at(codes), np.full(len(codes), -1, np.int32)
        key = self.keys[at]
        hit = key == codes
        out[hit] = self.places[at[hit]]
        live = np.flatnonzero(~hit & (key != self.EMPTY))
        at = at[live]
        while len(live):
            at = (at + 1) & (len(self.keys) - 1)
            key = self.keys[at]
            hit = key == codes[live]
            out[live[hit]] = self.places[at[hit]]
            more = ~hit & (key != self.EMPTY)
            live, at = live[more], at[more]
        return out


class ContextTrees:
    """Frozen code lengths of several languages: tables by order of contexts with a byte, and of contexts."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """counts, by order: language, number of context and byte, how often; of contexts in a language's tree all bytes, and with a context its shorter ones."""
        self.languages, n = languages, len(languages)
        self.grams, self.bits, self.seen, self.contexts, self.inside, self.outside = [], [], [], [], [], []
        below = None
        with np.errstate(divide="ignore", invalid="ignore"):
            for order, (lang, code, times) in enumerate(counts):
                codes, at = np.unique(code.astype(np.uint64), return_inverse=True)
                c = np.zeros((len(codes), n))
                c[at, lang] = times
                contexts, of = np.unique(codes >> np.uint64(8), return_inverse=True)
                total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
                np.add.at(total, of, c)
                np.add.at(kinds, of, c > 0)
                here = total > 0
                whole = np.where(here, np.log2(total + kinds), 0)
                escape = np.where(here, whole - np.log2(kinds), 0)
                if below is None:  # the empty context; beyond it, all bytes that it hasn't are alike
                    inside = outside = escape + np.where(kinds < 256, np.log2(256 - kinds), 0)
                    shorter, known = np.zeros((len(codes), n)), np.zeros((len(codes), n), bool)
                    shorter_of = outside[of]
                else:
                    gram, context, count, bits, sums, kind, log_whole, log_escape = below
                    p = context(lowest(contexts, order - 1))
                    lower = gram(lowest(codes, order))
                    # Counts and kinds of the shorter context without the bytes that this one has.
                    less = np.zeros((len(contexts), n))
                    np.add.at(less, of, np.where(c > 0, count[lower], 0))
                    rest, others = sums[p] - less, kind[p] - kinds
                    found = np.where(others > 0, np.log2(rest + others), 0)
                    inside = np.where(here, escape + found - log_whole[p], 0)
                    outside = np.where(here, escape - log_escape[p] + np.where(others > 0, found - np.log2(others), 0), 0)
                    shorter, known = bits[lower], count[lower] > 0
                    shorter_of = np.where(known, inside[of], outside[of])
                length = np.where(c > 0, whole[of] - np.log2(c), shorter + shorter_of)
                below = Lookup(codes), Lookup(contexts), c, length, total, kinds, whole, escape
                self.grams.append(below[0])
                self.contexts.append(below[1])
                self.bits.append(length.astype(np.float32))
                for to, x in ((self.inside, inside), (self.outside, outside)):
                    to.append(np.concatenate((x, np.zeros((1, n)))).astype(np.float32))  # the last row is that of no context
                self.seen.append(c > 0)

    def __getstate__(self) -> bytes:
        """What each executor stores of it, so packed."""
        return zlib.compress(pickle.dumps(self.__dict__, pickle.HIGHEST_PROTOCOL), 1)

    def __setstate__(self, state: bytes) -> None:
        self.__dict__ = pickle.loads(zlib.decompress(state))

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code length in bits of each byte with what precedes it, under each language."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        live = np.arange(len(codes))
        held = np.full(len(codes), -1, np.int32)  # the context one order up
        for order in range(len(self.grams) - 1, -1, -1):
            code = lowest(codes[live], order + 1)
            place = self.grams[order](code)
            hit = place >= 0
            own = live[hit]
            if order + 1 == len(self.grams):
                out[own] = self.bits[order][place[hit]]
            else:
                up, at = held[hit], place[hit]
                out[own] += self.bits[order][at] + np.where(self.seen[order][at], self.inside[order + 1][up], self.outside[order + 1][up])
                out[live[~hit]] += self.outside[order + 1][held[~hit]]
            live, code = live[~hit], code[~hit]
            if not len(live):
                return out
            held = self.contexts[order](code >> np.uint64(8)) if order else np.zeros(len(live), np.int32)
        out[live] += self.outside[0][0] if len(self.outside[0]) > 1 else 8.0
        return out

    def of_texts(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each whole text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        if not len(self.languages):
            return total
        data, ends = joined(texts)
        whose = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + ORDER for t in texts])
        scored = np.ones(len(data), bool)
        scored[(ends[:, None] + np.arange(ORDER)).ravel()] = False
        for lo in range(0, len(data) - ORDER, PART):
            part = data[lo : lo + PART + ORDER]
            own = scored[lo + ORDER : lo + len(part)]
            bits, of = self.lengths(grams(part)[own]), whose[lo + ORDER : lo + len(part)][own]
            if len(of):
                cuts = np.flatnonzero(np.diff(of, prepend=-1))
                total[of[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)
        return total


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each behind ORDER spaces, and where those begin."""
    gap = b" " * ORDER
    data = np.frombuffer(gap + gap.join(texts), np.uint8) if texts else np.zeros(0, np.uint8)
    sizes = np.array([len(t) + ORDER for t in texts], np.int64)
    return data, np.cumsum(sizes) - sizes


def coded(texts: pa.Array) -> list[bytes]:
    return pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()


#: Distinct grams that a task holds before it hands them on.
HELD = 1 << 21
#: Bytes of the contexts by which grams are dealt out: all longer contexts with such an end are in one task.
NEAR = 3


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, with the sum of n of each."""
    if not len(code):
        return code, n
    by = np.argsort(code, kind="stable")  # quick on runs in order, as they come
    code = code[by]
    cuts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    return code[cuts], np.add.reduceat(n[by], cuts)


def rows_of(number: int, code: np.ndarray, n: np.ndarray, **more: int) -> pa.RecordBatch:
    """Rows of one language."""
    same = {"number": pa.array(np.full(len(code), number, np.int32))} | {k: pa.array(np.full(len(code), v, np.int32)) for k, v in more.items()}
    return pa.RecordBatch.from_pydict(same | {"code": pa.array(code.astype(np.int64)), "n": pa.array(n)})


def count_contexts(docs: DataFrame, languages: list[str]) -> DataFrame:
    """(number, code, n): how often each byte follows each ORDER others in the texts of each language, by its place in languages. What several tasks have found is not yet added up."""
    numbers = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part in sliced(batch, 0, TOGETHER):
                langs = part.column(1).to_numpy(zero_copy_only=False)
                for lang in sorted(set(langs.tolist())):
                    texts = coded(part.column(0).filter(pa.array(langs == lang)))
                    data, ends = joined(texts)
                    own = np.ones(len(data), bool)
                    own[(ends[:, None] + np.arange(ORDER)).ravel()] = False
                    code, n = np.unique(grams(data)[own[ORDER:]], return_counts=True)
                    if lang in held:
                        code, n = summed(*map(np.concatenate, zip(held[lang], (code, n))))
                    held[lang] = code, n
                    if len(code) > HELD:
                        yield rows_of(numbers[lang], *held.pop(lang))
        for lang in list(held):
            yield rows_of(numbers[lang], *held.pop(lang))

    return docs.select("text", "lang").mapInArrow(count, "number int, code long, n long")


def grown(rows: DataFrame, least: list[float]) -> DataFrame:
    """(number, order, code, n) from rows of count_contexts: of orders from NEAR on, the contexts of `least` bytes or more with all their bytes; one order below, sums yet to be added up.

    Rows are shuffled once, by the last NEAR bytes of their contexts; a task holds the distinct ones that it gets.
    """

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def merge(parts: list[pa.RecordBatch]) -> None:
            number, code, n = (np.concatenate([p.column(k).to_numpy() for p in parts]) for k in range(3))
            for k in np.unique(number).tolist():
                own = code[number == k].astype(np.uint64), n[number == k]
                held[k] = summed(*(map(np.concatenate, zip(held[k], own)) if k in held else own))

        parts, size = [], 0
        for batch in batches:
            parts.append(batch)
            size += batch.num_rows
            if size > HELD:
                merge(parts)
                parts, size = [], 0
        if parts:
            merge(parts)
        for k in list(held):
            code, n = held.pop(k)
            for order in range(ORDER, NEAR - 1, -1):
                code, n = summed(lowest(code, order + 1), n)
                context = code >> np.uint64(8)
                cuts = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
                kept = np.repeat(np.add.reduceat(n, cuts) >= least[k], np.diff(cuts, append=len(code)))
                yield rows_of(k, code[kept], n[kept], order=order)
            yield rows_of(k, *summed(lowest(code, NEAR), n), order=NEAR - 1)

    near = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * NEAR) - 1))
    return rows.repartition("number", near).mapInArrow(grow, "number int, order int, code long, n long")


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_share: float = MIN_SHARE) -> ContextTrees:
    """Trees from all of docs, which are read twice. The driver gets the bytes of the contexts that are in the trees: 1 / min_share contexts an order at most, whatever the input.

    Null texts and languages don't count, nor do empty texts. Repeated rows count each. A language whose name has any case or space is its own.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(q(text_col).alias("text"), q(lang_col).cast("string").alias("lang")).where("octet_length(text) > 0 and lang is not null")
    sizes = {r.lang: r.n for r in docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}  # one row a language
    languages = sorted(sizes)
    if not languages:
        return ContextTrees([], [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))] * (ORDER + 1))
    least = [min_share * len(languages) * sizes[k] for k in languages]
    full, path = written(grown(count_contexts(docs, languages), least), "contexts")
    enough = F.broadcast(spark.createDataFrame(list(enumerate(least)), "number int, least double"))  # one row a language
    counts = []
    for order in range(ORDER + 1):
        rows = full.where(F.col("order") == max(order, NEAR - 1)).select("number", "code", "n")
        if order < NEAR:
            rows = rows.groupBy("number", F.col("code").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n"))
            rows = rows.withColumn("all", F.sum("n").over(Window.partitionBy("number", F.shiftright("code", 8))))
            rows = rows.join(enough, "number").where("all >= least").select("number", "code", "n")
        got = rows.toArrow()
        counts.append(tuple(got[c].to_numpy() for c in ("number", "code", "n")))
    remove(spark, path)
    return ContextTrees(languages, counts)


def identify(docs: DataFrame, trees: ContextTrees, *, text_col: str = "text") -> DataFrame:
    """docs with lang_pred (a learned language, or `und` where the text is null or has no letter) and score (0 to 1).

    score is the posterior of lang_pred under equal priors (0 for und). Whole texts are scored, of any length; ties go to the
    language that sorts first. Without any learned language all are und. Input columns of the two names are replaced; the
    id and other columns play no part, so null and repeated ids are rows like any other. An empty table gives an empty result.
    """
    docs = without(docs, "lang_pred", "score")
    bounded_batches(docs.sparkSession)
    at, names = docs.columns.index(text_col), [*docs.columns, "lang_pred", "score"]
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for batch in batches:
            for b in sliced(batch, at, TOGETHER):
                told = np.array([bool(t.languages) and x is not None and any(map(str.isalpha, x)) for x in b.column(at).to_pylist()], bool)
                lang, p = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
                if told.any():
                    bits = t.of_texts(coded(b.column(at).filter(pa.array(told))))
                    lang[told] = np.array(t.languages, object)[bits.argmin(axis=1)]
                    p[told] = 1 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(p)], names=names)

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out():
    """Documents that nothing is learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out, lang_pred and score of all documents; learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    trees = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), trees).select("doc_id", "held_out", "lang_pred", "score")

"""BPE encoding by dynamic programming over prefixes, and decoding.

The last token of the encoding of every prefix of a word is unique. It is a token that ends there (all such tokens are
found by walking a suffix automaton of the vocabulary) and that is compatible with the last token of the prefix before it:
that is, merging the two tokens' symbols side by side gives just these two tokens. So one pass stores the last token of
each prefix, and following the back-pointers from the end emits the ids, without ever running the merges.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, q, table, without
from tidemark.llm.words import WordMemory, sliced

#: Pieces of words whose ids a worker remembers before it starts afresh.
PIECES = 200_000
#: Bytes of text that are encoded at once (one text at least).
BATCH_BYTES = 8 << 20


class SuffixAutomaton:
    """Generalised suffix automaton of many sequences; a walk gives the longest suffix read so far that lies in any of them.

    The state of a whole sequence has that sequence as its longest string (nothing precedes its own start), so
    a sequence ends at the current place exactly if its state is reached at full length or by suffix links.
    """

    def __init__(self, sequences: list[tuple[int, ...]]):
        nxt, link, length, ends = [{}], [-1], [0], [-1]
        for k, seq in enumerate(sequences):
            last = 0
            for c in seq:
                p = last
                if c in nxt[p] and length[nxt[p][c]] == length[p] + 1:
                    last = nxt[p][c]
                    continue
                known = c in nxt[p]
                if known:
                    last = self._clone(nxt, link, length, ends, p, c)
                    continue
                new = len(nxt)
                nxt.append({}), link.append(0), length.append(length[p] + 1), ends.append(-1)
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    to = nxt[p][c]
                    link[new] = to if length[to] == length[p] + 1 else self._clone(nxt, link, length, ends, p, c)
                last = new
            ends[last] = k
        # Nearest state above with a whole sequence.
        above = [-1] * len(nxt)
        for v in sorted(range(1, len(nxt)), key=length.__getitem__):
            u = link[v]
            above[v] = u if ends[u] >= 0 else above[u]
        self.next = {v << 10 | c: to for v, edges in enumerate(nxt) for c, to in edges.items()}
        self.link, self.length, self.ends, self.above = link, length, ends, above

    @staticmethod
    def _clone(nxt, link, length, ends, p, c) -> int:
        """Splits the state that c leads to from p, so that its longest string is p's and c."""
        to, new = nxt[p][c], len(nxt)
        nxt.append(dict(nxt[to])), link.append(link[to]), length.append(length[p] + 1), ends.append(-1)
        link[to] = new
        while p >= 0 and nxt[p].get(c) == to:
            nxt[p][c] = new
            p = link[p]
        return new


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe(WordMemory):
    """A word-level BPE vocabulary file of the tokenizers library: NFC, white space to spaces, lower case; pieces by a
    pattern; bytes as letters; an end-of-word suffix. Other kinds are refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, norm, pre = spec["model"], spec["normalizer"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in norm["normalizers"]], [x["type"] for x in pre]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or spec["decoder"] or not model["end_of_word_suffix"] or model["dropout"] or model["ignore_merges"]:
            raise ValueError("not a vocabulary file of the kind that WordBpe reads")
        self.pattern = regex.compile(pre[0]["pattern"]["Regex"])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.final = [vocab[letters[b] + end] for b in range(256)]
        # Symbols are numbered from 0; every token has its symbols, the two parts it is merged from, and the rank of that.
        symbol = {t: k for k, t in enumerate([*self.inner, *self.final])}
        spelled = {t: (k,) for t, k in symbol.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            pair, to = (vocab[a], vocab[b]), vocab[a + b]
            self.rank[pair] = r
            if pair[0] in spelled and pair[1] in spelled and to not in self.made and to not in symbol and self.pair_stands(*pair, whole=False):
                self.made[to] = (*pair, r)
                spelled[to] = spelled[pair[0]] + spelled[pair[1]]
        self.ids = list(spelled)
        self.automaton = SuffixAutomaton([spelled[t] for t in self.ids])
        self.stands = functools.lru_cache(1 << 18)(self.pair_stands)
        self.pieces: dict[str, bytes] = {}
        self.spelled = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())
        self._forget()

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens along a token's right (1) or left (0) edge from the symbol up, each with the rank of the merge that takes it in."""
        out, taken = [], float("inf")
        while True:
            out.append((token, taken))
            if token not in self.made:
                return out[::-1]
            taken = self.made[token][2]
            token = self.made[token][side]

    def pair_stands(self, left: int, right: int, whole: bool = True) -> bool:
        """Whether no merge runs across the border when the two tokens' symbols stand side by side.

        At any time one token of left's right edge meets one of right's left edge. If their own merge ranks before the one
        that takes either of them in, it runs first. Equal ranks are the same pair twice: the one further left runs first.
        whole=False leaves out the merge of the two whole tokens.
        """
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, ends_x), (y, ends_y) = a[i], b[j]
            if not whole and i == len(a) - 1 and j == len(b) - 1:
                return True
            across = self.rank.get((x, y))
            if across is not None and across < ends_x and across <= ends_y:
                return False
            if i == len(a) - 1 and j == len(b) - 1:
                return True
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def encode_word(self, data: bytes) -> list[int]:
        """Ids of one piece's bytes."""
        n, auto, ids = len(data), self.automaton, self.ids
        nxt, link, length, ends, above, stands = auto.next, auto.link, auto.length, auto.ends, auto.above, self.stands
        last, start = [0] * (n + 1), [0] * (n + 1)
        state = size = 0
        for i in range(1, n + 1):
            c = data[i - 1] + (256 if i == n else 0)
            while (to := nxt.get(state << 10 | c)) is None:
                state = link[state]
                size = length[state]
            state, size = to, size + 1
            v = state if ends[state] >= 0 and size == length[state] else above[state]
            while True:
                token, j = ids[ends[v]], i - length[v]
                if j == 0 or stands(last[j], token):
                    last[i], start[i] = token, j
                    break
                v = above[v]
        out, i = [], n
        while i:
            out.append(last[i])
            i = start[i]
        return out[::-1]

    def _chunk(self, chunk: str) -> bytes:
        """Ids (little-endian, 32 bits) of a run without white space."""
        if chunk.isascii():
            x = chunk.lower()
        else:
            x = unicodedata.normalize("NFC", chunk)
            x = "".join(c.lower() for c in x) if "Σ" in x else x.lower()  # by letters: a final sigma is not special
        pieces, out = self.pieces, []
        for piece in self.pattern.findall(x):
            ids = pieces.get(piece)
            if ids is None:
                if len(pieces) >= PIECES:
                    pieces.clear()
                ids = b"".join([i.to_bytes(4, "little") for i in self.encode_word(piece.encode())])
                if len(piece) < 100:
                    pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit words; the special tokens' strings in it are those tokens."""
        out = []
        for k, part in enumerate(self.special_pattern.split(text or "")):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            else:  # str.split also cuts at U+001C to U+001F, which aren't white space to the vocabulary's own rules
                out += [self._chunk(x) for x in regex.split(r"[\t-\r\x85\p{Z}]+", part) if x]
        return b"".join(out)

    def _asked(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded = [self._chunk(x) if x else b"" for x in new.to_pylist()]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        return np.frombuffer(b"".join(coded), np.uint32), np.cumsum(size) - size, size

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's); each distinct run without white space is encoded once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        odd = pc.match_substring_regex(texts, "<\\||[\x1c-\x1f]")
        lists = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        cut, coded = lists.offsets.to_numpy().astype(np.int64), lists.flatten().dictionary_encode()
        place = self._rows(coded.dictionary)[coded.indices.to_numpy()]
        whole = [np.frombuffer(self.encode(x), np.uint32) for x in texts.filter(odd).to_pylist()]
        place[cut[:-1][odd.to_numpy(zero_copy_only=False)]] = len(self.start) + np.arange(len(whole))  # their one word is the empty one
        return self._put(place, cut, whole)

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; null for null."""
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))
        words = self.spelled.take(ids.flatten())
        if words.null_count:
            raise KeyError("an id that is no token's")
        texts = pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), " ")
        return pc.if_else(ids.is_valid(), texts, pa.nulls(len(ids), texts.type)).cast(pa.string())

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as files without a decoder ask for."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(2)
def vocabulary(path: str) -> WordBpe:
    """Built once in each worker process."""
    return WordBpe(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, at: int, out: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path)
    for batch in batches:
        for part in sliced(batch, at, BATCH_BYTES):
            ids, ends = v.encode_all(part.column(at))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out])
            pa.default_memory_pool().release_unused()


def _decoded(batches: Iterator[pa.RecordBatch], path: str, at: int, out: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path)
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            yield pa.RecordBatch.from_arrays([*part.columns, v.decode_all(part.column(at))], names=[*part.schema.names, out])


def encode_bpe(docs: DataFrame, path: str, *, text_col: str = "text", out: str = "ids") -> DataFrame:
    """docs with out, the array of ids of each whole text (null or empty: an empty array). path is read by each worker
    and so has to be there on every machine. A column named like out is replaced; all others stay; nothing is shuffled. Texts are taken
    whole, of any length; repeated rows and ids, null ones too, are rows of their own, and an empty table gives an empty result."""
    bounded_batches(docs.sparkSession)
    docs = without(docs, out)
    at, schema = docs.columns.index(text_col), T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(lambda it: _encoded(it, path, at, out), schema)


def decode_bpe(df: DataFrame, path: str, *, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """df with out, the text that the ids stand for (null ids: null; none: an empty text). An id that is no token's is an error. Columns as with encode_bpe."""
    bounded_batches(df.sparkSession)
    df = without(df, out)
    at, schema = df.columns.index(ids_col), T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    return df.mapInArrow(lambda it: _decoded(it, path, at, out), schema)


def round_trip(docs: DataFrame, path: str, *, text_col: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encode_bpe and decode_bpe in one pass, by one worker with one vocabulary; rows and columns as with these."""
    bounded_batches(docs.sparkSession)
    docs = without(docs, ids, decoded)
    at, n = docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])
    return docs.mapInArrow(lambda it: _decoded(_encoded(it, path, at, ids), path, n, decoded), schema)


def digests(docs: DataFrame, path: str, *, text_col: str = "text") -> DataFrame:
    """docs without its text, with n_tokens (long), ids_sha256 and decoded_sha256: encoded and decoded in one pass, so the ids don't cross to the JVM.

    Columns of these names in the input are replaced; rows as with encode_bpe."""
    bounded_batches(docs.sparkSession)
    docs = without(docs, *({"n_tokens", "ids_sha256", "decoded_sha256"} - {text_col}))
    docs = docs.select(*[q(c) for c in docs.columns if c != text_col], q(text_col))
    n = len(docs.columns) - 1
    schema = T.StructType([*docs.schema.fields[:n], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for b in _decoded(_encoded(batches, path, n, "ids"), path, n + 1, "decoded"):
            cut, ids = b.column(n + 1).offsets.to_numpy(), memoryview(b.column(n + 1).values.to_numpy().view(np.uint8))
            shas = [sha256(ids[4 * x : 4 * y]).hexdigest() for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
            columns = [pa.array(np.diff(cut).astype(np.int64)), pa.array(shas, pa.string()), pa.array([sha256(x).hexdigest() for x in b.column(n + 2).cast(pa.binary()).to_pylist()], pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *columns], names=schema.names)

    return docs.mapInArrow(digest, schema)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids and of the decoded text of all documents."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path("word_bpe_49k.json"))

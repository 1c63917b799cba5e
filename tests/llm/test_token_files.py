import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm.bpe import vocabulary_path
from tidemark.llm.token_files import BLOCK, Writer, encoder, op9_simple8b, pack, read_file, read_token_files, unpack, write_token_files

PATH = vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_words(ids):
    """Selectors and counts by the plain greedy rule, one block."""
    out, i = [], 0
    while i < len(ids):
        for s, c in enumerate((60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)):
            if i + c <= len(ids) and max(ids[i : i + c]) < 1 << 60 // c:
                out.append(s)
                i += c
                break
        else:
            out.append(15)
            i += 1
    return out


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("bits", [1, 3, 16, 33, 64])
def test_pack(n, bits):
    r = random.Random(n * 100 + bits)
    ids = [r.getrandbits(r.randrange(1, bits + 1)) for _ in range(n)]
    words, offsets, escapes = pack(np.array(ids, np.uint64))
    assert unpack(words, escapes).tolist() == ids
    chosen = (words >> np.uint64(60)).tolist()
    for k in range(len(offsets) - 1):
        block = ids[k * BLOCK : (k + 1) * BLOCK]
        a, b = int(offsets[k]), int(offsets[k + 1])
        assert chosen[a:b] == plain_words(block)
        assert unpack(words[a:b], escapes).tolist() == block


def test_file(tmp_path):
    r = random.Random(8)
    docs = [(i if i % 7 else None, [r.getrandbits(r.choice((4, 16, 62))) for _ in range(r.choice((0, 1, 50, 3000)))]) for i in range(80)] + [(99, list(range(900_000)))]
    w = Writer(f"{tmp_path}/deep/x.s8b")
    for lo in range(0, len(docs), 9):
        part = docs[lo : lo + 9]
        w.add([i for i, _ in part], np.concatenate([np.array(x, np.uint64) for _, x in part]), np.cumsum([len(x) for _, x in part]))
    w.close()
    got = [(i, s, x.tolist()) for i, s, x in read_file(f"{tmp_path}/deep/x.s8b")]
    assert [(i, x) for i, _, x in got] == docs
    assert [s for _, s, _ in got] == np.cumsum([0, *(len(x) for _, x in docs)])[:-1].tolist()


TEXTS = [None, "", " ", "\n", "a", "It's we'll  go", "a\n\nb", " lead", "trail ", "x\ty", "a\x1cb c", "one two\nthree, four.\nFive", "<|endoftext|> x", "é 中文 \U0001f600 d'été", "a\xa0b   c", "word " * 30000, "n1 22 333\n4"]


def encoded(texts):
    ids, ends = encoder(PATH).encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, ends)[:-1]]


def plainly(library, texts):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", TEXTS)
def test_encoder(library, text):
    assert encoded([text, "b c"]) == plainly(library, [text, "b c"])


def test_encoder_on_random_texts(library, monkeypatch):
    """Words, signs, letters of many scripts, every kind of white space and runs of it, at any place; and memories that overflow."""
    r = random.Random(9)
    space = [" "] * 12 + ["  ", "\n", " \n", "\t", "\r\n", "\xa0", "\u2003", "\u3000", "\x85", "\x1c", "\x1f", "\u200b", "   "]
    parts = ["word", "Word", "don't", "we'll", "'s", "'", ".", ",", "!?", "(x)", "x)", "12", "\u00b2", "\u2167", "\u00bd", "a1", "1a", "é", "ß", "中文", "\U0001f600", "\u0301", "e\u0301", "ÿ", "\ufeff", "\x00", "<|endoftext|>", "<|", "Σας", "ات", "ก็", "\u02b0", "ª"]
    texts = ["".join(r.choice(parts) + (r.choice(space) if r.random() < 0.8 else "") for _ in range(r.randrange(14))) for _ in range(4000)]
    texts += [r.choice(space) + t + r.choice(space) for t in texts[:1500]] + [None, ""]
    want = plainly(library, texts)
    assert encoded(texts) == want
    monkeypatch.setattr(type(encoder(PATH)), "REMEMBERED", 40)
    assert [x for lo in range(0, len(texts), 50) for x in encoded(texts[lo : lo + 50])] == want


def want(docs, library):
    out, start = [], 0
    for i, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, sf, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, op9_simple8b(spark, sf).collect())) == want(docs, library)


def test_edges(spark, tmp_path, library):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*d, "z") for d in data], "doc_id long, text string, tie string")
    write_token_files(docs, str(tmp_path / "a"), PATH, files=3)
    got = sorted(map(tuple, read_token_files(spark, str(tmp_path / "a")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d[0] for d in data), key=lambda i: (i is not None, i))
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert sorted((str(r[0]), tuple(r[3])) for r in got) == sorted((str(i), (*library.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in data)
    write_token_files(docs.where("false"), str(tmp_path / "b"), PATH)
    assert read_token_files(spark, str(tmp_path / "b")).collect() == []

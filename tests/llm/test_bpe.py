import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm.bpe import SuffixAutomaton, decode_bpe, digests, encode_bpe, op7_prefix_bpe, vocabulary, vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")
EDGES = [None, "", " \n\t", "It's we'll I'D", "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|> <|end", "İ ΑΣ Σ. \x85x\xa0y\x1cz w ẛ̣ é", "Ⅳ \xbd 3.14 x_y @@ --", "\U0001f600\U0001f469‍\U0001f4bb 中文あ", "aaaaaaaaaaaaaaaaaaaaaaaaa hahahahahahahaha ....!!!!!!????", "word " * 20000, "x" * 3000, "क्ष ١٢"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_automaton_finds_every_ending_sequence():
    r = random.Random(2)
    seqs = sorted({tuple(r.randrange(3) for _ in range(r.randrange(1, 6))) for _ in range(60)})
    a = SuffixAutomaton(seqs)
    text, state, size = [r.randrange(4) for _ in range(500)], 0, 0
    for i, c in enumerate(text):
        while state >= 0 and (state << 10 | c) not in a.next:
            state = a.link[state]
            size = a.length[state] if state >= 0 else 0
        state, size = (a.next[state << 10 | c], size + 1) if state >= 0 else (0, 0)
        v, found = (state if a.ends[state] >= 0 and size == a.length[state] else a.above[state]), []
        while v > 0:
            found.append(seqs[a.ends[v]])
            v = a.above[v]
        want = [s for s in seqs if tuple(text[max(0, i + 1 - len(s)) : i + 1]) == s]
        assert sorted(found) == sorted(want)


@pytest.mark.parametrize("text", EDGES)
def test_edges(library, text):
    ids = np.frombuffer(vocabulary(PATH).encode(text), np.uint32).tolist()
    assert ids == library.encode(text or "", add_special_tokens=False).ids
    assert vocabulary(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_texts(library):
    r = random.Random(4)
    letters = "abcdeiostn'.,!  \néüß中\U0001f600AEI0123"
    for _ in range(1500):
        text = "".join(r.choice(letters) for _ in range(r.randrange(60)))
        assert np.frombuffer(vocabulary(PATH).encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_batches(library, monkeypatch):
    """Many texts at once, with every kind of white space, special tokens, nulls, and a memory that overflows."""
    r = random.Random(5)
    parts = ["word", "Word,", "it's", "12", "Ⅳ", "é", "中文", "\U0001f600", "<|endoftext|>", "<|", "ΑΣ", "a1"]
    space = [" "] * 8 + ["  ", "\n", "\t", "\xa0", "\u2003", "\x85", "\x1c", "\x1f", "\u200b", ""]
    texts = ["".join(r.choice(parts) + r.choice(space) for _ in range(r.randrange(12))) for _ in range(3000)] + EDGES
    texts += [r.choice(space) + t for t in texts[:500]]
    v = vocabulary(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]

    def same(step):
        for lo in range(0, len(texts), step):
            ids, ends = v.encode_all(pa.array(texts[lo : lo + step], pa.string()))
            assert [x.tolist() for x in np.split(ids, ends)[:-1]] == want[lo : lo + step]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.view(np.int32)))
            assert v.decode_all(lists).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in want[lo : lo + step]]

    same(10_000)
    monkeypatch.setattr(type(v), "REMEMBERED", 50)
    same(100)
    assert v.decode_all(pa.array([None, [], [320]], pa.list_(pa.int32())).slice(1)).to_pylist() == ["", v.decode([320])]


def test_digests_replace_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x"), (None, None, 5, "y")], "doc_id long, text string, N_tokens int, ids_sha256 string")
    out = digests(docs, PATH)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and sorted(r.n_tokens for r in out.collect()) == [0, 2]


def test_random_words_from_tokens(library):
    r, tokens = random.Random(6), [t for t in library.get_vocab() if t.isascii() and t.removesuffix("</w>").isalpha()]
    for _ in range(5000):
        text = "".join(r.choice(tokens).removesuffix("</w>") for _ in range(r.randrange(1, 5)))
        assert np.frombuffer(vocabulary(PATH).encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_whole_table(spark, sf, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op7_prefix_bpe(spark, sf).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        want[d.doc_id] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode()))
    assert got == want


def test_frames(spark, library):
    docs = spark.createDataFrame([(i % 5 or None, t, "x") for i, t in enumerate(EDGES + EDGES)], "doc_id long, text string, IDS string")
    out = decode_bpe(encode_bpe(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for r in out.collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert decode_bpe(encode_bpe(docs.where("false"), PATH), PATH).collect() == []

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.language import ORDER, Lookup, identify, op6_ppm_language, train


def plain_tree(texts, least):
    """{context: Counter of bytes} of the contexts that hold `least` bytes or more."""
    counts = {}
    for t in texts:
        data = b" " * ORDER + t.encode()
        for i in range(ORDER, len(data)):
            for order in range(ORDER + 1):
                counts.setdefault(data[i - order : i], Counter())[data[i]] += 1
    return {c: x for c, x in counts.items() if sum(x.values()) >= least}


def plain_bits(history, s, tree):
    """PPM, method C with exclusion, by its definition."""
    bits, out = 0.0, set()
    for order in range(ORDER, -1, -1):
        context = history[len(history) - order :]
        left = {t: n for t, n in tree.get(context, {}).items() if t not in out}
        if not left:
            continue
        total, kinds = sum(left.values()), len(left)
        if s in left:
            return bits + math.log2((total + kinds) / left[s])
        bits += math.log2((total + kinds) / kinds)
        out |= set(left)
    return bits + math.log2(256 - len(out))


def test_lookup():
    codes = np.unique(np.random.default_rng(1).integers(0, 2**48, 5000).astype(np.uint64))
    found = Lookup(codes)
    assert (found(codes) == np.arange(len(codes))).all() and (found(codes + np.uint64(2**50)) == -1).all()
    assert (Lookup(codes[:0])(codes) == -1).all()


@pytest.mark.parametrize("min_share", [0.0, 0.004, 0.05])
def test_code_lengths(spark, min_share):
    r = random.Random(6)
    texts = {
        "a": ["the thing that they thought", "then", "the then the then"] + ["".join(r.choice("then tha") for _ in range(300))],
        "b": ["Él está aquí", "¿qué más?", "x1'y"] + ["".join(r.choice("qué está") for _ in range(200))],
        "c": ["中文字符中文", "हिन्दी हिन्दी भाषा"],
    }
    trees = train(spark.createDataFrame([(t, k) for k, v in texts.items() for t in v], "text string, lang string"), min_share=min_share)
    assert trees.languages == list(texts)
    probes = [t for v in texts.values() for t in v] + ["they", "que está", "\x00zz9", "ß", "", "中", "हिन्", "".join(r.choice("thenqué 中") for _ in range(400))]
    got = trees.of_texts([t.encode() for t in probes])
    for k, v in enumerate(texts.values()):
        tree = plain_tree(v, min_share * len(texts) * sum(len(t.encode()) for t in v))
        for t, bits in zip(probes, got[:, k]):
            data = b" " * ORDER + t.encode()
            assert math.isclose(bits, sum(plain_bits(data[i - ORDER : i], data[i], tree) for i in range(ORDER, len(data))), rel_tol=1e-5, abs_tol=1e-3), (k, t)


def test_lengths_are_probabilities(spark):
    trees = train(spark.createDataFrame([("the thing that they thought", "a"), ("der Hund", "b")], "text string, lang string"))
    for context in (b"thing", b"the t", b"zzzzz", b" Hund"):
        code = np.array([int.from_bytes(context + bytes([s])) for s in range(256)], np.uint64)
        assert np.allclose(np.exp2(-trees.lengths(code)).sum(axis=0), 1, atol=1e-4)


def test_whole_table(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op6_ppm_language(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    # Every prediction and score again, by the definition.
    tree = {}
    for k in sorted({d.lang for d in docs.values()}):
        own = [d.text for d in docs.values() if d.lang == k and zlib.crc32(str(d.doc_id).encode()) % 4 != 2]
        tree[k] = plain_tree(own, 0)  # at this size all contexts are in the trees
    for r in [r for r in got if len(docs[r.doc_id].text) < 2500][:60]:
        data = b" " * ORDER + docs[r.doc_id].text.encode()
        bits = {k: sum(plain_bits(data[i - ORDER : i], data[i], t) for i in range(ORDER, len(data))) for k, t in tree.items()}
        best = min(bits, key=bits.get)
        if any(map(str.isalpha, docs[r.doc_id].text)):
            assert r.lang_pred == best and math.isclose(r.score, 1 / sum(2 ** max(bits[best] - x, -1000) for x in bits.values()), abs_tol=1e-3)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)


def test_edges(spark):
    data = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "qui", None), (None, "the the and", "en"), (1, "the cat and the dog", "en")]
    docs = spark.createDataFrame([(*d, 1) for d in data], "doc_id long, text string, lang string, Score int")
    trees = train(docs)
    assert trees.languages == ["de", "en"]
    probe = spark.createDataFrame([(1, None, None, 1), (2, "", "en", 1), (3, "123 !?", "de", 1), (4, "the dog", None, 1), (5, "die Katze " * 200_000, "en", 1)], docs.schema)
    out = identify(probe, trees)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [(r.doc_id, r.lang_pred) for r in out.orderBy("doc_id").collect()] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de")]
    assert identify(docs.where("false"), trees).collect() == []
    none = train(docs.where("false"))
    assert {r.lang_pred for r in identify(docs, none).collect()} == {"und"}


@pytest.mark.parametrize("parts", [1, 5])
def test_partitions_do_not_matter(spark, sf, parts):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    a, b = train(docs), train(docs.repartition(parts))
    assert a.languages == b.languages and all((x == y).all() for x, y in zip(a.bits, b.bits))

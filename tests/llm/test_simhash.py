import random

import numpy as np
import pytest
import xxhash

from tidemark.llm.graphs import connected_components, forest
from tidemark.llm.simhash import fingerprint, near_duplicates, op4_pivot_simhash, components_of, signed


def plain_fingerprint(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(fps):
    ids = sorted(fps)
    return plain_components(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])


@pytest.mark.parametrize("text", [None, "", " \n", "One", "A b", "a b c", "É é A\x0bb c d e f", "x y z " * 300])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_forest():
    r = np.random.default_rng(1)
    i, j = r.integers(0, 300, 250), r.integers(0, 300, 250)
    want = plain_components(range(300), zip(i.tolist(), j.tolist()))
    assert forest(300, i, j).tolist() == [want[k] for k in range(300)]


def test_forest_of_paths_and_sparse_graphs():
    cases = [(11, [(1, 6), (2, 6), (2, 7), (3, 7), (3, 8), (5, 8), (5, 9), (4, 9), (4, 10), (0, 10)])]
    r = np.random.default_rng(2)
    for n in (2, 11, 40, 256):
        for _ in range(50):
            order = r.permutation(n)
            path = np.stack([order[:-1], order[1:]], axis=1)
            cases += [(n, r.permutation(path).tolist()), (n, r.integers(0, n, (r.integers(1, n + 1), 2)).tolist())]
    for n, links in cases:
        i, j = np.array(links).T
        want = plain_components(range(n), links)
        assert forest(n, i, j).tolist() == [want[k] for k in range(n)]


def test_connected_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(r.randrange(2000, 2300), r.randrange(2000, 2300)) for _ in range(200)] + [(5, 5)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long"))[0].collect()}
    want = plain_components({x for a, b in links if a != b for x in (a, b)}, links)
    assert got == want


@pytest.mark.parametrize("block", [8, 128])
def test_links_are_complete(spark, block):
    """Fingerprints at 0 to 5 bits from each other, in groups below and above a block's size."""
    r, fps = random.Random(5), {}
    for base in range(6):
        x = r.getrandbits(64)
        for _ in range(40):
            y = x
            for _ in range(r.randrange(6)):
                y ^= 1 << r.randrange(64)
            fps[len(fps)] = y
            x = y if r.random() < 0.2 else x
    slim = spark.createDataFrame([(k, signed(v)) for k, v in fps.items()], "id long, fp long")
    by_fp = {x.fp: x.component for x in components_of(slim, block=block).collect()}
    assert {k: by_fp[signed(v)] for k, v in fps.items()} == brute(fps)


def test_whole_table(spark, sf):
    docs = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op4_pivot_simhash(spark, sf).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {k: f"{v:016x}" for k, v in docs.items()}
    assert {r.doc_id: r.component_id for r in got} == brute(docs)


def test_edges(spark):
    data = [(1, None, "x"), (2, "", None), (None, "a b c d", "x"), (3, "a b c d", "y"), (3, "other words in here", "y"), (4, "A b C d", "z"), (9, "word " * 50000, "l"), (9, "word " * 50000, "l")]
    docs = spark.createDataFrame(data, "doc_id long, text string, Fingerprint string")
    got = near_duplicates(docs)
    assert got.columns == ["doc_id", "text", "fingerprint", "component_id"]
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got.collect()) == [("1", "1"), ("2", "1"), ("3", "3"), ("3", "3"), ("4", "3"), ("9", "9"), ("9", "9"), ("None", "None")]
    assert near_duplicates(docs.where("false")).collect() == []

import hashlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.line_dedup import PerfectHash, build_index, counters, drop_common_lines, hashed, op5_perfect_hash_lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(texts, n):
    lines = [(t or "").split("\n") for t in texts]
    seen = Counter(k for x in lines for k in {key(y) for y in x} if k)
    bad = {k for k, v in seen.items() if v >= n}
    return [(len(x), sum(key(y) in bad for y in x), "\n".join(y for y in x if key(y) not in bad)) for x in lines]


def hashes(r, n):
    return r.integers(0, 2**64, (n, 2), dtype=np.uint64)


@pytest.mark.parametrize("n", [0, 1, 3, 5000])
def test_perfect_hash(n):
    r = np.random.default_rng(n)
    h = hashes(r, n)
    h[n // 2 :, 0] = h[: n - n // 2, 0]  # keys that share 64 of their bits
    c = r.integers(1, 11, n).astype(np.uint8)
    p = PerfectHash.load(*PerfectHash.build(h, c).dump().values(), np.uint8)
    assert sorted(p.slots(h)) == list(range(n))
    assert (p.count(h) == c).all()
    assert np.count_nonzero(p.count(hashes(r, 20000))) < 10


def test_equal_hashes_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.build(np.ones((2, 2), np.uint64), np.ones(2, np.uint8))


def test_index_has_all_distinct_lines(spark):
    docs = spark.createDataFrame([("a\nb\nb",), ("A\nc\n",), ("a",), (None,)], "text string")
    index, shards, _ = build_index(docs, min_docs=2)
    (r,) = index.collect()
    p = PerfectHash.load(r.sizes, r.bits, r.prints, r.counts, counters(2))
    assert shards == 1 and p.count(hashed([b"a", b"b", b"c"])).tolist() == [2, 1, 1] and r.probes == 5 and len(p.counts) == 3


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d.doc_id: (a, b, hashlib.sha256(t.encode()).hexdigest()) for d, (a, b, t) in zip(docs, plain([d.text for d in docs], 10))}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op5_perfect_hash_lines(spark, sf).collect()} == want


@pytest.mark.parametrize("limits", [{}, {"shard_keys": 2}, {"shard_keys": 2, "index_bytes": 0, "probes": 3}, {"index_bytes": 0}])
def test_edges_and_ways(spark, limits):
    texts = [None, "", "\n\n", "A\nb ", "a\n\tB\r\nÉ", "b\na\na", "é\nÉ", "x\n" * 20000, "x", "c\nd\ne\nf\ng\nh", "c\nd\ne\nf\ng\nh"] + ["Solo\nA"] * 3
    docs = spark.createDataFrame([(i % 4 if i else None, t, 5, None) for i, t in enumerate(texts)], "doc_id long, text string, N_LINES int, other string")
    out = drop_common_lines(docs, min_docs=2, **limits)
    assert out.columns == ["doc_id", "text", "other", "n_lines", "n_dropped"]
    assert sorted((r.n_lines, r.n_dropped, r.text) for r in out.collect()) == sorted(plain(texts, 2))
    assert drop_common_lines(docs.where("false"), **limits).collect() == []
    assert drop_common_lines(docs, min_docs=300, min_chars=2, **limits).agg({"n_dropped": "sum"}).first()[0] == 0

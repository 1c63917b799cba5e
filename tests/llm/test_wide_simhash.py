import random
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from test_shingle_join import brute_jaccard, plain_shingles
from test_simhash import plain_components

from tidemark.llm import shingle_join, simhash
from tidemark.llm.shingle_join import near_copies
from tidemark.llm.simhash import signed, spanning, wide_pairs


def plain_print(text):
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in plain_shingles(text)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_copies_are_found_by_simhash_alone(spark, monkeypatch):
    """Without a single shingle list, texts of 0 to 6 differing bits and a similarity of 0.8 hang together, and no other texts do."""
    r, texts = random.Random(6), ["", "One", "one two"]
    for _ in range(8):
        words = [f"w{r.randrange(4000)}" for _ in range(400)]
        for _ in range(6):
            new = list(words)
            for _ in range(r.randrange(6)):
                new[r.randrange(len(new))] = f"x{r.randrange(4000)}"
            texts.append(" ".join(new))
    texts = dict(enumerate(texts))
    whole = shingle_join.listed

    def none(docs, nodes, width, least):
        out, path = whole(docs, nodes, width, least)
        return out.where("false"), path

    monkeypatch.setattr(shingle_join, "listed", none)
    groups = {}
    for x in near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect():
        groups.setdefault(x.component, []).append(x.doc_id)
    got = {i: min(g) for g in groups.values() for i in g}
    fps, similar = {k: plain_print(t) for k, t in texts.items()}, brute_jaccard(texts)
    near = [(a, b) for a in texts for b in texts if a < b and (fps[a] ^ fps[b]).bit_count() <= 6 and similar[a] == similar[b]]
    assert any((fps[a] ^ fps[b]).bit_count() > 3 for a, b in near)
    assert all(got[a] == got[b] for a, b in near)
    assert all(similar[i] == similar[c] for i, c in got.items())


@pytest.mark.parametrize("block", [8, 512])
def test_wide_pairs(spark, monkeypatch, block):
    """Fingerprints at 0 to 14 bits from each other, some equal, and sizes that part some of them."""
    monkeypatch.setattr(simhash, "WIDE_BLOCK", block)
    r, rows = random.Random(7), []
    for base in range(30):
        x, size = r.getrandbits(64), r.choice([1, 40, 1000])
        for _ in range(r.choice([2, 5, 30])):
            y = x
            for b in r.sample(range(64), r.randrange(8)):
                y ^= 1 << b
            rows.append((len(rows), y, size if base % 3 else r.choice([size, 2 * size])))
    size_of = {}
    rows = [(k, f, size_of.setdefault(f, n)) for k, f, n in rows]
    pairs, paths = wide_pairs(spark.createDataFrame([(k, signed(f), n) for k, f, n in rows], "row long, fp long, size int"), Fraction("0.8"))
    got = {(x.a, x.b) for x in pairs.collect()}
    far = lambda a, b: (rows[a][1] ^ rows[b][1]).bit_count() if 5 * min(rows[a][2], rows[b][2]) >= 4 * max(rows[a][2], rows[b][2]) else 64
    assert all(a < b and far(a, b) <= simhash.REACH for a, b in got)
    found = plain_components(range(len(rows)), got)
    all_pairs = [(a, b, far(a, b)) for b in range(len(rows)) for a in range(b)]
    assert all(found[a] == found[b] for a, b, d in all_pairs if d <= 6)
    assert any(d > 6 and (a, b) in got for a, b, d in all_pairs)
    assert len(got) < sum(d <= simhash.REACH for *_, d in all_pairs)


def test_spanning():
    r = np.random.default_rng(3)
    for n in (2, 11, 60):
        for _ in range(30):
            i, j, far = r.integers(0, n, 2 * n), r.integers(0, n, 2 * n), r.integers(0, 5, 2 * n)
            at = spanning(n, i, j, far)
            for d in range(5):
                want = plain_components(range(n), zip(i[far <= d].tolist(), j[far <= d].tolist()))
                some = at[far[at] <= d]
                assert plain_components(range(n), zip(i[some].tolist(), j[some].tolist())) == want
                assert len(some) == n - len(set(want.values()))

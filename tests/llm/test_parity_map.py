import random

import numpy as np
from test_shingle_join import brute_jaccard

from tidemark.llm import shingle_join
from tidemark.llm.shingle_join import near_copies, parity_map


def test_parity_map_differs_in_no_more_bits_than_the_sets():
    r = np.random.default_rng(4)
    for n in (0, 1, 30, 400, 6000):
        for changed in (0, 1, n // 10, n):
            s = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
            t = np.union1d(s[changed:], r.integers(0, 2**63, changed).astype(np.uint64))
            differ = int(np.bitwise_count(np.frombuffer(parity_map(s), np.uint64) ^ np.frombuffer(parity_map(t), np.uint64)).sum())
            assert differ <= len(np.setxor1d(s, t)) and (differ - len(np.setxor1d(s, t))) % 2 == 0


def test_a_crowd_below_the_threshold(spark, monkeypatch):
    """300 copies of a text, most at a similarity of 0.6 to 0.8 from each other: few of their pairs are left to be verified, and all links are found."""
    r, texts = random.Random(8), []
    words = [f"w{i}" for i in range(150)]
    for _ in range(300):
        new = list(words)
        for _ in range(r.choice([1, 3, 4, 5])):
            new[r.randrange(len(new))] = f"x{r.randrange(9)}"
        texts.append(" ".join(new))
    texts, compared, verified = dict(enumerate(texts)), [], shingle_join.verified

    def counted(pairs, *rest):
        compared.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(shingle_join, "verified", counted)
    groups = {}
    for x in near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        groups.setdefault(x.component, []).append(x.doc_id)
    want = brute_jaccard(texts)
    assert {i: min(g) for g in groups.values() for i in g} == want
    across = sum(want[a] != want[b] for a in texts for b in texts if a < b)
    assert across > 1000 and compared[-1] < 0.2 * across

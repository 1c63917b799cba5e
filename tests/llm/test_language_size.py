"""What learning and sending op6's context trees takes, and that it changes nothing."""

import pickle

import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.language import ORDER, Lookup, train


def shuffled(spark, f):
    """What f() returns, and how many rows were written to shuffles meanwhile."""
    sc = spark.sparkContext

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        every = sc._jvm.java.util.ArrayList()
        found = sc._jsc.sc().statusStore().stageList(every, False, False, sc._gateway.new_array(sc._jvm.double, 0), every)
        return {s.stageId(): s.shuffleWriteRecords() for s in (found.apply(i) for i in range(found.size()))}

    before = max(stages(), default=-1)
    out = f()
    return out, sum(n for k, n in stages().items() if k > before)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").coalesce(1).cache()


@pytest.fixture(scope="module")
def grams(docs):
    """Distinct (language, byte with the ORDER before it)."""
    out = set()
    for r in docs.collect():
        data = b" " * ORDER + r.text.encode()
        out |= {(r.lang, data[i - ORDER : i + 1]) for i in range(ORDER, len(data))}
    return out


def test_grams_are_shuffled_once(spark, docs, grams):
    """Not again for each order: shuffle files stay until the driver's JVM collects its garbage."""
    _, rows = shuffled(spark, lambda: train(docs))
    assert rows < 2 * len(grams)


def test_trees_are_sent_packed(docs):
    trees = train(docs)
    sent = pickle.dumps(trees)
    plain = sum(x.nbytes for k in (trees.bits, trees.seen, trees.inside, trees.outside) for x in k) + sum(x.keys.nbytes + x.places.nbytes for x in trees.grams + trees.contexts)
    assert len(sent) < 0.4 * plain
    got, probes = pickle.loads(sent), [b"", b"the thing", "qué está, Straße".encode(), bytes(range(256))]
    assert got.languages == trees.languages and (got.of_texts(probes) == trees.of_texts(probes)).all()


def test_lookup_is_sent_by_its_numbers():
    codes = np.unique(np.random.default_rng(2).integers(0, 2**48, 3000).astype(np.uint64))
    for c in (codes, codes[:1], codes[:0]):
        assert (pickle.loads(pickle.dumps(Lookup(c)))(codes) == Lookup(c)(codes)).all()


@pytest.mark.parametrize("held", [0, 5000])
def test_counts_handed_on_and_added_up_in_parts(docs, monkeypatch, held):
    whole = train(docs, min_share=1e-4)
    monkeypatch.setattr(language, "HELD", held)
    parts = train(docs.repartition(3), min_share=1e-4)
    assert whole.languages == parts.languages
    for a, b in zip(whole.grams + whole.contexts, parts.grams + parts.contexts):
        assert (a.keys == b.keys).all()
    assert all((x == y).all() for k in ("bits", "seen", "inside", "outside") for x, y in zip(getattr(whole, k), getattr(parts, k)))

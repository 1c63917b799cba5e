import math
import re

import pytest
import xxhash

from tidemark.llm.quality_rules import BINS, PSEUDO, SMOOTHING, THRESHOLD, assess, op10_likelihood_ratio, trusted_ids

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", t or "")


def plain_base(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if words(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    hit = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def long_hash(x, seed):
    return xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)


def bins(text, n):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(text)]
    return [signed(x) % n for x in h] + [signed(long_hash(y, long_hash(x, 42))) % n for x, y in zip(h, h[1:])]


def plain(docs, good, n=BINS):
    raw, target = [0] * n, [0] * n
    for i, t in docs:
        for b in bins(t, n):
            raw[b] += 1
            target[b] += i in good
    r, g = sum(raw), sum(target)
    ratio = [math.log((1 - SMOOTHING) * (y + PSEUDO) / (x * g / r + PSEUDO) + SMOOTHING) if g and x else 0.0 for x, y in zip(raw, target)]
    out = []
    for i, t in docs:
        base, b = plain_base(t), bins(t, n)
        llr = sum(ratio[k] for k in b) / len(b) if b else 0.0
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        out.append((i, *base, failed, not failed and llr >= THRESHOLD, llr))
    return out


def same(got, want):
    got, want = (sorted(x, key=str) for x in (got, want))
    assert [g[:8] for g in got] == [w[:8] for w in want]
    assert all(math.isclose(g[8], w[8], abs_tol=1e-9) for g, w in zip(got, want))


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    got = [tuple(r) for r in op10_likelihood_ratio(spark, sf).collect()]
    same([(r[0], *r[1:6], r[6], r[7], r[8]) for r in got], plain(docs, good))


@pytest.mark.parametrize("labels", [[(1, 1, 0), (2, 1, 1), (3, 1, None), (3, 0, 0), (None, 1, 0)], []])
def test_edges(spark, labels):
    long = " ".join(f"w{i % 700}" for i in range(30000))
    data = [(1, "a b c d e f g h " * 4 + "x\ny\ny\n \n \nz"), (2, None), (3, ""), (4, "\n\t "), (None, "# <b> | é " * 9), (5, "é*\x0bü\x0c" * 15), (5, "é*\x0bü\x0c" * 15), (6, long)]
    docs = spark.createDataFrame([(*d, "old", 1) for d in data], "doc_id long, text string, kept string, `target` int")
    good = trusted_ids(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = assess(docs, good)
    assert got.columns.count("kept") == 1 and "target" in got.columns
    same([(r.doc_id, *(r[c] for c in COUNTS), r.base_failed, r.kept, r.llr) for r in got.collect()], plain(data, {1} if labels else set()))
    assert [tuple(r) for r in assess(docs, good, max_broadcast=0).orderBy("doc_id", "text").collect()] == [tuple(r) for r in got.orderBy("doc_id", "text").collect()]
    assert assess(docs.where("false"), good).collect() == []


def test_labelled_documents(spark):
    """At two sizes, what labels call good stays, and what they call bad (and the base rules let pass) mostly goes."""
    for name, caught in (("sf0.01", 0.85), ("sf0.1", 0.93)):
        labels = {r.doc_id: r for r in spark.read.parquet(f"/root/testdata/{name}/labels.parquet").collect()}
        out = [r for r in op10_likelihood_ratio(spark, f"/root/testdata/{name}").collect() if r.doc_id in labels and not r.base_failed]
        good, bad = ([r.kept for r in out if labels[r.doc_id].quality == x and not (x and labels[r.doc_id].toxic)] for x in (1, 0))
        assert sum(good) >= 0.99 * len(good) and sum(bad) <= (1 - caught) * len(bad), (name, sum(good) / len(good), sum(bad) / len(bad))

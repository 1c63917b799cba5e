import hashlib
import itertools
import math

import duckdb
import pytest

from tidemark.llm.mixing import OP8_SQL, mix, op8_poisson_replication, poisson_at, rates


def plain(rows, weights, size=1.0, seed=11, default=0.0):
    """rows: (id, text, source)."""
    part = lambda x: "-" if x is None else f"={x}"
    md5 = lambda s, *x: hashlib.md5("|".join([str(s), *map(part, x)]).encode()).hexdigest()
    have = {}
    for _, t, s in rows:
        have[s] = have.get(s, 0) + len((t or "").encode()) + 1
    share = {s: (weights or {}).get(s or "", 1.0 if weights is None else default) for s in have}
    out = []
    for i, t, s in rows:
        if not sum(share.values()):
            break
        mean = share[s] / sum(share.values()) * sum(have.values()) * size / have[s]
        own = md5(seed, i, t)
        u, k, at = int(own[:13], 16) / 2**52, 0, math.exp(-mean)
        while mean and at <= u:
            k += 1
            at += math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
        out += [(i, t, s, k, c, md5(seed + 1, own, c)) for c in range(1, k + 1)]
    return sorted(out, key=str)


def got(df):
    return [(r.doc_id, r.text, r.source, r.n_copies, r["copy"], r.order_key) for r in df.collect()]


@pytest.mark.parametrize("mean", [0.0, 1e-6, 0.3, 5.0, 399.9, 400.0, 900.0, 2e5])
def test_poisson_at(spark, mean):
    from pyspark.sql import functions as F

    us = [0.001, 0.1, 0.5, 0.9, 0.999, 1 - 2**-52]
    term = lambda j: math.exp(-mean + (j * math.log(mean) if j else 0) - math.lgamma(j + 1)) if mean else float(j == 0)
    top = int(mean + 10 * math.sqrt(mean) + 30)
    cdf = list(itertools.accumulate(term(j) for j in range(top)))
    got = [r.n for r in spark.createDataFrame([(u,) for u in us], "u double").select(poisson_at(F.lit(mean), F.col("u")).alias("n")).collect()]
    assert got[:-1] == [sum(c <= u for c in cdf) for u in us[:-1]] and got[-1] <= top


def test_one_short_document_among_many(spark):
    """A source of one short document whose mean is large: as many copies as it asks for."""
    docs = spark.createDataFrame([(i, "word " * 8, "a") for i in range(20000)] + [(-1, "x", "b")], "doc_id long, text string, source string")
    out = mix(docs, {"a": 1, "b": 1})
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["b"] - 205000) < 3000 and abs(n["a"] - 10000) < 500


def test_whole_table_and_sql(spark, sf):
    from tidemark.llm.mixing import DEFAULT, WEIGHTS

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = got(op8_poisson_replication(spark, sf))
    assert [x[5] for x in out] == sorted(x[5] for x in out)
    assert sorted(out, key=str) == plain(rows, WEIGHTS, default=DEFAULT)
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    sql = c.execute(f"select doc_id, text, source, n_copies, copy, order_key from ({OP8_SQL})").fetchall()
    assert sorted(map(tuple, sql), key=str) == sorted(out, key=str)


DATA = [(i, "x" * (i % 9), f"s{i % 3}") for i in range(300)] + [(None, None, None), (None, "t", None), (5, None, "s1"), (5, "", "s1"), (7, "y" * 99999, "s2"), (8, "same", "s0"), (8, "same", "s0")]


@pytest.mark.parametrize("weights,size,few", [(None, None, 100), ({"s0": 3, "s1": 1, "nowhere": 5, "": 2}, 4.0, 0), ({"nowhere": 1.0}, None, 100)])
def test_edges(spark, weights, size, few):
    docs = spark.createDataFrame([(*d, "z") for d in DATA], "doc_id long, text string, source string, Copy string")
    out = mix(docs, weights, size=size, max_broadcast=few)
    assert out.columns == ["doc_id", "text", "source", "n_copies", "copy", "order_key"]
    assert sorted(got(out), key=str) == plain(DATA, weights, size or 1.0)
    assert [x[5] for x in got(out)] == sorted(x[5] for x in got(out))
    assert got(mix(docs.where("false"), weights)) == []
    other = mix(docs, {"s0": 2.0}, default=1.0, max_broadcast=few)
    assert sorted(got(other), key=str) == plain(DATA, {"s0": 2.0}, default=1.0)


def test_expected_bytes(spark):
    docs = spark.createDataFrame([(i, "word " * 4, "a" if i % 3 else "b") for i in range(20000)], "doc_id long, text string, source string")
    n = {r.source: r["count"] for r in mix(docs, {"a": 1, "b": 3}).groupBy("source").count().collect()}
    assert abs(n["a"] - 5000) < 300 and abs(n["b"] - 15000) < 500
    assert {r.source: r.mean for r in rates(docs, {"a": 1, "b": 3})[0].collect()}.keys() == {"a", "b"}

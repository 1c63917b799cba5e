import math
import os

import numpy as np
import pytest

from tidemark.llm.embeddings import near_duplicates, op1_pivot_permutation, unit


def brute(rows, least=0.98):
    """rows: (id, vector, label) -> {row: (id, n_links, component)}."""
    ok = [i for i, (k, v, lab) in enumerate(rows) if k is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    up = {i: i for i in range(len(rows))}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    n = [0] * len(rows)
    for x, a in enumerate(ok):
        for b in ok[x + 1 :]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                u, v = np.array(rows[a][1], "f8"), np.array(rows[b][1], "f8")
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= least:
                    n[a] += 1
                    n[b] += 1
                    up[max(root(a), root(b), key=lambda i: rows[i][0])] = min(root(a), root(b), key=lambda i: rows[i][0])
    return sorted(((rows[i][0], n[i], rows[root(i)][0]) for i in range(len(rows))), key=str)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def test_whole_table(spark, sf):
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(op1_pivot_permutation(spark, sf)) == brute(rows)


def planted(seed=1, d=32):
    r, out = np.random.default_rng(seed), []
    for g in range(12):
        base = r.normal(size=d)
        for _ in range([1, 2, 3, 90][g % 4]):
            v = base + r.normal(size=d) * 0.11 * (g % 3)
            out.append((v / np.linalg.norm(v)).astype("f4").tolist())
    return out


@pytest.mark.parametrize("block", [16, 256])
def test_recall_and_edges(spark, block):
    vs = planted()
    rows = [(i, v, i % 2) for i, v in enumerate(vs)] + [(1000 + i, vs[5], 1) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * 32, 1), (2002, vs[5][:31] + [None], 1), (2003, vs[5][:31] + [float("nan")], 1), (2004, vs[5][:31] + [float("inf")], 1), (2005, vs[5], None), (None, vs[5], 1), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (2009, [3 * x for x in vs[5]], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, n string")
    want, have = brute([(a, b and [float(np.float32(x)) if x is not None else None for x in b], c) for a, b, c in rows]), got(near_duplicates(df, block=block))
    assert [x[0] for x in have] == [x[0] for x in want]
    found, true = sum(x[1] for x in have), sum(x[1] for x in want)
    assert 0.99 * true <= found <= true and (found < true or have == want)
    assert got(near_duplicates(df.where("false"))) == []


LINKED = "/root/testdata/check_s"


@pytest.mark.skipif(not os.path.exists(f"{LINKED}/embeddings.parquet"), reason="no table with links")
@pytest.mark.parametrize("pivots", [None, 1024])
def test_recall_on_a_table_with_links(spark, pivots):
    """Every link of a whole table by all pairs in double precision; n_links can only fall short, and by little."""
    rows = spark.read.parquet(f"{LINKED}/embeddings.parquet").collect()
    by = {}
    for r in rows:
        if r.label is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding):
            by.setdefault(r.label, []).append((r.vec_id, r.embedding))
    want = {r.vec_id: 0 for r in rows}
    for group in by.values():
        x = unit(np.array([v for _, v in group]))
        for k, row in enumerate((x @ x.T >= 0.98).sum(axis=1) - 1):
            want[group[k][0]] += int(row)
    got = {r.vec_id: r.n_links for r in near_duplicates(spark.read.parquet(f"{LINKED}/embeddings.parquet"), pivots=pivots).collect()}
    assert got.keys() == want.keys() and sum(want.values()) > 10_000 and all(got[k] <= want[k] for k in want)
    assert sum(got.values()) >= 0.99 * sum(want.values()), sum(got.values()) / sum(want.values())

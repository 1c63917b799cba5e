import zlib

import pytest

from tidemark.llm.sharding import op3_external_shuffle, permuted, shuffle_into_shards

SCHEMA = "doc_id long, text string, shard string, `a b` int"


def rows(df):
    return [(r.doc_id, r.text, r.shard, r.slot) for r in df.collect()]


def test_permuted_is_a_permutation():
    assert sorted(permuted(1000, 1, 2)) == list(range(1000))
    assert list(permuted(50, 1, 2)) != list(permuted(50, 1, 3))


def test_whole_table(spark, sf):
    got = op3_external_shuffle(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in docs.items()}
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


@pytest.mark.parametrize("bucket_bytes", [60, 200, 2000, 1 << 20])
def test_edges_and_partition_invariance(spark, tmp_path, bucket_bytes):
    """Input and exchange may be partitioned in any way, with many equal rows, too: every row keeps its place."""
    data = [(i, "word " * (i % 40), "x", 1) for i in range(200)] + [(None, None, None, None)] * 3 + [(7, "", "y", 2), (None, "é", "z", 3)] + [(500, "same", "s", 4)] * 300 + [(500, "same", "s", None)] * 90
    data += [(9, "long " * 5000, "l", 5)]
    got = [rows(shuffle_into_shards(spark.createDataFrame(data, SCHEMA).repartition(k), str(tmp_path / str(k)), shards=5, bucket_bytes=bucket_bytes, partitions=p)) for k, p in ((1, 10**6), (7, 4))]
    for g in got:
        assert sorted(map(str, ((a, b) for a, b, _, _ in g))) == sorted(map(str, ((a, b) for a, b, _, _ in data)))
        n = [sum(x[2] == s for x in g) for s in range(5)]
        assert max(n) - min(n) <= 1 and all(sorted(x[3] for x in g if x[2] == s) == list(range(n[s])) for s in range(5))
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))


def test_equal_rows_are_spread(spark, tmp_path):
    """Copies that overfill a bucket don't stay side by side, and the place of all other rows in their order stays as it is."""
    single = [(i, f"t{i}", "x", 1) for i in range(400)]
    orders = []
    for k, data in enumerate((single, single + [(-1, "copy", "x", 1)] * 600)):
        found = sorted(rows(shuffle_into_shards(spark.createDataFrame(data, SCHEMA), str(tmp_path / str(k)), shards=1, bucket_bytes=10**9 if k == 0 else 300)), key=lambda r: r[3])
        orders.append([r[0] for r in found])
    at = [k for k, i in enumerate(orders[1]) if i == -1]
    assert len(at) == 600 and max(b - a for a, b in zip(at, at[1:])) < 100 and at[0] < 200 and at[-1] > 800
    assert sorted(i for i in orders[1] if i >= 0) == sorted(orders[0])


def test_empty(spark, tmp_path):
    assert rows(shuffle_into_shards(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))) == []

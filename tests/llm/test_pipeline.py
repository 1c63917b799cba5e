import itertools
import re

import corpus_pipeline
from pyspark.sql import functions as F
from test_line_dedup import plain as plain_lines
from test_mixing import plain as plain_mix
from test_quality_rules import plain as plain_quality
from tokenizers import Tokenizer

from tidemark.llm.bpe import vocabulary_path
from tidemark.llm.mixing import DEFAULT, WEIGHTS


def plain_groups(texts, width=5, least=0.8):
    """Smallest id of each text's group: all pairs, Jaccard similarity of the sets of 5-word shingles."""
    words = {k: [w for w in re.split("[ \t-\r]+", t.translate(LOWER)) if w] for k, t in texts.items()}
    sets = {k: {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for k, w in words.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if (not x and not y) or (x and y and 5 * len(x & y) >= 4 * len(x | y)):
            i, j = find(a), find(b)
            root[max(i, j)] = min(i, j)
    return {k: find(k) for k in sets}


LOWER = {c: c + 32 for c in range(65, 91)}


def plain_run(docs, good):
    kept = {r[0] for r in plain_quality([(d.doc_id, d.text) for d in docs], good) if r[7]}
    docs = [d for d in docs if d.doc_id in kept]
    texts = {d.doc_id: t for d, (_, _, t) in zip(docs, plain_lines([d.text for d in docs], 10))}
    first = plain_groups(texts)
    stay = [(d.doc_id, texts[d.doc_id], d.source) for d in docs if first[d.doc_id] == d.doc_id]
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    out = []
    for i, t, *_ in plain_mix(stay, WEIGHTS, default=DEFAULT):
        ids = library.encode(t, add_special_tokens=False).ids
        out.append((i, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    return sorted(out), {s[0] for s in stay}


def test_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    want, stay = plain_run(docs, good)
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    assert 0.5 * len(docs) < len(stay) < len(docs)


def test_columns_and_edges(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    long = " ".join(f"The w{i}" for i in range(30))
    data = [(1, long, "en", "src1", 5), (2, long, None, "src2", 5), (None, long + " x", "en", None, None), (3, None, None, None, None), (3, "", "", "", 0), (1, long, "en", "src1", 5)]
    data += [(i, "The very long one " + " ".join(f"w{i * 7 % 9973} x{i}" for i in range(60_000)), "en", "other", 1) for i in (20, 21)]
    for rows in (data, []):
        docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit(c) for c in ("row", "Kept", "copy", "component", "ids", "n_lines", "order_key")})
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            if name != "bpe":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            if name == "simhash_dedup" and rows:
                assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "20"]
            docs.collect()

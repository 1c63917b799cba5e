import random

import corpus_pipeline
import pytest
from test_simhash import plain_components

from tidemark.llm import shingle_join
from tidemark.llm.shingle_join import near_copies


def plain_shingles(text, width=5):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_jaccard(texts, least=0.8):
    """{id: text} -> {id: smallest id reachable over pairs of a 5-word Jaccard similarity of least or more}."""
    sets = {k: plain_shingles(t) for k, t in texts.items()}
    having = {}
    for k, s in sets.items():
        for g in s or [()]:
            having.setdefault(g, []).append(k)
    meet = {(a, b) for some in having.values() for a in some for b in some if a < b}
    return plain_components(sets, [(a, b) for a, b in meet if sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= round(10 * least) * len(sets[a] | sets[b])])


def copies(r, crowd):
    """Texts with near copies around the threshold, chains, a crowd, short texts and long ones."""
    texts = []
    for base in range(12):
        words = [f"w{r.randrange(400)}" for _ in range(r.choice([3, 5, 9, 14, 60, 300]))]
        for _ in range(crowd if base == 0 else r.randrange(1, 8)):
            new = list(words)
            for _ in range(r.randrange(1 + max(1, len(words) // 30))):
                new[r.randrange(len(new))] = f"x{r.randrange(1000)}"
            texts.append(" ".join(new))
            words = new if r.random() < 0.3 else words
    shared = " ".join(f"s{i}" for i in range(40))
    texts += [shared + " " + " ".join(f"t{i}-{j}" for j in range(n)) for i, n in enumerate([3, 4, 5, 5, 6, 9, 12, 30])]
    return [*texts, None, "", " \n", "One", "one", "a b c d", "A b\tc D", "é É w"]


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 4), (3, 4)])
def test_against_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "BUCKET", 700)
    texts = dict(enumerate(copies(random.Random(seed), 40)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = near_copies(docs).collect()
    groups = {}
    for x in rows:
        groups.setdefault(x.component, []).append(x.doc_id)
    assert len(rows) == len(texts)
    assert {i: min(g) for g in groups.values() for i in g} == brute_jaccard(texts)


def test_stage_against_all_pairs(spark):
    """Copies with a word in forty changed: far beyond 3 bits of a fingerprint, at a similarity of about 0.8."""
    texts = dict(enumerate(t for t in copies(random.Random(4), 40)))
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    want = {i for i, c in brute_jaccard(texts).items() if i == c}
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()) == sorted(want)


def test_one_row_of_each_group(spark):
    """Repeated rows, a repeated id with other texts, and null ids."""
    long = " ".join(f"The w{i}" for i in range(30))
    other = " ".join(f"An v{i}" for i in range(30))
    texts = [(1, long), (1, long), (None, long), (2, other), (2, "of its own"), (3, other), (None, "alone here"), (None, "alone here"), (4, None), (4, ""), (None, " ")]
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.simhash_dedup(spark, docs, "").collect()
    assert sorted((str(r.doc_id), (r.text or "").strip()) for r in got) == sorted([("1", long), ("2", other), ("2", "of its own"), ("None", "alone here"), ("4", "")])

"""Quality classifier: hierarchical empirical Bayes over sites.

A logistic model of a text's own features gives each document's evidence (log odds of being good). The mean
evidence of its host and of its path within the host are estimated with shrinkage: a path towards its host, a host
towards the global mean, each by as many pseudo-documents as the variances within and between the groups call for
(analysis of variance from grouped sums over all documents). A document's own evidence is left out of its site's. The posterior
log odds are the document's own plus what its path's odds add to the global odds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, q, remove, table, unused, without, written

#: Labelled rows that the logistic model is fitted on, at most: those whose ids have the least hashes.
FIT_ROWS = 20_000
RIDGE = 1.0
#: Bounds of the pseudo-documents of a prior, of a document's log odds, and of rates before they become odds.
STRENGTH, CLIP, EDGE = (1.0, 1e6), 20.0, 1e-4

FEATURES = ("log_words", "symbols", "capitals", "distinct", "top_word", "stutter", "word_length", "digits", "bare_words", "ended_lines", "dup_lines", "stops", "short_words")


def features(text: str | None) -> list[float]:
    """The numbers that the logistic model sees, over the whole text (all 0 without a word)."""
    text = text or ""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, text))
    return [
        float(np.log1p(n)),
        sum(map(text.count, "#*$%&|<>!")) / size,
        sum(map(str.isupper, text)) / max(1, letters),
        len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        float(np.log(sum(map(len, words)) / n)),
        sum(map(str.isdigit, text)) / size,
        sum(not any(map(str.isalpha, w)) for w in words) / n,
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines),
        1 - len(set(lines)) / len(lines),
        (text.count(".") + text.count(",")) / n,
        sum(len(w) <= 3 for w in words) / n,
    ]


@dataclass
class Logistic:
    """Weights on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 30) -> Logistic:
        """Newton's method with a ridge. Labels of one kind only, or none, give the log odds of their share alone."""
        n, d = x.shape if len(x) else (0, len(FEATURES))
        mean, scale = (x.mean(axis=0), x.std(axis=0)) if n else (np.zeros(d), np.ones(d))
        scale = np.where(scale > 1e-9, scale, 1.0)
        w = np.zeros(d + 1)
        w[0] = np.log((y.sum() + 1) / (n - y.sum() + 1))
        if 0 < y.sum() < n:
            z = np.column_stack((np.ones(n), (x - mean) / scale))
            penalty = np.diag([1e-6] + [ridge] * d)
            for _ in range(steps):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -CLIP, CLIP)))
                step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
                w = w + step
                if np.abs(step).max() < 1e-8:
                    break
        return cls(mean, scale, w)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + (x - self.mean) / self.scale @ self.weights[1:], -CLIP, CLIP)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> Logistic:
    """The model of at most `rows` labelled documents. Null labels and ids don't count; an id labelled both ways counts as bad."""
    sample = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = sample.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("y"))
    found = docs.select(q(id_col).alias("own_id"), q(text_col).alias("text")).join(F.broadcast(sample), F.col("own_id") == F.col("label_id"))  # `rows` rows at most

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([features(t.as_py()) for t in b.column(2)], pa.list_(pa.float64()))], names=["id", "y", "x"])

    # Several rows of an id are one row of the sample each; least and greatest features stand for them, so their number doesn't matter.
    got = found.select(F.col("own_id").cast("long").alias("id"), "y", "text").mapInArrow(measured, "id long, y double, x array<double>").groupBy("id").agg(F.first("y").alias("y"), F.min("x").alias("x")).orderBy("id").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return Logistic.fit(x, got["y"].to_numpy().astype(float))


def site_of(url: Column) -> tuple[Column, Column]:
    """Host (lower case, without www.) and path (the first segment) of a URL; null where it has none."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.regexp_replace(host, "^www\\.", ""), F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), "^/([^/]*)", 1)


def _strength(within: float, free_within: float, between: float, free_between: float, size: float) -> float:
    """Pseudo-documents of a prior: variance within groups over variance between their true means."""
    if free_within <= 0 or free_between <= 0 or within <= 0:
        return STRENGTH[1] if between <= 0 else STRENGTH[0]
    noise = within / free_within
    spread = (between / free_between - noise) / max(size, 1e-9)
    return float(np.clip(noise / spread, *STRENGTH)) if spread > 0 else STRENGTH[1]


def odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, model: Logistic, host: Column, path: Column, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep) with evidence, host_rate, path_rate, quality_score (doubles) and kept (score of a half or more).

    host and path are columns of docs; null is a site like any other. host_rate and path_rate are the posterior means
    for the document's site without the document itself. A null or wordless text has the evidence of features 0. Null and repeated ids
    are rows like any other. Input columns of the new names are replaced. An empty table gives an empty result. Only
    sums by site are shuffled, added up within each task first, and the documents' own columns to meet them, in pieces where a site is hot.
    """
    new = ("evidence", "host_rate", "path_rate", "quality_score", "kept")
    bounded_batches(docs.sparkSession)
    h, p = unused(docs, "host", "path")
    docs = docs.withColumn(h, host.cast("string")).withColumn(p, path.cast("string"))
    low = {n.lower() for n in new}
    kept = [c for c in (docs.columns[:-2] if keep is None else keep) if c.lower() not in low]
    source = docs.select(*[q(c) for c in kept], q(h), q(p), *([] if text_col in kept else [q(text_col)]))
    at, n = source.columns.index(text_col), len(kept) + 2

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(at)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(model.log_odds(x))], names=[*kept, h, p, "evidence"])

    scored, _ = written(source.mapInArrow(measured, T.StructType([*source.schema.fields[:n], T.StructField("evidence", T.DoubleType())])), "evidence", "zstd")
    rate = 1 / (1 + F.exp(-F.col("evidence")))
    paths, p1 = written(scored.groupBy(q(h).alias("h"), q(p).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum(rate).alias("s"), F.sum(rate * rate).alias("ss")), "paths")
    hosts, p2 = written(paths.groupBy(F.col("h").alias("h2")).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("ss").alias("hss"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("by_path"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.count(F.lit(1)).alias("paths")), "hosts")
    g = hosts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("hn", "hs", "hss", "by_path", "paths")], F.count(F.lit(1)).alias("hosts"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("by_host"), F.sum(F.col("hn") * F.col("hn")).alias("hn2"), F.sum(F.col("n2") / F.col("hn")).alias("n2_by_host")).first()
    total, mean = g["hn"], (g["hs"] / g["hn"] if g["hn"] else 0.5)
    if total:
        k_path = _strength(g["hss"] - g["by_path"], total - g["paths"], g["by_path"] - g["by_host"], g["paths"] - g["hosts"], (total - g["n2_by_host"]) / max(1.0, g["paths"] - g["hosts"]))
        k_host = _strength(g["hss"] - g["by_host"], total - g["hosts"], g["by_host"] - g["hs"] ** 2 / total, g["hosts"] - 1, (total - g["hn2"] / total) / max(1, g["hosts"] - 1))
    else:
        k_path = k_host = 1.0
    sites, p3 = written(paths.join(hosts, F.col("h").eqNullSafe(F.col("h2"))).select("h", "p", "n", "s", "hn", "hs"), "sites")
    out = scored.join(sites, q(h).eqNullSafe(F.col("h")) & q(p).eqNullSafe(F.col("p")))
    own = 1 / (1 + F.exp(-F.col("evidence")))
    out = out.withColumn("host_rate", (F.col("hs") - own + k_host * mean) / (F.col("hn") - 1 + k_host))
    out = out.withColumn("path_rate", (F.col("s") - own + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path))
    final = F.col("evidence") + odds(F.col("path_rate")) - odds(F.lit(mean))
    out = out.withColumn("quality_score", 1 / (1 + F.exp(-final))).withColumn("kept", F.col("quality_score") >= 0.5)
    remove(docs.sparkSession, p1, p2)
    return out.select(*[q(c) for c in kept], *new)


def op2_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of all documents: their source is the host, its part in one language the path."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model, F.col("source"), F.col("lang"), keep=["doc_id"])

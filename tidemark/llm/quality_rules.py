"""Quality rules: base counts of every text, and a hashed n-gram log-likelihood ratio. DataFrame operations only.

Two multinomials over the hashed words and word pairs of whole texts are counted by grouped aggregation: one over the trusted target
documents, one over the whole raw corpus. A bin's ratio is the target's count over what the raw distribution would have put
there, both with the same pseudo-count, so a bin that the target is too small to say anything of is neutral, in small
corpora as in large ones. A document's ratio is the mean of the logarithms over all its n-grams, so long and short texts compare; a
document is kept if it reaches a fixed threshold.
The only table sent to all tasks without a check of its size is the array of log ratios: one double a hash bin, a bound that doesn't
depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import q, remove, stays, table, unused, without, written

#: Hash bins of the n-grams.
BINS = 1 << 16
#: Share of the raw distribution mixed into the target's, so that a ratio is never below the logarithm of it, at any size.
SMOOTHING = 0.01
#: Pseudo-count added to a bin's count in the target and to the one expected there.
PSEUDO = 10.0
#: Least mean log ratio of a kept document.
THRESHOLD = -0.1
#: Trusted ids up to this many are sent to all tasks; beyond it, documents meet them by a shuffle.
BROADCAST_IDS = 1_000_000
#: Words of a window in the rule on repetition.
WINDOW = 8

SPACE = "[ \\t-\\r]+"


def words_of(text: Column) -> Column:
    """Array of the runs of anything but ASCII white space in a whole text (null: none)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def ngram_bins(hashes: Column, bins: int = BINS) -> Column:
    """Hash bins of all words and of all pairs of words side by side, from the words' hashes."""
    pairs = F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0)))
    at = lambda x: F.pmod(x, F.lit(bins)).cast("int")
    return F.concat(F.transform(hashes, at), F.transform(pairs, lambda x, i: at(F.xxhash64(x, F.get(hashes, i + 1)))))


def with_base(docs: DataFrame, text: Column, out: dict[str, str], window: int = WINDOW) -> DataFrame:
    """docs with the base counts under the names in out, and `out["hashes"]`, the array of the words' hashes.

    Repeated windows are told apart by 64-bit hashes of their words' hashes. Only texts that have a repeat take the
    sorting step: (hash, place) in order, entries with an equal neighbour marked, their places in order, and what each
    window covers beyond the one before added up - n log n in the length of the text.
    """
    lines, words, spans, ordered, places = unused(docs, "lines", "words", "spans", "ordered", "places")
    h = out["hashes"]
    docs = docs.withColumn(words, F.when(stays(), words_of(text))).withColumn(lines, F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike("[^ \\t-\\r]")))
    docs = (
        docs.withColumn(h, F.when(stays(), hashes_of(q(words))))
        .withColumn(out["n_words"], F.size(q(words)).cast("long"))
        .withColumn(out["word_chars"], F.length(F.array_join(q(words), "")).cast("long"))
        .withColumn(out["n_symbols"], F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn(out["n_dup_lines"], (F.size(q(lines)) - F.size(F.array_distinct(q(lines)))).cast("long"))
        .drop(lines, words)
    )
    starts = F.slice(q(h), 1, F.greatest(F.size(q(h)) - (window - 1), F.lit(0)))
    docs = docs.withColumn(spans, F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(q(h), i + k) for k in range(1, window)])))
    docs = docs.withColumn(ordered, F.when(stays() & (F.size(F.array_distinct(q(spans))) < F.size(q(spans))), F.array_sort(F.transform(q(spans), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda x, i: F.coalesce(x["h"] == F.get(q(ordered), i)["h"], F.lit(False))
    docs = docs.withColumn(places, F.array_sort(F.filter(F.transform(q(ordered), lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["i"])), lambda p: p.isNotNull())))
    start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
    total = F.aggregate(q(places), start, lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return docs.withColumn(out["n_repeat_words"], F.coalesce(total, F.lit(0)).cast("long")).drop(spans, ordered, places)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that labels call good and never bad or toxic, once each."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")).where("quality = 1 and toxic = 0").select("doc_id")


def log_ratios(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, smoothing: float = SMOOTHING, pseudo: float = PSEUDO, max_broadcast: int = BROADCAST_IDS) -> DataFrame:
    """One row, one column `ratios`: the smoothed log ratio of each bin, in order.

    Counts cover every n-gram of all documents; target is the part whose ids are in trusted (column doc_id, no repeats). With no trusted text at
    all, every ratio is 0. Trusted ids meet the documents at the scan if they are few; else texts are dealt by id
    once. The n-grams are added up within each task before anything else is shuffled.
    """
    spark = docs.sparkSession
    flag, path = written(trusted.select(F.col("doc_id").cast("long").alias("tid"), F.lit(1).alias("target")), "trusted")
    flag = F.broadcast(flag) if flag.count() <= max_broadcast else flag.hint("merge")
    rows = docs.select(q(id_col).cast("long").alias("did"), q(text_col).alias("t")).join(flag, F.col("did") == F.col("tid"), "left")
    rows = rows.select(F.coalesce("target", F.lit(0)).alias("target"), F.when(stays(), hashes_of(words_of(F.col("t")))).alias("h"))
    counts = rows.select("target", F.explode(ngram_bins(F.col("h"), bins)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("raw"), F.sum("target").alias("target"))
    full = spark.range(bins).join(counts, F.col("id") == F.col("bin"), "left").select(F.col("id"), F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    one = full.agg(F.array_sort(F.collect_list(F.struct("id", "raw", "target"))).alias("x"), F.sum("raw").alias("raws"), F.sum("target").alias("targets"))

    def ratio(x: Column) -> Column:
        expected = x["raw"] * F.col("targets") / F.col("raws")
        return F.when(x["raw"] > 0, F.log((1 - smoothing) * (x["target"] + pseudo) / (expected + pseudo) + smoothing)).otherwise(0.0)

    found = one.select(F.when(F.col("targets") > 0, F.transform("x", ratio)).otherwise(F.transform("x", lambda x: F.lit(0.0))).alias("ratios")).first()
    remove(spark, path)
    return spark.createDataFrame([(found.ratios,)], "ratios array<double>")


def assess(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, smoothing: float = SMOOTHING, pseudo: float = PSEUDO, threshold: float = THRESHOLD, max_broadcast: int = BROADCAST_IDS) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr (double) and kept.

    Columns of these names in the input are replaced. A null or wordless text has counts 0, llr 0.0, and fails the base
    rules. Null and repeated ids are rows like any other (a null id is never trusted). Each text, however long, is assessed whole, and
    every document by the same fixed threshold; a ratio equal to it is kept. An empty table gives an empty result.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    docs = without(docs, *names, "base_failed", "llr", "kept")
    ratios = log_ratios(docs, trusted, id_col=id_col, text_col=text_col, bins=bins, smoothing=smoothing, pseudo=pseudo, max_broadcast=max_broadcast)
    h, grams, r = unused(docs, "hashes", "grams", "ratios")
    out = with_base(docs, q(text_col), {n: n for n in names} | {"hashes": h})
    out = out.withColumn(grams, ngram_bins(q(h), bins)).withColumn(r, ratios.scalar()).drop(h)
    total = F.aggregate(q(grams), F.lit(0.0), lambda a, b: a + F.get(q(r), b))
    out = out.withColumn("llr", F.coalesce(total / F.nullif(F.size(q(grams)), F.lit(0)), F.lit(0.0))).drop(grams, r)
    out = out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def op10_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, ratio and verdict of all documents; trusted are those that `labels` calls good and not toxic."""
    out = assess(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")

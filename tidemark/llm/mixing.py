"""Mixing sources to target weights by Poisson replication. DataFrame operations only.

Every source gets a mean repetition rate: its share of the target over what it has. Each document is hashed once, from the seed, its
id and its text; it draws its number of copies by inverting the Poisson distribution of its source's mean at the uniform
number that the hash gives, is exploded by the count, and the copies are ordered globally by a hash of that hash and
the copy's number. Such hashes are uniform, so the order's ranges are equal parts of the hash's range: nothing is sampled for them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import q, remove, stays, stored_bytes, table, unused, without, written

#: Bytes of the table of sources' means (as stored) up to which it is sent to all tasks; a longer one is joined by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Expected bytes of a partition of the result.
PARTITION_BYTES = 256 << 20
#: Means from which the lower end of a distribution, ten deviations and 25 below the mean, is left out.
LARGE = 400.0


def digest(seed: int, *parts: Column) -> Column:
    """32 hex digits from the seed and the parts; a null part differs from any value."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]))


def uniform(hex_digits: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash."""
    return F.conv(F.substring(hex_digits, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_at(mean: Column, u: Column) -> Column:
    """The Poisson distribution's inverse at u: how many of 0, 1, 2, ... have a cumulative probability of at most u.

    Terms run over ten deviations and 25 on either side of the mean, so a draw takes the square root of the mean in time and space, and
    there is no table. Terms are kept as logarithms; the first one of a large mean is by Stirling's series, exact there to the last digits.
    """
    width = 10 * F.sqrt(mean) + 25
    low = F.when(mean < LARGE, F.lit(0)).otherwise(F.floor(mean - width)).cast("long")
    k = F.greatest(low, F.lit(1)).cast("double")
    log_factorial = k * F.log(k) - k + F.log(2 * math.pi * k) / 2 + 1 / (12 * k) - 1 / (360 * F.pow(k, 3.0)) + 1 / (1260 * F.pow(k, 5.0))
    log = F.when(low == 0, -mean).otherwise(k * F.log(mean) - mean - log_factorial)
    start = F.struct(log.alias("log"), F.exp(log).alias("sum"), (low + (F.exp(log) <= u).cast("long")).alias("n"))

    def step(a: Column, j: Column) -> Column:
        at = a["log"] + F.log(mean / j)
        total = a["sum"] + F.exp(at)
        return F.struct(at.alias("log"), total.alias("sum"), (a["n"] + (total <= u).cast("long")).alias("n"))

    found = F.aggregate(F.sequence(low + 1, F.ceil(mean + width).cast("long")), start, step, lambda a: a["n"])
    return F.when(mean > 0, found).otherwise(F.lit(0)).cast("int")


def rates(docs: DataFrame, weights: dict[str, float] | None, *, source_col: str = "source", text_col: str = "text", size: float | None = None, default: float = 0.0) -> tuple[DataFrame, str, float]:
    """(source, mean): mean repetitions of a document of each source.

    Sizes are in bytes of text plus one a row. weights maps sources to shares of the target (scaled to sum to one over the
    sources there are; a source without a weight gets `default`); without weights all sources have equal shares. size is the
    target's size as a multiple of the input's (1 by default). Null is a source of its own, with the weight of key "". Also
    returns the path of the written sizes and the target's bytes.
    """
    sized = docs.groupBy(q(source_col).alias("source")).agg(F.sum(F.coalesce(F.octet_length(q(text_col)), F.lit(0)).cast("long") + F.lit(1)).alias("bytes"))
    if weights is None:
        sized = sized.withColumn("share", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "key string, share double")
        sized = sized.join(F.broadcast(given), F.coalesce("source", F.lit("")) == F.col("key"), "left").select("source", "bytes", F.coalesce("share", F.lit(float(default))).alias("share"))
    sized, path = written(sized, "source-sizes")
    whole = sized.agg(F.sum("bytes").alias("bytes"), F.sum("share").alias("share")).first()
    target = (whole["bytes"] or 0) * (1.0 if size is None else size)
    if not whole["share"]:
        return sized.select("source", F.lit(0.0).alias("mean")), path, target
    return sized.select("source", (F.col("share") / F.lit(float(whole["share"])) * F.lit(float(target)) / F.col("bytes")).alias("mean")), path, target


def mix(docs: DataFrame, weights: dict[str, float] | None = None, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", size: float | None = None, seed: int = 11, default: float = 0.0, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """Copies of docs in one global random order, with n_copies, copy (int, from 1) and order_key (32 hex digits, ascending).

    A source's expected bytes are its share of the target; what a document gets depends on the seed, its id and text
    and its source's mean only. Rows equal in id and text get equal counts, and their copies tie in the order. Null ids, texts and
    sources are values of their own. Documents that draw 0 go; that is what a mean below one asks for. A text of any length is hashed
    whole, and copied whole. Input columns of the three names are replaced; others may have any names. Empty input, or weights
    that name no source there is (and no default), give an empty result.
    """
    docs = without(docs, "n_copies", "copy", "order_key")
    spark = docs.sparkSession
    key, mean, own = unused(docs, "source", "mean", "hash")
    means, sizes, target = rates(docs, weights, source_col=source_col, text_col=text_col, size=size, default=default)
    means, path = written(means.select(F.col("source").alias(key), F.col("mean").alias(mean)), "means")
    remove(spark, sizes)
    few = stored_bytes(spark, path) <= max_broadcast
    joined = docs.join(F.broadcast(means) if few else means.hint("merge"), q(source_col).eqNullSafe(q(key)))
    hashed = joined.withColumn(own, F.when(stays(), digest(seed, q(id_col), q(text_col))))
    drawn = hashed.withColumn("n_copies", F.when(stays(), poisson_at(q(mean), uniform(q(own))))).drop(key, mean)
    copies = drawn.withColumn("copy", F.explode(F.when(F.col("n_copies") > 0, F.sequence(F.lit(1), F.col("n_copies")))))
    out = copies.withColumn("order_key", F.when(stays(), digest(seed + 1, q(own), F.col("copy")))).drop(own)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(target / PARTITION_BYTES))
    place = F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("double") * F.lit(parts / (1 << 32))).cast("int")
    return out.repartitionById(parts, place).sortWithinPartitions("order_key")


#: Weights of the registered query: the first sources count most, as a curated part of a mixture would.
WEIGHTS = {"src0": 1.0, **{f"src{i}": 2.0 for i in range(1, 10)}, **{f"src{i}": 0.5 for i in range(10, 20)}}
#: Weight of any other source, and of null.
DEFAULT = 0.5


def op8_poisson_replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to WEIGHTS at the size of the input."""
    return mix(table(spark, sf_dir, "documents"), WEIGHTS, default=DEFAULT)


#: The same in DuckDB.
OP8_SQL = f"""
WITH w(source, share) AS (VALUES {", ".join(f"('{k}', {v}::DOUBLE)" for k, v in WEIGHTS.items())}),
s AS (SELECT d.source, sum(coalesce(strlen(text), 0) + 1)::DOUBLE AS bytes, any_value(coalesce(w.share, {DEFAULT})) AS share FROM documents d LEFT JOIN w ON coalesce(d.source, '') = w.source GROUP BY d.source),
m AS (SELECT source, share / (SELECT sum(share) FROM s) * (SELECT sum(bytes) FROM s) / bytes AS mean FROM s),
t AS (SELECT source, mean, j, -mean + CASE WHEN j = 0 THEN 0 ELSE j * ln(mean) - lgamma(j + 1) END AS log FROM (SELECT source, mean, unnest(range(0, ceil(mean + 10 * sqrt(mean) + 25)::BIGINT + 1)) AS j FROM m WHERE mean > 0)),
c AS (SELECT source, j, sum(exp(log)) OVER (PARTITION BY source ORDER BY j) AS cdf FROM t),
k AS (SELECT *, md5('11|' || coalesce('=' || doc_id, '-') || '|' || coalesce('=' || text, '-')) AS hash FROM documents),
h AS (SELECT *, ('0x' || substr(hash, 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u FROM k),
n AS (SELECT h.* EXCLUDE (u), (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM h.source AND c.cdf <= h.u)::INTEGER AS n_copies FROM h),
x AS (SELECT *, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM n WHERE n_copies > 0)
SELECT * EXCLUDE (hash), md5('12|=' || hash || '|=' || copy) AS order_key FROM x
"""

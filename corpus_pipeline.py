"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the shared folder and
reads it again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import round_trip, vocabulary_path
from tidemark.llm.common import remove, table, written
from tidemark.llm.line_dedup import drop_common_lines
from tidemark.llm.mixing import DEFAULT, WEIGHTS, mix
from tidemark.llm.quality_rules import assess, trusted_ids
from tidemark.llm.shingle_join import near_copies

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio; the others go. The raw corpus is what the stage is given.

    A null, empty or wordless text fails the base rules and goes. A null id is never trusted; repeated rows and ids are rows of their own, and
    a ratio equal to the threshold stays. Texts are assessed whole, however long. Other columns than those of documents go,
    whatever their names; an empty table stays empty.
    """
    return assess(docs, trusted_ids(table(spark, sf_dir, "labels"))).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines found in ten or more of them; n_chars follows the text.

    A null text is one empty line, so it becomes an empty text; a text all of whose lines are common does, too. Null and repeated ids and
    rows are documents of their own (ten equal rows empty each other's texts), and exactly ten are enough. Texts of any length; other
    columns go; an empty table stays empty.
    """
    return drop_common_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of smallest id (nulls last; ties by text hash, then the other columns): 5-word shingles, Jaccard 0.8 or more.

    Candidates come from SimHashes of the shingle sets by pivot tables (up to 12 of 64 bits) and are verified on the whole sets. No radius
    is without loss at that similarity, so the shingles themselves complete the links among texts that don't hang together yet.
    op4's fingerprints and 3 bits are those of the query op4 only. Null and wordless texts are one group. Null
    and repeated ids are rows like any other; rows equal in all columns leave one. Texts of any length are compared whole;
    other columns go; an empty table stays empty.
    """
    found = near_copies(docs.select(*COLUMNS))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col("text").isNull(), "lang", "source", "n_chars", "row")
    first = found.groupBy("component").agg(F.min(rank)["row"].alias("row")).select("row")
    return found.join(first, "row", "left_semi").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, as their source's weight has it, in one random order.

    Sources without a weight, and null, have the default one. Rows equal in id and text get equally many copies, which stand side by side; null
    ids and texts are values like any other. Texts of any length are copied whole; other columns go; an empty table stays empty.
    """
    return mix(docs.select(*COLUMNS), WEIGHTS, default=DEFAULT).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens (long), ids and decoded text of every copy.

    A null or empty text has no ids and decodes to an empty text; null and repeated ids are rows of their own. Texts of any length are encoded
    whole; other columns go; an empty table stays empty.
    """
    out = round_trip(docs.select(*COLUMNS), vocabulary_path("word_bpe_49k.json"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup), ("mixing", mixing), ("bpe", bpe)]

#: The near-dedup's components and BPE have no SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), f"stage-{name}", "zstd")
        if before:
            remove(spark, before)
        before = path
    return docs

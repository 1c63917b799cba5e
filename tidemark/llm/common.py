"""What the corpus operators share: the shared folder, written intermediates, column names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word rule of the text operators: runs of anything but ASCII white space.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or (only where unset, as in tests) an own one."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None)
    if not found:
        found = sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster's machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes paths by Hadoop's file system API, so in any store that Spark can write."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, name: str, compression: str = "uncompressed") -> tuple[DataFrame, str]:
    """df written to the shared folder and read again: lineage ends here, a lost executor costs nothing, and the size is known.

    Returns the read DataFrame and the path, which the caller removes when nothing reads it any more. Narrow tables go
    uncompressed: the codecs' buffers outside the heap, several for each of many small files, are freed late. Tables
    with texts name a codec.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Has batches to Python hold about so many bytes (one row at least), if the session doesn't say otherwise: of long texts, the usual 10,000 rows are too many."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if not now or not now.isdigit() or int(now) > 64 << 20:
        spark.conf.set(key, str(size))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like those asked for that df doesn't use (names are compared without case, as Spark does)."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        own = f"__{n}"
        while own.lower() in have:
            own += "_"
        have.add(own.lower())
        out.append(own)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns whose names (in any case) the caller is about to add."""
    low = {n.lower() for n in names}
    return df.select(*[q(c) for c in df.columns if c.lower() not in low])


def q(name: str):
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def stays() -> Column:
    """Always true, but not to the optimiser, which so leaves a column computed once.

    Else a filter on a result is moved below the projections, with the whole expressions of columns that a lambda refers to
    put into the lambda, to be computed again for every element.
    """
    return F.monotonically_increasing_id() >= 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Incremental protocols and keyed writes on plain Parquet tables."""

from __future__ import annotations

import contextlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import KEY, SERIES

EPOCH = "1970-01-01 00:00:00"


def above_high_water(new: DataFrame, target: DataFrame, scope: str = "key", key: list[str] | None = None, at: str = "open_time") -> DataFrame:
    """Rows later than the target's latest: of their own key (scope "key"), or of the whole target (scope "global", which drops late rows)."""
    key = key or [k for k in SERIES if k in new.columns]
    if scope == "global":
        top = target.agg(F.max(at)).first()[0]  # one value; as a literal it reaches the scan
        return new.where(F.col(at) > F.lit(top)) if top is not None else new
    marks = target.groupBy(*key).agg(F.max(at).alias("__high"))
    return new.join(marks, key, "left").where(F.col(at) > F.coalesce("__high", F.lit(EPOCH).cast("timestamp"))).drop("__high")


def missing_rows(source: DataFrame, target: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Rows of source whose key the target hasn't: also late and back-filled ones."""
    return source.join(target.select(*key), key, "left_anti")


def set_difference(source: DataFrame, target: DataFrame, compute, key: list[str] = KEY, series: list[str] = SERIES) -> DataFrame:
    """compute() over the whole history of the series that have missing rows; only the missing rows come out."""
    new = missing_rows(source, target, key).select(*key)
    history = source.join(new.select(*series).distinct(), series, "left_semi")
    return compute(history).join(new, key, "left_semi")


def since(source: DataFrame, target: DataFrame, days: int, at: str = "open_time") -> DataFrame:
    """Rows from `days` before the target's latest on (all, if the target is empty)."""
    top = target.agg(F.max(at)).first()[0]
    return source if top is None else source.where(F.col(at) >= F.lit(top) - F.make_dt_interval(F.lit(days)))


def lookback(source: DataFrame, target: DataFrame, compute, days: int, scope: str = "key") -> DataFrame:
    """compute() over the rows since the lookback; only those above the high-water mark come out, filtered after the windows."""
    return above_high_water(compute(since(source, target, days)), target, scope)


def upserted(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new in place of existing ones of equal key, and beside the others. The last of new's duplicates isn't defined: keys of new must be unique."""
    return existing.join(new.select(*key), key, "left_anti").unionByName(new)


def not_yet_there(new: DataFrame, existing: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of new to insert: those of unknown key, of each the first by order (without one, by all its other columns, so it is always the same)."""
    order = order or [F.col(c) for c in new.columns if c not in key]
    first = new.groupBy(*key).agg(F.min_by(F.struct(*new.columns), F.struct(*order)).alias("x")).select("x.*") if order else new.dropDuplicates(key)
    return first.join(existing.select(*key), key, "left_anti")


def reprocess(source: DataFrame, target: Table, compute, days: int) -> None:
    """Makes all rows since `days` before the target's latest anew (all, on the first run) and upserts them, so late and corrected rows count."""
    target.upsert(compute(since(source, target.read(), days)))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share: spark.checkpoint.dir, or (only where unset, as in tests) a folder of the warehouse's."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one read."""


class Table:
    """A keyed Parquet table in folders, partitioned by an expression of its rows.

    A manifest, one small file a version, says which folders hold the rows of which partition. A write adds folders and then the next
    version's manifest, created only if there is none of that number; so readers never see half a write, and of two writers
    that began from one version the second fails. Append adds folders. Upsert and insert-ignore read and rewrite only the partitions
    that the new rows touch. Within a folder rows are in order of the key, so readers skip by least and greatest values.
    """

    #: Versions whose folders stay, for readers that have begun.
    KEPT = 2

    def __init__(self, spark: SparkSession, path: str, schema, key: list[str], by: Column | None = None):
        self.spark, self.path, self.key, self.by = spark, path.rstrip("/"), key, by
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []

    def _load(self, version: int) -> dict[str, list[str]]:
        return json.loads(self.spark.sparkContext._jvm.scala.io.Source.fromInputStream(self._opened(version), "UTF-8").mkString())

    def _opened(self, version: int):
        fs, at = self._fs(f"versions/{version:09d}.json")
        return fs.open(at)

    def _create(self, path: str, text: str) -> None:
        fs, at = self._fs(path)
        try:
            out = fs.create(at, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise ConcurrentWrite(f"{path} is already there") from None
            raise
        out.write(bytearray(text.encode()))
        out.close()

    def state(self) -> tuple[int, dict[str, list[str]]]:
        """Version (-1: none yet) and its folders by partition."""
        versions = sorted(int(n.split(".")[0]) for n in self._names("versions") if n.endswith(".json"))
        return (versions[-1], self._load(versions[-1])) if versions else (-1, {})

    def _of(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._of([f for x in self.state()[1].values() for f in x])

    def _written(self, df: DataFrame) -> dict[str, str]:
        """Writes df to a folder a partition: partition -> folder."""
        name = f"data-{uuid.uuid4().hex[:12]}"
        rows = df.select(*self.schema.names, (F.lit("all") if self.by is None else F.coalesce(self.by.cast("string"), F.lit("null"))).alias("__part"))
        rows = rows.repartition("__part") if self.by is not None else rows
        rows.sortWithinPartitions("__part", *self.key).write.partitionBy("__part").parquet(f"{self.path}/{name}")
        return {n.split("=", 1)[1]: f"{name}/{n}" for n in self._names(name) if n.startswith("__part=")}

    def _commit(self, version: int, folders: dict[str, list[str]]) -> None:
        self._create(f"versions/{version + 1:09d}.json", json.dumps(folders))
        old = version + 1 - self.KEPT
        if old >= 0 and f"{old:09d}.json" in self._names("versions"):
            held = {f for v in range(old + 1, version + 2) for x in self._load(v).values() for f in x}
            for f in {f for x in self._load(old).values() for f in x} - held:
                fs, at = self._fs(f)
                fs.delete(at, True)
            fs, at = self._fs(f"versions/{old:09d}.json")
            fs.delete(at, False)

    def replace(self, df: DataFrame) -> None:
        """Full refresh."""
        version, _ = self.state()
        self._commit(version, {k: [f] for k, f in self._written(df).items()})

    def append(self, new: DataFrame) -> int:
        """Adds rows as they are; how many."""
        version, folders = self.state()
        added = self._written(new)
        n = self._of(list(added.values())).count()
        if n:
            self._commit(version, folders | {k: [*folders.get(k, []), f] for k, f in added.items()})
        return n

    def _touched(self, new: DataFrame, folders: dict[str, list[str]]) -> tuple[DataFrame, dict[str, str]]:
        """New rows, written, and their folders: what they touch is known, and they are made only once."""
        added = self._written(new)
        return self._of(list(added.values())), added

    def upsert(self, new: DataFrame) -> None:
        """New rows in place of those of equal key; keys of new must be unique."""
        version, folders = self.state()
        rows, added = self._touched(new, folders)
        if not added:
            return
        before = self._of([f for k in added for f in folders.get(k, [])])
        made = self._written(upserted(before, rows, self.key)) if any(k in folders for k in added) else added
        self._commit(version, folders | {k: [f] for k, f in made.items()})

    def insert_ignore(self, new: DataFrame, order: list[Column] | None = None) -> int:
        """Inserts rows of unknown key, of equal ones the first by order; how many."""
        version, folders = self.state()
        rows, added = self._touched(new, folders)
        before = self._of([f for k in added for f in folders.get(k, [])])
        made = self._written(not_yet_there(rows, before, self.key, order))
        n = self._of(list(made.values())).count()
        if n:
            self._commit(version, folders | {k: [*folders.get(k, []), f] for k, f in made.items()})
        return n

    @contextlib.contextmanager
    def single_flight(self, run: str):
        """One run at a time: a second one fails while the first is within; a run that died is cleared by deleting the file `running`."""
        self._create("running", run)
        try:
            yield
        finally:
            fs, at = self._fs("running")
            fs.delete(at, False)

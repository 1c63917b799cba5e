"""Runs, symbols' bootstrap states, and maintenance checks over small state tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import Table

RUNS = "pipeline_run_id long, dag_run_id string, started_at timestamp, finished_at timestamp, status string, rows_inserted long, error_message string"
SYMBOLS = "exchange string, symbol string, enabled boolean, history_days int, bootstrap_status string, last_bootstrap_open_time timestamp, last_error string"
ERROR_CHARS = 4000


class Runs:
    """Audit of runs: one row each, running until it succeeds or fails."""

    def __init__(self, spark: SparkSession, path: str, now: Callable[[], datetime]):
        self.spark, self.now, self.table = spark, now, Table(spark, path, RUNS, ["pipeline_run_id"])

    def start(self, dag_run_id: str) -> int:
        known = self.table.read()
        if known.where(F.col("dag_run_id") == dag_run_id).count():
            raise ValueError(f"run {dag_run_id} is already there")
        n = (known.agg(F.max("pipeline_run_id")).first()[0] or 0) + 1
        self.table.append(self.spark.createDataFrame([(n, dag_run_id, self.now(), None, "running", None, None)], RUNS))
        return n

    def _end(self, run: int, status: str, rows: int | None, error: str | None) -> None:
        row = self.table.read().where(F.col("pipeline_run_id") == run).first()
        self.table.upsert(self.spark.createDataFrame([(run, row.dag_run_id, row.started_at, self.now(), status, rows, error)], RUNS))

    def succeed(self, run: int, rows: int) -> None:
        self._end(run, "success", rows, None)

    def fail(self, run: int, error: str) -> None:
        self._end(run, "failed", None, error[:ERROR_CHARS])

    def latest(self) -> DataFrame:
        return self.table.read().orderBy(F.desc_nulls_last("started_at"), F.desc("pipeline_run_id")).limit(1)


def bootstrap(symbols: Table, load: Callable[[str, datetime, datetime, Callable[[datetime], None]], int], now: datetime) -> dict[str, str]:
    """Loads the history of every enabled symbol that isn't completed; one symbol's failure leaves the others alone.

    load(symbol, start, end, mark) calls mark(open_time) after each block, which is where a later run resumes. Returns the
    errors; RuntimeError at the end if there are any.
    """
    spark, errors = symbols.spark, {}

    def put(row, **new) -> None:
        symbols.upsert(spark.createDataFrame([tuple(new.get(c, row[c]) for c in row.asDict())], SYMBOLS))

    todo = symbols.read().where(F.col("enabled") & (F.col("bootstrap_status") != "completed")).orderBy("symbol").collect()
    for row in todo:
        key = (F.col("symbol") == row.symbol) & (F.col("exchange") == row.exchange)
        at = lambda: symbols.read().where(key).first()  # noqa: B023, E731
        put(row, bootstrap_status="running", last_error=None)
        begin = row.last_bootstrap_open_time + timedelta(milliseconds=1) if row.last_bootstrap_open_time else now - timedelta(days=row.history_days)
        try:
            load(row.symbol, begin, now, lambda t: put(at(), last_bootstrap_open_time=t))  # noqa: B023
        except Exception as e:  # each symbol on its own; all are raised at the end
            errors[row.symbol] = str(e)
            put(at(), bootstrap_status="failed", last_error=str(e)[:ERROR_CHARS])
        else:
            put(at(), bootstrap_status="completed")
    if errors:
        raise RuntimeError(f"symbols failed: {errors}")
    return errors


def maintenance(runs: Runs, symbols: DataFrame, klines: DataFrame, layers: dict[str, DataFrame], now: datetime, fresh: timedelta = timedelta(hours=2)) -> list[str]:
    """What is wrong: the latest run, symbols, freshness, empty or unequal layers."""
    out = []
    last = runs.latest().first()
    if last is None or last.status != "success":
        out.append("the latest run is not a success")
    found = symbols.where("enabled").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("bootstrap_status") == "failed").alias("failed")).first()
    if not found.n or found.failed:
        out.append("no enabled symbol" if not found.n else f"{found.failed} symbols failed")
    newest = klines.agg(F.max("open_time")).first()[0]
    if newest is None or now - newest > fresh:
        out.append("klines are stale")
    counts = {k: v.count() for k, v in layers.items()}
    out += [f"{k} is empty" for k, n in counts.items() if not n]
    if len(set(counts.values())) > 1:
        out.append(f"layers differ: {counts}")
    return out

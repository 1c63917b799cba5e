"""The ingest side: bronze tables, the run that fills them, their staging, and the symbols' configuration."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.logs import get_logger
from tidemark.operators.control import SYMBOLS, Runs
from tidemark.operators.incremental import Table
from tidemark.operators.validation import validate
from tidemark.sources.klines import KINDS, MINUTE_MS, PAGE, named, read_raw, typed

log = get_logger(__name__)

EXCHANGE = "BINANCE"
SCHEMAS = {kind: ", ".join(["pipeline_run_id long", *[f"`{n}` {t}" for n, t in fields.items()], "ingested_at timestamp"]) for kind, fields in KINDS.items()}
KEYS = {"price": ["symbol", "ingested_at"], "ticker": ["symbol", "ingested_at"], "kline": ["symbol", "open_time"]}
#: Order of the feeds in a run.
FEEDS = ("price", "ticker", "kline")


class Warehouse:
    """Tables by layer and name below one folder. A layer's name is taken as it is."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, layer: str, name: str, schema, key: list[str], by=None) -> Table:
        return Table(self.spark, f"{self.root}/{layer}/{name}", schema, key, by)

    def bronze(self, kind: str) -> Table:
        """Raw prices, tickers or klines, partitioned by day."""
        return self.table("bronze", f"{kind}s", SCHEMAS[kind], KEYS[kind], F.to_date("open_time" if kind == "kline" else "ingested_at"))

    def symbols(self) -> Table:
        return self.table("bronze", "configured_symbols", SYMBOLS, ["exchange", "symbol"])


def load(table: Table, records: DataFrame, kind: str, run: int, now: datetime) -> int:
    """Validated records into their bronze table: prices and tickers are appended, klines of known (symbol, open_time) are ignored. How many rows came in."""
    rows = typed(records, kind).withColumn("pipeline_run_id", F.lit(run).cast("long")).withColumn("ingested_at", F.lit(now).cast("timestamp")).select(*table.schema.names)
    return table.insert_ignore(rows) if kind == "kline" else table.append(rows)


def ingest(warehouse: Warehouse, runs: Runs, dag_run_id: str, extract: Callable[[str], DataFrame], now: Callable[[], datetime]) -> int:
    """One bronze run: for prices, tickers and the latest klines in turn, extract, validate and load; then success. An error marks the run failed and is raised.

    extract(kind) gives records as they come: (symbol, value).
    """
    run = runs.start(dag_run_id)
    try:
        n = 0
        for kind in FEEDS:
            records = named(extract(kind), kind).persist()  # asked for once, for validation and load
            try:
                added = load(warehouse.bronze(kind), validate(records, kind), kind, run, now())
            finally:
                records.unpersist()
            log.info("run %s: %s rows of %s", run, added, kind)
            n += added
        runs.succeed(run, n)
        return n
    except Exception as e:
        log.exception("run %s failed", run)
        runs.fail(run, str(e))
        raise


def rest_extract(spark: SparkSession, symbols: list[str], transport: str, interval: str = "1m") -> Callable[[str], DataFrame]:
    """The latest record of each symbol over REST."""
    return lambda kind: read_raw(spark, kind, symbols, transport, **({"limit": 1, "interval": interval} if kind == "kline" else {}))


def history(warehouse: Warehouse, transport: str, run: int, now: Callable[[], datetime], interval: str = "1m", pages_at_once: int = 100) -> Callable:
    """load(symbol, start, end, mark) for control.bootstrap: the executors ask for so many pages at once; each such stretch is validated, inserted and marked."""

    def millis(t: datetime) -> int:
        return int(t.replace(tzinfo=t.tzinfo or timezone.utc).timestamp() * 1000)

    def fetch(symbol: str, start: datetime, end: datetime, mark: Callable[[datetime], None]) -> int:
        n, at, last = 0, millis(start), millis(end)
        while at <= last:
            stop = min(last, at + pages_at_once * PAGE * MINUTE_MS - 1)
            records = named(read_raw(warehouse.spark, "kline", [symbol], transport, start_ms=at, end_ms=stop, interval=interval), "kline").persist()
            try:
                newest = records.agg(F.max(F.col("open_time").cast("long"))).first()[0]
                if newest is not None:
                    n += load(warehouse.bronze("kline"), validate(records, "kline"), "kline", run, now())
                    mark(datetime.fromtimestamp(newest / 1000, timezone.utc).replace(tzinfo=None))
            finally:
                records.unpersist()
            at = stop + 1
        return n

    return fetch


def sync_symbols(settings: Settings, symbols: Table) -> None:
    """Brings the configured symbols into their table: new ones as pending, with the configured depth of history; those not completed get the depth anew."""
    spark = symbols.spark
    wanted = spark.createDataFrame([(settings.exchange.lower(), s, True, settings.days, "pending", None, None) for s in settings.symbols], SYMBOLS)
    known = symbols.read()
    symbols.insert_ignore(wanted)
    todo = known.join(wanted.select("exchange", "symbol"), ["exchange", "symbol"], "left_semi").where("bootstrap_status <> 'completed'")
    symbols.upsert(todo.withColumn("history_days", F.lit(settings.days)).select(*symbols.schema.names))


def staging(bronze: DataFrame, kind: str) -> DataFrame:
    """Bronze rows without their run, behind the exchange's name."""
    return bronze.select(F.lit(EXCHANGE).alias("exchange"), *KINDS[kind], "ingested_at")


def market_candles(klines: DataFrame, interval: str = "1m") -> DataFrame:
    """Staged klines as candles of an interval."""
    return klines.withColumn("interval", F.lit(interval))


def of_interval(candles: DataFrame, interval: str = "1m") -> DataFrame:
    return candles.where(F.col("interval") == interval)

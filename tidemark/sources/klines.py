"""An exchange's REST interface: klines, spot prices and 24-hour tickers; request planning, retries, and parsing to typed rows.

The transport is a function (path, parameters) -> (status, body), so that it can be a HTTP client or a recorded file. As a
Spark data source, requests run on the executors, one input partition a symbol and page.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The public interface (fixed values).
BASE_URL = "https://api.binance.com"
API = "/api/v3"
PATHS = {"kline": "/klines", "price": "/ticker/price", "ticker": "/ticker/24hr"}
TIMEOUT = 30

PAGE = 1000
MINUTE_MS = 60_000
Transport = Callable[[str, dict], tuple[int, str]]

RAW = "symbol string, value string"
KLINE = ["open_time", "open_price", "high_price", "low_price", "close_price", "volume", "close_time", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume"]


class ClientError(RuntimeError):
    """A request that failed for good."""


def retried(send: Transport, path: str, params: dict, attempts: int = 5, sleep: Callable[[float], None] = time.sleep):
    """The parsed body; up to `attempts` tries on lost connections, timeouts, 429 and 5xx, waiting 1 to 30 seconds, doubling, with jitter."""
    for k in range(attempts):
        try:
            status, body = send(path, params)
        except (ConnectionError, TimeoutError) as e:
            failure: str | Exception = e
        else:
            if status == 200:
                try:
                    return json.loads(body)
                except ValueError as e:
                    raise ClientError(f"{path}: the answer is no JSON") from e
            if status != 429 and status < 500:
                raise ClientError(f"{path}: status {status}")
            failure = f"status {status}"
        if k + 1 < attempts:
            sleep(min(30.0, 2**k + random.random()))
    raise ClientError(f"{path}: {failure} after {attempts} attempts")


def pages(start_ms: int, end_ms: int, page: int = PAGE) -> list[tuple[int, int]]:
    """Ranges of at most `page` minutes that cover start to end, both included."""
    out = []
    while start_ms <= end_ms:
        stop = min(end_ms, start_ms + page * MINUTE_MS - 1)
        out.append((start_ms, stop))
        start_ms = stop + 1
    return out


def http(base: str = BASE_URL + API, timeout: float = TIMEOUT) -> Transport:
    """Requests over HTTP; connections that fail, time out or break off are ConnectionErrors."""
    import http.client
    import urllib.error
    import urllib.parse
    import urllib.request

    def send(path: str, params: dict) -> tuple[int, str]:
        try:
            with urllib.request.urlopen(f"{base}{path}?{urllib.parse.urlencode(params)}", timeout=timeout) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, ""
        except (urllib.error.URLError, http.client.HTTPException, TimeoutError) as e:
            raise ConnectionError(str(e)) from e

    return send


def real_http(path: str, params: dict) -> tuple[int, str]:
    """The transport by name for the data source."""
    return http()(path, params)


class MarketClient(Protocol):
    """What the pipeline asks a provider for."""

    def klines(self, symbol: str, interval: str = "1m", start_ms: int | None = None, end_ms: int | None = None, limit: int | None = None) -> list[list]: ...

    def price(self, symbol: str) -> dict: ...

    def ticker(self, symbol: str) -> dict: ...


class RestClient:
    """A MarketClient over a transport; range and limit are left to the server."""

    def __init__(self, send: Transport | None = None, sleep: Callable[[float], None] = time.sleep):
        self.send, self.sleep = send or http(), sleep

    def _get(self, kind: str, params: dict):
        return retried(self.send, PATHS[kind], {k: v for k, v in params.items() if v is not None}, sleep=self.sleep)

    def klines(self, symbol: str, interval: str = "1m", start_ms: int | None = None, end_ms: int | None = None, limit: int | None = None) -> list[list]:
        return self._get("kline", {"symbol": symbol, "interval": interval, "startTime": start_ms, "endTime": end_ms, "limit": limit})

    def price(self, symbol: str) -> dict:
        return self._get("price", {"symbol": symbol})

    def ticker(self, symbol: str) -> dict:
        return self._get("ticker", {"symbol": symbol})


def checked_limit(limit: int) -> int:
    if not 1 <= limit <= PAGE:
        raise ValueError(f"limit must be 1 to {PAGE}")
    return limit


def walk(send: Transport, symbol: str, start_ms: int, end_ms: int, page: int = PAGE, interval: str = "1m") -> Iterator[list]:
    """Blocks of klines of a range, each beginning a millisecond after the last one's open; ends on an empty or short block, or none newer."""
    checked_limit(page)
    client = RestClient(send)
    while start_ms <= end_ms:
        block = client.klines(symbol, interval, start_ms, end_ms, page)
        if not block:
            return
        yield block
        newest = max(int(x[0]) for x in block)
        if len(block) < page or newest < start_ms:
            return
        start_ms = newest + 1


#: A 24-hour ticker's fields as they come, as they are called here, and their types (fixed values).
TICKER = {
    "symbol": ("symbol", "string"),
    "priceChange": ("price_change", "decimal(20,8)"),
    "priceChangePercent": ("price_change_percent", "decimal(20,8)"),
    "weightedAvgPrice": ("weighted_avg_price", "decimal(20,8)"),
    "prevClosePrice": ("prev_close_price", "decimal(20,8)"),
    "lastPrice": ("last_price", "decimal(20,8)"),
    "lastQty": ("last_qty", "decimal(28,8)"),
    "bidPrice": ("bid_price", "decimal(20,8)"),
    "bidQty": ("bid_qty", "decimal(28,8)"),
    "askPrice": ("ask_price", "decimal(20,8)"),
    "askQty": ("ask_qty", "decimal(28,8)"),
    "openPrice": ("open_price", "decimal(20,8)"),
    "highPrice": ("high_price", "decimal(20,8)"),
    "lowPrice": ("low_price", "decimal(20,8)"),
    "volume": ("volume", "decimal(28,8)"),
    "quoteVolume": ("quote_volume", "decimal(28,8)"),
    "openTime": ("open_time", "timestamp"),
    "closeTime": ("close_time", "timestamp"),
    "firstId": ("first_id", "bigint"),
    "lastId": ("last_id", "bigint"),
    "count": ("count", "int"),
}
KINDS = {
    "price": {"symbol": "string", "price": "decimal(20,8)"},
    "ticker": dict(TICKER.values()),
    "kline": {"symbol": "string"} | {n: "timestamp" if n.endswith("_time") else "decimal(20,8)" if n.endswith("price") else "int" if n == "number_of_trades" else "decimal(28,8)" for n in KLINE},
}


def named(raw: DataFrame, kind: str) -> DataFrame:
    """(symbol, value: an answer's record as JSON) -> its fields under their names, still as text, as validation wants them."""
    if kind == "kline":
        x = F.from_json("value", "array<string>")
        return raw.select("symbol", *[x[i].alias(n) for i, n in enumerate(KLINE)])
    fields = {k: k for k in KINDS["price"]} if kind == "price" else {k: n for k, (n, _) in TICKER.items()}
    x = F.from_json("value", ", ".join(f"`{k}` string" for k in fields))
    return raw.select(*[x[k].alias(n) for k, n in fields.items()])


def typed(records: DataFrame, kind: str) -> DataFrame:
    """Records with their types; times are epoch milliseconds."""
    return records.select(*[F.timestamp_millis(F.col(n).cast("bigint")).alias(n) if t == "timestamp" else F.col(n).cast(t).alias(n) for n, t in KINDS[kind].items()])


def parse_klines(raw: DataFrame) -> DataFrame:
    return typed(named(raw, "kline"), "kline")


class MarketSource(DataSource):
    """Prices, tickers or kline ranges as a Spark data source: one input partition a symbol, or a symbol and page.

    Options: kind (price, ticker or kline), symbols, transport (module:function); for klines interval, limit, and start_ms and
    end_ms, without which the latest `limit` are asked for.
    """

    @classmethod
    def name(cls) -> str:
        return "market"

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Page(InputPartition):
    def __init__(self, symbol: str, start_ms: int | None = None, end_ms: int | None = None):
        self.symbol, self.start_ms, self.end_ms = symbol, start_ms, end_ms


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[_Page]:
        o = self.options
        symbols = [s.strip() for s in o["symbols"].split(",") if s.strip()]
        if "start_ms" not in o:
            return [_Page(s) for s in symbols]
        return [_Page(s, a, b) for s in symbols for a, b in pages(int(o["start_ms"]), int(o["end_ms"]))]

    def read(self, page: _Page) -> Iterator[tuple]:
        import importlib

        o = self.options
        module, _, function = o["transport"].partition(":")
        send = getattr(importlib.import_module(module), function)
        kind, interval = o.get("kind", "kline"), o.get("interval", "1m")
        if kind != "kline":
            yield page.symbol, json.dumps(getattr(RestClient(send), kind)(page.symbol))
            return
        blocks = [RestClient(send).klines(page.symbol, interval, limit=checked_limit(int(o.get("limit", 1))))] if page.start_ms is None else walk(send, page.symbol, page.start_ms, page.end_ms, interval=interval)
        for block in blocks:
            for kline in block:
                yield page.symbol, json.dumps(kline)


def read_raw(spark: SparkSession, kind: str, symbols: list[str], transport: str, **options) -> DataFrame:
    """Records as they come: (symbol, value)."""
    spark.dataSource.register(MarketSource)
    if kind == "kline":
        checked_limit(int(options.get("limit", 1)))
    return spark.read.format("market").options(kind=kind, symbols=",".join(symbols), transport=transport, **{k: str(v) for k, v in options.items() if v is not None}).load()


def read_klines(spark: SparkSession, symbols: list[str], start_ms: int, end_ms: int, transport: str, interval: str = "1m") -> DataFrame:
    """Klines of a range."""
    return parse_klines(read_raw(spark, "kline", symbols, transport, start_ms=start_ms, end_ms=end_ms, interval=interval))


def latest_klines(spark: SparkSession, symbols: list[str], transport: str, limit: int = 1, interval: str = "1m") -> DataFrame:
    """The latest klines of each symbol."""
    return parse_klines(read_raw(spark, "kline", symbols, transport, limit=limit, interval=interval))


def current_prices(spark: SparkSession, symbols: list[str], transport: str) -> DataFrame:
    return typed(named(read_raw(spark, "price", symbols, transport), "price"), "price")


def tickers(spark: SparkSession, symbols: list[str], transport: str) -> DataFrame:
    return typed(named(read_raw(spark, "ticker", symbols, transport), "ticker"), "ticker")

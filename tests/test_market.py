from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.config import TIMEFRAMES, Settings, cron_of, supported_intervals, trigger_of
from tidemark.functions.ema import factor, with_ema
from tidemark.operators import candles as C
from tidemark.operators import incremental as I
from tidemark.operators import technical as T
from tidemark.operators import validation as V
from tidemark.sources.klines import ClientError, pages, parse_klines, retried, walk
from tidemark.sources.ticks import synthetic_minutes

KEYS = ["exchange", "symbol", "open_time"]


def series(spark, closes, symbol="S"):
    rows = [("1h", "BINANCE", symbol, datetime(2026, 1, 1) + timedelta(hours=i), float(c), float(c), float(c), float(c)) for i, c in enumerate(closes)]
    return C.with_attributes(spark.createDataFrame(rows, "timeframe string, exchange string, symbol string, open_time timestamp, open_price double, high_price double, low_price double, close_price double"))


def test_five_minutes_make_one_candle(spark):
    start = datetime(2026, 1, 1, 12)
    bars = [(100, 110, 90, 105, 10), (105, 115, 100, 110, 20), (110, 120, 105, 108, 30), (108, 112, 95, 100, 15), (100, 105, 98, 102, 25)]
    rows = [("BINANCE", "AGGTEST5M", start + timedelta(minutes=i), start + timedelta(minutes=i + 1, milliseconds=-1), *map(float, b), b[4] * 100.0, 5, b[4] / 2, b[4] * 50.0, start) for i, b in enumerate(bars)]
    names = ["exchange", "symbol", "open_time", "close_time", "open_price", "high_price", "low_price", "close_price", "volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ingested_at"]
    minutes = spark.createDataFrame(rows, names)
    r = C.with_attributes(C.aggregate(minutes, 5)).collect()
    assert len(r) == 1
    r = r[0].asDict()
    want = {"open_price": 100, "high_price": 120, "low_price": 90, "close_price": 102, "volume": 100, "quote_asset_volume": 10000, "number_of_trades": 25, "taker_buy_base_volume": 50, "taker_buy_quote_volume": 5000, "candle_direction": 1, "body_size": 2, "upper_wick": 18, "lower_wick": 10, "candle_range": 30, "typical_price": 104, "ohlc_average": 103}
    assert {k: r[k] for k in want} == want and r["open_time"] == start
    assert C.aggregate(minutes.where(F.minute("open_time") != 2), 5).count() == 0


def test_complete_buckets_of_3000_minutes(spark):
    minutes = synthetic_minutes(spark, 3000)
    out = C.all_timeframes(minutes, {k: t.minutes for k, t in TIMEFRAMES.items()})
    assert {r.timeframe: r["count"] for r in out.groupBy("timeframe").count().collect()} == {"5m": 600, "15m": 200, "30m": 100, "1h": 50, "1d": 2}


@pytest.mark.parametrize("period", [9, 200])
def test_ema_is_the_adjusted_one_at_any_length(spark, period):
    n = 3000
    x = [100 + (i * 7919 % 1009) / 50 for i in range(n)]
    got = [r.e for r in with_ema(series(spark, x), {"e": ("close_price", period)}).orderBy("open_time").select("e").collect()]
    want = pd.Series(x).ewm(alpha=1 - factor(period), adjust=True).mean()
    assert max(abs(a - b) for a, b in zip(got, want)) < 1e-9


def test_edges_of_indicators(spark):
    first, *_ = rows = T.with_indicators(series(spark, [10, 11, 12, 13])).orderBy("open_time").collect()
    assert first.ema_9 == first.sma_20 == 10 and first.rsi_14 is None and first.bb_upper is None and first.macd == first.macd_signal == first.macd_histogram == 0
    assert all(r.rsi_14 is None for r in rows)  # no losses
    flat = T.dataset(series(spark, [5] * 25)).orderBy("open_time").collect()[-1]
    assert flat.bollinger_position is None and flat.bollinger_width == 0 and flat.low_volatility and flat.candle_body_ratio is None
    zero = T.dataset(series(spark, [0, 0, 1])).collect()
    assert zero[0].macd_strength is None and zero[0].ema_bearish_alignment


def test_validation(spark):
    ok = ("BTC", "1", "2", "1", "1.5", "3", "3", "4", "1", "1", "0", "59999")
    names = ["symbol", "open_price", "high_price", "low_price", "close_price", "volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "open_time", "close_time"]
    frame = lambda **k: spark.createDataFrame([tuple(k.get(n, v) for n, v in zip(names, ok))], ", ".join(f"{n} string" for n in names))
    V.validate(frame(), "kline")
    for bad, code in (({"symbol": " "}, "symbol"), ({"open_price": "NaN"}, "open_price"), ({"close_price": "abc"}, "close_price"), ({"high_price": None}, "high_price"), ({"volume": "-1"}, "volume"), ({"number_of_trades": "1.5"}, "number_of_trades"), ({"close_time": "0"}, "times"), ({"low_price": "9"}, "high_below")):
        with pytest.raises(V.DataQualityError, match=code):
            V.validate(frame(**bad), "kline")


def test_incremental_equals_full_refresh(spark):
    full = series(spark, [10 + i % 7 for i in range(60)], "A").unionByName(series(spark, [9 + i % 5 for i in range(60)], "B"))
    done = T.with_indicators(full.where("symbol = 'A'")).where(F.hour("open_time") != 5)
    want = {(r.symbol, r.open_time): r.ema_21 for r in T.with_indicators(full).collect()}
    new = I.set_difference(full, done, T.with_indicators).collect()
    assert {(r.symbol, r.open_time): r.ema_21 for r in [*new, *done.collect()]} == want and len(new) == len(want) - done.count()
    assert I.above_high_water(full, done, "global").count() == 0
    assert {r.symbol for r in I.above_high_water(full, done).collect()} == {"B"}


def test_table(spark, tmp_path):
    t = I.Table(spark, str(tmp_path / "t"), "k long, v string", ["k"], F.col("k") % 2)
    row = lambda *x: spark.createDataFrame(list(x), "k long, v string")
    assert t.read().count() == 0 and t.insert_ignore(row((1, "b"), (1, "a"), (2, "b"))) == 2 and t.insert_ignore(row((2, "x"))) == 0
    t.upsert(row((2, "c"), (4, "d")))
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "c"), (4, "d")]
    odd, even = t.state()[1]["1"], t.state()[1]["0"]
    t.upsert(row((6, "e")))
    assert t.state()[1]["1"] == odd and t.state()[1]["0"] != even  # only what is touched is written anew
    assert t.append(row((1, "again"))) == 1 and t.state()[1]["1"][:1] == odd and t.append(row()) == 0
    t.upsert(row())
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (1, "again"), (2, "c"), (4, "d"), (6, "e")]
    assert t.insert_ignore(row((9, "longer"), (9, "z")), [F.length("v")]) == 1 and t.read().where("k = 9").first().v == "z"
    t.replace(row((7, "only"), (None, "null")))
    assert sorted(map(tuple, t.read().collect()), key=str) == [(7, "only"), (None, "null")]


def test_writers_and_runs_exclude_each_other(spark, tmp_path):
    a, b = (I.Table(spark, str(tmp_path / "t"), "k long", ["k"]) for _ in range(2))
    a.replace(spark.range(3).withColumnRenamed("id", "k"))
    version, folders = b.state()
    a.replace(spark.range(4).withColumnRenamed("id", "k"))
    with pytest.raises(I.ConcurrentWrite):
        b._commit(version, folders)
    assert b.read().count() == 4
    with a.single_flight("r1"), pytest.raises(I.ConcurrentWrite), b.single_flight("r2"):
        pass
    with b.single_flight("r3"):
        pass


def recorded(path, params):
    """An exchange's recorded answers, as a transport."""
    import json

    t0, n = 1_767_225_600_000, 2500  # 2026-01-01
    kline = lambda t: [t, "100.1", "110", "90", "105", "50", t + 59_999, "1", 10, "2", "3", "0"]
    if path == "/klines":
        lo, hi = params.get("startTime", 0), params.get("endTime", 10**15)
        have = [t for t in range(t0, t0 + n * 60_000, 60_000) if lo <= t <= hi]
        have = have[: params["limit"]] if "startTime" in params else have[-params["limit"] :]
        return 200, json.dumps([kline(t) for t in have])
    if path == "/ticker/price":
        return 200, json.dumps({"symbol": params["symbol"], "price": "-1" if params["symbol"] == "BAD" else "60000.12345678"})
    from tidemark.sources.klines import TICKER

    values = {k: "1.5" for k in TICKER} | {"symbol": params["symbol"], "openTime": t0, "closeTime": t0 + 1, "firstId": 5_000_000_000, "lastId": 5_000_000_001, "count": 7}
    return 200, json.dumps(values)


TRANSPORT = "tests.test_market:recorded"


def test_market_source(spark):
    from tidemark.sources import klines as K

    start = 1_767_225_600_000
    rows = K.read_klines(spark, ["A", "B"], start, start + 2200 * 60_000 - 1, TRANSPORT)
    assert {r.symbol: (r.n, r.d) for r in rows.groupBy("symbol").agg(F.count("*").alias("n"), F.countDistinct("open_time").alias("d")).collect()} == {"A": (2200, 2200), "B": (2200, 2200)}
    assert rows.rdd.getNumPartitions() == 6
    assert K.latest_klines(spark, ["A"], TRANSPORT, 3).count() == 3
    with pytest.raises(ValueError):
        K.latest_klines(spark, ["A"], TRANSPORT, 1001)
    p = K.current_prices(spark, ["A", "B"], TRANSPORT).orderBy("symbol").collect()
    assert [(r.symbol, str(r.price)) for r in p] == [("A", "60000.12345678"), ("B", "60000.12345678")]
    (t,) = K.tickers(spark, ["A"], TRANSPORT).collect()
    assert len(t) == 21 and t.open_time == datetime(2026, 1, 1) and t["count"] == 7 and t.first_id == 5_000_000_000 and str(t.ask_qty) == "1.50000000"
    client = K.RestClient(recorded)
    assert client.price("A")["price"] == "60000.12345678" and len(client.klines("A", limit=2)) == 2 and client.ticker("A")["count"] == 7


def test_bronze_run_and_bootstrap(spark, tmp_path):
    from tidemark.operators import ingest as G
    from tidemark.operators.control import Runs, bootstrap

    w, clock = G.Warehouse(spark, str(tmp_path)), iter(datetime(2026, 1, 3) + timedelta(seconds=i) for i in range(99))
    now = lambda: next(clock)
    runs = Runs(spark, str(tmp_path / "runs"), now)
    go = lambda name, symbols: G.ingest(w, runs, name, G.rest_extract(spark, symbols, TRANSPORT), now)
    assert go("r1", ["A", "B"]) == 6
    assert go("r2", ["A", "B"]) == 4  # the klines are there already
    with pytest.raises(V.DataQualityError, match="price_not_positive"):
        go("r3", ["A", "BAD"])
    with pytest.raises(ValueError):
        go("r1", ["A"])
    assert [(r.status, r.rows_inserted) for r in runs.table.read().orderBy("pipeline_run_id").collect()] == [("success", 6), ("success", 4), ("failed", None)]
    assert [w.bronze(k).read().count() for k in G.FEEDS] == [4, 4, 2]
    symbols = w.symbols()
    G.sync_symbols(Settings(("A", "B"), 1), symbols)
    symbols.upsert(symbols.read().where("symbol = 'B'").withColumn("bootstrap_status", F.lit("completed")))
    G.sync_symbols(Settings(("A", "B", "C"), 2), symbols)
    assert [(r.symbol, r.history_days, r.bootstrap_status) for r in symbols.read().orderBy("symbol").collect()] == [("A", 2, "pending"), ("B", 1, "completed"), ("C", 2, "pending")]
    bootstrap(symbols, G.history(w, TRANSPORT, 1, now, pages_at_once=2), datetime(2026, 1, 2, 12))
    klines = w.bronze("kline").read()
    assert {r.symbol: r["count"] for r in klines.groupBy("symbol").count().collect()} == {"A": 2162, "B": 1, "C": 2161}
    assert {r.symbol: r.last_bootstrap_open_time for r in symbols.read().collect()}["A"] == datetime(2026, 1, 2, 12)
    staged = G.of_interval(G.market_candles(G.staging(klines, "kline")))
    assert staged.columns[:3] == ["exchange", "symbol", "open_time"] and C.aggregate(staged.where("symbol = 'A'"), 60).count() == 36


def test_incremental_run_equals_refresh(spark, tmp_path):
    minutes = synthetic_minutes(spark, 3000)
    make = lambda df: C.aggregate(df, 15)
    t = I.Table(spark, str(tmp_path / "t"), make(minutes).schema, KEYS, F.to_date("open_time"))
    late = (F.minute("open_time") == 7) & (F.hour("open_time") % 5 == 0)
    for cut in (700, 1900, 3000):
        have = minutes.where(~late) if cut < 3000 else minutes
        I.reprocess(have.where(F.col("open_time") < F.lit(datetime(2026, 7, 1) + timedelta(minutes=cut))), t, make, TIMEFRAMES["15m"].reprocess_days)
    show = lambda df: sorted(map(str, df.select(*KEYS, "close_price", "volume").collect()))
    assert show(t.read()) == show(make(minutes))


def test_formats_and_selections(spark):
    from tidemark.plans import semantic as M

    x = spark.createDataFrame([(v,) for v in (0.0, 999.99, -1500.0, 2.5e6, 7.123e9)], "x double")
    assert [r.s for r in x.select(M.number_format(F.col("x")).alias("s")).collect()] == ["0.00", "999.99", "-1.50K", "2.50M", "7.12B"]
    c = series(spark, range(1, 9))
    assert M.sliced(c, symbol=["S"], start="2026-01-01 02:00:00", end="2026-01-01 04:00:00").count() == 3 and M.sliced(c, exchange=["X"]).count() == 0
    assert M.views(spark, {"candles": c}, "gold") == ["gold_candles"] and spark.sql("SELECT count(*) AS n FROM gold_candles").first().n == 8


def test_retries_and_pages(spark):
    calls, waits = [], []

    def send(path, params):
        calls.append(params)
        if len(calls) < 3:
            raise ConnectionError("lost")
        return 200, "[1]"

    assert retried(send, "/x", {}, sleep=waits.append) == [1] and len(waits) == 2
    for status, body in ((404, "{}"), (200, "no json")):
        with pytest.raises(ClientError):
            retried(lambda *a, s=status, b=body: (s, b), "/x", {}, sleep=waits.append)
    with pytest.raises(ClientError, match="5 attempts"):
        retried(lambda *a: (503, ""), "/x", {}, sleep=waits.append)
    assert pages(0, 1000 * 60_000) == [(0, 59_999_999), (60_000_000, 60_000_000)]
    kline = lambda t: [t, "100", "110", "90", "105", "50", t + 59_999, "1", 10, "2", "3", "0"]
    seen = []

    def exchange(path, params):
        import json

        seen.append(params["startTime"])
        have = [kline(t) for t in range(0, 1001 * 60_000, 60_000) if t >= params["startTime"]]
        return 200, json.dumps(have[: params["limit"]])

    assert [len(b) for b in walk(exchange, "S", 0, 10**9)] == [1000, 1] and seen[1] == 999 * 60_000 + 1
    r = parse_klines(spark.createDataFrame([("S", str(kline(0)).replace("'", '"'))], "symbol string, value string")).first()
    assert (float(r.open_price), r.number_of_trades, float(r.taker_buy_quote_volume)) == (100.0, 10, 3.0)


def test_names_match_their_columns(spark):
    from tidemark.functions import columns as K

    assert {k: list(g()) for k, g in K.FEATURE_GROUPS.items()} == K.FEATURES and {k: list(g()) for k, g in K.SIGNAL_GROUPS.items()} == K.SIGNALS


def test_settings():
    assert cron_of(" 1H ") == "0 * * * *" and trigger_of("5m") == {"processingTime": "5 minutes"}
    with pytest.raises(ValueError):
        cron_of("2h")
    assert supported_intervals() == ("1m", "5m", "15m", "30m", "1h", "1d") and cron_of("5M") == "*/5 * * * *"
    s = Settings.from_mapping({"symbols": ["X"], "days": 3})
    assert s.schedules == {"incremental": "* * * * *", "bootstrap": None, "maintenance": "0 0 * * *"}


def test_settings_from_files(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("sources:\n  binance:\n    symbols: [BTCUSDT, ETHUSDT]\n    historical: {interval: 5m, days: 100}\n")
    assert Settings.from_file(str(path)) == Settings(("BTCUSDT", "ETHUSDT"), 100, "5m")
    path.write_text("")
    assert Settings.from_file(str(path)) == Settings()
    path = tmp_path / "c.json"
    path.write_text('{"sources": {"binance": {"historical": {"interval": "2h"}}}}')
    with pytest.raises(ValueError):
        Settings.from_file(str(path))


def test_logging_is_set_up_once():
    import logging

    from tidemark.logs import get_logger

    log, n = get_logger("a"), len(logging.getLogger().handlers)
    assert get_logger("tidemark.b").parent.name == "tidemark" and log.name == "tidemark.a" and len(logging.getLogger().handlers) == n >= 1


def test_registered_queries_run(spark, sf):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_run_and_bootstrap_control(spark, tmp_path):
    from tidemark.operators.control import SYMBOLS, Runs, bootstrap, maintenance

    now = datetime(2026, 1, 2)
    runs = Runs(spark, str(tmp_path / "runs"), lambda: now)
    run = runs.start("d1")
    runs.fail(run, "x" * 9999)
    assert len(runs.latest().first().error_message) == 4000
    symbols = I.Table(spark, str(tmp_path / "symbols"), SYMBOLS, ["exchange", "symbol"])
    symbols.append(spark.createDataFrame([("B", s, True, 2, "pending", None, None) for s in ("BAD", "GOOD")], SYMBOLS))
    begun = {}

    def load(symbol, start, end, mark):
        begun[symbol] = start
        mark(datetime(2026, 1, 1, 12))
        if symbol == "BAD" and len(begun) < 2:
            raise ValueError("no answer")
        return 1

    with pytest.raises(RuntimeError, match="BAD"):
        bootstrap(symbols, load, now)
    assert {r.symbol: r.bootstrap_status for r in symbols.read().collect()} == {"BAD": "failed", "GOOD": "completed"}
    bootstrap(symbols, load, now)
    assert begun["BAD"] == datetime(2026, 1, 1, 12, 0, 0, 1000)
    minutes = synthetic_minutes(spark, 5)
    assert maintenance(runs, symbols.read(), minutes, {"a": minutes, "b": minutes.limit(2)}, now) == ["the latest run is not a success", "layers differ: {'a': 5, 'b': 2}"]


def test_streaming_candles(spark, tmp_path):
    from tidemark.streaming.candles import candle_stream, upsert_stream

    minutes, src = synthetic_minutes(spark, 20), str(tmp_path / "in")
    minutes.where("minute(open_time) <> 7").write.parquet(src)
    target = I.Table(spark, str(tmp_path / "out"), C.aggregate(minutes, 5).schema, KEYS)
    go = lambda: upsert_stream(candle_stream(spark.readStream.schema(minutes.schema).parquet(src), TIMEFRAMES["5m"]), target, str(tmp_path / "cp")).awaitTermination()
    go()
    assert target.read().count() == 3
    minutes.where("minute(open_time) = 7").write.mode("append").parquet(src)  # late
    go()
    show = lambda df: sorted(map(str, df.select(*KEYS, "close_price", "volume").collect()))
    assert show(target.read()) == show(C.aggregate(minutes, 5))

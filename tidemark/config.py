"""Timeframes, symbols, thresholds and schedules."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Timeframe:
    """One candle length: minutes, days of candles made anew on each run, days read back for windows over them."""

    name: str
    minutes: int
    reprocess_days: int
    lookback_days: int


TIMEFRAMES = {t.name: t for t in (Timeframe("5m", 5, 3, 30), Timeframe("15m", 15, 5, 45), Timeframe("30m", 30, 7, 60), Timeframe("1h", 60, 10, 90), Timeframe("1d", 1440, 30, 400))}

#: Schedules of the supported intervals (fixed values).
CRON = {"1m": "* * * * *", "5m": "*/5 * * * *", "15m": "*/15 * * * *", "30m": "*/30 * * * *", "1h": "0 * * * *", "1d": "0 0 * * *"}
#: Schedule of the maintenance run; the bootstrap has none and is started by hand.
MAINTENANCE = "0 0 * * *"


def supported_intervals() -> tuple[str, ...]:
    return tuple(CRON)


def cron_of(interval: str) -> str:
    """Cron line of an interval, whatever its case and surrounding space; ValueError for others."""
    try:
        return CRON[(interval or "").strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported interval {interval!r}; supported: {', '.join(sorted(CRON))}") from None


def trigger_of(interval: str) -> dict[str, str]:
    """Structured Streaming trigger with the interval's period."""
    cron_of(interval)
    n, unit = int(interval.strip()[:-1]), interval.strip().lower()[-1]
    return {"processingTime": f"{n} {({'m': 'minutes', 'h': 'hours', 'd': 'days'})[unit]}"}


@dataclass(frozen=True)
class Settings:
    """What a run is configured with."""

    symbols: tuple[str, ...] = ("BTCUSDT", "ETHUSDT", "SOLUSDT")
    days: int = 365
    interval: str = "1m"
    exchange: str = "BINANCE"
    options: dict = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, raw: dict) -> Settings:
        """From a parsed configuration file; missing keys take the defaults."""
        symbols = tuple(raw.get("symbols") or cls.symbols)
        if not all(isinstance(s, str) and s.strip() for s in symbols):
            raise ValueError("symbols must be names")
        days = int(raw.get("days", cls.days))
        if days < 1:
            raise ValueError("days must be positive")
        interval = str(raw.get("interval", cls.interval))
        cron_of(interval)
        return cls(symbols, days, interval)

    @classmethod
    def from_file(cls, path: str, source: str = "binance") -> Settings:
        """From a YAML (or JSON) file: symbols and history (days, interval) under sources and the source's name; what is missing takes the defaults."""
        with open(path, encoding="utf-8") as f:
            if path.endswith(".json"):
                raw = json.load(f)
            else:
                import yaml

                raw = yaml.safe_load(f)
        own = ((raw or {}).get("sources") or {}).get(source) or {}
        return cls.from_mapping({"symbols": own.get("symbols"), **(own.get("historical") or {})})

    @property
    def schedule(self) -> str:
        return cron_of(self.interval)

    @property
    def schedules(self) -> dict[str, str | None]:
        """Cron lines of the three kinds of runs."""
        return {"incremental": self.schedule, "bootstrap": None, "maintenance": MAINTENANCE}

from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidelake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", 4,
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
         "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def D(text) -> Decimal:
    return Decimal(str(text))


def T(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def values(df, *columns) -> list[tuple]:
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: tuple(map(repr, r)))


def plan_of(df) -> str:
    """The physical plan as planned (before adaptive changes)."""
    return df._jdf.queryExecution().executedPlan().toString()


CANDLE = (
    "symbol_id long, interval_code string, open_time timestamp, close_time timestamp, "
    "open_price decimal(30,12), high_price decimal(30,12), low_price decimal(30,12), "
    "close_price decimal(30,12), volume_base decimal(30,12), volume_quote decimal(30,12), "
    "num_trades long, taker_buy_quote_volume decimal(30,12)"
)


def candle(symbol, at, o=10, h=None, low=None, c=None, vq=100, taker=40, n=1, interval="1m"):
    at = T(at) if isinstance(at, str) else at
    c = o if c is None else c
    return (
        symbol, interval, at, at + dt.timedelta(seconds=59, milliseconds=999),
        D(o), D(max(o, c) if h is None else h), D(min(o, c) if low is None else low), D(c),
        D(1), None if vq is None else D(vq), n, D(taker),
    )


def candles(spark, *rows):
    return spark.createDataFrame(list(rows), CANDLE)

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: known quote assets, and suffixes of leveraged or synthetic tokens
QUOTE_ASSETS = ("USDT", "BUSD", "FDUSD", "BTC", "ETH", "BNB")
BLOCKED_SUFFIXES = (
    "UPUSDT", "DOWNUSDT", "BULLUSDT", "BEARUSDT",
    "3LUSDT", "3SUSDT", "2LUSDT", "2SUSDT",
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quote_asset(code: Column | str) -> Column:
    """The listed suffix of ``code``; empty if there is none.

    No listed suffix is the tail of another, so at most one branch matches.
    """
    code = _col(code)
    found = [F.when(code.endswith(q), F.lit(q)) for q in QUOTE_ASSETS]
    return F.when(code.isNotNull(), F.coalesce(*found, F.lit("")))


def base_asset(code: Column | str) -> Column:
    code = _col(code)
    return F.substring(code, F.lit(1), F.length(code) - F.length(quote_asset(code)))


def in_universe(code: Column | str, quote_volume: Column | str, quote: str = "USDT") -> Column:
    """Tradable pairs of one quote asset: not leveraged, and traded at all."""
    code = _col(code)
    blocked = reduce(lambda a, b: a | b, (code.endswith(s) for s in BLOCKED_SUFFIXES))
    return code.endswith(quote) & ~blocked & (_col(quote_volume) > 0)

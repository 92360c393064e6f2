"""Column expressions shared by the operators. All of them stay inside the JVM."""

from tidelake.functions.numbers import amount, as_decimal, share
from tidelake.functions.symbols import base_asset, in_universe, quote_asset
from tidelake.functions.times import (
    bucket_start,
    from_millis,
    from_micros,
    sane_time,
    utc_date,
    utc_hour,
)

__all__ = [
    "amount", "as_decimal", "base_asset", "bucket_start", "from_micros", "from_millis",
    "in_universe", "quote_asset", "sane_time", "share", "utc_date", "utc_hour",
]

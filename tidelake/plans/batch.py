"""The six batch stages, from raw records to the top-N mart."""

from __future__ import annotations

import time
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.operators import contract, dims, flow, ranking
from tidelake.operators.candles import TARGETS
from tidelake.operators.filters import of_interval, sane
from tidelake.operators.merge import candle_order, latest_wins
from tidelake.session import partitions_for, stored
from tidelake.sinks import tables
from tidelake.sources import files
from tidelake.streaming.recompute import rebuild_from


@dataclass
class Warehouse:
    """Where the tables live."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def klines(self) -> tables.KeyedTable:
        return tables.fact_klines(self.path("fact_klines"))

    @property
    def tickers(self) -> tables.KeyedTable:
        return tables.fact_ticker(self.path("fact_ticker_24h_snapshots"))

    @property
    def trades(self) -> tables.KeyedTable:
        """The trades of incremental runs, from which the mart is made anew."""
        return tables.recent_trades(self.path("fact_trades"))

    def _snapshot(self, spark: SparkSession, table: str, schema, read=tables.read_snapshot) -> DataFrame:
        found = files._or_none(lambda: read(spark, self.path(table), schema))
        return spark.createDataFrame([], schema) if found is None else found

    def dim(self, spark: SparkSession) -> DataFrame:
        return self._snapshot(spark, "dim_symbols", schemas.DIM_SYMBOLS)

    def metrics(self, spark: SparkSession) -> DataFrame:
        return self._snapshot(spark, "mart_trade_metrics", schemas.MART_TRADE_METRICS)

    def top(self, spark: SparkSession) -> DataFrame:
        return self._snapshot(spark, "mart_top_coins", schemas.MART_TOP_COINS, tables.read_history)


@dataclass
class Inputs:
    """Raw records with a ``symbol`` column; a missing dataset skips its stages.

    ``incremental`` records are landed ones that add to what earlier runs have stored: candles
    compete by version, tickers have the hour of their folder, trades (with times in
    milliseconds) are kept, and a run may come without tickers.
    """

    klines: DataFrame | None = None
    tickers: DataFrame | None = None
    trades: DataFrame | None = None
    incremental: bool = False


@dataclass
class Run:
    timings: dict[str, float] = field(default_factory=dict)
    # rows of known symbols without a usable time, by dataset
    rejects: dict[str, int] = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str):
        start = time.monotonic()
        yield
        self.timings[name] = time.monotonic() - start


def csv_inputs(spark: SparkSession, klines: str, tickers: str, trades: str) -> Inputs:
    """Inputs from CSV paths or globs; fails only if all three are missing."""
    files.audit_inputs(spark, {"klines": klines, "ticker": tickers, "trades": trades})
    return Inputs(
        files.load_csv(spark, klines, schemas.CSV_KLINES),
        files.load_csv(spark, tickers, schemas.CSV_TICKER),
        files.load_trades_csv(spark, trades, schemas.CSV_TRADES),
    )


def run_batch(
    spark: SparkSession,
    inputs: Inputs,
    warehouse: Warehouse,
    top_n: int = 10,
    now: Column | None = None,
    adjust: bool = False,
    targets=TARGETS,
) -> Run:
    """Run every stage whose input is there; each leaves its table in the warehouse."""
    now = F.current_timestamp() if now is None else now
    run = Run()
    klines, tickers, trades = inputs.klines, inputs.tickers, inputs.trades

    with run.stage("dim_symbols"):
        if tickers is not None:
            with stored(dims.distinct_codes(tickers), "codes") as codes:
                known = dims.build_dim(warehouse.dim(spark), codes, now)
                tables.replace_snapshot(known, warehouse.path("dim_symbols"))
        elif not inputs.incremental or warehouse.dim(spark).isEmpty():
            raise FileNotFoundError("the symbol dimension needs ticker records")
    dim = warehouse.dim(spark)

    if klines is not None:
        with ExitStack() as scope:
            with run.stage("fact_klines"):
                # Counted while the rows pass, so that rejects cost no pass of their own.
                read, kept = Observation(), Observation()
                number = F.count(F.lit(1)).alias("n")
                known_rows = dims.with_symbol_id(klines, dim).observe(read, number)
                facts = sane(contract.kline_facts(known_rows, versions=True)).observe(kept, number)
                # Of several versions of a candle the closed, then newest one is final.
                unique = latest_wins(facts, schemas.KEYS["fact_klines"], candle_order(facts))
                minutes = scope.enter_context(stored(unique.drop(*contract.VERSION_FIELDS), "minutes"))
                run.rejects["klines"] = read.get["n"] - kept.get["n"]
                between = candle_order(minutes) if inputs.incremental else None
                with partitions_for(spark, minutes.count()):
                    warehouse.klines.upsert(minutes, staged=True, order=between)
            with run.stage("resample"):
                rebuild_from(warehouse.klines, minutes, targets)

    if trades is not None:
        with run.stage("mart_trade_metrics"):
            # Stored narrow, so that two passes do not parse the raw text twice.
            if inputs.incremental:
                added = contract.recent_trades(dims.with_symbol_id(trades, dim), now, unit="ms")
                added = sane(added.filter("trade_id IS NOT NULL"), "trade_time")
                order = [F.col(c).desc_nulls_last() for c in ("quote_qty", "is_buyer_maker")]
                warehouse.trades.insert_new(latest_wins(added, warehouse.trades.keys, order))
                facts = contract.trade_facts(warehouse.trades.read(spark).withColumnRenamed("qty_base", "qty"))
            else:
                facts = contract.trade_facts(dims.with_symbol_id(trades, dim))
            with stored(facts, "trades") as rows:
                metrics = flow.trade_metrics(rows, now)
                tables.replace_snapshot(metrics, warehouse.path("mart_trade_metrics"))

    if tickers is not None:
        with run.stage("fact_ticker_24h_snapshots"):
            folder = files.layout_time() if inputs.incremental else None
            rows = contract.ticker_facts(dims.with_symbol_id(tickers, dim), now, at=folder)
            order = [F.col("trade_count").desc_nulls_last()]
            unique = latest_wins(sane(rows, "snapshot_time"), schemas.KEYS["fact_ticker_24h_snapshots"], order)
            warehouse.tickers.upsert(unique)

    with run.stage("mart_top_coins"):
        daily = of_interval(warehouse.klines.read(spark), "1d")
        mart = ranking.top_coins(
            daily, warehouse.metrics(spark), dim, top_n, adjust=adjust, computed_at=now
        )
        with stored(mart, "top") as rows:
            tables.append_history(rows, warehouse.path("mart_top_coins"))
    return run

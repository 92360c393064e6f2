"""A sample of the registered queries against their SQL; ``tools/check.py`` runs them all."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidelake.plans.catalog import QUERIES, SQL
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "u2_all_intervals", "a5_whale_ratio", "a12_latest_wins", "a13_reconcile", "k4_merge_replace",
    "k5_merge_rules", "p2_ticker_projection", "p5_ingest_contract", "d1_symbol_dimension",
    "w5_percent_rank_many_ties", "w6_global_rank", "r6_composite_score", "r8_top_coins",
    "r9_adjusted_score", "s4_csv_scan_ticker", "p10_pushed_klines", "d9_symbol_universe",
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, db, name):
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_entry_gives_the_ranking(spark):
    assert entry(spark).count() == 10


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(oracle_sql()) and set(oracle_sql()) <= set(queries())

from __future__ import annotations

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tidelake.operators import ranks


def skewed(n=600, seed=5):
    """Group 0 owns a third of all rows; the order column is unique."""
    rng = random.Random(seed)
    order = rng.sample(range(10 * n), n)
    return [(None if i % 50 == 7 else 0 if i % 3 == 0 else rng.randrange(1, 40), order[i]) for i in range(n)]


@pytest.mark.parametrize("single_task", [True, False])
def test_row_numbers_per_group(spark, single_task):
    rows = skewed()
    df = spark.createDataFrame(rows, "g int, o int")
    got = ranks.row_numbers(df, [F.col("o")], ["g"], group_total="total", single_task=single_task)
    expected = []
    for _, items in groupby(sorted(rows, key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        items = list(items)
        expected += [(g, o, i, len(items)) for i, (g, o) in enumerate(items, 1)]
    assert values(got, "g", "o", "row_num", "total") == sorted(expected, key=lambda r: tuple(map(repr, r)))


def test_row_numbers_over_everything(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g int, o int")
    got = ranks.row_numbers(df, [F.col("o").desc()])
    expected = [(g, o, i) for i, (g, o) in enumerate(sorted(rows, key=lambda r: -r[1]), 1)]
    assert values(got, "g", "o", "row_num") == sorted(expected, key=lambda r: tuple(map(repr, r)))


def percent_rank(items):
    key = [(v is not None, v or 0) for v in items]
    n = len(items)
    return [sum(k < x for k in key) / (n - 1) if n > 1 else 0.0 for x in key]


@pytest.mark.parametrize("how", [
    {}, {"single_task_rows": 0}, {"single_task_rows": 0, "broadcast_rows": 0, "hot_rows": 20},
])
def test_percent_ranks_with_ties_and_nulls(spark, how):
    rng = random.Random(9)
    rows = [(i, None if i % 40 == 0 else 5 if i % 3 == 0 else rng.randrange(60), rng.randrange(9) / 4) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a int, b double")
    got = ranks.percent_ranks(df, "id", {"a": "pa", "b": "pb"}, **how)
    pa, pb = percent_rank([r[1] for r in rows]), percent_rank([r[2] for r in rows])
    assert values(got) == sorted(
        [(*r, x, y) for r, x, y in zip(rows, pa, pb)], key=lambda r: tuple(map(repr, r))
    )


@pytest.mark.parametrize("rows", [[(1, 5)], []])
def test_percent_rank_of_one_or_none(spark, rows):
    df = spark.createDataFrame(rows, "id int, a int")
    for single in (ranks.SINGLE_TASK_ROWS, 0):
        got = ranks.percent_ranks(df, "id", {"a": "p"}, single_task_rows=single)
        assert [r.p for r in got.collect()] == [0.0] * len(rows)


def test_ranged_plan_has_no_single_task_over_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("a"))
    plan = plan_of(ranks.percent_ranks(df, "id", {"a": "p"}, single_task_rows=0))
    assert "SinglePartition" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_rows_are_not_grouped_again_and_stay_where_values_are_few(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"))
    plan = plan_of(ranks.percent_ranks(df, "id", {"a": "p", "b": "q"}, single_task_rows=0))
    assert "Generate" not in plan and "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("per_range", [1, 7, 1_000_000])
def test_ranges_follow_the_number_of_values(spark, per_range, monkeypatch):
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", per_range)
    rows = [(i, i * 37 % 50) for i in range(120)]
    got = ranks.percent_ranks(spark.createDataFrame(rows, "id int, a int"), "id", {"a": "p"}, single_task_rows=0)
    assert values(got, "id", "p") == sorted(
        [(i, p) for (i, _), p in zip(rows, percent_rank([a for _, a in rows]))], key=lambda r: tuple(map(repr, r)))


def test_top_n_sends_only_n_rows_to_the_window(spark):
    df = spark.range(1000)
    top = ranks.top_n(df, [F.col("id").desc()], 3)
    assert values(top, "rank", "id") == [(1, 999), (2, 998), (3, 997)]
    assert "TakeOrderedAndProject" in plan_of(top)

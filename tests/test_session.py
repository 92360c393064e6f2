"""The package reaches Python workers that do not have it installed."""

import os
import subprocess
import sys
from pathlib import Path

from tidelake.session import ROWS_PER_PARTITION, partitions_for

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tidelake.session import get_session, ship_package
spark = get_session("ship", "local[2]", 2, {{"spark.ui.enabled": "false"}})
def run(batches):
    from tidelake.operators import quality
    for b in batches:
        b["where"] = quality.__file__
        yield b
print("WHERE", spark.range(1).mapInPandas(run, "id long, where string").first()[1])
ship_package(spark)
print("FILES", len(spark.sparkContext.listFiles))
"""


def test_workers_import_the_shipped_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=str(Path(__file__).resolve().parents[1]))
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    where = [line for line in done.stdout.splitlines() if line.startswith("WHERE")][0]
    assert ".zip" in where and "FILES 1" in done.stdout


def test_partitions_grow_with_rows_inside_a_block(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    df = spark.range(1_000).groupBy("id").count()

    def planned():
        plan = df.groupBy("count").count()._jdf.queryExecution().executedPlan().toString()
        return [int(part.split(")")[0].split(", ")[-1]) for part in plan.split("hashpartitioning(")[1:]]

    with partitions_for(spark, 7 * ROWS_PER_PARTITION - 1):
        with partitions_for(spark, 1):
            assert planned() == [7]
    assert spark.conf.get(name, None) is None and planned() == [4]

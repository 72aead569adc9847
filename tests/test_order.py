import pytest
from pyspark.sql import functions as F

from shiftkit.operators.order import global_row_number
from shiftkit.plans.changes import apply_change_set, change_results
from shiftkit.plans.runs import append_run_log, run_log_from_outcomes
from shiftkit.sources.config import config_exports, read_job_configs


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_row_numbers_are_each_used_once_and_in_order(spark, parts):
    n = 120_000
    df = spark.range(n).select(F.xxhash64("id").alias("v"), F.rpad(F.lit("x"), 40, "y").alias("pad")).repartition(parts)
    out = global_row_number(df, [F.col("v")])
    r = out.agg(F.min("row_id").alias("a"), F.max("row_id").alias("b"), F.countDistinct("row_id").alias("c"), F.count("*").alias("n")).first()
    assert tuple(r) == (1, n, n, n)
    wrong = out.join(out.select((F.col("row_id") - 1).alias("row_id"), F.col("v").alias("after")), "row_id").where("after < v")
    assert wrong.count() == 0


def test_run_log_keeps_both_operations_of_one_time(spark, tmp_dir):
    st = spark.createDataFrame([("j1", "SUCCESS", "f")], "job string, status string, file_name string")
    for op in ("export", "import", "import"):
        append_run_log(run_log_from_outcomes(st, "2024-01-01 00:00:00", op), f"{tmp_dir}/log")
    assert sorted(r.op for r in spark.read.parquet(f"{tmp_dir}/log").collect()) == ["export", "import"]


@pytest.mark.parametrize("operation", ["update", "upsert"])
def test_a_change_without_id_is_failed_and_not_applied(spark, operation):
    table = spark.createDataFrame([("a", "1")], "id string, v string")
    changes = spark.createDataFrame([("a", "2"), (None, "3")], "id string, v string")
    failed = change_results(table, changes, operation).where("status = 'failure'").collect()
    assert [r.errors for r in failed] == ["id is missing"]
    assert [tuple(r) for r in apply_change_set(table, changes, operation).collect()] == [("a", "2")]


def test_active_false_and_names_with_blanks(spark, tmp_dir):
    with open(f"{tmp_dir}/my job+1.json", "w") as f:
        f.write('{"exports": [{"name": "a", "active": false}, {"name": "b", "active": 0}, {"name": "c", "active": "1"}, {"name": "d"}]}')
    rows = config_exports(read_job_configs(spark, tmp_dir)).orderBy("export_pos").collect()
    assert [r.active for r in rows] == [0, 0, 1, None]
    assert {r.loader_config for r in rows} == {"my job+1.json"}

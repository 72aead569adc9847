import os

from shiftkit.plans.failures import analyse_folder, error_type_counts, failure_totals
from tests.conftest import rows


def write(path, text, enc="utf-8"):
    with open(path, "w", encoding=enc, newline="") as fh:
        fh.write(text)


def test_error_type_counts(spark):
    df = spark.createDataFrame(
        [("[id = 1] bad",), ("[id=2]   bad",), ("",), (None,), ("ref [ABCDEFGHIJKLMNO] gone",),
         ("ref [ABCDEFGHIJKLMNOP] gone",), ("  ",)], "errors string")
    got = rows(error_type_counts(df))
    assert got == sorted([("[id =***] bad", 1), ("[id=***] bad", 1), ("ref [***] gone", 1),
                          ("ref [ABCDEFGHIJKLMNOP] gone", 1)], key=repr)


def test_no_errors_column(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert error_type_counts(df).count() == 0


def test_failure_totals(spark):
    f = spark.createDataFrame([("a",), ("a",), ("b",)], "stem string")
    i = spark.createDataFrame([("a",), ("a",), ("a",), ("c",)], "stem string")
    assert rows(failure_totals(f, i)) == [("a", 3, 2, "paired"), ("b", None, 1, "missing_import")]


def test_analyse_folder(spark, tmp_dir):
    write(os.path.join(tmp_dir, "10_units.csv"), 'id,name__v\n1,"A, Inc"\n2,"multi\nline"\n3,x\n')
    write(os.path.join(tmp_dir, "10_units_FAILURE.csv"),
          'id,name__v,errors\n1,"A, Inc","Value [name__v = A, Inc] too long"\n'
          '2,"multi\nline","Record [Q7K00000042X918] locked"\n')
    write(os.path.join(tmp_dir, "20_kw_FAILURE.csv"), 'name__v,kind,errors\nq,r,"Boom"\n')
    write(os.path.join(tmp_dir, "30_x_SUCCESS.csv"), 'id\n1\n')
    totals, counts, missing = analyse_folder(spark, tmp_dir)
    assert rows(totals) == [("10_units", 3, 2, "paired"), ("20_kw", None, 1, "missing_import")]
    assert rows(counts) == [("10_units", "Record [***] locked", 1),
                            ("10_units", "Value [name__v =***] too long", 1)]
    assert rows(missing) == [("20_kw",)]


def test_run_log_rewrite_is_idempotent(spark, tmp_dir):
    from shiftkit.plans.runs import append_run_log, run_log_from_outcomes
    out = spark.createDataFrame([("j1", "SUCCESS", "a_SUCCESS.csv", "-create x__c -csv a.csv"),
                                 ("j2", "FAILED", None, "-update y__v -csv b.csv")],
                                "job string, status string, file_name string, params string")
    path = f"{tmp_dir}/log"
    append_run_log(run_log_from_outcomes(out, "2024-01-01 00:00:00"), path)
    append_run_log(run_log_from_outcomes(out, "2024-01-02 00:00:00"), path)
    append_run_log(run_log_from_outcomes(out, "2024-01-02 00:00:00"), path)   # retried run
    log = spark.read.parquet(path)
    assert log.count() == 4
    assert sorted(r["object_name"] for r in log.collect()) == ["x__c", "x__c", "y__v", "y__v"]

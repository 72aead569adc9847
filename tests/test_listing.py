"""Listings, header records and outcome folders with odd names, against plain Python and pandas."""

import io
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiftkit.plans.failures import analyse_folder, analyse_pair
from shiftkit.plans.inventory import header_inventory
from shiftkit.sources.files import HeaderFinder, latest_file, read_by_layout, read_header, scan_csv_headers
from shiftkit.sources.listing import list_tree, literal
from tests.conftest import rows


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data.encode() if isinstance(data, str) else data)


def test_list_tree_names_every_file_as_it_is(spark, tmp_dir):
    names = ["a.csv", "sub x/my file_upd_.csv", "sub x/deep [1] {2}/ä+b%20c.csv", "empty.csv", "sub x/other.txt", "_hidden.csv", ".dot/x.csv"]
    for n in names:
        write(f"{tmp_dir}/{n}", "" if n == "empty.csv" else "id,a\n1,2\n")
    got = {r.path: r.length for r in list_tree(spark, tmp_dir, "*.csv").collect()}
    want = {f"file:{tmp_dir}/{n}": 0 if n == "empty.csv" else 9 for n in names[:4]}
    assert got == want
    assert list_tree(spark, f"{tmp_dir}/nowhere").count() == 0
    assert {r.path for r in list_tree(spark, f"file:{tmp_dir}/sub x", "*.csv").collect()} == {p for p in want if "sub x" in p}


def test_inventory_of_names_with_blanks(spark, tmp_dir):
    write(f"{tmp_dir}/root dir/sub x/my file_upd_.csv", "\n \nid,name__v\n1,2\n")
    mapping = spark.createDataFrame([("sub x", "my file_upd_.csv", "Unit")], "relative_path string, filename string, object_type string")
    out = header_inventory(spark, f"{tmp_dir}/root dir", mapping)
    assert [tuple(r) for r in out["joined"].select("relative_path", "filename", "object_type", "headers").collect()] == [
        ("sub x", "my file_upd_.csv", "Unit", ["id", "name__v"])]


def test_latest_of_equal_times_is_the_last_path(spark):
    df = spark.createDataFrame([("/x/b.csv", 5), ("/x/c.csv", 5), ("/x/z.csv", 4)], "path string, t long")
    got = latest_file(df.select("path", F.timestamp_seconds("t").alias("modificationTime"))).first()
    assert got["path"] == "/x/c.csv"


def test_header_record_as_pandas_reads_it(tmp_dir):
    rng = random.Random(4)
    bits = ["a", "b c", '"q"', '"x,y"', '"l1\nl2"', '"cr\r\nx"', '"d""q"', 'm"id', "é", "", " "]
    for k in range(400):
        end = rng.choice(["\n", "\r\n", "\r"])
        # With CR alone pandas takes a blank line and a line that starts with a blank for one.
        blank = "" if end == "\r" else rng.choice(["", "", end, end + end, "  " + end, "\t" + end + end])
        cells = [rng.choice(bits) for _ in range(rng.randint(1, 5))]
        if end == "\r":
            cells = [c.replace("\r\n", "-").replace("\n", "-") for c in cells]
        text = blank + ",".join(cells) + rng.choice([end + "1" + ",2" * (len(cells) - 1) + end, end, ""])
        path = f"{tmp_dir}/{k}.csv"
        write(path, text)
        try:
            want = list(pd.read_csv(io.BytesIO(text.encode()), dtype=str, nrows=0).columns)
        except pd.errors.EmptyDataError:
            want = None
        assert read_header(path)[0] == want, (text, want)


def test_header_finder_in_pieces_of_any_size():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(['"', ",", "\n", "\r", "a", " "]) for _ in range(rng.randint(0, 30))).encode()
        whole = HeaderFinder().feed(text, last=True)
        finder, got, at = HeaderFinder(), None, 0
        while got is None:
            n = rng.randint(1, 4)
            piece, at = text[at:at + n], at + n
            got = finder.feed(piece, last=not piece)
        assert got == whole, text


def test_header_of_100_mb_without_line_end(tmp_dir):
    path = f"{tmp_dir}/big.csv"
    write(path, b"abc,defg," * (100_000_000 // 9))
    t0 = time.time()
    names, enc, err = read_header(path)
    assert err is None and len(names) > 20_000_000 and names[:2] == ["abc", "defg"] and names[2] == "abc.1"
    assert time.time() - t0 < 120


def outcome_folder(tmp_dir):
    d = f"{tmp_dir}/out dir [1]"
    write(f"{d}/my file.csv", 'id,name\n1,"a\nb"\n2,x\n3,y\n')
    write(f"{d}/my file_FAILURE.csv", '\n\nerrors,id\n"Boom [k = v]",1\n')
    write(f"{d}/zero_FAILURE.csv", "id,errors\n")
    write(f"{d}/zero.csv", "id\n")
    write(f"{d}/lost_FAILURE.csv", "id,errors\n1,Gone\n2,\n")
    write(f"{d}/plain_FAILURE.csv", "id,name\n1,x\n")
    write(f"{d}/plain.csv", "id,name\n1,x\n2,y\n")
    write(f"{d}/run 2/my file.csv", "id\n9\n")
    write(f"{d}/run 2/my file_FAILURE.csv", "id,errors\n9,Other\n")
    write(f"{d}/run 2/my file_SUCCESS.csv", "id\n8\n")
    return d


def test_outcome_folder_with_blanks_brackets_and_empty_files(spark, tmp_dir):
    d = outcome_folder(tmp_dir)
    totals, counts, missing = analyse_folder(spark, d, by_folder=True)
    here, run2 = f"file:{d}", f"file:{d}/run 2"
    assert rows(totals) == sorted([(here, "my file", 3, 1, "paired"), (here, "zero", 0, 0, "paired"), (here, "lost", None, 2, "missing_import"),
                                   (here, "plain", 2, 1, "paired"), (run2, "my file", 1, 1, "paired")], key=repr)
    assert rows(counts) == sorted([(here, "my file", "Boom [k =***]", 1), (run2, "my file", "Other", 1)], key=repr)
    assert rows(missing) == [(here, "lost")]


def test_single_pair(spark, tmp_dir):
    d = outcome_folder(tmp_dir)
    totals, counts = analyse_pair(spark, f"{d}/my file.csv", f"{d}/lost_FAILURE.csv")
    assert rows(totals) == [(3, 2)] and rows(counts) == [("Gone", 1)]
    totals, counts = analyse_pair(spark, f"{d}/nowhere.csv", f"{d}/plain_FAILURE.csv")
    assert rows(totals) == [(None, 1)] and rows(counts) == []


def test_a_thousand_layouts_are_one_scan(spark, tmp_dir):
    n = 1_000
    for i in range(n):
        write(f"{tmp_dir}/f/{i}_FAILURE.csv", f"c{i},errors,d{i}\n{i},E{i % 3},z\n")
    heads = scan_csv_headers(spark, f"{tmp_dir}/f")
    df = read_by_layout(spark, heads, literal(f"{tmp_dir}/f"), "*.csv")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1
    got = df.select(F.element_at("values", "errors").alias("e"), F.size("values").alias("k")).groupBy("e", "k").count()
    assert rows(got) == [("E0", 3, 334), ("E1", 3, 333), ("E2", 3, 333)]


@pytest.mark.parametrize("glob", ["*.csv", "f?.csv"])
def test_globs(spark, tmp_dir, glob):
    write(f"{tmp_dir}/f1.csv", "a\n")
    assert list_tree(spark, tmp_dir, glob).count() == 1

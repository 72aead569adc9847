"""Records of quoted CSV across byte ranges, against Python's csv module and Spark's own multi-line reader."""

import csv
import io
import random

import pytest

from shiftkit.sources.files import read_object_csv
from shiftkit.sources.records import read_records, read_split_csv


def write(path, rows, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        csv.writer(fh, lineterminator=newline).writerows(rows)


def texts(n, seed):
    rng = random.Random(seed)
    pick = ['plain', 'with "quotes"', 'two\nlines', 'a,b', '""', '\n\n', '"\n"', 'é漢\n😀', '', 'x' * 300, 'cr\r\nlf', ' lead', "'"]
    return [[str(i), rng.choice(pick) + rng.choice(pick), rng.choice(pick)] for i in range(n)]


@pytest.fixture()
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_records_across_ranges(spark, tmp_dir, small_ranges, newline, broadcast):
    want = {}
    for k in range(4):
        rows = [["id", "a\nb" if k == 1 else "a", "c"], *texts(120, k)]
        if k == 2:
            rows[40][1] = "long\n" * 2_000                  # one field over many ranges
        if k == 3:
            rows = rows[:1]
        write(f"{tmp_dir}/f{k}.csv", rows, newline)
        want[f"f{k}.csv"] = rows
    open(f"{tmp_dir}/empty.csv", "w").close()
    df = read_records(spark, tmp_dir, "*.csv", broadcast_ranges=broadcast)
    got = {}
    for r in df.collect():
        row = next(csv.reader(io.StringIO(r.record, newline="")))
        got.setdefault(r.file.split("/")[-1], []).append((row, r.first))
    assert set(got) == set(want)
    for name, rows in want.items():
        assert sorted(x for x, _ in got[name]) == sorted(rows)
        assert [x for x, first in got[name] if first] == [rows[0]]


def test_split_reader_equals_multiline(spark, tmp_dir, small_ranges):
    write(f"{tmp_dir}/big.csv", [["id", "b c", "d"], *texts(400, 9)])
    got = read_split_csv(spark, f"{tmp_dir}/big.csv")
    want = read_object_csv(spark, f"{tmp_dir}/big.csv")
    assert got.columns == want.columns
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(got) == key(want)
    assert spark.read.text(f"{tmp_dir}/big.csv").rdd.getNumPartitions() > 10          # one file, many tasks


def test_blank_lines_and_missing_last_break(spark, tmp_dir, small_ranges):
    with open(f"{tmp_dir}/x.csv", "w") as fh:
        fh.write('\n\nid,a\n1,"x\n\ny"\n\n2,z')
    assert sorted(map(tuple, read_split_csv(spark, f"{tmp_dir}/x.csv", ["id", "a"]).collect())) == [("1", "x\n\ny"), ("2", "z")]

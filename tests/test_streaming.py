import os

from shiftkit.streaming import start_failure_stream
from tests.conftest import rows


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_failure_stream_counts_new_files_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    out = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write(f"{landing}/a_FAILURE.csv", 'id,errors\n1,"bad [k = v]"\n2,"bad [k=w]"\n')
    write(f"{landing}/b_FAILURE.csv", 'x,y,errors\n1,2,"gone [Q7K00000042X918]"\n')
    write(f"{landing}/a.csv", "id\n1\n2\n")
    q = start_failure_stream(spark, landing, out, checkpoint=ckpt)
    q.awaitTermination()
    first = spark.read.parquet(out)
    assert rows(first.drop("batch_id")) == [("a", "bad [k =***]", 1), ("a", "bad [k=***]", 1),
                                            ("b", "gone [***]", 1)]
    write(f"{landing}/c_FAILURE.csv", 'id,errors\n1,"late"\n')
    q = start_failure_stream(spark, landing, out, checkpoint=ckpt)
    q.awaitTermination()
    second = spark.read.parquet(out)
    assert second.count() == 4
    assert rows(second.where("stem = 'c'").drop("batch_id")) == [("c", "late", 1)]

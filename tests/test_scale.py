"""What landed input and its readers cost as tables grow: plans, bytes and files."""

import json
import os

from shiftkit.sources.config import config_imports, read_job_configs
from tests.conftest import rows


def test_settings_are_parsed_once_a_configuration(spark, tmp_dir):
    texts = [{"import_settings": {"dns": "https://a", "import_path": "/data/a"}, "imports": [{"name": f"imp_{i}", "active": i % 2} for i in range(3)]},
             {"import_settings": {"import_path": "/data/b"}, "imports": []}, {"imports": [{"name": "alone"}, None]}]
    spark.createDataFrame([(json.dumps(t),) for t in texts], "value string").coalesce(1).write.text(f"{tmp_dir}/c")
    im = config_imports(read_job_configs(spark, f"{tmp_dir}/c", multiline=False))
    assert rows(im, "base_import_path", "target_dns", "import_pos", "name", "active") == sorted(
        [("/data/a", "https://a", i, f"imp_{i}", i % 2) for i in range(3)] + [(None, None, 0, "alone", None)], key=repr)
    plan = im._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Generate posexplode")
    assert "import_settings" in below and "import_settings" not in above and "value#" not in above


def test_configurations_shuffle_keys_and_land_compressed(spark, tmp_dir, monkeypatch):
    from shiftkit import registry
    spark.createDataFrame([(i, "5-LOW" if i % 2 else None, "F" if i % 3 else "O") for i in range(400)],
                          "o_orderkey long, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(i // 3, i % 3, i, "RAN"[i % 3], "O") for i in range(900)] + [(None, 1, 1, "R", "O"), (7, None, None, None, None)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_dir}/lineitem.parquet")
    monkeypatch.setattr(registry, "CONFIGS_PER_FILE", 100)
    registry._write_configs(spark, tmp_dir, f"{tmp_dir}/c")
    texts = [r[0] for r in spark.read.text(f"{tmp_dir}/c").collect()]
    files = [f for f in os.listdir(f"{tmp_dir}/c") if f.startswith("part-")]
    assert len(texts) == 400 and len(files) >= 4
    assert sum(os.path.getsize(f"{tmp_dir}/c/{f}") for f in files) < sum(map(len, texts)) / 5
    by_path = {c["import_settings"]["import_path"]: c for c in map(json.loads, texts)}
    assert "exports" not in by_path["/data/399"] and isinstance(by_path["/data/0"]["export_settings"], list)
    assert by_path["/data/7"]["exports"][0] == {"columns": ["id", "name__v", None], "ignore_column": ["id"]}
    assert by_path["/data/7"]["exports"][2] == {
        "name": "exp_7_1", "params": "-export item__c -csv exp_7_1.csv", "where": "l_partkey = 22", "columns": ["id", "name__v", "part_22"],
        "ignore_column": ["id"], "active": 1, "status": "O"}
    assert by_path["/data/7"]["imports"][1] == {
        "name": "imp_7_0", "params": "-update item__c -csv imp_7_0.csv -idParam id", "active": 0, "status": "O",
        "business_object_type": "Item", "referenced_objects": "part_21"}


def test_large_tables_are_written_as_several_split_files(spark, tmp_dir):
    from shiftkit.job_queries import _write_documents_csv
    from shiftkit.sources.records import read_split_csv
    docs = [(i, f'line "{i}"\nnext, line' if i % 3 else None, "en", f"s{i % 2}", i) for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").repartition(8).write.parquet(f"{tmp_dir}/documents.parquet")
    size = sum(os.path.getsize(f"{tmp_dir}/documents.parquet/{f}") for f in os.listdir(f"{tmp_dir}/documents.parquet") if f.endswith(".parquet"))
    for file_bytes, n in ((size + 1, 1), (size // 3 + 1, 3)):
        _write_documents_csv(spark, tmp_dir, f"{tmp_dir}/csv{n}", file_bytes)
        assert len([f for f in os.listdir(f"{tmp_dir}/csv{n}") if f.endswith(".csv")]) == n
        back = read_split_csv(spark, f"{tmp_dir}/csv{n}", glob="*.csv")
        assert rows(back) == sorted([tuple(None if v is None else str(v) for v in d) for d in docs], key=repr)


def test_csv_tree_is_landed_compressed_and_whole(spark, tmp_dir):
    from shiftkit.registry import QUERIES, TREE_TABLES, csv_tree
    from shiftkit.sources.files import read_object_csv
    for t in TREE_TABLES:
        spark.range(2_000).selectExpr("id", f"concat('{t} ', id % 9) as `{t[0]}_name, of`").coalesce(1).write.parquet(f"{tmp_dir}/{t}.parquet")
    assert rows(QUERIES["S2_scan_csv_headers"](spark, tmp_dir)) == sorted([(t, h) for t in TREE_TABLES for h in ("id", f"{t[0]}_name, of")], key=repr)
    assert QUERIES["S6_latest_snapshot"](spark, tmp_dir).first()[0] in TREE_TABLES
    for t in TREE_TABLES:
        folder = csv_tree(spark, tmp_dir).removeprefix("file:") + f"/{t}"
        back = read_object_csv(spark, folder)
        assert back.count() == 2_000
        text = sum(len(",".join(r)) + 1 for r in back.collect())
        assert sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("part-")) < text / 2

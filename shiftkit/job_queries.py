"""Further queries of the jobs, next to :mod:`shiftkit.registry`: whole jobs and their parts on the given tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shiftkit.functions.names import flat_names
from shiftkit.registry import landed, register, table

# --- P3: relation paths in export definitions -------------------------------------
# orders, customer, nation and region as objects with foreign keys.  One order in
# five has no customer, one in seven points to a customer that is not there;
# customers of nation 4 have no nation.


def object_tables(spark, sf_dir):
    """Object name -> its table."""
    def t(name):
        return table(spark, sf_dir, name)
    key = F.col("o_custkey")
    return {
        "order__c": lambda: t("orders").select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).when(F.col("o_orderkey") % 7 == 0, -key).otherwise(key).alias("customer__c"),
            F.col("o_orderstatus").alias("state__v"), F.col("o_totalprice").alias("total__c")),
        "customer__c": lambda: t("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name__v"), F.col("c_mktsegment").alias("segment__c"),
            F.nullif(F.col("c_nationkey"), F.lit(4)).alias("nation__c")),
        "nation__c": lambda: t("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name__v"), F.col("n_regionkey").alias("region__c")),
        "region__c": lambda: t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name__v")),
    }


def object_relations():
    from shiftkit.plans.relations import Relation
    return {"order__c": [Relation("customer__c", "customer__c")], "customer__c": [Relation("nation__c", "nation__c")],
            "nation__c": [Relation("region__c", "region__c")]}


# A job file's definitions: paths of one, two and three hops, relations called by
# their name and by their key, a filter through relations that no column uses,
# and a condition that records without parent meet.
RELATION_EXPORTS = [
    {"name": "24_orders_of_automobile", "params": "-export order__c -csv 24_orders.csv",
     "where": "customer__cr.segment__c = 'AUTOMOBILE' AND state__v <> 'P'",
     "columns": ["id", "customer__cr.name__v", "customer__cr.nation__cr.name__v", "customer__c.nation__c.region__c.name__v", "state__v"],
     "ignore_column": ["id"], "active": 1},
    {"name": "25_orders_of_region", "params": "-export order__c -csv 25_orders.csv",
     "where": "customer__cr.nation__cr.region__cr.name__v = 'ASIA' AND total__c >= 1000",
     "columns": ["id", "total__c"], "active": 1},
    {"name": "26_orders_without_nation", "params": "-export order__c -csv 26_orders.csv",
     "where": "customer__cr.nation__cr.name__v IS NULL", "columns": ["id", "customer__c", "customer__cr.name__v"], "active": 1},
]

ORDERS_SQL = """
WITH o AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS customer__c,
         o_orderstatus AS state__v, o_totalprice AS total__c FROM orders),
c AS (SELECT c_custkey AS cid, c_name AS cname, c_mktsegment AS segment, nullif(c_nationkey, 4) AS nk FROM customer),
j AS (
  SELECT o.*, c.cname, c.segment, n.n_name AS nname, r.r_name AS rname
  FROM o LEFT JOIN c ON o.customer__c = c.cid LEFT JOIN nation n ON c.nk = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


@register("P3_export_definition", ORDERS_SQL + """
SELECT id AS "ignore__id", cname AS "customer__cr__name__v", nname AS "customer__cr__nation__cr__name__v",
       rname AS "customer__c__nation__c__region__c__name__v", state__v
FROM j WHERE segment = 'AUTOMOBILE' AND state__v <> 'P'
""")
def q_export_definition(spark, sf_dir):
    """Multi-hop columns and a relation filter: each parent joined once."""
    from shiftkit.plans.relations import resolve_export
    objects, d = object_tables(spark, sf_dir), RELATION_EXPORTS[0]
    return flat_names(resolve_export(objects["order__c"](), "order__c", lambda o: objects[o](), object_relations(),
                                     d["where"], d["columns"], d["ignore_column"]))


@register("P3_relation_filter", ORDERS_SQL + "SELECT id, total__c FROM j WHERE rname = 'ASIA' AND total__c >= 1000")
def q_relation_filter(spark, sf_dir):
    """A relation that only the filter goes through: a semi-join with the filtered parent."""
    from shiftkit.plans.relations import resolve_export
    objects, d = object_tables(spark, sf_dir), RELATION_EXPORTS[1]
    return resolve_export(objects["order__c"](), "order__c", lambda o: objects[o](), object_relations(), d["where"], d["columns"])


def _run_relation_exports(spark, sf_dir, path):
    from shiftkit.plans.runs import run_exports
    from shiftkit.sources.config import read_job_configs
    objects = object_tables(spark, sf_dir)
    spark.createDataFrame([(json.dumps({"export_settings": {"dns": "https://a.example.com"}, "exports": RELATION_EXPORTS}),)],
                          "value string").write.text(f"{path}/config")
    run_exports(spark, read_job_configs(spark, f"{path}/config", multiline=False), lambda o: objects[o](), f"{path}/out",
                "2024-01-01 00:00:00", f"{path}/log", relations=object_relations())


@register("P3_run_exports", ORDERS_SQL + """
SELECT '24_orders_of_automobile' AS job, 'SUCCESS' AS status, count(*) AS row_count FROM j WHERE segment = 'AUTOMOBILE' AND state__v <> 'P'
UNION ALL SELECT '25_orders_of_region', 'SUCCESS', count(*) FROM j WHERE rname = 'ASIA' AND total__c >= 1000
UNION ALL SELECT '26_orders_without_nation', 'SUCCESS', count(*) FROM j WHERE nname IS NULL
""")
def q_run_exports(spark, sf_dir):
    """The whole export job on a job file with relation paths: its run log."""
    path = landed(spark, sf_dir, "relation_exports", lambda p: _run_relation_exports(spark, sf_dir, p))
    return spark.read.parquet(f"{path}/log").select("job", "status", "row_count")


@register("P3_run_exports_rows", ORDERS_SQL + """
SELECT CAST(id AS VARCHAR) AS id, CAST(customer__c AS VARCHAR) AS customer__c, cname AS "customer__cr__name__v" FROM j WHERE nname IS NULL
""")
def q_run_exports_rows(spark, sf_dir):
    """What that job wrote for the definition whose condition records without parent meet."""
    from shiftkit.sources.files import read_object_csv
    path = landed(spark, sf_dir, "relation_exports", lambda p: _run_relation_exports(spark, sf_dir, p))
    return flat_names(read_object_csv(spark, f"{path}/out/source_key=a.example.com/*/26_orders_without_nation"))


# --- S1: quoted CSV split by bytes ------------------------------------------------

#: Parquet bytes of the table that go into one CSV file, written by one task.
ONE_CSV_BYTES = 256 << 20


def _write_documents_csv(spark, sf_dir, path, file_bytes=ONE_CSV_BYTES):
    """``documents`` as one quoted CSV file, or as several of ``file_bytes`` each when it is larger."""
    from shiftkit.operators.sinks import write_csv
    from shiftkit.sources.files import list_files
    size = list_files(spark, f"{sf_dir.rstrip('/')}/documents.parquet").agg(F.sum("length")).first()[0] or 0
    write_csv(table(spark, sf_dir, "documents").coalesce(1 + size // file_bytes), path)


@register("S1_split_csv", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents
""")
def q_split_csv(spark, sf_dir):
    """Whole texts written as quoted CSV, a few large files, each read back by many tasks."""
    from shiftkit.sources.records import read_split_csv
    path = landed(spark, sf_dir, "documents_one_csv", lambda p: _write_documents_csv(spark, sf_dir, p))
    return read_split_csv(spark, path, glob="*.csv")


# --- K2: versions in hash buckets ---------------------------------------------------
# customer as an object table in 256 buckets; the archive set, repeated ids and
# new rows of the registry's change set are applied as one upsert, then the
# archive set once more as an update.

def _write_store(spark, sf_dir, path):
    from shiftkit.plans.changes import derive_archive_set
    from shiftkit.plans.versions import VersionStore
    from shiftkit.registry import ARCHIVE, change_rows, org_views
    orgs, types = org_views(spark, sf_dir)
    store = VersionStore(spark, path)
    store.create(orgs.select("id", "name__v", "state__v"), buckets=256)
    store.apply(change_rows(spark, sf_dir), "upsert")
    store.apply(derive_archive_set(orgs.drop("c_acctbal"), types, **ARCHIVE), "update")


def store_of(spark, sf_dir):
    from shiftkit.plans.versions import VersionStore
    return VersionStore(spark, landed(spark, sf_dir, "customer_store", lambda p: _write_store(spark, sf_dir, p)))


def _applied_sql() -> str:
    from shiftkit.registry import CHANGES_SQL
    return CHANGES_SQL + """,
ok AS (SELECT ch.* FROM ch JOIN cnt USING (id) WHERE cnt.n = 1),
v1 AS (SELECT coalesce(t.id, ok.id) AS id, coalesce(ok.name__v, t.name__v) AS name__v, coalesce(ok.state__v, t.state__v) AS state__v
       FROM t FULL OUTER JOIN ok ON t.id = ok.id)
"""


@register("K2_store_newest", _applied_sql() + """
SELECT v1.id, coalesce(arch.name__v, v1.name__v) AS name__v, coalesce(arch.state__v, v1.state__v) AS state__v
FROM v1 LEFT JOIN arch ON v1.id = arch.id
""")
def q_store_newest(spark, sf_dir):
    """The newest version after both change sets."""
    return store_of(spark, sf_dir).read()


@register("K2_store_earlier", _applied_sql() + "SELECT id, name__v, state__v FROM v1")
def q_store_earlier(spark, sf_dir):
    """The version between them: as it was, though later sets were applied."""
    return store_of(spark, sf_dir).read(1)


@register("K2_store_rewritten", _applied_sql() + """
SELECT 'update' AS change_set, count(DISTINCT id) AS n_ids, true AS no_more_buckets_than_ids, true AS others_are_the_same FROM arch
""")
def q_store_rewritten(spark, sf_dir):
    """Folders of the newest version that the one before doesn't have, against the ids of the change set."""
    from shiftkit.plans.changes import derive_archive_set
    from shiftkit.registry import ARCHIVE, org_views
    store = store_of(spark, sf_dir)
    orgs, types = org_views(spark, sf_dir)
    arch = derive_archive_set(orgs.drop("c_acctbal"), types, **ARCHIVE)
    old, new = store.folders(1), store.folders(2)
    changed = [b for b in new if new[b] != old.get(b)]
    hit, _ = store.hit(arch, 1)
    return arch.agg(F.countDistinct("id").alias("n_ids")).select(
        F.lit("update").alias("change_set"), "n_ids", (F.lit(len(changed)) <= F.col("n_ids")).alias("no_more_buckets_than_ids"),
        F.lit(set(changed) <= set(hit)).alias("others_are_the_same"))


# --- K4: the run log's commit protocol ------------------------------------------------
# One run a priority of orders, all under one time.  The first attempt of each
# run dies after staging, the second publishes, a third comes too late.

def _write_run_log(spark, sf_dir, path):
    from shiftkit.plans.runlog import log_run, stage_run
    from shiftkit.plans.runs import reconcile_imports, run_log_from_outcomes
    from shiftkit.registry import load_jobs, outcome_listing
    jobs = load_jobs(spark, sf_dir)
    st = reconcile_imports(jobs, outcome_listing(spark, sf_dir), exact=True, keep=["run"])
    st = st.join(jobs.select("job", "params"), "job", "left").cache()
    for (run,) in st.select("run").distinct().orderBy("run").collect():                # the five priorities
        log = run_log_from_outcomes(st.where(F.col("run") == run), "2024-01-01 00:00:00")
        stage_run(log, path, run)
        log_run(log, path, run)
        log_run(log, path, run)
    st.unpersist()


def _run_log_sql() -> str:
    from shiftkit.registry import OUTCOME_SQL, _reconcile_select
    return OUTCOME_SQL + _reconcile_select("f.fstem = j.stem") + "SELECT run AS run_id, status, count(*) AS n FROM st GROUP BY ALL"


@register("K4_published_runs", _run_log_sql())
def q_published_runs(spark, sf_dir):
    """Runs of one time all stay; staged rows of dead and late attempts are not read."""
    from shiftkit.plans.runlog import read_run_log
    path = landed(spark, sf_dir, "published_log", lambda p: _write_run_log(spark, sf_dir, p))
    return read_run_log(spark, path).groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))


# --- A9: gaps between pages --------------------------------------------------------------
# customer as a paged query for each segment, 10 rows a page: every seventh
# page is lost, every fifth came twice, and every eleventh starts 3 rows early.

def _write_paged(spark, sf_dir, path):
    from pyspark.sql import Window
    c = table(spark, sf_dir, "customer")
    w = Window.partitionBy("c_mktsegment").orderBy("c_custkey")
    pages = (c.withColumn("i", F.row_number().over(w) - 1).withColumn("page", F.floor(F.col("i") / 10))
             .groupBy("c_mktsegment", "page").agg(F.count(F.lit(1)).alias("n")))
    total = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("total"))
    early = F.when((F.col("page") % 11 == 10), 3).otherwise(0)
    pages = (pages.join(total, "c_mktsegment").where("page % 7 <> 6")
             .withColumn("copy", F.explode(F.when(F.col("page") % 5 == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))))
    rows = F.transform(F.sequence(F.lit(1), (F.col("n") + early).cast("int")), lambda i: F.struct(i.alias("id")))
    pages.select("c_mktsegment", F.struct((F.col("page") * 10 - early).alias("offset"), F.col("n").alias("size"),
                                          F.col("total").alias("total")).alias("responseDetails"), rows.alias("data")).write.json(path)


@register("A9_page_gaps", """
WITH c AS (SELECT c_mktsegment AS query, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS i FROM customer),
p AS (SELECT query, i // 10 AS page, count(*) AS n FROM c GROUP BY ALL),
t AS (SELECT query, count(*) AS total FROM c GROUP BY ALL),
k AS (SELECT query, page, page * 10 - CASE WHEN page % 11 = 10 THEN 3 ELSE 0 END AS a, page * 10 + n AS b FROM p WHERE page % 7 <> 6),
o AS (SELECT *, coalesce(max(b) OVER (PARTITION BY query ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM k)
SELECT query, 'missing' AS kind, seen AS "from", a AS "to" FROM o WHERE a > seen
UNION ALL SELECT query, 'overlapping', a, least(b, seen) FROM o WHERE a < seen
UNION ALL SELECT query, 'repeated', a, b FROM k WHERE page % 5 = 4
UNION ALL SELECT query, 'missing', e, total FROM (SELECT query, max(b) AS e FROM k GROUP BY query) x JOIN t USING (query) WHERE total > e
""")
def q_page_gaps(spark, sf_dir):
    from shiftkit.sources.config import page_gaps
    path = landed(spark, sf_dir, "paged_queries", lambda p: _write_paged(spark, sf_dir, p))
    detail = "c_mktsegment string, responseDetails struct<offset: bigint, total: bigint>, data array<struct<id: bigint>>"
    pages = spark.read.schema(detail).json(path).select(
        F.col("c_mktsegment").alias("query"), "responseDetails.offset", F.size("data").alias("size"), "responseDetails.total")
    return page_gaps(pages, by=["query"], span=1_000)


# --- J10, A3, A2: an outcome folder in one scan ---------------------------------------------
# One loader run a year of orders: its import file, failure file and sometimes
# none of the latter's rows.  Each year's files have a layout of their own, and
# folder and file names hold blanks.

def _write_outcomes(spark, sf_dir, path):
    from shiftkit.operators.sinks import write_csv
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    for (y,) in o.select("y").distinct().orderBy("y").collect():                         # seven years
        mine = o.where(F.col("y") == y).select("o_orderkey", F.col("o_orderstatus").alias(f"state {y}"),
                                               F.concat(F.lit("Order [id = "), "o_orderkey", F.lit("]\n is "), "o_orderpriority").alias("errors"))
        if y % 4 != 1:
            write_csv(mine.drop("errors"), f"{path}/out dir/load {y}.csv")
        failed = mine.where(F.lit(y % 3 != 0) & (F.col(f"state {y}") == "P"))
        write_csv(failed if y % 2 else failed.select("errors", f"state {y}", "o_orderkey"), f"{path}/out dir/load {y}_FAILURE.csv")


OUTCOMES_SQL = """
WITH o AS (SELECT year(o_orderdate) AS y, o_orderstatus, o_orderpriority FROM orders),
t AS (
  SELECT y, CASE WHEN y % 4 <> 1 THEN count(*) END AS rows_to_import,
         CAST(CASE WHEN y % 3 <> 0 THEN count_if(o_orderstatus = 'P') ELSE 0 END AS BIGINT) AS rows_failed FROM o GROUP BY y)
"""


def outcomes(spark, sf_dir):
    from shiftkit.plans.failures import analyse_folder
    path = landed(spark, sf_dir, "outcome_folder", lambda p: _write_outcomes(spark, sf_dir, p))
    return analyse_folder(spark, f"{path}/out dir")


@register("J10_outcome_folder", OUTCOMES_SQL + """
SELECT 'load ' || y AS stem, rows_to_import, rows_failed, CASE WHEN rows_to_import IS NULL THEN 'missing_import' ELSE 'paired' END AS partner FROM t
""")
def q_outcome_folder(spark, sf_dir):
    """A3 of every failure file of the folder, those without rows and without partner included."""
    return outcomes(spark, sf_dir)[0]


@register("J10_outcome_errors", OUTCOMES_SQL + """
SELECT 'load ' || y AS stem, 'Order [id =***] is ' || o_orderpriority AS error, count(*) AS n
FROM o JOIN t USING (y) WHERE o_orderstatus = 'P' AND y % 3 <> 0 AND rows_to_import IS NOT NULL GROUP BY ALL
""")
def q_outcome_errors(spark, sf_dir):
    """A2 of the paired ones, read in one scan whatever their layouts."""
    return outcomes(spark, sf_dir)[1]


# --- runs of many definitions ---------------------------------------------------------------
# Twenty export definitions over two objects, four at a time.

def _write_many(spark, sf_dir, path):
    from shiftkit.plans.runs import run_exports
    from shiftkit.sources.config import read_job_configs
    tables = {"customer": lambda: table(spark, sf_dir, "customer"), "supplier": lambda: table(spark, sf_dir, "supplier")}
    exports = [{"name": f"{k:02d}_{o}", "params": f"-export {o} -csv {o}_{k}.csv", "where": f"{o[0]}_nationkey = {k}",
                "columns": [f"{o[0]}_{'cust' if o == 'customer' else 'supp'}key", f"{o[0]}_name"], "active": 0 if k == 3 else 1}
               for k in range(10) for o in tables]
    spark.createDataFrame([(json.dumps({"exports": exports}),)], "value string").write.text(f"{path}/config")
    configs = read_job_configs(spark, f"{path}/config", multiline=False)
    run_exports(spark, configs, lambda o: tables[o](), f"{path}/out", "2024-01-01 00:00:00", f"{path}/log", parallel=4, run_id="one")


@register("K3_concurrent_exports", """
WITH n AS (SELECT n_nationkey AS k FROM nation WHERE n_nationkey < 10),
c AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT lpad(CAST(k AS VARCHAR), 2, '0') || '_customer' AS job, CASE WHEN k = 3 THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
       CASE WHEN k <> 3 THEN coalesce(c.n, 0) END AS row_count FROM n LEFT JOIN c USING (k)
UNION ALL
SELECT lpad(CAST(k AS VARCHAR), 2, '0') || '_supplier', CASE WHEN k = 3 THEN 'SKIPPED' ELSE 'SUCCESS' END,
       CASE WHEN k <> 3 THEN coalesce(s.n, 0) END FROM n LEFT JOIN s USING (k)
""")
def q_concurrent_exports(spark, sf_dir):
    from shiftkit.plans.runlog import read_run_log
    path = landed(spark, sf_dir, "many_exports", lambda p: _write_many(spark, sf_dir, p))
    return read_run_log(spark, f"{path}/log").select("job", "status", "row_count")


# --- bridge tables with gaps -------------------------------------------------------------------
# lineitem as the bridge again, with every eleventh tag key null and every
# thirteenth dangling; a quarter of the tags is not in the target, owner names
# carry blanks there, every ninth owner has a second record of the same name,
# and owners 1 to 5 have no bridge row.

def gap_views(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    n = F.col("l_orderkey") + F.col("l_linenumber")
    bridge = t("lineitem").where("l_suppkey > 5").select(
        F.col("l_suppkey").alias("qms_unit__c"),
        F.when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("keyword__c"))
    owners = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name__v"))
    tags = t("part").select(F.col("p_partkey").alias("id"), F.concat(F.lit(" "), "p_name").alias("name__v"), F.col("p_type").alias("keyword_type__c"))
    t_owners = t("supplier").select((F.col("s_suppkey") + 1_000_000).alias("id"), F.col("s_name").alias("name__v"))
    t_owners = t_owners.unionByName(t("supplier").where("s_suppkey % 9 = 0").select(
        (F.col("s_suppkey") + 2_000_000).alias("id"), F.col("s_name").alias("name__v")))
    t_tags = (t("part").groupBy(F.col("p_name").alias("name__v"), F.col("p_type").alias("keyword_type__c"))
              .agg((F.min("p_partkey") + 1_000_000).alias("id")).where("id % 4 <> 0").select("id", "name__v", "keyword_type__c"))
    return bridge, owners, tags, t_owners, t_tags


GAPS_SQL = """
WITH b AS (
  SELECT l_suppkey AS o, CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN NULL
                              WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN -l_partkey ELSE l_partkey END AS t FROM lineitem WHERE l_suppkey > 5),
bp AS (SELECT s_name AS owner, ' ' || p_name AS tag, p_type AS kind FROM b LEFT JOIN part ON t = p_partkey LEFT JOIN supplier ON o = s_suppkey),
tow AS (SELECT s_suppkey + 1000000 AS id, s_name FROM supplier UNION ALL SELECT s_suppkey + 2000000, s_name FROM supplier WHERE s_suppkey % 9 = 0),
tt AS (SELECT min(p_partkey) + 1000000 AS id, p_name, p_type FROM part GROUP BY ALL HAVING (min(p_partkey) + 1000000) % 4 <> 0),
j AS (
  SELECT tow.id AS owner_id, bp.owner, trim(bp.tag) || '_' || trim(bp.kind) AS helper, tt.id AS tag_id
  FROM tow LEFT JOIN bp ON tow.s_name = bp.owner LEFT JOIN tt ON trim(bp.tag) = tt.p_name AND trim(bp.kind) = tt.p_type)
"""


@register("J2_gaps", GAPS_SQL + """
SELECT owner AS "qms_unit__c__name__v", tag AS "keyword__c__name__v", kind AS keyword_type__c FROM bp
""")
def q_denormalize_gaps(spark, sf_dir):
    """Bridge rows with null and dangling keys stay, without names."""
    from shiftkit.plans.bridge import bridge_denormalize
    return flat_names(bridge_denormalize(*gap_views(spark, sf_dir)[:3]))


@register("J4_gaps", GAPS_SQL + """
SELECT owner_id AS qms_unit__c, owner AS "ignore__qms_unit__c__name__v", helper AS "ignore__keyword_helper", tag_id AS keyword__c
FROM j WHERE tag_id IS NOT NULL
""")
def q_rekey_gaps(spark, sf_dir):
    """Rows whose tag the target lacks are dropped, an owner name that two records have gives both."""
    from shiftkit.plans.bridge import bridge_denormalize, bridge_rekey
    bridge, owners, tags, t_owners, t_tags = gap_views(spark, sf_dir)
    return flat_names(bridge_rekey(bridge_denormalize(bridge, owners, tags), t_owners, t_tags))


@register("A6_gaps", GAPS_SQL + "SELECT count(tag_id) AS matched, count(*) AS total FROM j")
def q_coverage_gaps(spark, sf_dir):
    """A6 with owners that no bridge row names and rows that find no tag."""
    from shiftkit.plans.bridge import bridge_denormalize, rekey_coverage
    bridge, owners, tags, t_owners, t_tags = gap_views(spark, sf_dir)
    return rekey_coverage(bridge_denormalize(bridge, owners, tags), t_owners, t_tags)


@register("P9_drop_null_key", GAPS_SQL + "SELECT o AS qms_unit__c, t AS keyword__c FROM b WHERE t IS NOT NULL")
def q_drop_null_key(spark, sf_dir):
    from shiftkit.operators.project import drop_null_key
    return drop_null_key(gap_views(spark, sf_dir)[0], "keyword__c")


# --- listings, wide columns, fallbacks, reports ---------------------------------------------------

def _write_segments(spark, sf_dir, path):
    """customer as one CSV folder a segment, then once more as a newer snapshot of the last segment."""
    from shiftkit.operators.sinks import write_csv
    c = table(spark, sf_dir, "customer")
    for (s,) in c.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect():    # five segments
        write_csv(c.where(F.col("c_mktsegment") == s), f"{path}/snap shots/{s} [x]")


@register("S5_list_tree", """
SELECT DISTINCT c_mktsegment || ' [x]' AS relative_path, true AS has_bytes FROM customer
""")
def q_list_tree(spark, sf_dir):
    """The listing of a written tree: its folders, blanks and brackets as they are."""
    from shiftkit.functions.params import relative_dir
    from shiftkit.sources.listing import list_tree
    path = landed(spark, sf_dir, "segments", lambda p: _write_segments(spark, sf_dir, p))
    files = list_tree(spark, f"{path}/snap shots", "*.csv")
    return files.groupBy(relative_dir("path", f"{path}/snap shots").alias("relative_path")).agg((F.sum("length") > 0).alias("has_bytes"))


@register("S6_latest_of_tree", "SELECT max(c_mktsegment) || ' [x]' AS relative_path FROM customer")
def q_latest_of_tree(spark, sf_dir):
    """The newest file: of the snapshot written last."""
    from shiftkit.functions.params import relative_dir
    from shiftkit.sources.files import latest_file
    from shiftkit.sources.listing import list_tree
    path = landed(spark, sf_dir, "segments", lambda p: _write_segments(spark, sf_dir, p))
    latest = latest_file(list_tree(spark, f"{path}/snap shots", "*.csv"), name_like="part-%")
    return latest.select(relative_dir("path", f"{path}/snap shots").alias("relative_path"))


def _inventory_sql() -> str:
    from shiftkit.registry import INVENTORY_SQL
    return INVENTORY_SQL


@register("K5_wide_heads", _inventory_sql() + """
SELECT object_type, file_intent, l[1] AS "HEAD1", l[2] AS "HEAD2", l[3] AS "HEAD3", l[12] AS "HEAD12"
FROM (SELECT *, CASE WHEN headers = '' THEN [] ELSE string_split(headers, '|') END AS l FROM inv)
""")
def q_wide_heads(spark, sf_dir):
    """Twelve head columns, whatever the longest list; four of them are compared."""
    from shiftkit.operators.aggregate import headers_by_type_intent, wide_heads
    from shiftkit.registry import inventory_long
    wide = wide_heads(headers_by_type_intent(inventory_long(spark, sf_dir)), width=12)
    return wide.select("object_type", "file_intent", "HEAD1", "HEAD2", "HEAD3", "HEAD12")


@register("F17_loader_file", """
SELECT p_partkey AS job_id,
       coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE 'in/' || p_size END, ''), CASE WHEN p_size % 3 = 0 THEN p_brand END,
                nullif(CASE WHEN p_size % 5 = 0 THEN p_type ELSE '' END, ''), p_name) AS loader_file FROM part
""")
def q_loader_file(spark, sf_dir):
    """The first of four names that is neither null nor empty."""
    from shiftkit.functions.params import first_non_blank
    size = F.col("p_size")
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("job_id"), F.when(size % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("in/"), size)).alias("import_path"),
        F.when(size % 3 == 0, F.col("p_brand")).alias("file"), F.when(size % 5 == 0, F.col("p_type")).otherwise(F.lit("")).alias("import_file"),
        F.col("p_name").alias("name"))
    return p.select("job_id", first_non_blank("import_path", "file", "import_file", "name").alias("loader_file"))


def _lists_sql() -> str:
    from shiftkit.registry import OUTCOME_SQL, _reconcile_select
    return OUTCOME_SQL + _reconcile_select("f.fstem = j.stem") + """,
r AS (SELECT run, status, file_name, row_number() OVER (PARTITION BY run, status ORDER BY file_name) AS k FROM st WHERE status <> 'SKIPPED' AND file_name IS NOT NULL),
l AS (SELECT run, string_agg(CASE WHEN status = 'SUCCESS' THEN file_name END, ',' ORDER BY file_name) AS good,
             string_agg(CASE WHEN status = 'FAILED' THEN file_name END, ',' ORDER BY file_name) AS bad FROM r WHERE k <= 20 GROUP BY run)
SELECT s.run, CAST(count_if(status = 'SUCCESS') AS BIGINT) AS successful, CAST(count_if(status = 'FAILED') AS BIGINT) AS failed,
       CAST(count_if(status = 'SKIPPED') AS BIGINT) AS skipped, coalesce(any_value(good), '') AS good, coalesce(any_value(bad), '') AS bad
FROM st s LEFT JOIN l ON s.run = l.run GROUP BY s.run
"""


@register("A5_outcome_lists", _lists_sql())
def q_outcome_lists(spark, sf_dir):
    """The run summary with the first twenty good and failed files of each run (a report's limit; the counts are whole)."""
    from shiftkit.operators.aggregate import outcome_counts
    from shiftkit.plans.runs import reconcile_imports
    from shiftkit.registry import load_jobs, outcome_listing
    st = reconcile_imports(load_jobs(spark, sf_dir), outcome_listing(spark, sf_dir), exact=True, keep=["run"])
    c = outcome_counts(st, by=["run"], most_items=20)
    return c.select("run", "successful", "failed", "skipped", F.array_join("successful_items", ",").alias("good"),
                    F.array_join("failed_items", ",").alias("bad"))


def _reasons_sql() -> str:
    from shiftkit.registry import JOB_OUTPUT_SQL, TEST_BANNER
    return JOB_OUTPUT_SQL + f"""
SELECT event_id, concat_ws(' / ',
  CASE WHEN extra <> '' THEN CASE WHEN starts_with(out, '{TEST_BANNER}') THEN 'Additional output: ' ELSE 'Unexpected output: ' END || extra END,
  CASE WHEN extra <> '' OR return_code <> 0 THEN coalesce(nullif(stderr, ''), 'Unknown error') END) AS reasons
FROM y
"""


@register("F15_failure_reasons", _reasons_sql())
def q_failure_reasons(spark, sf_dir):
    """All reasons that a failed import is logged with."""
    from shiftkit.functions.outcomes import import_failure_reasons
    from shiftkit.registry import TEST_BANNER, job_outputs
    return job_outputs(spark, sf_dir).select("event_id", F.array_join(
        import_failure_reasons("return_code", "stdout", "stderr", TEST_BANNER), " / ").alias("reasons"))


# --- the sync report: where additions stand, and its totals ------------------------------------

def _walk_sql() -> str:
    from shiftkit.registry import WALK_SQL
    return WALK_SQL + """,
tr AS (
  SELECT s.loader_config, s.row_id, s.attr, row_number() OVER (PARTITION BY s.loader_config, s.row_id ORDER BY s.o) - 1 AS i
  FROM seen s LEFT JOIN ra ON ra.row_id = s.row_id AND ra.attr = s.attr WHERE ra.attr IS NULL),
w AS (SELECT max(n_headers) AS width FROM rows_),
k AS (SELECT t.loader_config, t.row_id, count(*) - 1 AS opens, any_value(r.n_headers) AS n FROM tr t JOIN rows_ r USING (row_id) GROUP BY ALL),
o AS (SELECT *, coalesce(sum(opens) OVER (PARTITION BY loader_config ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM k),
mv AS (SELECT loader_config, min(row_id) AS moved FROM o, w WHERE n = width AND opened = 0 GROUP BY 1)
"""


@register("K5_additions_layout", _walk_sql() + """
SELECT loader_config, row_id, CAST(width + opened + CASE WHEN row_id >= moved THEN 1 ELSE 0 END + i AS BIGINT) AS head, attr
FROM tr JOIN o USING (loader_config, row_id) LEFT JOIN mv USING (loader_config), w
""")
def q_additions_layout(spark, sf_dir):
    """The head column of every attribute that the walk adds to a row."""
    from shiftkit.plans.sync import additions_layout, attribute_sync
    from shiftkit.registry import inventory_rows, sync_exports
    rows = inventory_rows(spark, sf_dir)
    return additions_layout(rows, attribute_sync(rows, sync_exports(spark, sf_dir))["sync"], span=20)


@register("A8_sync_totals", _walk_sql() + """,
tc AS (SELECT i.loader_config, sum(n_exports) AS n FROM intro i JOIN nexp USING (loader_config, key) GROUP BY 1),
ta AS (SELECT loader_config, count(*) AS n FROM tr GROUP BY 1), tm AS (SELECT loader_config, count(*) AS n FROM m GROUP BY 1)
SELECT loader_config, (SELECT count(*) FROM rk) AS n_rows, (SELECT count(*) FROM rk) - coalesce(tm.n, 0) AS unmatched,
       CAST(coalesce(tc.n, 0) AS BIGINT) AS added_to_config, coalesce(ta.n, 0) AS added_to_rows
FROM (SELECT DISTINCT loader_config FROM exports) c LEFT JOIN tm USING (loader_config) LEFT JOIN tc USING (loader_config) LEFT JOIN ta USING (loader_config)
""")
def q_sync_totals(spark, sf_dir):
    from shiftkit.plans.sync import attribute_sync, sync_totals
    from shiftkit.registry import inventory_rows, sync_exports
    rows, exports = inventory_rows(spark, sf_dir), sync_exports(spark, sf_dir)
    return sync_totals(rows, exports, attribute_sync(rows, exports)["sync"])


# --- catalogues as the reports write them -----------------------------------------------------------
# One configuration a brand with an import for each of its parts; active,
# status, business type and file path are missing here and there.

def _write_brand_configs(spark, sf_dir, path):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    key = F.col("p_partkey").cast("string")
    item = F.struct(
        F.concat(F.lit("imp_"), key).alias("name"),
        F.when(size % 7 == 0, F.lit("-upsert")).otherwise(F.concat(F.lit("-update item__c -csv imp_"), key, F.lit(".csv -idParam id"))).alias("params"),
        F.when(size % 3 == 0, 0).when(size % 3 == 1, 1).alias("active"), F.when(size % 2 == 0, F.col("p_type")).alias("status"),
        F.when(size % 5 != 0, F.col("p_name")).alias("business_object_type"), F.when(size % 2 == 1, F.concat(F.lit("in/"), key)).alias("file_path"))
    configs = p.groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("i")))), lambda x: x["i"]).alias("imports"))
    configs.select(F.to_json(F.struct(F.struct(F.concat(F.lit("/data/"), "p_brand").alias("import_path")).alias("import_settings"),
                                      "imports")).alias("value")).write.text(path)


def brand_imports(spark, sf_dir):
    from shiftkit.sources.config import config_imports, read_job_configs
    path = landed(spark, sf_dir, "brand_configs", lambda p: _write_brand_configs(spark, sf_dir, p))
    return config_imports(read_job_configs(spark, path, multiline=False))


BRANDS_SQL = """
WITH i AS (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS nr, 'imp_' || p_partkey AS name,
         CASE p_size % 3 WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE '' END AS act, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS st FROM part)
"""


@register("C2_import_report", BRANDS_SQL + """
SELECT act AS active, name, st AS status, CASE WHEN p_size % 2 = 1 THEN 'in/' || p_partkey ELSE '' END AS file_path FROM i
""")
def q_import_report(spark, sf_dir):
    from shiftkit.plans.catalog import import_report
    return import_report(brand_imports(spark, sf_dir)).drop("loader_config", "import_pos")


@register("C3_load_order_report", BRANDS_SQL + """
SELECT nr AS "LoadOrderNr", CASE WHEN p_size % 7 = 0 THEN '' ELSE name || '.csv' END AS "LoaderFileName",
       CASE WHEN p_size % 7 = 0 THEN '' ELSE 'item__c' END AS "ObjectType", CASE WHEN p_size % 5 <> 0 THEN p_name ELSE '' END AS "Business ObjectType",
       '' AS "ReferencedObject(s)", act AS "Load is Active", st AS "FunctionStatus", '/data/' || p_brand AS "BaseImportPath"
FROM i
""")
def q_load_order_report(spark, sf_dir):
    from shiftkit.plans.catalog import load_order_report
    return load_order_report(brand_imports(spark, sf_dir)).drop("LoaderConfig").withColumn("LoadOrderNr", F.col("LoadOrderNr").cast("long"))

"""The operators of the survey, run on the given test tables.

Each entry maps an operator ID to ``(spark, sf_dir) -> DataFrame`` and, where
SQL can express it, to an equivalent DuckDB query over the same tables.  The
TPC-H-style tables are read as object exports: ``lineitem`` is a bridge
between ``part`` (tags with a name and type) and ``supplier`` (owners),
``customer`` an organisation table typed by ``nation``, ``orders`` an object
to export, ``events`` the rows of a failure file, and so on.  Every query
reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftkit.functions.names import flat_names

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return wrap


_TABLES: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a DataFrame; the handle (plan and schema, no data) is
    reused per session, so its parquet schema is read once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    mine = _TABLES.setdefault(spark, {})
    if path not in mine:
        mine[path] = spark.read.parquet(path)
    return mine[path]


# --- object views of the test tables ------------------------------------------

def bridge_views(spark: SparkSession, sf_dir: str):
    """lineitem as the owner/tag bridge, supplier as owners, part as tags."""
    bridge = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("qms_unit__c"), F.col("l_partkey").alias("keyword__c"))
    owners = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name__v"))
    tags = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name__v"),
        F.col("p_type").alias("keyword_type__c"))
    return bridge, owners, tags


# Target instance: same business objects under other ids.  Owners keep their
# names; tags exist once per business key (name, type), as in an instance
# where that key is unique.
TARGET_ID_SHIFT = 1_000_000


def target_views(spark: SparkSession, sf_dir: str):
    owners = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + TARGET_ID_SHIFT).alias("id"), F.col("s_name").alias("name__v"))
    tags = (table(spark, sf_dir, "part")
            .groupBy(F.col("p_name").alias("name__v"), F.col("p_type").alias("keyword_type__c"))
            .agg((F.min("p_partkey") + TARGET_ID_SHIFT).alias("id"))
            .select("id", "name__v", "keyword_type__c"))
    return owners, tags


@register("J2_bridge_denormalize", """
SELECT s.s_name AS "qms_unit__c__name__v", p.p_name AS "keyword__c__name__v",
       p.p_type AS keyword_type__c
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def q_bridge_denormalize(spark, sf_dir):
    from shiftkit.plans.bridge import bridge_denormalize
    return flat_names(bridge_denormalize(*bridge_views(spark, sf_dir)))


REKEY_SQL = """
WITH bp AS (
  SELECT s.s_name AS owner_name, p.p_name AS tag_name, p.p_type AS tag_type
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
t_owner AS (SELECT s_suppkey + 1000000 AS id, s_name AS name FROM supplier),
t_tag AS (SELECT min(p_partkey) + 1000000 AS id, p_name AS name, p_type AS kind
          FROM part GROUP BY p_name, p_type),
j AS (
  SELECT o.id AS owner_id, bp.owner_name, trim(bp.tag_name) || '_' || trim(bp.tag_type) AS helper,
         trim(bp.tag_name) AS tn, trim(bp.tag_type) AS tt
  FROM t_owner o LEFT JOIN bp ON o.name = bp.owner_name),
r AS (
  SELECT j.owner_id, j.owner_name, j.helper, t.id AS tag_id
  FROM j LEFT JOIN t_tag t ON j.tn = trim(t.name) AND j.tt = trim(t.kind))
"""


@register("J4_bridge_rekey", REKEY_SQL + """
SELECT owner_id AS qms_unit__c, owner_name AS "ignore__qms_unit__c__name__v",
       helper AS "ignore__keyword_helper", tag_id AS keyword__c
FROM r WHERE tag_id IS NOT NULL
""")
def q_bridge_rekey(spark, sf_dir):
    from shiftkit.plans.bridge import bridge_denormalize, bridge_rekey
    blueprint = bridge_denormalize(*bridge_views(spark, sf_dir))
    owners, tags = target_views(spark, sf_dir)
    return flat_names(bridge_rekey(blueprint, owners, tags))


@register("A6_match_coverage", REKEY_SQL + """
SELECT count(tag_id) AS matched, count(*) AS total FROM r
""")
def q_match_coverage(spark, sf_dir):
    from shiftkit.plans.bridge import bridge_denormalize, rekey_coverage
    blueprint = bridge_denormalize(*bridge_views(spark, sf_dir))
    owners, tags = target_views(spark, sf_dir)
    return rekey_coverage(blueprint, owners, tags)


# --- landed files ---------------------------------------------------------------
# Sources and sinks are checked on files Spark writes from the tables into a
# fresh folder under the session's checkpoint root, then reads back.

_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    from shiftkit.session import checkpoint_root, shared_dir
    key = (checkpoint_root(spark), sf_dir, name)
    if key not in _LANDED:
        path = shared_dir(spark, name)
        write(path)
        _LANDED[key] = path
    return _LANDED[key]


def _csv_writer(df: DataFrame, path: str, single_file: bool = False) -> None:
    from shiftkit.operators.sinks import write_csv
    write_csv(df, path, single_file=single_file)


# --- P: projections and filters -------------------------------------------------

@register("P4_export_snapshot", """
SELECT o_orderkey AS "ignore__o_orderkey", o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 100000
""")
def q_export_snapshot(spark, sf_dir):
    from shiftkit.plans.runs import export_view
    return flat_names(export_view(
        table(spark, sf_dir, "orders"),
        where="o_orderstatus = 'O' AND o_totalprice >= 100000",
        columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
        ignore_columns=["o_orderkey", "not_a_column"]))


@register("P2_where_filter", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE contains(c_name, '#00000') AND c_acctbal >= 0 AND c_mktsegment IS NOT NULL
""")
def q_where_filter(spark, sf_dir):
    from shiftkit.operators.project import project_columns, where_filter
    df = where_filter(table(spark, sf_dir, "customer"),
                      "contains(c_name, '#00000') AND c_acctbal >= 0 AND c_mktsegment IS NOT NULL")
    return project_columns(df, ["c_custkey", "c_name", "c_mktsegment"])


@register("A1_row_count", """
SELECT 'open_orders' AS export_name, count(*) AS row_count
FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 100000
""")
def q_row_count(spark, sf_dir):
    from shiftkit.plans.runs import export_view
    df = export_view(table(spark, sf_dir, "orders"),
                     where="o_orderstatus = 'O' AND o_totalprice >= 100000",
                     columns=["o_orderkey", "o_totalprice"], ignore_columns=["o_orderkey"])
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("open_orders").alias("export_name"), "row_count")


@register("P3_relation_path", """
SELECT o.o_orderkey, c.c_name AS "customer__r__c_name", n.n_name AS "customer__r__nation__r__n_name"
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_relation_path(spark, sf_dir):
    from shiftkit.operators.joins import relation_path
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    x = relation_path(o, "o_custkey", table(spark, sf_dir, "customer"), "c_custkey",
                      ["c_name", "c_nationkey"], relation="customer__r")
    x = relation_path(x, "customer__r.c_nationkey", table(spark, sf_dir, "nation"), "n_nationkey",
                      ["n_name"], relation="customer__r.nation__r")
    return flat_names(x.select("o_orderkey", "`customer__r.c_name`", "`customer__r.nation__r.n_name`"))


# --- change sets ------------------------------------------------------------------

def org_views(spark, sf_dir):
    orgs = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name__v"),
        F.col("c_mktsegment").alias("state__v"), F.col("c_nationkey").alias("object_type__v"),
        "c_acctbal")
    types = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"),
                                                  F.col("n_name").alias("name__v"))
    return orgs, types


# The archive request: own values for the rename prefix and the new
# state (the name token and type pick customers of one nation).
ARCHIVE = dict(name_token="Customer#", type_value="NATION_3", name_prefix="RETIRED_",
               new_state="retired_state__c")

ARCHIVE_SQL = """
SELECT c.c_custkey AS id, c.c_name AS "ignore__current_name",
       'RETIRED_' || c.c_name AS name__v, c.c_mktsegment AS "ignore__current_state__v",
       'retired_state__c' AS state__v, c.c_acctbal
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE lower(c.c_name) LIKE '%customer#%' AND n.n_name = 'NATION_3'
"""


@register("J6_change_set_derive", f"""
SELECT id, "ignore__current_name", name__v, "ignore__current_state__v", state__v
FROM ({ARCHIVE_SQL}) a
""")
def q_change_set_derive(spark, sf_dir):
    from shiftkit.plans.changes import derive_archive_set
    orgs, types = org_views(spark, sf_dir)
    return flat_names(derive_archive_set(orgs, types, **ARCHIVE))


def change_rows(spark, sf_dir):
    """Updates (the archive set), repeated ids (negative balance twice), creates (suppliers)."""
    from shiftkit.plans.changes import derive_archive_set
    orgs, types = org_views(spark, sf_dir)
    arch = derive_archive_set(orgs.drop("c_acctbal"), types, **ARCHIVE)
    neg = orgs.where("c_acctbal < 0").select("id")
    dup = arch.join(neg, "id", "left_semi")
    new = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 10_000_000).alias("id"),
        F.lit(None).cast("string").alias("ignore.current_name"), F.col("s_name").alias("name__v"),
        F.lit(None).cast("string").alias("ignore.current_state__v"),
        F.lit("active_state__c").alias("state__v"))
    return arch.unionByName(dup).unionByName(new)


CHANGES_SQL = f"""
WITH arch AS ({ARCHIVE_SQL}),
ch AS (
  SELECT id, name__v, state__v FROM arch
  UNION ALL SELECT id, name__v, state__v FROM arch WHERE c_acctbal < 0
  UNION ALL SELECT s_suppkey + 10000000, s_name, 'active_state__c' FROM supplier),
cnt AS (SELECT id, count(*) AS n FROM ch GROUP BY id),
t AS (SELECT c_custkey AS id, c_name AS name__v, c_mktsegment AS state__v FROM customer)
"""


@register("K2_apply_upsert", CHANGES_SQL + """,
ok AS (SELECT ch.* FROM ch JOIN cnt USING (id) WHERE cnt.n = 1)
SELECT coalesce(t.id, ok.id) AS id, coalesce(ok.name__v, t.name__v) AS name__v,
       coalesce(ok.state__v, t.state__v) AS state__v
FROM t FULL OUTER JOIN ok ON t.id = ok.id
""")
def q_apply_upsert(spark, sf_dir):
    from shiftkit.plans.changes import apply_change_set
    orgs, _ = org_views(spark, sf_dir)
    t = orgs.select("id", "name__v", "state__v")
    return apply_change_set(t, change_rows(spark, sf_dir), "upsert")


@register("K2_change_results", CHANGES_SQL + """,
r AS (
  SELECT CASE WHEN cnt.n > 1 THEN 'duplicate id in change set'
              WHEN t.id IS NULL THEN 'record not found' END AS errors
  FROM ch JOIN cnt USING (id) LEFT JOIN (SELECT DISTINCT id FROM t) t ON ch.id = t.id)
SELECT CASE WHEN errors IS NULL THEN 'update' END AS action,
       CASE WHEN errors IS NULL THEN 'success' ELSE 'failure' END AS status,
       errors, count(*) AS n
FROM r GROUP BY ALL
""")
def q_change_results(spark, sf_dir):
    from shiftkit.plans.changes import change_results
    orgs, _ = org_views(spark, sf_dir)
    t = orgs.select("id", "name__v", "state__v")
    res = change_results(t, change_rows(spark, sf_dir), "update")
    return res.groupBy("action", "status", "errors").agg(F.count(F.lit(1)).alias("n"))


# --- failure analysis ----------------------------------------------------------------

def failure_rows(spark, sf_dir) -> DataFrame:
    """events as the rows of a failure file, with an ``errors`` text per row."""
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit("  Row [user = "), F.col("user_id").cast("string"), F.lit("]   "),
                    F.col("event_type"), F.lit(" failed on ["),
                    F.lpad(F.col("event_id").cast("string"), 15, "0"),
                    F.lit("] with props "), F.col("props"), F.lit(" ["), F.col("event_type"),
                    F.lit("]\t"))
    return e.select("event_id", F.when(F.col("event_type") == "view", F.lit("")).otherwise(text)
                    .alias("errors"))


FAILURE_SQL = """
WITH f AS (
  SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE
    '  Row [user = ' || CAST(user_id AS VARCHAR) || ']   ' || event_type || ' failed on [' ||
    lpad(CAST(event_id AS VARCHAR), 15, '0') || '] with props ' || props || ' [' || event_type ||
    ']' || chr(9) END AS errors
  FROM events),
m AS (
  SELECT event_id, trim(regexp_replace(regexp_replace(regexp_replace(errors,
      '\\[\\s*([^\\]=]*)=[^\\]]*\\]', '[\\1=***]', 'g'),
      '\\[\\s*[A-Za-z0-9]{15}\\s*\\]', '[***]', 'g'), '\\s+', ' ', 'g')) AS error
  FROM f)
"""


@register("F8_mask_bracketed", FAILURE_SQL + "SELECT event_id, error FROM m")
def q_mask_bracketed(spark, sf_dir):
    from shiftkit.functions.text import normalize_error
    return failure_rows(spark, sf_dir).select(
        "event_id", normalize_error("errors").alias("error"))


@register("A2_error_type_counts", FAILURE_SQL + """
SELECT error, count(*) AS n FROM m WHERE error <> '' GROUP BY error
""")
def q_error_type_counts(spark, sf_dir):
    from shiftkit.plans.failures import error_type_counts
    return error_type_counts(failure_rows(spark, sf_dir))


@register("T1_most_common", FAILURE_SQL + """
SELECT error, count(*) AS n FROM m WHERE error <> '' GROUP BY error ORDER BY n DESC, error
""")
def q_most_common(spark, sf_dir):
    from shiftkit.plans.failures import error_type_counts, most_common
    return most_common(error_type_counts(failure_rows(spark, sf_dir)))


@register("A3_failure_totals", """
WITH f AS (
  SELECT 'lines_' || CAST(year(l_shipdate) AS VARCHAR) AS stem FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'orders_' || CAST(year(o_orderdate) AS VARCHAR) FROM orders WHERE o_orderstatus = 'P'),
i AS (SELECT 'lines_' || CAST(year(l_shipdate) AS VARCHAR) AS stem FROM lineitem),
fc AS (SELECT stem, count(*) AS rows_failed FROM f GROUP BY stem),
ic AS (SELECT stem, count(*) AS rows_to_import FROM i GROUP BY stem)
SELECT fc.stem, ic.rows_to_import, fc.rows_failed,
       CASE WHEN ic.stem IS NULL THEN 'missing_import' ELSE 'paired' END AS partner
FROM fc LEFT JOIN ic ON fc.stem = ic.stem
""")
def q_failure_totals(spark, sf_dir):
    from shiftkit.plans.failures import failure_totals
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    lines_stem = F.concat(F.lit("lines_"), F.year("l_shipdate").cast("string")).alias("stem")
    failures = (li.where("l_returnflag = 'R'").select(lines_stem)
                .unionByName(o.where("o_orderstatus = 'P'").select(
                    F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")).alias("stem"))))
    imports = li.select(lines_stem)
    return failure_totals(failures, imports)


# --- header inventory and attribute sync --------------------------------------------
# part as a CSV tree: p_brand is the folder, p_type the file (and object type),
# p_name a column header.  PROMO files carry a "Verketten" helper column (their
# groups are dropped) and every file an "ignore_" column (left out).

def mapping_rows(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("relative_path"), F.col("p_type").alias("filename"),
                    F.upper(F.regexp_replace("p_name", " ", "_")).alias("object_type"),
                    F.col("p_partkey").alias("ordinal"), "p_size")


@register("W1_keep_first", """
SELECT relative_path, filename, object_type FROM (
  SELECT p_brand AS relative_path, p_type AS filename,
         upper(replace(p_name, ' ', '_')) AS object_type,
         row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS rn
  FROM part) WHERE rn = 1
""")
def q_keep_first(spark, sf_dir):
    from shiftkit.plans.inventory import load_mapping
    return load_mapping(mapping_rows(spark, sf_dir), ordinal="ordinal")


@register("J5_multi_key_left", """
WITH m AS (
  SELECT relative_path, filename, object_type FROM (
    SELECT p_brand AS relative_path, p_type AS filename,
           upper(replace(p_name, ' ', '_')) AS object_type,
           row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS rn
    FROM part WHERE p_size > 40) WHERE rn = 1)
SELECT p.p_partkey AS file_id, p.p_brand AS relative_path, p.p_type AS filename, m.object_type
FROM part p LEFT JOIN m ON p.p_brand = m.relative_path AND p.p_type = m.filename
""")
def q_multi_key_left(spark, sf_dir):
    from shiftkit.plans.inventory import join_mapping, load_mapping
    mapping = load_mapping(mapping_rows(spark, sf_dir).where("p_size > 40").drop("p_size"),
                           ordinal="ordinal")
    files = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("file_id"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit("\t")).alias("relative_path"),
        F.col("p_type").alias("filename"))
    return join_mapping(files, mapping).select("file_id", "relative_path", "filename", "object_type")


def inventory_long(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    base = p.select(F.col("p_type").alias("object_type"), F.col("p_brand").alias("file_intent"),
                    F.col("p_name").alias("header"))
    ign = p.select("p_type", "p_brand", F.concat(F.lit("ignore_"), F.col("p_brand")))
    drop = p.where("p_type = 'PROMO'").select("p_type", "p_brand",
                                               F.concat(F.lit("Verketten "), F.col("p_brand")))
    return base.union(ign).union(drop)


INVENTORY_SQL = """
WITH long AS (
  SELECT p_type AS object_type, p_brand AS file_intent, p_name AS header FROM part
  UNION ALL SELECT p_type, p_brand, 'ignore_' || p_brand FROM part
  UNION ALL SELECT p_type, p_brand, 'Verketten ' || p_brand FROM part WHERE p_type = 'PROMO'),
g AS (SELECT object_type, file_intent, bool_or(contains(lower(header), 'verketten')) AS d
      FROM long GROUP BY ALL),
h AS (SELECT DISTINCT object_type, file_intent, header FROM long
      WHERE header <> '' AND NOT contains(lower(header), 'ignore.')
        AND NOT contains(lower(header), 'ignore_')),
inv AS (
  SELECT g.object_type, g.file_intent,
         coalesce(string_agg(h.header, '|' ORDER BY lower(h.header), h.header), '') AS headers,
         count(h.header) AS n_headers
  FROM g LEFT JOIN h USING (object_type, file_intent) WHERE NOT g.d
  GROUP BY g.object_type, g.file_intent),
rows_ AS (
  SELECT row_number() OVER (ORDER BY lower(object_type), object_type, lower(file_intent),
                                     file_intent) AS row_id, * FROM inv)
"""


@register("A4_headers_by_type_intent", INVENTORY_SQL + """
SELECT object_type, file_intent, headers, n_headers FROM inv
""")
def q_headers_by_type_intent(spark, sf_dir):
    from shiftkit.operators.aggregate import headers_by_type_intent
    inv = headers_by_type_intent(inventory_long(spark, sf_dir))
    return inv.select("object_type", "file_intent", F.array_join("headers", "|").alias("headers"),
                      F.size("headers").cast("long").alias("n_headers"))


@register("K5_wide_header_sink")
def q_wide_header_sink(spark, sf_dir):
    from shiftkit.operators.aggregate import headers_by_type_intent
    from shiftkit.plans.inventory import by_type_wide
    return by_type_wide(headers_by_type_intent(inventory_long(spark, sf_dir)))


def inventory_rows(spark, sf_dir):
    from shiftkit.operators.aggregate import headers_by_type_intent
    from shiftkit.operators.order import ci_sort_keys, global_row_number
    inv = headers_by_type_intent(inventory_long(spark, sf_dir))
    return global_row_number(inv, ci_sort_keys(["object_type", "file_intent"])) \
        .withColumnRenamed("headers", "attrs")


# Exports of two configurations, derived from part: one per (configuration, type,
# size), so many exports share a key, with the names of a third of its parts
# as columns (some padded, plus a blank and a column no file has).  STANDARD
# exports of every fifth size name another object in their parameters, so they
# are reached by two keys, which then share them.  SMALL is in no
# configuration, LARGE only in one.
EXPORT_POS = "p_size * 100 + ascii(substr(p_type, 2, 1))"


def sync_exports(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("p_type <> 'SMALL' AND NOT (p_type = 'LARGE' AND p_size % 2 = 1)")
    low = F.lower("p_type")
    named = F.when(F.col("p_partkey") % 3 == 0, F.struct("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(
        F.lit("  "), "p_name", F.lit(" "))).otherwise(F.col("p_name")).alias("attr")))
    grouped = p.groupBy("p_type", "p_size").agg(F.array_sort(F.collect_list(named)).alias("names"))
    return grouped.select(
        F.concat(F.lit("cfg_"), (F.col("p_size") % 2).cast("string")).alias("loader_config"),
        F.expr(EXPORT_POS).cast("int").alias("export_pos"), F.concat(low, F.lit("_"), F.col("p_size").cast("string")).alias("name"),
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("business_object_type"),
        F.concat(F.lit("-export "), F.when((F.col("p_type") == "STANDARD") & (F.col("p_size") % 5 == 0), F.lit("Medium")).otherwise(low),
                 F.lit(" -csv x.csv")).alias("params"),
        F.concat(F.col("names.attr"), F.array(F.lit(" "), F.concat(F.lit("extra "), (F.col("p_size") % 7).cast("string")))).alias("columns"))


SYNC_SQL = INVENTORY_SQL + f""",
src AS (
  SELECT 'cfg_' || (p_size % 2) AS loader_config, {EXPORT_POS} AS export_pos, * FROM part
  WHERE p_type <> 'SMALL' AND NOT (p_type = 'LARGE' AND p_size % 2 = 1)),
exports AS (
  SELECT DISTINCT loader_config, export_pos, lower(p_type) || '_' || p_size AS name,
    CASE WHEN p_size % 3 <> 0 THEN '  ' || p_type || ' ' END AS bot,
    CASE WHEN p_type = 'STANDARD' AND p_size % 5 = 0 THEN 'Medium' ELSE lower(p_type) END AS object FROM src),
idx AS (
  SELECT DISTINCT loader_config, export_pos, key FROM (
    SELECT loader_config, export_pos, regexp_replace(lower(trim(bot)), '_+', '_', 'g') AS key FROM exports WHERE bot IS NOT NULL
    UNION ALL SELECT loader_config, export_pos, regexp_replace(lower(object), '_+', '_', 'g') FROM exports)),
nexp AS (SELECT loader_config, key, count(*) AS n_exports FROM idx GROUP BY ALL),
rk AS (SELECT row_id, object_type, file_intent,
              regexp_replace(lower(trim(object_type)), '_+', '_', 'g') AS key, headers FROM rows_),
ra AS (
  SELECT row_id, key, attr, apos FROM (
    SELECT row_id, key, unnest(string_split(headers, '|')) AS attr,
           generate_subscripts(string_split(headers, '|'), 1) AS apos
    FROM rk WHERE headers <> '')),
cl AS (
  SELECT loader_config, export_pos, p_name AS attr, row_number() OVER (PARTITION BY loader_config, export_pos ORDER BY p_partkey) AS cpos
  FROM src WHERE p_partkey % 3 = 0
  UNION ALL SELECT DISTINCT loader_config, export_pos, 'extra ' || (p_size % 7), 99000 FROM src),
j0 AS (
  SELECT loader_config, key, attr, min(export_pos * 100000 + cpos) AS o FROM idx JOIN cl USING (loader_config, export_pos)
  GROUP BY ALL)
"""

# The walk: a key's first row with an attribute that no export of the key has
# adds it to all of them, unless a key that shares an export with it did so in
# an earlier row (only the keys standard and medium share exports).
WALK_SQL = SYNC_SQL + """,
m AS (SELECT loader_config, row_id, object_type, file_intent, rk.key, n_exports FROM rk JOIN nexp USING (key)),
cand AS (
  SELECT n.loader_config, n.key, f.attr, f.row_id, f.apos
  FROM nexp n JOIN (SELECT key, attr, min(row_id) AS row_id, arg_min(apos, row_id) AS apos FROM ra GROUP BY key, attr) f USING (key)
  LEFT JOIN j0 ON j0.loader_config = n.loader_config AND j0.key = n.key AND j0.attr = f.attr WHERE j0.attr IS NULL),
shared AS (SELECT DISTINCT a.loader_config, a.key AS k1, b.key AS k2 FROM idx a JOIN idx b USING (loader_config, export_pos) WHERE a.key <> b.key),
intro AS (
  SELECT c.* FROM cand c LEFT JOIN (
    SELECT s.loader_config, s.k1 AS key, o.attr, min(o.row_id) AS other FROM shared s
    JOIN cand o ON o.loader_config = s.loader_config AND o.key = s.k2 GROUP BY ALL) x USING (loader_config, key, attr)
  WHERE x.other IS NULL OR x.other > c.row_id),
ent AS (
  SELECT loader_config, export_pos, attr, 0 AS phase, min(cpos) AS a, 0 AS b, -1 AS intro_row FROM cl GROUP BY ALL
  UNION ALL SELECT i.loader_config, idx.export_pos, i.attr, 1, i.row_id, i.apos, i.row_id FROM intro i JOIN idx USING (loader_config, key)),
seen AS (
  SELECT m.loader_config, m.row_id, e.attr, min(e.export_pos * 10000000000000 + e.phase * 1000000000000 + e.a * 100000 + e.b) AS o
  FROM m JOIN idx USING (loader_config, key) JOIN ent e USING (loader_config, export_pos) WHERE e.intro_row < m.row_id GROUP BY ALL)
"""


@register("J7_multi_key_index_join", SYNC_SQL + """
SELECT loader_config, rk.row_id, rk.object_type, rk.file_intent, e.name AS export_name
FROM rk JOIN idx USING (key) JOIN exports e USING (loader_config, export_pos)
""")
def q_multi_key_index_join(spark, sf_dir):
    from shiftkit.plans.sync import export_index
    from shiftkit.functions.text import normalize_object_type
    rows = inventory_rows(spark, sf_dir)
    ex = sync_exports(spark, sf_dir)
    rk = rows.select("row_id", "object_type", "file_intent",
                     normalize_object_type("object_type").alias("key"))
    return (rk.join(export_index(ex), "key")
            .join(ex.select("loader_config", "export_pos", F.col("name").alias("export_name")), ["loader_config", "export_pos"])
            .select("loader_config", "row_id", "object_type", "file_intent", "export_name"))


@register("J8_anti_unmatched", SYNC_SQL + """
SELECT row_id + 1 AS row_number, object_type, file_intent FROM rk
WHERE key NOT IN (SELECT key FROM idx)
""")
def q_anti_unmatched(spark, sf_dir):
    from shiftkit.plans.sync import unmatched_rows
    un = unmatched_rows(inventory_rows(spark, sf_dir), sync_exports(spark, sf_dir))
    return un.select((F.col("row_id") + 1).alias("row_number"), "object_type", "file_intent")


@register("A7_ordered_union_distinct", SYNC_SQL + """
SELECT loader_config, k.key, coalesce(string_agg(j0.attr, '|' ORDER BY j0.o), '') AS attrs
FROM nexp k LEFT JOIN j0 USING (loader_config, key) GROUP BY ALL
""")
def q_ordered_union_distinct(spark, sf_dir):
    from shiftkit.plans.sync import ordered_config_lists
    return ordered_config_lists(sync_exports(spark, sf_dir)).select(
        "loader_config", "key", F.array_join("attrs", "|").alias("attrs"))


@register("U2_attr_difference", SYNC_SQL + """,
m AS (SELECT loader_config, row_id, key FROM rk JOIN nexp USING (key)),
r AS (
  SELECT m.loader_config, m.row_id, string_agg(ra.attr, '|' ORDER BY ra.apos) AS only_in_row
  FROM m JOIN ra USING (row_id, key) LEFT JOIN j0 ON j0.loader_config = m.loader_config AND j0.key = m.key AND j0.attr = ra.attr
  WHERE j0.attr IS NULL GROUP BY ALL),
c AS (
  SELECT m.loader_config, m.row_id, string_agg(j0.attr, '|' ORDER BY j0.o) AS only_in_config
  FROM m JOIN j0 USING (loader_config, key) LEFT JOIN ra ON ra.row_id = m.row_id AND ra.attr = j0.attr
  WHERE ra.attr IS NULL GROUP BY ALL)
SELECT m.loader_config, m.row_id, coalesce(only_in_row, '') AS only_in_row, coalesce(only_in_config, '') AS only_in_config
FROM m LEFT JOIN r USING (loader_config, row_id) LEFT JOIN c USING (loader_config, row_id)
""")
def q_attr_difference(spark, sf_dir):
    from shiftkit.plans.sync import attr_difference
    d = attr_difference(inventory_rows(spark, sf_dir), sync_exports(spark, sf_dir))
    return d.select("loader_config", "row_id", F.array_join("only_in_row", "|").alias("only_in_row"),
                    F.array_join("only_in_config", "|").alias("only_in_config"))


@register("A8_attribute_sync", WALK_SQL + """,
tc AS (
  SELECT loader_config, row_id, string_agg(attr, '|' ORDER BY apos) AS added_to_config, count(*) AS n
  FROM intro GROUP BY ALL),
tr AS (
  SELECT s.loader_config, s.row_id, string_agg(s.attr, '|' ORDER BY s.o) AS added_to_row, count(*) AS n
  FROM seen s LEFT JOIN ra ON ra.row_id = s.row_id AND ra.attr = s.attr WHERE ra.attr IS NULL GROUP BY ALL)
SELECT m.loader_config, m.row_id, m.object_type, m.file_intent,
  coalesce(added_to_config, '') AS added_to_config, coalesce(added_to_row, '') AS added_to_row,
  coalesce(tc.n, 0) * m.n_exports AS n_added_to_config, coalesce(tr.n, 0) AS n_added_to_row
FROM m LEFT JOIN tc USING (loader_config, row_id) LEFT JOIN tr USING (loader_config, row_id)
""")
def q_attribute_sync(spark, sf_dir):
    from shiftkit.plans.sync import attribute_sync
    res = attribute_sync(inventory_rows(spark, sf_dir), sync_exports(spark, sf_dir))
    s = res["sync"]
    return s.select("loader_config", "row_id", "object_type", "file_intent",
                    F.array_join("added_to_config", "|").alias("added_to_config"),
                    F.array_join("added_to_row", "|").alias("added_to_row"),
                    "n_added_to_config", "n_added_to_row")


# --- outcomes of load jobs -----------------------------------------------------------
# orders as import jobs (loader file load_<orderkey>.csv, 5-LOW ones inactive);
# lineitem rows as the outcome files the loader left (R -> failure file).

def load_jobs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("load_"), F.col("o_orderkey").cast("string")).alias("job"),
                    F.concat(F.lit("-update order__c -csv load_"), F.col("o_orderkey").cast("string"),
                             F.lit(".csv -idParam id")).alias("params"),
                    F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias("active"),
                    F.col("o_orderpriority").alias("run"))


def outcome_listing(spark, sf_dir):
    """One outcome file per (order, failed?) pair: distinct on the small keys,
    then the path text."""
    li = table(spark, sf_dir, "lineitem")
    keys = li.select("l_orderkey", (F.col("l_returnflag") == "R").alias("failed")).distinct()
    name = F.concat(F.lit("/landing/load_"), F.col("l_orderkey").cast("string"),
                    F.when(F.col("failed"), F.lit("_FAILURE.csv")).otherwise(F.lit("_SUCCESS.csv")))
    return keys.select(name.alias("path"))


OUTCOME_SQL = """
WITH jobs AS (
  SELECT 'load_' || CAST(o_orderkey AS VARCHAR) AS job, 'load_' || CAST(o_orderkey AS VARCHAR) AS stem,
         CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS active, o_orderpriority AS run
  FROM orders),
files AS (
  SELECT DISTINCT 'load_' || CAST(l_orderkey AS VARCHAR) ||
         CASE WHEN l_returnflag = 'R' THEN '_FAILURE.csv' ELSE '_SUCCESS.csv' END AS file_name
  FROM lineitem),
f AS (SELECT file_name, CASE WHEN ends_with(file_name, '_FAILURE.csv') THEN 'failure' ELSE 'success' END
             AS outcome, regexp_replace(file_name, '_(FAILURE|SUCCESS)\\.csv$', '') AS fstem FROM files)
"""


def _reconcile_select(match: str) -> str:
    return f""",
m AS (SELECT j.job, j.stem, j.run, f.file_name, f.outcome FROM jobs j LEFT JOIN f ON {match}
      WHERE j.active <> 0),
per AS (
  SELECT job, stem, run, bool_or(outcome = 'failure') AS hf, bool_or(outcome = 'success') AS hs,
         min(CASE WHEN outcome = 'failure' THEN file_name END) AS ff,
         min(CASE WHEN outcome = 'success' THEN file_name END) AS sf
  FROM m GROUP BY job, stem, run),
st AS (
  SELECT job, stem, run, CASE WHEN coalesce(hf, false) THEN 'FAILED' WHEN coalesce(hs, false) THEN 'SUCCESS'
                         ELSE 'FAILED' END AS status, coalesce(ff, sf) AS file_name FROM per
  UNION ALL
  SELECT job, stem, run, 'SKIPPED', NULL FROM jobs WHERE active = 0)
"""


@register("J9_substring_match", OUTCOME_SQL + _reconcile_select("contains(f.file_name, j.stem)") + """
SELECT job, stem, status, file_name FROM st
""")
def q_substring_match(spark, sf_dir):
    from shiftkit.plans.runs import reconcile_imports
    return reconcile_imports(load_jobs(spark, sf_dir).drop("run"), outcome_listing(spark, sf_dir),
                             exact=False)


@register("F16_reconcile_outcome", OUTCOME_SQL + _reconcile_select("f.fstem = j.stem") + """
SELECT job, stem, status, file_name FROM st
""")
def q_reconcile_outcome(spark, sf_dir):
    from shiftkit.plans.runs import reconcile_imports
    return reconcile_imports(load_jobs(spark, sf_dir).drop("run"), outcome_listing(spark, sf_dir),
                             exact=True)


@register("A5_outcome_counts", OUTCOME_SQL + _reconcile_select("f.fstem = j.stem") + """
SELECT run, CAST(count_if(status = 'SUCCESS') AS BIGINT) AS successful,
       CAST(count_if(status = 'FAILED') AS BIGINT) AS failed,
       CAST(count_if(status = 'SKIPPED') AS BIGINT) AS skipped
FROM st GROUP BY run
""")
def q_outcome_counts(spark, sf_dir):
    from shiftkit.operators.aggregate import outcome_counts
    from shiftkit.plans.runs import reconcile_imports
    st = reconcile_imports(load_jobs(spark, sf_dir), outcome_listing(spark, sf_dir), exact=True,
                           keep=["run"])
    return outcome_counts(st, by=["run"], with_items=False)


# events as the console output of loader runs.
TEST_BANNER = "Loader 1.0. All rights reserved."


def job_outputs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    return e.select(
        "event_id",
        F.when(t == "error", 1).otherwise(0).alias("return_code"),
        F.when(t == "purchase", F.concat(F.lit(TEST_BANNER + "\n Exception: "), F.col("props")))
         .when(t == "click", F.lit(TEST_BANNER + " \n"))
         .when(t == "signup", F.concat(F.lit("Unknown relationship "), F.col("props")))
         .otherwise(F.lit("")).alias("stdout"),
        F.when(t == "error", F.concat(F.lit("Failure: "), F.col("props"))).otherwise(F.lit(""))
         .alias("stderr"))


JOB_OUTPUT_SQL = f"""
WITH o AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS return_code,
    CASE WHEN event_type = 'purchase' THEN '{TEST_BANNER}' || chr(10) || ' Exception: ' || props
         WHEN event_type = 'click' THEN '{TEST_BANNER} ' || chr(10)
         WHEN event_type = 'signup' THEN 'Unknown relationship ' || props ELSE '' END AS stdout,
    CASE WHEN event_type = 'error' THEN 'Failure: ' || props ELSE '' END AS stderr
  FROM events),
x AS (
  SELECT *, trim(stdout, ' ' || chr(9) || chr(10) || chr(13)) AS out FROM o),
y AS (
  SELECT *, CASE WHEN out = '' OR out = '{TEST_BANNER}' THEN ''
                 WHEN starts_with(out, '{TEST_BANNER}')
                   THEN trim(substr(out, {len(TEST_BANNER) + 1}), ' ' || chr(9) || chr(10) || chr(13))
                 ELSE out END AS extra FROM x)
"""


@register("F14_classify_export_output", JOB_OUTPUT_SQL + """
SELECT event_id, return_code <> 0 OR regexp_matches(lower(stdout || chr(10) || stderr),
       'failure:|error making request|exception|unknown relationship') AS failed FROM o
""")
def q_classify_export_output(spark, sf_dir):
    from shiftkit.functions.outcomes import export_failed
    o = job_outputs(spark, sf_dir)
    return o.select("event_id", export_failed("return_code", "stdout", "stderr").alias("failed"))


@register("F15_classify_import_output", JOB_OUTPUT_SQL + """
SELECT event_id, return_code <> 0 OR extra <> '' AS failed,
  CASE WHEN extra <> '' THEN
         CASE WHEN starts_with(out, '""" + TEST_BANNER + """') THEN 'Additional output: ' || extra
              ELSE 'Unexpected output: ' || extra END
       WHEN return_code <> 0 THEN coalesce(nullif(stderr, ''), 'Unknown error') END AS reason
FROM y
""")
def q_classify_import_output(spark, sf_dir):
    from shiftkit.functions.outcomes import import_failed, import_failure_reason
    o = job_outputs(spark, sf_dir)
    return o.select("event_id", import_failed("return_code", "stdout", TEST_BANNER).alias("failed"),
                    import_failure_reason("return_code", "stdout", "stderr", TEST_BANNER)
                    .alias("reason"))


# --- parameter strings, file names, URLs ----------------------------------------------

def job_params(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    marker = (F.when(F.col("p_name").startswith("new "), "add")
              .when(F.col("p_name").startswith("old "), "upd")
              .when(F.col("p_name").startswith("hot "), "update")
              .when(F.col("p_name").startswith("cold "), "UPS")
              .when(F.col("p_name").startswith("red "), "upsert")
              .otherwise("x"))
    fname = F.concat(F.lower("p_type"), F.lit("_"), marker, F.lit("_"), F.col("p_partkey").cast("string"),
                     F.lit(".csv"))
    flag = (F.when(F.col("p_size") < 10, "-export").when(F.col("p_size") < 20, "-create")
            .when(F.col("p_size") < 30, "-update").when(F.col("p_size") < 40, "-upsert")
            .otherwise("-recordmigrationmode"))
    params = F.concat(flag, F.lit(" "), F.lower("p_type"), F.lit("__c  -csv "), fname)
    return p.select(F.col("p_partkey").alias("job_id"), fname.alias("filename"), params.alias("params"))


@register("F3_params_tokens", """
WITH j AS (
  SELECT p_partkey AS job_id,
    lower(p_type) || '_' || CASE WHEN starts_with(p_name, 'new ') THEN 'add'
      WHEN starts_with(p_name, 'old ') THEN 'upd' WHEN starts_with(p_name, 'hot ') THEN 'update'
      WHEN starts_with(p_name, 'cold ') THEN 'UPS' WHEN starts_with(p_name, 'red ') THEN 'upsert'
      ELSE 'x' END || '_' || CAST(p_partkey AS VARCHAR) || '.csv' AS filename, p_size, p_type
  FROM part),
k AS (
  SELECT job_id, filename,
    CASE WHEN p_size < 10 THEN '-export' WHEN p_size < 20 THEN '-create' WHEN p_size < 30 THEN '-update'
         WHEN p_size < 40 THEN '-upsert' ELSE '-recordmigrationmode' END || ' ' || lower(p_type)
      || '__c  -csv ' || filename AS params
  FROM j),
t AS (
  SELECT job_id, filename, params,
    regexp_extract(params, '(?:^|\\s)-(?:export|create|update|upsert|import)\\s+(\\S+)', 1) AS o,
    regexp_extract(params, '(?:^|\\s)-csv\\s+(\\S+)', 1) AS f
  FROM k)
SELECT job_id,
  CASE WHEN o <> '' AND NOT starts_with(o, '-') THEN o ELSE '' END AS object,
  CASE WHEN f <> '' AND NOT starts_with(f, '-') THEN f ELSE '' END AS file,
  string_split_regex(trim(params), '\\s+')[2] AS second_token,
  CASE WHEN contains(lower(filename), '_upsert_') THEN 'upsert'
       WHEN contains(lower(filename), '_ups_') THEN 'upsert'
       WHEN contains(lower(filename), '_update_') THEN 'updated'
       WHEN contains(lower(filename), '_upd_') THEN 'update'
       ELSE 'addition' END AS file_intent
FROM t
""")
def q_params_tokens(spark, sf_dir):
    from shiftkit.functions.params import file_from_params, file_intent, object_from_params, second_token
    j = job_params(spark, sf_dir)
    return j.select("job_id", object_from_params("params").alias("object"),
                    file_from_params("params").alias("file"),
                    second_token("params").alias("second_token"),
                    file_intent("filename").alias("file_intent"))


@register("F13_normalize_url", """
WITH u AS (SELECT page_id, trim(coalesce(url, '')) AS raw FROM pages),
v AS (
  SELECT page_id, raw, contains(raw, '://') AS has,
         CASE WHEN contains(raw, '://') THEN regexp_extract(raw, '^([^:/?#]*)://', 1) END AS scheme,
         CASE WHEN contains(raw, '://') THEN regexp_extract(raw, '^[^:/?#]*://(.*)$', 1) ELSE raw END AS rest
  FROM u),
w AS (
  SELECT page_id, raw, scheme, regexp_extract(rest, '^([^/?#]*)', 1) AS host FROM v),
n AS (
  SELECT page_id, CASE WHEN raw = '' THEN '' WHEN host = '' THEN regexp_replace(raw, '/+$', '')
         ELSE lower(coalesce(nullif(scheme, ''), 'https')) || '://' || host END AS instance FROM w)
SELECT page_id, instance, replace(replace(instance, 'https://', ''), '/', '_') AS source_key FROM n
""")
def q_normalize_url(spark, sf_dir):
    from shiftkit.functions.params import normalize_url, source_key
    p = table(spark, sf_dir, "pages").select("page_id", normalize_url("url").alias("instance"))
    return p.select("page_id", "instance", source_key("instance").alias("source_key"))


# --- sources and sinks on landed files -------------------------------------------------

def _write_configs(spark, sf_dir, path):
    """One job configuration per order (JSON lines): exports and imports per line item.

    Only the line items' short columns are shuffled; the members are built from
    them where the text is written, and the text is compressed.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    active = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1)
    k = F.col("l_orderkey").cast("string")

    def part(x):
        return F.concat(F.lit("part_"), x["l_partkey"].cast("string"))

    def export(x):
        n = x["l_linenumber"].cast("string")
        return F.struct(F.concat(F.lit("exp_"), k, F.lit("_"), n).alias("name"),
                        F.concat(F.lit("-export item__c -csv exp_"), k, F.lit("_"), n, F.lit(".csv")).alias("params"),
                        F.concat(F.lit("l_partkey = "), x["l_partkey"].cast("string")).alias("where"),
                        F.array(F.lit("id"), F.lit("name__v"), part(x)).alias("columns"),
                        F.array(F.lit("id")).alias("ignore_column"),
                        x["active"].alias("active"), x["l_linestatus"].alias("status"))

    def import_(x):
        n = x["l_linenumber"].cast("string")
        return F.struct(F.concat(F.lit("imp_"), k, F.lit("_"), n).alias("name"),
                        F.concat(F.lit("-update item__c -csv imp_"), k, F.lit("_"), n,
                                 F.lit(".csv -idParam id")).alias("params"),
                        x["active"].alias("active"), x["l_linestatus"].alias("status"),
                        F.lit("Item").alias("business_object_type"), part(x).alias("referenced_objects"))

    items = (li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", active.alias("active")))).alias("items")))
    cfg = o.join(items, o.o_orderkey == items.l_orderkey, "left").select(
        F.to_json(F.struct(
            F.struct(F.lit("java").alias("java_exe"), F.lit("loader.jar").alias("vault_loader")).alias("general"),
            F.lit("__ES__").alias("export_settings"),
            F.struct(F.concat(F.lit("https://inst-"), F.lower(F.regexp_replace("o_orderpriority", " ", "-")),
                              F.lit(".example.com")).alias("dns"),
                     F.lit(1800).alias("time_out"),
                     F.concat(F.lit("/data/"), F.col("o_orderkey").cast("string")).alias("import_path"))
            .alias("import_settings"),
            F.transform("items", export).alias("exports"),
            F.transform("items", import_).alias("imports"))).alias("j"),
        F.when(F.col("o_orderstatus") == "F",
               F.to_json(F.struct(F.lit("https://src-a.example.com").alias("dns"),
                                  F.lit("reader").alias("username"))))
         .otherwise(F.to_json(F.array(
             F.struct(F.lit("https://src-a.example.com").alias("dns"), F.lit("reader").alias("username")),
             F.struct(F.lit("https://src-b.example.com").alias("dns"), F.lit("reader").alias("username")))))
        .alias("es"))
    # Compressed files are read by a task each: they stay small.
    (cfg.select(F.replace("j", F.lit('"__ES__"'), F.col("es")).alias("value"))
     .write.option("maxRecordsPerFile", CONFIGS_PER_FILE).text(path, compression="gzip"))


#: Configurations in a landed file, some 2 KB of text each.
CONFIGS_PER_FILE = 100_000


def configs(spark, sf_dir):
    from shiftkit.sources.config import read_job_configs
    path = landed(spark, sf_dir, "configs", lambda p: _write_configs(spark, sf_dir, p))
    return read_job_configs(spark, path, multiline=False)


CONFIG_SQL = """
WITH l AS (
  SELECT l_orderkey AS k, l_linenumber AS n, l_partkey, l_linestatus AS status,
         CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END AS active,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) - 1 AS pos
  FROM lineitem)
"""


@register("S3_scan_job_config", CONFIG_SQL + """
SELECT 'exp_' || k || '_' || n AS name, pos AS export_pos,
       '-export item__c -csv exp_' || k || '_' || n || '.csv' AS params,
       'l_partkey = ' || l_partkey AS where_clause, 3 AS n_columns, active, status
FROM l
""")
def q_scan_job_config(spark, sf_dir):
    from shiftkit.sources.config import config_exports
    e = config_exports(configs(spark, sf_dir))
    return e.select("name", F.col("export_pos").cast("long").alias("export_pos"), "params",
                    F.col("where").alias("where_clause"), F.size("columns").alias("n_columns"),
                    "active", "status")


@register("S3_export_sources", """
SELECT o_orderkey AS config, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS n_sources
FROM orders
""")
def q_export_sources(spark, sf_dir):
    from shiftkit.sources.config import config_settings
    c = config_settings(configs(spark, sf_dir)).select(
        F.substring_index("import_settings.import_path", "/", -1).cast("long").alias("config"),
        F.size("export_settings").alias("n_sources"))
    return c


@register("P10_active_filter", CONFIG_SQL + """
SELECT 'exp_' || k || '_' || n AS name FROM l WHERE coalesce(active, 1) <> 0
""")
def q_active_filter(spark, sf_dir):
    from shiftkit.operators.project import active_filter
    from shiftkit.sources.config import config_exports
    return active_filter(config_exports(configs(spark, sf_dir))).select("name")


@register("C1_export_catalog", CONFIG_SQL + """
SELECT 'exp_' || k || '_' || n AS name, coalesce(active, 1) AS active, status, 'item__c' AS object,
       'id,name__v,part_' || l_partkey AS columns
FROM l
""")
def q_export_catalog(spark, sf_dir):
    from shiftkit.plans.catalog import export_catalog
    from shiftkit.sources.config import config_exports
    c = export_catalog(config_exports(configs(spark, sf_dir)))
    return c.select("name", "active", "status", "object", "columns")


@register("C2_import_catalog", CONFIG_SQL + """
SELECT 'imp_' || k || '_' || n AS name, coalesce(active, 1) AS active, status,
       'imp_' || k || '_' || n || '.csv' AS file_path
FROM l
""")
def q_import_catalog(spark, sf_dir):
    from shiftkit.plans.catalog import import_catalog
    from shiftkit.sources.config import config_imports
    c = import_catalog(config_imports(configs(spark, sf_dir)))
    return c.select("name", "active", "status", "file_path")


@register("C3_load_order_sheet", CONFIG_SQL + """
SELECT pos + 1 AS "LoadOrderNr", 'imp_' || k || '_' || n || '.csv' AS "LoaderFileName",
       'item__c' AS "ObjectType", 'Item' AS "Business ObjectType",
       'part_' || l_partkey AS "ReferencedObject(s)", coalesce(active, 1) AS "Load is Active",
       status AS "FunctionStatus", '/data/' || k AS "BaseImportPath"
FROM l
""")
def q_load_order_sheet(spark, sf_dir):
    from shiftkit.plans.catalog import load_order_sheet
    from shiftkit.sources.config import config_imports
    s = load_order_sheet(config_imports(configs(spark, sf_dir)))
    return s.drop("LoaderConfig").withColumn("LoadOrderNr", F.col("LoadOrderNr").cast("long"))


def _write_pages(spark, sf_dir, path, page_size=1000):
    c = table(spark, sf_dir, "customer")
    total = c.count()   # one number, announced in every page as the remote query does
    rows = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name__v"),
                    F.struct(F.col("c_mktsegment").alias("segment"),
                             F.col("c_nationkey").alias("nation")).alias("account"))
    pages = (c.groupBy(F.floor(F.col("c_custkey") / page_size).alias("page"))
             .agg(F.collect_list(rows).alias("data")))
    pages.select(F.struct(F.lit(total).alias("total")).alias("responseDetails"), "data") \
        .write.json(path)


PAGE_SCHEMA = ("responseDetails struct<total: bigint>, "
               "data array<struct<id: bigint, name__v: string, account: struct<segment: string, nation: int>>>")


def pages_of(spark, sf_dir):
    from pyspark.sql.types import StructType
    from shiftkit.sources.config import read_pages
    path = landed(spark, sf_dir, "pages", lambda p: _write_pages(spark, sf_dir, p))
    return read_pages(spark, path, multiline=False, schema=StructType.fromDDL(PAGE_SCHEMA))


@register("S4_paged_union", """
SELECT c_custkey AS id, c_name AS name__v, c_mktsegment AS account__segment,
       c_nationkey AS account__nation
FROM customer
""")
def q_paged_union(spark, sf_dir):
    rows, _ = pages_of(spark, sf_dir)
    return flat_names(rows)


@register("A9_page_completeness", """
SELECT count(*) AS received, count(*) AS total, count(DISTINCT c_custkey // 1000) AS pages,
       true AS complete
FROM customer
""")
def q_page_completeness(spark, sf_dir):
    _, comp = pages_of(spark, sf_dir)
    return comp


@register("S1_scan_object_csv", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents
""")
def q_scan_object_csv(spark, sf_dir):
    from shiftkit.sources.files import read_object_csv
    path = landed(spark, sf_dir, "documents_csv",
                  lambda p: _csv_writer(table(spark, sf_dir, "documents"), p))
    return read_object_csv(spark, path)


@register("K1_write_csv", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
""")
def q_write_csv(spark, sf_dir):
    from shiftkit.sources.files import read_object_csv
    path = landed(spark, sf_dir, "customer_csv",
                  lambda p: _csv_writer(table(spark, sf_dir, "customer"), p))
    return read_object_csv(spark, path)


TREE_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem")


def _write_tree(spark, sf_dir, root):
    """Every table whole, as compressed CSV files: header scans read heads, a listing no content."""
    from shiftkit.operators.sinks import write_csv
    for t in TREE_TABLES:
        write_csv(table(spark, sf_dir, t), f"{root}/{t}", compression="gzip")


def csv_tree(spark, sf_dir):
    return landed(spark, sf_dir, "csv_tree", lambda p: _write_tree(spark, sf_dir, p))


@register("S2_scan_csv_headers", """
SELECT table_name AS relative_path, column_name AS header FROM information_schema.columns
WHERE table_name IN ('region', 'nation', 'supplier', 'customer', 'part', 'orders', 'lineitem')
""")
def q_scan_csv_headers(spark, sf_dir):
    from shiftkit.sources.files import header_long_form, scan_csv_headers
    root = csv_tree(spark, sf_dir)
    long = header_long_form(scan_csv_headers(spark, root, "*.csv.gz"), root)
    return long.select("relative_path", "header").distinct()


@register("S5_scan_file_listing")
def q_scan_file_listing(spark, sf_dir):
    from shiftkit.sources.files import list_files
    from shiftkit.functions.params import file_name_of
    return list_files(spark, sf_dir, "*.parquet").select(
        file_name_of("path").alias("file_name"), (F.col("length") > 0).alias("has_bytes"))


@register("S6_latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    from shiftkit.sources.files import latest_file, list_files
    from shiftkit.functions.params import relative_dir
    root = csv_tree(spark, sf_dir)
    latest = latest_file(list_files(spark, root, "*.csv.gz"), name_like="part-%")
    return latest.select(relative_dir("path", root).alias("relative_path"))


@register("K3_write_by_source", """
SELECT replace(replace('https://inst-' || lower(replace(o_orderpriority, ' ', '-')) || '.example.com/x',
                       'https://', ''), '/', '_') AS source_key, count(*) AS n
FROM orders GROUP BY 1
""")
def q_write_by_source(spark, sf_dir):
    from shiftkit.operators.sinks import write_by_source

    def write(p):
        o = table(spark, sf_dir, "orders").withColumn(
            "instance", F.concat(F.lit("https://inst-"), F.lower(F.regexp_replace("o_orderpriority", " ", "-")),
                                 F.lit(".example.com/x")))
        write_by_source(o, p, "instance", fmt="parquet")
    path = landed(spark, sf_dir, "by_source", write)
    back = spark.read.option("basePath", path).parquet(path)
    return back.groupBy(F.col("source_key").cast("string").alias("source_key")).agg(
        F.count(F.lit(1)).alias("n"))


@register("K4_append_run_log", OUTCOME_SQL + _reconcile_select("f.fstem = j.stem") + """
SELECT r.run_ts, st.status, count(*) AS n
FROM st, (VALUES ('2024-01-01 00:00:00'), ('2024-01-02 00:00:00')) r(run_ts)
GROUP BY ALL
""")
def q_append_run_log(spark, sf_dir):
    from shiftkit.plans.runs import append_run_log, reconcile_imports, run_log_from_outcomes

    def write(p):
        jobs = load_jobs(spark, sf_dir).drop("run")
        st = reconcile_imports(jobs, outcome_listing(spark, sf_dir), exact=True)
        st = st.join(jobs.select("job", "params"), "job", "left")
        for ts in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
            append_run_log(run_log_from_outcomes(st, ts), p)
    path = landed(spark, sf_dir, "run_log", write)
    log = spark.read.parquet(path)
    return log.groupBy(F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_ts"), "status") \
        .agg(F.count(F.lit(1)).alias("n"))


# --- further joins, ordering, names ------------------------------------------------------

@register("J1_bridge_join_left", """
SELECT l.l_orderkey, l.l_linenumber, p.p_name AS keyword_name, p.p_type AS keyword_type
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")
def q_bridge_join_left(spark, sf_dir):
    from shiftkit.operators.joins import key_join
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("keyword_name"),
                                            F.col("p_type").alias("keyword_type"))
    return key_join(li, p, [("l_partkey", "p_partkey")], how="left").select(
        "l_orderkey", "l_linenumber", "keyword_name", "keyword_type")


@register("J11_null_safe_join", """
WITH seg AS (SELECT DISTINCT nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
SELECT c.c_custkey, coalesce(seg.segment, '(none)') AS segment_label
FROM customer c LEFT JOIN seg ON nullif(c.c_mktsegment, 'BUILDING') IS NOT DISTINCT FROM seg.segment
""")
def q_null_safe_join(spark, sf_dir):
    from shiftkit.operators.joins import key_join
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg_key"))
    seg = c.select(F.col("seg_key").alias("segment")).distinct()
    j = key_join(c, seg, [("seg_key", "segment")], how="left", null_safe=True)
    return j.select("c_custkey", F.coalesce("segment", F.lit("(none)")).alias("segment_label"))


@register("J12_missing_inputs", OUTCOME_SQL + """
SELECT 'load_' || CAST(o_orderkey AS VARCHAR) || '_SUCCESS.csv' AS file_name FROM orders
WHERE 'load_' || CAST(o_orderkey AS VARCHAR) || '_SUCCESS.csv' NOT IN (SELECT file_name FROM files)
""")
def q_missing_inputs(spark, sf_dir):
    """Every order job expects its success file; which are absent from the listing?"""
    from shiftkit.sources.files import missing_inputs
    expected = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("load_"), F.col("o_orderkey").cast("string"), F.lit("_SUCCESS.csv"))
        .alias("file_name"))
    return missing_inputs(expected, outcome_listing(spark, sf_dir))


@register("T4_preview_limit", REKEY_SQL + """
SELECT owner_id AS qms_unit__c, owner_name AS "ignore__qms_unit__c__name__v",
       helper AS "ignore__keyword_helper", tag_id AS keyword__c
FROM r WHERE tag_id IS NOT NULL
ORDER BY qms_unit__c, keyword__c, "ignore__keyword_helper" LIMIT 5
""")
def q_preview_limit(spark, sf_dir):
    from shiftkit.operators.order import preview
    df = q_bridge_rekey(spark, sf_dir)
    return preview(df, ["qms_unit__c", "keyword__c", "ignore__keyword_helper"], 5)


@register("F1_normalize_column_name", """
SELECT table_name AS relative_path, column_name AS header,
       regexp_replace(replace(lower(trim(column_name)), 'ignore.', ''), '[ ._-]', '', 'g') AS normalized
FROM information_schema.columns
WHERE table_name IN ('region', 'nation', 'supplier', 'customer', 'part', 'orders', 'lineitem')
""")
def q_normalize_column_name(spark, sf_dir):
    from shiftkit.functions.names import normalize_column_name_expr
    heads = q_scan_csv_headers(spark, sf_dir)
    return heads.select("relative_path", "header",
                        normalize_column_name_expr(F.col("header")).alias("normalized"))


@register("T2_sort_case_insensitive", """
WITH n AS (
  SELECT DISTINCT p_type, CASE WHEN p_size > 25 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2)
                               ELSE p_name END AS name
  FROM part)
SELECT p_type, string_agg(name, '|' ORDER BY lower(name), name) AS names FROM n GROUP BY p_type
""")
def q_sort_case_insensitive(spark, sf_dir):
    from shiftkit.operators.aggregate import sort_ci
    p = table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") > 25, F.concat(F.upper(F.substring("p_name", 1, 1)),
                                                  F.expr("substr(p_name, 2)"))).otherwise(F.col("p_name"))
    return (p.groupBy("p_type").agg(sort_ci(F.collect_set(name)).alias("names"))
            .select("p_type", F.array_join("names", "|").alias("names")))


@register("P7_project_final", """
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_comment, o_orderstatus FROM orders
""")
def q_project_final(spark, sf_dir):
    from shiftkit.operators.project import project_final
    return project_final(table(spark, sf_dir, "orders"), ["o_orderkey", "o_comment", "o_orderstatus"],
                         strict=False)


@register("P6_rename_map", """
SELECT c_custkey AS id, c_name AS name__v, c_mktsegment AS state__v, c_phone_missing_is_skipped
FROM (SELECT *, NULL::VARCHAR AS c_phone_missing_is_skipped FROM customer) c
""")
def q_rename_map(spark, sf_dir):
    from shiftkit.functions.names import rename_keep_existing
    from shiftkit.operators.project import drop_if_present
    c = table(spark, sf_dir, "customer").withColumn(
        "c_phone_missing_is_skipped", F.lit(None).cast("string"))
    # c_name -> name__v is skipped because name__v already exists (P6 keeps the
    # existing target); the later select resolves the clash explicitly.
    c = c.withColumn("name__v", F.col("c_name"))
    r = rename_keep_existing(c, {"c_custkey": "id", "c_name": "name__v", "c_mktsegment": "state__v",
                                 "absent": "x"})
    return drop_if_present(r, ["c_name", "c_nationkey", "c_acctbal", "absent"]).select(
        "id", "name__v", "state__v", "c_phone_missing_is_skipped")


@register("W2_running_attribute_set", WALK_SQL + """
SELECT m.loader_config, m.row_id, count(s.attr) AS n_config_seen
FROM m LEFT JOIN seen s USING (loader_config, row_id) GROUP BY ALL
""")
def q_running_attribute_set(spark, sf_dir):
    from shiftkit.plans.sync import attribute_sync
    res = attribute_sync(inventory_rows(spark, sf_dir), sync_exports(spark, sf_dir))
    return res["sync"].select("loader_config", "row_id", "n_config_seen")


@register("T3_sort_numeric_suffix", INVENTORY_SQL + """,
h2 AS (SELECT DISTINCT object_type, file_intent, header FROM long
       WHERE NOT contains(lower(header), 'ignore.') AND NOT contains(lower(header), 'ignore_'))
SELECT h2.object_type, h2.file_intent,
       row_number() OVER (PARTITION BY h2.object_type, h2.file_intent
                          ORDER BY lower(h2.header), h2.header) AS pos, h2.header
FROM h2 JOIN g USING (object_type, file_intent) WHERE NOT g.d
""")
def q_sort_numeric_suffix(spark, sf_dir):
    """The wide HEAD1..HEADn sink read back in numeric column order (HEAD10 after HEAD9)."""
    from shiftkit.functions.names import head_columns
    from shiftkit.operators.aggregate import headers_by_type_intent
    from shiftkit.plans.inventory import by_type_wide
    wide = by_type_wide(headers_by_type_intent(inventory_long(spark, sf_dir)))
    heads = head_columns(wide.columns)
    long = wide.select("object_type", "file_intent",
                       F.posexplode(F.array(*[F.col(h) for h in heads])).alias("p", "header"))
    return long.where(F.col("header").isNotNull()).select(
        "object_type", "file_intent", (F.col("p") + 1).cast("long").alias("pos"), "header")


@register("J4_bridge_transfer", REKEY_SQL + """
SELECT owner_id AS qms_unit__c, owner_name AS "ignore__qms_unit__c__name__v",
       helper AS "ignore__keyword_helper", tag_id AS keyword__c
FROM r WHERE tag_id IS NOT NULL
""")
def q_bridge_transfer(spark, sf_dir):
    """J1-J4 in one plan when both instances are at hand: ids mapped on the dimensions."""
    from shiftkit.plans.bridge import bridge_transfer
    bridge, owners, tags = bridge_views(spark, sf_dir)
    t_owners, t_tags = target_views(spark, sf_dir)
    return flat_names(bridge_transfer(bridge, owners, tags, t_owners, t_tags))


def _write_failure_landing(spark, sf_dir, path):
    """events-derived failure rows as one failure 'file' per event type (Spark folders)."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    rows = failure_rows(spark, sf_dir).join(e, "event_id")
    from shiftkit.operators.sinks import write_csv
    write_csv(rows.select("event_id", "errors",
                          F.concat(F.lit("load_"), F.col("event_type"), F.lit("_FAILURE.csv"))
                          .alias("outcome_file")), path, partition_by=["outcome_file"])


@register("A2_streaming_error_counts", FAILURE_SQL.replace(
    "SELECT event_id, CASE WHEN", "SELECT event_id, event_type, CASE WHEN").replace(
    "SELECT event_id, trim(", "SELECT event_id, event_type, trim(") + """
SELECT 'load_' || event_type AS stem, error, count(*) AS n FROM m WHERE error <> '' GROUP BY ALL
""")
def q_streaming_error_counts(spark, sf_dir):
    """The failure stream (availableNow) over landed failure files; counts per stem and error."""
    from shiftkit.session import shared_dir
    from shiftkit.streaming import start_failure_stream
    landing = landed(spark, sf_dir, "failure_landing", lambda p: _write_failure_landing(spark, sf_dir, p))
    out = shared_dir(spark, "failure_counts")
    start_failure_stream(spark, landing, out, checkpoint=shared_dir(spark, "failure_ckpt")).awaitTermination()
    return (spark.read.parquet(out).groupBy("stem", "error")
            .agg(F.sum("n").cast("long").alias("n")))

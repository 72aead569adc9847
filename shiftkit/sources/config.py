"""Job configurations (S3) and landed query pages.

A job configuration is a JSON document with ``general``, ``export_settings``
(an object or an array of objects), ``import_settings``, ``exports[]`` and
``imports[]``.  Credentials are never read: the schema has no password field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = T.StructType([
    T.StructField("dns", T.StringType()),
    T.StructField("username", T.StringType()),
])

EXPORT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("params", T.StringType()),
    T.StructField("where", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("ignore_column", T.ArrayType(T.StringType())),
    T.StructField("active", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("business_object_type", T.StringType()),
    T.StructField("object_type", T.StringType()),
])

IMPORT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("params", T.StringType()),
    T.StructField("active", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("import_path", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("import_file", T.StringType()),
    T.StructField("business_object_type", T.StringType()),
    T.StructField("referenced_objects", T.StringType()),
])

IMPORT_SETTINGS = T.StructType([
    T.StructField("dns", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("time_out", T.LongType()),
    T.StructField("import_path", T.StringType()),
])

# The member names of a job configuration file.
CONFIG = T.StructType([
    T.StructField("general", T.StructType([
        T.StructField("java_exe", T.StringType()),
        T.StructField("vault_loader", T.StringType()),
        T.StructField("banner", T.StringType()),
    ])),
    T.StructField("export_settings", T.StringType()),   # object or array: parsed below
    T.StructField("import_settings", IMPORT_SETTINGS),
    T.StructField("exports", T.ArrayType(EXPORT)),
    T.StructField("imports", T.ArrayType(IMPORT)),
])


def _part(text: Column, path: str, schema: T.DataType) -> Column:
    """Parse one top-level member only: ``get_json_object`` cuts it out of the
    text, so the rest of the document is never turned into rows."""
    return F.from_json(F.get_json_object(text, path), schema)


def parse_config(text: Column) -> Column:
    """JSON text -> the whole config struct; ``export_settings`` always an array.

    Declared as text first, the field keeps its raw JSON; parsing that as an
    array wraps a lone object into a one-element array.
    """
    c = F.from_json(text, CONFIG)
    settings = F.from_json(c["export_settings"], T.ArrayType(SETTINGS))
    return c.withField("export_settings", settings)


def read_job_configs(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """S3: one row per configuration: ``loader_config`` (file name), the raw
    ``value`` and the parsed ``config``.

    ``multiline=True``: one JSON document per file (the usual layout);
    ``False``: JSON lines, one configuration per line.  The helpers below
    parse only the member they need; an unused ``config`` column is pruned
    and never parsed.
    """
    if multiline:
        raw = spark.read.text(path, wholetext=True)
    else:
        raw = spark.read.text(path)
    raw = raw.select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("loader_config"), "value")
    return raw.select("loader_config", "value", parse_config(F.col("value")).alias("config"))


def active_number(active: Column) -> Column:
    """``active`` as 0 or 1: 0 and false (as number, text or JSON literal) are 0, null stays null."""
    return F.when(active.isNotNull(), F.when(F.lower(F.trim(active)).isin("0", "false"), 0).otherwise(1)).cast("int")


def config_exports(configs: DataFrame) -> DataFrame:
    """Exports of every configuration, flattened, with ``export_pos`` from 0."""
    ex = _part(F.col("value"), "$.exports", T.ArrayType(EXPORT))
    return configs.select("loader_config", F.posexplode_outer(ex).alias("export_pos", "e")) \
        .where(F.col("e").isNotNull()).select("loader_config", "export_pos", "e.*") \
        .withColumn("active", active_number(F.col("active")))


def config_imports(configs: DataFrame) -> DataFrame:
    """Imports of every configuration, flattened, with ``import_pos`` from 0."""
    st = _part(F.col("value"), "$.import_settings", IMPORT_SETTINGS)
    im = _part(F.col("value"), "$.imports", T.ArrayType(IMPORT))
    # The settings are parsed once a configuration, below the explode, and the text ends there.
    parsed = configs.select("loader_config", st.alias("st"), im.alias("im")).select(
        "loader_config", F.col("st.import_path").alias("base_import_path"), F.col("st.dns").alias("target_dns"), "im")
    return parsed.select("loader_config", "base_import_path", "target_dns", F.posexplode_outer("im").alias("import_pos", "i")) \
        .where(F.col("i").isNotNull()) \
        .select("loader_config", "base_import_path", "target_dns", "import_pos", "i.*") \
        .withColumn("active", active_number(F.col("active")))


def config_settings(configs: DataFrame) -> DataFrame:
    """Per configuration: ``import_settings`` (struct) and ``export_settings`` (array)."""
    return configs.select(
        "loader_config",
        _part(F.col("value"), "$.import_settings", IMPORT_SETTINGS).alias("import_settings"),
        _part(F.col("value"), "$.export_settings", T.ArrayType(SETTINGS)).alias("export_settings"))


def config_sources(configs: DataFrame) -> DataFrame:
    """Export source instances of every configuration (object or array form)."""
    es = _part(F.col("value"), "$.export_settings", T.ArrayType(SETTINGS))
    return configs.select("loader_config", F.posexplode_outer(es).alias("source_pos", "s")) \
        .where(F.col("s").isNotNull()).select("loader_config", "source_pos", "s.dns", "s.username")


# --- S4 ---------------------------------------------------------------------------

def _flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to dotted top-level columns (``json_normalize``)."""
    def walk(dt: T.DataType, prefix: str, path: list[str]):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                yield from walk(f.dataType, f"{prefix}{sep}{f.name}" if prefix else f.name,
                                [*path, f.name])
        else:
            c = F.col("`" + path[0] + "`")
            for p in path[1:]:
                c = c.getField(p)
            yield c.alias(prefix)
    return df.select(*[c for f in df.schema.fields for c in walk(f.dataType, f.name, [f.name])])


def read_pages(spark: SparkSession, path: str, multiline: bool = True,
               schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """S4 + U1 + A9: union the ``data`` rows of all landed pages; check completeness.

    Returns ``(rows, completeness)``.  ``completeness`` has ``received``
    (sum of page sizes), ``total`` (the largest announced total), ``pages``
    and ``complete``.
    """
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    pages = reader.json(path)
    rows = _flatten(pages.select(F.inline("data")))
    completeness = pages.agg(
        F.sum(F.size("data")).alias("received"),
        F.max("responseDetails.total").alias("total"),
        F.count(F.lit(1)).alias("pages"),
    ).withColumn("complete", F.col("received") == F.col("total"))
    return rows, completeness


def page_gaps(pages: DataFrame, by: list[str] | None = None, offset: str = "offset", size: str = "size",
              total: str = "total", span: int = 10_000_000) -> DataFrame:
    """A9 in detail: which rows of a paged query are missing, overlapping or repeated, by offset.

    ``pages``: one row a page with the offset and number of its rows and the
    announced total of its query; ``by`` names the query.  Returns
    ``(by..., kind, from, to)``, rows ``from`` to ``to`` (exclusive):

    * ``missing``: no page has them (up to the largest total announced);
    * ``overlapping``: two different pages share them, reported with the later page;
    * ``repeated``: a page of that offset and size came more than once.

    Pages are dealt to ranges of ``span`` offsets, so no window holds a whole
    query; how far the ranges before reach is carried over from one row a range.
    Empty pages cover nothing.
    """
    from pyspark.sql import Window
    keys = list(by or [])
    p = pages.select(*keys, F.col(offset).cast("long").alias("a"), (F.col(offset) + F.col(size)).cast("long").alias("b"),
                     F.col(total).cast("long").alias("total"))
    filled = p.where("b > a")
    distinct = filled.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n"))
    ranged = distinct.withColumn("range", F.floor(F.col("a") / span))
    reach = ranged.groupBy(*keys, "range").agg(F.max("b").alias("to"))
    over_ranges = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    reach = reach.withColumn("before", F.max("to").over(over_ranges)).drop("to")
    inside = Window.partitionBy(*keys, "range").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(reach, [*keys, "range"])
    seen = joined.withColumn("seen", F.coalesce(F.greatest(F.max("b").over(inside), "before"), F.lit(0)))
    out = lambda df, kind, a, b: df.select(*keys, F.lit(kind).alias("kind"), a.alias("from"), b.alias("to"))
    missing = out(seen.where("a > seen"), "missing", F.col("seen"), F.col("a"))
    overlapping = out(seen.where("a < seen"), "overlapping", F.col("a"), F.least("b", "seen"))
    repeated = out(distinct.where("n > 1"), "repeated", F.col("a"), F.col("b"))
    ends = p.groupBy(*keys).agg(F.max("total").alias("total"), F.coalesce(F.max(F.when(F.col("b") > F.col("a"), F.col("b"))), F.lit(0)).alias("end"))
    rest = out(ends.where("total > end"), "missing", F.col("end"), F.col("total"))
    return missing.unionByName(overlapping).unionByName(repeated).unionByName(rest)


def read_page_details(spark: SparkSession, path: str, multiline: bool = True, by_file: bool = False) -> DataFrame:
    """``offset, size, total`` (and ``file``) of landed pages, for :func:`page_gaps`; the rows themselves are only counted."""
    detail = "responseDetails struct<offset: bigint, total: bigint>, data array<struct<>>"
    pages = spark.read.option("multiLine", multiline).schema(detail).json(path)
    file = [F.col("_metadata.file_path").alias("file")] if by_file else []
    return pages.select(F.coalesce("responseDetails.offset", F.lit(0)).alias("offset"), F.size("data").alias("size"),
                        F.col("responseDetails.total").alias("total"), *file)

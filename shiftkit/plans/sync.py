"""Job ``attribute_sync`` (survey 2.4 A8, 2.3 J7/J8): inventory vs configured columns.

Rows of the aggregated header inventory are walked in order.  Per row, the
attributes found in files but absent from the configured exports are added
to those exports ("to config"), and configured attributes absent from the
row are added to the row ("to row").  Additions to an export are visible to
later rows of the same key, so the walk is order-dependent.

An attribute's fate does not depend on other attributes: a row adds it when
none of the exports of its key has it, and then all of them do.  So only the
first row of each key that carries the attribute can add it (``min(row)`` per
(key, attribute), a partial aggregate), and those first rows, one per
configured key, are settled in row order by ``aggregate`` over a
configuration-sized array.  No window or group ever holds the rows of a key.
Configurations are independent of each other; exports are identified by
(``loader_config``, ``export_pos``).

Reports are tables; the configuration file is not rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.functions.params import export_object_from_params
from shiftkit.functions.text import normalize_object_type, trim_ws
from shiftkit.operators.aggregate import ordered_union

CONFIG = "loader_config"


def _with_config(exports: DataFrame) -> DataFrame:
    """``exports`` with the configuration they come from; a single unnamed one if there is no such column."""
    return exports if CONFIG in exports.columns else exports.withColumn(CONFIG, F.lit(""))


def export_index(exports: DataFrame) -> DataFrame:
    """``(loader_config, export_pos, key)`` for the business type and the ``-export`` object.

    Blank keys are left out; an export reached twice by the same key counts
    once.
    """
    exports = _with_config(exports)
    bot = F.coalesce(col("business_object_type"), col("object_type")) \
        if "object_type" in exports.columns else col("business_object_type")
    k1 = F.nullif(normalize_object_type(F.coalesce(trim_ws(bot), F.lit(""))), F.lit(""))
    k2 = F.nullif(normalize_object_type(export_object_from_params(col("params"))), F.lit(""))
    return exports.select(CONFIG, "export_pos", F.explode(F.array_distinct(F.array_compact(
        F.array(k1, k2)))).alias("key"))


def unmatched_rows(rows: DataFrame, exports: DataFrame) -> DataFrame:
    """Inventory rows whose normalised type reaches no export of any configuration."""
    keys = export_index(exports).select("key").distinct()
    rk = rows.select("row_id", "object_type", "file_intent",
                     normalize_object_type(F.coalesce(col("object_type"), F.lit(""))).alias("key"))
    return rk.join(keys, "key", "left_anti").select("row_id", "object_type", "file_intent")


def _clean_attrs(arr) -> F.Column:
    return F.array_distinct(F.filter(F.transform(F.coalesce(arr, F.array().cast("array<string>")),
                                                 trim_ws), lambda a: a != ""))


def _configured(exports: DataFrame) -> DataFrame:
    """(loader_config, export_pos, cpos, attr): the configured columns, one row each."""
    return _with_config(exports).select(CONFIG, "export_pos", F.posexplode(F.coalesce(
        col("columns"), F.array().cast("array<string>"))).alias("cpos", "attr"))


def _introductions(rk: DataFrame, exports_of: DataFrame, configured: DataFrame) -> DataFrame:
    """(loader_config, attr, row_id, apos, key, exports): which row adds an attribute to the exports of its key."""
    first = (rk.select("key", "row_id", F.posexplode("attrs").alias("apos", "attr"))
             .groupBy("key", "attr").agg(F.min(F.struct("row_id", "apos")).alias("f")))
    turn = F.struct(F.col("f.row_id").alias("row_id"), F.col("f.apos").alias("apos"), F.col("key"), F.col("exports"))
    turns = (first.join(exports_of, "key").groupBy(CONFIG, "attr")
             .agg(F.array_sort(F.collect_list(turn)).alias("turns")))      # one per configured key
    owners = configured.groupBy(CONFIG, "attr").agg(F.collect_set("export_pos").alias("owners"))
    both = turns.join(owners, [CONFIG, "attr"], "left")
    none = F.filter("turns", lambda t: F.lit(False))
    start = F.struct(F.coalesce("owners", F.array().cast(owners.schema["owners"].dataType)).alias("owners"), none.alias("adds"))
    settled = F.aggregate("turns", start, lambda so_far, t: F.when(
        F.arrays_overlap(so_far["owners"], t["exports"]), so_far).otherwise(F.struct(
            F.concat(so_far["owners"], t["exports"]).alias("owners"),
            F.concat(so_far["adds"], F.array(t)).alias("adds"))))
    return both.select(CONFIG, "attr", F.explode(settled["adds"]).alias("t")).select(CONFIG, "attr", "t.*")


def attribute_sync(rows: DataFrame, exports: DataFrame) -> dict[str, DataFrame]:
    """A8 + W2 + J7 + J8 + A7 + U2.

    ``rows``: ``row_id`` (walk order), ``object_type``, ``file_intent``,
    ``attrs`` (array, in the row's column order).  ``exports``:
    ``export_pos``, ``name``, ``business_object_type``, ``params``,
    ``columns`` (array) and, if there are several configurations,
    ``loader_config``.  Returns ``sync`` (one row per configuration and row
    that it matches; ``n_config_seen`` is the size of the running attribute
    set, W2, that the row is compared with), ``unmatched`` (J8),
    ``config_additions`` (per export, in order) and ``config_columns`` (per
    export all columns after the additions).
    """
    idx = export_index(exports)
    group = [CONFIG, "key"]
    exports_of = idx.groupBy(*group).agg(F.array_sort(F.collect_list("export_pos")).alias("exports"))
    rk = rows.select(F.col("row_id").cast("long").alias("row_id"), "object_type", "file_intent",
                     normalize_object_type(F.coalesce(col("object_type"), F.lit(""))).alias("key"),
                     _clean_attrs(col("attrs")).alias("attrs"))
    unmatched = rk.join(idx.select("key").distinct(), "key", "left_anti").select("row_id", "object_type", "file_intent")
    configured = (_configured(exports).withColumn("attr", trim_ws(col("attr"))).where("attr <> ''")
                  .groupBy(CONFIG, "export_pos", "attr").agg(F.min("cpos").alias("cpos")))
    added = _introductions(rk, exports_of, configured)

    # What an export holds and since which row, in the order of its column list.
    since = lambda phase, a, b, intro: F.struct(
        F.col("export_pos").alias("e"), F.lit(phase).alias("phase"), a.cast("long").alias("a"),
        b.cast("int").alias("b"), intro.cast("long").alias("intro"), F.col("attr")).alias("x")
    entries = configured.select(CONFIG, "export_pos", since(0, F.col("cpos"), F.lit(0), F.lit(-1))).unionByName(
        added.withColumn("export_pos", F.explode("exports")).select(
            CONFIG, "export_pos", since(1, F.col("row_id"), F.col("apos"), F.col("row_id"))))
    known = (entries.join(idx, [CONFIG, "export_pos"]).groupBy(*group)
             .agg(F.array_sort(F.collect_list("x")).alias("known")))
    by_row = added.groupBy(CONFIG, "row_id").agg(F.array_sort(F.collect_list(F.struct("apos", "attr"))).alias("new"))
    per_row = rk.join(exports_of, "key").join(known, group, "left").join(by_row, [CONFIG, "row_id"], "left")
    names = F.array().cast("array<string>")
    seen = F.array_distinct(F.transform(F.filter("known", lambda x: x["intro"] < F.col("row_id")), lambda x: x["attr"]))
    per_row = per_row.select(CONFIG, "row_id", "object_type", "file_intent", "exports", "attrs",
                             F.coalesce(seen, names).alias("seen"),
                             F.coalesce(F.col("new.attr"), names).alias("added_to_config"))
    missing = F.array_except("seen", "attrs")
    sync = per_row.select(
        CONFIG, "row_id", "object_type", "file_intent", F.size("seen").cast("long").alias("n_config_seen"),
        "added_to_config", missing.alias("added_to_row"),
        (F.size("added_to_config") * F.size("exports")).cast("long").alias("n_added_to_config"),
        F.size(missing).cast("long").alias("n_added_to_row"))
    ordered = F.array_sort(F.collect_list("x"))
    titled = _with_config(exports).select(CONFIG, "export_pos", "name")
    per_export = entries.groupBy(CONFIG, "export_pos").agg(ordered.alias("x")).join(titled, [CONFIG, "export_pos"])
    later = F.transform(F.filter("x", lambda x: x["phase"] == 1), lambda x: x["attr"])
    return {"sync": sync, "unmatched": unmatched,
            "config_additions": per_export.select(CONFIG, "export_pos", later.alias("added"), "name").where(F.size("added") > 0),
            "config_columns": per_export.select(CONFIG, "export_pos", "name", F.col("x.attr").alias("columns"))}


def additions_layout(rows: DataFrame, sync: DataFrame, span: int = 100_000) -> DataFrame:
    """K5 after the walk: ``(loader_config, row_id, head, attr)``, where each attribute added to a row stands in the wide form.

    A row's additions begin in the last head column there is, or in a new one
    if the row holds that itself, and each further one opens a column; columns
    opened for a row are there for all later ones.  So a row begins where the
    openings before it end, a running sum over rows.  It is taken within ranges
    of ``span`` rows and carried over by one number a range.
    """
    from pyspark.sql import Window
    width = rows.agg(F.max(F.size("attrs"))).first()[0] or 0             # one number
    own = rows.select("row_id", (F.size(_clean_attrs(col("attrs"))) == F.lit(width)).alias("full"))
    added = (sync.where(F.size("added_to_row") > 0).select(CONFIG, "row_id", "added_to_row", (F.size("added_to_row") - 1).alias("opens"))
             .join(own, "row_id").withColumn("range", F.floor(F.col("row_id") / span)))
    before = lambda *keys: (Window.partitionBy(CONFIG, *keys).rowsBetween(Window.unboundedPreceding, -1))
    carried = (added.groupBy(CONFIG, "range").agg(F.sum("opens").alias("n"))
               .select(CONFIG, "range", F.coalesce(F.sum("n").over(before().orderBy("range")), F.lit(0)).alias("carried")))
    placed = added.join(carried, [CONFIG, "range"]).withColumn(
        "opened", F.col("carried") + F.coalesce(F.sum("opens").over(before("range").orderBy("row_id")), F.lit(0)))
    # Only while no column was opened can a row of full width stand in the way; it opens one for itself and all later rows.
    first = placed.where(F.col("full") & (F.col("opened") == 0) & F.lit(width > 0)).groupBy(CONFIG).agg(F.min("row_id").alias("moved"))
    placed = placed.join(first, CONFIG, "left")
    start = F.lit(max(width, 1)) + F.col("opened") + F.when(F.col("row_id") >= F.col("moved"), 1).otherwise(0)
    return (placed.select(CONFIG, "row_id", start.alias("start"), F.posexplode("added_to_row").alias("i", "attr"))
            .select(CONFIG, "row_id", (F.col("start") + F.col("i")).cast("long").alias("head"), "attr"))


def sync_totals(rows: DataFrame, exports: DataFrame, sync: DataFrame) -> DataFrame:
    """The report's numbers per configuration: rows, rows whose type it doesn't have, attributes added to it and to rows."""
    every = rows.agg(F.count(F.lit(1)).alias("n_rows"))
    n_rows = every.first()["n_rows"]                                       # one number
    sums = sync.groupBy(CONFIG).agg(F.count(F.lit(1)).alias("matched"), F.sum("n_added_to_config").alias("added_to_config"),
                                    F.sum("n_added_to_row").alias("added_to_rows"))
    configs = _with_config(exports).select(CONFIG).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return configs.join(sums, CONFIG, "left").select(
        CONFIG, F.lit(n_rows).cast("long").alias("n_rows"), (F.lit(n_rows) - zero("matched")).alias("unmatched"),
        zero("added_to_config").alias("added_to_config"), zero("added_to_rows").alias("added_to_rows"))


def _config_lists(exports: DataFrame) -> DataFrame:
    """``(loader_config, key, attrs)``, the columns of a key's exports in order of first occurrence."""
    keyed = export_index(exports).join(_configured(exports), [CONFIG, "export_pos"]).withColumn("__k", F.struct(CONFIG, "key"))
    union = ordered_union(keyed, "__k", "attr", ["export_pos", "cpos"])
    return (union.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("first", "attr"))).alias("__l"))
            .select("__k.*", F.col("__l.attr").alias("attrs")))


def attr_difference(rows: DataFrame, exports: DataFrame) -> DataFrame:
    """Per configuration and matched row, attributes only in the row and only in the configuration.

    Plain set difference against the initial configuration (no walk, no
    order dependence): ``array_except`` both ways against the key's
    ordered union (A7), which is joined per row as one small array.
    """
    rk = rows.select("row_id", normalize_object_type(F.coalesce(col("object_type"), F.lit("")))
                     .alias("key"), _clean_attrs(col("attrs")).alias("attrs"))
    keyed = rk.join(ordered_config_lists(exports).withColumnRenamed("attrs", "config_attrs"), "key")
    return keyed.select(CONFIG, "row_id", F.array_except("attrs", "config_attrs").alias("only_in_row"),
                        F.array_except("config_attrs", "attrs").alias("only_in_config"))


def ordered_config_lists(exports: DataFrame) -> DataFrame:
    """A7 per configuration and key: ``(loader_config, key, attrs)``; a key without columns has an empty list."""
    keys = export_index(exports).select(CONFIG, "key").distinct()
    return keys.join(_config_lists(exports), [CONFIG, "key"], "left").select(
        CONFIG, "key", F.coalesce("attrs", F.array().cast("array<string>")).alias("attrs"))


def check_export_config(by_type: DataFrame, configs: DataFrame, out_dir: str | None = None
                        ) -> dict[str, DataFrame]:
    """The check job: aggregated header inventory (A4) vs the configuration's exports.

    Rows are numbered in the inventory's written order (case-insensitive by
    object type, then intent); the unmatched report carries the CSV line
    (``row_number`` = row + 1, after the header line).  With ``out_dir`` the
    reports are written as CSV (sync lists joined with ``|``).
    """
    from shiftkit.operators.order import ci_sort_keys, global_row_number
    from shiftkit.sources.config import config_exports
    rows = global_row_number(by_type, ci_sort_keys(["object_type", "file_intent"])) \
        .withColumnRenamed("headers", "attrs")
    exports = config_exports(configs).select(CONFIG, "export_pos", "name", "business_object_type",
                                             "object_type", "params", "columns")
    res = attribute_sync(rows, exports)
    res["unmatched"] = res["unmatched"].select((F.col("row_id") + 1).alias("row_number"),
                                               "object_type", "file_intent")
    if out_dir:
        from shiftkit.operators.sinks import write_csv
        write_csv(res["unmatched"], f"{out_dir}/unmatched_object_types")
        write_csv(res["sync"].select(
            CONFIG, "row_id", "object_type", "file_intent", "n_config_seen",
            F.array_join("added_to_config", "|").alias("added_to_config"),
            F.array_join("added_to_row", "|").alias("added_to_row"),
            "n_added_to_config", "n_added_to_row"), f"{out_dir}/sync")
        write_csv(res["config_additions"].select(
            CONFIG, "export_pos", "name", F.array_join("added", "|").alias("added")),
            f"{out_dir}/config_additions", single_file=True)
    return res

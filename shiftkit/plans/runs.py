"""Jobs ``export_snapshot`` and ``run_summary`` (survey 3.1, 3.4).

``export_snapshot``: per active export, filter + project (+ relation paths) a
table, mark ignore-columns, write it under its source key and log the row
count observed in the same pass.  ``run_summary``: reconcile import jobs with
the outcome files the loader left (J9, F16) and roll up per run (A5).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.functions.outcomes import reconcile_status
from shiftkit.functions.params import (
    FAILURE_SUFFIX, SUCCESS_SUFFIX, file_name_of, file_stem, first_non_blank, object_from_params, outcome_status, outcome_stem,
    source_key,
)
from shiftkit.operators.aggregate import row_count_observed
from shiftkit.operators.joins import possible_patterns
from shiftkit.operators.project import mark_ignored, project_columns, where_filter
from shiftkit.plans.relations import Relations, resolve_export

RUN_LOG_SCHEMA = ("run_ts timestamp, job string, op string, object_name string, status string, "
                  "file_name string, row_count long, reasons array<string>, ts timestamp")


def export_view(table: DataFrame, where: str | None = None, columns: Sequence[str] | None = None,
                ignore_columns: Sequence[str] | None = None) -> DataFrame:
    """P2 -> P1 -> P4: what one export definition yields from a table."""
    return mark_ignored(project_columns(where_filter(table, where), columns), ignore_columns)


def write_export(df: DataFrame, out_dir: str, source: str, name: str) -> int:
    """K1 + K3 + A1: write under ``source_key=<key>/<name>`` and return the rows written.

    The count is an ``Observation`` on the written plan: one pass, no re-read.
    """
    key = source.replace("https://", "").replace("/", "_")
    observed, obs = row_count_observed(df, f"rows_{uuid.uuid4().hex}")
    (observed.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{out_dir.rstrip('/')}/source_key={key}/{name}"))
    return int(obs.get.get("row_count", 0))


def append_run_log(log: DataFrame, path: str) -> None:
    """K4: add one run to the run-log table, partitioned by run and operation.

    Dynamic partition overwrite replaces only the partitions of the runs and
    operations being written: other runs, and an import logged under the
    time of an export, stay, and writing the same run again (a retry
    after a lost executor or a failed job) replaces its rows instead of
    appending them twice.
    """
    (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_ts", "op").parquet(path))


def reconcile_imports(jobs: DataFrame, files: DataFrame, exact: bool = True,
                      keep: Sequence[str] = ()) -> DataFrame:
    """J9 + F16 per import job: ``SUCCESS`` / ``FAILED`` / ``SKIPPED`` from outcome files.

    ``jobs``: ``job`` (name), ``params``, ``active``, optional
    ``import_path`` / ``file`` / ``import_file``.  ``files``: ``path`` of
    outcome files (S5 listing).  The loader file's stem is matched to
    ``<stem>_SUCCESS.csv`` / ``<stem>_FAILURE.csv`` by equality
    (``exact=True``) or, as the reference does, when it occurs anywhere in
    the file name (``exact=False``, so ``35_a`` also matches
    ``35_ab_SUCCESS.csv``).  A failure file wins; no file at all is a
    failure; inactive jobs are skipped.  ``keep`` names job columns to carry
    into the result (e.g. the run a job belongs to).
    """
    opt = [c for c in ("import_path", "file", "import_file") if c in jobs.columns]
    loader_file = first_non_blank(*opt, "job") if opt else col("job")
    j = jobs.select("*", file_stem(loader_file).alias("stem"),
                    F.coalesce(col("active").cast("int"), F.lit(1)).alias("__active"))
    f = files.select(file_name_of("path").alias("file_name"))
    f = f.select("file_name", outcome_status("file_name").alias("outcome")).where(
        F.col("outcome").isNotNull())
    active = j.where(F.col("__active") != 0)
    if exact:
        # Files aggregate to one row per stem before the join, and the stem
        # fixes both possible file names: flags suffice (a hash aggregation),
        # and the join is 1:1 on unique keys, so no key can be hot.
        flags = (f.groupBy(outcome_stem("file_name").alias("__fstem"))
                 .agg(F.bool_or(F.col("outcome") == "failure").alias("has_failure"),
                      F.bool_or(F.col("outcome") == "success").alias("has_success")))
        per = j.select("job", "stem", "__active", *keep).join(
            flags, F.col("stem") == F.col("__fstem"), "left")
        file_name = (F.when(F.col("has_failure"), F.concat("stem", F.lit(FAILURE_SUFFIX)))
                     .when(F.col("has_success"), F.concat("stem", F.lit(SUCCESS_SUFFIX))))
    else:
        # Substring form: flags and first files per possible stem before
        # anything is shuffled (partial aggregation), so a short stem contained
        # in many file names never becomes many (job, file) pairs.  The
        # join with the jobs is 1:1 on it and drops what is no stem.
        per_stem = possible_patterns(f, "file_name", active, "stem").groupBy("__pattern").agg(
            F.bool_or(F.col("outcome") == "failure").alias("has_failure"),
            F.bool_or(F.col("outcome") == "success").alias("has_success"),
            F.min(F.when(F.col("outcome") == "failure", F.col("file_name"))).alias("failure_file"),
            F.min(F.when(F.col("outcome") == "success", F.col("file_name"))).alias("success_file"))
        per = j.select("job", "stem", "__active", *keep).join(
            per_stem, F.col("stem") == F.col("__pattern"), "left")
        file_name = F.coalesce("failure_file", "success_file")
    # One pass over the jobs: inactive ones are SKIPPED whatever files exist.
    skip = F.col("__active") == 0
    return per.select(
        "job", "stem", *keep,
        F.when(skip, F.lit("SKIPPED")).otherwise(reconcile_status("has_failure", "has_success"))
        .alias("status"),
        F.when(skip, F.lit(None).cast("string")).otherwise(file_name).alias("file_name"))


def run_log_from_outcomes(outcomes: DataFrame, run_ts: str, op: str = "import") -> DataFrame:
    """K4 rows from a table of job outcomes (``job``, ``status``, ``file_name``,
    optional ``params`` and ``reasons``)."""
    obj = object_from_params("params") if "params" in outcomes.columns else F.lit(None).cast("string")
    reasons = (col("reasons") if "reasons" in outcomes.columns
               else F.array().cast("array<string>"))
    return outcomes.select(
        F.to_timestamp(F.lit(run_ts)).alias("run_ts"), col("job"), F.lit(op).alias("op"),
        F.nullif(obj, F.lit("")).alias("object_name"), col("status"), col("file_name"),
        F.lit(None).cast("long").alias("row_count"), reasons.alias("reasons"),
        F.current_timestamp().alias("ts"))


def run_chains(spark, chains: Sequence[Sequence[tuple[str, Callable[[], list[dict]]]]], parallel: int) -> list[list[list[dict]]]:
    """Run chains of (tag, step) as concurrent Spark jobs: the steps of a chain one after the other, chains side by side.

    Each chain has a scheduler pool of its own (fair, if the session schedules
    so) and each step's jobs carry its tag, by which they can be interrupted.
    Results come back in the order given, however the steps ended up in time.
    """
    def run(chain: Sequence[tuple[str, Callable[[], list[dict]]]]) -> list[list[dict]]:
        out = []
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", chain[0][0] if chain else None)
        for tag, step in chain:
            spark.addTag(tag)
            try:
                out.append(step())
            finally:
                spark.removeTag(tag)
        return out

    if parallel <= 1:
        try:
            return [run(c) for c in chains]
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    with ThreadPoolExecutor(max_workers=parallel) as threads:
        return list(threads.map(lambda c: inheritable_thread_target(spark)(run)(c), chains))


def _tag(*parts) -> str:
    """Letters, digits and a few signs: what a job tag may hold."""
    return re.sub(r"[^A-Za-z0-9._-]", "_", "-".join(str(p) for p in parts))


def _logged(spark, log: list[dict], run_ts: str, log_path: str | None, run_id: str | None) -> DataFrame:
    """The run-log rows of a run; written if there is a path, with a run id by the commit protocol of ``plans.runlog``."""
    rows = spark.createDataFrame(
        [(r["job"], r["op"], r["object_name"], r["status"], r["file_name"], r["row_count"],
          r["reasons"]) for r in log],
        "job string, op string, object_name string, status string, file_name string, "
        "row_count long, reasons array<string>")
    out = rows.select(F.to_timestamp(F.lit(run_ts)).alias("run_ts"), "*",
                      F.current_timestamp().alias("ts"))
    if log_path and run_id:
        from shiftkit.plans.runlog import log_run
        log_run(out, log_path, run_id)
    elif log_path:
        append_run_log(out, log_path)
    return out


def run_exports(spark, configs: DataFrame, read_object, out_dir: str, run_ts: str,
                log_path: str | None = None, relations: Relations | None = None, parallel: int = 4,
                run_id: str | None = None) -> DataFrame:
    """Job ``export_snapshot``: run every export definition of the configurations.

    ``S3 -> P10 -> (read -> P2 -> P1 -> P4 -> Observation) -> K3/K1 -> K4``.
    The definitions are configuration (a handful per job file), so they are
    walked on the driver; each export is one Spark job writing its table
    under ``source_key=<instance>/<configuration>/<name>`` with the row count observed in the
    same pass, ``parallel`` of them at a time (:func:`run_chains`).
    ``read_object(object_name)`` returns the object's table.  A
    failing export is logged as ``FAILED`` with the reason and does not stop
    the run; inactive ones are ``SKIPPED``.  Paths through ``relations`` are
    resolved (:mod:`shiftkit.plans.relations`).  Returns the run-log rows in
    the order of the definitions (and writes them to ``log_path`` when given).
    """
    from shiftkit.functions.params import file_from_params
    from shiftkit.sources.config import config_exports, config_sources
    exports = (config_exports(configs)
               .select("loader_config", "export_pos", "name", "params", "where", "columns",
                       "ignore_column", F.coalesce(F.col("active"), F.lit(1)).alias("active"),
                       object_from_params("params", ("export",)).alias("object"),
                       file_from_params("params").alias("file"))
               .orderBy("loader_config", "export_pos").collect())
    sources = {}
    for r in config_sources(configs).select("loader_config", "dns").collect():
        sources.setdefault(r["loader_config"], []).append(r["dns"])

    def export(e, dns: str) -> list[dict]:
        base = {"job": e["name"], "op": "export", "object_name": e["object"] or None}
        if e["active"] == 0:
            return [{**base, "status": "SKIPPED", "file_name": None, "row_count": None, "reasons": []}]
        try:
            view = resolve_export(read_object(e["object"]), e["object"], read_object, relations or {}, e["where"],
                                  list(e["columns"] or []), list(e["ignore_column"] or []))
            # The configuration is part of the folder: two of them may name an export alike.
            n = write_export(view, out_dir, dns or "local", f"{e['loader_config']}/{e['name']}")
            return [{**base, "status": "SUCCESS", "file_name": e["file"] or None, "row_count": n, "reasons": []}]
        except Exception as exc:   # one failed export is a log row, not a stopped run
            return [{**base, "status": "FAILED", "file_name": e["file"] or None,
                     "row_count": None, "reasons": [str(exc) or type(exc).__name__]}]

    chains = []
    for e in exports:
        for dns in [""] if e["active"] == 0 else sources.get(e["loader_config"], []) or [""]:
            tag = _tag("export", e["loader_config"], e["export_pos"], dns)
            chains.append([(tag, lambda e=e, dns=dns: export(e, dns))])
    log = [row for chain in run_chains(spark, chains, parallel) for rows in chain for row in rows]
    return _logged(spark, log, run_ts, log_path, run_id)


def run_imports(spark, configs: DataFrame, read_loader_file, read_table, out_dir: str, run_ts: str,
                log_path: str | None = None, id_col: str = "id", listing: DataFrame | None = None,
                parallel: int = 4, run_id: str | None = None, store_of=None) -> DataFrame:
    """The import loop: apply every active import definition as a change set.

    Rows are matched by the column that ``-idParam`` names, ``id_col`` if
    there is none.  An import sees what earlier imports of the run left of
    its object.  With ``listing`` (S5, column ``path``), an import whose file is not
    listed fails with that reason before anything is read (J12).

    For each import: read its loader file
    (``read_loader_file(base_import_path, file)``) and the target object's
    table (``read_table(object)``), apply create/update/upsert (K2), write
    the new version under ``<out_dir>/tables/<object>/<import name>`` and the
    loader-style outcome folders ``<stem>_SUCCESS.csv`` / ``<stem>_FAILURE.csv``
    (rows plus ``errors``) under ``<out_dir>/outcomes/<configuration>/<position>_<name>``,
    a folder for each import, which the failure analysis reads.  With ``store_of(object)``
    the versions are those of a :class:`~shiftkit.plans.versions.VersionStore`
    and only the buckets that a set falls into are read and rewritten.

    The imports of one object follow each other in configuration order;
    ``parallel`` objects are worked on at a time (:func:`run_chains`).  The
    failure count is observed while writing.  An import with any failed row is
    ``FAILED`` (a failure file wins), inactive ones are ``SKIPPED``.  Returns
    the run-log rows in configuration order (written to ``log_path`` if given).
    """
    from shiftkit.functions.params import file_from_params, file_stem
    from shiftkit.operators.sinks import write_csv
    from shiftkit.plans.changes import apply_change_set, change_results
    from shiftkit.sources.config import config_imports
    from shiftkit.sources.files import missing_inputs
    op_flag = F.regexp_extract("params", r"(?:^|\s)-(create|update|upsert)(?:\s|$)", 1)
    key_flag = F.regexp_extract("params", r"(?:^|\s)-idParam\s+([^\s-]\S*)", 1)
    file = file_from_params("params")
    imports = (config_imports(configs)
               .select("loader_config", "import_pos", "name", "base_import_path",
                       F.coalesce(F.col("active"), F.lit(1)).alias("active"), op_flag.alias("op"),
                       key_flag.alias("key"), object_from_params("params").alias("object"),
                       file.alias("file"), file_stem(F.when(file == "", F.col("name")).otherwise(file)).alias("stem"))
               .orderBy("loader_config", "import_pos").collect())
    absent = set()
    if listing is not None:
        wanted = spark.createDataFrame([(im["file"],) for im in imports if im["file"]], "file_name string").distinct()
        absent = {r["file_name"] for r in missing_inputs(wanted, listing).collect()}
    versions: dict[str, list[str]] = {}    # object -> where the run's versions of it are, in order

    def step(im) -> list[dict]:
        base = {"job": im["name"], "op": im["op"] or "import", "object_name": im["object"] or None,
                "file_name": im["file"] or None}
        if im["active"] == 0:
            return [{**base, "status": "SKIPPED", "row_count": None, "reasons": []}]
        try:
            if im["op"] not in ("create", "update", "upsert"):
                raise ValueError(f"no create/update/upsert flag in the parameters of {im['name']}")
            if im["file"] in absent:
                raise FileNotFoundError(f"input file {im['file']} is missing")
            changes = read_loader_file(im["base_import_path"], im["file"])
            key, stem = im["key"] or id_col, im["stem"]
            store = store_of(im["object"]) if store_of is not None else None
            if store is not None:
                results = store.results(changes, im["op"])
            else:
                done = versions.setdefault(im["object"], [])
                at = spark.read.parquet(done[-1]) if done else read_table(im["object"])
                results = change_results(at, changes, im["op"], key)
            outcomes = f"{out_dir}/outcomes/{im['loader_config']}/{im['import_pos']}_{im['name']}"
            # A copy of the loader file next to its outcomes, as the loader leaves it.
            observed, read = row_count_observed(changes, f"read_{uuid.uuid4().hex}")
            write_csv(observed, f"{outcomes}/{stem}.csv")
            failed, obs = row_count_observed(results.where(F.col("status") == "failure"), f"fail_{uuid.uuid4().hex}")
            write_csv(failed.drop("action", "status"), f"{outcomes}/{stem}{FAILURE_SUFFIX}")
            n_failed = int(obs.get.get("row_count", 0))
            write_csv(results.where(F.col("status") == "success").drop("action", "status", "errors"),
                      f"{outcomes}/{stem}{SUCCESS_SUFFIX}")
            if store is not None:
                store.apply(changes, im["op"])
            else:
                to = f"{out_dir}/tables/{im['object']}/{im['name']}"
                if to in done:             # two imports of one name: no version is overwritten
                    to = f"{to}_{len(done)}"
                apply_change_set(at, changes, im["op"], key).write.mode("overwrite").parquet(to)
                done.append(to)
            return [{**base, "status": "FAILED" if n_failed else "SUCCESS",
                     "row_count": int(read.get.get("row_count", 0)),
                     "reasons": [f"{n_failed} rows failed"] if n_failed else []}]
        except Exception as exc:   # one failed import is a log row, not a stopped run
            return [{**base, "status": "FAILED", "row_count": None,
                     "reasons": [str(exc) or type(exc).__name__]}]

    of_object: dict[str, list[int]] = {}
    for i, im in enumerate(imports):
        of_object.setdefault(im["object"], []).append(i)
    chains = [[(_tag("import", imports[i]["loader_config"], imports[i]["import_pos"]), lambda i=i: step(imports[i])) for i in at]
              for at in of_object.values()]
    done_rows = run_chains(spark, chains, parallel)
    in_order = {i: rows for at, chain in zip(of_object.values(), done_rows, strict=True) for i, rows in zip(at, chain, strict=True)}
    return _logged(spark, [row for i in sorted(in_order) for row in in_order[i]], run_ts, log_path, run_id)

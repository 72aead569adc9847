"""Job-outcome classification (F14-F16), as expressions over tables of job outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftkit.functions.text import _c, trim_ws

# Output markers that make an export job count as failed.
EXPORT_FAILURE_MARKERS = ("failure:", "error making request", "exception", "unknown relationship")

# The loader prints one banner line on every run; the exact text depends on
# the loader release, so callers pass it (job config ``general.banner``).


def _escape_regex(text: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\-/" else ch for ch in text)


def export_failed(return_code: Column | str, stdout: Column | str, stderr: Column | str) -> Column:
    """failed when the code is not 0 or the output holds a failure marker."""
    text = F.lower(F.concat_ws("\n", F.coalesce(_c(stdout), F.lit("")),
                               F.coalesce(_c(stderr), F.lit(""))))
    pattern = "|".join(_escape_regex(m) for m in EXPORT_FAILURE_MARKERS)
    return (F.coalesce(_c(return_code), F.lit(-1)) != 0) | text.rlike(pattern)


def import_extra_output(stdout: Column | str, banner: str) -> Column:
    """F15 helper: output beyond the banner line, '' when there is none."""
    out = trim_ws(F.coalesce(_c(stdout), F.lit("")))
    rest = trim_ws(F.substr(out, F.lit(len(banner) + 1)))
    return (F.when((out == "") | (out == F.lit(banner)), F.lit(""))
            .when(out.startswith(banner), rest)
            .otherwise(out))


def import_failed(return_code: Column | str, stdout: Column | str, banner: str) -> Column:
    """failed when the code is not 0 or anything beyond the banner was printed."""
    return (F.coalesce(_c(return_code), F.lit(-1)) != 0) | (import_extra_output(stdout, banner) != "")


def import_failure_reason(return_code: Column | str, stdout: Column | str, stderr: Column | str,
                          banner: str) -> Column:
    """F15 reason text: the extra output, else stderr, else a fixed text."""
    out = trim_ws(F.coalesce(_c(stdout), F.lit("")))
    extra = import_extra_output(stdout, banner)
    return (F.when(extra != "",
                   F.when(out.startswith(banner), F.concat(F.lit("Additional output: "), extra))
                   .otherwise(F.concat(F.lit("Unexpected output: "), extra)))
            .when(F.coalesce(_c(return_code), F.lit(-1)) != 0,
                  F.coalesce(F.nullif(_c(stderr), F.lit("")), F.lit("Unknown error"))))


def import_failure_reasons(return_code: Column | str, stdout: Column | str, stderr: Column | str, banner: str) -> Column:
    """F15 as the run log gets it: every reason of a failed import in order, an empty list for one that went well.

    Output beyond the banner is one reason; a failed import is also logged
    with its error output, or a fixed text if it has none.
    """
    out = trim_ws(F.coalesce(_c(stdout), F.lit("")))
    extra = import_extra_output(stdout, banner)
    first = F.when(extra != "", F.concat(F.when(out.startswith(banner), F.lit("Additional output: "))
                                         .otherwise(F.lit("Unexpected output: ")), extra))
    last = F.when(import_failed(return_code, stdout, banner), F.coalesce(F.nullif(_c(stderr), F.lit("")), F.lit("Unknown error")))
    return F.array_compact(F.array(first, last))


def reconcile_status(has_failure: Column | str, has_success: Column | str) -> Column:
    """F16: a failure file wins over a success file; neither counts as failed."""
    return (F.when(F.coalesce(_c(has_failure), F.lit(False)), F.lit("FAILED"))
            .when(F.coalesce(_c(has_success), F.lit(False)), F.lit("SUCCESS"))
            .otherwise(F.lit("FAILED")))

"""Column expressions (section 2.9 of the survey) and column-name helpers."""

from shiftkit.functions.names import (
    ColumnResolutionError, col, flat_names, head_columns, normalize_column_name,
    normalize_column_name_expr, quote, rename_keep_existing, resolve_column, resolve_columns,
)
from shiftkit.functions.outcomes import (
    export_failed, import_extra_output, import_failed, import_failure_reason, reconcile_status,
)
from shiftkit.functions.params import (
    columns_display, export_object_from_params, file_from_params, file_intent, file_name_of,
    file_stem, first_non_blank, normalize_url, object_from_params, outcome_status, outcome_stem,
    relative_dir, second_token, source_key,
)
from shiftkit.functions.text import (
    blank_to_null, business_key, collapse_ws, mask_bracketed, normalize_error,
    normalize_object_type, trim_ws,
)

__all__ = [
    "ColumnResolutionError", "blank_to_null", "business_key", "col", "collapse_ws",
    "columns_display", "export_failed", "export_object_from_params", "file_from_params",
    "file_intent", "file_name_of", "file_stem", "first_non_blank", "flat_names", "head_columns",
    "import_extra_output", "import_failed", "import_failure_reason", "mask_bracketed",
    "normalize_column_name", "normalize_column_name_expr", "normalize_error",
    "normalize_object_type", "normalize_url", "object_from_params", "outcome_status",
    "outcome_stem", "quote", "reconcile_status", "relative_dir", "rename_keep_existing",
    "resolve_column", "resolve_columns", "second_token", "source_key", "trim_ws",
]

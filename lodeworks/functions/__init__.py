from lodeworks.functions.columns import (
    cast_columns,
    changed_expr,
    current,
    edition_order_key,
    load_date_of,
    null_sentinels,
    percent_text,
    rename_columns,
    require_columns,
    trim_columns,
)

__all__ = [
    "cast_columns",
    "changed_expr",
    "current",
    "edition_order_key",
    "load_date_of",
    "null_sentinels",
    "percent_text",
    "rename_columns",
    "require_columns",
    "trim_columns",
]

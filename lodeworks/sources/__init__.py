from lodeworks.sources.tables import (
    append_rows,
    ingest_csv,
    read_table_or_empty,
    stage,
    staging_root,
    write_table,
)

__all__ = [
    "append_rows",
    "ingest_csv",
    "read_table_or_empty",
    "stage",
    "staging_root",
    "write_table",
]

"""Sources and sinks of the raw layer."""

from mktlens.sources.raw import (
    RawTables,
    file_set_diff,
    find_source,
    find_tables,
    list_files,
    list_tables,
    load_raw,
    read_csv,
    read_table,
    require_file_set,
    scan_table,
    file_inventory,
    table_inventory,
    write_csv,
)
from mktlens.sources.schemas import KEY_FIELDS, RAW_SCHEMAS, RAW_TABLES, RELATIONSHIPS
from mktlens.sources.sinks import (
    create_view,
    ensure_layer,
    materialize,
    register,
    scratch_path,
    shared_dir,
    write_profile,
    write_report,
)

__all__ = [
    "create_view",
    "find_tables",
    "list_tables",
    "require_file_set",
    "write_report",
    "KEY_FIELDS",
    "RAW_SCHEMAS",
    "RAW_TABLES",
    "RELATIONSHIPS",
    "RawTables",
    "ensure_layer",
    "file_set_diff",
    "find_source",
    "list_files",
    "load_raw",
    "materialize",
    "read_csv",
    "read_table",
    "register",
    "scan_table",
    "scratch_path",
    "shared_dir",
    "file_inventory",
    "table_inventory",
    "write_csv",
    "write_profile",
]

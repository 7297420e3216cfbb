"""Readers and writers: CSV, JDBC, parquet tables and the long-form results store."""

from .files import (
    count_on_read,
    has_rows,
    read_csv_raw,
    read_table,
    table_counts,
    table_has_rows,
    write_csv,
    write_table,
)
from .jdbc import jdbc_options, read_jdbc, write_jdbc
from .versions import append_rows, read_version, replace_table
from .results import RESULTS_COLUMNS, category_max, load_results, long_rows, save_results, to_long

__all__ = [
    "count_on_read", "has_rows", "read_csv_raw", "read_table", "table_counts", "table_has_rows", "write_csv",
    "write_table", "jdbc_options", "read_jdbc", "write_jdbc", "RESULTS_COLUMNS", "category_max",
    "append_rows", "read_version", "replace_table", "load_results", "long_rows", "save_results", "to_long",
]

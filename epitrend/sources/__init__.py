"""Sources and sinks: driver tables, derived fixtures, report CSVs, Parquet."""

from epitrend.sources.csv_reports import discover_headers, scan_reports, write_report_csvs
from epitrend.sources.fixtures import alias_table, raw_report_files, report_rows, reports
from epitrend.sources.parquet import read_clean, register_view, write_clean
from epitrend.sources.tables import read_table

__all__ = [
    "alias_table",
    "discover_headers",
    "raw_report_files",
    "read_clean",
    "read_table",
    "register_view",
    "report_rows",
    "reports",
    "scan_reports",
    "write_clean",
    "write_report_csvs",
]

"""Sources and sinks."""

from panelkit.sources.census import CENSUS_SCHEMA, census_csv, census_whitespace
from panelkit.sources.readers import (
    HISTORY_COLUMNS, HISTORY_SCHEMA, RATE_COLUMNS, RATE_SCHEMA, REGISTER_COLUMNS, REGISTER_SCHEMA,
    parse_whitespace, read_csv, scan_header_only, scan_parquet, scan_rates, scan_register,
    scan_register_hist, scan_whitespace, scan_years, text_schema,
)
from panelkit.sources.sinks import as_view, delimited_lines, preview, row_count, write_delimited, write_parquet

__all__ = [n for n in dir() if not n.startswith("_")]

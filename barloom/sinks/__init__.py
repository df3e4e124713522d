from barloom.sinks.tables import (
    append_bars, compact_stored, delete_range, delete_stored, export_tickers, insert_all, insert_new, missing_findings,
    status_findings, validate_row_count, write_findings, write_raw, write_universe,
)

__all__ = [
    "append_bars", "compact_stored", "delete_range", "delete_stored", "export_tickers", "insert_all", "insert_new",
    "missing_findings", "status_findings", "validate_row_count", "write_findings", "write_raw", "write_universe",
]

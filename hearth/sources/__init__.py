"""Readers and writers (survey items A1-A7)."""

from hearth.sources.csv import read_csv, NA_TOKEN
from hearth.sources.tables import table, TABLES
from hearth.sources.sinks import (write_predictions, write_report,
                                  write_submission, run_report, write_bucketed)

__all__ = ["read_csv", "NA_TOKEN", "table", "TABLES", "write_predictions",
           "write_report", "write_submission", "run_report", "write_bucketed"]

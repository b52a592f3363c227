"""Sources, sinks and catalog helpers."""

from .tables import (conform, read_csv, read_table, schema_report, use_namespace,
                     verify_persisted, write_splits, write_table)

__all__ = ["conform", "read_csv", "read_table", "schema_report", "use_namespace",
           "verify_persisted", "write_splits", "write_table"]

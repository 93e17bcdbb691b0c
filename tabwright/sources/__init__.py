"""Readers, writers and the step runner."""

from tabwright.sources.durable import discard, materialise, pin_small, scratch_folder
from tabwright.sources.files import export_csv, read_csv, read_jdbc, read_parquet_table, write_jdbc
from tabwright.sources.results import read_best, read_metrics, write_best, write_metrics
from tabwright.sources.schema import PATIENT_COLUMNS, PATIENT_SCHEMA
from tabwright.sources.tables import FolderTables, Tables, run_step

__all__ = [
    "FolderTables", "PATIENT_COLUMNS", "PATIENT_SCHEMA", "Tables", "discard", "export_csv", "materialise", "pin_small",
    "read_best", "read_csv", "read_jdbc", "read_metrics", "read_parquet_table", "run_step", "scratch_folder",
    "write_best", "write_jdbc", "write_metrics",
]

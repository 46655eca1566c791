"""Inputs, stage tables and published tables."""

from starlane.sources.contracts import TableContract, conform_to
from starlane.sources.readers import InputError, Landed, input_files, land_csv, read_csv, read_many, read_parquet, unparsed_cells
from starlane.sources.scratch import scratch_folder
from starlane.sources.sinks import (
    LayoutError, create_table, publish, publish_all, publish_jdbc, read_published, write_bucketed, write_observed,
    write_stage,
)

__all__ = [
    "InputError",
    "Landed",
    "LayoutError",
    "TableContract",
    "conform_to",
    "create_table",
    "input_files",
    "land_csv",
    "publish",
    "publish_all",
    "publish_jdbc",
    "read_csv",
    "read_many",
    "read_parquet",
    "read_published",
    "scratch_folder",
    "unparsed_cells",
    "write_bucketed",
    "write_observed",
    "write_stage",
]

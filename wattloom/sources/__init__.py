"""Reading and writing tables, series files and published outputs."""

from wattloom.sources.publish import OUTPUTS, Output, file_sink, publish
from wattloom.sources.series import read_series_csv, series_from_lines, write_series_csv
from wattloom.sources.tables import RangePartition, read_table, write_table

__all__ = [
    "OUTPUTS",
    "Output",
    "RangePartition",
    "file_sink",
    "publish",
    "read_series_csv",
    "read_table",
    "series_from_lines",
    "write_series_csv",
    "write_table",
]

"""Sources: CSV files of the data dictionary and views over the driver tables."""

from .csv import read_csv_checked, read_csv_raw, read_csv_typed, read_tables_csv, write_csv
from .views import Tables, load_tables, register_views

__all__ = ["read_csv_checked", "read_csv_raw", "read_csv_typed", "read_tables_csv", "write_csv", "Tables",
           "load_tables", "register_views"]

"""Reading tables in, and writing tables and models out."""

from parityscope.sources.csv import read_csv, write_predictions_csv
from parityscope.sources.models import load_model, save_model
from parityscope.sources.tables import first_rows, read_parquet, write_parquet

__all__ = [
    "first_rows",
    "load_model",
    "read_csv",
    "read_parquet",
    "save_model",
    "write_parquet",
    "write_predictions_csv",
]

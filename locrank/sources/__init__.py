from locrank.sources.catalog import Catalog, Dataset
from locrank.sources.quarantine import BadRowsRule, MalformedRowsError, checked_csv
from locrank.sources.readers import read_csv, read_parquet, read_published, read_task_specs

__all__ = [
    "BadRowsRule",
    "Catalog",
    "Dataset",
    "MalformedRowsError",
    "checked_csv",
    "read_csv",
    "read_parquet",
    "read_published",
    "read_task_specs",
]

from locrank.sinks.files import replace_csv, replace_parquet
from locrank.sinks.jdbc import load_table, rows_to_load
from locrank.sinks.publish import (
    OutputCheckError,
    OutputRules,
    PublishResult,
    prune_versions,
    publish,
    published_path,
    remove_unfinished,
)
from locrank.storage import scratch_dir, shared_root

__all__ = [
    "OutputCheckError",
    "OutputRules",
    "PublishResult",
    "load_table",
    "prune_versions",
    "publish",
    "published_path",
    "remove_unfinished",
    "replace_csv",
    "replace_parquet",
    "rows_to_load",
    "scratch_dir",
    "shared_root",
]

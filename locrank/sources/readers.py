"""Scans with a declared schema."""

from locrank.schemas import TASK_SPEC
from locrank.sinks.publish import published_path
from locrank.sources.catalog import read_csv


def read_parquet(spark, path, schema=None):
    """A Parquet folder; with a schema an empty folder is an empty frame, not an error."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_published(spark, dataset):
    """The newest complete version of a dataset written by publish()."""
    path = published_path(spark, dataset)
    if path is None:
        raise FileNotFoundError(f"dataset {dataset.name} has no published version")
    return dataset.read(spark, path)


def read_task_specs(spark, path):
    """Task specifications as JSON, one task per line: its name, its inputs and its outputs."""
    return spark.read.schema(TASK_SPEC).json(path)


__all__ = ["read_csv", "read_parquet", "read_published", "read_task_specs"]

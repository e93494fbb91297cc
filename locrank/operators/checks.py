"""Output check: one row of counts about a table."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F


def _flagged(condition):
    return F.sum(F.when(condition, 1).otherwise(0))


def outside(name, low, high):
    """Values of a column that are not within (low, high); a null is not outside."""
    return _flagged(~F.coalesce(F.col(name).between(low, high), F.lit(True)))


def check_output(df, keys, ranges=None):
    """Rows, distinct and repeated keys, null keys, nulls per column, values outside their range.

    `ranges` maps a column to (low, high), both allowed. Two levels: first per key, combined in
    the map tasks, then over the keys; the only shuffle carries one row per key and map task.
    """
    ranges = ranges or {}
    others = [name for name in df.columns if name not in keys]

    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_flagged(F.col(name).isNull()).alias(f"null_{name}") for name in others],
        *[outside(name, *ranges[name]).alias(f"outside_{name}") for name in ranges],
    )
    null_key = reduce(or_, [F.col(name).isNull() for name in keys])
    counts = [f"null_{name}" for name in others] + [f"outside_{name}" for name in ranges]
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.coalesce(_flagged(F.col("_rows") > 1), F.lit(0)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("_rows"))), F.lit(0)).alias("null_key_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
    )

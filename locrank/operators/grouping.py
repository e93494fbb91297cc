"""Sums per key and one row per key.

Each of these reduces its input inside the map tasks before anything is shuffled, so a key that
holds a third of all rows sends one row per map task and key, not its rows.
"""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

LOWEST = -(2**63)


def sum_by(df, keys, measures, scale=None):
    """Sum the measures per key; the columns come out in the order given.

    With `scale`, for doubles of that many decimal places such as money, whole units of the last
    place are added: the total then does not depend on the order in which partitions are added,
    and has 28 digits, so that the sum of a hot key does not overflow.
    """

    def total(name):
        if scale is None:
            return F.sum(name).alias(name)
        units = F.rint(F.col(name) * 10**scale).cast("long").cast("decimal(18,0)")
        # Divided as decimals and rounded once, when the total becomes a double.
        return (F.sum(units) * F.lit(Decimal(1).scaleb(-scale))).cast("double").alias(name)

    return df.groupBy(*keys).agg(*[total(name) for name in measures])


def latest_per_key(df, key, order, values):
    """The row with the latest `order` (a date or timestamp) per key; a null counts as earliest.

    `order` must be unique per key, as it is after a sum by (key, order). Ranking by a long keeps
    every buffer fixed-width, so this is a hash aggregate with map-side combine and no sort.
    """
    rank = F.coalesce(F.unix_micros(F.col(order).cast("timestamp")), F.lit(LOWEST))
    return df.groupBy(key).agg(
        F.max(order).alias(order), *[F.max_by(name, rank).alias(name) for name in values]
    )


def one_row_per_key(df, keys, order_by):
    """The first row per key in the order given; make that a total order for a repeatable result.

    The filter on row_number is pushed below the shuffle as a group limit of one row.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def any_row_per_key(df, keys):
    """Some row per key: cheapest when the columns used afterwards are the same in all of them."""
    return df.dropDuplicates(list(keys))

"""Joins on a key between many rows and one row per key.

No join carries a broadcast hint for a side that grows with the data. Whether a side is small
enough is left to the session's broadcast limit, which Spark checks against file sizes when it
plans and against measured shuffle sizes while it runs; beyond the limit the join is a shuffle
join. Adaptive execution splits its hot partitions where both sides come straight from a shuffle;
salted_join is for the others.
"""

from pyspark.sql import functions as F

from locrank.storage import keep


def join_on_key(many, one, key):
    """Inner join on equal key, key kept once. Keys on one side only, and null keys, are dropped."""
    return many.join(one, key, "inner")


def rows_with_match(one, many, key):
    """The rows of `one` whose key occurs in `many`.

    The keys of `many` are made distinct first: that combines in the map tasks, so the rows of a
    hot key never meet in one task, and the semi-join sees each key once.
    """
    return one.join(many.select(key).distinct(), key, "left_semi")


def lost_keys(many, one, key):
    """Keys of `many` that an inner join with `one` drops, with the rows each of them takes along."""
    return rows_per_key(many, key).join(one.select(key), key, "left_anti")


def hot_keys(counted, key, rows_per_salt):
    """From the rows per key (key, rows): keys with more than rows_per_salt rows, and their salts.

    There are fewer than rows / rows_per_salt such keys, each with as many salts as it needs.
    """
    salts = F.ceil(F.col("rows") / F.lit(rows_per_salt)).cast("int")
    return counted.where(F.col(key).isNotNull() & (F.col("rows") > rows_per_salt)).select(
        key, F.col("rows").alias("_rows"), salts.alias("_salts")
    )


def rows_per_key(df, key):
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def spread_hash(*columns):
    return F.xxhash64(*columns)


def salted_join(many, one, key, spread, hot, how="inner", hint=None, keep_hot=True):
    """The rows of a join on `key`, with the rows of each hot key spread over several tasks.

    `hot` comes from hot_keys. For joins whose skew adaptive execution does not split: it looks at
    bytes, not at the pairs a key has, and splits only where both sides come straight from a shuffle
    of the join, not where one side was aggregated by the key before. The salt is taken from
    `spread`, a whole number of the row of `many` such as spread_hash of its other columns, so a
    task that runs again after a lost executor places its rows as before; `spread` may use the
    rows of the key as `_rows`. Rows of `one` are repeated for hot keys only, so `how` may also be
    left, left_semi or left_anti. The result keeps the salt as `_salt`.

    The hot keys are written once and read by both sides, so their salts agree whatever `hot` is
    computed from; Spark broadcasts them if they are as small as it measures. keep_hot=False is for a
    table that was written already.
    """
    hot = keep(hot, "hot-keys") if keep_hot else hot
    salts = F.coalesce("_salts", F.lit(1))
    salt = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("_salts")))
    left = many.join(hot, key, "left").withColumn("_salt", salt.cast("int"))
    right = one.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    left, right = left.drop("_rows", "_salts"), right.drop("_rows", "_salts")
    return left.join(right.hint(hint) if hint else right, [key, "_salt"], how)

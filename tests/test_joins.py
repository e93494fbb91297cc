import pytest
from pyspark.sql import functions as F

from locrank.operators import (
    hot_keys,
    join_on_key,
    lost_keys,
    rows_per_key,
    rows_with_match,
    salted_join,
    spread_hash,
)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on key 0, some null keys, some keys without a match."""
    many = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 400)
        .alias("k"),
        F.col("id").alias("v"),
    )
    one = spark.range(300).select(
        F.when(F.col("id") == 299, None).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 2).alias("w"),
    )
    return many, one


def salted(many, one, rows_per_salt, how="inner"):
    hot = hot_keys(rows_per_key(many, "k"), "k", rows_per_salt)
    return salted_join(many, one, "k", spread_hash("v"), hot, how).drop("_salt")


def by_hand(many, one):
    lookup = {r.k: r.w for r in one.collect() if r.k is not None}
    found = [(r.k, r.v, lookup[r.k]) for r in many.collect() if r.k in lookup]
    return sorted(found, key=repr)


def test_join_drops_unmatched_and_null_keys(skewed):
    many, one = skewed
    joined = join_on_key(many, one, "k")
    assert joined.columns == ["k", "v", "w"]
    assert rows(joined) == by_hand(many, one)


@pytest.mark.parametrize("rows_per_salt", [1, 20, 10**6])
def test_salted_join_has_the_same_rows(skewed, rows_per_salt):
    many, one = skewed
    joined = salted(many, one, rows_per_salt)
    assert joined.columns == ["k", "v", "w"]
    assert rows(joined) == by_hand(many, one)


def test_salted_join_with_several_rows_on_both_sides(spark, skewed):
    many, one = skewed
    twice = one.unionAll(one.withColumn("w", -F.col("w")))
    plain = join_on_key(many, twice, "k")
    assert rows(salted(many, twice, 20)) == rows(plain)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salted_join_of_other_kinds(skewed, how):
    many, one = skewed
    assert rows(salted(many, one, 20, how)) == rows(many.join(one, "k", how))


def test_hot_keys_are_all_keys_above_the_limit(spark, skewed):
    many, _ = skewed
    hot = {r.k: r._salts for r in hot_keys(rows_per_key(many, "k"), "k", 100).collect()}
    assert hot[0] == 31 and None not in hot
    counted = spark.range(3000).selectExpr("id as k", "id * 100 + 11 as rows")
    salts = {r.k: r._salts for r in hot_keys(counted, "k", 10).collect()}
    assert len(salts) == 3000 and salts[2999] == 29992


def test_salting_spreads_the_hot_key(spark, skewed, settings):
    many, one = skewed
    settings("spark.sql.adaptive.enabled", "false")
    settings("spark.sql.shuffle.partitions", "16")

    def largest_share(frame):
        sizes = frame.groupBy(F.spark_partition_id()).count().collect()
        return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)

    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert largest_share(join_on_key(many, one, "k").select("v")) > 0.3
    assert largest_share(salted(many, one, 100).select("v")) < 0.2


def test_adaptive_execution_splits_the_hot_key(spark, skewed, settings):
    many, one = skewed
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    joined = join_on_key(many.repartition(16), one, "k")
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_semi_join_reduces_the_many_side_before_the_shuffle(skewed, settings):
    many, one = skewed
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept = rows_with_match(one, many, "k")
    keys = {r.k for r in many.collect()} - {None}
    assert rows(kept) == sorted(((k, 2 * k) for k in keys if k < 299), key=repr)
    many_side = kept._jdf.queryExecution().executedPlan().toString().split("LeftSemi")[1]
    assert many_side.count("HashAggregate") == 2


def test_lost_keys_counts_rows(skewed):
    many, one = skewed
    lost = {r.k: r.rows for r in lost_keys(many, one, "k").collect()}
    have = {r.k for r in one.collect()} - {None}
    expected = {}
    for r in many.collect():
        if r.k not in have:
            expected[r.k] = expected.get(r.k, 0) + 1
    assert lost == expected and None in lost

"""What the plans of the queries must and must not contain, with broadcasts by size turned off."""

import re

import pytest

from locrank.plans.queries import QUERIES
from locrank.session import sized_for

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")

    def of(name):
        frame = QUERIES[name](spark, SF_DIR)
        return re.sub(r"#\d+L?", "", frame._jdf.queryExecution().executedPlan().toString())

    return of


def shuffles(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)


# The cycle checks run their plans inside and return one row.
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if "acyclic" not in n))
def test_no_pairing_without_a_key_and_no_python(plan, name):
    text = plan(name)
    for word in ("CartesianProduct", "NestedLoop", "Python", "InPandas", "Scan ExistingRDD"):
        assert word not in text


def test_flagship_reads_two_narrow_scans(plan):
    text = plan("top_recovery_locations")
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert schemas == ["struct<o_custkey:bigint>", "struct<user_id:bigint,event_type:string>"]
    assert "TakeOrderedAndProject(limit=40" in text and "Window" not in text
    assert text.count("PushedFilters: [IsNotNull(") == 2


def test_one_row_per_location_shuffles_thrice(plan):
    text = plan("one_row_per_location")
    assert sorted(shuffles(text)) == ["location", "location", "location, date"]
    assert "SortAggregate" not in text


def test_clean_observations_do_not_shuffle(plan):
    assert "Exchange" not in plan("observations_clean")


def test_output_check_shuffles_by_key_once(plan):
    assert shuffles(plan("output_check_daily")) == ["location, date"]


def test_group_limit_before_the_shuffle(plan):
    text = plan("largest_order_per_location")
    assert text.index("Exchange") < text.index("row_number(), 1, Partial")


def test_edges_merge_sorted_shuffles(plan):
    text = plan("lineage_edges")
    assert "SortMergeJoin" in text
    assert sorted(shuffles(text)) == ["dataset", "dataset", "dataset, src", "src, dst"]


def test_broadcast_by_size_is_sparks_choice(spark):
    frame = QUERIES["observations_with_rates"](spark, SF_DIR)
    frame.collect()
    assert "BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()


def test_sized_for():
    def partitions(*arguments):
        return int(sized_for(*arguments)["spark.sql.shuffle.partitions"])

    assert (partitions(10**9), partitions(10**12), partitions(10**14)) == (200, 1863, 186_265)
    assert partitions(10**14, 50_000) == 50_000

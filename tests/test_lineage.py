import re

import pytest

from locrank.operators import (
    consumers_of,
    contract_violations,
    derive_edges,
    fan_in,
    lines_by,
    outputs_of,
    producers_of,
)
from locrank.schemas import TASK_SPEC

SPEC = [
    ("task_1", ["large"], [("clean", "data/clean")]),
    ("task_2", ["clean", "snapshot"], [("joined", "data/joined")]),
    ("task_3", ["data/joined"], [("best", "data/best")]),
    ("task_4", ["best", "data/best", "clean", "best"], [("loaded", "data/loaded")]),
]


def edges_of(spark, spec, **options):
    tasks = spark.createDataFrame(spec, TASK_SPEC)
    edges = derive_edges(producers_of(outputs_of(tasks)), consumers_of(tasks), **options)
    return sorted(map(tuple, edges.collect()))


@pytest.mark.parametrize("options", [{}, {"rows_per_salt": 1}])
def test_edges_by_name_and_path_without_duplicates(spark, options):
    assert edges_of(spark, SPEC, **options) == [
        ("task_1", "task_2"),
        ("task_1", "task_4"),
        ("task_2", "task_3"),
        ("task_3", "task_4"),
    ]


def test_two_producers_give_two_edges_and_own_output_a_self_edge(spark):
    spec = [
        ("a", None, [("x", "p/x")]),
        ("b", [], [("x", "p/x2")]),
        ("c", ["x", "y"], [("y", "p/y")]),
        ("d", ["x "], None),
    ]
    assert edges_of(spark, spec) == [("a", "c"), ("b", "c"), ("c", "c")]


def test_fan_in_lines(spark):
    edges = spark.createDataFrame([("b", "c"), ("a", "c"), ("c", "d")], "src string, dst string")
    lines = {r.dst: (r.part, r.upstreams, r.line) for r in fan_in(edges).collect()}
    assert lines == {"c": (0, 2, "[a, b] >> c"), "d": (0, 1, "c >> d")}


def test_repeated_edges_and_null_sources_give_no_upstreams(spark):
    edges = spark.createDataFrame([("a", "c"), ("a", "c"), ("b", "c"), (None, "d")], "src string, dst string")
    assert [tuple(r) for r in fan_in(edges).collect()] == [("c", 0, 2, "[a, b] >> c")]


def test_a_line_has_the_same_form_at_any_size(spark):
    edges = [(str(n), "wide") for n in range(30_000)] + [("1", "small")]
    lines = {r.dst: r for r in fan_in(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert len(lines) == 2 and lines["wide"].upstreams == 30_000
    names = re.findall(r"\d+", lines["wide"].line.split(" >> ")[0])
    assert names == sorted(str(n) for n in range(30_000))


def test_parts_hold_for_every_task_and_are_whole(spark):
    edges = [(str(n), "wide") for n in range(1000)] + [(str(n), "small") for n in range(100)]
    lines = fan_in(spark.createDataFrame(edges, "src string, dst string"), parts=10).collect()
    for task, size in (("wide", 1000), ("small", 100)):
        own = [r for r in lines if r.dst == task]
        assert {r.part for r in own} == set(range(10))
        names = [n for r in own for n in re.findall(r"\d+", r.line.split(" >> ")[0])]
        assert sorted(names) == sorted(str(n) for n in range(size))


def test_lines_take_one_shuffle(spark):
    edges = spark.range(100).selectExpr("cast(id as string) as src", "concat('w', id % 7) as dst")
    plan = fan_in(edges, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_contract(spark):
    tasks = spark.createDataFrame(
        [(t,) for t in ("none", "one", "two", "no path", "two places", "one and a bare one")], "task string"
    )
    outputs = spark.createDataFrame(
        [
            ("one", "x", "p/x"),
            ("one", "x", "p/x"),
            ("two", "y", "p/y"),
            ("two", "z", "p/z"),
            ("no path", "w", None),
            ("two places", "a", "p/1"),
            ("two places", "a", "p/2"),
            ("one and a bare one", "a", "p/1"),
            ("one and a bare one", "b", None),
        ],
        "task string, name string, path string",
    )
    found = sorted(map(tuple, contract_violations(tasks, outputs).collect()))
    assert found == [
        ("no path", 0, 1),
        ("none", 0, 0),
        ("one and a bare one", 1, 1),
        ("two", 2, 0),
        ("two places", 2, 0),
    ]


def test_names_are_sorted_by_a_hash_and_stay_apart(spark):
    """Datasets that begin alike and tasks that are numbers have the edges and lines of any other."""
    producers = spark.range(200).selectExpr("id as task", "concat('data/set/', id) as dataset")
    consumers = spark.range(200).selectExpr("id + 1000 as task", "concat('data/set/', id % 50) as dataset")
    edges = derive_edges(producers, consumers)
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("hex(xxhash64(dataset") == 2
    assert sorted(map(tuple, edges.collect())) == sorted((n % 50, n + 1000) for n in range(200))
    assert {r.line for r in fan_in(edges).collect()} == {f"{n % 50} >> {n + 1000}" for n in range(200)}
    assert "md5" not in fan_in(edges)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("kind", ["string", "long"])
def test_edges_are_dealt_out_once_for_the_lines(spark, settings, parts, kind):
    """One shuffle of bare edges, after a table of pairs; the lines are those of any other edges."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")

    def tasks(ids):
        return ids.selectExpr(f"cast(task as {kind}) as task", "concat('data/', dataset) as dataset")

    producers = tasks(spark.range(400).selectExpr("id % 300 as task", "id % 100 as dataset"))
    consumers = tasks(spark.range(3000).selectExpr("if(id % 3 = 0, 1000, 1000 + id % 700) as task", "id % 130 as dataset"))
    plain = fan_in(derive_edges(producers, consumers), parts)
    edges = derive_edges(producers, consumers, by=lines_by(parts))
    lines = fan_in(edges, parts)
    assert edges.count() == edges.distinct().count() == derive_edges(producers, consumers).count()
    assert lines.schema == plain.schema
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, plain.collect()))
    plan = fan_in(edges, parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    # What is shuffled has no array yet.
    assert plan.rindex("ObjectHashAggregate") < plan.index("Exchange")


def test_queries_of_lines_join_before_the_edges_are_dealt_out(spark, settings):
    from locrank.plans.queries import lineage_fan_in, lineage_fan_in_parts

    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    for query in (lineage_fan_in, lineage_fan_in_parts):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan

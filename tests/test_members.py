import random

import pytest
from pyspark.sql import functions as F

from locrank.operators import cycle_members, members
from locrank.operators.members import numbered
from locrank.plans.dependencies import CyclicFlowError, dependency_lines
from locrank.schemas import TASK_SPEC


def graph(spark, edges, kind="long"):
    return spark.createDataFrame(edges, f"src {kind}, dst {kind}")


def by_hand(edges):
    after = {}
    for src, dst in edges:
        after.setdefault(src, set()).add(dst)

    def reached(start):
        seen, stack = set(), [start]
        while stack:
            for nxt in after.get(stack.pop(), ()):
                if nxt not in seen:
                    seen.add(nxt)
                    stack.append(nxt)
        return seen

    reach = {v: reached(v) for v in after}
    on = {v for v, r in reach.items() if v in r}
    of = {v: sorted(w for w in on if w in reach[v] and v in reach[w]) for v in on}
    return {(v, of[v][0], len(of[v])) for v in on}


def found(spark, edges, kind="long"):
    rows = [tuple(r) for r in cycle_members(graph(spark, edges, kind)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_random_graphs(spark):
    draw = random.Random(21)
    for count in (12, 30, 45):
        edges = [(draw.randrange(30), draw.randrange(30)) for _ in range(count)]
        assert found(spark, edges) == by_hand(edges)


def test_cycles_with_paths_between_them(spark):
    ring = [("a", "b"), ("b", "c"), ("c", "a")]
    path = [("c", "p"), ("p", "q"), ("q", "x"), ("in", "a"), ("y", "out")]
    edges = [*ring, *path, ("x", "y"), ("y", "x"), ("s", "s"), ("q", "s"), ("a", "b"), (None, "a"), ("b", None)]
    expected = {("a", "a", 3), ("b", "a", 3), ("c", "a", 3), ("x", "x", 2), ("y", "x", 2), ("s", "s", 1)}
    assert found(spark, edges, "string") == expected


def test_no_cycle_and_no_edges(spark):
    assert found(spark, []) == set()
    assert found(spark, [(n, n + 1) for n in range(6)]) == set()


def test_a_long_ring_takes_few_rounds(spark, monkeypatch):
    kept = []
    keep = members._Rounds.keep
    monkeypatch.setattr(members._Rounds, "keep", lambda self, frame: kept.append(1) or keep(self, frame))
    assert found(spark, [(n, (n + 1) % 120) for n in range(120)]) == {(n, 0, 120) for n in range(120)}
    assert len(kept) < 60


def test_numbers_are_dense_and_in_order(spark, settings):
    settings("spark.sql.shuffle.partitions", "5")
    frame = spark.createDataFrame([(f"n{k:03}",) for k in range(100)], "name string").repartition(7)
    assert {r.name: r.id for r in numbered(frame).collect()} == {f"n{k:03}": k for k in range(100)}


def test_the_error_names_the_tasks_of_the_cycle(spark):
    tasks = [("a", ["z"], [("x", "p/x")]), ("b", ["x"], [("y", "p/y")]), ("c", ["p/y"], [("z", "p/z")]), ("d", ["z"], [("w", "p/w")])]
    with pytest.raises(CyclicFlowError, match="3 tasks depend on their own output: a, b, c") as raised:
        dependency_lines(spark.createDataFrame(tasks, TASK_SPEC))
    assert {tuple(r) for r in raised.value.members.collect()} == {(t, "a", 3) for t in "abc"}


def test_vertices_of_one_hash_are_numbered(spark, monkeypatch):
    used = []
    monkeypatch.setattr(members, "_hashed", lambda name: F.pmod(F.xxhash64(name), F.lit(3)))
    monkeypatch.setattr(members, "numbered", lambda names: used.append(1) or numbered(names))
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "x"), ("x", "y"), ("s", "s")]
    assert found(spark, edges, "string") == by_hand(edges) and used
    used.clear()
    monkeypatch.undo()
    monkeypatch.setattr(members, "numbered", lambda names: used.append(1) or numbered(names))
    assert found(spark, edges, "string") == by_hand(edges) and not used

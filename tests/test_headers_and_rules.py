"""Columns by header name, versions by number, rules before a commit, scratch folders."""

import importlib
from pathlib import Path

import pytest

from locrank.operators import is_acyclic
from locrank.sinks import OutputCheckError, OutputRules, publish, remove_unfinished, shared_root
from locrank.sources import Dataset, read_csv, read_published

SCHEMA = "location string, date date, new_cases double"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_columns_are_found_by_name(spark, tmp_path):
    write(tmp_path / "a", "x.csv", "iso_code,new_cases,continent,location,date", "IT,4.5,Europe,Italy,2020-03-01")
    frame = read_csv(spark, str(tmp_path / "a"), schema(spark))
    assert [tuple(map(str, r)) for r in frame.collect()] == [("Italy", "2020-03-01", "4.5")]
    plan = frame.select("new_cases")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<new_cases:double>" in plan


def test_a_missing_column_is_an_error(spark, tmp_path):
    write(tmp_path / "a", "x.csv", "location,date", "Italy,2020-03-01")
    with pytest.raises(ValueError, match="new_cases"):
        read_csv(spark, str(tmp_path / "a"), schema(spark))


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    write(tmp_path / "a", "x.csv", "location,date,new_cases", "Italy,2020-03-01,1")
    write(tmp_path / "a", "y.csv", "date,location,new_cases", "2020-03-01,Peru,1")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "a"), schema(spark)).collect()


def test_the_last_publish_is_read_whatever_the_clock(spark, tmp_path, monkeypatch):
    dataset = Dataset("d", str(tmp_path / "d"))
    publish(spark.range(3), dataset)
    monkeypatch.setattr("time.time", lambda: 0.0)
    monkeypatch.setattr("time.time_ns", lambda: 0)
    assert publish(spark.range(9), dataset).row_count == 9
    assert read_published(spark, dataset).count() == 9


def test_a_number_is_claimed_once(spark, tmp_path):
    from locrank.sinks.publish import _claim, _commits

    path = str(tmp_path / "d")
    numbers = [_claim(spark, path, f"run{n}", n) for n in range(3)]
    (tmp_path / "d" / "commits" / f"{4:020d}").write_text("")  # claimed, not yet written
    assert numbers == [1, 2, 3] and _claim(spark, path, "late", 9) == 5
    assert _commits(spark, path).first().run == "late"


def test_broken_rules_leave_the_last_version(spark, tmp_path):
    dataset, rules = Dataset("d", str(tmp_path / "d")), OutputRules(("id",), {"id": (0, 100)})
    publish(spark.range(3), dataset, rules=rules)
    for bad, name in (
        (spark.range(0), "row_count"),
        (spark.range(3).unionAll(spark.range(1)), "repeated_keys"),
        (spark.range(200), "outside_id"),
    ):
        with pytest.raises(OutputCheckError, match=name):
            publish(bad, dataset, rules=rules)
    assert read_published(spark, dataset).count() == 3
    assert len(list((tmp_path / "d" / "versions").iterdir())) == 1


def test_folders_of_failed_runs_are_removed(spark, tmp_path):
    dataset = Dataset("d", str(tmp_path / "d"))
    publish(spark.range(3), dataset)
    spark.range(5).write.parquet(str(tmp_path / "d" / "versions" / "failed"))
    assert remove_unfinished(spark, dataset, 3600) == 0
    assert remove_unfinished(spark, dataset, -60) == 1
    assert read_published(spark, dataset).count() == 3


def test_a_cycle_check_leaves_no_files(spark):
    edges = spark.range(50).selectExpr("id as src", "id + 1 as dst")
    assert is_acyclic(edges)
    assert not is_acyclic(edges.unionAll(spark.range(1).selectExpr("50L as src", "id as dst")))
    assert list(Path(shared_root(spark)).glob("locrank/cycles-*")) == []


class _Session:
    """What shared_root asks of a session."""

    def __init__(self, spark, master, warehouse):
        self._jvm, self._jsc = spark._jvm, spark._jsc
        values = {"spark.sql.warehouse.dir": warehouse}
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, other=None: values.get(name, other))})
        context = {"master": master, "getCheckpointDir": staticmethod(lambda: None)}
        self.sparkContext = type("Context", (), context)


@pytest.mark.parametrize("master, allowed", [("local", True), ("local[4]", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_a_local_warehouse_serves_local_sessions_only(spark, master, allowed):
    session = _Session(spark, master, "file:/tmp/warehouse")
    if allowed:
        assert shared_root(session) == "file:/tmp/warehouse/_scratch"
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(session)


def test_rules_read_the_keys_alone(spark, tmp_path, monkeypatch):
    module = importlib.import_module("locrank.sinks.publish")

    plans, check = [], module.check_output

    def seen(frame, keys):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return check(frame, keys)

    monkeypatch.setattr(module, "check_output", seen)
    rows = spark.range(5).selectExpr("id", "id * 1.5 as value", "'x' as note")
    dataset = Dataset("d", str(tmp_path / "d"))
    publish(rows, dataset, rules=OutputRules(("id",), {"value": (0, 100)}))
    assert len(plans) == 1 and "ReadSchema: struct<id:bigint>" in plans[0]
    with pytest.raises(OutputCheckError, match="'outside_value': 2"):
        publish(rows, dataset, rules=OutputRules(("id",), {"value": (0, 4)}))


def test_lost_rows_break_the_rules(spark, tmp_path):
    rules = OutputRules(("id",))
    assert rules.broken(spark.range(3), {"rows": 3}) == {}
    assert rules.broken(spark.range(3), {"rows": 5}) == {"lost_rows": 2}

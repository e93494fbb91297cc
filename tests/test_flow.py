"""The flow on a hand-typed part of its real inputs, and properties of its stages."""

import pytest
from pyspark.sql import functions as F

from locrank.plans import flow
from locrank.schemas import DAILY, SNAPSHOT
from locrank.sinks import PublishResult
from locrank.sources import read_published

# Rows of the snapshot (location, confirmed, deaths, recovered).
SNAPSHOT_ROWS = [
    ("Dominica", 18, 0, 18),
    ("Grenada", 23, 0, 23),
    ("Holy See", 12, 0, 12),
    ("Taiwan*", 462, 7, 440),
    ("Djibouti", 5059, 58, 4977),
    ("Saint Kitts and Nevis", 17, 0, 15),
]
EXTRA_ROWS = [("Nowhere", 0, 0, 0), ("Gap", None, None, None)]
RANKING = [("Dominica", 1.0), ("Grenada", 1.0), ("Djibouti", 4977 / 5059), ("Saint Kitts and Nevis", 15 / 17)]


@pytest.fixture
def catalog(tmp_path):
    header = ",".join(field.name for field in SNAPSHOT.fields)
    lines = [header]
    for name, confirmed, deaths, recovered in SNAPSHOT_ROWS + EXTRA_ROWS:
        counts = ["" if v is None else str(v) for v in (confirmed, deaths, recovered)]
        lines.append(",".join([name, *counts, "", "", "", "", "", "", "inf", "", "", "", "Any"]))
    (tmp_path / "snapshot.csv").write_bytes("\r\n".join(lines).encode() + b"\r\n")
    observed = ["location,date,total_cases,new_cases,total_deaths,new_deaths"]
    for name in ["Dominica", "Grenada", "Djibouti", "Taiwan", "Saint Kitts and Nevis", "Nowhere", "Gap"]:
        observed += [f"{name},2020-07-26,1,,2,", f"{name},2020-07-27,3,1,,0", f"{name},2020-07-27,4,,,"]
    (tmp_path / "observations.csv").write_text("\n".join(observed) + "\n")
    return flow.flow_catalog(
        str(tmp_path / "out"), str(tmp_path / "observations.csv"), str(tmp_path / "snapshot.csv")
    )


def run(spark, catalog):
    return [flow.run_daily(spark, catalog), flow.run_joined(spark, catalog), flow.run_ranking(spark, catalog)]


def test_stages_from_files_to_ranking(spark, catalog):
    results = run(spark, catalog)
    assert [r.row_count for r in results] == [14, 6, 6]
    ranking = [tuple(r) for r in read_published(spark, catalog["ranking"]).collect()]
    assert ranking[:4] == RANKING
    assert sorted(ranking[4:]) == [("Gap", 0.0), ("Nowhere", 0.0)]
    joined = {r.location: r for r in read_published(spark, catalog["joined"]).collect()}
    assert set(joined) == {name for name, _ in RANKING} | {"Nowhere", "Gap"}
    latest = joined["Djibouti"]
    assert (str(latest.date), latest.total_cases, latest.new_cases) == ("2020-07-27", 7.0, 1.0)
    assert (latest.Confirmed, latest.mortality_rate) == (5059, 58 / 5059)


def test_running_again_changes_nothing(spark, catalog):
    run(spark, catalog)
    first = {n: sorted(map(tuple, read_published(spark, catalog[n]).collect())) for n in ("daily", "joined", "ranking")}
    run(spark, catalog)
    for name, rows in first.items():
        assert sorted(map(tuple, read_published(spark, catalog[name]).collect())) == rows


def test_stage_is_skipped_without_its_folder(spark, catalog):
    result = flow.run_daily(spark, catalog, on_missing="skip")
    assert result == PublishResult("daily", "skipped: no output folder")
    with pytest.raises(FileNotFoundError):
        flow.run_joined(spark, catalog)


def test_repeated_snapshot_rows_do_not_repeat_locations(spark):
    rows = [("a", 5, 1, 2), ("a", 7, 1, 2), ("a", 7, 1, 2), ("b", 1, 0, 0)]
    frame = spark.createDataFrame(rows, "location string, Confirmed long, Deaths long, Recovered long")
    unique = flow.unique_snapshot(flow.snapshot_rates(frame))
    assert sorted((r.location, r.Confirmed) for r in unique.collect()) == [("a", 7), ("b", 1)]


def test_ranking_by_match_equals_the_full_path(spark):
    observations = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 90)).alias("location"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("date"),
        *[F.lit(1.0).alias(name) for name in DAILY.names[2:]],
    )
    snapshot = spark.range(120).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id"))).alias("location"),
        (F.col("id") % 11).alias("Confirmed"),
        F.lit(0).cast("long").alias("Deaths"),
        (F.col("id") % 7 % 11).alias("Recovered"),
    )
    rated = flow.snapshot_rates(snapshot)
    full = flow.ranking(flow.one_row_per_location(flow.daily(observations), rated))
    by_match = flow.ranking_by_match(observations, rated)
    assert [tuple(r) for r in full.collect()] == [tuple(r) for r in by_match.collect()]
    shuffled = flow.ranking(flow.one_row_per_location(flow.daily(observations.repartition(5)), rated))
    assert [tuple(r) for r in shuffled.collect()] == [tuple(r) for r in full.collect()]


def test_null_locations_meet_nothing(spark):
    schema = "location long, date date, total_cases double, new_cases double, total_deaths double, new_deaths double"
    observations = spark.createDataFrame([(None, None, 1.0, 1.0, 1.0, 1.0)], schema)
    rated = flow.snapshot_rates(
        spark.createDataFrame([(0, 3, 1, 2)], "location long, Confirmed long, Deaths long, Recovered long")
    )
    assert flow.one_row_per_location(flow.daily(observations), rated).count() == 0

"""The queries over the star schema: name -> function of (session, folder of the tables)."""

from pyspark.sql import functions as F

from locrank.functions import fill_numeric_nulls
from locrank.operators import (
    any_row_per_key,
    check_output,
    contract_violations,
    cycle_members,
    cycle_tasks,
    derive_edges,
    fan_in,
    hot_keys,
    is_acyclic,
    is_acyclic_lineage,
    lines_by,
    lost_keys,
    nearest_names,
    one_row_per_key,
    producers_of,
    rows_per_key,
    salted_join,
    spread_hash,
)
from locrank.plans import flow, star
from locrank.plans.dependencies import dependency_lines
from locrank.schemas import KEY, OBSERVATIONS, SNAPSHOT
from locrank.sinks import OutputRules, publish, replace_csv, replace_parquet, rows_to_load, scratch_dir
from locrank.sources import BadRowsRule, Dataset, checked_csv, read_csv, read_parquet, read_published, read_task_specs
from locrank.storage import keep


def observations_clean(spark, sf_dir):
    return flow.clean_observations(star.observations(spark, sf_dir))


def observations_daily(spark, sf_dir):
    return flow.daily(star.observations(spark, sf_dir), star.SCALE)


def snapshot_rates(spark, sf_dir):
    return flow.snapshot_rates(star.snapshot(spark, sf_dir))


def observations_with_rates(spark, sf_dir):
    return flow.observations_with_rates(
        observations_daily(spark, sf_dir), snapshot_rates(spark, sf_dir)
    )


def observations_with_rates_salted(spark, sf_dir):
    """The salt count starts at few rows per key here, so small tables have salted keys too."""
    daily = observations_daily(spark, sf_dir)
    hot = hot_keys(rows_per_key(daily, KEY), KEY, rows_per_salt=8)
    joined = salted_join(daily, snapshot_rates(spark, sf_dir), KEY, spread_hash("date"), hot)
    return joined.drop("_salt")


def lost_locations(spark, sf_dir):
    return lost_keys(observations_daily(spark, sf_dir), snapshot_rates(spark, sf_dir), KEY)


def nearest_lost_names(spark, sf_dir):
    """The names that a join loses, with their rows and the nearest name one edit away."""
    known = star.customer_names(spark, sf_dir)
    lost = keep(lost_keys(star.misspelt_customers(spark, sf_dir), known, KEY), "lost-names")
    names = nearest_names(lost.select(F.col(KEY).alias("name")), known.select(F.col(KEY).alias("name")))
    names = names.withColumnsRenamed({"name": KEY, "near": "nearest"})
    return lost.join(names, KEY).select(KEY, "rows", "nearest", "distance")


def one_row_per_location(spark, sf_dir):
    return flow.one_row_per_location(
        observations_daily(spark, sf_dir), snapshot_rates(spark, sf_dir)
    )


def largest_order_per_location(spark, sf_dir):
    """One row per key by a total order, not only by the latest date."""
    order = [F.desc("total_cases"), F.desc("date")] + [
        F.desc(name) for name in ("new_cases", "total_deaths", "new_deaths")
    ]
    return one_row_per_key(observations_clean(spark, sf_dir), [KEY], order)


def any_row_per_location(spark, sf_dir):
    """Only columns that are the same in all rows of a location, so that any row will do."""
    joined = observations_with_rates(spark, sf_dir)
    return any_row_per_key(joined, [KEY]).select(*flow.SNAPSHOT_COLUMNS)


def top_recovery_locations(spark, sf_dir):
    return flow.ranking(one_row_per_location(spark, sf_dir))


def top_recovery_semi(spark, sf_dir):
    return flow.ranking_by_match(
        star.observations(spark, sf_dir), snapshot_rates(spark, sf_dir)
    )


def csv_scan_roundtrip(spark, sf_dir):
    """Write the observations as CSV with empty fields, scan them by schema, sum per day."""
    path = scratch_dir(spark, "observations")
    replace_csv(star.observations(spark, sf_dir), path)
    return flow.daily(read_csv(spark, path, OBSERVATIONS), star.SCALE)


def csv_scan_by_name(spark, sf_dir):
    """A file with other columns before, between and after those that are read, in another order."""
    path = scratch_dir(spark, "wide")
    rows = star.observations(spark, sf_dir)
    names = sorted(rows.columns)
    wide = rows.select(F.lit("x").alias("iso_code"), *names[:3], F.lit(1.5).alias("smoothed"), *names[3:])
    replace_csv(wide.withColumn("note", F.lit("a, b")), path)
    return flow.daily(read_csv(spark, path, OBSERVATIONS), star.SCALE)


def _checked_observations(spark, sf_dir):
    path = scratch_dir(spark, "faulty")
    star.write_faulty_observations(spark, sf_dir, path)
    return checked_csv(spark, path, OBSERVATIONS, BadRowsRule(most_share=0.5))


def csv_checked_daily(spark, sf_dir):
    """Sums of the good rows of a file with malformed ones."""
    return flow.daily(_checked_observations(spark, sf_dir).good, star.SCALE)


def csv_malformed_rows(spark, sf_dir):
    """The malformed rows of the file, by the location they begin with, and what is wrong with them."""
    bad = _checked_observations(spark, sf_dir).bad
    return bad.select(F.split("text", ",")[0].cast("long").alias(KEY), "reason")


def csv_snapshot_scan(spark, sf_dir):
    """Write a snapshot file with CRLF line ends, `inf` texts and an empty column; scan it by schema.

    The empty column is a double by its schema, so filling nulls makes it 0.
    """
    path = scratch_dir(spark, "snapshot")
    star.snapshot_file(spark, sf_dir).write.options(header=True, lineSep="\r\n").csv(path)
    scanned = fill_numeric_nulls(read_csv(spark, path, SNAPSHOT))
    infinite = F.col("Deaths / 100 Recovered") == F.lit(float("inf"))
    return scanned.select(
        F.col("Country/Region").alias(KEY),
        "Confirmed",
        "Active",
        F.when(infinite, 1).otherwise(0).alias("no_recovery"),
        F.when(infinite, None).otherwise(F.col("Deaths / 100 Recovered")).alias("deaths_per_100"),
        F.col("1 week % increase").alias("week_increase"),
        F.col("WHO Region").alias("region"),
    )


def parquet_publish_twice(spark, sf_dir):
    """Published twice and read once: the rows of one copy."""
    dataset = Dataset("daily", scratch_dir(spark, "daily"))
    for _ in range(2):
        publish(observations_daily(spark, sf_dir), dataset)
    return read_published(spark, dataset)


def parquet_replace_twice(spark, sf_dir):
    """Written twice over a plain folder and read with a schema."""
    path = scratch_dir(spark, "replaced")
    frame = observations_daily(spark, sf_dir)
    for _ in range(2):
        replace_parquet(frame, path)
    return read_parquet(spark, path, frame.schema)


def _published_ranking(spark, sf_dir, checked=False):
    """Run the three stages from CSV files to the published ranking, checked before each commit or not."""
    root = scratch_dir(spark, "flow")
    inputs = flow.flow_catalog(root, f"{root}/observations", f"{root}/snapshot")
    replace_csv(star.observations(spark, sf_dir), inputs["observations"].path)
    replace_csv(star.snapshot_file(spark, sf_dir), inputs["snapshot"].path)
    by_day = OutputRules((KEY, "date"), {"total_cases": (0.0, float("inf"))}) if checked else None
    by_location = OutputRules((KEY,), {"recovery_rate": (0.0, 1.0)}) if checked else None
    flow.run_daily(spark, inputs, scale=star.SCALE, rules=by_day)
    flow.run_joined(spark, inputs, rules=by_location)
    flow.run_ranking(spark, inputs, rules=by_location)
    return read_published(spark, inputs["ranking"])


def rank_published_csv(spark, sf_dir):
    return _published_ranking(spark, sf_dir)


def rank_published_checked(spark, sf_dir):
    return _published_ranking(spark, sf_dir, checked=True)


def load_ready_rows(spark, sf_dir):
    """The rows a database load would insert."""
    return rows_to_load(top_recovery_locations(spark, sf_dir))


def output_check(spark, sf_dir):
    return check_output(
        top_recovery_locations(spark, sf_dir), [KEY], {"recovery_rate": (0.0, 1.0)}
    )


def output_check_daily(spark, sf_dir):
    return check_output(
        observations_daily(spark, sf_dir),
        [KEY, "date"],
        {"total_cases": (0.0, 400000.0), "new_cases": (0.0, 400000.0)},
    )


def output_check_clean(spark, sf_dir):
    """A key that repeats, on columns with nulls."""
    return check_output(star.observations(spark, sf_dir), [KEY], {"new_deaths": (1000.0, 250000.0)})


def lineage_edges(spark, sf_dir, **options):
    producers = producers_of(star.row_outputs(spark, sf_dir))
    consumers = star.row_consumers(spark, sf_dir)
    return derive_edges(producers, consumers, **options)


def lineage_edges_salted(spark, sf_dir):
    """Datasets of more than 100 pairs are dealt out by a grid here, so small tables have some too."""
    return lineage_edges(spark, sf_dir, rows_per_salt=10)


def lineage_fan_in(spark, sf_dir):
    return fan_in(lineage_edges(spark, sf_dir, by=lines_by()))


def lineage_fan_in_parts(spark, sf_dir):
    """Up to three lines for every task."""
    return fan_in(lineage_edges(spark, sf_dir, by=lines_by(3)), parts=3)


def _answer(spark, graph, acyclic):
    """One row with an answer; the check has run when the frame is built, as it is a loop of jobs."""
    return spark.range(1).select(F.lit(graph).alias("graph"), F.lit(acyclic).alias("acyclic"))


def lineage_acyclic(spark, sf_dir):
    producers = producers_of(star.row_outputs(spark, sf_dir))
    consumers = star.row_consumers(spark, sf_dir)
    return _answer(spark, "rows", is_acyclic_lineage(producers, consumers))


def lineage_acyclic_orders(spark, sf_dir):
    """Does any order take a part whose delivery depends on that order?"""
    producers = star.stock_lineage(spark, sf_dir, "F")
    consumers = star.stock_lineage(spark, sf_dir, "O")
    return _answer(spark, "orders", is_acyclic_lineage(producers, consumers))


def lineage_acyclic_trade(spark, sf_dir):
    return _answer(spark, "trade", is_acyclic(star.trade(spark, sf_dir)))


def lineage_acyclic_net_trade(spark, sf_dir):
    """Can the nations be put in an order in which none sells more to an earlier one than it buys?"""
    return _answer(spark, "net trade", is_acyclic(star.net_trade(spark, sf_dir)))


def lineage_cycle_net_trade(spark, sf_dir):
    """The nations on a cycle of net trade, by component."""
    return cycle_members(star.net_trade(spark, sf_dir)).withColumnRenamed("vertex", "nation")


def lineage_cycle_customers(spark, sf_dir):
    """The customers whose large orders depend on each other's parts, by component."""
    return cycle_tasks(star.part_lineage(spark, sf_dir, "F"), star.part_lineage(spark, sf_dir, "O"))


def lineage_dependency_lines(spark, sf_dir):
    """Contract, cycle check and fan-in of task specifications that were written as JSON."""
    path = scratch_dir(spark, "tasks")
    # A compressed file is read by one task, so no file gets many rows.
    star.row_tasks(spark, sf_dir).write.option("maxRecordsPerFile", 250_000).json(path, compression="gzip")
    return dependency_lines(read_task_specs(spark, path))


def lineage_output_contract(spark, sf_dir):
    """Orders without exactly one part of a supplier, or with one that has no place yet."""
    orders = star.table(spark, sf_dir, "orders", star.ORDER_COLUMNS)
    tasks = orders.select(F.col("o_orderkey").alias("task"))
    return contract_violations(tasks, star.order_outputs(spark, sf_dir))


QUERIES = {
    query.__name__: query
    for query in (
        top_recovery_locations,
        observations_clean,
        observations_daily,
        snapshot_rates,
        observations_with_rates,
        observations_with_rates_salted,
        lost_locations,
        nearest_lost_names,
        one_row_per_location,
        largest_order_per_location,
        any_row_per_location,
        top_recovery_semi,
        csv_scan_roundtrip,
        csv_scan_by_name,
        csv_checked_daily,
        csv_malformed_rows,
        csv_snapshot_scan,
        parquet_publish_twice,
        parquet_replace_twice,
        rank_published_csv,
        rank_published_checked,
        load_ready_rows,
        output_check,
        output_check_daily,
        output_check_clean,
        lineage_edges,
        lineage_edges_salted,
        lineage_fan_in,
        lineage_fan_in_parts,
        lineage_acyclic,
        lineage_acyclic_orders,
        lineage_acyclic_trade,
        lineage_acyclic_net_trade,
        lineage_cycle_net_trade,
        lineage_cycle_customers,
        lineage_output_contract,
        lineage_dependency_lines,
    )
}

"""The batch flow: daily sums -> one row per location with rates -> ranking -> database table.

Each stage has a DataFrame function and a run_ function that reads and publishes catalog datasets.
The run_ functions are called in order by whatever schedules the flow.
"""

from pyspark.sql import functions as F

from locrank.functions import add_rates, fill_numeric_nulls, rename
from locrank.operators import (
    join_on_key,
    latest_per_key,
    one_row_per_key,
    rows_with_match,
    sum_by,
    top_k,
)
from locrank.operators.topk import RANKING_SIZE
from locrank.schemas import (
    DAILY,
    JOINED,
    KEY,
    MEASURES,
    OBSERVATIONS,
    RANKING,
    RATES,
    SNAPSHOT,
    SNAPSHOT_COUNTS,
    SNAPSHOT_KEY,
)
from locrank.sinks import load_table, publish
from locrank.sources import Catalog, Dataset, checked_csv, read_published

SNAPSHOT_COLUMNS = [KEY, *SNAPSHOT_COUNTS, *RATES]


def clean_observations(observations):
    """The six columns of an observation, nulls in the measures as 0."""
    return fill_numeric_nulls(observations.select(KEY, "date", *MEASURES), keys=[KEY])


def daily(observations, scale=None):
    """Sum the four measures per location and date."""
    return sum_by(clean_observations(observations), [KEY, "date"], MEASURES, scale)


def snapshot_rates(snapshot):
    """Key, counts and the two rates of each snapshot row."""
    named = rename(snapshot, {SNAPSHOT_KEY: KEY})
    return add_rates(fill_numeric_nulls(named, keys=[KEY])).select(*SNAPSHOT_COLUMNS)


def unique_snapshot(rated):
    """One row per location, for a snapshot file nobody guarantees: highest counts first."""
    return one_row_per_key(
        rated, [KEY], [F.col(name).desc_nulls_last() for name in SNAPSHOT_COUNTS]
    )


def observations_with_rates(daily_rows, rated):
    """Every daily row with its location's counts and rates."""
    return join_on_key(daily_rows, rated, KEY)


def one_row_per_location(daily_rows, rated):
    """The latest daily row of each location with its counts and rates.

    The reduction to one row comes before the join, so the join meets one row per location on
    both sides whatever the skew, and reuses the partitioning the reduction ends with. `rated`
    must have one row per location.
    """
    latest = latest_per_key(daily_rows, KEY, "date", MEASURES)
    return join_on_key(latest, rated, KEY)


def ranking(joined, k=RANKING_SIZE):
    """The k locations with the highest recovery rate."""
    return top_k(joined.select(KEY, "recovery_rate"), "recovery_rate", k)


def ranking_by_match(observations, rated, k=RANKING_SIZE):
    """The same ranking straight from the snapshot: it needs to know only which locations occur."""
    return ranking(rows_with_match(rated, observations, KEY), k)


def flow_catalog(root, observations_path, snapshot_path):
    """The flow's datasets, with its outputs under `root`."""
    return Catalog().add(
        Dataset("observations", observations_path, "csv", OBSERVATIONS),
        Dataset("snapshot", snapshot_path, "csv", SNAPSHOT),
        Dataset("daily", f"{root}/daily", "parquet", DAILY),
        Dataset("joined", f"{root}/joined", "parquet", JOINED),
        Dataset("ranking", f"{root}/ranking", "csv", RANKING),
    )


def scan_checked(spark, catalog, name, bad_rows=None):
    """The rows of a CSV dataset; with a BadRowsRule only the good ones, or MalformedRowsError."""
    if bad_rows is None:
        return catalog.scan(spark, name)
    return checked_csv(spark, catalog[name].path, catalog[name].schema, bad_rows).good


def run_daily(spark, catalog, on_missing="create", scale=None, rules=None, bad_rows=None):
    observations = scan_checked(spark, catalog, "observations", bad_rows)
    return publish(daily(observations, scale), catalog["daily"], on_missing, rules)


def run_joined(spark, catalog, on_missing="create", rules=None, bad_rows=None):
    rated = unique_snapshot(snapshot_rates(scan_checked(spark, catalog, "snapshot", bad_rows)))
    rows = one_row_per_location(read_published(spark, catalog["daily"]), rated)
    return publish(rows, catalog["joined"], on_missing, rules)


def run_ranking(spark, catalog, k=RANKING_SIZE, on_missing="create", rules=None):
    rows = ranking(read_published(spark, catalog["joined"]), k)
    return publish(rows, catalog["ranking"], on_missing, rules)


def run_load(spark, catalog, url, connect, **options):
    return load_table(read_published(spark, catalog["ranking"]), url, connect, **options)


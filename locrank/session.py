"""Session settings the flows are planned for. No master is set here: the cluster gives it."""

from pyspark.sql import SparkSession

# Adaptive execution does three jobs in this package: it splits hot join partitions, turns a
# shuffle join into a broadcast join once the measured side is below the limit, and merges small
# shuffle partitions. So the initial partition count can be set high for the largest input.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

TASK_BYTES = 512 * 1024**2


def sized_for(shuffle_bytes, most_partitions=None):
    """Settings for a flow whose largest shuffle has about that many bytes.

    The number of shuffle blocks is map tasks times partitions; `most_partitions` holds it to what
    the cluster's shuffle service can serve, at the price of larger partitions.
    """
    wanted = -(-shuffle_bytes // TASK_BYTES)
    partitions = max(200, min(most_partitions or wanted, wanted))
    return {
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }


def build_session(app_name="locrank", settings=None):
    """A session with SETTINGS and the given ones, which win."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

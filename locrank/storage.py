"""Paths on the session's file system."""

import uuid
from contextlib import contextmanager

# Whether Spark removes the shuffle files of a plan as soon as it has run; by default they stay until
# the driver's garbage collection finds their frame.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def located(spark, path):
    """The file system of a path, and the path as that system's type."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark, path):
    system, place = located(spark, path)
    return system.exists(place)


def delete(spark, path):
    """Remove a folder this package wrote. False if it was not there."""
    system, place = located(spark, path)
    return system.delete(place, True)


def shared_root(spark):
    """The folder the cluster gives in spark.checkpoint.dir, else one in the session's warehouse.

    A folder that the cluster names is taken as it is, also a `file:` one: executors may share a
    mount. The warehouse stands in for it only where all tasks run on this machine or where it is
    not on a local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is not None:
        return root
    warehouse = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    if not local and located(spark, warehouse)[0].getScheme() == "file":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return warehouse


def scratch_dir(spark, purpose):
    """A new folder name under the shared root."""
    return f"{shared_root(spark).rstrip('/')}/locrank/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark):
    """What is written inside leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def keep(frame, purpose, path=None, compression=None):
    """Write a result that several jobs read, and read it back.

    A lost executor then costs the tasks that ran on it, not the jobs before, and all readers see
    the same rows. The table stays until the shared folder is cleaned; the shuffles it was computed
    by go when it is written, as nothing reads them again.
    """
    spark = frame.sparkSession
    path = path or scratch_dir(spark, purpose)
    with _shuffles_removed(spark):
        frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)

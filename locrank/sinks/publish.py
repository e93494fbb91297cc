"""Full refresh that readers and other runs can survive.

A dataset's path holds versions/<run> with the data and commits/<number>, a small record that is
created when the data is complete. Readers take the highest number. A number is claimed by creating
its record, which fails where the file is there, so of two runs one takes the next number; clocks
play no part. No run writes into a folder of another, so two runs at the same time cannot remove
each other's temporary files, a failed run leaves the last version in place, and publishing again
leaves one copy visible.
"""

import json
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation
from pyspark.sql import functions as F

from locrank.operators.checks import check_output, outside
from locrank.storage import delete, exists, located

COMMIT = "number long, run string, row_count long"


class OutputCheckError(Exception):
    """A version that was not published, with what is wrong with it."""


@dataclass(frozen=True)
class OutputRules:
    """What an output must be like: keys that are unique and not null, rows, values in their ranges."""

    keys: tuple
    ranges: dict | None = None
    least_rows: int = 1

    def metrics(self):
        """Counts that need no other row, taken while the rows are written."""
        return [outside(name, *limits).alias(f"outside_{name}") for name, limits in (self.ranges or {}).items()]

    def broken(self, stored, counts):
        """The rules that a version breaks.

        stored is the version as written, of which only the keys are read; counts holds the rows and
        the metrics of its write. Rows that are written but not found are reported as lost.
        """
        found = check_output(stored.select(*self.keys), list(self.keys)).first().asDict()
        bad = {name: found[name] for name in ("repeated_keys", "null_key_rows") if found[name]}
        bad |= {name: n for name, n in counts.items() if n and name.startswith("outside_")}
        if found["row_count"] < self.least_rows:
            bad["row_count"] = found["row_count"]
        if found["row_count"] != counts["rows"]:
            bad["lost_rows"] = counts["rows"] - found["row_count"]
        return bad


@dataclass(frozen=True)
class PublishResult:
    name: str
    status: str
    run: str | None = None
    row_count: int | None = None


def _commits(spark, path):
    """The commit records, newest first; None if nothing was ever published."""
    if not exists(spark, f"{path}/commits"):
        return None
    records = spark.read.schema(COMMIT).json(f"{path}/commits")
    return records.where("run is not null").orderBy(F.desc("number"))


def _claim(spark, path, run, row_count):
    """Create the record of the next number, which no other run has."""
    records = _commits(spark, path)
    newest = records.select("number").first() if records is not None else None
    number = newest.number + 1 if newest else 1
    while True:
        system, record = located(spark, f"{path}/commits/{number:020d}")
        try:
            stream = system.create(record, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            number += 1
            continue
        stream.write(bytearray(json.dumps({"number": number, "run": run, "row_count": row_count}).encode()))
        stream.close()
        return number


def publish(df, dataset, on_missing="create", rules=None):
    """Write `df` as the dataset's new version and make it the one readers see.

    on_missing="skip" writes nothing where the dataset's folder does not exist yet, and says so
    in the result. A version that breaks `rules` is removed, the last one stays, and the error says
    what was wrong. Rows and values outside their range are counted while they are written; only the keys are
    read again, to find repeated ones.
    """
    if on_missing not in ("create", "skip"):
        raise ValueError(f"on_missing is create or skip, not {on_missing}")
    spark = df.sparkSession
    if on_missing == "skip" and not exists(spark, dataset.path):
        return PublishResult(dataset.name, "skipped: no output folder")
    run = uuid.uuid4().hex
    version = f"{dataset.path}/versions/{run}"
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"), *(rules.metrics() if rules else []))
    rows.write.format(dataset.format).options(**dataset.write_options).save(version)
    broken = rules.broken(dataset.read(spark, version), counted.get) if rules else None
    if broken:
        delete(spark, version)
        raise OutputCheckError(f"{dataset.name} is not published: {broken}")
    row_count = counted.get["rows"]
    _claim(spark, dataset.path, run, row_count)
    return PublishResult(dataset.name, "published", run, row_count)


def published_path(spark, dataset):
    """The folder of the newest complete version, or None."""
    records = _commits(spark, dataset.path)
    newest = records.select("run").first() if records is not None else None
    return f"{dataset.path}/versions/{newest.run}" if newest else None


def prune_versions(spark, dataset, keep=2):
    """Delete all but the newest `keep` published versions and return how many went.

    Folders without a commit record are left alone: their run may still be writing.
    """
    if keep < 1:
        raise ValueError("keep at least the version readers see")
    records = _commits(spark, dataset.path)
    if records is None:
        return 0
    old = records.select("number", "run").offset(keep).collect()
    for record in old:
        delete(spark, f"{dataset.path}/commits/{record.number:020d}")
        delete(spark, f"{dataset.path}/versions/{record.run}")
    return len(old)


def remove_unfinished(spark, dataset, older_than_seconds):
    """Delete folders of runs that never committed and have not changed for so long; returns how many."""
    if not exists(spark, f"{dataset.path}/versions"):
        return 0
    records = _commits(spark, dataset.path)
    done = {row.run for row in records.select("run").collect()} if records is not None else set()
    system, versions = located(spark, f"{dataset.path}/versions")
    old = [
        status.getPath().getName()
        for status in system.listStatus(versions)
        if status.getPath().getName() not in done
        and status.getModificationTime() / 1000 <= time.time() - older_than_seconds
    ]
    for run in old:
        delete(spark, f"{dataset.path}/versions/{run}")
    return len(old)

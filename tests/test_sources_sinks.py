from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locrank.schemas import RANKING, SNAPSHOT
from locrank.sinks import prune_versions, publish, published_path, replace_csv, replace_parquet
from locrank.sinks.jdbc import load_table, rows_to_load
from locrank.sources import Catalog, Dataset, read_csv, read_parquet, read_published
from locrank.storage import exists, scratch_dir

HEADER = ",".join(field.name for field in SNAPSHOT.fields)


def values(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_snapshot_scan_with_crlf_and_infinity(spark, tmp_path):
    lines = [
        HEADER,
        "Ruritania*,90,9,60,21,5,1,2,10.0,66.67,15.0,85,5,5.88,Nowhere Sea",
        "Cote d'Ivoire,10,3,0,7,0,0,0,30.0,0.0,inf,,,,Africa",
    ]
    (tmp_path / "snapshot.csv").write_bytes("\r\n".join(lines).encode() + b"\r\n")
    rows = {r[0]: r for r in read_csv(spark, str(tmp_path), SNAPSHOT).collect()}
    assert rows["Ruritania*"]["WHO Region"] == "Nowhere Sea"
    assert rows["Cote d'Ivoire"]["Deaths / 100 Recovered"] == float("inf")
    assert rows["Cote d'Ivoire"]["Confirmed last week"] is None
    inferred = read_csv(spark, str(tmp_path))
    assert inferred.schema["Confirmed"].dataType == T.IntegerType()


def test_csv_replaced_twice_reads_back_once(spark, tmp_path):
    frame = spark.createDataFrame([("a, \"b\"", 0.1 + 0.2), ("c", 1 / 3)], RANKING)
    path = str(tmp_path / "rank")
    for _ in range(2):
        replace_csv(frame, path)
    assert values(read_csv(spark, path, RANKING)) == values(frame)


def test_parquet_of_an_empty_folder(spark, tmp_path):
    assert read_parquet(spark, str(tmp_path), RANKING).count() == 0
    with pytest.raises(AnalysisException):
        read_parquet(spark, str(tmp_path))


def test_parquet_replaced_twice(spark, tmp_path):
    frame = spark.range(5).toDF("n")
    for _ in range(2):
        replace_parquet(frame, str(tmp_path / "t"))
    assert values(read_parquet(spark, str(tmp_path / "t"), frame.schema)) == values(frame)


@pytest.fixture
def dataset(tmp_path):
    return Dataset("numbers", str(tmp_path / "numbers"), "parquet", T.StructType().add("n", "long"))


def test_publish_shows_the_newest_version_only(spark, dataset):
    for size in (3, 5, 4):
        result = publish(spark.range(size).toDF("n"), dataset)
        assert (result.status, result.row_count) == ("published", size)
        assert values(read_published(spark, dataset)) == [(n,) for n in range(size)]


def test_publish_a_frame_that_reads_the_dataset_itself(spark, dataset):
    publish(spark.range(3).toDF("n"), dataset)
    publish(read_published(spark, dataset).where("n > 0"), dataset)
    assert values(read_published(spark, dataset)) == [(1,), (2,)]


def test_publish_skips_a_missing_folder_when_told(spark, dataset):
    frame = spark.range(3).toDF("n")
    result = publish(frame, dataset, on_missing="skip")
    assert result.status.startswith("skipped") and not exists(spark, dataset.path)
    publish(frame, dataset)
    assert publish(frame, dataset, on_missing="skip").status == "published"
    with pytest.raises(ValueError):
        publish(frame, dataset, on_missing="maybe")


def test_failed_publish_leaves_the_last_version(spark, dataset):
    publish(spark.range(3).toDF("n"), dataset)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("n"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, dataset)
    assert values(read_published(spark, dataset)) == [(0,), (1,), (2,)]


def test_a_reader_keeps_its_version_while_another_is_published(spark, dataset):
    publish(spark.range(3).toDF("n"), dataset)
    reader = read_published(spark, dataset)
    publish(spark.range(9).toDF("n"), dataset)
    assert prune_versions(spark, dataset, keep=2) == 0
    assert reader.count() == 3


def test_prune_keeps_the_newest(spark, dataset):
    runs = [publish(spark.range(n).toDF("n"), dataset).run for n in (1, 2, 3)]
    assert prune_versions(spark, dataset, keep=1) == 2
    assert published_path(spark, dataset).endswith(runs[-1])
    assert [exists(spark, f"{dataset.path}/versions/{run}") for run in runs] == [False, False, True]
    assert read_published(spark, dataset).count() == 3
    with pytest.raises(ValueError):
        prune_versions(spark, dataset, keep=0)


def test_runs_at_the_same_time_do_not_disturb_each_other(spark, dataset):
    sizes = [11, 12, 13, 14]
    with ThreadPoolExecutor(len(sizes)) as pool:
        results = list(pool.map(lambda n: publish(spark.range(n).toDF("n"), dataset), sizes))
    assert [r.row_count for r in results] == sizes
    assert read_published(spark, dataset).count() in sizes
    assert prune_versions(spark, dataset, keep=1) == 3


def test_nothing_published(spark, dataset):
    assert published_path(spark, dataset) is None and prune_versions(spark, dataset) == 0
    with pytest.raises(FileNotFoundError):
        read_published(spark, dataset)


def test_published_csv(spark, tmp_path):
    dataset = Dataset("rank", str(tmp_path / "rank"), "csv", RANKING)
    frame = spark.createDataFrame([("a", 0.75), ("b", 1 / 3)], RANKING)
    publish(frame, dataset)
    assert values(read_published(spark, dataset)) == values(frame)


def test_catalog_scans_and_views(spark, tmp_path):
    replace_parquet(spark.range(4).toDF("n"), str(tmp_path / "t"))
    catalog = Catalog().add(Dataset("four_rows", str(tmp_path / "t")))
    assert catalog.scan(spark, "four_rows").count() == 4
    catalog.register_views(spark)
    assert spark.sql("SELECT sum(n) AS s FROM four_rows").first().s == 6
    with pytest.raises(ValueError):
        catalog.add(Dataset("four_rows", "elsewhere"))
    with pytest.raises(KeyError):
        catalog["nothing"]


def test_scratch_folders_lie_in_the_shared_folder_and_differ(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_to_load_has_one_row_per_location(spark):
    frame = spark.createDataFrame([("a", 0.5, 1), ("a", 0.5, 1)], "location string, recovery_rate double, x int")
    assert values(rows_to_load(frame)) == [("a", 0.5)]


class Recorder:
    """Stands for a DB-API connection, its cursor and Spark's JDBC reader and writer at once."""

    def __init__(self, staged, fail_on=None):
        self.log, self.staged, self.fail_on = [], staged, fail_on

    def __call__(self):
        return self

    def cursor(self):
        return self

    def execute(self, statement):
        self.log.append(statement)
        if self.fail_on and statement.startswith(self.fail_on):
            raise OSError("connection lost")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


@pytest.fixture
def jdbc(spark, monkeypatch):
    """No database is started: the JDBC write and read are recorded instead."""
    from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

    def prepare(staged, fail_on=None):
        recorder = Recorder(staged, fail_on)

        def write(self, url, table, mode=None, properties=None):
            recorder.table = table
            recorder.log.append(f"write {mode}")

        monkeypatch.setattr(DataFrameWriter, "jdbc", write)
        monkeypatch.setattr(
            DataFrameReader, "jdbc", lambda self, url, table, properties=None: spark.range(staged)
        )
        return recorder

    return prepare


def test_load_swaps_after_staging(spark, jdbc):
    recorder = jdbc(staged=2)
    frame = spark.createDataFrame([("a", 0.5), ("b", 0.25)], RANKING)
    assert load_table(frame, "jdbc:x", recorder, "db.best") == 2
    assert recorder.log == [
        "write error",
        "DROP TABLE IF EXISTS db.best",
        f"ALTER TABLE {recorder.table} RENAME TO best",
        "commit",
        "close",
        "close",
    ]
    assert recorder.table.startswith("db.best_")


def test_load_leaves_the_table_when_counts_differ(spark, jdbc):
    recorder = jdbc(staged=3)
    frame = spark.createDataFrame([("a", 0.5), ("b", 0.25)], RANKING)
    with pytest.raises(RuntimeError, match="staged 3 rows of 2"):
        load_table(frame, "jdbc:x", recorder, "best")
    assert recorder.log[1:] == ["rollback", f"DROP TABLE IF EXISTS {recorder.table}", "commit", "close", "close"]


def test_load_rolls_back_a_failed_swap(spark, jdbc):
    recorder = jdbc(staged=1, fail_on="ALTER")
    frame = spark.createDataFrame([("a", 0.5)], RANKING)
    with pytest.raises(OSError):
        load_table(frame, "jdbc:x", recorder, "best")
    assert recorder.log[-5:] == ["rollback", f"DROP TABLE IF EXISTS {recorder.table}", "commit", "close", "close"]

"""Named datasets: where each lies, in which format and with which schema."""

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The reader knows `Inf` as infinity; the snapshot file writes `inf`.
CSV_READ = {"header": "true", "positiveInf": "inf", "negativeInf": "-inf"}
CSV_WRITE = {"header": "true"}


def read_csv(spark, path, schema=None):
    """A CSV file or folder with header lines; without a schema Spark infers one in an extra pass.

    The columns of a schema are found by their names in the header, whatever their order and however
    many others there are; one that is missing is an error. All files must have the same header:
    Spark compares each file's with that of the first. Reading the header reads one line; the scan
    reads each file once and parses only the columns that are used.
    """
    reader = spark.read.options(**CSV_READ)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    declared = {column.name: column.dataType for column in schema}
    missing = [name for name in declared if name not in header]
    if missing and header:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    whole = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in header or declared])
    return reader.schema(whole).option("enforceSchema", False).csv(path).select(*map(quoted, declared))


def quoted(name):
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Dataset:
    name: str
    path: str
    format: str = "parquet"
    schema: T.StructType | None = None

    @property
    def write_options(self):
        return CSV_WRITE if self.format == "csv" else {}

    def read(self, spark, path=None):
        """The dataset's files, or those of a version of it, as a lazy DataFrame."""
        path = path or self.path
        if self.format == "csv":
            return read_csv(spark, path, self.schema)
        reader = spark.read.format(self.format)
        return (reader if self.schema is None else reader.schema(self.schema)).load(path)


@dataclass
class Catalog:
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def add(self, *datasets):
        for dataset in datasets:
            if dataset.name in self.datasets:
                raise ValueError(f"dataset {dataset.name} is already in the catalog")
            self.datasets[dataset.name] = dataset
        return self

    def __getitem__(self, name):
        return self.datasets[name]

    def scan(self, spark, name):
        """The dataset as a lazy DataFrame, read from its path as it stands."""
        return self.datasets[name].read(spark)

    def register_views(self, spark):
        """Make every dataset a temporary view of its own name."""
        for name in self.datasets:
            self.scan(spark, name).createOrReplaceTempView(name)

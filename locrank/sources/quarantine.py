"""CSV scans that part malformed rows from good ones, instead of reading what is wrong as null.

The reader's corrupt-record channel keeps the text of each row in which a field does not have its
declared type or whose number of fields is not that of the header. All rows are read once and
written as Parquet with that text; good and malformed rows are both read from there, so they always
complement each other, whatever columns a query uses later.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locrank.sources.catalog import CSV_READ, quoted
from locrank.storage import scratch_dir

_TEXT, _FILE = "_malformed_record", "_source_file"


class MalformedRowsError(Exception):
    """More malformed rows than the rule allows; `bad` is the table of them."""

    def __init__(self, path, checked):
        self.bad, self.bad_count, self.row_count = checked.bad, checked.bad_count, checked.row_count
        super().__init__(f"{path} has {self.bad_count} malformed rows of {self.row_count}")


@dataclass(frozen=True)
class BadRowsRule:
    """How many malformed rows a file may have, as a number and as a share of its rows."""

    most_rows: int | None = None
    most_share: float | None = None

    def broken(self, bad_count, row_count):
        many = self.most_rows is not None and bad_count > self.most_rows
        return many or (self.most_share is not None and bad_count > self.most_share * row_count)


@dataclass(frozen=True)
class CheckedRows:
    """good has the declared columns, bad has file, text and reason."""

    good: DataFrame
    bad: DataFrame
    row_count: int
    bad_count: int


def _parsed(column, kind):
    """A text as a value of a type, null where it is none, by the reader's own rules for dates."""
    if isinstance(kind, T.DateType):
        return F.try_to_date(column, "yyyy-MM-dd")
    return column.try_cast(kind)


def _reason(names, declared):
    """What is wrong with the row in _TEXT: the fields that do not parse, or their number."""
    layout = ", ".join([*(f"f{i} string" for i in range(len(names))), "wrong string"])
    fields = F.from_csv(F.col(_TEXT), layout, {"columnNameOfCorruptRecord": "wrong"})
    wrong = [
        F.when(
            F.col(f"fields.f{i}").isNotNull() & _parsed(F.col(f"fields.f{i}"), declared[name]).isNull(),
            F.concat(F.lit(f"{name} is not {declared[name].simpleString()}: "), F.col(f"fields.f{i}")),
        )
        for i, name in enumerate(names)
        if name in declared and not isinstance(declared[name], T.StringType)
    ]
    number = F.when(F.col("fields.wrong").isNotNull(), F.lit(f"not {len(names)} fields"))
    found = F.coalesce(number, F.nullif(F.concat_ws("; ", *wrong), F.lit("")), F.lit("not readable"))
    return fields.alias("fields"), found


def checked_csv(spark, path, schema, rule=None):
    """The rows of a CSV file or folder with header lines as CheckedRows.

    Columns are found by their header names, as in read_csv; the header must be that of every file.
    A row is malformed if a field of a declared column does not have its type, or if it has more or
    fewer fields than the header. Empty fields are null and not malformed; columns that are not
    declared are not converted. A broken rule raises MalformedRowsError, with the table of bad rows.

    The file is read once; rows are counted while they are written to the shared folder.
    """
    reader = spark.read.options(**CSV_READ)
    names = reader.csv(path).columns
    declared = {column.name: column.dataType for column in schema}
    missing = [name for name in declared if name not in names]
    if missing and names:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    names = names or list(declared)
    whole = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in names])
    reader = reader.schema(whole.add(_TEXT, T.StringType())).option("enforceSchema", False)
    # Fields are counted only where the parser does not leave out columns.
    reader = reader.options(columnNameOfCorruptRecord=_TEXT, mode="PERMISSIVE", columnPruning=False)
    counts, at = Observation(), scratch_dir(spark, "checked-rows")
    rows = reader.csv(path).select(*map(quoted, declared), _TEXT, F.input_file_name().alias(_FILE))
    is_bad = F.col(_TEXT).isNotNull()
    observed = rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(is_bad).alias("bad"))
    # Malformed rows lie in a folder of their own, so that either kind is read without the other.
    observed.withColumn("_malformed", is_bad).write.partitionBy("_malformed").parquet(at)
    layout = T.StructType([*rows.schema.fields, T.StructField("_malformed", T.BooleanType())])
    kept = spark.read.schema(layout).parquet(at)
    fields, reason = _reason(names, declared)
    bad = kept.where("_malformed").select(F.col(_FILE).alias("file"), F.col(_TEXT).alias("text"), fields, _TEXT)
    bad = bad.select("file", "text", reason.alias("reason"))
    good = kept.where("not _malformed").select(*map(quoted, declared))
    found = counts.get if names else {"rows": 0, "bad": 0}
    checked = CheckedRows(good, bad, found["rows"], found["bad"])
    if rule and rule.broken(checked.bad_count, checked.row_count):
        raise MalformedRowsError(path, checked)
    return checked

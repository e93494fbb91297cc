"""Declared schemas. Every scan states its schema, so no read needs an inference pass."""

from pyspark.sql import types as T

KEY = "location"
MEASURES = ["total_cases", "new_cases", "total_deaths", "new_deaths"]
RATES = ["mortality_rate", "recovery_rate"]

# The column names of the snapshot file and the names its key and counts go by.
SNAPSHOT_KEY = "Country/Region"
SNAPSHOT_COUNTS = ["Confirmed", "Deaths", "Recovered"]
SNAPSHOT = T.StructType(
    [
        T.StructField("Country/Region", T.StringType()),
        T.StructField("Confirmed", T.LongType()),
        T.StructField("Deaths", T.LongType()),
        T.StructField("Recovered", T.LongType()),
        T.StructField("Active", T.LongType()),
        T.StructField("New cases", T.LongType()),
        T.StructField("New deaths", T.LongType()),
        T.StructField("New recovered", T.LongType()),
        T.StructField("Deaths / 100 Cases", T.DoubleType()),
        T.StructField("Recovered / 100 Cases", T.DoubleType()),
        T.StructField("Deaths / 100 Recovered", T.DoubleType()),
        T.StructField("Confirmed last week", T.LongType()),
        T.StructField("1 week change", T.LongType()),
        T.StructField("1 week % increase", T.DoubleType()),
        T.StructField("WHO Region", T.StringType()),
    ]
)

OBSERVATIONS = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
)

# One row per (location, date).
DAILY = OBSERVATIONS

# One row per location: its latest daily row, the snapshot's counts and the two rates.
JOINED = T.StructType(
    DAILY.fields
    + [T.StructField(name, T.LongType()) for name in SNAPSHOT_COUNTS]
    + [T.StructField(name, T.DoubleType()) for name in RATES]
)

RANKING = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("recovery_rate", T.DoubleType())]
)

# One job of a flow: the datasets it reads and the ones it declares as output.
TASK_SPEC = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("inputs", T.ArrayType(T.StringType())),
        T.StructField(
            "outputs",
            T.ArrayType(
                T.StructType(
                    [T.StructField("name", T.StringType()), T.StructField("path", T.StringType())]
                )
            ),
        ),
    ]
)


def keyed_by(schema, data_type):
    """The same schema with another type for the location key."""
    return T.StructType(
        [T.StructField(f.name, data_type if f.name == KEY else f.dataType) for f in schema.fields]
    )

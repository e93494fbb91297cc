"""Column work: renames, null filling, guarded ratios. All built-in expressions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename(df, names):
    """Rename columns; a name the frame lacks is left alone."""
    return df.withColumnsRenamed(names)


def fill_numeric_nulls(df, keys=()):
    """Null becomes 0 in numeric columns. Text, dates and the named keys keep their nulls.

    A key that is a number must not become 0: it would match the key 0, and a hot null key would
    reach the shuffle of the next join instead of being dropped at the scan.
    """
    numeric = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in keys
    ]
    return df.na.fill(0, subset=numeric) if numeric else df


def safe_ratio(numerator, denominator):
    """numerator / denominator as a double; 0.0 unless the denominator is above zero.

    The guard stays inside the expression, so a zero denominator raises nothing in ANSI mode.
    """
    top, bottom = F.col(numerator).cast("double"), F.col(denominator)
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def add_rates(snapshot):
    """Add the share of confirmed cases that died and the share that recovered."""
    return snapshot.withColumns(
        {
            "mortality_rate": safe_ratio("Deaths", "Confirmed"),
            "recovery_rate": safe_ratio("Recovered", "Confirmed"),
        }
    )

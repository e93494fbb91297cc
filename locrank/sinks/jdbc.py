"""Full refresh of a database table: rows go to a staging table, which then takes its place."""

import uuid
from contextlib import closing

from locrank.operators.grouping import any_row_per_key
from locrank.schemas import KEY
from locrank.storage import keep

# The table's name and the declared type of its key. The rate takes the dialect's own
# double type.
TABLE = "best_recovery_countries"
COLUMN_TYPES = "location VARCHAR(255)"


def rows_to_load(ranking):
    """The ranking as the table takes it: one row per location."""
    return any_row_per_key(ranking.select(KEY, "recovery_rate"), [KEY])


def load_table(ranking, url, connect, table=TABLE, properties=None):
    """Replace `table` with the ranking; the old rows stay if anything fails before the swap.

    Spark writes the rows over JDBC into a staging table, a partition per transaction. Its count
    must equal the ranking's, which also catches a partition written twice after a lost executor.
    Then one transaction on `connect()` (a DB-API connection to the same database) drops the old
    table and renames the staging table. Errors are raised, not printed.
    """
    properties = properties or {}
    spark = ranking.sparkSession
    rows = rows_to_load(ranking)
    staging = f"{table}_{uuid.uuid4().hex[:8]}"
    rows = keep(rows, "load")  # the same rows are written and counted
    with closing(connect()) as connection, closing(connection.cursor()) as cursor:
        try:
            rows.write.option("createTableColumnTypes", COLUMN_TYPES).jdbc(
                url, staging, mode="error", properties=properties
            )
            expected = rows.count()
            found = spark.read.jdbc(url, staging, properties=properties).count()
            if found != expected:
                raise RuntimeError(f"staged {found} rows of {expected}; {table} is unchanged")
            cursor.execute(f"DROP TABLE IF EXISTS {table}")
            cursor.execute(f"ALTER TABLE {staging} RENAME TO {table.rsplit('.', 1)[-1]}")
            connection.commit()
        except Exception:
            connection.rollback()
            cursor.execute(f"DROP TABLE IF EXISTS {staging}")
            connection.commit()
            raise
    return found

"""The flow's inputs and lineage tables, derived from a star schema of orders and events.

observations: an order is an observation of its customer, the total price split by order status.
snapshot: the events of a user, of which errors are deaths and purchases recoveries.
lineage: a row of a table is a task that reads the rows its foreign keys name.
"""

from functools import reduce

from pyspark.sql import functions as F

from locrank.schemas import KEY, MEASURES
from locrank.sources import read_parquet

EVENT_COLUMNS = "user_id long, event_type string"
LINE_COLUMNS = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string"
)
ORDER_COLUMNS = "o_orderkey long, o_custkey long"
OBSERVED_COLUMNS = (
    "o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
)
CUSTOMER_COLUMNS = "c_custkey long, c_nationkey long"
SUPPLIER_COLUMNS = "s_suppkey long, s_nationkey long"
NATION_COLUMNS = "n_nationkey long, n_regionkey long"

# Prices have two decimal places.
SCALE = 2


def table(spark, sf_dir, name, columns=None):
    """A table of the folder. Stating the columns and types saves the job that reads them."""
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", columns)


def observations(spark, sf_dir):
    """A measure is null, not 0, for orders of another status."""
    price = F.col("o_totalprice")

    def of_status(status):
        return F.when(F.col("o_orderstatus") == status, price)

    return table(spark, sf_dir, "orders", OBSERVED_COLUMNS).select(
        F.col("o_custkey").alias(KEY),
        F.col("o_orderdate").cast("date").alias("date"),
        price.alias(MEASURES[0]),
        of_status("O").alias(MEASURES[1]),
        of_status("P").alias(MEASURES[2]),
        of_status("F").alias(MEASURES[3]),
    )


def write_faulty_observations(spark, sf_dir, path):
    """The observations as CSV, with words for numbers, dates in another form and lines cut short at some locations."""
    rows = observations(spark, sf_dir)
    other = F.date_format("date", "dd/MM/yyyy")
    short = F.col(KEY) % 83 == 2
    texts = rows.select(
        F.col(KEY).cast("string").alias(KEY),
        F.when(F.col(KEY) % 89 == 1, other).otherwise(F.col("date").cast("string")).alias("date"),
        F.when(F.col(KEY) % 97 == 0, "n/a").otherwise(F.col(MEASURES[0]).cast("string")).alias(MEASURES[0]),
        *(F.col(name).cast("string").alias(name) for name in MEASURES[1:]),
        short.alias("short"),
    )
    texts.where("not short").drop("short").write.option("header", True).csv(path)
    lines = texts.where("short").select(F.concat_ws(",", KEY, "date").alias("value"))
    header = spark.createDataFrame([(",".join(rows.columns),)], "value string").coalesce(1)
    # One file, which begins with the header.
    header.unionAll(lines).coalesce(1).write.mode("append").text(path)


def misspelt_customers(spark, sf_dir):
    """location, one row per order: the name of its customer, for some customers with an edit, for others turned round."""
    customers = table(spark, sf_dir, "customer", "c_custkey long, c_name string")
    key, name = F.col("c_custkey"), F.col("c_name")

    def written(text):
        return F.replace(name, F.lit("Customer"), F.lit(text))

    seen = F.when(key % 50 == 7, F.reverse(name)).when(key % 15 == 0, written("Custommer"))
    seen = seen.when(key % 15 == 5, written("Custmer")).when(key % 15 == 10, written("Cuztomer")).otherwise(name)
    orders = table(spark, sf_dir, "orders", ORDER_COLUMNS).select(F.col("o_custkey").alias("c_custkey"))
    return orders.join(customers, "c_custkey").select(seen.alias(KEY))


def customer_names(spark, sf_dir):
    return table(spark, sf_dir, "customer", "c_name string").select(F.col("c_name").alias(KEY))


def snapshot(spark, sf_dir):
    """One row per user: all events, errors and purchases.

    The key is renamed before the grouping, so a join on it finds the rows partitioned already.
    """

    def of_type(kind):
        return F.count(F.when(F.col("event_type") == kind, 1))

    return (
        table(spark, sf_dir, "events", EVENT_COLUMNS)
        .select(F.col("user_id").alias(KEY), "event_type")
        .groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("Confirmed"),
            of_type("error").alias("Deaths"),
            of_type("purchase").alias("Recovered"),
        )
    )


def snapshot_file(spark, sf_dir):
    """The snapshot in the columns and texts of the snapshot file, infinity as `inf`."""

    def of_type(kind):
        return F.count(F.when(F.col("event_type") == kind, 1))

    counted = (
        table(spark, sf_dir, "events", EVENT_COLUMNS)
        .groupBy(F.col("user_id").cast("string").alias("Country/Region"))
        .agg(
            F.count(F.lit(1)).alias("Confirmed"),
            of_type("error").alias("Deaths"),
            of_type("purchase").alias("Recovered"),
            of_type("signup").alias("New cases"),
            of_type("view").alias("New deaths"),
            of_type("click").alias("New recovered"),
        )
    )
    deaths, recovered = F.col("Deaths"), F.col("Recovered")
    return counted.select(
        "Country/Region",
        "Confirmed",
        "Deaths",
        "Recovered",
        (F.col("Confirmed") - deaths - recovered).alias("Active"),
        "New cases",
        "New deaths",
        "New recovered",
        F.round(100 * deaths / F.col("Confirmed"), 2).alias("Deaths / 100 Cases"),
        F.round(100 * recovered / F.col("Confirmed"), 2).alias("Recovered / 100 Cases"),
        F.when(recovered == 0, F.lit("inf"))
        .otherwise(F.round(100 * deaths / F.greatest(recovered, F.lit(1)), 2).cast("string"))
        .alias("Deaths / 100 Recovered"),
        (F.col("Confirmed") - F.col("New cases")).alias("Confirmed last week"),
        F.col("New cases").alias("1 week change"),
        F.lit(None).cast("double").alias("1 week % increase"),
        F.lit("All").alias("WHO Region"),
    )


def _row(kind, *columns):
    return F.concat_ws(" ", F.lit(kind), *[F.col(name) for name in columns])


def _name(kind, column):
    return F.concat(F.lit(f"{kind}-"), F.col(column))


def _path(kind, column):
    return F.concat(F.lit(f"data/{kind}/"), F.col(column))


# kind of row, its table and its key
PRODUCING = [
    ("region", "region", "r_regionkey"),
    ("nation", "nation", "n_nationkey"),
    ("customer", "customer", "c_custkey"),
    ("supplier", "supplier", "s_suppkey"),
    ("part", "part", "p_partkey"),
    ("order", "orders", "o_orderkey"),
]


def row_outputs(spark, sf_dir):
    """outputs(task, name, path): each row that others refer to declares itself as a dataset."""

    def of_table(kind, source, key):
        return table(spark, sf_dir, source, f"{key} long").select(
            _row(kind, key).alias("task"),
            _name(kind, key).alias("name"),
            _path(kind, key).alias("path"),
        )

    return reduce(lambda a, b: a.unionAll(b), [of_table(*row) for row in PRODUCING])


def row_consumers(spark, sf_dir):
    """consumers(task, dataset): the rows a row's foreign keys name, some by name, some by path."""

    def of_table(source, columns, task, *inputs):
        return table(spark, sf_dir, source, columns).select(
            task.alias("task"), F.explode(F.array(*inputs)).alias("dataset")
        )

    return reduce(
        lambda a, b: a.unionAll(b),
        [
            of_table(
                "nation",
                NATION_COLUMNS,
                _row("nation", "n_nationkey"),
                _name("region", "n_regionkey"),
            ),
            of_table(
                "customer",
                CUSTOMER_COLUMNS,
                _row("customer", "c_custkey"),
                _path("nation", "c_nationkey"),
            ),
            of_table(
                "supplier",
                SUPPLIER_COLUMNS,
                _row("supplier", "s_suppkey"),
                _path("nation", "s_nationkey"),
            ),
            of_table(
                "orders",
                ORDER_COLUMNS,
                _row("order", "o_orderkey"),
                _name("customer", "o_custkey"),
            ),
            of_table(
                "lineitem",
                LINE_COLUMNS,
                _row("line", "l_orderkey", "l_linenumber"),
                _path("order", "l_orderkey"),
                _name("part", "l_partkey"),
                _name("supplier", "l_suppkey"),
            ),
        ],
    )


def row_tasks(spark, sf_dir):
    """tasks(task, inputs, outputs): every row reads the rows its keys name and declares itself."""

    def of_table(kind, source, key, *inputs, number=None):
        columns = [key, *([number] if number else []), *[column for _, column in inputs]]
        types = ", ".join(f"{name} {'int' if name == number else 'long'}" for name in dict.fromkeys(columns))
        read = F.array(*[_path(other, column) for other, column in inputs])
        own = [key, number] if number else [key]
        of_row = F.concat_ws("-", F.lit(kind), *own)
        declared = F.struct(of_row.alias("name"), F.concat(F.lit("data/rows/"), of_row).alias("path"))
        if not number:
            declared = F.struct(_name(kind, key).alias("name"), _path(kind, key).alias("path"))
        return table(spark, sf_dir, source, types).select(
            _row(kind, *own).alias("task"),
            read.cast("array<string>").alias("inputs"),
            F.array(declared).alias("outputs"),
        )

    return reduce(
        lambda a, b: a.unionAll(b),
        [
            of_table("region", "region", "r_regionkey"),
            of_table("nation", "nation", "n_nationkey", ("region", "n_regionkey")),
            of_table("customer", "customer", "c_custkey", ("nation", "c_nationkey")),
            of_table("supplier", "supplier", "s_suppkey", ("nation", "s_nationkey")),
            of_table("part", "part", "p_partkey"),
            of_table("order", "orders", "o_orderkey", ("customer", "o_custkey")),
            of_table(
                "line",
                "lineitem",
                "l_orderkey",
                ("order", "l_orderkey"),
                ("part", "l_partkey"),
                ("supplier", "l_suppkey"),
                number="l_linenumber",
            ),
        ],
    )


def order_outputs(spark, sf_dir):
    """outputs(task, name, path): an order delivers a part of a supplier with each line; open lines
    have no place yet."""
    place = F.concat(_path("part", "l_partkey"), F.lit("/"), F.col("l_suppkey"))
    return table(spark, sf_dir, "lineitem", LINE_COLUMNS).select(
        F.col("l_orderkey").alias("task"),
        _name("part", "l_partkey").alias("name"),
        F.when(F.col("l_linestatus") == "F", place).alias("path"),
    )


def stock_lineage(spark, sf_dir, status):
    """(task, dataset): orders with a line of that status on a part of a supplier.

    Finished lines put the part on stock, open lines take it.
    """
    return (
        table(spark, sf_dir, "lineitem", LINE_COLUMNS)
        .where(F.col("l_linestatus") == status)
        .select(
            F.col("l_orderkey").alias("task"),
            F.concat_ws("/", "l_partkey", "l_suppkey").alias("dataset"),
        )
    )


def part_lineage(spark, sf_dir, status):
    """(task, dataset): customers and the parts of their large lines of that status."""
    lines = table(spark, sf_dir, "lineitem", LINE_COLUMNS + ", l_quantity double")
    large = lines.where((F.col("l_linestatus") == status) & (F.col("l_quantity") >= 45))
    orders = table(spark, sf_dir, "orders", ORDER_COLUMNS).withColumnRenamed("o_orderkey", "l_orderkey")
    return large.join(orders, "l_orderkey").select(F.col("o_custkey").alias("task"), F.col("l_partkey").alias("dataset"))


def trade(spark, sf_dir):
    """Edges (src, dst) from the nation of an order's customer to that of a line's supplier.

    Lines are reduced to distinct (order, nation) pairs inside the map tasks before they move.
    """
    suppliers = table(spark, sf_dir, "supplier", SUPPLIER_COLUMNS).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dst")
    )
    customers = table(spark, sf_dir, "customer", CUSTOMER_COLUMNS).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("src")
    )
    orders = table(spark, sf_dir, "orders", ORDER_COLUMNS).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    sold = table(spark, sf_dir, "lineitem", LINE_COLUMNS).select("l_orderkey", "l_suppkey")
    supplied = sold.join(suppliers, "l_suppkey").select("l_orderkey", "dst").distinct()
    bought = orders.join(customers, "o_custkey").select("l_orderkey", "src")
    return supplied.join(bought, "l_orderkey").select("src", "dst").distinct()


def net_trade(spark, sf_dir):
    """Edges (src, dst) between nations: src's suppliers deliver more lines to dst than the other way."""
    suppliers = table(spark, sf_dir, "supplier", SUPPLIER_COLUMNS).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("src")
    )
    customers = table(spark, sf_dir, "customer", CUSTOMER_COLUMNS).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dst")
    )
    orders = table(spark, sf_dir, "orders", ORDER_COLUMNS).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    sold = table(spark, sf_dir, "lineitem", LINE_COLUMNS).select("l_orderkey", "l_suppkey")
    bought = orders.join(customers, "o_custkey").select("l_orderkey", "dst")
    pairs = sold.join(suppliers, "l_suppkey").join(bought, "l_orderkey").where("src <> dst")
    low, high = F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high")
    balance = F.sum(F.when(F.col("src") < F.col("dst"), 1).otherwise(-1)).alias("balance")
    net = pairs.groupBy(low, high).agg(balance).where("balance <> 0")
    up = F.col("balance") > 0
    return net.select(
        F.when(up, F.col("low")).otherwise(F.col("high")).alias("src"),
        F.when(up, F.col("high")).otherwise(F.col("low")).alias("dst"),
    )

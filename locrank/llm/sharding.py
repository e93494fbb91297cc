"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a tuple of subset sums, one per shard. Differencing takes the two with the
largest spread and adds them in opposite order, largest subset to smallest, until one is left;
undoing the combinations from the last to the first tells the shard of every unit.

Groups larger than 1 / UNITS of all bytes are units of their own, so there are fewer than UNITS of
them. The others are gathered into UNITS bundles by the hash of their key. Differencing thus sees
the exact sizes of at most 2 x UNITS units whatever the size of the corpus, and large groups meet
enough small units to level them out.
"""

import heapq

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import Window

from locrank.llm.words import keep

#: Groups with more than this share of all bytes are placed one by one; the others in as many bundles.
UNITS = 8192


def differencing(sizes, shards):
    """The shard of every unit with these sizes, so that the sums per shard are nearly equal."""
    if len(sizes) == 0:
        return np.empty(0, np.int64)
    order = np.argsort(-np.asarray(sizes, np.int64), kind="stable")
    # A node is a leaf with its size in the first place, or two nodes and how their places were sorted.
    nodes, heap = [], []
    for at in order:
        sums = np.zeros(shards, np.int64)
        sums[0] = sizes[at]
        heap.append((-int(sizes[at]) if shards > 1 else 0, len(nodes), sums))
        nodes.append(int(at))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        joint = left + right[::-1]
        places = np.argsort(-joint, kind="stable")
        joint = joint[places]
        heapq.heappush(heap, (int(joint[-1] - joint[0]), len(nodes), joint))
        nodes.append((a, b, places))
    found = np.empty(len(sizes), np.int64)
    stack = [(len(nodes) - 1, np.arange(shards))]
    while stack:
        node, shard = stack.pop()
        if isinstance(nodes[node], int):
            found[nodes[node]] = shard[0]
            continue
        a, b, places = nodes[node]
        before = np.empty(shards, np.int64)
        before[places] = shard
        stack += [(a, before), (b, before[::-1])]
    return found


def _place(shards):
    def place(frames):
        import pandas as pd

        units = list(frames)
        if units:
            units = pd.concat(units).sort_values(["large", "unit"], kind="stable")
            units["shard"] = differencing(units["bytes"].to_numpy(), shards).astype(np.int32)
            yield units

    return place


def sharded(rows, size, group, shards=24, units=UNITS):
    """rows with shard and slot: every row in one of the shards 0, 1, ..., with nearly equal sums of size.

    size is an expression for a row's bytes, group one for a 64-bit key; rows of equal key share a
    shard. slot counts the rows of a shard from 0 without gaps. No sum per shard is further from the
    others than the largest group, and in general they differ by far less.

    * A null size is 0; null keys are one group, that of key -1.
    * Repeated rows are rows of their own. A group larger than a shard's share still is not divided,
      so its shard is the largest and the others share the rest.
    * No rows give no row. Columns of rows named shard or slot are replaced, all others stay.

    Sizes and rows per group are combined in the map tasks; one task sees 2 x units units at most.
    A group's rows are numbered in as many parts as its share of all rows asks for.
    """
    spark = rows.sparkSession
    names = [name for name in rows.columns if name not in ("shard", "slot")]
    sized = rows.select(
        F.struct(*names).alias("row"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        F.coalesce(group.cast("long"), F.lit(-1)).alias("key"),
        F.monotonically_increasing_id().alias("number"),
    )
    # Written once, so that every job reads the same numbers.
    sized = keep(sized, "shards-rows")
    totals = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    groups = sized.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    groups = groups.withColumn("large", F.col("bytes") > totals.bytes // units)
    unit = F.when(F.col("large"), F.col("key")).otherwise(F.pmod("key", F.lit(units))).alias("unit")
    summed = groups.groupBy("large", unit).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    placed = summed.repartition(1).mapInPandas(_place(shards), "large boolean, unit long, bytes long, rows long, shard int")
    before = Window.partitionBy("shard").orderBy("large", "unit").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    parts = F.ceil(F.col("rows") * tasks / F.lit(max(1, totals.rows))).cast("int")
    placed = keep(placed.select("large", "unit", "shard", "first", parts.alias("parts")), "shards-units")

    # Fewer than 2 x units rows, by construction.
    own = placed.where("large").select(F.col("unit").alias("key"), F.struct("shard", "first", "parts").alias("own"))
    bundles = placed.where("not large").select(F.col("unit").alias("bundle"), F.struct("shard", "first", "parts").alias("shared"))
    found = sized.join(F.broadcast(own), "key", "left").withColumn("bundle", F.pmod("key", F.lit(units)))
    found = found.join(F.broadcast(bundles), "bundle", "left").withColumn("large", F.col("own").isNotNull())
    place = F.coalesce("own", "shared")
    unit = F.when(F.col("large"), F.col("key")).otherwise(F.col("bundle"))
    found = found.select("row", "number", "large", unit.alias("unit"), place.alias("place"))
    found = found.withColumn("part", F.pmod(F.xxhash64("number"), F.col("place.parts")))

    # At most one row per unit and one more per share of a task.
    part = ["large", "unit", "part"]
    counted = found.groupBy(*part).agg(F.count("*").alias("rows"), F.first("place.first").alias("first"))
    earlier = Window.partitionBy("large", "unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("first") + F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    starts = keep(counted.select(*part, start.alias("start")), "shards-parts")
    order = F.row_number().over(Window.partitionBy(*part).orderBy("number")) - 1
    slots = found.withColumn("order", order).join(F.broadcast(starts), part)
    return slots.select("row.*", F.col("place.shard").alias("shard"), (F.col("start") + F.col("order")).alias("slot"))


def op11_sharding(spark, sf_dir):
    """All documents in 24 shards of nearly equal bytes; equal texts share a shard."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group_key"),
    )
    found = sharded(rows, F.col("size"), F.col("group_key"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)

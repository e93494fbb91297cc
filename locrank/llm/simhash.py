"""SimHash near-duplicates found with covering locality-sensitive hashing.

A fingerprint has 64 bits. Every bit position gets a random non-zero word of radius + 1 bits, and
each of the 2^(radius + 1) - 1 non-zero words v gives a mask: the positions whose word has an odd
number of bits in common with v. Two fingerprints that differ in at most `radius` positions differ
in none of the positions of at least one mask, because at most `radius` words leave a non-zero v
orthogonal to all of them. So fingerprints are put into one bucket per mask, and every pair within
the radius meets, without exception; the distance itself is checked before a pair is linked.
"""

import random
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from locrank.llm.components import components
from locrank.llm.words import column_bytes, give_back, keep, spaced_words, whole_rows

#: Fingerprints per side of one comparison task in a bucket that needs pairs compared.
BLOCK = 4096

_SEED = 42


def covering_masks(radius, seed=7):
    """2^(radius + 1) - 1 masks as signed 64-bit numbers."""
    draw = random.Random(seed)
    words = [draw.randrange(1, 2 ** (radius + 1)) for _ in range(64)]
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << bit for bit, word in enumerate(words) if (word & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def fingerprint(text, size):
    """SimHash of UTF-8 text as a signed 64-bit number; without words it is zero."""
    words = spaced_words(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        shingles = [joined]
    else:
        ends = np.cumsum([len(word) + 1 for word in words])
        starts = [0, *ends[:-size].tolist()]
        shingles = [joined[a:b] for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]
    totals = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 65536):
        part = shingles[at : at + 65536]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(_SEED)), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * totals > len(shingles), bitorder="little").view(np.int64)
    return int(value[0])


def fingerprints(docs, size=4):
    """doc_id, text_key, fp for every row of docs(doc_id, text)."""

    def scan(batches):
        for batch in batches:
            prints = [fingerprint(text, size) for text in column_bytes(batch, "text")]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "fp"])
        give_back()

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(scan, f"doc_id {kind}, text_key long, fp long")


def _apart(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _spanning(prints, far, near, radius):
    """Links that connect what the far fingerprints connect, at most one less than fingerprints.

    prints: distinct; far: indexes to compare with all others; near: indexes that are connected already.
    """
    label = np.arange(len(prints))
    if len(near):
        label[near] = near[0]
    for i in far:
        close = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius)
        groups, first = np.unique(label[close], return_index=True)
        if len(groups) > 1:
            yield from ((int(prints[i]), int(prints[close[k]])) for k, g in zip(first, groups) if g != label[i])
            label[np.isin(label, groups)] = groups[0]


def _compare(radius):
    """Rows sorted by (bucket, q, b): links between the far rows of block q and all rows of block b."""

    def links(fp, is_far, is_query):
        prints, at = np.unique(fp, return_inverse=True)
        queries = np.unique(at[is_query])
        near = np.unique(at[~is_far])
        return list(_spanning(prints, queries, near, radius))

    def scan(batches):
        held = None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("bucket", "q", "b", "fp", "is_far", "is_query")]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            bucket, q, b = columns[:3]
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (q[1:] != q[:-1]) | (b[1:] != b[:-1])) + 1
            bounds = [0, *cuts.tolist()]
            out = []
            for start, end in zip(bounds, bounds[1:]):
                out += links(*(column[start:end] for column in columns[3:]))
            held = [column[bounds[-1] :] for column in columns]
            yield _links_batch(out)
        if held is not None:
            yield _links_batch(links(*held[3:]))

    return scan


def _links_batch(pairs):
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(weights, radius=4, block=BLOCK):
    """(a, b): links between distinct fingerprints that join all pairs within the radius.

    weights(fp, n): distinct fingerprints and their numbers of documents. In each bucket the
    fingerprint of most documents is the pivot, and whatever lies within the radius of it is linked
    to it: one comparison per row. Only fingerprints further away are compared with the others of
    the bucket, block by block, and each comparison returns a spanning forest, not all pairs. A
    bucket of any size is therefore split over tasks of at most 2 x block rows, and no link that
    decides about a component is lost.
    """
    keys = [F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(mask))) for t, mask in enumerate(covering_masks(radius))]
    placed = weights.select("fp", "n", F.explode(F.array(*keys)).alias("bucket"))
    # Ties between equal numbers of documents are broken by the fingerprint.
    rank = F.col("n") + F.col("fp").bitwiseAND(F.lit(0xFFFFFF)) / float(1 << 24)
    pivots = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.max_by("fp", rank).alias("pivot"))
    pivots = keep(pivots.where("size > 1"), "simhash-pivots")
    # Pivots grow with the corpus: a merge join at every size, whose hot buckets Spark splits.
    members = placed.select("bucket", "fp").join(pivots.hint("merge"), "bucket")
    members = keep(members.withColumn("is_far", _apart("fp", "pivot") > radius), "simhash-members")

    to_pivot = members.where("not is_far and fp <> pivot").select(F.col("fp").alias("a"), F.col("pivot").alias("b"))
    # A bucket of two has been compared; so has one without far fingerprints.
    open_buckets = members.where("is_far and size > 2").select("bucket").distinct()
    rows = members.join(keep(open_buckets, "simhash-open"), "bucket")
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = rows.select("bucket", "fp", "is_far", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).alias("own"))
    # Far rows ask all blocks; the others are sent only to the blocks that have far rows.
    rows = keep(rows, "simhash-rows")
    asked = rows.where("is_far").select("bucket", F.col("own").cast("long").alias("q")).distinct()
    tested = rows.join(asked, "bucket").select(
        "bucket", "q", F.col("own").cast("long").alias("b"), "fp", "is_far", F.lit(False).alias("is_query")
    )
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    asking = rows.where("is_far").select(
        "bucket", F.col("own").cast("long").alias("q"), blocks.alias("b"), "fp", "is_far", F.lit(True).alias("is_query")
    )
    both = tested.unionAll(asking.select(*tested.columns))
    dealt = both.repartition("bucket", "q", "b").sortWithinPartitions("bucket", "q", "b")
    return to_pivot.unionAll(dealt.mapInArrow(_compare(radius), "a long, b long")).distinct()


def near_duplicates(docs, size=4, radius=4, block=BLOCK):
    """doc_id, text_key, fp, root, component_id for every row of docs(doc_id, text).

    Fingerprints differing in at most `radius` bits are linked; component_id is the smallest doc_id
    among the documents whose fingerprints are connected, root the smallest such fingerprint.

    * Null and empty texts have the fingerprint zero and are linked like any other.
    * Repeated rows share a fingerprint and give as many rows. A null doc_id is never the smallest;
      a component without any doc_id has a null component_id.
    * Empty docs give no row; other columns are ignored.
    """
    prints = keep(fingerprints(docs, size), "simhash-prints")
    weights = keep(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), "simhash-weights")
    found = components(links(weights, radius, block), "simhash-labels")
    found = found.select(F.col("vertex").alias("fp"), F.col("component").alias("root"))
    rooted = weights.join(found, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = keep(rooted, "simhash-roots")
    first = keep(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-first")
    return prints.join(keep(rooted.join(first, "root").select("fp", "root", "component_id"), "simhash-classes"), "fp")


def one_of_each(docs, size=4, radius=4):
    """The row with the smallest doc_id of each component of near-duplicates, in all its columns.

    Rows without a doc_id go if their component has one with; else one of them stays. Of repeated
    rows of the doc_id that stays, one stays.
    """
    classes = near_duplicates(docs, size, radius)
    chosen = classes.where("doc_id <=> component_id")
    chosen = keep(chosen.groupBy("doc_id", "text_key", "root").agg(F.count("*").alias("rows")), "simhash-chosen")
    repeated = not chosen.groupBy("doc_id", "root").agg(F.sum("rows").alias("rows")).where("rows > 1").isEmpty()
    rows = whole_rows(docs).withColumn("key", F.xxhash64("row.text"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    kept = rows.join(chosen.select("doc_id", "text_key", "root"), same)
    kept = kept.dropDuplicates(["doc_id", "root"]) if repeated else kept
    return kept.select("row.*")


def op2_simhash(spark, sf_dir):
    """Fingerprint and component of each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    classes = near_duplicates(docs)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return classes.select("doc_id", hexed.alias("fingerprint"), "component_id")

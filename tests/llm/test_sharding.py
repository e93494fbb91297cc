import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from locrank.llm.sharding import differencing, op11_sharding, sharded


def spread(sizes, found, shards):
    sums = np.bincount(found, weights=sizes, minlength=shards)
    return int(sums.max() - sums.min())


def greedy(sizes, shards):
    """Largest unit first, each into the smallest shard."""
    sums = [0] * shards
    for size in sorted(sizes, reverse=True):
        sums[sums.index(min(sums))] += size
    return max(sums) - min(sums)


def by_hand(sizes, shards):
    """Differencing over lists of sets."""
    parts = [[(s, [i])] + [(0, []) for _ in range(shards - 1)] for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: max(s for s, _ in p) - min(s for s, _ in p))
        a, b = parts.pop(), parts.pop()
        a, b = sorted(a, key=lambda x: -x[0]), sorted(b, key=lambda x: x[0])
        parts.append([(x + y, m + n) for (x, m), (y, n) in zip(a, b)])
    sums = [s for s, _ in parts[0]]
    return max(sums) - min(sums)


def test_differencing_of_known_sizes():
    assert spread([8, 7, 6, 5, 4], differencing([8, 7, 6, 5, 4], 2), 2) == 2
    assert sorted(differencing([5, 5, 5], 3).tolist()) == [0, 1, 2]
    assert differencing([], 4).tolist() == [] and differencing([3, 1], 1).tolist() == [0, 0]


def test_differencing_equals_a_plain_form_and_beats_the_greedy_one():
    draw = random.Random(1)
    closer = 0
    for _ in range(30):
        shards = draw.randint(2, 5)
        sizes = draw.sample(range(1, 10**6), draw.randint(1, 60))
        found = spread(sizes, differencing(sizes, shards), shards)
        assert found == by_hand(sizes, shards)
        closer += found <= greedy(sizes, shards)
    assert closer >= 25


def check(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert set(slots) <= set(range(shards))


def test_edge_cases_and_clashing_names(spark, frame, edge_cases):
    docs = frame(edge_cases).withColumns({name: F.lit(7) for name in ("row", "number", "unit", "shard", "slot", "large", "size")})
    found = sharded(docs, F.octet_length("text"), F.xxhash64("text"), shards=3)
    assert set(found.columns) == set(docs.columns)
    rows = found.collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(d) for d, _ in edge_cases)
    check(rows, 3)
    assert len({r.shard for r in rows if r.doc_id == 4}) == 1
    assert sharded(frame([]), F.octet_length("text"), F.xxhash64("text")).count() == 0
    assert {r.shard for r in sharded(docs, F.lit(None), F.lit(None), shards=3).collect()} == {0}


def test_a_third_of_all_rows_are_copies(spark):
    draw = random.Random(3)
    rows = [(n, "copy", 10) if n % 3 == 0 else (n, f"t{n}", draw.randint(1, 400)) for n in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bytes long").repartition(16)
    found = sharded(docs, F.col("bytes"), F.xxhash64("text"), shards=4, units=1024).collect()
    check(found, 4)
    assert len(found) == 9000 and len({r.shard for r in found if r.text == "copy"}) == 1
    sums = defaultdict(int)
    for r in found:
        sums[r.shard] += r.bytes
    assert max(sums.values()) - min(sums.values()) <= 300  # of about 300,000
    again = sharded(docs, F.col("bytes"), F.xxhash64("text"), shards=4, units=1024).collect()
    assert {(r.doc_id, r.shard) for r in again} == {(r.doc_id, r.shard) for r in found}


def test_a_group_larger_than_a_share_stays_together(spark):
    rows = [(n, "hot" if n < 500 else f"t{n}") for n in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharded(docs, F.lit(10), F.xxhash64("text"), shards=5).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r.shard] += 1
    assert sorted(sizes.values()) == [125, 125, 125, 125, 500]


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check(rows, 24)
    homes, sums = defaultdict(set), [0] * 24
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        homes[docs[r.doc_id]].add(r.shard)
        sums[r.shard] += r.size
    assert all(len(found) == 1 for found in homes.values())
    groups = defaultdict(int)
    for r in rows:
        groups[docs[r.doc_id]] += r.size
    # A few groups exceed a share; the other shards are level.
    rest = sorted(sums)[: 24 - sum(size > sum(sums) / 24 for size in groups.values())]
    assert rest[-1] - rest[0] <= 0.02 * rest[0]

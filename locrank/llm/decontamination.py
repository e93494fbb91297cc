"""Benchmark decontamination by Wu-Manber search for many patterns at once.

Symbols are words. A pattern is a window of consecutive words of a benchmark item; patterns of one
length share a table. While the end of the search window rests on a block of two words, the shift
table says how far it may move without skipping an occurrence; only where the shift is zero does a
bucket, chosen by the block at the end and the block at the start, name patterns to compare.
"""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from locrank import storage
from locrank.llm.words import alphanumeric_words, column_bytes, give_back, keep, utf8

#: Words of benchmark text whose patterns are searched in one pass and sent to the executors, about
#: 100 MB of tables. Larger benchmarks take several passes over the documents, one after the other;
#: the tables of a pass are released before the next.
BLOCK_WORDS = 500_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SCANNED = "doc_id {id}, text_key long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def shift_table(patterns):
    """(length, shift, buckets) for patterns: tuple of words -> item ids; all tuples of one length."""
    length = len(next(iter(patterns)))
    block = min(2, length)
    shift, buckets = {}, {}
    for words, items in patterns.items():
        for end in range(block, length + 1):
            key = words[end - block : end]
            shift[key] = min(shift.get(key, length), length - end)
        heads = buckets.setdefault(words[-block:], {})
        heads.setdefault(words[:block], []).append((list(words), sorted(items)))
    return length, shift, buckets


def occurrences(table, words):
    """(start, item ids) of every occurrence of a table's patterns in a list of words."""
    length, shifts, buckets = table
    block = min(2, length)
    shift, skip, end, n = shifts.get, length - block + 1, length, len(words)
    while end <= n:
        tail = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
        move = shift(tail, skip)
        if move:
            end += move
            continue
        start = end - length
        head = tuple(words[start : start + block])
        for pattern, items in buckets[tail].get(head, ()):
            if words[start:end] == pattern:
                yield start, items
        end += 1


def shift_tables(rows, window):
    """Tables for the windows of (item id, text) rows; a shorter item is one window, none has none."""
    by_length = {}
    for item, text in rows:
        words = tuple(alphanumeric_words((text or "").encode()))
        size = min(window, len(words))
        for start in range(len(words) - size + 1) if words else ():
            by_length.setdefault(size, {}).setdefault(words[start : start + size], set()).add(str(item))
    return [shift_table(by_length[size]) for size in sorted(by_length)]


def merged(spans):
    """Disjoint spans in order that cover the same words."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _scan(tables, schema):
    def scan(batches):
        found = tables.value
        for batch in batches:
            counts, spans, items = [], [], []
            for text in column_bytes(batch, "text"):
                words = alphanumeric_words(text)
                hits, names = [], set()
                for table in found:
                    for start, ids in occurrences(table, words):
                        hits.append((start, start + table[0]))
                        names.update(ids)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(hits)])
                items.append(sorted(names))
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64())]
            columns += [pa.array(spans, schema.field("spans").type), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        give_back()

    return scan


def _pieces(item, text, window, block_words):
    """An item, or for one longer than a block overlapping pieces of it that have the same windows."""
    starts = [m.start() for m in _WORD.finditer(text)] if len(text) // 5 >= block_words else []
    if len(starts) <= max(block_words, window):
        yield item, text
        return
    for at in range(0, len(starts) - window + 1, block_words):
        end = at + block_words + window - 1
        yield item, text[starts[at] : starts[end] if end < len(starts) else None]


def _blocks(benchmark, window, block_words):
    block, size, some = [], 0, False
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        for piece in _pieces(row.item_id, row.text, window, block_words):
            block.append(piece)
            size += len(piece[1]) // 5 + 1
            if size >= block_words:
                yield block
                block, size, some = [], 0, True
    if block or not some:
        yield block


def _passes(spark, benchmark, window, block_words):
    """The tables of each block as a broadcast, and whether it is the last."""
    blocks = _blocks(benchmark, window, block_words)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        yield spark.sparkContext.broadcast(shift_tables(block, window)), following is None
        block = following


def benchmark_hits(docs, benchmark, window=10, block_words=BLOCK_WORDS):
    """One row per row of docs(doc_id, text): doc_id, text_key, n_words, spans, items.

    spans are disjoint word ranges covered by occurrences of windows of benchmark(item_id, text),
    items the sorted ids (as strings) of the items whose windows occur. Other columns are ignored.

    * A null or empty text has no words and no spans; a benchmark text without words has no window.
    * An empty benchmark gives every document without spans, empty docs give no row.
    * Repeated rows of docs give as many rows, also where doc_id is null; items of one id count as one.

    The benchmark is read in blocks of a bounded number of words, and each block is searched in all
    documents without a shuffle; with several blocks each pass writes what it finds and releases its
    tables. Only the results of several blocks are brought together, by
    document; a document's row holds at most its own words.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    layout = SCANNED.format(id=kind)
    schema = _arrow_schema(spark, layout)
    found, passes = None, 0
    for tables, last in _passes(spark, benchmark, window, block_words):
        hits = base.mapInArrow(_scan(tables, schema), layout)
        if not (last and passes == 0):
            hits = keep(hits, "benchmark-hits")
            tables.destroy()
        found, passes = hits if found is None else found.unionAll(hits), passes + 1
    return found if passes == 1 else _together(found, passes)


def _together(found, passes):
    """Rows of several passes over the documents as one row per document and copy of it."""
    ends = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<start:long,end:long>>)"),
        lambda done, span: F.when(
            (F.size(done) > 0) & (span["start"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], span["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(span))),
    )
    grouped = found.groupBy("doc_id", "text_key", "n_words").agg(
        ends.alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count("*") / passes).cast("int").alias("copies"),
    )
    each = F.explode(F.sequence(F.lit(1), "copies"))
    return grouped.withColumn("copies", each).drop("copies")


def _arrow_schema(spark, layout):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(layout))


def with_hit_counts(hits):
    """hits plus n_hit, n_items, items_sha256 and contaminated (at least one word is covered)."""
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort("items"), ",")
    return hits.withColumns(
        {
            "n_hit": covered,
            "n_items": F.size("items").cast("long"),
            "items_sha256": F.sha2(names.cast("binary"), 256),
            "contaminated": F.size("spans") > 0,
        }
    )


def _holds_window(tables):
    """A function of a text: whether a pattern of the tables occurs in it. Only the text is sent to Python."""

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        found = tables.value
        parts = (texts.slice(at, 512) for at in range(0, len(texts), 512))
        words = (alphanumeric_words(text) for part in parts for text in utf8(part))
        held = pa.array([any(next(occurrences(table, w), None) for table in found) for w in words], pa.bool_())
        give_back()
        return held

    return holds


def without_contaminated(docs, benchmark, window=10, block_words=BLOCK_WORDS):
    """The rows of docs without any window of the benchmark, in all their columns.

    The scan that finds a window drops the row, so nothing is shuffled. With several blocks each
    pass but the last writes what it leaves, and what the pass before wrote is removed.
    """
    spark, at = docs.sparkSession, None
    for tables, last in _passes(spark, benchmark, window, block_words):
        docs = docs.where(~_holds_window(tables)("text"))
        if not last:
            done = storage.scratch_dir(spark, "clean")
            docs = storage.keep(docs, "clean", done)
            tables.destroy()
            if at:
                storage.delete(spark, at)
            at = done
    return docs


def op1_decontamination(spark, sf_dir):
    """Words of each document inside 10-word windows of the benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = with_hit_counts(benchmark_hits(docs, benchmark))
    return hits.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_SQL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS s
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM windows))),
found AS (SELECT doc_id, item_id, i, l FROM places JOIN windows USING (l, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM found) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

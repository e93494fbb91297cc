"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

Strings of `size` bytes that occur at several places are found in three steps.

1. Every string is put under its minimizer: of the hashes of its 32-byte grams the smallest, the
   leftmost of equal ones. It depends on the string alone, so equal strings lie under one key.
   Neighbouring strings of one key form a snippet. A key of a single gram cannot hold a repeat.
2. Snippets of one key are brought together as distinct texts, so copies cost one row per task. A
   text with several copies is repeated as a whole.
3. What is left, distinct texts that share a key, is dealt out by key in shards. Each shard is
   suffix-sorted by itself into a Burrows-Wheeler transform, and the transforms are merged by
   iterative interleave refinement: a stable sort of the interleave by the preceding gram extends
   the context that it is sorted by, until it is `size` bytes. Boundaries that appear in a step give
   the common prefixes of neighbours; intervals without a boundary are the repeated strings. No
   suffix is sorted again.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from locrank.llm.words import column_bytes, keep

SIZE = 200
#: Bytes of a gram that may be a minimizer, a power of two.
GRAM = 32
#: Bytes of neighbouring texts that are hashed at once; places in them have 20 bits.
BUFFER = 1 << 20
#: Most strings of a snippet, which only periodic text reaches.
MAX_STRINGS = 512
#: Bytes of one shard, and of the shards that are merged at once; up to 2^16, ranks and codes take 16 bits.
SHARD, MERGED = 1 << 14, 60_000
#: Snippet bytes under one key beyond which its strings are compared one by one over all tasks.
HOT_BYTES = 1 << 18
#: Bytes that a refinement step adds to the context at most, a power of two.
STEP = 32

#: Ends a snippet; this byte does not occur in UTF-8.
_SENTINEL = 0xFF
_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(BUFFER - 1)


def _gram_hashes(data, gram):
    """A 64-bit hash of every gram, by doubling its length."""
    hashes, length, factor = _TABLE[data], 1, np.uint64(0x9E3779B97F4A7C15)
    while length < gram:
        hashes = hashes[:-length] * factor + hashes[length:]
        length, factor = 2 * length, factor * factor
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _smallest(values, width):
    """Minimum of every `width` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def snippets(data, starts, ends, size, gram):
    """(key, first string, strings, grams) arrays for the strings of texts data[starts:ends]."""
    nothing = np.zeros(0, np.int64)
    if len(data) < size:
        return nothing, nothing, nothing, nothing
    with np.errstate(over="ignore"):
        hashes = _gram_hashes(data, gram)
    placed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (_smallest(placed, size - gram + 1) & _PLACE).astype(np.int64)
    key = hashes[place].view(np.int64)
    last = ends - size + 1  # first place without a string
    edges = np.concatenate([np.flatnonzero(key[1:] != key[:-1]) + 1, starts, np.maximum(starts, last)])
    edges = np.unique(edges[edges <= len(key)])
    text = np.searchsorted(starts, edges, "right") - 1
    fits = edges < last[text]
    first, after = edges[fits], np.append(edges[1:], len(key))[fits]
    if (after - first).max(initial=0) > MAX_STRINGS:
        parts = -(-(after - first) // MAX_STRINGS)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        after = np.minimum(np.repeat(after, parts), np.repeat(first, parts) + (within + 1) * MAX_STRINGS)
        first = np.repeat(first, parts) + within * MAX_STRINGS
    moves = np.concatenate([[0], np.cumsum(place[1:] != place[:-1])])
    return key[first], first, after - first, moves[after - 1] - moves[first] + 1


def _snippet_rows(size, gram):
    """Snippets of all texts, by documents joined to buffers."""

    def of_buffer(group):
        data = b"".join(text for _, _, text in group)
        ends = np.cumsum([len(text) for _, _, text in group])
        starts = ends - [len(text) for _, _, text in group]
        key, first, strings, grams = snippets(np.frombuffer(data, np.uint8), starts, ends, size, gram)
        view = memoryview(data)
        digests = [xxhash.xxh3_128_digest(view[a : a + n + size - 1]) for a, n in zip(first.tolist(), strings.tolist())]
        digests = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        text = np.searchsorted(starts, first, "right") - 1
        at = first - starts[text] + np.array([at for _, at, _ in group], np.int64)[text]
        row = np.array([row for row, _, _ in group], np.int64)[text]
        return row, key, at, strings, grams, digests[:, 0], digests[:, 1]

    def scan(batches):
        for batch in batches:
            group, held = [], 0
            for row, text in enumerate(column_bytes(batch, "text")):
                # Longer texts are cut into pieces that share all but one byte of a string.
                for at in range(0, max(1, len(text) - size + 1), BUFFER - size + 1):
                    piece = text[at : at + BUFFER]
                    if held + len(piece) > BUFFER:
                        yield to_batch(batch, of_buffer(group))
                        group, held = [], 0
                    if len(piece) >= size:
                        group.append((row, at, piece))
                        held += len(piece)
            if group:
                yield to_batch(batch, of_buffer(group))

    def to_batch(batch, columns):
        row, *rest = columns
        keys = [batch.column(name).take(pa.array(row)) for name in ("doc_id", "text_key")]
        names = ["doc_id", "text_key", "key", "at", "strings", "grams", "h1", "h2"]
        return pa.RecordBatch.from_arrays([*keys, *(pa.array(column, pa.int64()) for column in rest)], names=names)

    return scan


# Shards and their merge


def _narrow(numbers, most):
    return numbers.astype(np.uint16 if most < 1 << 16 else np.uint32)


def _stable_order(codes, most):
    """Stable order of codes up to `most`, by one or two passes over 16 bits."""
    if most < 1 << 16:
        return np.argsort(codes.astype(np.uint16), kind="stable")
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((codes >> 16).astype(np.uint16)[order], kind="stable")]


class Shard:
    """Texts of at least `depth` bytes, each ended by a sentinel, and the order of their rotations."""

    def __init__(self, texts, depth):
        self.data = np.frombuffer(b"".join(text + bytes([_SENTINEL]) for text in texts), np.uint8)
        self.lengths = np.array([len(text) + 1 for text in texts])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.index = np.arange(len(self.data))
        self.place = self.index - np.repeat(self.starts, self.lengths)
        self.length = np.repeat(self.lengths, self.lengths)
        self.order = self._sorted(depth)

    def _sorted(self, depth):
        """Places in the order of their rotations' first `depth` bytes, by prefix doubling.

        Which of equal ones comes first is of no account: they stay in one interval.
        """
        known = 1
        rank = self.data
        while known < depth:
            after = self.index + known - np.where(self.place + known >= self.length, self.length, 0)
            later = rank[after]
            most = int(rank.max())
            order = _stable_order(later, most)
            order = order[_stable_order(rank[order], most)]
            first, second = rank[order], later[order]
            number = np.cumsum(np.concatenate([[0], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
            rank = np.empty(len(order), np.uint16 if number[-1] < 1 << 16 else np.uint32)
            rank[order] = number
            known *= 2
        return order


def _gram_codes(shards, step):
    """A number for the `step` bytes before each place, going round within its text; equal for equal grams.

    Grams of up to 8 bytes are numbered as they are, longer ones by the numbers of their halves.
    """
    data, place, length = (np.concatenate([getattr(s, name) for s in shards]) for name in ("data", "place", "length"))
    index = np.arange(len(data))

    def before(values, back):
        return values[index - back + np.where(place < back, length, 0)]

    known = min(8, step)
    code = np.zeros(len(data), np.uint64)
    for back in range(known, 0, -1):
        code = (code << np.uint64(8)) | before(data, back)
    distinct, code = np.unique(code, return_inverse=True)
    while known < step:
        pair = (before(code, known).astype(np.uint64) << np.uint64(32)) | code.astype(np.uint64)
        distinct, code = np.unique(pair, return_inverse=True)
        known *= 2
    return _narrow(code, len(distinct))


def merged_blocks(shards, depth):
    """(shard, place, block, common) in merged order.

    block numbers the intervals of rotations that agree in their first `depth` bytes. common is the
    context in which the boundary before a rotation appeared, 0 within a block: its common prefix with
    its neighbour is shorter than that, and as long as the context before.
    """
    sizes = [len(shard.order) for shard in shards]
    offsets, total = np.cumsum([0, *sizes]), sum(sizes)
    # For each place in the shards' own orders, one shard after the other.
    places = np.concatenate([shard.order + offset for shard, offset in zip(shards, offsets)])
    source = np.repeat(_narrow(np.arange(len(shards)), len(shards)), sizes)
    source = source.astype(np.uint8) if len(shards) <= 256 else source
    block, common = np.zeros(total, np.int32), np.zeros(total, np.int32)
    done, coded, edge = 0, 0, np.empty(total, bool)
    while done < depth:
        step = min(STEP, 1 << ((depth - done).bit_length() - 1))
        if step != coded:
            # The transform of each shard: the grams before its rotations, in its order.
            transforms, coded = _gram_codes(shards, step)[places], step
            most = int(transforms.max())
        # The transforms read along the interleave, ...
        along = np.empty(total, transforms.dtype)
        along[np.argsort(source, kind="stable")] = transforms
        # ... and a stable sort by what is before a rotation gives the interleave of longer contexts.
        order = _stable_order(along, most)
        moved, before = along[order], block[order]
        edge[0] = True
        np.logical_or(moved[1:] != moved[:-1], before[1:] != before[:-1], out=edge[1:])
        done += step
        source, block = source[order], np.cumsum(edge, dtype=np.int32) - 1
        # Longer contexts divide the intervals where they lie, so a boundary stays where it appeared.
        common[edge & (common == 0)] = done
    merged = np.empty(total, np.int64)
    merged[np.argsort(source, kind="stable")] = np.concatenate([shard.order for shard in shards])
    return source, merged, block, common


def repeated_strings(texts, size, shard_bytes=SHARD):
    """For each of distinct texts the [from, to) ranges of its strings that occur elsewhere in texts."""
    shards, held = [], 0
    for text in texts:
        if not shards or held + len(text) >= shard_bytes:
            shards.append([])
            held = 0
        shards[-1].append(text)
        held += len(text) + 1
    built = [Shard(shard, size) for shard in shards]
    source, place, block, _ = merged_blocks(built, size)
    # Only strings that end before the sentinel count.
    offsets = np.cumsum([0, *(len(shard.data) for shard in built)])
    starts = np.concatenate([shard.starts + offset for shard, offset in zip(built, offsets)])
    lengths = np.concatenate([shard.lengths for shard in built])
    place = place + offsets[source]
    text = np.searchsorted(starts, place, "right") - 1
    inside = place - starts[text] + size < lengths[text]
    twice = np.bincount(block[inside], minlength=1) > 1
    flags = np.zeros(offsets[-1] + 1, bool)
    flags[place[inside]] = twice[block[inside]]
    steps = np.diff(np.concatenate([[False], flags]).astype(np.int8))
    begin, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    ranges = [[] for _ in texts]
    for text, a, b in zip((np.searchsorted(starts, begin, "right") - 1).tolist(), begin.tolist(), end.tolist()):
        ranges[text].append((a - int(starts[text]), b - int(starts[text])))
    return ranges


def _ranges_of_groups(size, merged_bytes):
    """Rows sorted by key: the repeated strings of each text, merging whole keys together."""

    def judged(rows):
        found = repeated_strings([text for *_, text in rows], size) if rows else []
        kept = [(key, h1, h2, [{"from": a, "to": b} for a, b in ranges]) for (key, h1, h2, _), ranges in zip(rows, found)]
        columns = list(zip(*kept)) if kept else [()] * 4
        ranges = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), ranges]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "h1", "h2", "ranges"])

    def scan(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in ("key", "h1", "h2", "snippet"))):
                if row[0] != last and held >= merged_bytes:
                    yield judged(rows)
                    rows, held = [], 0
                rows.append(row)
                held, last = held + len(row[3]), row[0]
        yield judged(rows)

    return scan


def _cut(layout):
    """The snippets wanted of each document."""

    def cut(batches):
        for batch in batches:
            texts = column_bytes(batch, "text")
            out = [
                (w["key"], w["h1"], w["h2"], w["hot"], text[w["at"] : w["at"] + w["bytes"]])
                for text, wanted in zip(texts, batch.column("wanted").to_pylist())
                for w in wanted
            ]
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=layout)

    return cut


def _single_strings(size):
    """A digest of each string of hot snippets."""

    def scan(batches):
        for batch in batches:
            for key, h1, h2, text in zip(*(batch.column(name).to_pylist() for name in ("key", "h1", "h2", "snippet"))):
                count, view = len(text) - size + 1, memoryview(text)
                digests = b"".join([xxhash.xxh3_128_digest(view[a : a + size]) for a in range(count)])
                digests = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = [np.full(count, key), np.full(count, h1), np.full(count, h2), np.arange(count), *digests.T]
                arrays = [pa.array(np.ascontiguousarray(column), pa.int64()) for column in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "h1", "h2", "string", "s1", "s2"])

    return scan


def _same(docs):
    return docs["doc_id"].eqNullSafe(F.col("_doc_id")) & (docs["text_key"] == F.col("_text_key"))


def repeated_ranges(docs, size=SIZE, gram=GRAM, hot_bytes=HOT_BYTES, merged_bytes=MERGED):
    """doc_id, text_key, start, end: byte ranges of docs(doc_id, text_key, text) in repeated strings.

    Ranges of one document may overlap. A document that repeats another row is a place of its own.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    layout = f"doc_id {kind}, text_key long, key long, at long, strings long, grams long, h1 long, h2 long"
    found = keep(docs.mapInArrow(_snippet_rows(size, gram), layout), "snippets")
    several = found.groupBy("key").agg(F.sum("grams").alias("places")).where("places > 1").select("key")
    found = keep(found.join(keep(several, "snippet-keys"), "key"), "snippets-shared")

    # One place stands for all copies of a text; which, does not matter.
    place = ["doc_id", "text_key", "at", "strings", "grams"]
    texts = found.groupBy("key", "h1", "h2").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in place))
    texts = keep(texts, "snippet-texts")
    length = F.col("strings") + size - 1
    keys = texts.groupBy("key").agg(F.count("*").alias("texts"), F.sum(length).alias("key_bytes"))
    keys = keep(keys.where("texts > 1"), "snippet-open")
    texts = texts.join(keys, "key", "left")
    copied = texts.where("copies > 1")
    ranges = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("strings").alias("to")))
    repeated = copied.select("key", "h1", "h2", ranges.alias("ranges"))

    # A single text under its key is open only where it holds several grams of that key itself.
    wanted = texts.where("texts > 1 or (copies = 1 and grams > 1)")
    one = F.struct(
        "key", "h1", "h2", (F.coalesce("key_bytes", F.lit(0)) > hot_bytes).alias("hot"), "at", length.alias("bytes")
    )
    wanted = wanted.groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")).agg(
        F.collect_list(one).alias("wanted")
    )
    rows = docs.join(keep(wanted, "snippets-wanted"), _same(docs)).select("text", "wanted")
    names = ["key", "h1", "h2", "hot", "snippet"]
    cut = keep(rows.mapInArrow(_cut(names), "key long, h1 long, h2 long, hot boolean, snippet binary"), "snippets-cut")

    groups = cut.where("not hot").drop("hot").repartition("key").sortWithinPartitions("key")
    found_ranges = "key long, h1 long, h2 long, ranges array<struct<from:long,to:long>>"
    merged = groups.mapInArrow(_ranges_of_groups(size, merged_bytes), found_ranges)

    hot = cut.where("hot").drop("hot")
    if not hot.isEmpty():
        strings = keep(hot.mapInArrow(_single_strings(size), "key long, h1 long, h2 long, string long, s1 long, s2 long"), "strings")
        twice = keep(strings.groupBy("s1", "s2").agg(F.count("*").alias("n")).where("n > 1").select("s1", "s2"), "strings-twice")
        single = F.collect_list(F.struct(F.col("string").alias("from"), (F.col("string") + 1).alias("to")))
        merged = merged.unionAll(strings.join(twice, ["s1", "s2"]).groupBy("key", "h1", "h2").agg(single.alias("ranges")))

    # A copied text that was merged too is repeated as a whole already; so is all that a repeated row holds.
    merged = merged.where(F.size("ranges") > 0).join(copied.select("key", "h1", "h2"), ["key", "h1", "h2"], "left_anti")
    repeated = keep(repeated.unionAll(merged), "snippet-ranges")
    at = found.select("doc_id", "text_key", "key", "h1", "h2", "at").join(repeated, ["key", "h1", "h2"])
    each = at.select("doc_id", "text_key", "at", F.explode("ranges").alias("r"))
    return each.select(
        "doc_id", "text_key", (F.col("at") + F.col("r.from")).alias("start"), (F.col("at") + F.col("r.to") + size - 1).alias("end")
    )


def _remove(batches):
    """What is left of each text, given its repeated ranges."""
    for batch in batches:
        out = []
        for text, ranges in zip(column_bytes(batch, "text"), batch.column("ranges").to_pylist()):
            spans = []
            for start, end in sorted((r["start"], r["end"]) for r in ranges or ()):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            rest, at = [], 0
            for start, end in spans:
                rest.append(text[at:start])
                at = end
            rest.append(text[at:])
            out.append((len(text), [{"start": a, "end": b} for a, b in spans], b"".join(rest)))
        sizes, spans, kept = zip(*out) if out else ((), (), ())
        ranges_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, ranges_type), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs, size=SIZE, **options):
    """doc_id, n_bytes, spans(start, end), kept for every row of docs(doc_id, text).

    Every byte of the UTF-8 text that lies in a string of `size` bytes that starts anywhere else too,
    in this or another text, is removed; spans are the maximal removed ranges, kept the other bytes.

    * A null text is empty; a text of fewer than `size` bytes keeps all.
    * Repeated rows, with a doc_id or a null one, are separate places, so both lose what they share.
    * Empty docs give no row; other columns are ignored.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = repeated_ranges(docs, size, **options)
    ranges = found.groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")).agg(
        F.collect_list(F.struct("start", "end")).alias("ranges")
    )
    joined = docs.join(ranges, _same(docs), "left").select("doc_id", "text", "ranges")
    kind = dict(docs.dtypes)["doc_id"]
    return joined.mapInArrow(_remove, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op9_suffixes(spark, sf_dir):
    """Bytes of each document outside repeated 200-byte strings."""
    rows = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

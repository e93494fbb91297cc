"""Language-model scores of documents: smoothed word frequencies, and a gated recurrent network.

Words are counted over all training documents. The most frequent ones are symbols of the network;
the others share symbols by their shape, and within a shape they have their smoothed frequencies, so
every word has a probability. The network sees every training document: tasks train on their own
share from the same parameters, and the parameters are averaged after each round.
"""

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from locrank.llm import gru
from locrank.llm.words import keep

#: Words that are symbols, and classes they are put into by frequency.
SYMBOLS, CLASSES = 2048, 32
#: Words whose counts every task holds, 32 MB; counts of rarer ones are joined.
MAX_WORDS = 1 << 21
#: Bytes of text that a task counts or encodes at once, and symbols that it trains on or scores.
COUNTED_BYTES, ENCODED_BYTES, SYMBOLS_AT_ONCE = 16_000_000, 4_000_000, 1_000_000
#: Symbols after which a training document is divided, so that streams are of nearly equal length.
TRAIN_SYMBOLS = 2048
#: Steps of the optimizer in each round; a round has a share of the training documents.
RATES = (0.01, 0.008, 0.005, 0.003)
#: Parameters per row while they are averaged, and rows that one task adds up at first.
CHUNK, BRANCHES = 4096, 64

ALPHA = 0.1
#: Stands for the end of a text; no word holds a line feed.
END = b"\n"
_SHAPES = 8


def shapes(words):
    """What the words of a binary array that are no symbols have in common: last character, length and script."""
    if not len(words):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[: offsets[-1]]
    starts, ends = offsets[:-1], offsets[1:]
    stop = np.isin(data[ends - 1], np.frombuffer(b".,:;!?", np.uint8))
    wide = np.maximum.reduceat(data, starts) >= 0x80
    return stop + 2 * (ends - starts > 6) + 4 * wide


def _numbered(texts):
    """(words, flat, sizes) of a string array: the distinct words, the word numbers of all texts one
    after the other, each text followed by its end, and how many numbers a text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, row = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.not_equal(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    distinct = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END])])
    sizes = np.bincount(row.filter(real).to_numpy(zero_copy_only=False), minlength=len(texts)) + 1
    flat = np.full(sizes.sum(), len(distinct) - 1, np.int32)
    inside = np.ones(len(flat), bool)
    inside[np.cumsum(sizes) - 1] = False
    flat[inside] = coded.indices.to_numpy(zero_copy_only=False)
    return distinct, flat, sizes


def _parts(batch, size):
    """Slices of an Arrow batch with about `size` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def held_out(doc_id):
    """Whether crc32 of the doc_id as text leaves no remainder by 10; a null one is for training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def word_counts(texts):
    """word, shape, n, h of the words and ends of texts(text)."""

    def scan(batches):
        for batch in batches:
            for part in _parts(batch, COUNTED_BYTES):
                words, flat, _ = _numbered(part.column("text"))
                columns = [words.cast(pa.string()), pa.array(shapes(words), pa.int32())]
                columns.append(pa.array(np.bincount(flat, minlength=len(words)), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["word", "shape", "n"])

    rows = texts.mapInArrow(scan, "word string, shape int, n long")
    counts = rows.groupBy("word", "shape").agg(F.sum("n").alias("n"))
    return counts.withColumn("h", F.xxhash64("word"))


class Vocabulary:
    """What the tasks need to know of all words; as large whatever the corpus."""

    def __init__(self, counts, max_words):
        end = F.col("word") == END.decode()
        top = counts.where(~end).orderBy(F.desc("n"), "word").limit(SYMBOLS - 1).collect()
        total = counts.agg(F.sum("n"), F.count("*")).first()
        self.tokens, self.words = total[0] or 0, total[1]
        ends = counts.where(end).first()
        symbols = [(row.n, row.word.encode()) for row in top] + [(ends.n if ends else 0, END)]
        symbols.sort(key=lambda s: (-s[0], s[1]))
        self.symbols = {word: k for k, (_, word) in enumerate(symbols)}
        self.start = self.symbols[END]
        by_shape = {row["shape"]: (row.n, row.words) for row in self._by_shape(counts)}
        mass = [by_shape.get(s, (0, 0)) for s in range(_SHAPES)]
        for (n, _), s in zip(symbols, shapes(pa.array([word for _, word in symbols])).tolist()):
            if n:
                mass[s] = (mass[s][0] - n, mass[s][1] - 1)
        # Each shape has room for one word that was not seen.
        self.mass = np.array([n + ALPHA * (words + 1) for n, words in mass])
        frequency = np.concatenate([[n + ALPHA for n, _ in symbols], self.mass])
        share = np.cumsum(np.sqrt(frequency[: len(symbols)]))
        classes = np.minimum(share / share[-1] * CLASSES, CLASSES - 1).astype(int)
        first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        self.starts = np.concatenate([first, len(symbols) + np.arange(_SHAPES + 1)])
        self.class_of = np.searchsorted(self.starts, np.arange(len(frequency)), "right") - 1
        self.initial = gru.initial(frequency, self.starts)
        self._frequent(counts, max_words)

    @staticmethod
    def _by_shape(counts):
        return counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()

    def _frequent(self, counts, max_words):
        """Hashes and counts of words of at least so many tokens that max_words is not exceeded."""
        self.complete = self.words <= max_words
        frequent = counts
        if not self.complete:
            # Frequencies 1, 2, 4, ...: at most 64 rows, whatever the corpus.
            level = F.floor(F.log2("n")).cast("int")
            levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
            held, least = 0, 64
            for row in levels:
                if held + row.words > max_words:
                    break
                held, least = held + row.words, row.level
            frequent = counts.where(level >= least)
        # Words whose hashes are equal are left to the join.
        table = frequent.select("h", "n").toArrow()
        hashes, n = table.column("h").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(hashes, kind="stable")
        hashes, n = hashes[order], n[order]
        same = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        alone = ~(same | np.concatenate([same[1:], [False]]))[: len(hashes)]
        self.complete &= bool(alone.all())
        self.hashes, self.logs = hashes[alone], np.log10(n[alone] + ALPHA)

    def plain(self):
        """Arrays and dicts only, to be sent to the tasks."""
        names = ["symbols", "start", "mass", "starts", "class_of", "complete", "hashes", "logs"]
        return {name: getattr(self, name) for name in names}


def _look_up(known, words):
    """log10(count + ALPHA) and whether the word is known, for a list of distinct words."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words)).view(np.int64)
    at = np.minimum(np.searchsorted(known["hashes"], hashes), max(0, len(known["hashes"]) - 1))
    found = known["hashes"][at] == hashes if len(known["hashes"]) else np.zeros(len(words), bool)
    if not known["complete"]:
        return np.where(found, known["logs"][at] if len(known["logs"]) else 0.0, 0.0), found
    return np.where(found, known["logs"][at] if len(known["logs"]) else 0.0, np.log10(ALPHA)), found


def encoded(docs, vocabulary):
    """Symbols of every document, sums over the words that tasks know, and the words they do not.

    log_sum adds log10(count + ALPHA) of all tokens, tail_sum that of tokens that are no symbols, less
    log10 of the mass of their shape. Words in rare are missing from both, and from n_known.
    """
    names = ["n_tokens", "n_known", "log_sum", "tail_sum", "symbols", "rare"]

    def unknown(flat, sizes, found, tail, distinct):
        """The words of each document that are not found, with their numbers."""
        at = np.flatnonzero(~found[flat])
        pairs, times = np.unique(np.repeat(np.arange(len(sizes)), sizes)[at] * len(distinct) + flat[at], return_counts=True)
        row, word = np.divmod(pairs, len(distinct))
        words = distinct.take(pa.array(word)).cast(pa.string())
        fields = [words, pa.array(times, pa.int64()), pa.array(tail[word].astype(np.int64))]
        offsets = pa.array(np.searchsorted(row, np.arange(len(sizes) + 1)), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["word", "n", "tail"]))

    def scan(batches):
        known = vocabulary.value
        symbols, mass, base = known["symbols"], np.log10(known["mass"]), len(known["symbols"])
        for batch in batches:
            for rows in _parts(batch, ENCODED_BYTES):
                words, flat, sizes = _numbered(rows.column("text"))
                distinct = words.to_pylist()
                logs, found = _look_up(known, distinct)
                code = np.fromiter(map(symbols.get, distinct, repeat(-1)), np.int64, len(distinct))
                of_shape = shapes(words)
                tail = code < 0
                code = np.where(tail, base + of_shape, code)
                tail_logs = np.where(tail, logs - mass[of_shape], 0.0)
                starts = np.cumsum(sizes) - sizes
                coded, ends = code[flat].astype("<u2"), np.cumsum(sizes)
                asked = np.ones(len(distinct), bool) if known["complete"] else found
                values = [
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat(found[flat].astype(np.int64), starts), pa.int64()),
                    pa.array(np.add.reduceat(logs[flat], starts), pa.float64()),
                    pa.array(np.add.reduceat(tail_logs[flat], starts), pa.float64()),
                    pa.array([coded[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    unknown(flat, sizes, asked, tail, words),
                ]
                keys = [rows.column(name) for name in ("doc_id", "text_key", "held_out")]
                yield pa.RecordBatch.from_arrays([*keys, *values], names=["doc_id", "text_key", "held_out", *names])

    kind = dict(docs.dtypes)["doc_id"]
    layout = (
        f"doc_id {kind}, text_key long, held_out boolean, n_tokens long, n_known long, log_sum double, tail_sum double, "
        "symbols binary, rare array<struct<word:string,n:long,tail:long>>"
    )
    return docs.mapInArrow(scan, layout)


def _documents(batch):
    return [np.frombuffer(symbols, "<u2") for symbols in batch.column("symbols").to_pylist()]


def _portions(documents, size):
    """Runs of documents with about `size` symbols."""
    ends = np.cumsum([len(document) for document in documents])
    start = 0
    while start < len(documents):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield documents[start:end]
        start = end


def _trained(known, parameters, rate):
    """The parameters that a task ends with, weighted by the symbols it has seen, in chunks."""

    def scan(batches):
        words, vector = known.value, parameters.value.copy()
        optimizer, seen = gru.Adam(vector, rate), 0
        for batch in batches:
            pieces = [d[at : at + TRAIN_SYMBOLS] for d in _documents(batch) for at in range(0, len(d), TRAIN_SYMBOLS)]
            for part in _portions(pieces, SYMBOLS_AT_ONCE):
                seen += gru.train(vector, part, words["starts"], words["class_of"], words["start"], optimizer)
        if seen:
            weighted = vector.astype("<f8") * seen
            parts = [weighted[at : at + CHUNK].tobytes() for at in range(0, len(weighted), CHUNK)]
            columns = [range(len(parts)), [TaskContext.get().partitionId() % BRANCHES] * len(parts), [seen] * len(parts), parts]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_SUM)

    return scan


_SUM = ["chunk", "branch", "seen", "total"]
_SUM_LAYOUT = "chunk int, branch int, seen long, total binary"


def _added(frame):
    total = sum(np.frombuffer(part, "<f8") for part in frame["total"])
    row = (frame["chunk"].iloc[0], frame["branch"].iloc[0], frame["seen"].sum(), total.tobytes())
    return pd.DataFrame([row], columns=_SUM)


def trained(rows, known, vector, rates=RATES):
    """The network's parameters after one pass over rows(doc_id, text_key, symbols), in rounds."""
    spark = rows.sparkSession
    for number, rate in enumerate(rates):
        of_round = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(len(rates))) == number
        parameters = spark.sparkContext.broadcast(vector)
        results = rows.where(of_round).select("symbols").mapInArrow(_trained(known, parameters, rate), _SUM_LAYOUT)
        # Added up in two steps: a task adds the results of one in BRANCHES tasks, then those sums.
        sums = results.groupBy("chunk", "branch").applyInPandas(_added, _SUM_LAYOUT)
        sums = sums.withColumn("branch", F.lit(0)).groupBy("chunk").applyInPandas(_added, _SUM_LAYOUT)
        parts = sorted(sums.collect(), key=lambda row: row.chunk)
        if parts:
            vector = np.concatenate([np.frombuffer(row.total, "<f8") / row.seen for row in parts]).astype(np.float32)
        parameters.unpersist()
    return vector


def _scored(known, parameters):
    names = ["doc_id", "text_key", "held_out", "n_tokens", "n_known", "log_sum", "tail_sum"]

    def scan(batches):
        words, vector = known.value, parameters.value
        for batch in batches:
            # Documents of like length run side by side.
            documents = _documents(batch)
            order = sorted(range(len(documents)), key=lambda k: len(documents[k]))
            logs, done = np.empty(len(documents)), 0
            for part in _portions([documents[k] for k in order], SYMBOLS_AT_ONCE):
                found = gru.score(vector, part, words["starts"], words["class_of"], words["start"])
                logs[order[done : done + len(part)]] = found / np.log(10)
                done += len(part)
            columns = [*(batch.column(name) for name in names), pa.array(logs, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "network"])

    return scan


def _rare_sums(rows, counts):
    """Sums over the words that tasks did not know, by an exact join with all counts."""
    rare = rows.where(F.size("rare") > 0).select("doc_id", "text_key", "rare").dropDuplicates(["doc_id", "text_key"])
    rare = rare.select("doc_id", "text_key", F.inline("rare"))
    joined = rare.withColumnRenamed("n", "times").join(counts.select("word", F.col("n").alias("seen")), "word", "left")
    log = F.log10(F.coalesce("seen", F.lit(0)) + ALPHA) * F.col("times")
    return joined.groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")).agg(
        F.sum(log).alias("rare_log"),
        F.sum(log * F.col("tail")).alias("rare_tail"),
        F.sum(F.when(F.col("seen").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )


def scores(docs, max_words=MAX_WORDS, rates=RATES):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs(doc_id, text).

    Both scores are log10 probabilities of the whole text and its end. base_score is that of smoothed
    frequencies of single words, score that of the network.

    * A null or empty text is its end alone.
    * Documents that are held out (see held_out) are scored, not learned from. Without training
      documents every word is unseen.
    * Repeated rows are learned from and scored each; a null doc_id is for training.
    * Empty docs give no row; other columns are ignored.

    Counts are combined in the map tasks. Tasks hold the counts of max_words words at most; the
    words of a document beyond them are joined with all counts.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), held_out("doc_id").alias("held_out"), "text")
    counts = keep(word_counts(rows.where("not held_out").select("text")), "lm-counts")
    vocabulary = Vocabulary(counts, max_words)
    known = spark.sparkContext.broadcast(vocabulary.plain())
    table = keep(encoded(rows, known), "lm-encoded")
    vector = trained(table.where("not held_out"), known, vocabulary.initial, rates)
    layout = ", ".join(f"{k} {t}" for k, t in table.dtypes if k not in ("symbols", "rare"))
    parameters = spark.sparkContext.broadcast(vector)
    result = table.drop("rare").mapInArrow(_scored(known, parameters), f"{layout}, network double")
    if vocabulary.complete:
        sums = {name: F.lit(0.0) for name in ("rare_log", "rare_tail", "rare_known")}
        result = result.withColumns(sums)
    else:
        rare = _rare_sums(table, counts)
        same = result["doc_id"].eqNullSafe(F.col("_doc_id")) & (result["text_key"] == F.col("_text_key"))
        result = result.join(rare, same, "left").na.fill(0, ["rare_log", "rare_tail", "rare_known"])
    denominator = float(np.log10(vocabulary.tokens + ALPHA * (vocabulary.words + 1)))
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("log_sum") + F.col("rare_log") - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("network") + F.col("tail_sum") + F.col("rare_tail")).alias("score"),
    )


def op8_lm(spark, sf_dir):
    """Scores of each document."""
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))

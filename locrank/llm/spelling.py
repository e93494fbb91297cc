"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

One word of a pair contributes two disjoint chunks of q = half its length, the other its positional
q-grams. One inserted, deleted or replaced code point touches at most one of the chunks, so the
other chunk is a gram of the other word, at the same place or shifted by one. Words that meet in
such a key are verified by their edit distance.

A key in which very many pairs meet, because many words share half of their letters, is not
compared pair by pair: what is left of its words without the shared chunk is one edit apart again,
so the same scheme deals them out by a chunk of the rest, until the rest is one letter.
"""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from locrank.llm.words import column_bytes, keep

_RUN = re.compile("[a-zÀ-ÿ]+")

MIN_CHARS = 7
MIN_COUNT = 2
#: A form has at least this many times the occurrences of the word.
RATIO = 10
#: Pairs that may meet in a key before its words are dealt out by the rest.
MEETING = 10_000
#: Distinct words a task counts before it passes them on, about 100 MB.
COUNTED = 500_000


def altered(doc_id, run, every=31):
    """The run, without one code point where the CRC-32 of `doc_id:run` is divisible by every."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs, min_chars=MIN_CHARS, every=31):
    """word, n: words of min_chars code points or more in docs(doc_id, text), and their occurrences.

    Words are maximal runs of `[A-Za-z\\u00C0-\\u00FF]` with A-Z lower-cased, altered as altered() says.
    """

    def counted(batches):
        total = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), column_bytes(batch, "text")):
                # bytes.lower() changes A-Z alone.
                runs = Counter(_RUN.findall(text.lower().decode()))
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in runs.items():
                    if len(run) >= min_chars:
                        h = zlib.crc32(run.encode(), start)
                        if h % every == 0:
                            run = run[: h % len(run)] + run[h % len(run) + 1 :]
                            if len(run) < min_chars:
                                continue
                        total[run] += n
            if len(total) >= COUNTED:
                yield from _batches(total)
                total = Counter()
        yield from _batches(total)

    parts = docs.select("doc_id", "text").mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _batches(total, rows=50_000):
    words, counts = list(total), list(total.values())
    for at in range(0, len(words), rows):
        columns = [pa.array(words[at : at + rows], pa.string()), pa.array(counts[at : at + rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def _part(start, length):
    return F.substring(F.col("rest"), start + 1, length)


def _keyed(rows, places):
    """key, word, rest, start, length, more of rows(key, word, rest, only).

    places: (more, chunk, shift) for parts that can equal the chunk of a word that has `more` code
    points more, at that chunk's place shifted by `shift`. If only is given, more can be nothing else.
    """
    each = F.array(*(F.struct(*map(F.lit, place)) for place in places))
    whole = F.char_length("rest") + F.col("more")
    dealt = rows.select("*", F.inline(each).alias("more", "chunk", "shift")).where("only is null or only = more")
    dealt = dealt.withColumn("whole", whole).withColumn("length", F.shiftright("whole", 1))
    dealt = dealt.withColumn("start", F.col("length") * F.col("chunk") + F.col("shift"))
    dealt = dealt.where("length > 0 and start >= 0 and start + length <= whole - more")
    key = F.xxhash64("key", "whole", "chunk", _part(F.col("start"), F.col("length"))).alias("key")
    return dealt.select(key, "word", "rest", "start", "length", "more")


def _rests(keyed):
    """key, word, what is left of rest without the shared part, and the known difference of lengths."""
    before, after = _part(F.lit(0), F.col("start")), _part(F.col("start") + F.col("length"), F.char_length("rest"))
    return keyed.select("key", "word", F.concat(before, after).alias("rest"), F.col("more").alias("only"))


def chunks(rows):
    """The two disjoint chunks of rows(key, word, rest), keyed by the length they come from and their number."""
    return _keyed(rows, [(0, chunk, 0) for chunk in (0, 1)])


def grams(rows):
    """The positional grams of rows(key, word, rest) that can equal a chunk of a word one edit away.

    Chunks come from the longer word of a pair, so such a word is as long or one longer; its chunk
    is at the same place here, or shifted by the difference. Grams elsewhere meet no chunk and are left out.
    """
    return _keyed(rows, [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 0), (1, 1, -1)])


def near_pairs(words, meeting=MEETING):
    """a, b: every two words of words(word) that differ by exactly one edit, a < b, once each.

    * Null words and those of less than two code points, which have no two chunks, are near nothing;
      repeated words count once. No words give no row.

    Both sides of a key are shuffled by it, seven short rows per word at most. Keys where more than
    `meeting` pairs would meet are counted first and refined by the rest of their words; a rest of
    at most one code point on the chunk's side ends that, as the words of such a key differ in two
    code points at most. No key is dropped.
    """
    level = words.where(F.char_length("word") > 1).select(F.lit(0).cast("long").alias("key"), "word", F.col("word").alias("rest"))
    level = level.distinct().withColumn("only", F.lit(None).cast("int"))
    left, right = chunks(level), grams(level)
    found = None
    while True:
        left, right = keep(left, "spelling-chunks"), keep(right, "spelling-grams")
        sizes = left.groupBy("key").agg(F.count("*").alias("chunks"))
        sizes = sizes.join(right.groupBy("key").agg(F.count("*").alias("grams")), "key")
        hot = keep(sizes.where(F.col("chunks") * F.col("grams") > meeting).select("key"), "spelling-hot")
        refined = not hot.isEmpty()
        left_over = F.char_length("rest") - F.col("length")
        if refined:
            apart = hot.withColumn("hot", F.lit(True))
            left, right = left.join(apart, "key", "left"), right.join(apart, "key", "left")
            few_left = left.where(F.col("hot").isNull() | (left_over < 2))
            few_right = right.where(F.col("hot").isNull() | (left_over < 3))
        else:
            few_left, few_right = left, right
        a = few_left.select("key", F.col("word").alias("one"))
        b = few_right.select("key", F.col("word").alias("other"), "more")
        # Words of equal length meet in both directions.
        near = ((F.col("more") > 0) | (F.col("one") < F.col("other"))) & (F.levenshtein("one", "other", 1) == 1)
        pairs = a.join(b, "key").where(near).select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b"))
        pairs = keep(pairs.distinct(), "spelling-pairs")
        found = pairs if found is None else found.unionAll(pairs)
        if not refined:
            return found.distinct()
        left = chunks(_rests(left.where(F.col("hot") & (left_over > 1))))
        right = grams(_rests(right.where("hot")))


def roots(forms):
    """word, root: the end of the way from form to form, for every row of forms(word, form) without cycles.

    The number of rounds grows with the logarithm of the longest way.
    """
    ways = keep(forms.select("word", F.col("form").alias("root")), "spelling-ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = ways.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        stepped = keep(stepped, "spelling-ways")
        ways = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return ways


def variants(counts, ratio=RATIO, meeting=MEETING):
    """word, form, root, n, n_near, form_n for every row of counts(word, n), a word with its occurrences.

    n_near words are one edit away. Of these the one of largest n, among equals the smallest in
    code-point order, is the form if its n is at least ratio times the word's, else form is null.
    root is the last word reached from form to form, the word itself without a form.

    * Null words and those of less than two code points have no near words; words must be distinct.
      No words give no row.
    """
    counts = keep(counts.select("word", "n"), "spelling-words")
    pairs = near_pairs(counts, meeting)
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(counts.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    # The smallest of (-n, word) is the near word of largest n that comes first.
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("b").alias("word"))).alias("best")
    near = near.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    judged = counts.join(near, "word", "left")
    is_form = F.col("n") * -ratio >= F.col("best.minus")
    judged = judged.select(
        "word",
        F.when(is_form, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.minus")).alias("form_n"),
    )
    judged = keep(judged, "spelling-judged")
    ends = roots(judged.where("form is not null"))
    rooted = judged.join(ends, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir):
    """Words of the documents with two occurrences or more, and the more frequent form one edit away."""
    counts = word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return variants(counts.where(F.col("n") >= MIN_COUNT))


OP13_SQL = r"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS MATERIALIZED (
  SELECT doc_id, run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT *, list_transform(range(octet_length(encode(doc_id::VARCHAR || ':' || run))),
    lambda i: ('0x' || substring(hex(encode(doc_id::VARCHAR || ':' || run)), 2 * i + 1, 2))::BIGINT) AS bytes FROM runs), crc_table),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 <> 0 THEN run
      ELSE substring(run, 1, (h % length(run))::INTEGER) || substring(run, (h % length(run))::INTEGER + 2) END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS MATERIALIZED (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT less.word, words.word FROM less JOIN words ON less.rest = words.word
  UNION SELECT words.word, less.word FROM less JOIN words ON less.rest = words.word),
judged AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * words.n THEN form END AS form,
    CASE WHEN near_n >= 10 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN (
    SELECT a, count(*) AS n_near, max(words.n) AS near_n, arg_min(b, (-words.n, encode(b))) AS form
    FROM pairs JOIN words ON words.word = b GROUP BY a) ON a = words.word),
way AS (
  SELECT word, word AS root, 0 AS steps FROM judged
  UNION ALL SELECT way.word, judged.form, steps + 1 FROM way JOIN judged ON judged.word = way.root WHERE judged.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM judged JOIN (SELECT word, arg_max(root, steps) AS root FROM way GROUP BY word) USING (word)
"""

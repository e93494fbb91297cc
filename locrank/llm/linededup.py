"""Line dedup: range partitions of line hashes, sorted by document and position.

Each line's key is hashed to 128 bits. Hashes are partitioned by range and sorted with document and
position as secondary keys, so that the first occurrence of a key comes first and one pass over a
partition tells which lines repeat it. What comes back is a run-length coded bitmap of the lines
each document keeps; no text is shuffled to find it. Built of DataFrame functions only.
"""

import string

from pyspark.sql import functions as F
from pyspark.sql import Window

from locrank.llm.words import keep, whole_rows

#: Shorter keys are never dropped.
MIN_KEY_CHARS = 10
#: Ranges of hashes whose lines are counted to find hot keys; the counts are broadcast, 1 MB at most.
RANGES = 65_536

_SPACE = " \t\n\x0b\f\r"


def _bare(line):
    return F.btrim(line, F.lit(_SPACE))


def line_key(line):
    """The line without white space at its ends, A-Z lower-cased."""
    bare = _bare(line)
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_lines(docs):
    """(doc_id, text_key, pos) of the lines of docs(doc_id, text) that an earlier document has.

    A key with very many lines would fill one range. Lines are therefore counted per range of
    hashes first, and a range with more than a task's share is dealt out by document as well: the
    first occurrence is then found per part, and the parts' firsts, one document each, are compared
    after that.
    """
    spark = docs.sparkSession
    # The text is hashed below the explode, once and not for every line. Any text has a line, and
    # the outer form spares a second split that looks for texts without one.
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), _lines(F.col("text")).alias("lines"))
    lines = texts.select("doc_id", "text_key", F.posexplode_outer("lines").alias("pos", "line"))
    # A key has as many code points as the bare line.
    lines = lines.where(F.char_length(_bare(F.col("line"))) >= MIN_KEY_CHARS).withColumn("key", line_key(F.col("line")))
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")]
    lines = keep(lines.select("doc_id", "text_key", "pos", *hashes), "lines")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    span = F.pmod("h1", F.lit(RANGES)).alias("span")
    counts = lines.groupBy(span).agg(F.count("*").alias("rows"))
    parts = F.ceil(F.col("rows") * tasks / F.sum("rows").over(Window.partitionBy()))
    hot = counts.select("span", parts.cast("int").alias("parts")).where("parts > 1")
    dealt = lines.withColumn("span", span).join(F.broadcast(hot), "span", "left")
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc_id"), "parts")).otherwise(0)
    dealt = dealt.withColumn("part", part).drop("span").repartitionByRange("h1", "h2", "part")

    order = Window.partitionBy("h1", "h2", "part").orderBy(F.col("doc_id").asc_nulls_last(), "pos")
    first = F.first("doc_id").over(order.rowsBetween(Window.unboundedPreceding, 0))
    streamed = dealt.withColumn("first", first).withColumn("repeats", ~F.col("doc_id").eqNullSafe(F.col("first")))
    streamed = keep(streamed.where("repeats or parts is not null").drop("part"), "lines-streamed")

    place = ["doc_id", "text_key", "pos"]
    heads = streamed.where("not repeats")
    earliest = keep(heads.groupBy("h1", "h2").agg(F.min("doc_id").alias("earliest")), "lines-earliest")
    late = heads.join(earliest, ["h1", "h2"]).where("not (doc_id <=> earliest)")
    return streamed.where("repeats").select(*place).unionAll(late.select(*place)).distinct()


def bitmaps(docs):
    """doc_id, text_key, n_dropped, changes of documents that lose lines.

    changes is the run-length coded bitmap of the lines that stay: the positions where it changes.
    Lines before the first one stay, those from there to the second go, and so on.
    """
    document = ["doc_id", "text_key"]
    order = Window.partitionBy(*document).orderBy("pos")
    islands = dropped_lines(docs).withColumn("island", F.col("pos") - F.row_number().over(order))
    runs = islands.groupBy(*document, "island").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("length"))
    ends = F.array("start", F.col("start") + F.col("length"))
    changes = F.flatten(F.array_sort(F.collect_list(ends))).alias("changes")
    return runs.groupBy(*document).agg(F.sum("length").alias("n_dropped"), changes)


def _with_bitmap(docs):
    """row, a struct of all columns of docs, n_dropped and changes, null where nothing is dropped."""
    rows = whole_rows(docs).withColumn("key", F.xxhash64("row.text"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    return rows.join(bitmaps(docs), same, "left").select("row", "key", "n_dropped", "changes")


def _stretches(lines, take):
    """take(first, number) for each stretch of lines that stays, the first and the last maybe empty."""

    def stretch(i):
        first = F.coalesce(F.get("changes", 2 * i - 1), F.lit(0))
        return take(first, F.coalesce(F.get("changes", 2 * i), F.size(lines)) - first)

    return F.transform(F.sequence(F.lit(0), F.coalesce(F.shiftright(F.size("changes"), 1), F.lit(0))), stretch)


def _kept_text():
    """The lines whose bits are set, joined by line feeds."""

    def stay(lines):
        return F.array_join(F.flatten(_stretches(lines, lambda first, n: F.slice(lines, first + 1, n))), "\n")

    text = F.col("row.text")
    split_once = F.transform(F.array(_lines(text)), stay)
    return F.when(F.col("changes").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.element_at(split_once, 1))


def keep_bitmaps(docs):
    """doc_id, text_key, n_lines, n_dropped, keep_runs for every row of docs(doc_id, text).

    Lines are what line feeds separate; a line's key has no white space at its ends and A-Z
    lower-cased. Keys of MIN_KEY_CHARS code points or more that occur in several documents lose all
    their lines but those of the smallest doc_id. keep_runs are run lengths of kept and dropped
    lines in turn, the first and the last of them kept.

    * A null or empty text is one empty line, which stays.
    * A null doc_id is one document that sorts last. Rows that repeat a doc_id are one document;
      text_key, a hash of the text, tells their lines apart.
    * Empty docs give no row; other columns are ignored.
    """
    rows = _with_bitmap(docs.select("doc_id", "text"))
    n_lines = F.size(_lines(F.col("row.text")))
    ends = F.concat(F.coalesce("changes", F.array().cast("array<int>")), F.array(n_lines))
    runs = F.transform(ends, lambda end, i: end - F.coalesce(F.get(ends, i - 1), F.lit(0)))
    return rows.select(
        "row.doc_id",
        F.col("key").alias("text_key"),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        runs.alias("keep_runs"),
    )


def without_repeated_lines(docs):
    """docs with the text of the lines that stay; n_chars, where there is one, follows. A text that
    loses no line stays as it is, null included."""
    whole = F.col("changes").isNull()
    rows = _with_bitmap(docs).withColumn("text", F.when(whole, F.col("row.text")).otherwise(_kept_text()))
    columns = {name: F.col("row").getField(name) for name in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(dict(docs.dtypes)["n_chars"])
        columns["n_chars"] = F.when(whole, columns["n_chars"]).otherwise(changed)
    return rows.select(*(column.alias(name) for name, column in columns.items()))


def op10_line_dedup(spark, sf_dir):
    """Lines of each document, those dropped, and a digest of the rest."""
    rows = _with_bitmap(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select(
        "row.doc_id",
        F.size(_lines(F.col("row.text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept_text().cast("binary"), 256).alias("kept_sha256"),
    )


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, line, pos,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
firsts AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key),
judged AS (
  SELECT doc_id, line, pos, first IS NULL OR doc_id = first AS stays
  FROM lines LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

"""Words, Arrow batches and tables kept between jobs, shared by the operators."""

import ctypes

import pyarrow as pa
from pyspark.sql import functions as F

from locrank.storage import scratch_dir

# A-Z to a-z, every other ASCII character but digits and a-z to a space.
_ALPHANUMERIC = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def alphanumeric_words(text):
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of UTF-8 bytes after lower-casing A-Z."""
    return text.translate(_ALPHANUMERIC).split()


def spaced_words(text):
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 bytes: bytes.split() separates at just those six."""
    return text.split()


def utf8(strings):
    """An Arrow array of strings as UTF-8 bytes, null as empty."""
    return [value or b"" for value in strings.cast(pa.large_binary()).to_pylist()]


def column_bytes(batch, name):
    """A string column of an Arrow batch as UTF-8 bytes, null as empty."""
    return utf8(batch.column(name))


def give_back():
    """Return memory that was freed to the system, where the C library can.

    Workers are used again from stage to stage; without this each keeps the most it ever used, beside
    a Java heap that does the same.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def whole_rows(docs):
    """docs as one column row, a struct of all its columns, beside which names are free."""
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))


def keep(frame, purpose):
    """Write a result that several jobs read to the shared folder, and read it back.

    A lost executor then costs the tasks that ran on it, not the jobs before, and all readers see
    the same rows. The table stays until the folder named in spark.checkpoint.dir is cleaned.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def cores(spark):
    """Tasks that run at once, for dealing out work that has no natural split."""
    return spark.sparkContext.defaultParallelism

"""From raw documents to packed training sequences: five stages, each reading what the one before wrote."""

from locrank.llm.decontamination import without_contaminated
from locrank.llm.linededup import without_repeated_lines
from locrank.llm.packing import packed_documents
from locrank.llm.quality import without_rejected
from locrank.llm.simhash import one_of_each
from locrank.llm.words import keep


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or are outliers of their language and source go."""
    return without_rejected(docs)


def line_dedup(spark, docs, sf_dir):
    """Lines that a document with a smaller doc_id has go; a document left without lines stays, empty."""
    return without_repeated_lines(docs)


def near_dedup(spark, docs, sf_dir):
    """Of each component of near-duplicates the document with the smallest doc_id stays."""
    return one_of_each(docs, size=4, radius=4)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a window of the benchmark go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark, docs, sf_dir):
    """Pieces of documents in sequences of 4096 tokens."""
    return packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: SQL has neither the hashes nor the estimates nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The pieces of documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), "-".join(name.lower().split()))
    return STAGES[-1][1](spark, docs, sf_dir)

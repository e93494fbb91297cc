"""Queries with SQL against DuckDB, and the pipeline against brute force."""

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
import test_decontamination
import test_linededup
import test_packing
import test_simhash
from locrank.llm.packing import Limits
from locrank.llm.quality import judged
from locrank.llm.queries import ORACLE, QUERIES
from locrank.storage import keep

TABLES = "documents embeddings pages benchmark conversations".split()


def test_all_queries_are_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    expected = connection.execute(ORACLE[name])
    columns = [part[0] for part in expected.description]
    frame = QUERIES[name](spark, sf_dir)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_pipeline_against_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in judged(documents).collect()}
    rows = {r.doc_id: r for r in documents.collect() if verdict[r.doc_id]}
    texts = {
        d: "\n".join(line for line, k in zip(lines, kept) if k)
        for d, kept, lines in test_linededup.by_hand(sorted((d, r.text) for d, r in rows.items()))
    }
    prints = {d: test_simhash.by_hand_print(t) for d, t in texts.items()}
    of, first = test_simhash.classes(set(prints.values())), {}
    for d in sorted(texts):
        first.setdefault(of[prints[d]], d)
    texts = {d: t for d, t in texts.items() if first[of[prints[d]]] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _, n, _ in test_decontamination.by_hand(list(texts.items()), items, 10) if n}
    assert hit
    texts = {d: t for d, t in texts.items() if d not in hit}

    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), "pipeline-test")
        assert docs.columns == documents.columns
    assert {r.doc_id: r.text for r in docs.collect()} == texts
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    test_packing.check(pieces, Limits())
    assert {p.doc_id for p in pieces} == set(texts)


def test_stages_take_an_empty_table(spark, frame, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame([]), sf_dir).count() == 0

import hashlib
import random
import re

import pytest
from conftest import rows

from locrank.llm.linededup import keep_bitmaps, op10_line_dedup, without_repeated_lines


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def by_hand(docs):
    """(doc_id, kept flags, lines) per row."""
    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc)
    first = {k: min(d, key=lambda x: (x is None, x)) for k, d in holders.items()}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        out.append((doc, [k not in first or first[k] == doc for k in map(key, lines)], lines))
    return out


def documents(draw):
    shared = [f"shared line number {n} Ä" for n in range(6)] + ["short", "", "  A very COMMON line\t"]
    docs = []
    for n in range(80):
        lines = [draw.choice(shared) if draw.random() < 0.5 else f"own line {n} {draw.random()}" for _ in range(draw.randint(1, 12))]
        docs.append((n, "\n".join(lines) + draw.choice(["", "\n", " a very common LINE"])))
    return docs


def check(frame, docs):
    expected = by_hand(docs)
    flags = []
    for r in keep_bitmaps(frame).collect():
        kept = [k for n, run in enumerate(r.keep_runs) for k in [n % 2 == 0] * run]
        assert len(kept) == r.n_lines and kept.count(False) == r.n_dropped
        flags.append((r.doc_id, kept))
    assert sorted(flags, key=repr) == sorted(((d, k) for d, k, _ in expected), key=repr)
    texts = sorted(((d, "\n".join(x for x, f in zip(lines, k) if f)) for d, k, lines in expected), key=repr)
    found = without_repeated_lines(frame)
    assert found.columns == frame.columns
    assert sorted(((r.doc_id, r.text or "") for r in found.collect()), key=repr) == texts
    assert all(r.n_chars == len(r.text or "") for r in found.collect())


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_documents_with_hot_lines(spark, frame, edge_cases, settings, partitions):
    """With many partitions the common lines exceed a task's share and are dealt out by document."""
    settings("spark.sql.shuffle.partitions", partitions)
    docs = documents(random.Random(int(partitions))) + edge_cases
    check(frame(docs), docs)


def test_null_ids_repeated_rows_and_empty_tables(spark, frame):
    docs = [(None, "a line that repeats\nx"), (None, "a line that repeats"), (4, "A line that repeats "), (4, "A line that repeats ")]
    check(frame(docs), docs)
    assert keep_bitmaps(frame([])).count() == 0
    assert rows(without_repeated_lines(frame([]))) == []


def test_a_long_text_with_many_runs(spark, frame):
    """Every second of 40,000 lines is in an earlier document."""
    common = [f"common line {n}" for n in range(20_000)]
    mixed = [line for n, other in enumerate(common) for line in (f"own line {n}", other)]
    docs = [(1, "\n".join(common)), (2, "\n".join(mixed)), (3, "\n".join(common[::2]))]
    check(frame(docs), docs)


def test_plan(spark, sf_dir):
    plan = op10_line_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_op10_on_the_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = []
    for d, kept, lines in by_hand(docs):
        rest = "\n".join(line for line, k in zip(lines, kept) if k)
        expected.append((d, len(lines), kept.count(False), hashlib.sha256(rest.encode()).hexdigest()))
    assert sorted(map(tuple, op10_line_dedup(spark, sf_dir).collect())) == sorted(expected)

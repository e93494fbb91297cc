import re

from conftest import rows

from locrank.llm.decontamination import benchmark_hits, with_hit_counts, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, window):
    patterns = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            patterns.setdefault(tuple(own[i : i + window]), set()).add(str(item))
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for pattern, names in patterns.items():
            for i in range(len(own) - len(pattern) + 1):
                if tuple(own[i : i + len(pattern)]) == pattern:
                    hit.update(range(i, i + len(pattern)))
                    found |= names
        out.append((doc, len(own), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


ITEMS = [
    (1, "one two three four five six"),
    (2, "short one"),
    (3, "solo"),
    (10, "ONE-two three, four nine"),
    (11, None),
    (12, "..."),
    (1, "a second text of item one"),
]
DOCS = [
    (1, "zero one two three four five six one two three four nine"),
    (2, "short one short one solo SOLO"),
    (3, None),
    (4, ""),
    (None, "it is solo"),
    (5, "one two three four five"),
    (5, "one two three four five"),
    (6, "clean words only, of no item at all"),
]


def found(spark, docs, items, window, block):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits = with_hit_counts(benchmark_hits(docs, benchmark, window, block))
    return sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in hits.collect()), key=repr)


def test_windows_of_all_lengths_in_one_and_in_many_passes(spark, frame):
    for window in (1, 2, 3, 4, 10):
        expected = by_hand(DOCS, ITEMS, window)
        assert found(spark, frame(DOCS), ITEMS, window, 10**6) == expected
        assert found(spark, frame(DOCS), ITEMS, window, 4) == expected


def test_edge_cases_and_empty_tables(spark, frame, edge_cases):
    items = [(7, " ".join(edge_cases[6][1].split()[100:115])), (8, "row twice with")]
    expected = by_hand(edge_cases, items, 10)
    assert sum(r[2] > 0 for r in expected) == 3
    assert found(spark, frame(edge_cases), items, 10, 10**6) == expected
    assert found(spark, frame([]), items, 10, 10**6) == []
    assert all(r[2] == 0 for r in found(spark, frame(edge_cases), [], 10, 10**6))


def test_contaminated_rows_go_and_clean_ones_stay_with_all_columns(spark, frame, edge_cases):
    docs = frame(edge_cases)
    benchmark = spark.createDataFrame([(8, "row twice with")], "item_id long, text string")
    kept = without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert rows(kept) == rows(docs.where("doc_id is null or doc_id <> 4"))


def test_an_item_longer_than_a_block(spark, frame):
    """Its windows are searched in pieces; a document in the middle of two pieces is found as well."""
    long = " ".join(f"w{n}" for n in range(100))
    docs = [(n, " ".join(f"w{k}" for k in range(n, n + 10))) for n in range(0, 91, 7)] + [(200, "w5 w6 w7 w8 w9 w10 w11 w12 w13")]
    items = [(1, long), (2, "other words")]
    expected = by_hand(docs, items, 10)
    assert found(spark, frame(docs), items, 10, 12) == expected == found(spark, frame(docs), items, 10, 10**6)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert rows(without_contaminated(frame(docs), benchmark, 10, 12), "doc_id") == [(200,)]

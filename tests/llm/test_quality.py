import random
import re
from collections import Counter

from conftest import rows

from locrank.llm.quality import judged, op5_quality, without_rejected


def by_hand(text):
    text = text or ""
    words, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", text), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    spans = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(spans), set()
    for i, span in enumerate(spans):
        if often[span] > 1:
            covered.update(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_and_base_rules(spark, frame, edge_cases):
    texts = [*edge_cases, (20, "a b c d e " * 30), (21, "x\ny\nx\n \nx"), (22, "#*$ a|b <c> & %"), (23, "one two three four five")]
    found = {(r.doc_id, r.n_words): r for r in judged(frame(texts)).collect()}
    for doc, text in texts:
        counts = by_hand(text)
        r = found[doc, counts[0]]
        assert tuple(r[c] for c in COUNTS) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert r.kept == (not r.base_failed)  # too few documents for an estimate
    assert judged(frame([])).count() == 0


def test_outliers_do_not_hide_each_other_and_clean_documents_stay(spark):
    """A sixth of one source is junk; another source writes all its documents with symbols."""
    draw = random.Random(6)

    def text(symbols):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(draw.randint(60, 200))]
        return " ".join(w + ("%%%" if draw.random() < symbols else "") for w in words)

    docs = [(n, text(0.9 if n % 6 == 0 else 0.0), "en", "plain") for n in range(600)]
    docs += [(n, text(0.9), "en", "symbols") for n in range(1000, 1300)]
    docs += [(n, text(0.0), None, None) for n in range(2000, 2010)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in judged(frame).collect()}
    assert all(kept[n] == (n % 6 != 0) for n in range(600))
    assert all(kept[n] for n in range(1000, 1300)) and all(kept[n] for n in range(2000, 2010))
    assert sorted(r.doc_id for r in without_rejected(frame).collect()) == sorted(n for n, good in kept.items() if good)


def test_a_third_of_a_source_are_copies(spark):
    """Copies of one text, and variants of it, that pass the base rules do not hide each other."""
    draw = random.Random(7)

    def text(symbols):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(draw.randint(60, 200))]
        return " ".join(w + ("%%%" if draw.random() < symbols else "") for w in words)

    copy = text(0.9)
    docs = [(n, copy if n % 3 == 0 else text(0.0), "en", "copies") for n in range(600)]
    docs += [(n, text(0.9 if n % 10 in (0, 3, 6) else 0.0), "en", "variants") for n in range(1000, 1600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    found = judged(frame).collect()
    assert not any(r.base_failed for r in found)
    kept = {r.doc_id: r.kept for r in found}
    assert all(kept[n] == (n % 3 != 0) for n in range(600))
    assert all(kept[n] == (n % 10 not in (0, 3, 6)) for n in range(1000, 1600))


def test_a_small_source_has_an_estimate_of_its_own(spark):
    """Sixty documents with symbols, a sixth without: the others of the language have none."""
    draw = random.Random(8)

    def text(symbols):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(draw.randint(60, 200))]
        return " ".join(w + ("%%%" if draw.random() < symbols else "") for w in words)

    docs = [(n, text(0.0), "en", "large") for n in range(600)]
    docs += [(n, text(0.0 if n % 6 == 0 else 0.9), "en", "small") for n in range(1000, 1060)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in judged(frame).collect()}
    assert all(kept[n] for n in range(600))
    assert all(kept[n] == (n % 6 != 0) for n in range(1000, 1060))


def test_all_columns_and_repeated_rows_stay(spark, frame, edge_cases):
    kept = without_rejected(frame([*edge_cases, (30, " ".join(f"w{n}" for n in range(50)))] * 2))
    assert kept.columns == frame(edge_cases).columns
    assert [r[0] for r in rows(kept, "doc_id")].count(30) == 2


def test_labelled_documents(spark):
    """Documents of good quality that pass the base rules are kept; most of the others are not."""
    sf_dir = "/root/testdata/sf0.1"
    found = op5_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    good = found.where("quality = 1 and not base_failed")
    bad = found.where("quality = 0")
    assert good.where("kept").count() >= 0.999 * good.count()
    assert bad.where("not kept").count() >= 0.95 * bad.count()

import random

import pytest

SF = "/root/testdata/sf0.001"


def rows(frame, *columns):
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr)


@pytest.fixture(scope="session")
def sf_dir():
    return SF


#: Names that the operators give to columns of their own.
OWN_NAMES = (
    "row key text_key spans items part rows number unit changes n_dropped _doc_id _text_key _runs _n_dropped _root "
    "_lang _source root fp n_words base_failed kept distance g2 x0 mu"
).split()


@pytest.fixture
def frame(spark):
    """Rows of (doc_id, text) as documents, with columns whose names operators use themselves."""

    def build(pairs):
        rows = [(d, t, "en", "s", len(t or ""), *(1 for _ in OWN_NAMES)) for d, t in pairs]
        layout = ", ".join(f"`{name}` int" for name in OWN_NAMES)
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {layout}")

    return build


@pytest.fixture
def edge_cases():
    """Null and empty texts, a null doc_id, repeated rows, one very long text, odd white space."""
    draw = random.Random(2)
    words = [f"w{n}" for n in range(300)]
    long = " ".join(draw.choices(words, k=30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (None, "a text without an id that is long enough to be kept"),
        (4, "the same row twice with some words in it"),
        (4, "the same row twice with some words in it"),
        (5, long),
        (6, "Ünïcode ÄÖ 中文 — \x1c\x85 and 'tis <|endoftext|> x"),
    ]

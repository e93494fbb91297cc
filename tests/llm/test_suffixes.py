import random
from collections import Counter

import pytest

from locrank.llm.suffixes import Shard, merged_blocks, op9_suffixes, repeated_strings, without_repeats


def by_hand(docs, size):
    texts = [(d, (t or "").encode()) for d, t in docs]
    counts = Counter(t[i : i + size] for _, t in texts for i in range(len(t) - size + 1))
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if counts[text[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(text), sum(gone), spans, bytes(c for c, g in zip(text, gone) if not g)))
    return sorted(out, key=repr)


def found(frame, size, **options):
    rows = without_repeats(frame, size, **options).collect()
    return sorted(
        ((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in rows), key=repr
    )


def texts_of(draw, alphabet, least, count):
    return list(dict.fromkeys(bytes(draw.choices(alphabet, k=draw.randint(least, 90))) for _ in range(count)))


def test_merged_shards_against_sorting():
    draw = random.Random(3)
    for _ in range(60):
        size = draw.choice([8, 11, 20, 33, 70])
        texts = texts_of(draw, draw.choice([b"ab", b"abcd", b"a"]), size, draw.randint(1, 12))
        counts = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
        expected = [[i for i in range(len(t) - size + 1) if counts[t[i : i + size]] > 1] for t in texts]
        ranges = repeated_strings(texts, size, draw.choice([30, 100, 1000]))
        assert [[i for a, b in r for i in range(a, b)] for r in ranges] == expected


def test_common_prefixes():
    draw = random.Random(5)
    texts = texts_of(draw, b"ab", 40, 12)
    shards = [Shard(texts[:5], 40), Shard(texts[5:], 40)]
    source, place, _, common = merged_blocks(shards, 40)

    def rotation(k):
        shard, at = shards[source[k]], place[k]
        base, length = at - shard.place[at], shard.length[at]
        ring = bytes(shard.data[base : base + length])
        return (ring * 3)[at - base : at - base + 40]

    for k in range(1, len(place)):
        a, b = rotation(k - 1), rotation(k)
        equal = next((i for i in range(40) if a[i] != b[i]), 40)
        assert (equal == 40) == (common[k] == 0)
        if common[k]:
            assert common[k] - 32 <= equal < common[k]


@pytest.mark.parametrize("options", [{}, {"merged_bytes": 1}, {"hot_bytes": 1}])
def test_documents(spark, frame, edge_cases, options):
    draw = random.Random(7)
    word = lambda: "".join(draw.choices("abcdefghijklmnop ", k=10))
    passage = "".join(word() for _ in range(40))
    docs = [*edge_cases, (50, "z" * 700), (51, "xy" * 300), (52, passage)]
    docs += [(60 + n, "".join(word() for _ in range(10)) + passage[n : 400 - n] + "ß" + word()) for n in range(12)]
    docs += [(80 + n, passage[:150] + word() + passage[150:]) for n in range(3)]
    assert found(frame(docs), 100, gram=16, **options) == by_hand(docs, 100)


def test_buffers_are_joined_without_a_gap(spark, frame):
    """A text longer than a buffer, with repeats across the place where it is cut."""
    draw = random.Random(1)
    text = "".join(draw.choices("abcdefgh", k=(1 << 20) + 5000))
    cut = 1 << 20
    docs = [(1, text), (2, "start " + text[cut - 700 : cut + 700] + " end"), (3, "none of it")]
    expected = [(1, len(text), 1400, 1), (2, 1410, 1400, 1), (3, 10, 0, 0)]
    assert [r[:4] for r in found(frame(docs), 200)] == expected


def test_empty(spark, frame):
    assert found(frame([]), 200) == []


def test_op9_on_the_tables(spark, sf_dir):
    import hashlib

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = [(d, n, gone, spans, hashlib.sha256(rest).hexdigest()) for d, n, gone, spans, rest in by_hand(docs, 200)]
    assert sorted(map(tuple, op9_suffixes(spark, sf_dir).collect())) == sorted(expected)

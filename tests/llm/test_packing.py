import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from locrank.llm.packing import DOCUMENT_LIMITS, Limits, Pool, WordTokenizer, op3_packing, pack, packed_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def check(pieces, limits):
    """Sequences are gapless and within all three limits; returns padding and tokens."""
    sequences, padding, total = defaultdict(list), 0, 0
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length == len(p.ids) // 4 > 0
            at += p.length
        assert at <= limits.tokens and len(own) <= limits.segments and sum(p.n_loss for p in own) <= limits.loss
        total += at
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding, total


def joined(pieces):
    """Documents put together again: (doc_id, ids) of every copy."""
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.start].append(p)
    out = []
    for (doc, start), firsts in by_doc.items():
        if start:
            continue
        for first in firsts:
            ids, at = b"", 0
            while at < first.doc_tokens:
                piece = by_doc[doc, at][0] if at else first
                ids += piece.ids
                at += piece.length
            out.append((doc, np.frombuffer(ids, "<u4").tolist()))
    return sorted(out, key=repr)


def test_ids_of_odd_texts(tokenizer):
    """Texts of characters and special tokens that join, divide or compose."""
    signs = [*"abXY01.,'!?<>|/_-# \t\n\x0b\x1c\x85", *"éßİñΣς½Ⅷﬁ日😀", "\u0301", "\u0331", "\u200d", "\xa0", "'s", "<|endoftext|>"]
    draw, coder = random.Random(3), WordTokenizer(PATH, 2)
    for _ in range(4):
        texts = ["".join(draw.choices(signs, k=draw.randrange(30))) for _ in range(500)] + [None, "", " \n"]
        found = coder.encode(pa.array(texts, pa.string()))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(tokenizer, text) for text in texts]
    assert coder.encode(pa.array([None, " "], pa.string())) == [b"", b""]


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 40, 4), Limits(128, 256, 16, 1)])
def test_every_id_lies_in_one_piece_within_the_limits(spark, frame, edge_cases, tokenizer, limits):
    pieces = pack(frame(edge_cases), PATH, 2, limits).collect()
    check(pieces, limits)
    assert joined(pieces) == sorted(((d, [*ids_of(tokenizer, t), 2]) for d, t in edge_cases), key=repr)
    assert pack(frame([]), PATH, 2).count() == 0


def test_prompts_bear_no_loss(spark, tokenizer):
    rows = [(1, "answer one", "a question about it"), (2, None, "only a question"), (3, "no question", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, prompt string").coalesce(1)
    pieces = pack(docs, PATH, 2, Limits(64, 8, 64)).collect()
    check(pieces, Limits(64, 8, 64))
    for doc, text, prompt in rows:
        own = [p for p in pieces if p.doc_id == doc]
        assert sum(p.n_loss for p in own) == len(ids_of(tokenizer, text)) + 1
        assert own[0].doc_tokens == len(ids_of(tokenizer, text)) + 1 + len(ids_of(tokenizer, prompt))


def test_op3_on_the_tables(spark, sf_dir, tokenizer):
    pieces = op3_packing(spark, sf_dir).collect()
    places = defaultdict(list)
    for p in pieces:
        places[p.doc_id].append(p)
    total = 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids, at = np.array([*ids_of(tokenizer, r.text), 2], "<u4"), 0
        for p in sorted(places.pop(r.doc_id), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
        total += at
    assert not places
    used = defaultdict(int)
    for p in pieces:
        used[p.sequence_id] += p.length
    assert sum(4096 - n for n in used.values() if n & (n - 1)) < 0.01 * total


def test_the_first_part_of_a_text_bears_no_loss(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, None), (3, "a")], "doc_id long, text string")
    loss, tokens = defaultdict(int), {}
    for r in pack(docs, PATH, 2, Limits(), 0.25).collect():
        loss[r.doc_id] += r.n_loss
        tokens[r.doc_id] = r.doc_tokens
    assert tokens[1] > 9 and loss == {doc: n - (n - 1) // 4 for doc, n in tokens.items()}


def test_every_limit_binds_on_the_tables(spark):
    """Sequences that are full by tokens, by segments and by loss."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packed_documents(docs).collect()
    padding, total = check(pieces, DOCUMENT_LIMITS)
    assert padding < 0.01 * total
    used = defaultdict(lambda: [0, 0, 0])
    for p in pieces:
        for k, n in enumerate((p.length, 1, p.n_loss)):
            used[p.sequence_id][k] += n
    for k, limit in enumerate(DOCUMENT_LIMITS[:3]):
        assert any(u[k] == limit for u in used.values())


def test_the_next_example_has_the_largest_dot_product():
    draw = random.Random(5)
    limits = Limits(100, 6, 70, 4)
    for _ in range(200):
        pool, waiting = Pool(limits), []
        for key in range(draw.randint(1, 12)):
            n = draw.randint(1, 60)
            piece = (key, 0, np.zeros(n, "<u4"), draw.randint(0, n), n)
            pool.put(piece)
            waiting.append((key, n, n - piece[3]))
        left = [limits.tokens, limits.segments, limits.loss]
        for key, _, ids, plain, whole in pool.sequence(limits.tokens, limits.min_cut):
            fits = [w for w in waiting if w[1] <= left[0] and w[2] <= left[2]]
            if not fits:
                assert len(ids) < whole or left[0] >= limits.min_cut
                break
            demand = {w[0]: (w[1], 1, w[2]) for w in fits}
            gain = {k: sum(d * room / limit**2 for d, room, limit in zip(demand[k], left, limits)) for k in demand}
            assert gain[key] >= max(gain.values()) - 1e-9
            left = [room - d for room, d in zip(left, demand[key])]
            waiting = [w for w in waiting if w[0] != key]

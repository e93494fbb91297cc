"""Packing examples into training sequences by vector bin packing with the dot-product heuristic.

A sequence has three capacities: tokens, segments and loss-bearing tokens. Of the examples that fit
into what is left of all three, the one with the largest dot product of demand and remaining
capacity, each as a share of its limit, is placed next.
"""

import os
import sys
import types
from array import array
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import functions as F

from locrank.llm.words import give_back

#: Tokens a task holds while it packs; about 16 MB.
POOL_TOKENS = 2_000_000
#: Words, and parts of words, whose ids a worker remembers; about 120 MB.
CACHED_WORDS = 600_000
#: Bytes of text tokenized at a time.
TEXT_BYTES = 4_000_000


class Limits(NamedTuple):
    """Limits of a sequence; a gap of fewer than min_cut tokens is not filled by cutting an example."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096
    min_cut: int = 16


class WordTokenizer:
    """Ids of texts, word by word: the tokenizer's own rules never join text across white space.

    Words are divided further where its rules surely divide them, between letters, digits and other
    characters, so that fewer distinct strings have to be tokenized. ASCII words are divided and
    lower-cased as arrays of bytes, whole texts at once.
    """

    #: Kinds of bytes: letters, digits, others.
    _KIND = np.array([1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 0 for c in range(128)] + [0] * 128, np.uint8)
    _LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
    #: Words with such bytes stay whole: apostrophes and special tokens join others, accents may be composed.
    _WHOLE = np.array([c >= 0x80 or c in b"'<" for c in range(256)])
    #: Parts that are tokenized in one text.
    _JOINED = 100

    def __init__(self, path, end_id):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.known = {}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True

    @classmethod
    def parts(cls, words):
        """Parts of a binary array of words, one after the other, and at which part each word begins; the
        last of these numbers is that of all parts."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[: offsets[-1]]
        whole = np.zeros(len(words), bool)
        whole[np.searchsorted(offsets, np.flatnonzero(cls._WHOLE[data]), "right") - 1] = True
        kind, lowered = cls._KIND[data], cls._LOWER[data]
        if whole.any():
            inside = np.repeat(whole, np.diff(offsets))
            lowered[inside], kind[inside] = data[inside], 0
        begins = np.empty(len(data) + 1, bool)
        begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begins[offsets] = True
        cuts = np.flatnonzero(begins).astype(np.int32)
        divided = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(lowered)])
        return divided, np.searchsorted(cuts, offsets)

    @staticmethod
    def divided(word):
        """Strings that the tokenizer takes one by one, or None where that is not sure. Here ASCII words are
        divided already, unless they stay whole."""
        if word.isascii():
            return None if b"'" in word or b"<" in word else (word,)
        letters = word.rstrip(b",.;:!?")
        if not letters.decode().lower().isalpha():
            return None
        return (letters, word[len(letters) :]) if letters != word else (word,)

    def _joint(self, parts, into):
        """Ids of parts, told from each other in a joint text by the mark of a last token."""
        groups = [parts[at : at + self._JOINED] for at in range(0, len(parts), self._JOINED)]
        coded = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, code in zip(groups, coded):
            ids = np.array(code.ids, "<u4")
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            if len(ends) == len(group):
                data = ids.tobytes()
                into.update(zip(group, [data[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                self._alone(group, into)

    def _alone(self, words, into):
        coded = self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)
        into.update((word, array("I", code.ids).tobytes()) for word, code in zip(words, coded))

    def _learned(self, words):
        """Ids of words that are not known yet."""
        divided, ids = list(map(self.divided, words)), {}
        self._alone([word for word, parts in zip(words, divided) if parts is None], ids)
        self._joint(list(set(chain.from_iterable(parts for parts in divided if parts))), ids)
        return [
            ids[word] if parts is None or len(parts) == 1 else ids[parts[0]] + ids[parts[1]] for word, parts in zip(words, divided)
        ]

    def encode(self, texts):
        """Ids of each text of a string array as little-endian unsigned 32-bit numbers, without the end id."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        strings, row = lists.flatten(), pc.list_parent_indices(lists)
        real = pc.not_equal(pc.binary_length(strings), 0)
        sizes = np.bincount(row.filter(real), minlength=len(texts))
        if not sizes.any():
            return [b""] * len(texts)
        parts, begins = self.parts(strings.filter(real).cast(pa.binary()))
        coded = parts.dictionary_encode()
        words = coded.dictionary.to_pylist()
        ids = list(map(self.known.get, words))
        new = [k for k, known in enumerate(ids) if known is None]
        learned = self._learned([words[k] for k in new])
        for k, found in zip(new, learned):
            ids[k] = found
        # The first to come are the most frequent.
        room = max(0, CACHED_WORDS - len(self.known))
        self.known.update(islice(zip((words[k] for k in new), learned), room))
        joined = pa.array(ids, pa.binary()).take(coded.indices)
        bounds = begins[np.concatenate([[0], np.cumsum(sizes)])]
        ends = np.frombuffer(joined.buffers()[1], np.int32)[: len(joined) + 1][bounds]
        data = joined.buffers()[2].to_pybytes()
        return [data[start:end] for start, end in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _tokenizer(path, end_id):
    """The tokenizer of this worker process, which keeps the words it knows from task to task."""
    kept = sys.modules.setdefault("_tokenizers_of_worker", types.ModuleType("_tokenizers_of_worker")).__dict__
    if (path, end_id) not in kept:
        kept[path, end_id] = WordTokenizer(path, end_id)
    return kept[path, end_id]


class Pool:
    """Pieces that wait for a sequence: key, first token, ids and number of tokens without loss."""

    def __init__(self, limits):
        self.limits, self.pieces, self.tokens = limits, [], 0
        self.size, self.loss = np.zeros(1024), np.zeros(1024)

    def put(self, piece, at=None):
        """Add a piece, in place of the one at an index if that is given."""
        key, start, ids, plain, total = piece
        if at is None:
            at = len(self.pieces)
            self.pieces.append(piece)
            if at == len(self.size):
                self.size, self.loss = (np.concatenate([x, np.zeros(at)]) for x in (self.size, self.loss))
        else:
            self.pieces[at] = piece
        self.size[at], self.loss[at] = len(ids), len(ids) - plain
        self.tokens += len(ids)

    def drop(self, at):
        last = len(self.pieces) - 1
        self.tokens -= len(self.pieces[at][2])
        self.pieces[at] = self.pieces[last]
        self.size[at], self.loss[at] = self.size[last], self.loss[last]
        self.pieces.pop()

    def sequence(self, capacity, min_cut):
        """Pieces of the next sequence, taken out of the pool."""
        limits, taken = self.limits, []
        tokens, segments, loss = capacity, limits.segments, limits.loss
        while tokens and segments and self.pieces:
            n = len(self.pieces)
            size, bearing = self.size[:n], self.loss[:n]
            gain = size * (tokens / limits.tokens**2) + segments / limits.segments**2
            gain += bearing * (loss / limits.loss**2)
            whole = np.where((size <= tokens) & (bearing <= loss), gain, -1.0)
            at = int(whole.argmax())
            if whole[at] < 0:
                if tokens < min_cut:
                    break
                at = int(gain.argmax())
            key, start, ids, plain, total = self.pieces[at]
            length = min(len(ids), tokens, plain + loss)
            if length < (1 if whole[at] >= 0 else min_cut):
                break
            taken.append((key, start, ids[:length], min(plain, length), total))
            self.drop(at)
            if length < len(ids):
                self.put((key, start + length, ids[length:], max(0, plain - length), total))
            tokens, segments, loss = tokens - length, segments - 1, loss - max(0, length - plain)
        if not taken:  # the loss limit leaves less than min_cut of every piece
            key, start, ids, plain, total = self.pieces[0]
            length = max(1, min(len(ids), capacity, plain + limits.loss))
            self.drop(0)
            taken.append((key, start, ids[:length], min(plain, length), total))
            if length < len(ids):
                self.put((key, start + length, ids[length:], max(0, plain - length), total))
        return taken

    def sequences(self, leave):
        """Sequences until fewer than `leave` tokens wait.

        What is less than a whole sequence at the end gets sequences of decreasing powers of two,
        which need no padding.
        """
        while self.pieces and self.tokens > leave:
            if self.tokens >= self.limits.tokens:
                yield self.sequence(self.limits.tokens, self.limits.min_cut)
            else:
                yield self.sequence(1 << (self.tokens.bit_length() - 1), 1)


def _batches_of_text(batch, size):
    """(from, to) row ranges of about `size` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0)
    ends, start = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield start, end
        start = end


def _pack(path, end_id, limits, prompt_part):
    def rows_to_batch(rows):
        key, start, ids, plain, total, sequence, offset = zip(*rows)
        lengths = [len(x) for x in ids]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(key, key_type[0]),
                pa.array(start, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array([x.tobytes() for x in ids], pa.binary()),
                pa.array([n - p for n, p in zip(lengths, plain)], pa.int64()),
                pa.array(total, pa.int64()),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            names=["doc_id", "start", "length", "ids", "n_loss", "doc_tokens", "sequence_id", "offset"],
        )

    key_type = [None]

    def placed(sequences, number):
        rows = []
        for pieces in sequences:
            offset = 0
            for piece in pieces:
                rows.append((*piece, number[0], offset))
                offset += len(piece[2])
            number[0] += 1
            if len(rows) >= 2000:
                yield rows_to_batch(rows)
                rows = []
        if rows:
            yield rows_to_batch(rows)

    def scan(batches):
        tokenizer, pool = _tokenizer(path, end_id), Pool(limits)
        number = [TaskContext.get().partitionId() << 33]
        for batch in batches:
            key_type[0] = batch.schema.field("doc_id").type
            for start, end in _batches_of_text(batch, TEXT_BYTES):
                part = batch.slice(start, end - start)
                prompts, texts = (tokenizer.encode(part.column(name)) for name in ("prompt", "text"))
                give_back()
                for key, prompt, text in zip(part.column("doc_id").to_pylist(), prompts, texts):
                    ids = np.frombuffer(prompt + text + tokenizer.end, "<u4")
                    own = len(text) // 4
                    pool.put((key, 0, ids, len(prompt) // 4 + int(own * prompt_part), len(ids)))
                    if pool.tokens >= POOL_TOKENS:
                        yield from placed(pool.sequences(POOL_TOKENS // 2), number)
        yield from placed(pool.sequences(0), number)
        give_back()

    return scan


def pack(docs, tokenizer_path, end_id, limits=Limits(), prompt_part=0.0):
    """Pieces of docs(doc_id, text[, prompt]): doc_id, start, length, ids, n_loss, doc_tokens, sequence_id, offset.

    A document is its prompt, its text and end_id; the prompt's tokens bear no loss, nor does the first
    prompt_part, rounded down, of the text's tokens, for texts that begin with their prompt. ids holds a
    piece's ids as little-endian unsigned 32-bit numbers, offset its place in the sequence. Each
    id lies in one piece. Examples are cut where they are longer than what a sequence may hold, and
    where nothing whole fits into a gap of at least limits.min_cut tokens.

    * Null and empty texts and prompts have no ids, so such a document is the end id alone.
    * Repeated rows and null doc_ids are packed like others; ties go to the earlier of equal gains.
    * Empty docs give no row; other columns are ignored.

    Each task tokenizes and packs the rows of its own input split, holding POOL_TOKENS at most, so
    there is no shuffle and no key that could be hot. sequence_id is unique: the task's number, then
    a count. A task that runs again repeats its result.
    """
    kind = dict(docs.dtypes)["doc_id"]
    prompt = F.col("prompt") if "prompt" in docs.columns else F.lit(None)
    rows = docs.select("doc_id", "text", prompt.cast("string").alias("prompt"))
    layout = f"doc_id {kind}, start long, length long, ids binary, n_loss long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(_pack(tokenizer_path, end_id, limits, prompt_part), layout)


#: Of a document the first quarter of its tokens is its prompt; the limits of a sequence of 4096 tokens.
PROMPT_PART = 0.25
DOCUMENT_LIMITS = Limits(tokens=4096, segments=24, loss=3500)


def packed_documents(docs):
    """Whole documents in sequences of 4096 tokens of the word vocabulary, within DOCUMENT_LIMITS."""
    docs = docs.select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2, DOCUMENT_LIMITS, PROMPT_PART)


def op3_packing(spark, sf_dir):
    """Where each piece of each document lies, with a checksum of its ids."""
    pieces = packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "n_loss"
    )

"""Packing of tokenised texts into training sequences under several limits at once.

A sequence has at most so many tokens, segments (pieces of texts) and loss-bearing tokens. This
is bin packing with vectors, solved by the dot-product heuristic: the open sequence takes, of
all pieces that fit, the one whose vector of demands has the largest product with the vector of
what is left, each in shares of its limit. So a sequence with few segments left takes large
pieces, and one with little loss left takes pieces that bear little.

Texts may be cut. A text over the limit gives whole sequences first and its rest is packed;
when nothing fits any more, the largest piece that still can is cut to fill the sequence. A
sequence that cannot be filled is cut back to a power of two tokens, which needs no padding,
and what is cut off is packed again. So no sequence has any padding.

Every task packs the texts it reads, from a pool of bounded size, and empties the pool at its
end; no text is shuffled, and at most a dozen sequences a task are short. Texts are cut into
pieces that the tokenizer treats apart: before white space, and between ASCII letters, digits and
other marks, but not at an apostrophe or a character that is not ASCII. A piece is tokenised once
and kept at hand; plain words go to the tokenizer's model directly. The tokenizer must drop white space and split so, as ``word_bpe_49k.json`` does
(checked when it is loaded). A text that holds one of its special strings is tokenised as a whole.

The tokens of an example are those of its prompt, which bear no loss, those of its text, and a
closing token. Without a prompt the first token bears none, as nothing comes before it.

Defined results: a null or empty text is its closing token alone; repeated rows and rows with a
null id are packed one by one; an empty table gives an empty one. Only the id, text and prompt
columns are read. ``sequence_id`` has the task in its upper bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tiermill.llm import textbatch as tb

#: Pieces that wait to be packed, bytes of text tokenised together, and pieces of text kept at hand.
POOL, BYTES, WORDS = 256, 2 << 20, 1 << 19


# Kinds of bytes: 0 goes with its neighbours, 1 letter, 2 digit, 3 other, 4 white space.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[ord("'")] = 0
_KIND[tb.WHITE] = 4
#: Whether a piece begins between two kinds.
_BEGINS = np.array([y == 4 and x != 4 or 0 < x < 4 and 0 < y < 4 and (x != y or x == 2) for x in range(5) for y in range(5)])
#: Pieces in lower case that are one word to the tokenizer: its letters, or marks that each stand for their own byte.
_WORD = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u024f]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1 or self.tokens & (self.tokens - 1):
            raise ValueError("limits are at least 1, and that of tokens a power of two")


class Words:
    """Ids of texts, piece by piece."""

    def __init__(self, serialized: str):
        self.tokenizer = Tokenizer.from_str(serialized)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, level = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(k) for k in range(128, 0x250)]  # the model reads bytes as letters
        self.spelled = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self.clear()
        for text in (" it's\n\tÜnï-1  a ", "x9--y 'Tis [d's] 10%", "I'LL we'd œuvre ÉTÉ!?"):
            if self.encode(pa.array([text]))[0].tolist() != self.ids_of(text):
                raise ValueError("the tokenizer does not treat words apart")

    def ids_of(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _piece(self, piece: str) -> list[int]:
        word = piece.strip(" \t\n\v\f\r").lower()
        if not _WORD.fullmatch(word):
            return self.ids_of(piece)
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.spelled))]

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Places of distinct pieces in the tables, which take up what is new."""
        if len(self.number) + len(pieces) > WORDS:
            self.clear()
        known = self.number
        fresh = [w for w in pieces if w not in known]
        if fresh:
            lists = [self._piece(w) for w in fresh]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ends = len(self.ids) + np.cumsum(sizes)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            self.start, self.size = np.append(self.start, ends - sizes), np.append(self.size, sizes)
            self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text; a null text has none."""
        data, offsets = tb.buffers(texts)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(texts)
        kind = _KIND[data]
        begins = np.ones(len(data), bool)
        begins[1:] = _BEGINS[kind[:-1] * np.uint8(5) + kind[1:]]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(begins).astype(np.int32)
        cuts = pa.py_buffer(np.append(start, np.int32(len(data))))
        pieces = pa.StringArray.from_buffers(len(start), cuts, pa.py_buffer(tb.LOWER[data])).dictionary_encode()
        own = self._numbers(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        size = self.size[own]
        ids = self.ids[tb.ranges(self.start[own], size)]
        bounds = np.append(0, np.cumsum(size))[np.searchsorted(start, offsets)]
        out = [ids[a:z] for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for mark in self.special:
            for k in np.flatnonzero(pc.match_substring(texts, mark).fill_null(False).to_numpy(zero_copy_only=False)):
                out[k] = np.array(self.ids_of(texts[k].as_py()), np.uint32)
        return out


@lru_cache(maxsize=2)
def _words(serialized: str) -> Words:
    return Words(serialized)


@dataclass(slots=True)
class Example:
    id: object
    ids: np.ndarray
    loss_from: int  # the first token that bears loss

    def loss(self, start: int, end: int) -> int:
        return max(0, end - max(start, self.loss_from))

    def longest(self, start: int, tokens: int, loss: int) -> int:
        """The most tokens from ``start`` on within two limits."""
        size = min(tokens, len(self.ids) - start)
        return min(size, max(self.loss_from - start, 0) + loss)


class Packer:
    """Pieces of a task. A finished sequence is a list of (example, start, length)."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.shares = [1.0 / x**2 for x in (limits.tokens, limits.segments, limits.loss)]
        self.held: list[tuple[Example, int, int] | None] = []
        self.sizes = np.zeros((2, 0), np.int64)  # tokens and loss of every piece, each one segment; no tokens where there is none
        self.count = 0

    def _hold(self, example: Example, start: int, length: int) -> None:
        if self.count == len(self.held):
            live = [k for k, x in enumerate(self.held) if x is not None]
            room = max(64, 2 * len(live))
            sizes = np.zeros((2, room), np.int64)
            sizes[:, : len(live)] = self.sizes[:, live]
            self.held = [self.held[k] for k in live] + [None] * (room - len(live))
            self.sizes, self.free = sizes, list(range(room - 1, len(live) - 1, -1))
        place = self.free.pop()
        self.held[place] = (example, start, length)
        self.sizes[:, place] = length, example.loss(start, start + length)
        self.count += 1

    def _take(self, place: int) -> tuple[Example, int, int]:
        piece = self.held[place]
        self.held[place] = None
        self.sizes[:, place] = 0
        self.free.append(place)
        self.count -= 1
        return piece

    def add(self, example: Example) -> Iterator[list]:
        """Whole sequences of the example; its rest is held, and the pool is packed down to its bound."""
        limits, start = self.limits, 0
        while len(example.ids) - start >= limits.tokens and example.loss(start, start + limits.tokens) <= limits.loss:
            yield [(example, start, limits.tokens)]
            start += limits.tokens
        while start < len(example.ids):  # a piece is within every limit
            length = example.longest(start, limits.tokens, limits.loss)
            self._hold(example, start, length)
            start += length
        while self.count > POOL:
            yield self._fill()

    def rest(self) -> Iterator[list]:
        while self.count:
            yield self._fill()

    def _fill(self) -> list:
        """One sequence from the pool."""
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        found: list[tuple[Example, int, int]] = []
        while tokens and segments:
            fits = (self.sizes[0] > 0) & (self.sizes[0] <= tokens) & (self.sizes[1] <= loss)
            last = segments == 1 and not (fits & (self.sizes[0] == tokens)).any()
            if not last and fits.any():
                a, b, c = self.shares[0] * tokens, self.shares[1] * segments, self.shares[2] * loss
                piece = self._take(int(np.where(fits, a * self.sizes[0] + b + c * self.sizes[1], -1.0).argmax()))
            else:  # the largest piece of which something fits is cut
                piece = self._cut(tokens, loss)
                if piece is None:
                    break
            found.append(piece)
            tokens, segments, loss = tokens - piece[2], segments - 1, loss - piece[0].loss(piece[1], piece[1] + piece[2])
        size = self.limits.tokens - tokens
        over = size - (1 << (size.bit_length() - 1))
        while over:  # back to a power of two
            example, start, length = found.pop()
            kept = max(0, length - over)
            if kept:
                found.append((example, start, kept))
            self._hold(example, start + kept, length - kept)
            over -= length - kept
        return found

    def _cut(self, tokens: int, loss: int) -> tuple[Example, int, int] | None:
        for place in np.argsort(-self.sizes[0], kind="stable"):
            if self.held[place] is None:
                return None
            example, start, length = self.held[place]
            size = min(length, example.longest(start, tokens, loss))
            if size:
                self._take(place)
                if size < length:
                    self._hold(example, start + size, length - size)
                return example, start, size
        return None


def pack(
    docs: DataFrame, vocabulary: str, limits: Limits = Limits(), end: int = 1, doc_id: str = "doc_id", text: str = "text", prompt: str | None = None
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, loss_tokens, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's tokens as unsigned 32-bit numbers, low byte first. ``vocabulary`` is the
    path of a tokenizer file on the driver; its content travels with the tasks.
    """
    with open(vocabulary, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file: fixed size
    kind = docs.schema[doc_id].dataType
    columns = [F.col(doc_id).alias("id"), F.col(text).alias("text"), *([F.col(prompt).alias("prompt")] if prompt else [])]
    schema = f"id {kind.simpleString()}, start long, length long, ids binary, loss_tokens long, doc_tokens long, sequence_id long, offset long"

    closing = np.array([end], np.uint32)

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        words, ids = _words(held.value), batch.column("id").to_pylist()
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        if prompt:
            size = size + pc.fill_null(pc.binary_length(batch.column("prompt")), 0).to_numpy()
        group = (np.cumsum(size) - size) // BYTES
        for part in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(group)) + 1):
            rows = slice(int(part[0]), int(part[-1]) + 1)
            texts = words.encode(batch.column("text")[rows])
            asked = words.encode(batch.column("prompt")[rows]) if prompt else [texts[0][:0]] * len(part)
            for row, before, own in zip(part, asked, texts):
                yield Example(ids[row], np.concatenate([before, own, closing]), len(before) or 1)

    def run(batches):
        packer, number = Packer(limits), TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def told(sequence):
            nonlocal number
            offset = 0
            for example, start, length in sequence:
                ids = example.ids[start : start + length].astype("<u4").tobytes()
                loss = example.loss(start, start + length)
                rows.append((example.id, start, length, ids, loss, len(example.ids), number, offset))
                offset += length
            number += 1

        for batch in batches:
            if not batch.num_rows:
                continue
            for example in examples(batch):
                for sequence in packer.add(example):
                    told(sequence)
                if len(rows) > 4096:
                    yield _table(rows, batch.schema.field("id").type)
                    rows = []
            id_type = batch.schema.field("id").type
        for sequence in packer.rest():
            told(sequence)
        if rows:
            yield _table(rows, id_type)

    return docs.select(*columns).mapInArrow(run, schema).withColumnRenamed("id", doc_id)


def _table(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    names = ["id", "start", "length", "ids", "loss_tokens", "doc_tokens", "sequence_id", "offset"]
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

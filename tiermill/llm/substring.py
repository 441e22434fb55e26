"""Repeated word windows removed, found by a count-min prefilter and an exact second pass.

First pass. Every group of documents counts its windows in a sketch of its own; the sketches
are merged by adding their cells, slice by slice. A window is counted in the cells of its
anchor, the least hashed 8-word gram inside it: equal windows have equal anchors, so the
merged cells overestimate the count of every window and a repeated one is never missed,
while there are some fifteen times fewer anchors than windows to count. Only occupied cells
travel, and each group gets back the part of the merged sketch that it needs, so neither
the width of the sketch nor the corpus is limited by what one machine can hold.

Second pass. Windows estimated twice or more, and only they, are grouped exactly by 128-bit
hashes of their word sequences (two independent 64-bit ones over 64-bit word hashes). Each
group names a window once however often it has it, with count one or two: the merge of a
very common window sees one entry per group of documents.

Last pass. Every word covered by a repeated window goes.

Words are runs of bytes other than space and 0x09 to 0x0D, unchanged. Defined results: null
or empty texts have no words; documents shorter than a window lose nothing; repeated rows
and rows with a null id are documents like any other, and repeat each other. An empty table
gives an empty one. Only the id and text columns are read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tiermill.llm import exchange
from tiermill.llm import textbatch as tb

GRAM = 8
ROWS = 2
#: Cells of a sketch row for each anchor expected.
SPARE = 4

_SKETCH = pa.schema([("slice", pa.int32()), ("g", pa.int32()), ("depth", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])
_CELLS = pa.schema([("g", pa.int32()), ("slice", pa.int32()), ("depth", pa.int32()), ("cells", pa.binary())])
_WINDOWS = pa.schema([("slice", pa.int32()), ("g", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
_REPEATED = pa.schema([("g", pa.int32()), ("hashes", pa.binary())])


def _word_windows(data: np.ndarray, offsets: np.ndarray, window: int):
    """Texts of the words, hashes of the words, whether a whole window begins at each word."""
    start, end, doc = tb.words(data, offsets)
    return doc, tb.word_hashes(data, start, end), tb.together(doc, window)


def _anchors(hashes: np.ndarray, valid: np.ndarray, window: int):
    gram = min(GRAM, window)
    return tb.anchor_runs(tb.mix(tb.Sums(hashes, 1).rolling(gram), 1), valid, window - gram + 1)


def _cells(anchors: np.ndarray, slices: int, width: int) -> list[np.ndarray]:
    """For every sketch row the cell of each anchor; a slice owns ``width`` cells of a row."""
    part = anchors % np.uint64(slices)
    return [part * np.uint64(width) + tb.mix(anchors, 10 + row) % np.uint64(width) for row in range(ROWS)]


def _window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    both = np.empty((max(0, len(hashes) - window + 1), 2), np.uint64)
    for column, seed in enumerate((2, 3)):
        both[:, column] = tb.mix(tb.Sums(hashes, seed).rolling(window), seed)
    return both


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a two-column array, sorted, and how often each occurs."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return hashes[first], np.diff(np.append(first, len(hashes)))


def remove_repeats(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_removed`` and ``kept_text``, words joined by a space."""
    groups, slices, size = exchange.grouped(docs, doc_id, text)
    expected = size / 6 / max(1, (window - min(GRAM, window) + 2) / 2)
    width = max(1 << 10, 1 << int(SPARE * expected / slices).bit_length())

    def sketch(own: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, data, offsets in tb.chunks(own["text"]):
            _, hashes, valid = _word_windows(data, offsets, window)
            found.append(_anchors(hashes, valid, window)[0])
        g, rows = own["g"][0].as_py(), []
        for depth, cells in enumerate(_cells(np.concatenate(found), slices, width)):
            cells, counts = np.unique(cells, return_counts=True)
            part = cells // np.uint64(width)
            cells, counts = (cells % np.uint64(width)).astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
            cuts = np.flatnonzero(np.diff(part)) + 1
            for number, c, n in zip(part[np.append(0, cuts)] if len(part) else [], np.split(cells, cuts), np.split(counts, cuts)):
                rows.append((int(number), g, depth, c.tobytes(), n.tobytes()))
        return exchange.records(rows, _SKETCH)

    def merge_sketches(said: pa.Table) -> pa.Table:
        total = np.zeros((ROWS, width), np.uint32)
        depths, groups_ = said["depth"].to_pylist(), said["g"].to_pylist()
        cells, counts = exchange.blobs(said["cells"], np.uint32), exchange.blobs(said["counts"], np.uint8)
        for depth, c, n in zip(depths, cells, counts):
            total[depth, c] += n
        number = said["slice"][0].as_py()
        rows = [(g, number, depth, c[total[depth, c] > 1].tobytes()) for g, depth, c in zip(groups_, depths, cells)]
        return exchange.records([row for row in rows if row[3]], _CELLS)

    def estimate(own: pa.Table, merged: pa.Table) -> pa.Table:
        if not own.num_rows or not merged.num_rows:
            return exchange.records([], _WINDOWS)
        over = [[np.zeros(0, np.uint64)] for _ in range(ROWS)]
        for depth, number, c in zip(merged["depth"].to_pylist(), merged["slice"].to_pylist(), exchange.blobs(merged["cells"], np.uint32)):
            over[depth].append(c.astype(np.uint64) + np.uint64(number * width))
        over = [np.sort(np.concatenate(parts)) for parts in over]
        found = [np.zeros((0, 2), np.uint64)]
        for _, data, offsets in tb.chunks(own["text"]):
            _, hashes, valid = _word_windows(data, offsets, window)
            anchors, first, count = _anchors(hashes, valid, window)
            twice = np.ones(len(anchors), bool)
            for known, cells in zip(over, _cells(anchors, slices, width)):
                twice &= tb.isin(cells, known)
            if twice.any():
                found.append(_window_hashes(hashes, window)[tb.ranges(first[twice], count[twice])])
        distinct, count = _distinct(np.concatenate(found))
        g = own["g"][0].as_py()
        rows = [
            (number, g, distinct[at].tobytes(), np.minimum(count[at], 2).astype(np.uint8).tobytes())
            for number, at in exchange.by_slice(distinct[:, 0], slices)
        ]
        return exchange.records(rows, _WINDOWS)

    def group_exactly(said: pa.Table) -> pa.Table:
        parts = [x.reshape(-1, 2) for x in exchange.blobs(said["hashes"], np.uint64)]
        hashes, counts = np.concatenate(parts), exchange.joined(said["counts"], np.uint8)
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        ranked = hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
        label = np.cumsum(new) - 1
        twice = np.empty(len(hashes), bool)
        twice[order] = (np.bincount(label, counts[order]) > 1)[label]
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        rows = [(g, p[t].tobytes()) for g, p, t in zip(said["g"].to_pylist(), parts, np.split(twice, cuts))]
        return exchange.records([row for row in rows if row[1]], _REPEATED)

    result = f"id {docs.schema[doc_id].dataType.simpleString()}, n_words long, n_removed long, kept_text string"

    def cut(own: pa.Table, repeated: pa.Table) -> pa.Table:
        known = _distinct(exchange.joined(repeated["hashes"], np.uint64).reshape(-1, 2))[0]
        maybe = np.zeros(1 << 20, bool)
        maybe[(known[:, 0] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        n_words, n_removed, kept = [], [], []
        for _, data, offsets in tb.chunks(own["text"]):
            doc, hashes, valid = _word_windows(data, offsets, window)
            gone = np.zeros(len(doc), bool)
            if len(known) and valid.any():
                both = _window_hashes(hashes, window)
                at = np.flatnonzero(valid & maybe[(both[:, 0] & np.uint64((1 << 20) - 1)).astype(np.int64)])
                gone = tb.covered(at[tb.rows_in(both[at], known)], window, len(doc))
            cuts = np.searchsorted(doc, np.arange(len(offsets)))
            raw = data.tobytes()
            for row in range(len(offsets) - 1):
                own_words = raw[offsets[row] : offsets[row + 1]].split()
                lost = gone[cuts[row] : cuts[row + 1]]
                n = int(lost.sum())
                n_words.append(len(own_words))
                n_removed.append(n)
                kept.append(b" ".join(compress(own_words, ~lost) if n else own_words))
        return pa.table(
            {"id": own["id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
             "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
        )

    cells = groups.groupBy("g").applyInArrow(sketch, "slice int, g int, depth int, cells binary, counts binary")
    merged = cells.groupBy("slice").applyInArrow(merge_sketches, "g int, slice int, depth int, cells binary")
    windows = exchange.both(groups, merged, "g", estimate, "slice int, g int, hashes binary, counts binary")
    repeated = windows.groupBy("slice").applyInArrow(group_exactly, "g int, hashes binary")
    return exchange.both(groups, repeated, "g", cut, result).withColumnRenamed("id", doc_id)

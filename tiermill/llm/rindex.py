"""Long repeated byte strings marked and removed with a run-length index.

Three things keep the index of a large corpus in small parts. Equal strings of ``length``
bytes have equal anchors (the least hashed 48-byte gram inside) at equal places, so windows
with one anchor form a piece of text and only pieces with equal anchors need to be compared.
Anchors that occur once are dropped, and of equal pieces one is indexed, with its count: a
group of thousands of copies is indexed once. Pieces go to slices by their anchor.

A slice builds, for blocks of its pieces, the Burrows-Wheeler transform of the collection
and keeps its runs: the suffix positions at both ends of every run are sampled, and for each
the length of the match with the neighbouring suffix across the run's boundary is measured.
Inside a run a match grows by one byte for each byte to the left, so streaming over the text
from sample to sample gives every position's matching statistic, the longest string from
there that also begins elsewhere. Windows whose statistic reaches ``length``, and all windows
of a piece with two copies, are repeated. The documents then drop all bytes they cover.

An anchor with more than ``BUSY`` different pieces (a line common to very many documents)
would be an unbounded block. Its windows are dealt by a 128-bit hash of the window itself
and counted, which is exact and spreads them; nothing is left out.

Pieces are identified by 128 bits of hashes of anchor and piece. Defined results: null texts
are empty; matches never cross documents; documents under ``length`` bytes lose nothing;
repeated rows and rows with a null id are documents like any other. An empty table gives an
empty one. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tiermill.llm import exchange
from tiermill.llm import textbatch as tb

GRAM = 48
#: Different pieces of one anchor up to which they are indexed together.
BUSY = 4096
#: Bytes of pieces in a block. With ``BUSY`` pieces of one anchor it stays under 2**21, so that
#: two ranks and a position fit into one number to sort.
BLOCK = 1 << 20
_IDX = 21
#: With this length ``BUSY`` pieces, each of at most twice the length less a gram, still fit.
LONGEST = ((1 << _IDX) // BUSY + GRAM) // 2 - 1
#: Bits of a table that tells most windows apart from the repeated ones.
_FILTER = 1 << 20

_SAID = pa.schema([("slice", pa.int32()), ("g", pa.int32()), ("anchors", pa.binary()), ("pieces", pa.binary()), ("counts", pa.binary())])
_ASKED = pa.schema([("g", pa.int32()), ("anchors", pa.binary()), ("pieces", pa.binary()), ("weights", pa.binary())])
_SENT = pa.schema([("slice", pa.int32()), ("g", pa.int32()), ("anchors", pa.binary()), ("pieces", pa.binary()),
                   ("weights", pa.binary()), ("sizes", pa.binary()), ("body", pa.binary())])
_MARKS = pa.schema([("g", pa.int32()), ("pieces", pa.binary()), ("marks", pa.binary())])
_DDL = {pa.int32(): "int", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


class Cut:
    """The pieces of a batch of texts: anchor, identity, first byte, number of windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        gram = min(GRAM, length)
        self.sums = tb.byte_sums(data)
        last = offsets[1:] - length + 1
        steps = np.zeros(len(data) + 1, np.int64)
        some = last > offsets[:-1]
        np.add.at(steps, offsets[:-1][some], 1)
        np.add.at(steps, last[some], -1)
        valid = np.cumsum(steps)[: max(0, len(data) - length + 1)] > 0
        grams = tb.mix(self.sums.rolling(gram), 1)
        self.anchors, self.first, self.count = tb.anchor_runs(grams, valid, length - gram + 1)
        whole = self.sums.of(self.first, self.first + self.count + length - 1)
        self.pieces = tb.mix(whole + self.count.astype(np.uint64), 2) ^ tb.mix(self.anchors, 3)


def _suffix_order(text: np.ndarray, end: np.ndarray, longest: int):
    """Sorted suffixes of the pieces in ``text`` and the ranks by their first 5, 10, 20 ... bytes.

    ``end`` is where the piece of each position ends; what follows is less than any byte, and
    equal suffixes of different pieces are ordered by position.
    """
    n = len(text)
    place = np.arange(n, dtype=np.int64)
    code = np.zeros(n, np.int64)
    for step in range(5):
        inside = place + step < end
        code *= 257
        code[inside] += text[place[inside] + step].astype(np.int64) + 1
    keys, depth, ranks, classes = code, 5, [], 0
    while True:
        order = np.sort((keys << _IDX) | place) if keys is code else np.sort(keys)
        position = order & ((1 << _IDX) - 1)
        order >>= _IDX
        new = np.ones(n, np.int32)
        new[1:] = order[1:] != order[:-1]
        rank = np.empty(n, np.int32)
        rank[position] = np.cumsum(new, dtype=np.int32)
        ranks.append((depth, rank))
        total = int(new.sum())
        if total == n or total == classes or depth >= longest:
            return position, ranks
        classes = total
        follower = place + depth
        second = np.where(follower < end, rank[np.minimum(follower, n - 1)], 0).astype(np.int64)
        keys = (rank.astype(np.int64) << (2 * _IDX)) | (second << _IDX) | place
        depth *= 2


def _common(x: np.ndarray, y: np.ndarray, text: np.ndarray, end: np.ndarray, ranks) -> np.ndarray:
    """Length of the string that begins at both positions, by halves and then byte by byte."""
    n, size = len(text), np.zeros(len(x), np.int64)
    room = np.minimum(end[x] - x, end[y] - y)
    for depth, rank in reversed(ranks):
        a, b = np.minimum(x + size, n - 1), np.minimum(y + size, n - 1)
        size += np.where((size + depth <= room) & (rank[a] == rank[b]), depth, 0)
    for _ in range(5):
        a, b = np.minimum(x + size, n - 1), np.minimum(y + size, n - 1)
        size += (size < room) & (text[a] == text[b])
    return size


def matching_statistics(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Longest string from each position that also begins elsewhere in the collection of pieces.

    ``bounds`` are the offsets of the pieces in ``text``. The statistic of a position follows
    from the nearest sampled run end at or before it.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    end = np.repeat(bounds[1:], sizes)
    suffixes, ranks = _suffix_order(text, end, int(sizes.max()))
    opening = np.zeros(n, bool)
    opening[bounds[:-1][sizes > 0]] = True
    bwt = np.where(opening[suffixes], -1, text[suffixes - 1].astype(np.int16))  # -1: nothing before
    changes = (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0)
    best = np.zeros(n, np.int64)
    for here, other in ((slice(1, None), slice(None, -1)), (slice(None, -1), slice(1, None))):
        # run heads against the suffix above, then run ends against the suffix below
        sampled, neighbour = suffixes[here][changes], suffixes[other][changes]
        reach = np.full(n, -1, np.int64)
        reach[bounds[:-1][sizes > 0]] = 0
        edge = suffixes[0] if here.start == 1 else suffixes[-1]
        reach[edge] = 0
        reach[sampled] = _common(sampled, neighbour, text, end, ranks)
        known = np.flatnonzero(reach >= 0)
        nearest = known[np.cumsum(reach >= 0) - 1]
        best = np.maximum(best, reach[nearest] - (np.arange(n) - nearest))
    return best


def _ranges(flags: np.ndarray) -> np.ndarray:
    """First and end of each stretch of true, as rows."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges.reshape(-1, 2)


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and the bytes ``kept``."""
    if not GRAM < length <= LONGEST:
        raise ValueError(f"length is over {GRAM} and at most {LONGEST}")
    groups, slices, _ = exchange.grouped(docs, doc_id, text)

    def state(own: pa.Table) -> pa.Table:
        cuts = [Cut(data, offsets, length) for _, data, offsets in tb.chunks(own["text"])]
        anchors = np.concatenate([c.anchors for c in cuts])
        pieces, first, counts = np.unique(np.concatenate([c.pieces for c in cuts]), return_index=True, return_counts=True)
        anchors, g = anchors[first], own["g"][0].as_py()
        counts = np.minimum(counts, 2).astype(np.uint8)
        rows = [(number, g, anchors[at].tobytes(), pieces[at].tobytes(), counts[at].tobytes())
                for number, at in exchange.by_slice(anchors, slices)]
        return exchange.records(rows, _SAID)

    def choose(said: pa.Table) -> pa.Table:
        """Who sends which piece: one group for each different piece; weight 0 asks for windows, not for the piece."""
        parts = exchange.blobs(said["anchors"], np.uint64)
        anchors, pieces = np.concatenate(parts), exchange.joined(said["pieces"], np.uint64)
        counts = exchange.joined(said["counts"], np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.lexsort((owner, pieces, anchors))
        anchors, pieces, counts, owner = anchors[order], pieces[order], counts[order], owner[order]
        new_anchor, new_piece = np.ones(len(order), bool), np.ones(len(order), bool)
        new_anchor[1:] = anchors[1:] != anchors[:-1]
        new_piece[1:] = new_anchor[1:] | (pieces[1:] != pieces[:-1])
        anchor_no, piece_no = np.cumsum(new_anchor) - 1, np.cumsum(new_piece) - 1
        copies = np.bincount(piece_no, counts)[piece_no]
        often = np.bincount(anchor_no, counts)[anchor_no]
        busy = np.bincount(anchor_no, new_piece)[anchor_no] > BUSY
        asked = (often > 1) & (new_piece | busy)
        weights = np.where(busy, 0, np.minimum(copies, 2)).astype(np.uint8)
        rows, groups_ = [], said["g"].to_pylist()
        places = np.flatnonzero(asked)
        places = places[np.argsort(owner[places], kind="stable")]  # by owner, then as before
        for at in np.split(places, np.flatnonzero(np.diff(owner[places])) + 1):
            if len(at):
                rows.append((groups_[owner[at[0]]], anchors[at].tobytes(), pieces[at].tobytes(), weights[at].tobytes()))
        return exchange.records(rows, _ASKED)

    def send(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return exchange.records([], _SENT)
        wanted, weights = exchange.joined(asked["pieces"], np.uint64), exchange.joined(asked["weights"], np.uint8)
        order = np.argsort(wanted)
        wanted, weights = wanted[order], weights[order]
        done = np.zeros(len(wanted), bool)
        anchors, pieces, weight, bodies, windows = [], [], [], [], [np.zeros((0, 3), np.uint64)]
        for _, data, offsets in tb.chunks(own["text"]):
            cut = Cut(data, offsets, length)
            place = np.searchsorted(wanted, cut.pieces)
            place[place == len(wanted)] = 0
            asked_for = wanted[place] == cut.pieces
            light = np.flatnonzero(asked_for & (weights[place] == 0))
            at = np.flatnonzero(asked_for & (weights[place] > 0) & ~done[place])
            _, once = np.unique(place[at], return_index=True)
            at = at[once]
            done[place[at]] = True
            for i in at:
                bodies.append(data[cut.first[i] : cut.first[i] + cut.count[i] + length - 1].tobytes())
            anchors.append(cut.anchors[at])
            pieces.append(cut.pieces[at])
            weight.append(weights[place[at]])
            if len(light):
                windows.append(_busy_windows(cut, light, data, length))
        g, rows = own["g"][0].as_py(), []
        anchors, pieces, weight = np.concatenate(anchors), np.concatenate(pieces), np.concatenate(weight)
        for number, at in exchange.by_slice(anchors, slices):
            body = [bodies[i] for i in at]
            sizes = np.array([len(b) for b in body], np.uint16)
            rows.append((number, g, anchors[at].tobytes(), pieces[at].tobytes(), weight[at].tobytes(), sizes.tobytes(), b"".join(body)))
        windows, times = _count_rows(np.concatenate(windows))
        for number, at in exchange.by_slice(windows[:, 0], slices):
            rows.append((number, g, windows[at, :2].tobytes(), b"", np.minimum(times[at], 2).astype(np.uint8).tobytes(), b"", b""))
        return exchange.records(rows, _SENT)

    def index(said: pa.Table, sent: pa.Table) -> pa.Table:
        """Marks for every group that said it has a piece: piece, first and end of the repeated windows."""
        whole = [bool(len(x)) for x in exchange.blobs(sent["pieces"], np.uint8)]
        light = sent.filter(pa.array([not w for w in whole], pa.bool_()))
        sent = sent.filter(pa.array(whole, pa.bool_()))
        rows = _count_windows(light)
        if sent.num_rows:
            anchors, pieces = exchange.joined(sent["anchors"], np.uint64), exchange.joined(sent["pieces"], np.uint64)
            weights, sizes = exchange.joined(sent["weights"], np.uint8), exchange.joined(sent["sizes"], np.uint16).astype(np.int64)
            text = exchange.joined(sent["body"], np.uint8)
            offsets = np.append(0, np.cumsum(sizes))
            order = np.argsort(anchors, kind="stable")
            marks = []
            for block in _blocks(anchors[order], sizes[order]):
                own = order[block]
                bounds = np.append(0, np.cumsum(sizes[own]))
                body = np.concatenate([text[offsets[i] : offsets[i + 1]] for i in own])
                repeated = matching_statistics(body, bounds) >= length
                repeated |= np.repeat(weights[own] > 1, sizes[own])
                tail = np.repeat(bounds[1:], sizes[own]) - np.arange(len(body)) < length
                spans = _ranges(repeated & ~tail)
                piece = np.searchsorted(bounds, spans[:, 0], "right") - 1
                marks.append((pieces[own][piece], spans - bounds[piece][:, None]))
            names = np.concatenate([m[0] for m in marks])
            spans = np.concatenate([m[1] for m in marks]).astype(np.uint16)
            order = np.argsort(names, kind="stable")
            names, spans = names[order], spans[order]
            for g, own in zip(said["g"].to_pylist(), exchange.blobs(said["pieces"], np.uint64)):
                low, high = np.searchsorted(names, own, "left"), np.searchsorted(names, own, "right")
                at = tb.ranges(low, high - low)
                if len(at):
                    rows.append((g, names[at].tobytes(), spans[at].tobytes()))
        return exchange.records(rows, _MARKS)

    result = f"id {docs.schema[doc_id].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"

    def cut_out(own: pa.Table, marks: pa.Table) -> pa.Table:
        piece_rows = [bool(len(x)) for x in exchange.blobs(marks["pieces"], np.uint8)]
        hashed = exchange.joined(marks.filter(pa.array([not p for p in piece_rows], pa.bool_()))["marks"], np.uint64).reshape(-1, 2)
        marks = marks.filter(pa.array(piece_rows, pa.bool_()))
        names, spans = exchange.joined(marks["pieces"], np.uint64), exchange.joined(marks["marks"], np.uint16).reshape(-1, 2)
        order = np.argsort(names, kind="stable")
        names, spans = names[order], spans[order].astype(np.int64)
        hashed = _count_rows(hashed)[0]
        filtered = np.zeros(_FILTER, bool)
        filtered[(hashed[:, 0] & np.uint64(_FILTER - 1)).astype(np.int64)] = True
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for _, data, offsets in tb.chunks(own["text"]):
            steps = np.zeros(len(data) + 1, np.int64)
            if len(names) or len(hashed):
                cut = Cut(data, offsets, length)
                low, high = np.searchsorted(names, cut.pieces, "left"), np.searchsorted(names, cut.pieces, "right")
                has = np.flatnonzero(high > low)
                many = high[has] - low[has]
                row = tb.ranges(low[has], many)
                base = np.repeat(cut.first[has], many)
                np.add.at(steps, base + spans[row, 0], 1)
                np.add.at(steps, base + spans[row, 1] + length - 1, -1)
                if len(hashed):
                    first = tb.ranges(cut.first, cut.count)
                    hashes = tb.mix(cut.sums.of(first, first + length), 5)
                    maybe = np.flatnonzero(filtered[(hashes & np.uint64(_FILTER - 1)).astype(np.int64)])
                    first, hashes = first[maybe], hashes[maybe]
                    second = tb.mix(tb.byte_sums(data, 4).of(first, first + length), 6)
                    hit = first[tb.rows_in(np.stack([hashes, second], axis=1), hashed)]
                    np.add.at(steps, hit, 1)
                    np.add.at(steps, hit + length, -1)
            gone = np.cumsum(steps[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = offsets[:-1][offsets[:-1] < offsets[1:]]
            opens[inner] |= gone[inner]
            removed, spans_before = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(opens))
            rest = data[~gone].tobytes()
            at = offsets - removed[offsets]
            n_bytes.append(np.diff(offsets))
            n_removed.append(np.diff(removed[offsets]))
            n_spans.append(np.diff(spans_before[offsets]))
            kept += [rest[a:b] for a, b in zip(at[:-1], at[1:])]
        return pa.table({"id": own["id"], "n_bytes": np.concatenate(n_bytes), "n_removed": np.concatenate(n_removed),
                         "n_spans": np.concatenate(n_spans), "kept": pa.array(kept, pa.binary())})

    said = groups.groupBy("g").applyInArrow(state, _ddl(_SAID))
    asked = said.groupBy("slice").applyInArrow(choose, _ddl(_ASKED))
    sent = exchange.both(groups, asked, "g", send, _ddl(_SENT))
    marks = exchange.both(said, sent, "slice", index, _ddl(_MARKS))
    return exchange.both(groups, marks, "g", cut_out, result).withColumnRenamed("id", doc_id)


def _busy_windows(cut: Cut, at: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """Two hashes and the first byte of every window of the given pieces."""
    count = cut.count[at]
    first = tb.ranges(cut.first[at], count)
    second = tb.byte_sums(data, 4)
    return np.stack([tb.mix(cut.sums.of(first, first + length), 5), tb.mix(second.of(first, first + length), 6), first.astype(np.uint64)], axis=1)


def _count_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows by their first two numbers, sorted, and how often each occurs."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    first = np.flatnonzero(new)
    return rows[first], np.diff(np.append(first, len(rows)))


def _count_windows(light: pa.Table) -> list[tuple]:
    """For each group the windows among its own that occur twice or more."""
    if not light.num_rows:
        return []
    parts = [x.reshape(-1, 2) for x in exchange.blobs(light["anchors"], np.uint64)]
    rows, times = np.concatenate(parts), exchange.joined(light["weights"], np.uint8)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    ranked = rows[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    label = np.cumsum(new) - 1
    twice = np.empty(len(rows), bool)
    twice[order] = (np.bincount(label, times[order]) > 1)[label]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return [(g, b"", p[t].tobytes()) for g, p, t in zip(light["g"].to_pylist(), parts, np.split(twice, cuts)) if t.any()]


def _blocks(anchors: np.ndarray, sizes: np.ndarray):
    """Consecutive pieces, whole anchors, of about ``BLOCK`` bytes."""
    cuts = np.append(np.flatnonzero(np.diff(anchors)) + 1, len(anchors))
    start, filled, before = 0, 0, 0
    for cut in cuts:
        size = int(sizes[before:cut].sum())
        if filled and filled + size > BLOCK:
            yield np.arange(start, before)
            start, filled = before, 0
        filled, before = filled + size, int(cut)
    yield np.arange(start, before)

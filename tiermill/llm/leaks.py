"""Benchmark items found in training text: BM25 with block-max pruning, then exact overlap.

The index holds the test items, cut into question and answer: for each term its items with
their BM25 impact, in blocks of ``BLOCK`` items with the largest impact of each block. Impacts
are divided by the item's score for its own words, so a score is the share of an item's
weight that a passage has. Passages grow with the items, so that one threshold fits items of
any length: items are grouped by their words, up to ``PASSAGE / 2`` in the first group and
twice as many in each further one, and every group has postings and blocks of its own. For
each group every document is cut into overlapping windows of twice the group's most words,
half a window apart, so that a copy of an item is whole in one; every window is a query. A passage whose terms' largest impacts do not reach the
threshold is left at once; for the others the bounds of blocks are summed and only blocks
that reach the threshold are scored item by item. All items above it are retrieved: pruning
drops none of them.

A retrieved item is a leak if the document has at least ``percent`` of the distinct 5-word
shingles of its question and of its answer (a part of fewer words is one shingle). Words are
runs of bytes other than white space and ASCII punctuation, A-Z in lower case.

The index is sent to all tasks in shards of at most ``SHARD_BYTES`` of item text; more items
than that are searched shard by shard, with document frequencies over all items. Documents
are never shuffled, so no source, bucket or item can be hot.

Defined results: null or empty texts and items have no words and match nothing; an item
with an empty answer is judged by its question alone. Repeated rows, rows with a null id and
repeated items are judged one by one. Empty tables give an empty result. Only the named
columns are read.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm import textbatch as tb
from tiermill.session import freeze

SHINGLE, PASSAGE, BLOCK = 5, 128, 8
THRESHOLD, K1, B = 0.5, 1.2, 0.75
SHARD_BYTES = 16 << 20

PLAIN = tb.LOWER.copy()
PLAIN[[ord(c) for c in string.punctuation]] = 0x20


def _hashes(text: str) -> np.ndarray:
    data = PLAIN[np.frombuffer(text.encode(), np.uint8)]
    start, end, _ = tb.words(data, np.array([0, len(data)]))
    return tb.word_hashes(data, start, end)


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    return np.unique(tb.mix(tb.Sums(hashes, 1).rolling(width), 1)) if len(hashes) else np.zeros(0, np.uint64)


class _Group:
    """Postings of the items that passages of one length fit; terms are numbered over all groups."""

    def __init__(self, passage: int, known: np.ndarray, terms: np.ndarray, item: np.ndarray, impact: np.ndarray):
        self.passage = passage
        order = np.lexsort((item, terms))
        terms, self.item, self.impact = np.searchsorted(known, terms[order]), item[order], impact[order]
        # Postings of a term in one block of items stand together.
        _, place = np.unique(self.item, return_inverse=True)
        block = place // BLOCK
        opens = np.ones(len(terms), bool)
        opens[1:] = (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])
        self.block_first = np.append(np.flatnonzero(opens), len(terms))
        self.block = block[self.block_first[:-1]]
        self.block_most = np.maximum.reduceat(self.impact, self.block_first[:-1])
        self.term_first = np.searchsorted(terms[self.block_first[:-1]], np.arange(len(known) + 1))
        self.most = np.zeros(len(known))
        np.maximum.at(self.most, terms, self.impact)

    def search(self, terms: np.ndarray, first: np.ndarray, items: int, threshold: float):
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        low = threshold - 1e-9
        sizes, step = np.diff(first), self.passage // 2
        many = np.where(sizes > 0, np.maximum(1, -(-(sizes - step) // step)), 0)
        text = np.repeat(np.arange(len(sizes)), many)
        start = first[text] + step * tb.ranges(np.zeros(len(many), np.int64), many)
        end = np.minimum(start + self.passage, first[text + 1])
        bound = np.zeros(len(terms) + 1)
        np.cumsum(np.where(terms >= 0, self.most[terms], 0.0), out=bound[1:])
        alive = np.flatnonzero(bound[end] - bound[start] >= low)
        if not len(alive):
            return none
        size = end[alive] - start[alive]
        own = terms[tb.ranges(start[alive], size)]
        ours = (own >= 0) & (self.most[own] > 0)
        pairs = np.unique(np.repeat(np.arange(len(alive)), size)[ours] * len(self.most) + own[ours])
        passage, own = pairs // len(self.most), pairs % len(self.most)
        again = np.bincount(passage, self.most[own], minlength=len(alive)) >= low  # each term once
        keep = again[passage]
        passage, own = passage[keep], own[keep]
        blocks = self.term_first[own + 1] - self.term_first[own]
        entry = tb.ranges(self.term_first[own], blocks)
        total = int(self.block.max()) + 1
        where = np.repeat(passage, blocks) * total + self.block[entry]
        names, place = np.unique(where, return_inverse=True)
        live = (np.bincount(place, self.block_most[entry]) >= low)[place]
        where, entry = where[live], entry[live]
        count = self.block_first[entry + 1] - self.block_first[entry]
        posting = tb.ranges(self.block_first[entry], count)
        found = np.repeat(where // total, count) * items + self.item[posting]
        names, place = np.unique(found, return_inverse=True)
        scores = np.bincount(place, self.impact[posting]) if len(names) else np.zeros(0)
        over = scores >= low
        return text[alive[names[over] // items]], names[over] % items, scores[over]


class Index:
    """The test items of a shard. ``rows`` has (item, question, answer) and ``frequency`` the items of each term hash."""

    def __init__(self, rows: list[tuple], frequency: dict[int, int], items: int, mean: float):
        self.items, postings = [], {}
        for number, (item, question, answer) in enumerate(rows):
            q, a = _hashes(question or ""), _hashes(answer or "")
            widths = [min(SHINGLE, len(x)) for x in (q, a)]
            self.items.append((item, [(w, _shingles(x, w)) for x, w in zip((q, a), widths) if w]))
            terms, times = np.unique(np.concatenate([q, a]), return_counts=True)
            if not len(terms):
                continue
            share = np.array([frequency[int(t)] for t in terms])
            weight = np.log(1 + (items - share + 0.5) / (share + 0.5))
            impact = weight * times * (K1 + 1) / (times + K1 * (1 - B + B * times.sum() / mean))
            passage = PASSAGE
            while passage < 2 * times.sum():
                passage *= 2
            postings.setdefault(passage, []).append((terms, np.full(len(terms), number), impact / impact.sum()))
        every = [terms for own in postings.values() for terms, _, _ in own]
        self.terms = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.groups = [_Group(passage, self.terms, *map(np.concatenate, zip(*own))) for passage, own in sorted(postings.items())]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def term_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """-1 for words of no item."""
        out = np.full(len(hashes), -1)
        at = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(at):
            place = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
            hit = self.terms[place] == hashes[at]
            out[at[hit]] = place[hit]
        return out

    def search(self, terms: np.ndarray, first: np.ndarray, threshold: float):
        """Text number, item number and score of every passage and item over the threshold.

        ``terms`` are the term numbers of the words of all texts, ``first`` where each text begins.
        """
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        found += [group.search(terms, first, len(self.items), threshold) for group in self.groups]
        return tuple(map(np.concatenate, zip(*found)))

    def overlaps(self, item: int, hashes: np.ndarray, known: dict[int, np.ndarray]) -> list[float]:
        """Percent of the shingles of question and answer that a text has; ``known`` keeps the text's shingles by width."""
        out = []
        for width, wanted in self.items[item][1]:
            if width not in known:
                known[width] = _shingles(hashes, width) if len(hashes) >= width else np.zeros(0, np.uint64)
            out.append(100.0 * tb.isin(wanted, known[width]).sum() / len(wanted))
        return out


def _shards(items: DataFrame, item_id: str, question: str, answer: str):
    """Indexes of bounded size; terms are counted over all items."""
    rows = freeze(items.select(F.col(item_id).alias("item"), F.col(question).alias("question"), F.col(answer).alias("answer")))
    size, total = rows.agg(F.sum(F.octet_length("question") + F.coalesce(F.octet_length("answer"), F.lit(0))), F.count("*")).first()
    shards = max(1, math.ceil((size or 0) / SHARD_BYTES))

    def terms(batches):
        for batch in batches:
            lists = [np.concatenate([_hashes(q or ""), _hashes(a or "")]).view(np.int64)
                     for q, a in zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist())]
            yield pa.record_batch({"shard": batch.column("shard"), "terms": pa.array(lists, pa.list_(pa.int64()))})

    split = rows.withColumn("shard", F.pmod(F.xxhash64("item", "question"), F.lit(shards)).cast("int"))
    counted = split.mapInArrow(terms, "shard int, terms array<long>")
    mean = counted.agg(F.avg(F.size("terms"))).first()[0] or 1.0
    each = counted.select("shard", F.explode(F.array_distinct("terms")).alias("term"))
    frequency = freeze(each.groupBy("term").agg(F.count("*").alias("n"), F.collect_set("shard").alias("shards")))
    for shard in range(shards):
        own = split.filter(F.col("shard") == shard).orderBy("item").select("item", "question", "answer").collect()
        known = frequency.filter(F.array_contains("shards", shard)).select("term", "n").collect()
        yield Index([tuple(r) for r in own], {r.term & (2**64 - 1): r.n for r in known}, total, mean)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    percent: float = 75.0,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    question: str = "question",
    answer: str = "answer",
) -> DataFrame:
    """One row per document and leaked item: ids, best passage ``score``, ``question_percent``, ``answer_percent``."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = f"id {docs.schema[doc_id].dataType.simpleString()}, item {items.schema[item_id].dataType.simpleString()}, "
    schema += "score double, question_percent double, answer_percent double"
    found = None
    for index in _shards(items, item_id, question, answer):
        part = rows.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(index), threshold, percent), schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnsRenamed({"id": doc_id, "item": item_id})


def _each(index: Index, column, threshold: float, percent: float):
    """Row, item number, score and overlaps of the leaks in a column of texts."""
    for first_row, data, offsets in tb.chunks(column):
        data = PLAIN[data]
        start, end, doc = tb.words(data, offsets)
        hashes = tb.word_hashes(data, start, end)
        first = np.searchsorted(doc, np.arange(len(offsets)))
        texts, numbers, scores = index.search(index.term_numbers(hashes), first, threshold)
        best: dict = {}
        for t, i, s in zip(texts.tolist(), numbers.tolist(), scores.tolist()):
            best[t, i] = max(s, best.get((t, i), 0.0))
        known: dict = {}
        for (t, i), score in sorted(best.items()):
            overlaps = index.overlaps(i, hashes[first[t] : first[t + 1]], known.setdefault(t, {}))
            if overlaps and min(overlaps) >= percent:
                yield first_row + t, i, score, overlaps


def _searcher(held, threshold: float, percent: float):
    def search(batches):
        index = held.value
        for batch in batches:
            hits = list(_each(index, batch.column("text"), threshold, percent))
            ids = batch.column("id").take(pa.array([h[0] for h in hits], pa.int64()))
            yield pa.record_batch(
                {"id": ids, "item": pa.array([index.items[h[1]][0] for h in hits]), "score": pa.array([h[2] for h in hits], pa.float64()),
                 "question_percent": pa.array([h[3][0] for h in hits], pa.float64()),
                 "answer_percent": pa.array([h[3][-1] for h in hits], pa.float64())}
            ) if hits else pa.record_batch([ids, *[pa.array([], t) for t in _types(index)]], names=_NAMES)

    return search


_NAMES = ["id", "item", "score", "question_percent", "answer_percent"]


def _types(index: Index) -> list[pa.DataType]:
    kind = pa.array([index.items[0][0]]).type if index.items else pa.int64()
    return [kind, pa.float64(), pa.float64(), pa.float64()]


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, percent: float = 75.0, text: str = "text", **columns) -> DataFrame:
    """``docs`` without the rows that hold a leak; all columns stay, and nothing is shuffled."""
    names, place = docs.columns, docs.columns.index(text)
    for index in _shards(items, columns.get("item_id", "item_id"), columns.get("question", "question"), columns.get("answer", "answer")):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches, held=held):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for row, *_ in _each(held.value, batch.column(place), threshold, percent):
                    clean[row] = False
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(clean)).columns, names=names)

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def question_and_answer(items: DataFrame, text: str = "text") -> DataFrame:
    """Items of one text cut in two: the answer is the last quarter of the words, at least five of ten or more."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    n = F.size("_words")
    last = F.when(n < 10, F.lit(0)).otherwise(F.greatest(F.lit(5), F.floor(n / 4).cast("int")))
    cut = items.withColumn("_words", words).withColumn("_last", last)
    return cut.withColumns(
        {
            "question": F.array_join(F.slice("_words", F.lit(1), n - F.col("_last")), " "),
            "answer": F.array_join(F.slice("_words", n - F.col("_last") + 1, F.col("_last")), " "),
        }
    ).drop("_words", "_last")

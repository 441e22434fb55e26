"""Fill-in-the-middle examples, cut at unit boundaries found through a learned rank index.

A unit is a word with the white space before it, or white space at the end of a text. Two
ranks drawn from a hash of the id are the cuts. Their places come from an index that takes a
rank to an offset: straight segments are fitted to all boundary offsets of a batch of texts so
that no boundary is further from its segment than a bound, and each boundary keeps its residual
in one byte. A cut is predicted from the segment its rank falls into and corrected by the
residual, which makes it exact. The index takes about a byte a boundary, however long the texts
are, and no list of units is made.

A text is given as it is (``plain``) or as prefix, suffix, middle (``psm``) or suffix, prefix,
middle (``spm``), each part after its mark. Texts that hold a mark stay plain, so the marks in
an output are those it was given, and :func:`restore` gives back the text exactly.

Defined results: null texts are empty; empty texts have no unit and stay plain; a null id is
hashed as an empty one; repeated rows are cut alike. An empty table gives an empty one. Rows are
not shuffled. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm import textbatch as tb

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Furthest that a boundary may be from its segment: the rounded residual fits one byte.
BOUND = 126
#: Boundaries looked at when a segment begins; twice as many as long as all of them fit.
FIRST = 512


class RankIndex:
    """Offsets by rank, as straight segments and one byte a rank."""

    def __init__(self, offsets: np.ndarray, bound: int = BOUND):
        first, base, slope = [], [], []
        at, n, width = 0, len(offsets), FIRST
        while at < n:
            length, tilt = 1, 0.0
            while True:
                stop = min(n, at + width)
                if stop - at > 1:
                    # The slopes that keep all boundaries so far within the bound, as the range narrows.
                    step = np.arange(1, stop - at)
                    rise = offsets[at + 1 : stop] - offsets[at]
                    low = np.maximum.accumulate((rise - bound) / step)
                    high = np.minimum.accumulate((rise + bound) / step)
                    wrong = low > high
                    fits = int(wrong.argmax()) if wrong[-1] else len(wrong)
                    length, tilt = fits + 1, float((low[fits - 1] + high[fits - 1]) / 2) if fits else 0.0
                if length < stop - at or stop == n:
                    break
                width *= 2
            first.append(at)
            base.append(int(offsets[at]))
            slope.append(tilt)
            at += length
            width = max(FIRST, 2 * length)
        self.first, self.base, self.slope = np.array(first, np.int64), np.array(base, np.int64), np.array(slope)
        residual = offsets - self.predicted(np.arange(n))
        if n and np.abs(residual).max() > 127:
            raise ValueError(f"a residual does not fit one byte; the bound is {bound}")
        self.residual = residual.astype(np.int8)

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        own = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[own] + np.rint(self.slope[own] * (ranks - self.first[own])).astype(np.int64)

    def at(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residual[ranks] if len(ranks) else np.zeros(0, np.int64)


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the beginnings of all texts and the ends of their units, text by text; number of units of every text."""
    _, end, doc = tb.words(data, offsets)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    last = np.maximum(offsets[1:] - 1, 0)
    trails = (offsets[1:] > offsets[:-1]) & (tb.WHITE[data[last]] if len(data) else False)
    units = count + trails
    first = np.append(0, np.cumsum(units + 1)[:-1])
    places = np.repeat(offsets[1:], units + 1)  # the end of the text, where white space trails
    places[first] = offsets[:-1]
    nth = np.arange(len(end)) - np.append(0, np.cumsum(count)[:-1])[doc]
    places[first[doc] + 1 + nth] = end
    return places, units


def _cut(data: np.ndarray, offsets: np.ndarray, form: list[str], first: np.ndarray, second: np.ndarray) -> dict[str, list]:
    places, units = boundaries(data, offsets)
    index = RankIndex(places)
    begin = np.append(0, np.cumsum(units + 1)[:-1])
    ranks = np.sort(np.stack([first % (units + 1), second % (units + 1)]), axis=0)
    low, high = index.at(begin + ranks[0]), index.at(begin + ranks[1])
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    prefix, middle = points[low] - points[offsets[:-1]], points[high] - points[low]
    body, out = data.tobytes(), []
    for k, shape in enumerate(form):
        a, b, c, d = int(offsets[k]), int(low[k]), int(high[k]), int(offsets[k + 1])
        if shape == "plain":
            out.append(body[a:d])
        elif shape == "psm":
            out.append(b"".join([PREFIX.encode(), body[a:b], SUFFIX.encode(), body[c:d], MIDDLE.encode(), body[b:c]]))
        else:
            out.append(b"".join([SUFFIX.encode(), body[c:d], PREFIX.encode(), body[a:b], MIDDLE.encode(), body[b:c]]))
    cut = [shape != "plain" for shape in form]
    return {
        "n": units.tolist(),
        "prefix_chars": [int(x) if ok else None for x, ok in zip(prefix, cut)],
        "middle_chars": [int(x) if ok else None for x, ok in zip(middle, cut)],
        "output": out,
    }


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` of a hundred texts are cut, ``spm`` of a hundred of these with the suffix first.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)

    def drawn(turn: int) -> Column:
        return F.conv(F.substring(hashed, 8 * turn - 7, 8), 16, 10).cast("long")

    marked = body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE)
    plain = (body == "") | marked | (drawn(3) % 100 >= rate)
    rows = docs.select(
        F.col(doc_id).alias("id"),
        body.alias("text"),
        F.when(plain, "plain").when(drawn(4) % 100 < spm, "spm").otherwise("psm").alias("form"),
        drawn(1).alias("first"),
        drawn(2).alias("second"),
    )
    kind = docs.schema[doc_id].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            form, first, second = batch.column("form"), batch.column("first").to_numpy(), batch.column("second").to_numpy()
            for row, data, offsets in tb.chunks(batch.column("text")):
                part = slice(row, row + len(offsets) - 1)
                found = _cut(data, offsets, form[part].to_pylist(), first[part], second[part])
                yield pa.record_batch(
                    {
                        "id": batch.column("id")[part],
                        "n": pa.array(found["n"], pa.int64()),
                        "form": form[part],
                        "prefix_chars": pa.array(found["prefix_chars"], pa.int64()),
                        "middle_chars": pa.array(found["middle_chars"], pa.int64()),
                        "output": pa.array(found["output"], pa.binary()).cast(pa.string()),
                    }
                )

    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(cut, schema).withColumnRenamed("id", doc_id)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. A text that is cut holds no mark, so each mark is found where it was set."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    rest = F.substring(head, 4, 2**31 - 1)
    psm = F.concat(F.substring_index(rest, SUFFIX, 1), middle, F.substring_index(rest, SUFFIX, -1))
    spm = F.concat(F.substring_index(rest, PREFIX, -1), middle, F.substring_index(rest, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

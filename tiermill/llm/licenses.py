"""License notices found by MinHash bands over overlapping windows, then exact containment.

Templates are grouped by their number of 5-word shingles. For a group of ``n`` to ``2n - 1``
a text is cut into blocks of ``n`` shingles, and windows of three blocks start at every block,
so any stretch as long as a template of the group lies in one window. A window that contains
at least ``percent`` of a template has a similarity to it that cannot be under a bound, since
the window's size is fixed. The number of bands (one least hash each) follows from that
bound: such a window misses all of them with a probability under ``MISS``. A window that
shares a band with a template is a candidate; its shingles are then intersected with the
template's, and the match counts if the exact containment is reached.

Words are runs of bytes other than white space and ASCII punctuation, A-Z in lower case.
Templates are a parameter list of bounded size and travel with the tasks; documents are not
shuffled, so no source or notice can be hot.

Defined results: texts of fewer than five words, null and empty texts have no match, and
templates of fewer than five words are refused. Of several windows that match a template in
one text the one with most shingles counts, the first of equal ones. Repeated rows and rows
with a null id are searched one by one. An empty table gives an empty result. Only the id
and text columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm import textbatch as tb
from tiermill.llm.leaks import PLAIN

SHINGLE, MISS = 5, 1e-6
BLOCKS = 3

# Notices by which texts state their license.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
    "MPL was not distributed with this file, You can obtain one at",
}


def _text_shingles(data: np.ndarray, offsets: np.ndarray):
    """Shingle hashes of a batch and where those of each text begin, in text order."""
    data = PLAIN[data]
    start, end, doc = tb.words(data, offsets)
    hashes = tb.mix(tb.Sums(tb.word_hashes(data, start, end), 1).rolling(SHINGLE), 1)
    valid = np.flatnonzero(tb.together(doc, SHINGLE))
    return hashes[valid], np.searchsorted(doc[valid], np.arange(len(offsets)))


class Group:
    """Templates of ``size`` to ``2 * size - 1`` shingles, and the bands they need."""

    def __init__(self, size: int, members: list[tuple[str, np.ndarray]], percent: float, miss: float):
        self.size, self.names, self.sets = size, [m[0] for m in members], [m[1] for m in members]
        window = BLOCKS * size
        # Least similarity of a window that contains enough of the template.
        bound = min(math.ceil(len(s) * percent / 100) / (window + len(s) - math.ceil(len(s) * percent / 100)) for s in self.sets)
        self.bands = math.ceil(math.log(miss) / math.log(1 - bound)) if bound < 1 else 1
        self.factors = (tb.mix(np.arange(self.bands, dtype=np.uint64), 40) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.least = np.stack([[(_short(s) * f).min() for s in self.sets] for f in self.factors])

    def candidates(self, shingles: np.ndarray, first: np.ndarray):
        """Text, first shingle of the window and template number, each once."""
        sizes, step = np.diff(first), self.size
        blocks = np.where(sizes > 0, np.maximum(BLOCKS, -(-sizes // step)), 0)
        text = np.repeat(np.arange(len(sizes)), blocks)
        opens = np.cumsum(blocks) - blocks
        at = (np.arange(len(text)) - opens[text]) * step
        inside = np.minimum(at[None, :] + np.arange(step)[:, None], sizes[text] - 1)  # past the end: the last one again
        laid = _short(shingles)[first[text] + inside]
        ok = np.arange(len(text)) + BLOCKS <= (opens + blocks)[text]
        found = []
        for factor, least in zip(self.factors, self.least):
            lows = (laid * factor).min(axis=0)
            lows = np.minimum(np.minimum(lows[:-2], lows[1:-1]), lows[2:])
            for number, value in enumerate(least):
                hit = np.flatnonzero(lows == value)
                if len(hit):
                    found.append(hit[ok[hit]] * len(self.sets) + number)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        names = np.unique(np.concatenate(found))
        window = names // len(self.sets)
        return text[window], at[window], names % len(self.sets)


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def groups(templates: dict[str, str], percent: float = 75.0, miss: float = MISS) -> list[Group]:
    by_size: dict[int, list] = {}
    for name, body in templates.items():
        raw = np.frombuffer(body.encode(), np.uint8)
        shingles = np.unique(_text_shingles(raw, np.array([0, len(raw)]))[0])
        if not len(shingles):
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        by_size.setdefault(1 << (len(shingles).bit_length() - 1), []).append((name, shingles))
    return [Group(size, members, percent, miss) for size, members in sorted(by_size.items())]


def matches(column, found_groups: list[Group], percent: float):
    """Row, template, containment in percent, first and end word of the best window of each text and template."""
    for row, data, offsets in tb.chunks(column):
        shingles, first = _text_shingles(data, offsets)
        for group in found_groups:
            best: dict = {}
            for t, at, number in zip(*(x.tolist() for x in group.candidates(shingles, first))):
                own = shingles[first[t] + at : min(first[t] + at + BLOCKS * group.size, first[t + 1])]
                hit = np.flatnonzero(tb.isin(own, group.sets[number]))
                share = 100.0 * len(np.unique(own[hit])) / len(group.sets[number])
                if share >= percent and share > best.get((t, number), (0.0,))[0]:
                    best[t, number] = share, int(at + hit[0]), int(at + hit[-1] + SHINGLE)
            for (t, number), (share, start, end) in sorted(best.items()):
                yield row + t, group.names[number], share, start, end


def find_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: float = 75.0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and template found: id, ``template``, ``containment``, ``start_word``, ``end_word``."""
    found_groups = groups(templates, percent)
    kind = docs.schema[doc_id].dataType.simpleString()

    def search(batches):
        for batch in batches:
            hits = list(matches(batch.column("text"), found_groups, percent))
            cells = list(zip(*hits)) or [()] * 5
            yield pa.record_batch(
                {"id": batch.column("id").take(pa.array(cells[0], pa.int64())), "template": pa.array(cells[1], pa.string()),
                 "containment": pa.array(cells[2], pa.float64()), "start_word": pa.array(cells[3], pa.int64()),
                 "end_word": pa.array(cells[4], pa.int64())}
            )

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = f"id {kind}, template string, containment double, start_word long, end_word long"
    return rows.mapInArrow(search, schema).withColumnRenamed("id", doc_id)

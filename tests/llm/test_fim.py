"""Fill-in-the-middle against a plain version, and the rank index on its own."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tiermill.llm import fim  # noqa: E402

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(pairs):
    out = []
    for i, text in pairs:
        text = text or ""
        units = UNIT.findall(text)
        assert "".join(units) == text
        h = brute.sha(f"42:{'' if i is None else i}".encode())
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
            out.append((i, len(units), "plain", None, None, text))
        elif h4 % 100 < 80:
            out.append((i, len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"))
        else:
            out.append((i, len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"))
    return out


def test_cuts(frame, corpus):
    words = corpus[11][1].split()
    rows = corpus + [(500 + i, " ".join(words[: i % 60]) + "  \n" * (i % 3)) for i in range(400)]
    rows += [(1000 + i, f"{'  ' * (i % 2)}a <{'PSM'[i % 3]}{'>' * (i % 4 > 0)} b<S c <{'<P' * (i % 5)} d>") for i in range(200)]
    got = fim.transform(frame(rows))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert brute.counted(got.collect()) == brute.counted(plain(rows))
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    back = got.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert brute.counted(back) == brute.counted((i, t or "") for i, t in rows)


def test_empty_table(frame):
    assert fim.transform(frame([])).collect() == []


@pytest.mark.parametrize("bound", [1, 20, fim.BOUND])
def test_index_is_exact(bound):
    draw = np.random.default_rng(3)
    steps = [draw.integers(0, 12, 5000), np.zeros(700, np.int64), [90_000], draw.integers(1, 3, 3000), [2**40], draw.geometric(0.01, 900)]
    cases = [np.cumsum(np.concatenate(steps)), np.arange(100_000) * 6, np.array([7]), np.array([0, 0, 0]), np.array([], np.int64)]
    for offsets in cases:
        index = fim.RankIndex(offsets, bound)
        ranks = np.arange(len(offsets))
        assert (index.at(ranks) == offsets).all() and index.residual.nbytes == len(offsets)
        if len(offsets):
            assert np.abs(index.predicted(ranks) - offsets).max() <= bound + 1
    assert len(fim.RankIndex(cases[1], bound).first) == 1  # one straight line is one segment

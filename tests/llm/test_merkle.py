"""Manifest and proofs against a plain version, over groups of every size and odd rows."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tiermill.llm import merkle  # noqa: E402


def digest(*parts):
    return brute.sha("".join(parts).encode())


def leaf(*fields):
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, place):
    """Digests before and after the own one on every level."""
    for nodes in tree[:-1]:
        run, slot = nodes[place // 16 * 16 : place // 16 * 16 + 16], place % 16
        yield run[:slot], run[slot + 1 :]
        place //= 16


def plain(rows, changed):
    """``rows`` are (id, text, source); ``changed`` gives the text as read again."""
    order = lambda v: (v is not None, v)
    bytewise = lambda v: (v is not None, (v or "").encode())
    sources = sorted({s for _, _, s in rows}, key=bytewise)
    groups = {s: sorted(((i, leaf(i, s, t), leaf(i, s, changed(i, t))) for i, t, g in rows if g == s), key=lambda x: (order(x[0]), x[1])) for s in sources}
    trees = {s: levels([x[1] for x in own]) for s, own in groups.items()}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for place, (i, own, seen) in enumerate(groups[s]):
            path = [*siblings(trees[s], place), *siblings(top, k)]
            folded = seen
            for before, after in path:
                folded = digest(*before, folded, *after)
            proof = "".join(x for before, after in path for x in [*before, *after])
            out.append((i, own, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def lowered(i, text):
    return brute.lower(text) if text and i is not None and i % 3 == 0 else text


def check(spark, rows):
    table = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "doc_id long, text string, source string, leaf string, root string, tree int")
    changed = {"text": F.when(F.col("doc_id") % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))}
    got = merkle.prove(table.repartition(3), changed, fields=("doc_id", "source", "text"))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    assert brute.counted(got.collect()) == brute.counted(plain(rows, lowered))


def test_groups_of_every_size(spark):
    sizes = {"a": 1, "b": 2, "é": 16, "z": 17, "Z": 33, None: 257, "": 273, **{f"s{i}": 1 + i % 3 for i in range(14)}}
    rows, at = [], 0
    for source, n in sizes.items():
        rows += [(at + i, f"Text {i} ÄB" if i % 5 else "small", source) for i in range(n)]
        at += n
    check(spark, rows)


def test_many_nodes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", 1)
    check(spark, [(i, f"Row {i}", f"s{i % 2}") for i in range(600)])


def test_odd_rows(spark, corpus):
    check(spark, [(i, t, ("x", None, "y")[k % 3]) for k, (i, t) in enumerate(corpus)] + [(3, "Same", "x")] * 40)


@pytest.mark.parametrize("n", [1, 2, 16, 40])
def test_one_group(spark, n):
    check(spark, [(i, f"Row {i}", "only") for i in range(n)])


def test_a_row_read_unchanged_is_verified(frame, corpus):
    got = merkle.prove(frame(corpus), fields=("doc_id", "text"), group="_source").collect()
    assert len(got) == len(corpus) and all(r.verified for r in got)
    assert merkle.prove(frame([]), fields=("doc_id", "text")).collect() == []


def test_nodes_name_their_parents(frame):
    runs, nodes = merkle.build(frame([(i, str(i)) for i in range(300)]), fields=("doc_id", "text"))
    known = {r.node: r for r in nodes.collect()}
    bottom = runs.collect()
    assert max(len(r.leaves) for r in bottom) == 16
    for r in [*bottom, *known.values()]:
        assert r.parent is None or known[r.parent].children[32 * r.slot : 32 * r.slot + 32].hex() == r.digest
    assert sum(r.parent is None for r in known.values()) == 1

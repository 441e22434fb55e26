"""Packed sequences: every token once, in order, under all limits and without padding."""

from __future__ import annotations

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from tiermill.llm import packing  # noqa: E402
from tiermill.llm.packing import Limits  # noqa: E402
from tiermill.llm.queries import QUERIES  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def check(pieces, limits, examples):
    """``examples`` are (id, ids, first token that bears loss)."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limits.tokens and at & (at - 1) == 0
        assert len(own) <= limits.segments and sum(r.loss_tokens for r in own) <= limits.loss
    wanted = defaultdict(list)
    for i, ids, loss_from in examples:
        wanted[i].append((tuple(ids), loss_from))
    assert set(wanted) == set(documents)
    for i, own in documents.items():
        copies = len(wanted[i])
        own.sort(key=lambda r: r.start)
        if copies == 1:
            ids, loss_from = wanted[i][0]
            at = 0
            for r in own:
                assert r.start == at and tuple(np.frombuffer(r.ids, "<u4").tolist()) == ids[at : at + r.length]
                at += r.length
                assert r.loss_tokens == max(0, at - max(r.start, loss_from))
            assert at == len(ids) and {r.doc_tokens for r in own} == {len(ids)}
        else:  # rows that share an id cannot be told apart, but their tokens can be counted
            assert sum(r.length for r in own) == sum(len(ids) for ids, _ in wanted[i])
    return sequences


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 2, 64), Limits(256, 3, 100), Limits(16, 1, 5), Limits(1, 1, 1)])
def test_documents(frame, corpus, limits):
    got = packing.pack(frame(corpus), VOCABULARY, limits).collect()
    check(got, limits, [(i, [*ids_of(t), 1], 1) for i, t in corpus])


def test_odd_strings(frame):
    draw = random.Random(4)
    letters = "aBé1́İΣß \n\t  \u0085\x1c\x00'.<|>日\U0001f642ſ"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(1500)]
    texts += ["".join(draw.choice("ab'sd9-_ \té*") for _ in range(draw.randrange(30))) for _ in range(1500)]
    texts += ["a<|endoftext|>b <|startoftext|>", "IT'S we'll 'S", "x" * 5000, "ΑΣ ΑΣ. İ", None]
    rows = list(enumerate(texts))
    check(packing.pack(frame(rows), VOCABULARY).collect(), Limits(), [(i, [*ids_of(t), 1], 1) for i, t in rows])


def test_instructions(spark):
    """Prompts bear no loss; a tight limit on loss binds before that on tokens."""
    draw = random.Random(8)
    word = lambda n: " ".join(draw.choice(["red", "tall", "house", "runs", "over", "unlikely"]) for _ in range(n))
    rows = [(i, word(draw.randrange(0, 60)), word(draw.randrange(1, 90))) for i in range(600)] + [(600, None, word(900)), (601, word(900), None), (602, "", "")]
    table = spark.createDataFrame(rows, "doc_id long, question string, text string").repartition(2)
    limits = Limits(256, 4, 120)
    examples = [(i, [*ids_of(p), *ids_of(t), 1], len(ids_of(p)) or 1) for i, p, t in rows]
    sequences = check(packing.pack(table, VOCABULARY, limits, prompt="question").collect(), limits, examples)
    loss = [sum(r.loss_tokens for r in own) for own in sequences.values()]
    assert np.mean([x > 100 for x in loss]) > 0.5  # most sequences are full of loss
    loose = check(packing.pack(table, VOCABULARY, Limits(256, 64, 256), prompt="question").collect(), Limits(256, 64, 256), examples)
    total = sum(len(ids) for _, ids, _ in examples)
    assert len(loose) <= total // 256 + 2 * 9  # whole sequences but for the short ones at the end of a task


def test_dot_product_prefers_what_the_scarce_limit_allows():
    """With one segment left the largest piece is taken, with little loss left one that bears little."""
    limits = Limits(64, 2, 30)
    packer = packing.Packer(limits)
    for name, size, loss_from in [("a", 30, 5), ("b", 30, 30), ("c", 3, 0), ("d", 20, 0)]:
        assert list(packer.add(packing.Example(name, np.arange(size, dtype=np.uint32), loss_from))) == []
    first = packer._fill()
    assert {x.id for x, _, _ in first} == {"a", "b"}


def test_pool_is_bounded():
    packer = packing.Packer(Limits())
    out = sum(1 for i in range(5000) for _ in packer.add(packing.Example(i, np.zeros(1 + i % 700, np.uint32), 1)))
    assert packer.count <= packing.POOL and len(packer.held) <= 4 * packing.POOL and out > 500


def test_limits_are_checked():
    for bad in ((100, 4, 10), (64, 0, 10), (64, 1, 0)):
        with pytest.raises(ValueError):
            Limits(*bad)


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        packing.Words(file.read())


def test_empty_table(frame):
    assert packing.pack(frame([]), VOCABULARY).collect() == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_vector_packing"][0](spark, sf).collect()
    want = {r.doc_id: np.array([*ids_of(r.text), 1], "<u4") for r in rows}
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    lengths = defaultdict(int)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(want[r.doc_id])
        lengths[r.sequence_id] += r.length
    assert all(n & (n - 1) == 0 and n <= 2048 for n in lengths.values())


def test_words_of_sliced_columns():
    words = packing.Words(open(VOCABULARY, encoding="utf-8").read())
    texts = ["skip me", "a b", None, "", "c  d'll e", "ü"]
    assert [x.tolist() for x in words.encode(pa.array(texts).slice(1))] == [ids_of(t) for t in texts[1:]]


def test_words_kept_at_hand_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 50)
    words = packing.Words(open(VOCABULARY, encoding="utf-8").read())
    for i in range(20):
        text = " ".join(f"w{chr(97 + i)}{chr(97 + k)}" for k in range(26))
        assert words.encode(pa.array([text]))[0].tolist() == ids_of(text)
        assert len(words.number) <= 50

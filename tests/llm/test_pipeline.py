"""The pipeline's stages against plain versions, and the numbered queries against their SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from tiermill.llm import leaks, pii, quality  # noqa: E402
from tiermill.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_matches_sql(spark, name):
    run, sql = QUERIES[name]
    assert oracle.compare(run(spark, SF), oracle.connect(SF), sql) is None


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if not sql))
def test_runs_on_the_whole_table(spark, name):
    assert QUERIES[name][0](spark, SF).count() > 0


def test_personal_data_digest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    kinds = pii.KINDS
    want = []
    for row in docs:
        found = brute.personal(row.text)
        told = ",".join(f"{kinds[k]}:{a}:{z}" for a, k, z in found)
        want.append((row.doc_id, *(sum(k == n for _, k, _ in found) for n in range(4)), brute.sha(told.encode())))
    got = QUERIES["op7_semi_crf_pii"][0](spark, SF)
    assert brute.counted(got.drop("spans").collect()) == brute.counted(want)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, SF)
    kept = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept

    single = stages["near duplicates"](spark, good, SF)
    pairs = [(r.doc_id, r.text) for r in good.collect()]
    want = {i for i, _, _, stays in brute.near_duplicates(pairs) if stays}
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(want)

    clean = stages["decontamination"](spark, single, SF)
    items = leaks.question_and_answer(spark.read.parquet(f"{SF}/benchmark.parquet"))
    leaked = {r.doc_id for r in leaks.find_leaks(single, items).collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want - leaked

    masked = stages["personal data"](spark, clean, SF)
    assert masked.columns == docs.columns and masked.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    for row in masked.collect():
        assert not brute.personal(row.text) and row.n_chars == len(row.text)

    mixed = stages["source mix"](spark, masked, SF)
    assert {r.doc_id for r in mixed.collect()} <= want - leaked
    assert not mixed.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_copies").alias("m")).filter("n <> m").count()


def test_repeated_rows_leave_one(spark, frame):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (6, "a b c d e f g"), (7, "other words are here now"), (None, None), (None, "")]
    got = corpus_pipeline.near_duplicates(spark, frame(rows), SF)
    assert sorted((r.doc_id for r in got.collect()), key=str) == [5, 7, None, None]


def test_rows_are_judged_one_by_one(spark, frame):
    """Null ids and repeated ids: a copy goes, other rows of its id stay."""
    base = " ".join(f"w{i}" for i in range(60))
    near, other, third = base.replace("w30", "x"), " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    rows = [
        (3, base), (None, near), (None, other), (None, None), (None, ""), (5, base), (5, third), (8, near), (8, "some words of its own"),
        (9, "one more text"), (9, None), (9, "one more text"),
    ]
    want = [(3, base), (5, third), (8, "some words of its own"), (9, "one more text"), (None, ""), (None, None), (None, other)]
    got = corpus_pipeline.near_duplicates(spark, frame(rows), SF)
    assert got.columns == frame(rows).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_masked_text_has_no_rule_left():
    assert pii.base_spans("[EMAIL] [CARD]") == []

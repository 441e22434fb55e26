from __future__ import annotations

import re
import unicodedata
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiermill.functions import membership, numeric, text
from tiermill.operators.reconcile import region_filter
from tiermill.profile import HIGHER_EDUCATION


def apply(spark, make, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_region_key(spark):
    values = ["Bogotá, D.C.", " BOGOTA DC", "Santafé de Bogotá", None, "Bogotá  d.c."]
    assert apply(spark, text.region_key, values) == ["bogota", "bogota", "santafedebogota", "", "bogota"]


def test_region_filter(spark, rows):
    df = spark.createDataFrame(
        [(1, "Bogotá, D.C."), (2, " BOGOTA DC"), (3, "Santafé de Bogotá"), (4, None), (5, "Antioquia")], "i int, r string"
    )
    assert rows(region_filter(df, "r", "bogota"), "i") == [(1,), (2,), (3,)]


def test_name_clean(spark):
    values = ["  Uni,  Norte - ", "A--", None, "A - -", ",,", "x y"]
    assert apply(spark, text.name_clean, values) == ["Uni Norte", "A", "", "A -", "", "x y"]


def test_match_fold(spark):
    got = apply(spark, text.match_fold, ["UNIVERSIDAD Militar-Nueva  Granada", None, "Nariño"])
    assert got == ["universidad militar nueva granada", "", "narino"]


def test_header_normalize(spark):
    assert apply(spark, text.header_normalize, ["Sector\n  IES ", None]) == ["sector ies", ""]


def _strip(value):
    return "".join(c for c in unicodedata.normalize("NFD", value) if unicodedata.category(c) != "Mn")


# Letters of European scripts with and without accents, spaces, marks and separators.
_TEXT = st.text(st.characters(codec="utf-8", min_codepoint=32, max_codepoint=0x24F), max_size=20)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_TEXT, min_size=50, max_size=50))
def test_accents_match_decomposition(spark, values):
    assert apply(spark, text.strip_accents, values) == [_strip(v) for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(" \t\n\x0b\x1c\x85\xa0 a,-.", max_size=12), min_size=50, max_size=50))
def test_name_clean_matches_python(spark, values):
    def clean(value):
        squeezed = re.sub(r"\s+", " ", value.strip().replace(",", "")).strip()
        return squeezed.rstrip("-").strip()

    assert apply(spark, text.name_clean, values) == [clean(v) for v in values]


def test_driver_fold_agrees(spark):
    names = list(HIGHER_EDUCATION.members)
    folded = apply(spark, text.match_fold, names)
    assert folded == [text.fold_literal(n) for n in names]
    assert len(set(folded)) == 33


def test_member_flag(spark):
    members = HIGHER_EDUCATION.members
    values = [
        "Universidad Pedagógica Nacional",
        "UNIVERSIDAD DE ANTIOQUIA - SEDE BOGOTÁ",
        "Universidad",
        "",
        "Politécnico Grancolombiano",
        "Universidad Militar-Nueva Granada",
        None,
    ]
    flags = apply(spark, lambda c: membership.member_flag(c, members), values)
    assert flags == [True, True, True, True, False, True, True]
    assert apply(spark, lambda c: membership.member_flag(c, members, 5), ["", "unad"]) == [False, False]
    assert apply(spark, lambda c: membership.member_flag(c, []), ["unad"]) == [False]


def _random_lists():
    """Names and entries of few letters, so that many hold one another; also a name longer than all entries."""
    import random

    draw = random.Random(6)
    word = lambda most: "".join(draw.choice("abcé ") for _ in range(draw.randrange(1, most)))
    for most in (6, 14):
        yield [word(most) for _ in range(150)] + [word(200)], [word(most + 4) for _ in range(40)]


@pytest.mark.parametrize("shard_bytes", [3, membership.SHARD_BYTES])
@pytest.mark.parametrize(
    "names, members",
    [
        (["Uni A", "uni a norte", "ni", "", "zzz", "Otra"], ["UNÍ-A", "largo uni b", "otra cosa"]),
        (["a", "bb", ""], [""]),
        (["a", "bb", ""], []),
        (["abc", "abcabc", "xabcx", "b"], ["abc", "bc", "cab"]),
        ([None, "ab", "Á-b", "c d"], ["xx ab", None, "d e c d"]),
        *_random_lists(),
    ],
)
def test_member_semi_join_against_brute_force(spark, rows, names, members, shard_bytes):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    listed = spark.createDataFrame([(m,) for m in members], "m string")
    fold = lambda s: text.fold_literal(s or "")
    want = [
        (i,)
        for i, n in enumerate(names)
        if any(fold(n) in fold(m) or fold(m) in fold(n) for m in members)
    ]
    assert rows(membership.member_semi_join(df, "n", listed, "m", shard_bytes), "i") == want


def test_numeric_coerce(spark):
    values = ["12", "12.7", "x", None, " 5 ", "1d", "1e2", "-3", ".5", ""]
    assert apply(spark, numeric.numeric_coerce, values) == [12, 12.7, 0, 0, 5, 0, 100, -3, 0.5, 0]


def test_parse_integer(spark):
    values = ["12", "12.0", "", " 7 ", "99999999999", "+4"]
    assert apply(spark, numeric.parse_integer, values) == [12, None, None, 7, None, 4]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(100, 8), (50, 0), (0, 4), (1, 8), (5, -1), (39, 8)], "a bigint, b bigint")
    got = [r.r for r in df.select(numeric.safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [Decimal("12.50"), None, Decimal("0.00"), Decimal("0.13"), None, Decimal("4.88")]


def test_safe_ratio_overflow(spark):
    df = spark.createDataFrame([(100000, 100)], "a bigint, b bigint")
    kept = df.select(numeric.safe_ratio(F.col("a"), F.col("b"), on_overflow="quarantine").alias("r"))
    assert kept.first().r is None
    with pytest.raises(Exception, match="does not fit"):
        df.select(numeric.safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    with pytest.raises(ValueError):
        numeric.fit_decimal(F.lit(1), "decimal(5,2)", "ignore")


def test_pct_change(spark):
    df = spark.createDataFrame([(120, 100), (30, 60), (15, 0), (5, None), (200, 3)], "c bigint, p bigint")
    got = [r.r for r in df.select(numeric.pct_change(F.col("c"), F.col("p")).alias("r")).collect()]
    assert [None if g is None else float(g) for g in got] == [20.0, -50.0, None, None, 6566.67]


@pytest.mark.parametrize("shard_bytes", [3, membership.SHARD_BYTES])
def test_member_semi_join_searches_names_once(spark, shard_bytes):
    """What the automaton told is written; the branches of the result do not search the names again."""
    df = spark.createDataFrame([(1, "xx ab"), (2, "a"), (3, ""), (4, "zz"), (5, None), (6, "long name without any")], "i int, n string")
    listed = spark.createDataFrame([("ab",), ("c a d",)], "m string")
    found = membership.member_semi_join(df, "n", listed, "m", shard_bytes)
    assert "PythonUDF" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.i for r in found.collect()) == [1, 2, 3, 5] and found.columns == ["i", "n"]

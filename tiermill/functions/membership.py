"""Fuzzy list membership: equal to, containing, or contained in a list entry.

A short list that is part of a profile is written into the plan (:func:`member_flag`). A list in a
table, of any length, is matched by :func:`member_semi_join`, in two directions:

* A name that holds an entry is found by an automaton over many patterns with failure links, which
  reads each name once, whatever the number of entries. It is built from a shard of the list of
  bounded size, which is all that is sent to the tasks; a longer list takes one pass per shard.
* A name that is held by an entry is no longer than the longest entry. Of its runs of ``GRAM`` letters
  the one that fewest entries have is looked up among those of all entries, and what is found is
  verified. Names as short as a run are looked up as they are.

Names longer than all entries are not shuffled and no array is made over their length. An empty
name is held by every entry, an empty entry by every name; a null counts as empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.text import fold_literal, match_fold
from tiermill.session import freeze

#: Bytes of list entries that one automaton is built from, and letters of an indexed run.
SHARD_BYTES, GRAM = 4 << 20, 3


def member_flag(name: Column, members: Iterable[str], min_len: int = 0) -> Column:
    """True if the folded name and some folded entry contain one another.

    An empty name counts as contained in every entry; ``min_len`` excludes short names.
    """
    entries = sorted({fold_literal(m) for m in members})
    if not entries:
        return F.lit(False)
    # A longer entry adds nothing when it contains a shorter one that a name may hold.
    shortest = [e for e in entries if not any(o != e and o in e for o in entries)]
    joined = F.lit("\n".join(entries))

    def test(folded: Column) -> Column:
        flag = joined.contains(folded)
        for entry in shortest:
            flag = flag | folded.contains(entry)
        return flag & (F.length(folded) >= min_len) if min_len else flag

    # The one-element array binds the folded name, so that it is computed once per row also
    # where the flag is used in a filter.
    return F.exists(F.array(match_fold(name)), test)


@lru_cache(maxsize=1)
def _automaton(entries: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for entry in entries:
        found.add_word(entry, True)
    found.make_automaton()
    return found


def _holds(name: Column, entries: list[str]) -> Column:
    """Whether the name holds one of the entries of a shard."""
    patterns = tuple(entries)

    @F.pandas_udf("boolean")
    def test(names: pd.Series) -> pd.Series:
        automaton = _automaton(patterns)
        return pd.Series([next(automaton.iter(n), None) is not None for n in names], dtype=bool)

    return test(name)


def _holders(keyed: DataFrame, entries: DataFrame, shard_bytes: int, longest: int) -> DataFrame:
    """Rows that hold an entry, and those short enough that an entry may hold them: a written table.

    ``_holds`` tells the two apart. Every name is folded and searched once per shard; of a row that holds an entry,
    the key is not needed any more, so it is not written.
    """
    size = entries.agg(F.coalesce(F.sum(F.octet_length("entry")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(size / shard_bytes))
    shard = F.pmod(F.xxhash64("entry"), F.lit(shards))
    lists = ([r.entry for r in entries.filter(shard == k).collect()] for k in range(shards))  # one shard at a time
    if shards == 1:
        return _settled(keyed.withColumn("_holds", _holds(F.col("_key"), next(lists))), longest)
    digest, found = F.md5("_key"), None
    for patterns in lists:
        if patterns:
            more = freeze(keyed.filter(_holds(F.col("_key"), patterns)).select(digest.alias("_digest")).distinct())
            found = more if found is None else found.unionByName(more)
    marked = keyed.withColumn("_digest", digest).join(found.distinct().withColumn("_found", F.lit(True)), "_digest", "left")
    return _settled(marked.withColumn("_holds", F.col("_found").isNotNull()).drop("_digest", "_found"), longest)


def _settled(marked: DataFrame, longest: int) -> DataFrame:
    """The rows that match or still may, written."""
    key = F.when(~F.col("_holds"), F.col("_key"))
    return freeze(marked.filter(F.col("_holds") | (F.length("_key") <= longest)).withColumn("_key", key))


def _grams(df: DataFrame, column: str, sizes: Iterable[int]) -> DataFrame:
    """Distinct runs of letters of the given sizes: ``column, gram``."""
    text = F.col(column)

    def runs(n: int) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1))
        return F.when(F.length(text) >= n, F.transform(first, lambda i: F.substring(text, i, n))).otherwise(F.array().cast("array<string>"))

    return df.select(column, F.explode(F.array_distinct(F.concat(*map(runs, sizes)))).alias("gram"))


def _held(names: DataFrame, entries: DataFrame) -> DataFrame:
    """``_key`` of the names, none of them empty, that an entry holds."""
    postings = freeze(_grams(entries, "entry", range(1, GRAM + 1)))
    counts = freeze(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    short = names.filter(F.length("_key") <= GRAM).join(counts.withColumnRenamed("gram", "_key"), "_key", "left_semi").select("_key")
    long = names.filter(F.length("_key") > GRAM)
    # A run that no entry has rules the name out, so the least count is that of the rarest run.
    own = _grams(long, "_key", [GRAM]).join(counts, "gram", "left")
    rarest = own.groupBy("_key").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    probes = rarest.filter("r.n > 0").select("_key", F.col("r.gram").alias("gram"))
    found = probes.join(postings, "gram").filter(F.col("entry").contains(F.col("_key"))).select("_key").distinct()
    return short.unionByName(found)


def member_semi_join(df: DataFrame, name: str, members: DataFrame, member: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows of ``df`` whose name matches a list held in a table of any length."""
    entries = freeze(members.select(match_fold(F.col(member)).alias("entry")).distinct())
    about = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("entry")).alias("longest"), F.min(F.length("entry")).alias("least")).first()
    if not about.n:
        return df.filter(F.lit(False))
    if not about.least:  # every name holds the empty entry
        return df
    keyed = df.withColumn("_key", match_fold(F.col(name)))
    told = _holders(keyed, entries, shard_bytes, about.longest)
    sure = told.filter(F.col("_holds") | (F.length("_key") == 0))
    rest = told.filter(~F.col("_holds") & (F.length("_key") > 0))
    held = rest.join(_held(rest.select("_key").distinct(), entries), "_key", "left_semi")
    return sure.unionByName(held.select(sure.columns)).drop("_key", "_holds")

"""Token counts of texts without their token ids.

A byte-pair vocabulary is applied to pre-tokens one by one, so the tokens of a text are the
sum over its pre-tokens. Every distinct pre-token of the corpus is given to the tokenizer
once. The counts are joined to the pre-token frequencies of each document and summed; no
list of ids is ever made.

The join has two sides of very different size and both are exact. The ``COMMON`` pre-tokens
that are most frequent over the whole corpus make up nearly all occurrences and are sent to
all tasks as a table of bounded size; a document sums them as it is read. Its other
pre-tokens, each rare by construction, are joined by a shuffle on the pre-token, where no key
can be hot, and added per document.

Special strings inside a text count as the tokenizer does by default: one token each, and
the text is cut there first. Defined results: null or empty texts have no bytes and no
tokens. Repeated rows and rows with a null id are counted one by one. An empty table gives
an empty one. Only the id and text columns are read.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiermill.session import freeze

#: Pre-tokens sent to all tasks, and the longest of them in bytes: 16 MB at most.
COMMON, COMMON_BYTES = 1 << 18, 64

# Fixed value: the pattern of byte-level byte-pair vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = regex.compile(PATTERN)


@lru_cache(maxsize=2)
def _tokenizer(serialized: str) -> tuple[Tokenizer, object]:
    tokenizer = Tokenizer.from_str(serialized)
    special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return tokenizer, regex.compile("|".join(map(regex.escape, special))) if special else None


def pieces(text: str, special) -> tuple[list[str], int]:
    """Pre-tokens of a text and the number of special strings in it."""
    if special is None or not special.search(text):
        return _SPLIT.findall(text), 0
    parts = special.split(text)
    return [p for part in parts for p in _SPLIT.findall(part)], len(parts) - 1


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 1024, common: int = COMMON, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``vocabulary`` is the path of a tokenizer file on the driver; its content travels with
    the tasks.
    """
    with open(vocabulary, encoding="utf-8") as file:
        serialized = file.read()
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(serialized)  # one vocabulary file: fixed size
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def tally(batches):
        special = _tokenizer(held.value)[1]
        seen: Counter = Counter()
        for batch in batches:
            for x in batch.column("text"):
                seen.update(pieces(x.as_py(), special)[0])
            if len(seen) > 1 << 20:  # partial counts add up
                yield _pairs(seen)
                seen = Counter()
        if seen:
            yield _pairs(seen)

    def encode(batches):
        tokenizer = _tokenizer(held.value)[0]
        tokenizer.encode_special_tokens = True  # a pre-token has no special string
        for batch in batches:
            names = batch.column("piece").to_pylist()
            n = [len(tokenizer.encode(x, add_special_tokens=False).ids) for x in names]
            yield pa.record_batch({"piece": batch.column("piece"), "freq": batch.column("freq"), "n": pa.array(n, pa.int32())})

    tallied = rows.select("text").mapInArrow(tally, "piece string, freq long")
    counted = freeze(tallied.groupBy("piece").agg(F.sum("freq").alias("freq")).mapInArrow(encode, "piece string, freq long, n int"))
    frequent = _frequent(counted.filter(F.octet_length("piece") <= COMMON_BYTES), common)
    known = spark.sparkContext.broadcast({r.piece: r.n for r in frequent.select("piece", "n").toLocalIterator()})

    def add_up(batches):
        special, table = _tokenizer(held.value)[1], known.value
        for batch in batches:
            tokens, rare = [], []
            for x in batch.column("text"):
                found, total = pieces(x.as_py(), special)
                each, other = [*map(table.get, found)], []
                if None in each:
                    other = [p for p, n in zip(found, each) if n is None]
                    each = filter(None, each)
                total += sum(each)
                tokens.append(total)
                rare.append([{"piece": p, "times": k} for p, k in Counter(other).items()])
            kind = pa.list_(pa.struct([("piece", pa.string()), ("times", pa.int64())]))
            yield pa.record_batch(
                {"row": batch.column("row"), "id": batch.column("id"), "n_bytes": batch.column("n_bytes"),
                 "tokens": pa.array(tokens, pa.int64()), "rare": pa.array(rare, kind)}
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    measured = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        add_up, f"row long, id {kind}, n_bytes long, tokens long, rare array<struct<piece: string, times: long>>"
    )
    measured = freeze(measured)
    rare = measured.filter(F.size("rare") > 0).select("row", F.inline("rare"))
    late = rare.join(counted.select("piece", "n"), "piece").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("late"))
    total = measured.drop("rare").join(late, "row", "left").withColumn("n_tokens", F.col("tokens") + F.coalesce("late", F.lit(0)))
    return total.select(F.col("id").alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _frequent(counted: DataFrame, most: int) -> DataFrame:
    """The most frequent pieces, ``most`` at most: all above a frequency found from a histogram.

    The histogram has at most eight bins for each doubling of the frequency, so neither it
    nor any task grows with the corpus, and nothing is sorted.
    """
    step = F.floor(F.log2(F.col("freq").cast("double")) * 8).cast("int")
    bins = counted.groupBy(step.alias("step")).agg(F.count("*").alias("pieces")).orderBy(F.desc("step")).collect()
    total, lowest = 0, None
    for row in bins:
        total += row.pieces
        if total > most:
            break
        lowest = row.step
    return counted.filter(F.lit(False) if lowest is None else step >= lowest)


def _pairs(seen: Counter) -> pa.RecordBatch:
    return pa.record_batch({"piece": pa.array(list(seen), pa.string()), "freq": pa.array(list(seen.values()), pa.int64())})

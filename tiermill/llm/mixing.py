"""Mixing sources to target weights by Poisson replication.

A source with a given share of the target has a mean repetition rate: target characters
over characters present. Every document draws its number of copies from a Poisson
distribution with that mean, by inverting the distribution at a uniform number hashed from
the seed and the document id, so each row decides alone and a rerun gives the same copies.
Copies are exploded and dealt over the cluster by a hash of seed, id and copy number, and
sorted by it in each partition: a global shuffle in one exchange.

Hot sources: per-source sums are combined before they are shuffled, and the table of
sources (one row each, written before it is joined, so that its size is known to the
planner) is broadcast while it is under the broadcast limit; above it the join is a
shuffled one whose large partitions adaptive execution splits.

Defined results: a null source is a source of its own; null texts count 0 characters, and a
source without any character keeps each document once. Rows with the same id, repeated rows
too, get the same number of copies each. An empty table gives an empty one. Input columns
named like an added column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.session import freeze

#: Means above this are drawn as a sum of equal parts, each with a hash of its own.
PART_MEAN = 16.0
#: Terms of the distribution function of a part: the tail beyond is under 2**-60.
TERMS = 96


def uniform(seed: int, *keys) -> Column:
    """52 hashed bits as a number strictly between 0 and 1."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def row_key(doc_id: str, text: str) -> Column:
    """What a row draws by: its id, or its text where it has none."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))


def source_rates(docs: DataFrame, source: str, text: str, weights: DataFrame | None, exponent: float, scale: float):
    """One row per source: its mean repetition rate, number of parts, distribution function of a part."""
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(F.length(F.coalesce(text, F.lit("")))).alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("chars").cast("double"), exponent))
    else:
        chosen = weights.select(F.col("source").alias("_chosen"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(chosen, F.col("_source").eqNullSafe(F.col("_chosen")), "left").drop("_chosen")
        sizes = sizes.fillna(0.0, ["weight"])
    sizes = freeze(sizes)
    chars, weight = sizes.agg(F.sum("chars"), F.sum("weight")).first()  # two numbers
    rate = F.col("weight") / F.lit(weight) * F.lit(chars) * scale / F.col("chars")
    rates = sizes.withColumn("rate", F.when(F.col("chars") > 0, rate).otherwise(F.lit(1.0)))
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN).cast("int")))
    mean = F.col("rate") / F.col("parts")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * mean / k)).alias("cdf"),
        ),
    )
    return rates.select("_source", "rate", "parts", steps["cdf"].alias("cdf"))


def replicate(
    docs: DataFrame,
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    scale: float = 1.0,
    seed: int = 20240,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` with every row as often as drawn, plus ``copy``, ``n_copies`` and ``shuffle_key``.

    ``weights`` has ``source`` and ``weight``; sources it does not name are left out. Without
    it a source weighs its characters to the power ``exponent``. ``scale`` is the size of the
    result relative to the input.
    """
    docs = docs.drop("copy", "n_copies", "shuffle_key")
    name = next(f"_source{i}" for i in range(len(docs.columns) + 1) if not {f"_source{i}", f"_source{i}_rate"} & {*docs.columns})
    rates = freeze(source_rates(docs, source, text, weights, exponent, scale))
    named = rates.select(F.col("_source").alias(name), F.struct("parts", "cdf").alias(f"{name}_rate"))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col(f"{name}_rate.parts")),
        F.lit(0),
        lambda n, part: n + F.size(F.filter(f"{name}_rate.cdf", lambda c: c <= uniform(seed, row_key(doc_id, text), part))),
    )
    return (
        docs.join(named, F.col(source).eqNullSafe(F.col(name)))
        .withColumn("n_copies", drawn.cast("long"))
        .drop(name, f"{name}_rate")
        .filter("n_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
        .withColumn(
            "shuffle_key",
            F.md5(F.concat_ws("|", F.lit(f"{seed}s"), row_key(doc_id, text), "copy")),
        )
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )

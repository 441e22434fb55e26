"""Quality rules: one table of thresholds compiled into one Spark projection.

Everything is built-in column functions over one row, so there is no shuffle, no user
function and no state between rows. Words are maximal runs of characters other than
space and U+0009 to U+000D.

Defined results: a null or empty text has no words, all counts are 0 and it fails the
base rules. Repeated rows are judged one by one, each the same. Input columns other than
the text pass through unread; a column named like an added one is replaced by it, and the
names ``_words``, ``_lines`` and ``_digests`` are used in between and dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"

# Common function words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from has have he in is it of on or that the this to was were with "
    "au aux avec ce ces dans de des du elle en et il la le les leur ou par pas pour que qui sur un une "
    "als auf aus das dem den der des die ein eine einer es für im ist mit nicht sich sie und von zu zum "
    "asi así como con de del el en es la las lo los más no o para pero por que se si su un una y ya"
)


@dataclass(frozen=True)
class Rule:
    """A document fails when ``numerator / denominator`` is outside ``[low, high]``.

    The comparison is made on products of whole numbers, so it is exact. A document whose
    denominator is under ``at_least`` is too short for the rule and passes it.
    """

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None
    at_least: int = 1


# Ratios are stated in thousandths.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=1500, high=20000),
    Rule("symbols_to_words", "n_symbols", "n_words", high=300),
    Rule("stop_words", "n_stop_words", "n_words", low=5, at_least=100),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=500, at_least=4),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900, at_least=4),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=300, at_least=4),
)


def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def _repeat_words(digests: Column, window: int) -> Column:
    """Words inside a window that occurs twice or more in the text, the first one included.

    Only a text that has a repeated window is looked at position by position: windows are
    sorted with their positions, those equal to a neighbour stay, and each adds the words
    that the next one does not cover.
    """
    placed = F.array_sort(F.transform(digests, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        last = F.size(s)
        same = F.transform(
            s,
            lambda x, i: F.when(
                ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i + 1 < last) & (F.get(s, i + 1)["h"] == x["h"])),
                x["i"],
            ),
        )
        return F.sort_array(F.filter(same, lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def once(value: Column, then) -> Column:
        return F.get(F.transform(F.array(value), then), F.lit(0))

    plain = F.size(F.array_distinct(digests)) == F.size(digests)
    return F.when(plain, F.lit(0).cast("long")).otherwise(once(once(placed, repeated), covered))


def _joined(digests: str, step: int) -> Column:
    """Digest of each position together with the one ``step`` further; past the end there is none."""
    shifted = F.slice(digests, step + 1, F.greatest(F.size(digests), F.lit(1)))
    return F.zip_with(digests, shifted, lambda a, b: F.xxhash64(a, b))


def measure(docs: DataFrame, text: str = "text", repeat_window: int = 8) -> DataFrame:
    """Adds the counts that the rules compare.

    Words and lines come first, then digests of windows that double in width, then the
    counts. Each step is used several times by the next, so the planner keeps them apart
    and computes each once.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, SPACES), "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    n = F.size("_words")
    single = F.transform("_words", lambda w: F.xxhash64(w))
    stop = [w for s in dict.fromkeys(STOP_WORDS.split()) for w in (s, s.capitalize())]
    columns = {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_bullet_lines": _count(F.col("_lines"), lambda x: F.ltrim(x).rlike("^[-*\u2022]")),
        "n_ellipsis_lines": _count(F.col("_lines"), lambda x: F.rtrim(x).endswith("...")),
        "n_stop_words": _count(F.col("_words"), lambda w: w.isin(stop)),
        "n_repeat_words": _repeat_words(F.col("_digests"), repeat_window),
    }
    staged = docs.withColumns({"_words": words, "_lines": lines}).withColumn("_digests", single)
    width = 1
    while width < repeat_window:
        step = min(width, repeat_window - width)
        staged = staged.withColumn("_digests", _joined("_digests", step))
        width += step
    whole = F.slice("_digests", 1, F.greatest(n - (repeat_window - 1), F.lit(0)))
    return staged.withColumn("_digests", whole).withColumns(columns).drop("_words", "_lines", "_digests")


def verdict(rules: Iterable[Rule]) -> Column:
    """The table as one boolean column: true when every rule holds."""
    held = F.lit(True)
    for rule in rules:
        top, bottom = F.col(rule.numerator) * 1000, F.col(rule.denominator)
        ok = F.lit(True)
        if rule.low is not None:
            ok = ok & (top >= bottom * rule.low)
        if rule.high is not None:
            ok = ok & (top <= bottom * rule.high)
        held = held & ((bottom < rule.at_least) | ok)
    return held


def judge(
    docs: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text", min_words: int = 20, max_repeat_percent: int = 30
) -> DataFrame:
    """Adds the counts, ``base_failed`` and ``kept`` to every row of ``docs``."""
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    return (
        measure(docs, text)
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )


def keep(docs: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text", **base) -> DataFrame:
    """The rows that pass, with their own columns.

    A row number takes part in the filter. Without it the planner would move the filter below
    the projection and compute every count again wherever a rule uses it.
    """
    row = next(f"_row{i}" for i in range(len(docs.columns) + 1) if f"_row{i}" not in docs.columns)
    judged = judge(docs.select(F.struct(*docs.columns).alias("_own"), F.col(text)), rules, text, **base)
    numbered = judged.select("_own", "kept", F.monotonically_increasing_id().alias(row))
    return numbered.filter(F.col("kept") & (F.col(row) >= 0)).select("_own.*")

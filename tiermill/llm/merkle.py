"""Merkle manifest of a table, and proofs of its rows by a recursive query.

A row is a leaf: the sha256 of its fields. Leaves of one group ascend by id; every ``FANOUT``
of them become a node, and so on up to the subroot of the group; subroots, in the order of
their groups, become the root in the same way. The levels are stored as node rows that name
their parent and hold the digests of their children.

A recursive query climbs these rows. What climbs is a run: up to ``FANOUT`` leaves with one
parent, whose siblings differ on the first step and are the same on every further one. A step
joins the parent, appends the siblings to the proof and folds them into the digest of every
leaf of the run as it was read again, so that a changed leaf ends in another root. A run
leaves the loop when it has no parent: after as many steps as the logarithm of the largest
group, plus that of the number of groups.

Positions come from one range sort of (group, id, digest), so a group of any size is spread
over tasks; nothing gathers more rows than a run has. Digests are text (lowercase hex); those that
a climb carries along, and the children of a node, are bytes, 32 a digest. The node rows, of which
there is one to some 240 rows of the table, are broadcast to the climb while they are few.

Defined results: a null field counts as ``-``, also a null group or id, which come first in
their order; rows with one id are ordered by digest, and rows that repeat all fields are
leaves of their own with equal results. Text may be empty or of any length. An empty table has
no root and gives an empty result. Only the fields, the group and the id are read, whatever
other columns there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.operators.keys import surrogate_key
from tiermill.session import freeze

FANOUT = 16
#: Node rows up to which they are broadcast: some 640 bytes each, 40 MB in all.
BROADCAST_NODES = 1 << 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = -1


def leaf_digest(fields: Sequence[Column]) -> Column:
    """sha256 of all fields, each with its length in bytes, so that no two rows read the same."""
    told = [F.coalesce(F.concat(F.octet_length(f.cast("string")), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*told), 256)


def _around(digests: Column, slot: Column) -> tuple[Column, Column]:
    """Digests before and after one, each as one text."""
    return F.array_join(F.slice(digests, F.lit(1), slot), ""), F.array_join(F.slice(digests, slot + 2, F.lit(FANOUT)), "")


def _fold(before: Column, own: Column, after: Column) -> Column:
    return F.unhex(F.sha2(F.concat(before, own, after), 256))


def _name(tree: Column, level: Column | int, place: Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.concat_ws("/", tree, level, place)


def _up(place: Column) -> Column:
    return F.floor(place / FANOUT).cast("long")


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The next level: ``tree, level, place, n, children, digest``; ``n`` is the number of nodes of the tree there."""
    run = F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"])
    grouped = nodes.groupBy("tree", _up(F.col("place")).alias("place")).agg(F.array_join(run, "").alias("told"), F.first(_up(F.col("n") + FANOUT - 1)).alias("n"))
    return grouped.select(
        "tree", F.lit(level).alias("level"), "place", "n", F.unhex("told").alias("children"), F.sha2("told", 256).alias("digest")
    )


def _grow(nodes: DataFrame, level: int) -> list[DataFrame]:
    """All levels above ``nodes``, each in a written table, up to one node per tree."""
    levels, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level, most = level + 1, -(-most // FANOUT)
        nodes = freeze(_parents(nodes.filter("n > 1"), level))
        levels.append(nodes)
    return levels


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    doc_id: str = "doc_id",
    group: str = "source",
    reread: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The manifest: ``runs`` of leaves and ``nodes`` above them.

    ``runs`` has ``node, parent, slot, digest, subroot, leaves``; a leaf has ``slot, id, leaf``
    and ``seen``, its digest with the fields of ``reread`` in place of its own. ``nodes`` has
    ``node, parent, slot, digest, subroot, children``.
    """
    reread = reread or {}
    before, after = [F.col(f) for f in fields], [reread.get(f, F.col(f)) for f in fields]
    same = [reread[f].eqNullSafe(F.col(f)) for f in fields if f in reread]
    changed = ~F.array_min(F.array(*same)) if same else F.lit(False)
    rows = docs.select(
        F.col(group).alias("grp"),
        F.col(doc_id).alias("id"),
        leaf_digest(before).alias("leaf"),
        F.when(changed, leaf_digest(after)).alias("seen"),
        F.monotonically_increasing_id().alias("row"),
    )
    # The row number only spreads repeated rows; it is fixed by the written table.
    leaves = freeze(surrogate_key(freeze(rows), ["grp", "id", "leaf", "row"], "at", start=0).drop("row"))
    groups = leaves.groupBy("grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    trees = freeze(surrogate_key(groups, ["grp"], "tree", start=0))
    placed = leaves.join(trees, leaves["grp"].eqNullSafe(trees["grp"])).select(
        "tree", "size", "id", "leaf", F.coalesce("seen", "leaf").alias("seen"), (F.col("at") - F.col("first")).alias("at")
    )
    slot = F.pmod("at", F.lit(FANOUT)).cast("int")
    runs = placed.groupBy("tree", _up(F.col("at")).alias("place"), "size").agg(
        F.sort_array(F.collect_list(F.struct(slot.alias("slot"), "id", "leaf", "seen"))).alias("leaves")
    )
    digests = F.array_join(F.transform("leaves", lambda x: x["leaf"]), "")
    own = F.when(F.col("size") == 1, digests).otherwise(F.sha2(digests, 256))  # a lone leaf is its group's subroot
    runs = freeze(runs.withColumn("digest", own).withColumn("n", _up(F.col("size") + FANOUT - 1)))

    inner = _grow(runs.select("tree", "place", "n", "digest"), 1)
    roots = [x.filter("n = 1").select("tree", "digest") for x in [runs, *inner]]
    tops = roots[0]
    for x in roots[1:]:
        tops = tops.unionByName(x)
    many = trees.count()
    tops = tops.select(F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(many).cast("long").alias("n"), "digest")
    outer = _grow(tops, 1)

    def linked(level: DataFrame, number: Column | int, subroots: bool, *rest: str) -> DataFrame:
        """Node rows with their parents: the next level, or from a subroot the tree of subroots."""
        last, own_level = F.col("n") == 1, F.lit(number) if isinstance(number, int) else number
        rises = _name(F.col("tree"), own_level + 1, _up(F.col("place")))
        climbs = F.when(F.lit(many > 1), _name(F.lit(_TOP), 2, _up(F.col("tree")))) if subroots else F.lit(None).cast("string")
        at = F.when(last, F.col("tree")).otherwise(F.col("place")) if subroots else F.col("place")
        return level.select(
            _name(F.col("tree"), own_level, F.col("place")).alias("node"),
            F.when(last, climbs).otherwise(rises).alias("parent"),
            F.pmod(at, F.lit(FANOUT)).cast("int").alias("slot"),
            "digest",
            (F.lit(subroots) & last).alias("subroot"),
            *rest,
        )

    spark = docs.sparkSession
    nodes = spark.createDataFrame([], "node string, parent string, slot int, digest string, subroot boolean, children binary")
    for levels, subroots in ((inner, True), (outer, False)):
        for x in levels:
            nodes = nodes.unionByName(linked(x, F.col("level"), subroots, "children"))
    return linked(runs, 1, True, "leaves"), freeze(nodes)


_CLIMB = """
WITH RECURSIVE climb(run, parent, slot, digest, subroot, folded, proof) AS (
  SELECT run, parent, slot, digest, subroot, folded, proof FROM {runs}
  UNION ALL
  SELECT run, up, up_slot, up_digest, coalesce(subroot, up_subroot),
         transform(folded, f -> unhex(sha2(concat(lower(hex(before)), lower(hex(f)), lower(hex(after))), 256))),
         concat(proof, before, after)
  FROM (
    SELECT c.run, c.subroot, c.folded, c.proof, n.parent AS up, n.slot AS up_slot, n.digest AS up_digest,
           CASE WHEN n.subroot THEN n.digest END AS up_subroot,
           substring(n.children, 1, 32 * c.slot) AS before, substring(n.children, 32 * c.slot + 33) AS after
    FROM climb c JOIN {nodes} n ON n.node = c.parent
  )
)
SELECT run, digest AS root, subroot, folded, proof FROM climb WHERE parent IS NULL
"""


@contextmanager
def _unlimited(spark: SparkSession):
    """Rows of a recursive query grow with the table, so their number has no limit; its depth keeps the usual one."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def climb(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``run, root, subroot, folded, proof`` for every run; ``folded`` has the root as folded from each leaf as it was seen."""
    spark = runs.sparkSession
    digests = F.transform("leaves", lambda x: x["leaf"])

    def first_step(leaf: Column, i: Column) -> Column:
        before, after = _around(digests, i)
        return _fold(before, leaf["seen"], after)

    lone = F.col("subroot") & (F.size("leaves") == 1)
    start = runs.select(
        F.col("node").alias("run"),
        "parent",
        "slot",
        "digest",
        F.when(F.col("subroot"), F.col("digest")).alias("subroot"),
        F.when(lone, F.transform("leaves", lambda x: F.unhex(x["seen"]))).otherwise(F.transform("leaves", first_step)).alias("folded"),
        F.lit(b"").alias("proof"),
    )
    if nodes.count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    with _unlimited(spark):
        return freeze(spark.sql(_CLIMB, runs=start, nodes=nodes))


def prove(
    docs: DataFrame,
    reread: Mapping[str, Column] | None = None,
    fields: Sequence[str] = FIELDS,
    doc_id: str = "doc_id",
    group: str = "source",
) -> DataFrame:
    """One row per document: its id, ``leaf, subroot, root, proof, folded_root, verified``.

    ``proof`` has the digests of the siblings, level by level up to the root, left to right.
    ``folded_root`` is the root that follows from the row as ``reread`` gives it, and the row is
    ``verified`` if that is the root of the manifest.
    """
    runs, nodes = build(docs, fields, doc_id, group, reread)
    found = climb(runs, nodes)
    digests = F.transform("leaves", lambda x: x["leaf"])

    def shown(leaf: Column, i: Column) -> Column:
        before, after = _around(digests, i)
        own = F.lower(F.hex(F.get("folded", i)))
        return F.struct(leaf["id"].alias("id"), leaf["leaf"].alias("leaf"), own.alias("folded_root"), F.concat(before, after, "above").alias("proof"))

    rows = runs.select(F.col("node").alias("run"), "leaves").join(found, "run")
    rows = rows.withColumn("above", F.lower(F.hex("proof")))
    rows = rows.select("root", "subroot", F.inline(F.transform("leaves", shown)))
    return rows.select(
        F.col("id").alias(doc_id), "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )

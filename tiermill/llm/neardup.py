"""Near-duplicate classes by fast similarity sketches, banding and exact verification.

A document is the set of its distinct 5-word shingles, A-Z in lower case. Its sketch has
``BANDS * ROWS`` coordinates, filled in rounds: in each of the first rounds every shingle is
hashed to one coordinate, and the least hash stays; a coordinate filled in an earlier round
keeps its value. A long text fills nearly all in two or three rounds over its shingles,
instead of one pass per coordinate. As many further rounds send all shingles to one
coordinate each, so that every coordinate is certain to be filled, and the share of equal
coordinates estimates the similarity with concentration bounds like those of independent
minima. Documents of similarity 0.75 miss all bands with a probability under 3e-7.

Equal sets are one class before any pairing. Classes that share a band are candidates; no
pair of a bucket is ever a row. First each class is compared with one hub, of those buckets
it is in the class met most often, which links most near copies at one comparison each.
Buckets that then still hold several components are resolved exactly: their classes go to
groups of bounded size (what hangs together by open buckets, else one bucket, else pairs of
blocks of it), and a task compares each class outside its largest component with all of the
group in one pass over their sets. So no link between different texts is lost that a band
shows. All comparisons are on full sets.

Components come from rounds of large-star and small-star steps over linked classes, every
round in a written table. Hot buckets: counts and hubs are combined in every task
before they are shuffled, and joins on a bucket can be split by adaptive execution.

Defined results: null texts and texts without words have no shingle, link with nothing and
stay; a text of one to four words is one shingle. A component's id is its least document id
that is not null. Repeated rows are documents like any other; rows with one id and
different texts are versions of a document and linked. Ids may be numbers or texts. An empty table gives
an empty one. Only the id and text columns are read. Shingles are told apart by 52 bits of hash within a document and pair, sets by 128.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm import textbatch as tb
from tiermill.session import freeze, freeze_counted

SHINGLE = 5
BANDS, ROWS = 40, 4
#: Bounds of a group of classes that one task compares with each other.
CLASSES, SHINGLES = 4096, 2_000_000
#: Rows up to which ids are broadcast: some 60 bytes each, 32 MB in all.
BROADCAST_ROWS = 1 << 19
_ID_BITS = np.uint64(52)
_UNFILLED = np.uint64(2**64 - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every distinct shingle, in order; at most 4096 texts at once."""
    start, end, doc = tb.words(data, offsets)
    hashes = tb.word_hashes(tb.LOWER[data], start, end)
    sums = tb.Sums(hashes, 1)
    whole = np.flatnonzero(tb.together(doc, shingle))
    first = np.searchsorted(doc, np.arange(len(offsets)))
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < shingle))
    found = np.concatenate([sums.rolling(shingle)[whole], sums.of(first[short], first[short + 1])])
    width = np.concatenate([np.full(len(whole), shingle), count[short]]).astype(np.uint64)
    owner = np.concatenate([doc[whole], short]).astype(np.uint64)
    keys = np.sort((owner << _ID_BITS) | (tb.mix(found + width, 7) >> np.uint64(12)))
    if len(keys):
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
    return (keys >> _ID_BITS).astype(np.int64), keys & np.uint64((1 << 52) - 1)


def sketches(doc: np.ndarray, hashes: np.ndarray, texts: int, size: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``size`` coordinates per text; a text without shingles has none filled."""
    filled = np.full(texts * size, _UNFILLED)
    for turn in range(2 * size):
        if not len(doc):
            break
        drawn = tb.mix(hashes, 50 + turn)
        place = doc * size + ((drawn >> np.uint64(32)) % np.uint64(size)).astype(np.int64) if turn < size else doc * size + (turn - size)
        np.minimum.at(filled, place, (drawn & np.uint64(0xFFFFFFFF)) | np.uint64(turn << 32))
        open_ = (filled.reshape(texts, size) == _UNFILLED).any(axis=1)[doc]
        if not open_.all():
            doc, hashes = doc[open_], hashes[open_]
    return filled.reshape(texts, size)


def _small_chunks(column):
    for first, data, offsets in tb.chunks(column):
        for at in range(0, len(offsets) - 1, 4096):
            part = offsets[at : at + 4097]
            yield first + at, data[part[0] : part[-1]], part - part[0]


def _sign(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        sets, names, keys = [], [[], []], []
        for _, data, offsets in _small_chunks(batch.column("text")):
            texts = len(offsets) - 1
            doc, hashes = shingle_sets(data, offsets)
            sets.append(np.bincount(doc, minlength=texts))
            bounds = np.searchsorted(doc, np.arange(texts + 1))
            for seed, name in zip((8, 9), names):
                sums = np.append(np.uint64(0), np.cumsum(tb.mix(hashes, seed), dtype=np.uint64))
                name.append(sums[bounds[1:]] - sums[bounds[:-1]])
            coordinates = sketches(doc, hashes, texts).reshape(texts * BANDS, ROWS)
            band = np.tile(np.arange(BANDS, dtype=np.uint64), texts)
            for row in range(ROWS):
                band = tb.mix(band ^ coordinates[:, row], 20 + row)
            keys.append(band)
        flat = pa.array(np.concatenate(keys).view(np.int64))
        bounds = pa.array(np.arange(0, batch.num_rows * BANDS + 1, BANDS, dtype=np.int32))
        yield pa.record_batch(
            {
                "id": batch.column("id"),
                "text_hash": batch.column("text_hash"),
                "n_shingles": pa.array(np.concatenate(sets), pa.int64()),
                "h1": pa.array(np.concatenate(names[0]).view(np.int64)),
                "h2": pa.array(np.concatenate(names[1]).view(np.int64)),
                "keys": pa.ListArray.from_arrays(bounds, flat),
            }
        )


#: Bytes of shingle sets that a task keeps at hand.
KEEP = 48 << 20


def _compare(batches):
    """Pairs whose sets have the needed similarity; sets met again in the task are kept while they fit."""
    sets: dict[str, np.ndarray] = {}
    room = KEEP

    def one(text: str) -> np.ndarray:
        nonlocal room
        known = sets.get(text)
        if known is None:
            raw = np.frombuffer(text.encode(), np.uint8)
            known = shingle_sets(raw, np.array([0, len(raw)]))[1]
            room -= known.nbytes + 2 * len(text)
            if room < 0:
                sets.clear()
                room = KEEP
            sets[text] = known
        return known

    for batch in batches:
        keep = []
        for left, right, percent in zip(*(batch.column(n).to_pylist() for n in ("pivot_text", "text", "percent"))):
            a, b = one(left), one(right)
            if len(a) > len(b):
                a, b = b, a
            shared = int(tb.isin(a, b).sum())
            keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["pivot", "node"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for all nodes of ``a``-``b`` edges but the roots."""
    edges, mark = freeze(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = sides.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = freeze(large.filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = freeze(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now


def _unresolved(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots, of the buckets that hold several components."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return placed.join(several.select("key"), "key", "left_semi")


def _units(open_: DataFrame) -> DataFrame:
    """Groups of classes to be compared with each other in one task each: ``kind, unit, i, j, node, root``.

    A unit is all that hangs together by open buckets, if that is small, or else one bucket;
    a bucket over the bounds is cut into blocks, and every pair of blocks is a group.
    """
    star = open_.select(F.col("node").alias("a"), "key").join(open_.groupBy("key").agg(F.min("node").alias("b")), "key")
    clusters = components(star.select("a", "b")).withColumnRenamed("root", "cluster")
    classes = open_.groupBy("node").agg(F.max("n").alias("n"), F.min("root").alias("root")).join(clusters, "node", "left")
    classes = freeze(classes.withColumn("cluster", F.coalesce("cluster", "node")))
    size = [F.count("*").alias("classes"), F.sum("n").alias("shingles")]
    small = classes.groupBy("cluster").agg(*size).filter((F.col("classes") <= CLASSES) & (F.col("shingles") <= SHINGLES)).select("cluster")
    whole = classes.join(small, "cluster", "left_semi").select(F.lit(0).alias("kind"), F.col("cluster").alias("unit"), "node", "n", "root")
    large = classes.join(small, "cluster", "left_anti").select("node")
    parts = open_.join(large, "node", "left_semi").select(F.lit(1).alias("kind"), F.col("key").alias("unit"), "node", "n", "root")
    units = freeze(whole.unionByName(parts))
    blocks = F.greatest(F.ceil(F.col("classes") / CLASSES), F.ceil(F.col("shingles") / SHINGLES)).cast("int")
    cut = units.groupBy("kind", "unit").agg(*size).select("kind", "unit", blocks.alias("blocks"))
    placed = units.join(cut, ["kind", "unit"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("kind", "unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "root")


def _linker(percent: int):
    """Links between components among the classes of a group, as many as connect what belongs together.

    Every class outside the largest component is compared with all others at once: its
    shingles are flagged, and the flags are counted over the sets of all.
    """

    def step(group: pa.Table) -> pa.Table:
        node = group["node"].to_numpy()
        _, label = np.unique(group["root"].to_numpy(), return_inverse=True)
        owner, hashes = [], []
        for first, data, offsets in _small_chunks(group["text"]):
            doc, own = shingle_sets(data, offsets)
            owner.append(doc + first)
            hashes.append(own)
        owner = np.concatenate(owner)
        known, number = np.unique(np.concatenate(hashes), return_inverse=True)
        bounds = np.searchsorted(owner, np.arange(len(node) + 1))
        sizes = np.diff(bounds)
        flags, largest, found = np.zeros(len(known), bool), np.bincount(label).argmax(), []
        for p in np.flatnonzero(label != largest):
            if label[p] == largest:
                continue
            own = number[bounds[p] : bounds[p + 1]]
            flags[own] = True
            shared = np.add.reduceat(flags[number], bounds[:-1], dtype=np.int64)
            flags[own] = False
            for q in np.flatnonzero((100 * shared >= percent * (sizes[p] + sizes - shared)) & (label != label[p])):
                if label[q] != label[p]:
                    found.append((node[p], node[q]))
                    old, new = (label[p], label[q]) if label[q] == largest else (label[q], label[p])
                    label[label == old] = new
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return step


def link(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` and ``kept``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    signed = freeze(rows.mapInArrow(_sign, f"id {kind}, text_hash long, n_shingles long, h1 long, h2 long, keys array<long>"))

    # A class is a set; its row number in a written table is its name. One of its rows stands for
    # its text, a row with an id if there is one.
    classes = signed.filter("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("id").alias("least_id"),
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")).alias("shown"),
        F.first("n_shingles").alias("n"),
        F.first("keys").alias("keys"),
    )
    classes = freeze(classes.withColumn("node", F.monotonically_increasing_id()))
    owned = freeze(signed.filter("n_shingles > 0").select("id", "n_shingles", "h1", "h2").join(classes.select("h1", "h2", "node"), ["h1", "h2"]).drop("h1", "h2"))
    versions = _versions(owned)
    banded = classes.select("node", "n", F.explode(F.array_distinct("keys")).alias("key"))
    shared = banded.groupBy("key").agg((F.count("*") - 1).alias("others")).filter("others > 0")
    met = freeze(banded.join(shared, "key"))
    # The classes met most often are in the middle of their group and compared first.
    weight = met.groupBy("node").agg(F.sum("others").alias("weight"))
    members = freeze(met.drop("others").join(weight, "node"))
    hubs = members.groupBy("key").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub"))

    texts = _texts(rows, classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "shown.*"))

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
        told = pairs.join(texts, "node").join(left, "pivot")
        told = told.select("pivot", "pivot_text", "node", "text", F.lit(percent).alias("percent"))
        return told.mapInArrow(_compare, "pivot long, node long").select(F.col("pivot").alias("a"), F.col("node").alias("b"))

    def near(a: str, b: str):
        return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)

    # First the hub that shares most bands with a class, among those of a possible size.
    hub_sizes = members.select(F.col("node").alias("hub"), F.col("n").alias("hub_n")).distinct()
    stars = members.join(hubs, "key").filter("node <> hub").groupBy("node", "hub", "n").agg(F.count("*").alias("bands"))
    stars = stars.join(hub_sizes, "hub").filter(near("n", "hub_n"))
    best = stars.groupBy("node").agg(F.max_by("hub", F.struct("bands", -F.col("hub"))).alias("pivot"))
    roots = components(verified(best).unionByName(versions))
    open_, found = freeze_counted(_unresolved(members, roots))
    if found:
        links = _units(open_).join(texts, "node").groupBy("kind", "unit", "i", "j").applyInArrow(_linker(percent), "a long, b long")
        roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    placed = classes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = owned.join(placed.join(ids, "root").select("node", "component_id"), "node").drop("node")
    alone = signed.filter("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(doc_id), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _versions(owned: DataFrame) -> DataFrame:
    """Edges between the classes that share an id: each to the least of them."""
    pairs = owned.filter("id is not null").select("id", "node")
    several, found = freeze_counted(pairs.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("high")).filter("b <> high").select("id", "b"))
    if not found:
        return owned.sparkSession.createDataFrame([], "a long, b long")
    return pairs.distinct().join(several, "id").filter("node <> b").select(F.col("node").alias("a"), "b")


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the wanted classes, whose rows are told by id and hash of the text.

    The rows are not shuffled while the wanted ones are few enough to be sent to every task.
    """
    wanted, count = freeze_counted(wanted)
    small = F.broadcast if count <= BROADCAST_ROWS else (lambda df: df)
    named = wanted.filter("not unnamed").select("node", "id", "text_hash")
    found = rows.join(small(named), ["id", "text_hash"]).select("node", "text")
    if count and wanted.filter("unnamed").limit(1).count():
        # Rows without an id may all be one text: they are made distinct in every task first.
        bare = rows.filter("id is null").groupBy("text_hash").agg(F.first("text").alias("text"))
        found = found.unionByName(bare.join(wanted.filter("unnamed").select("node", "text_hash"), "text_hash").select("node", "text"))
    found, rows_found = freeze_counted(found)
    return found if rows_found <= count else freeze(found.groupBy("node").agg(F.first("text").alias("text")))

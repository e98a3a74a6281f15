"""Near-duplicate documents by HyperMinHash over word shingles.

A document's set holds its distinct runs of ``words`` words in lower case, as 64-bit hashes. Low bits of a hash pick one of
``BUCKETS`` buckets; of the least rest in each bucket the sketch keeps the number of its leading zeros and the
``MANTISSA`` bits after them, 16 bits in all. An empty bucket borrows from the first filled one in an order of its own, the
same for all documents. Bands of ``ROWS`` registers are hashed; documents that share a band are candidates.

Equal sets become one node first, named by a hash. The members of a band are compared with its least node, so a group of thousands of copies
makes about one pair for each of them. A pair's similarity is estimated from equal registers, less those that are equal by
accident, and pairs that are not far below the threshold are verified on their full sets.

Members that did not link to that node may still link to each other. They are found without pairing all of them, and
without leaving out any. Take a cluster, all that candidate pairs connect, and its core, the shingles that more than half of
its members hold. First the member nearest to the core is compared with all that are not in its group. Then, for members x
and y of different groups that hold i of their n shingles in the core, at most min(i) shared shingles lie within it. So
either min(i) alone reaches the threshold, or they share a shingle outside it; of those, only the rarest of each member need
be looked up (a prefix filter). What members of a cluster share beyond its core is rare, and so are such pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import U, blob, mix, runs_of, slices, words_of
from gaugeworks.llm.graph import components, hub_pairs
from gaugeworks.session import ship_package, written

BUCKET_BITS, MANTISSA, ROWS = 7, 10, 4
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // ROWS
#: Standard deviations by which an estimate may fall below the threshold; misses one true pair in some millions.
SLACK = 5.0
#: Sets smaller than this fill too few buckets for an estimate; their pairs are verified at once.
SMALL = 2 * BUCKETS
_REST = 64 - BUCKET_BITS
_ORDER = np.array([np.random.default_rng(j).permutation(BUCKETS) for j in range(BUCKETS)])
_BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=U))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, bucket in the high bits; a shorter text is one shingle."""
    words = words_of(texts, lower=True)
    start, run = runs_of(words, n)
    cut = np.searchsorted(start, words.ptr)
    out = []
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        own = words.hashes[words.ptr[i] : words.ptr[i + 1]]
        if a == b and len(own):  # as one shingle, unlike any of another length
            whole = int.from_bytes(blake2b(own.tobytes() + bytes([len(own)]), digest_size=8).digest(), "little")
            out.append(np.array([whole], U))
        else:
            out.append(np.unique(run[a:b]))
    return out


def sketch(own: np.ndarray) -> np.ndarray:
    """Compressed registers of a set that is not empty."""
    bucket, first = np.unique((own >> U(_REST)).astype(np.int64), return_index=True)
    rest = own[first] & U((1 << _REST) - 1)
    # Leading zeros by the exponent of a float; rounding up to the next power of two is put right.
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    bits -= (bits > 0) & (rest < (U(1) << np.maximum(bits - 1, 0).astype(U)))
    top = np.where(bits > MANTISSA, rest >> np.maximum(bits - 1 - MANTISSA, 0).astype(U), rest << np.maximum(MANTISSA + 1 - bits, 0).astype(U))
    value = ((_REST - bits) << MANTISSA) | (top.astype(np.int64) & ((1 << MANTISSA) - 1))
    out = np.full(BUCKETS, -1, np.int64)
    out[bucket] = value
    empty = np.flatnonzero(out < 0)
    if len(empty):
        tries = out[_ORDER[empty]]
        out[empty] = tries[np.arange(len(empty)), (tries >= 0).argmax(axis=1)]
    return out.astype(np.uint16)


def bands(registers: np.ndarray) -> np.ndarray:
    return mix(registers.reshape(BANDS, ROWS).copy().view(U).ravel() ^ _BAND_SALT).view(np.int64)


def accidents(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that the registers of different least hashes are equal: same leading zeros, same mantissa."""
    zeros = np.arange(_REST)

    def exactly(n: np.ndarray) -> np.ndarray:
        per_bucket = np.maximum(n, BUCKETS)[:, None] / BUCKETS
        at_least = 1 - np.power(1 - 0.5 ** np.arange(_REST + 1), per_bucket)
        return at_least[:, zeros] - at_least[:, zeros + 1]

    return (exactly(n_a) * exactly(n_b)).sum(axis=1) * 0.5**MANTISSA


def similarity_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity by registers (one row for each pair), corrected for accidents."""
    equal, chance = (a == b).mean(axis=1), accidents(n_a, n_b)
    return np.maximum(0, (equal - chance) / (1 - chance))


def _scan(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), n)
            sketches = [sketch(x) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary()),
                 pa.array([None if x is None else blob(x) for x in sketches], pa.binary()),
                 pa.array([None if x is None else bands(x) for x in sketches], pa.list_(pa.int64()))],
                ["id", "n", "digest", "registers", "bands"])

    return work


def _sets(n: int):
    """Full sets of the documents that candidates are made of."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), n)
            fits = [blake2b(x.tobytes(), digest_size=16).digest() == d for x, d in zip(sets, batch.column("digest").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                ["node", "n", "items"]).filter(pa.array(fits))

    return work


def _estimate(percent: int):
    """Of candidate pairs with both sketches, those whose estimate allows the threshold."""
    threshold = percent / 100
    lowest = threshold - SLACK * np.sqrt(threshold * (1 - threshold) / BUCKETS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
                na, nb = (batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
                small, large = np.minimum(na, nb), np.maximum(na, nb)
                good = (100 * small >= percent * large) & ((small < SMALL) | (similarity_estimate(a, b, na, nb) >= lowest))
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return work


def _verify(percent: int):
    def lists(column: pa.ListArray) -> list[np.ndarray]:
        return np.split(column.flatten().to_numpy().view(U), np.cumsum(column.value_lengths().to_numpy())[:-1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = []
                for a, b in zip(lists(batch.column("ia")), lists(batch.column("ib")), strict=True):
                    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
                    good.append(100 * both >= percent * (len(a) + len(b) - both))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return work


class _Comparison:
    """Estimates and verifies candidate pairs of nodes whose ``sets`` (node, n, items) are stored."""

    schema = "a long, b long"

    def __init__(self, nodes: DataFrame, sets: DataFrame, percent: int):
        self.nodes, self.sets, self.percent = nodes, sets, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that reach the threshold."""
        sketches = lambda s: self.nodes.select(F.col("node").alias(s), F.col("registers").alias(f"r{s}"), F.col("n").alias(f"n{s}"))
        items = lambda s: self.sets.select(F.col("node").alias(s), F.col("items").alias(f"i{s}"))
        likely = pairs.join(sketches("a"), "a").join(sketches("b"), "b").mapInArrow(_estimate(self.percent), self.schema).distinct()
        sides = likely.join(items("a"), "a").join(items("b"), "b")
        return written(sides.mapInArrow(_verify(self.percent), self.schema).distinct(), "links")


def _regrouped(df: DataFrame, links: DataFrame) -> DataFrame:
    """``df`` (with ``node``) and the ``root`` that the links lead to."""
    return df.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _profiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """cluster, node, root, n, inner (shingles in the core), core (its size) and rare, those outside that must be looked up.

    ``members`` is (cluster, size, node, root). ``rare`` is the prefix of a node's other shingles by their number of members,
    long enough to hold one of every ``ceil(percent / 100 * n) - inner`` of them.
    """
    held = members.join(sets, "node")
    items = held.select("cluster", "size", "node", F.explode_outer("items").alias("item"))
    counts = items.groupBy("cluster", "item").agg(F.count("*").alias("times"), F.first("size").alias("size")).where("times > 1")
    counts = written(counts.select("cluster", "item", "times", (F.col("times") * 2 > F.col("size")).alias("inner")), "shingle-counts")
    cores = counts.where("inner").groupBy("cluster").agg(F.count("*").alias("core"))
    outer = F.when(~F.col("inner"), F.struct("times", "item"))
    common = items.join(counts, ["cluster", "item"]).groupBy("cluster", "node").agg(
        F.sum(F.col("inner").cast("long")).alias("inner"), F.array_sort(F.collect_list(outer)).alias("outer"))
    known = held.select("cluster", "node", "root", "n").join(common, ["cluster", "node"], "left").join(cores, "cluster", "left")
    known = known.withColumns({"inner": F.coalesce("inner", F.lit(0)), "core": F.coalesce("core", F.lit(0)),
                               "outer": F.coalesce("outer", F.expr("cast(array() as array<struct<times: bigint, item: bigint>>)"))})
    needed = F.ceil(F.col("n") * percent / 100) - F.col("inner")
    alone = F.col("n") - F.col("inner") - F.size("outer")  # shingles of no other member come first
    length = F.col("n") - F.col("inner") - F.greatest(needed, F.lit(1)) + 1 - alone
    rare = F.transform(F.slice("outer", 1, F.greatest(length, F.lit(0)).cast("int")), lambda x: x["item"])
    return written(known.select("cluster", "node", "root", "n", "inner", "core", rare.alias("rare")), "profiles")


def _beyond_hubs(profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that may reach the threshold, by core and rare shingles."""
    x_, y_ = "x.", "y."
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    near = profiles.select("cluster", "node", "root", "n", "inner").where(F.col("inner") * 100 >= F.col("n") * percent)
    within = F.least(x_ + "inner", y_ + "inner") * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    by_core = near.alias("x").join(near.alias("y"), (F.col("x.cluster") == F.col("y.cluster")) & apart & within)
    looked_up = profiles.select("cluster", "node", "root", "n", F.explode("rare").alias("item"))
    sizes = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    by_item = looked_up.alias("x").join(looked_up.alias("y"), (F.col("x.cluster") == F.col("y.cluster")) & (
        F.col("x.item") == F.col("y.item")) & apart & sizes)
    pair = [F.col("x.node").alias("a"), F.col("y.node").alias("b")]
    return by_core.select(pair).unionByName(by_item.select(pair)).distinct()


def _links(nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between nodes: all that decide which nodes belong together."""
    _, pairs = hub_pairs(nodes.select(F.explode_outer("bands").alias("key"), "node"))
    pairs = written(pairs, "band-pairs")
    clusters = components(pairs).withColumnRenamed("root", "cluster")
    wanted = nodes.select("node", "first", "digest").join(clusters.select("node"), "node", "left_semi")
    # Rows that repeat id and text give their set once.
    found = texts.withColumn("hash", F.xxhash64("text")).join(wanted, F.col("id") == F.col("first")).dropDuplicates(["id", "digest", "hash"])
    sets = written(found.select("node", "digest", "text").mapInArrow(_sets(words), "node long, n long, items array<long>"), "sets")
    compare = _Comparison(nodes, sets.select("node", "items"), percent)
    links = compare.links(pairs)

    grouped = _regrouped(clusters, links)
    mixed = grouped.groupBy("cluster").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).where("low < high")
    profiles = _profiles(written(grouped.join(mixed.select("cluster", "size"), "cluster"), "open-clusters"), sets, percent)
    nearness = F.col("inner") / (F.col("n") + F.col("core") - F.col("inner"))
    centres = profiles.groupBy("cluster").agg(F.max_by(F.struct("node", "root"), F.struct(nearness, "node")).alias("centre"))
    to_centre = profiles.join(centres, "cluster").where(F.col("root") != F.col("centre.root"))
    tried = written(to_centre.select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct(), "centre-pairs")
    links = links.unionByName(compare.links(tried))

    rest = _beyond_hubs(_regrouped(profiles.drop("root"), links), percent)
    return links.unionByName(compare.links(rest))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id and kept of each row.

    Rows are linked if 100 * shared shingles >= ``percent`` * shingles of either; ``component_id`` is the smallest id that
    links lead to, the row's own included, and ``kept`` tells that it is the row's own. A text without words has no shingles
    and no links, like a row with a null id (component_id null, kept). Rows that share an id are judged one by one. An empty table
    gives an empty one; other columns are left out.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    rows = written(texts.mapInArrow(_scan(words), f"id {kind}, n long, digest binary, registers binary, bands array<long>"), "sketches")
    full = rows.where("n > 0 and id is not null")
    classes = full.groupBy("digest").agg(F.min("id").alias("first")).withColumn("node", F.xxhash64("digest"))
    firsts = full.join(classes.select(F.col("digest").alias("d"), "first", "node"), (F.col("id") == F.col("first")) & (F.col("digest") == F.col("d")))
    nodes = written(firsts.select("node", "first", "n", "digest", "registers", "bands").dropDuplicates(["node"]), "nodes")

    of = _regrouped(classes, _links(nodes, texts, words, percent))
    names = of.groupBy("root").agg(F.min("first").alias("component"))
    to = of.join(names, "root").select("digest", "component")
    out = rows.select("id", "n", "digest").join(to, "digest", "left")
    component = F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))

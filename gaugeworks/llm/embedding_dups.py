"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the axis, with sign, on which
its largest coordinate lies. ``HASHES`` such hashes make the key of a table. A vector is put into the bucket of its own
key and, as probes, into those where one hash is the axis of its second largest coordinate. At a cosine of 0.98 in 64
dimensions two vectors meet in one table in 93 of 100 cases, so ``TABLES`` = 6 miss about one pair in ten million.

Vectors that are equal become one node with a weight first. A bucket of more than ``TILE`` nodes is cut into tiles, and each
pair of tiles is a task's work, so no bucket has to fit into one. Candidates are verified by their cosine in double
precision; a pair that meets in several buckets counts in the first of them. Pairs never leave the worker: it passes on, for
each node, the number of its links and a node of its group that it leads to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import U, blob, mix
from gaugeworks.llm.graph import components
from gaugeworks.session import ship_package, written

TABLES, HASHES = 6, 2
PROBES = 1 + HASHES
#: Nodes of a bucket that meet in one task at most; larger buckets are cut.
TILE = 1024
#: Pairs whose vectors are gathered at once.
AT_ONCE = 1 << 14


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the number of columns is a power of two."""
    step = 1
    while step < x.shape[1]:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        step *= 2
    return x


@lru_cache(maxsize=256)
def _signs(table: int, number: int, size: int) -> np.ndarray:
    return np.random.default_rng((table, number, size)).choice([-1.0, 1.0], (3, size))


def axes(x: np.ndarray, table: int, number: int) -> np.ndarray:
    """(first, second) signed axis of the two largest coordinates of each rotated row; the lower axis among equals."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    for signs in _signs(table, number, size):
        x = hadamard(x * signs)
    order = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :2]
    return order * 2 + (np.take_along_axis(x, order, 1) > 0)


def keys(x: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Bucket keys of each row, ``PROBES`` for each table; ``salt`` keeps apart what must not meet."""
    out = []
    for table in range(TABLES):
        own = np.stack([axes(x, table, j) for j in range(HASHES)], axis=1).astype(U)
        for probe in range(PROBES):
            key = mix(salt + U(table + 1))
            for j in range(HASHES):
                key = mix(key ^ (own[:, j, int(probe == j + 1)] + U(1)))
            out.append(key)
    return np.stack(out, axis=1)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors in double precision, with a digest of label and vector and with their keys; nulls for others."""
    names = ["id", "digest", "vector", "own_keys", "keys"]
    kinds = [None, pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    for batch in batches:
        labels, ids = batch.column("label").to_pylist(), batch.column("id")
        rows, vectors = [], []
        for i, vector in enumerate(batch.column("vector").to_pylist()):
            if ids[i].is_valid and labels[i] is not None and vector and None not in vector:
                vector = np.array(vector, np.float64) + 0.0  # one zero
                if np.isfinite(vector).all() and vector.any():
                    rows.append(i)
                    vectors.append(vector / np.abs(vector).max())  # no overflow in squares; the cosine stays
        other = sorted(set(range(len(labels))) - set(rows))
        if other:
            empty = [pa.nulls(len(other), kind) for kind in kinds[1:]]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(other)), *empty], names)
        for size in {len(x) for x in vectors}:
            use = [k for k, x in enumerate(vectors) if len(x) == size]
            x = np.array([vectors[k] for k in use])
            label = [repr((labels[rows[k]], size)).encode() for k in use]
            salt = np.array([int.from_bytes(blake2b(n, digest_size=8).digest(), "little") for n in label], U)
            of = keys(x / np.linalg.norm(x, axis=1, keepdims=True), salt)
            found = ([blake2b(n + v.tobytes(), digest_size=16).digest() for n, v in zip(label, x, strict=True)],
                     [blob(v) for v in x], [blob(k) for k in of], list(of.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([rows[k] for k in use])), *(pa.array(c, k) for c, k in zip(found, kinds[1:], strict=True))], names)


def _first_meeting(a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether ``key`` is the first bucket, by table and then by number, that the rows of a and b share."""
    out, going = np.zeros(len(key), bool), np.arange(len(key))
    for table in range(TABLES):
        x, y = (s[going, table * PROBES : (table + 1) * PROBES] for s in (a, b))
        shared = np.where((x[:, :, None] == y[:, None, :]).any(axis=2), x, U(2**64 - 1)).min(axis=1)
        met = shared != U(2**64 - 1)
        out[going[met]] = shared[met] == key[going[met]]
        going = going[~met]
    return out


def _group_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that the links (a, b) lead to, of each of n rows."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _pairs(cell: np.ndarray, tile: np.ndarray, inner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows to compare. Rows are sorted by cell and tile; only in an ``inner`` cell do rows of one tile meet."""
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    stop = np.r_[start[1:], len(cell)]
    held, count = [], 0
    for s, e in zip(start, stop, strict=True):
        if e - s < 2:
            continue
        if inner[s]:
            a, b = np.triu_indices(e - s, 1)
        else:
            cut = int(np.searchsorted(tile[s:e], tile[s], side="right"))
            a, b = (x.ravel() for x in np.meshgrid(np.arange(cut), np.arange(cut, e - s), indexing="ij"))
        for k in range(0, len(a), AT_ONCE):
            held.append((a[k : k + AT_ONCE] + s, b[k : k + AT_ONCE] + s))
            count += len(held[-1][0])
            if count >= AT_ONCE:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, count = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _compare(least: float):
    """Links within each cell of a partition that is sorted by cell."""

    def links(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cell = [rows[c].to_numpy() for c in ("key", "i", "j")]
        code = np.r_[0, np.cumsum(np.logical_or.reduce([x[1:] != x[:-1] for x in cell]))]
        tile, inner = rows["tile"].to_numpy(), cell[1] == cell[2]
        order = np.lexsort((tile, code))
        rows, code, tile, inner = rows.take(pa.array(order)), code[order], tile[order], inner[order]
        key, weight = rows["key"].to_numpy().view(U), rows["weight"].to_numpy()
        own = np.frombuffer(b"".join(rows["own_keys"].to_pylist()), U).reshape(len(rows), -1)
        data = rows["vector"].to_pylist()
        width = np.array([len(x) for x in data])
        found_a, found_b = [], []
        for a, b in _pairs(code, tile, inner):
            same = width[a] == width[b]  # unlike only if hashes collide
            for w in np.unique(width[a[same]]):
                use = same & (width[a] == w)
                x, y = a[use], b[use]
                rows_used, back = np.unique(np.r_[x, y], return_inverse=True)
                v = np.frombuffer(b"".join([data[k] for k in rows_used]), np.float64).reshape(len(rows_used), -1)
                norm = np.sqrt(np.einsum("ij,ij->i", v, v))
                x_, y_ = back[: len(x)], back[len(x) :]
                near = np.einsum("ij,ij->i", v[x_], v[y_]) / (norm[x_] * norm[y_]) >= least
                x, y = x[near], y[near]
                first = _first_meeting(own[x], own[y], key[x])
                found_a.append(x[first])
                found_b.append(y[first])
        if found_a and len(a := np.concatenate(found_a)):
            b = np.concatenate(found_b)
            links = np.bincount(a, weight[b], len(rows)) + np.bincount(b, weight[a], len(rows))
            linked = np.flatnonzero(links)
            node = rows["node"].combine_chunks()
            roots = _group_roots(len(rows), a, b)[linked]
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(linked)), node.take(pa.array(roots)), pa.array(links[linked].astype(np.int64))],
                ["node", "root", "links"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < 4 * TILE:
                continue
            rows = pa.Table.from_batches(held)
            cell = [rows[c].to_numpy() for c in ("key", "i", "j")]
            last = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in cell]))
            if len(last):  # the last cell may go on in the next batch
                yield from links(rows.slice(0, last[-1] + 1))
                held = rows.slice(last[-1] + 1).to_batches()
        if held:
            yield from links(pa.Table.from_batches(held))

    return work


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """id_col, n_links, component_id and kept of each row.

    Rows with equal labels are linked if their cosine is at least ``least``; a null label, a null, empty or zero vector and
    one with a null or non-finite component link with nothing. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id that links lead to, and ``kept`` tells that it is the row's own. Rows that repeat
    count one by one; a row with a null id links with nothing and is kept, its component null. Vectors of different length
    never link. An empty table gives an empty one; other columns are left out.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    kind = rows.schema["id"].dataType.simpleString()
    scanned = written(rows.mapInArrow(_scan, f"id {kind}, digest binary, vector binary, own_keys binary, keys array<long>"), "vectors")
    used = scanned.where("digest is not null")
    classes = used.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("weight"))
    first = used.join(classes.select(F.col("digest").alias("d"), "node", "weight"),
                         (F.col("digest") == F.col("d")) & (F.col("id") == F.col("node")))
    nodes = written(first.select("node", "weight", "vector", "own_keys", "keys").dropDuplicates(["node", "own_keys", "vector"]), "nodes")

    members = nodes.select("node", "weight", "vector", "own_keys", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = sizes.select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    met = members.join(tiles, "key").withColumn("tile", F.pmod(F.xxhash64("node", "vector"), F.col("tiles")).cast("int"))
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cells = spread.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node",
                          "weight", "vector", "own_keys")
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = written(dealt.mapInArrow(_compare(least), f"node {kind}, root {kind}, links long"), "links")

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root")
    of_class = classes.join(counts, "node", "left").join(roots, "node", "left").select(
        F.col("digest"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    linked = used.select("id", "digest").join(of_class, "digest").select("id", "links", "root")
    alone = scanned.where("digest is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("root"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("root").alias("component_id"),
        F.coalesce(F.col("root") == F.col("id"), F.lit(True)).alias("kept"))

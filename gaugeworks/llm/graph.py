"""Connected groups of a graph whose links are rows, and candidate pairs from shared keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.membership import maybe_among
from gaugeworks.session import written


def _least(links: DataFrame) -> DataFrame:
    """(u, v) of every link in both directions, with the least node m among u and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link; root is the least node that links lead to.

    Alternates the large-star and the small-star step until no link changes: each round hangs every node's neighbours
    from the least of them, so long chains shrink by a constant factor. Every round is written to the shared folder.
    """
    now = written(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(now)
    for _ in range(most_rounds):
        large = _least(now).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Now u > v holds, and a node's neighbours are all less than it: the small step needs that direction only.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        now = written(small, "links")
        if (after := _state(now)) == state:
            break
        state = after
    else:
        raise RuntimeError("groups did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def hub_pairs(members: DataFrame, close: Callable[[Column, Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(shared, pairs) of ``members`` (key, node, and ``mark`` if ``close`` is given), each key and node once.

    ``pairs`` (a, b) links the nodes of a key to the least of them, so their number grows with the members, not with
    their square. ``close`` must hold for the marks of a pair. ``shared`` is the members of keys that more than two nodes
    hold, those with pairs yet to be considered.
    """
    counts = members.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("held")).where("held > 1")
    hubs = written(counts, "hubs")
    likely = maybe_among(members, hubs.select("key"), "key").where("maybe").drop("maybe")
    shared = written(likely.join(hubs, "key"), "shared-keys")
    met = shared.where("node <> hub")
    if close is not None:
        marks = shared.where("node = hub").select("key", F.col("mark").alias("hub_mark"))
        met = met.join(marks, "key").where(close(F.col("mark"), F.col("hub_mark")))
    more = shared.where("held > 2").select(members.columns)
    return more, met.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def cross_pairs(shared: DataFrame, groups: DataFrame, close: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Pairs (a, b) that share a key but are not yet in one group; all others could not change any group.

    ``groups`` is (node, root); ``shared`` and ``close`` are those of :func:`hub_pairs`.
    """
    rooted = shared.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_ = written(rooted.join(mixed.select("key"), "key"), "open-keys")
    x, y = open_.alias("x"), open_.alias("y")
    condition = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    pairs = x.join(y, condition if close is None else condition & close(F.col("x.mark"), F.col("y.mark")))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()

"""Benchmark decontamination by winnowing, in DataFrame functions only.

The hash of every run of ``GRAM`` words is a gram; of each ``WINDOW`` consecutive grams the least is kept as a fingerprint. Two
texts that share ``GRAM + WINDOW - 1`` = 10 words in a row share the grams of that span and so its least one: no shared
span of that length is missed. Documents that share a fingerprint with an item are candidates. Their hits are then
extended exactly: each window of an item's words is looked up among the document's windows, word by word.

An item of fewer words than a window is one window; for it, all runs of its length count as fingerprints.

Arrays are exploded as outer arrays: for others the optimizer tests the size of the array first, which computes it once
more and, pushed below the steps before it, many times over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import written

GRAM, WINDOW = 5, 6
#: Words of a shared span that is always found.
SPAN = GRAM + WINDOW - 1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words in lower case (A-Z): runs of ASCII letters and digits and of all characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def _indices(count: Column) -> Column:
    """0 .. count - 1; no element if count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _runs(hashes: Column, n: int) -> Column:
    """Hash of each run of ``n`` words."""
    return F.transform(_indices(F.size(hashes) - n + 1), lambda i: F.xxhash64(F.lit(n), *(F.get(hashes, i + k) for k in range(n))))


def _fingerprints(grams: Column) -> Column:
    """The least gram of each window of grams, each value once."""
    least = F.transform(_indices(F.size(grams) - WINDOW + 1), lambda i: F.least(*(F.get(grams, i + k) for k in range(WINDOW))))
    return F.array_distinct(least)


def _with_fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """``df`` (with ``words``) and its ``prints``: winnowed grams, and all runs of the lengths ``short``."""
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("grams", _runs(F.col("hashes"), GRAM))
    prints = [_fingerprints(F.col("grams")), *(F.array_distinct(_runs(F.col("hashes"), n)) for n in short)]
    return grams.withColumn("prints", F.concat(*prints)).drop("hashes", "grams")


def _windows(lengths: list[int]) -> Column:
    """(at, n, words) of each run of one of ``lengths`` words, the words joined by a space, which none holds."""
    def of(n: int) -> Column:
        return F.transform(_indices(F.size("words") - n + 1), lambda i: F.struct(
            i.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice("words", i + 1, n), " ").alias("window")))

    return F.concat(*(of(n) for n in lengths))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_hit, n_items, items_sha256 and contaminated of each row.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the items with such a window; the digest is of
    their ids, sorted as text and joined by commas. A null or empty text has no words. Rows that share an id are judged one by one,
    a null id stays null. Items without words match nothing; one with a null id hits words but is not counted. Either
    table may be empty; other columns are left out.
    """
    item_words = items.select(F.col(item_col).alias("item"), words(F.col(item_text_col).cast("string")).alias("words")).where(F.size("words") > 0)
    lengths = item_words.select(F.size("words").alias("n")).where(F.col("n") < SPAN).distinct().collect()  # nine at most
    short = sorted(row.n for row in lengths)
    item_windows = written(item_words.select("item", F.explode_outer(F.when(F.size("words") < SPAN, F.array(
        F.struct(F.lit(0).alias("at"), F.size("words").alias("n"), F.array_join("words", " ").alias("window")))).otherwise(
            _windows([SPAN]))).alias("w")).select("item", "w.n", "w.window").distinct(), "item-windows")
    long_items = _with_fingerprints(item_words.where(F.size("words") >= SPAN), [])
    whole = [_with_fingerprints(item_words.where(F.size("words") == n), [n]) for n in short]
    item_prints = written(reduce(DataFrame.unionByName, [long_items, *whole]).select(
        F.explode_outer("prints").alias("print")).where("print is not null").distinct(), "item-prints")

    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    scanned = _with_fingerprints(texts.select("id", "hash", words(F.col("text")).alias("words")), short)
    prints = scanned.select("id", "hash", F.size("words").alias("n_words"), F.posexplode_outer("prints").alias("at", "print"))
    marked = prints.join(item_prints.withColumn("found", F.lit(1)), "print", "left")
    # One row for each text: it is summed up where it was scanned.
    found = written(marked.groupBy("id", "hash", "n_words").agg(
        F.sum((F.coalesce("at", F.lit(0)) == 0).cast("long")).alias("times"), F.max("found").alias("found")), "fingerprints")

    candidates = found.where("found = 1").select(F.col("id").alias("i"), F.col("hash").alias("h"))
    of = candidates.join(texts, F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash"))).select("id", "hash", words(F.col("text")).alias("words"))
    spots = of.select("id", "hash", F.explode_outer(_windows([SPAN, *short])).alias("w")).select("id", "hash", "w.at", "w.n", "w.window")
    hits = spots.join(item_windows, ["window", "n"]).groupBy("id", "hash").agg(
        F.collect_set(F.struct("at", "n")).alias("spans"), F.collect_set(F.col("item").cast("string")).alias("items"))
    hit_words = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))
    hits = hits.select(F.col("id").alias("i"), F.col("hash").alias("h"), F.size(F.array_distinct(hit_words)).alias("n_hit"), F.array_sort("items").alias("items"))

    out = found.join(hits, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")), "left")
    out = out.withColumn("items", F.coalesce("items", F.array().cast("array<string>"))).withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    return out.select(
        F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("_")).drop("_")

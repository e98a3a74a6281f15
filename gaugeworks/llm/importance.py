"""Importance resampling towards a target text: documents are drawn by how much their words resemble the target's.

A text is lower-cased (A-Z only), its separators collapse to single spaces, and an overlapped regex scan with lookarounds at the
words' boundaries emits each run of 1 to ``n`` words as one span of bytes, whose crc32 names its bucket. Buckets are counted over
all documents and over all target texts; a bucket's gain is the logarithm of its smoothed share in the target over that in the
documents. A document weighs the mean gain of its features. Adding Gumbel noise, which a hash of the document's id decides, and
taking the highest scores draws without replacement in proportion to exp(weight), and draws the same documents each time.

The documents are scanned twice, and no text is shuffled: the first scan hands on one row of sums for each bucket and task. What the
driver holds is bounded: a gain for each bucket, and one row for each score that occurs. Scores are whole numbers within about
100,000 of each other (see :func:`score_offsets`), so the number of better documents at each score gives ranks without sorting
all rows in one place, and within one score the noise leaves few documents to be put in order.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.batches import slices, text_bytes
from gaugeworks.session import ship_package, written

#: Bytes of a word: digits, letters and everything beyond ASCII; A-Z become a-z, all others a space.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def spans(n: int) -> list[regex.Pattern]:
    """One pattern for each length of run; each match is a whole run, and the next one begins with the next word."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (k - 1)) for k in range(1, n + 1)]


def collapsed(text: bytes) -> bytes:
    """Words of a text, lower-cased, with one space between them and none at the ends."""
    return b" ".join(text.translate(_WORD_BYTES).split())


class Scanner:
    """Buckets of the features of texts. Words met before keep their bucket at hand, ``KEPT`` of them at most."""

    KEPT, LONG = 1 << 18, 64

    def __init__(self, n: int, buckets: int):
        self.patterns, self.buckets, self.known = spans(n), buckets, {}

    def _bucket(self, feature: bytes) -> int:
        place = zlib.crc32(feature) % self.buckets
        if len(feature) <= self.LONG:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            self.known[feature] = place
        return place

    def __call__(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each feature."""
        line, known, out, words = collapsed(text), self.known, [], 0
        for k, pattern in enumerate(self.patterns):
            for match in pattern.finditer(line, overlapped=True):
                feature = match.group()
                place = known.get(feature)
                out.append(self._bucket(feature) if place is None else place)
            if k == 0:
                words = len(out)
        return words, np.array(out, np.int64)


def bucket_counts(texts: DataFrame, text_col: str, n: int, buckets: int) -> DataFrame:
    """(bucket, count) of the features of all texts; buckets without any are left out. A null text has none."""
    ship_package(texts.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, total = Scanner(n, buckets), np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for text in text_bytes(batch.column("text")):
                total += np.bincount(scan(text)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "count"])

    each = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, "bucket long, count long")
    return each.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, text_col: str = "text", target_col: str = "text") -> list[int]:
    """Gain of each bucket in thousandths, rounded down: the logarithm of its share in the target over its share in ``docs``.

    Every count is one higher than it is, so buckets that nothing fell into have a gain, too; two empty tables give zeros.
    """
    counts = []
    for df, column in ((docs, text_col), (target, target_col)):
        each = np.zeros(buckets, np.int64)
        for row in bucket_counts(df, column, n, buckets).collect():  # a row for each bucket at most
            each[row["bucket"]] = row["count"]
        counts.append(each.tolist())
    own, wanted = counts
    s, t = float(sum(own) + buckets), float(sum(wanted) + buckets)
    return [math.floor(1000 * math.log((y + 1) * s / ((x + 1) * t))) for x, y in zip(own, wanted, strict=True)]


def noise(seed: int | str, doc_id: object) -> int:
    """Gumbel noise in thousandths, rounded down, by the first 32 bits of sha256(``seed:doc_id``); a null id is empty."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: list[int], n: int = 1, seed: int | str = 2024, id_col: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of each row, then n_words, n_features, weight and score.

    A text without features, or null, weighs 0. A column of ``docs`` with one of the new names is left out. Repeated rows
    give repeated results.
    """
    ship_package(docs.sparkSession)
    added = ["n_words", "n_features", "weight", "score"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    of_gain = np.array(gain, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(n, len(of_gain))
        for batch in slices(batches, "scanned"):
            n_words, n_features, weight, score = [], [], [], []
            for name, text in zip(batch.column("named").to_pylist(), text_bytes(batch.column("scanned")), strict=True):
                words, places = scan(text)
                mean = int(of_gain[places].sum()) // len(places) if len(places) else 0
                n_words.append(words)
                n_features.append(len(places))
                weight.append(mean)
                score.append(mean + noise(seed, name))
            rest = [batch.column(f"c{i}") for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score))],
                                             [f"c{i}" for i in range(len(names))] + added)

    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    source = docs.select(*own, F.col(id_col).cast("string").alias("named"), F.col(text_col).cast("string").alias("scanned"))
    kinds = ", ".join([f"c{i} {source.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))] + [f"{c} long" for c in added])
    return source.mapInArrow(work, kinds).toDF(*names, *added)


def score_offsets(found: DataFrame) -> list[tuple[int, int, int]]:
    """(score, rows of higher scores, rows of this score), from the highest score down.

    Gains lie within 1000 * ln(2**63) = 43,669 of zero and noise between -3,124 and 22,875, so there are less than 113,400
    scores, whatever the number of rows.
    """
    before, out = 0, []
    for row in sorted(found.groupBy("score").count().collect(), key=lambda r: -r["score"]):
        out.append((row["score"], before, row["count"]))
        before += row["count"]
    return out


def ranked(found: DataFrame, eligible: Column, percent: int, id_col: str = "doc_id") -> DataFrame:
    """``found`` with ``rank``: 1, 2, 3 ... for that percentage of the eligible rows, rounded down, that scores highest.

    Ties go to smaller ids, null ids last, then to fewer features. Rows not drawn have a null rank. ``found`` has to be stored, as it is read
    several times.
    """
    able = F.coalesce(eligible, F.lit(False))
    offsets = score_offsets(found.where(able))
    most = sum(n for _, _, n in offsets) * percent // 100
    drawn = [(score, before) for score, before, _ in offsets if before < most]
    above = found.sparkSession.createDataFrame(drawn, "_score long, _before long")
    likely = found.where(able).join(F.broadcast(above), F.col("score") == F.col("_score"))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col(id_col).asc_nulls_last(), "n_features"))
    rank = (F.col("_before") + place).cast("long")
    got = likely.withColumn("rank", F.when(rank <= most, rank)).drop("_score", "_before")
    lowest = drawn[-1][0] if drawn else None
    rest = found.where(~able | (F.col("score") < lowest) if drawn else F.lit(True))
    return got.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, n: int = 1, buckets: int = 10_000,
             seed: int | str = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with the columns ``keep`` (all by default), n_words, n_features, weight, score and rank.

    ``percent`` of the documents of at least ``least_words`` words are drawn; only these have a rank, so the sample is
    ``where("rank is not null")``. A column of ``docs`` with one of the new names is left out. An empty table gives an empty one; an empty target draws by what is rare in ``docs``.
    """
    gain = gains(docs, target, n, buckets, text_col, target_col)
    keep = [c for c in (docs.columns if keep is None else keep) if c != "rank"]
    found = written(weighed(docs, gain, n, seed, id_col, text_col, keep), "importance")
    return ranked(found, F.col("n_words") >= least_words, percent, id_col)

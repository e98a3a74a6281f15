"""Languages of a text as a mixture, inferred by expectation-maximisation.

Training counts, for each language, character trigrams within words (hashed to ``BUCKETS``). Each word of a text is
taken to be drawn from one language, which gives it the likelihood of its trigrams; a text's language proportions are
those that make its words most likely, found by EM. Languages join the set one at a time. The first is the single
best; another can raise the likelihood only if its likelihood ratio to the present mixture averages above one over
the words, and it is kept only if the gain in log-likelihood exceeds the penalty of one more parameter, half the
logarithm of the number of words (BIC). If it is not, the next best is tried; a text's set is complete when none
passes, and may hold every language learned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count as count_up

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.batches import U, mix, slices
from gaugeworks.session import ship_package

BITS = 17
BUCKETS = 1 << BITS
UNDETERMINED = "und"
#: A word speaks against a language by a factor of e**FLOOR at most: every text holds names and foreign words.
FLOOR = -12.0
#: EM ends when no proportion of a text moves by this much.
TOLERANCE = 1e-3
#: Languages of one model; its table has BUCKETS numbers for each and goes to every worker.
MOST_LANGUAGES = 400


def words(text: str) -> list[str]:
    """Runs of letters (with their marks), in lower case."""
    import regex

    return regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())


def trigrams(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of each trigram; words are padded with a space on both sides."""
    points = np.frombuffer((" " + " ".join(distinct) + " ").encode("utf-32-le"), np.uint32).astype(U)
    inner = np.flatnonzero(points != 32)
    word = (np.cumsum(points == 32) - 1)[inner]
    key = points[inner - 1] | points[inner] << U(21) | points[inner + 1] << U(42)
    return word, (mix(key) >> U(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """log P(trigram bucket | language), one column for each language in alphabetical order."""

    languages: list[str]
    table: np.ndarray

    def likelihoods(self, distinct: list[str]) -> np.ndarray:
        """Log-likelihood of each word by language, less that of its best language."""
        out = np.zeros((len(distinct), len(self.languages)), np.float64)
        if distinct and self.languages:
            word, bucket = trigrams(distinct)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[first]] = np.add.reduceat(self.table[bucket], first, axis=0)
        return np.maximum(out - out.max(axis=1, keepdims=True, initial=-np.inf), FLOOR)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", smoothing: float = 0.5) -> Model:
    """Count the trigrams of every row whose language and text are not null.

    Counts are summed by Spark; what reaches the driver has at most ``BUCKETS`` rows for each language.
    """
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            by_language: dict[str, Counter] = {}
            for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_language.setdefault(language, Counter()).update(words(text))
            for language, seen in by_language.items():
                if seen:
                    word, bucket = trigrams(list(seen))
                    weight = np.fromiter(seen.values(), np.int64)[word]
                    total = counts.setdefault(language, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(bucket, weight, BUCKETS).astype(np.int64)
        for language, total in counts.items():
            bucket = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(bucket)), pa.array(bucket.astype(np.int32)), pa.array(total[bucket])],
                ["lang", "bucket", "n"])

    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = source.where("lang is not null and text is not null").mapInArrow(work, "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(pc.unique(found["lang"]).to_pylist())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; one model takes {MOST_LANGUAGES}")
    table = np.full((BUCKETS, len(languages)), smoothing)
    column = pc.index_in(found["lang"], pa.array(languages, found["lang"].type)).to_numpy()
    table[found["bucket"].to_numpy(), column] += found["n"].to_numpy()
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def mixtures(log_ratio: np.ndarray, count: np.ndarray, ptr: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Proportions of languages by text, zero for those outside the selected set.

    ``log_ratio`` has the words of all texts (rows) by language, those of text i at ``ptr[i]:ptr[i + 1]``, each with
    its ``count``. Every text has a word. A text's set grows until no language that is left passes the test.
    EM runs to its tolerance, or for ``rounds`` steps if given.
    """
    n, kinds = len(ptr) - 1, log_ratio.shape[1]
    ratio = np.exp(log_ratio)
    total = np.add.reduceat(count, ptr[:-1]).astype(np.float64)
    penalty = 0.5 * np.log(total + 1)
    alone = np.add.reduceat(log_ratio * count[:, None], ptr[:-1], axis=0)
    best = alone.argmax(axis=1)
    share = np.zeros((n, kinds))
    share[np.arange(n), best] = 1
    fit = alone[np.arange(n), best]
    failed = np.zeros((n, kinds), bool)  # tried with the present set
    going = np.arange(n)
    while len(going):
        # Words of the texts that may still take another language.
        length = np.diff(ptr)[going]
        start = np.r_[0, np.cumsum(length)]
        rows = np.repeat(ptr[going] - start[:-1], length) + np.arange(start[-1])
        text, q, c = np.repeat(np.arange(len(going)), length), ratio[rows], count[rows].astype(np.float64)
        mixture = (share[going][text] * q).sum(axis=1)
        slope = np.add.reduceat(q * (c / mixture)[:, None], start[:-1], axis=0) / total[going, None] - 1
        held = share[going] > 0
        inside = np.where(held, slope, -1).max(axis=1)
        slope[held | failed[going]] = -1
        new = slope.argmax(axis=1)
        steepest = slope[np.arange(len(going)), new]
        # The log-likelihood is concave: no mixture of the set and the new one gains more than the greatest slope times the words.
        can = (steepest > 1e-9) & (total[going] * np.maximum(steepest, inside) > penalty[going] - 1e-6)
        if not can.any():
            break
        keep = can[text]
        text, q, c = (np.cumsum(can) - 1)[text[keep]], q[keep], c[keep]
        going, new, length = going[can], new[can], length[can]
        p = share[going] * 0.9
        p[np.arange(len(going)), new] = 0.1
        _settle(p, q, c, length, total[going], rounds)
        after = np.add.reduceat(c * np.log((p[text] * q).sum(axis=1)), np.r_[0, np.cumsum(length)][:-1])
        won = after - fit[going] > penalty[going]
        failed[going[~won], new[~won]] = True
        failed[going[won]] = False
        share[going[won]], fit[going[won]] = p[won], after[won]
    return share


def _settle(p: np.ndarray, q: np.ndarray, c: np.ndarray, length: np.ndarray, total: np.ndarray, rounds: int | None) -> None:
    """EM steps on the proportions ``p`` of each text, in place, until its own step is below ``TOLERANCE``.

    ``q`` and ``c`` are the ratios and counts of the texts' words, ``length`` of them for each. Every step gains likelihood
    by its divergence at least, and ``FLOOR`` bounds that, so large steps come to an end.
    """
    open_ = np.arange(len(p))
    for _ in count_up() if rounds is None else range(rounds):
        if not len(open_):
            break
        text, start = np.repeat(np.arange(len(open_)), length), np.r_[0, np.cumsum(length)][:-1]
        r = p[open_][text] * q
        r *= (c / r.sum(axis=1))[:, None]
        step = np.add.reduceat(r, start, axis=0) / total[:, None]
        still = np.abs(step - p[open_]).max(axis=1) >= TOLERANCE
        p[open_] = step
        if not still.all():
            words = still[text]
            open_, q, c, length, total = open_[still], q[words], c[words], length[still], total[still]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score and languages (name and proportion of the selected set, largest first) of each row.

    ``lang_pred`` is the language with the largest proportion and ``score`` that proportion. A null text and one
    without a letter, or any text if nothing was learned, is ``und`` with score 0. Works row by row: repeated rows give
    repeated results, a null id stays null, an empty table gives an empty one, other columns are left out.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    schema = f"id {source.schema['id'].dataType.simpleString()}, {found}"
    return source.mapInArrow(_guesser(docs.sparkSession, model, ["id"]), schema).withColumnRenamed("id", id_col)


def annotate(docs: DataFrame, model: Model, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_col`` set to the predicted language."""
    names = docs.columns
    source = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)] + [F.col(text_col).cast("string").alias("text")])
    kinds = [f"c{i} {source.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))]
    found = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    work = _guesser(docs.sparkSession, model, [f"c{i}" for i in range(len(names))])
    guessed = source.mapInArrow(work, ", ".join([*kinds, found]))
    return guessed.select([F.col("lang_pred" if c == lang_col else f"c{i}").alias(c) for i, c in enumerate(names)])


def _guesser(spark: SparkSession, model: Model, kept: list[str]):
    """Function for mapInArrow: the columns ``kept`` and what the model says of ``text``."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast((model.languages, model.table))  # BUCKETS x languages, bounded

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = Model(*shared.value)
        known: dict[str, int] = {}
        table = np.zeros((0, len(use.languages)))
        for batch in slices(batches, most=2 << 20):
            rows = [Counter(words(x or "")) for x in batch.column("text").to_pylist()]
            if len(known) > 1 << 16:
                known, table = {}, table[:0]
            fresh = list({w for row in rows for w in row if w not in known})
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
            table = np.vstack([table, use.likelihoods(fresh)])
            full = [i for i, row in enumerate(rows) if row and use.languages]
            guesses: list[tuple] = [(UNDETERMINED, 0.0, [])] * len(rows)
            if full:
                index = np.array([known[w] for i in full for w in rows[i]], np.int64)
                count = np.array([n for i in full for n in rows[i].values()], np.int64)
                shares = mixtures(table[index], count, np.r_[0, np.cumsum([len(rows[i]) for i in full])])
                for i, share in zip(full, shares, strict=True):
                    order = [k for k in np.argsort(-share, kind="stable") if share[k] > 0]
                    set_ = [{"lang": use.languages[k], "share": min(1.0, float(share[k]))} for k in order]
                    guesses[i] = (set_[0]["lang"], set_[0]["share"], set_)
            kinds = (pa.string(), pa.float64(), pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))
            columns = [pa.array(x, kind) for x, kind in zip(zip(*guesses, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *columns], [*kept, "lang_pred", "score", "languages"])

    return work

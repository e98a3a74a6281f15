"""Importance resampling against plain Python, and its SQL twin."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import importance
from gaugeworks.llm.catalogue import QUERIES, SQL
from tests.llm.brute import LOWER
from tools.check import connect, rows

FIND = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def features(text, n):
    w = FIND((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, percent, least_words, n, buckets, seed):
    """Sorted (doc_id, n_words, n_features, weight, score, rank)."""
    own = [(i, *features(t, n)) for i, t in docs]
    s = Counter(h % buckets for _, _, f in own for h in f)
    t = Counter(h % buckets for x in target for h in features(x, n)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    out = []
    for i, words, f in own:
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x % buckets] for x in f) // len(f) if f else 0
        out.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in out if x[1] >= least_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2]))
    drawn = able[: percent * len(able) // 100]
    ranks, left = [], Counter(out)
    for k, x in enumerate(drawn):
        ranks.append((*x, k + 1))
        left[x] -= 1
    return sorted(ranks + [(*x, None) for x in left.elements()], key=repr)


def found(docs, target, percent, least_words, n, buckets, seed):
    got = importance.resample(docs, target, percent, least_words, n, buckets, seed, keep=["doc_id"])
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("percent, least_words, n, buckets", [(10, 20, 1, 10_000), (50, 1, 2, 97), (100, 0, 3, 1), (0, 5, 1, 10)])
def test_resampling_by_hand(spark, make, hand_rows, percent, least_words, n, buckets):
    docs_rows = [*hand_rows, *hand_rows[:3], (None, hand_rows[0][1]), (None, None), (7, "a  b\x00b--B c d"), (7, "again the same id")]
    target = spark.createDataFrame([("the quick brown fox",), (None,), ("",), ("seven seven geese",)], "text string")
    want = brute(docs_rows, [r.text for r in target.collect()], percent, least_words, n, buckets, "s")
    assert found(make(docs_rows), target, percent, least_words, n, buckets, "s") == want


def test_resampling_keeps_whole_rows_and_clashing_columns(spark, hand_docs):
    clash = hand_docs.withColumns({"score": F.lit("mine"), "rank": F.lit(1), "named": F.lit(2), "scanned": F.lit(b"x"), "c1": F.lit("y")})
    added = ["n_words", "n_features", "weight", "score", "rank"]
    target = spark.createDataFrame([("the river bank",)], "text string")
    got = importance.resample(clash, target, percent=50, least_words=3)
    assert got.columns == [c for c in clash.columns if c not in added] + added
    drawn = got.where("rank is not null").orderBy("rank").collect()
    able = got.where("n_words >= 3").count()
    assert [r["rank"] for r in drawn] == list(range(1, able // 2 + 1)) and {r["c1"] for r in drawn} == {"y"}
    assert [r.score for r in drawn] == sorted((r.score for r in drawn), reverse=True)


def test_resampling_of_empty_tables(spark, empty_docs, hand_docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(empty_docs, none).count() == 0
    assert importance.gains(empty_docs, none, buckets=3) == [0, 0, 0]
    assert importance.resample(hand_docs, none, percent=100, least_words=0).where("rank is null").count() == 0


def test_scan_emits_overlapping_runs(monkeypatch):
    words = [random.Random(3).choice(["a", "bb", "é", "漢字", "x" * 100, "9"]) for _ in range(500)]
    text = ". ".join(words).encode()
    line = importance.collapsed(text)
    for k, pattern in enumerate(importance.spans(4), 1):
        got = [m.group().decode() for m in pattern.finditer(line, overlapped=True)]
        assert got == [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    monkeypatch.setattr(importance.Scanner, "KEPT", 3)
    n, places = importance.Scanner(4, 50)(text)
    assert n == 500 and places.tolist() == [h % 50 for h in features(text.decode(), 4)[1]]


def test_a_very_long_text_takes_linear_time():
    n, places = importance.Scanner(1, 10_000)(b"x" * 2_000_000 + b" y" * 200_000)
    assert (n, len(places)) == (200_001, 200_001)


def test_resampling_query(spark, sf):
    df = QUERIES["op11_importance_resampling"](spark, sf)
    cursor = connect(sf).execute(SQL["op11_importance_resampling"])
    names = [c[0] for c in cursor.description]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())
    assert all(t == "bigint" for _, t in df.dtypes)

"""Repeated passages, found with suffix automata of reference shards.

A window is ``n`` consecutive words of one document. A word is removed if it lies in a window whose word sequence also
starts in a document with a smaller id. Windows are judged on the input.

No machine can hold a suffix automaton of the whole corpus, and streaming every document past every shard of it would cost
the square of the input. So texts are routed to the shards that can matter to them:

1. Each window has an anchor, the least hash of its ``K``-word runs. Equal windows have equal anchors. One scan writes
   each document's distinct anchors (about one for every twenty words). Exact copies of a document are settled here:
   every window of theirs starts in the first copy.
2. An anchor that two documents hold sends its windows to the shard of the first document that holds it, or to one of its
   own if more than ``JOINT`` do. A first document whose anchors are held more than ``WORK`` times in all has several shards,
   dealt by anchor, so that no automaton grows with the length of a text. Runs of consecutive windows with the same shard
   travel as one segment.
3. A shard goes through its documents by ascending id. It streams each segment through its automaton for matching
   statistics, the length of the longest match that ends at each word; lengths of ``n`` or more are repeated windows. Then
   it adds the windows that it did not hold. So an automaton holds each distinct window about once.
4. Anchors of more than ``HOT`` documents would make a shard as large as their number of documents. Their windows take
   another way, which is exact as well: the least document id of each window's 64-bit hash, found before the shuffle as far as it
   can be. Runs of windows are cut into pieces by content, and equal pieces are settled as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.batches import U, Words, runs_of, slices, text_bytes, words_of
from gaugeworks.session import ship_package, written

#: Words of the runs whose least hash anchors a window.
K = 10
#: Documents up to which an anchor shares the shard of its first document, and from which on its windows are compared by
#: hash. In between it has a shard of its own, of at most ``HOT`` segments of fewer than twice the window's words.
JOINT, HOT = 200, 3000
#: Anchors times documents that a shard of a first document is meant to hold; each brings fewer than twice the window's words.
WORK = 2000
#: Repeated windows of one hot anchor that a run is compared with at once.
CHUNK = 256


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self):
        self.arcs: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, arcs: dict, link: int) -> int:
        self.arcs.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word) -> int:
        """A copy of state q for the shorter strings that reach it from p."""
        arcs, link = self.arcs, self.link
        copy = self._state(self.length[p] + 1, dict(arcs[q]), link[q])
        link[q] = copy
        while p >= 0 and arcs[p].get(word) == q:
            arcs[p][word] = copy
            p = link[p]
        return copy

    def add(self, words: list) -> None:
        arcs, link, length = self.arcs, self.link, self.length
        last = 0
        for word in words:
            q = arcs[last].get(word)
            if q is not None:  # known as a substring already
                last = q if length[q] == length[last] + 1 else self._split(last, q, word)
                continue
            p, new = last, self._state(length[last] + 1, {}, 0)
            while p >= 0 and word not in arcs[p]:
                arcs[p][word] = new
                p = link[p]
            if p >= 0:
                q = arcs[p][word]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
            last = new

    def matches(self, words: list, n: int) -> list[int]:
        """Starts of the windows of ``n`` words that are a substring: where the matching statistic reaches ``n``."""
        arcs, link, length = self.arcs, self.link, self.length
        state = size = 0
        out = []
        for i, word in enumerate(words):
            to = arcs[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = arcs[state].get(word)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= n:
                out.append(i - n + 1)
        return out


def spans(starts: list[int], n: int) -> list[tuple[int, int]]:
    """Windows that touch or overlap, joined: (start, end) in words."""
    out: list[list[int]] = []
    for start in starts:
        if out and start <= out[-1][1]:
            out[-1][1] = start + n
        else:
            out.append([start, start + n])
    return [tuple(x) for x in out]


def window_anchors(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, window hash, anchor) of every window."""
    start, window = runs_of(words, n)
    at, run = runs_of(words, min(K, n))
    least = np.full(len(words.hashes), np.iinfo(np.uint64).max, U)
    least[at] = run
    need, have = n - min(K, n) + 1, 1
    while have < need:  # least[i] is over the runs from i to i + have - 1
        step = min(have, need - have)
        least[: len(least) - step] = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return start, window, least[start]


def hot_spans(found: DataFrame, n: int) -> DataFrame:
    """Repeated windows among pieces (anchor, piece, id, digest, start, windows): id, digest and spans of each that has any.

    A whole piece is repeated in the documents after its first one. In that document its windows are looked up among the
    repeated windows of the anchor, in chunks of bounded size; nothing is joined window by window.
    """
    groups = found.groupBy("piece").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    again = found.join(groups.where("first < last"), "piece").where("first < id").select("id", "digest", F.array(F.struct(
        "start", (F.col("start") + F.size("windows") + n - 1).alias("stop"))).alias("spans"))
    runs = found.join(groups.select("piece", F.col("first").alias("id")), ["piece", "id"])
    each = runs.select("anchor", "id", F.explode_outer("windows").alias("window"))
    firsts = each.groupBy("anchor", "window").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    firsts = written(firsts.select("anchor", "window", "first"), "hot-windows")
    chunks = firsts.groupBy("anchor").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    known = firsts.join(chunks, "anchor").groupBy("anchor", F.pmod("window", F.col("chunks")).alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct("window", "first"))).alias("firsts"))
    asked = runs.join(chunks, "anchor").select("anchor", "id", "digest", "start", "windows", F.explode_outer(
        F.array_distinct(F.transform("windows", lambda w: F.pmod(w, F.col("chunks"))))).alias("chunk"))
    at = F.transform("windows", lambda w, i: F.when(F.element_at("firsts", w) < F.col("id"), F.col("start") + i))
    some = asked.join(known, ["anchor", "chunk"]).select("id", "digest", F.filter(at, lambda x: x.isNotNull()).alias("at"))
    return again.unionByName(some.where(F.size("at") > 0).select("id", "digest", F.transform(
        "at", lambda x: F.struct(x.alias("start"), (x + n).alias("stop"))).alias("spans")))


def pieces(windows: np.ndarray) -> list[tuple[int, int]]:
    """A run of windows cut before each one whose hash is a multiple of four: equal passages are cut alike."""
    cut = np.unique(np.r_[0, np.flatnonzero((windows & U(3)) == 0), len(windows)])
    return list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))


def _digest(data: bytes) -> tuple[str, int]:
    """(sha256 in hex, its first 8 bytes as a number: tells rows of one id apart)."""
    raw = sha256(data)
    return raw.hexdigest(), int.from_bytes(raw.digest()[:8], "little", signed=True)


def _scan(n: int):
    """Words, digest and distinct anchors of each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = text_bytes(batch.column("text"))
            words = words_of(batch.column("text"))
            start, _, anchor = window_anchors(words, n)
            cut = np.searchsorted(start, words.ptr)
            of = [np.unique(anchor[a:b]).view(np.int64) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            digests = [_digest(b" ".join(x.split())) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(words.ptr)), pa.array([x for x, _ in digests]),
                 pa.array([x for _, x in digests], pa.int64()), pa.array(of, pa.list_(pa.int64()))],
                ["id", "n_words", "sha", "digest", "anchors"])

    return work


_SEGMENT = "shard long, id {id}, digest long, start int, words binary, anchor long, piece long, windows array<long>"


def _cut(n: int):
    """Segments for the shards, and pieces of runs of windows of one hot anchor by their hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            words = words_of(batch.column("text"))
            start, window, anchor = window_anchors(words, n)
            cut = np.searchsorted(start, words.ptr)
            rows = zip(batch.column("id").to_pylist(), batch.column("digest").to_pylist(), batch.column("shared").to_pylist(),
                       text_bytes(batch.column("text")), strict=True)
            for i, (id_, digest, shared, text) in enumerate(rows):
                split = text.split()
                if _digest(b" ".join(split))[1] != digest:  # another row with this id
                    continue
                to = {x["anchor"]: x["shard"] for x in shared}
                a, b = cut[i], cut[i + 1]
                own, back = np.unique(anchor[a:b].view(np.int64), return_inverse=True)
                # -1: not shared, 0: hot, k: shard k of those of this document
                shards = sorted({x for x in to.values() if x is not None})
                number = {x: k for k, x in enumerate(shards, 1)} | {None: 0}
                kind = np.array([number[to[x]] if x in to else -1 for x in own.tolist()])[back]
                edge = np.flatnonzero((np.diff(kind) != 0) | ((kind[1:] == 0) & (np.diff(back) != 0))) + 1
                for p, q in zip(np.r_[0, edge].tolist(), np.r_[edge, len(kind)].tolist(), strict=True):
                    if p < q and kind[p] > 0:
                        out.append((shards[kind[p] - 1], id_, digest, p, b" ".join(split[p : q + n - 1]), None, None, None))
                    elif p < q and kind[p] == 0:
                        for x, y in pieces(window[a + p : a + q]):
                            part = window[a + p + x : a + p + y]
                            name = int.from_bytes(blake2b(part.tobytes(), digest_size=8).digest(), "little", signed=True)
                            out.append((None, id_, digest, p + x, None, int(own[back[p]]), name, part.view(np.int64)))
            if out:
                kinds = (pa.int64(), batch.schema.field("id").type, pa.int64(), pa.int32(), pa.binary(),
                         pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["shard", "id", "digest", "start", "words", "anchor", "piece", "windows"])

    return work


def _shard(n: int):
    """Repeated spans among the segments of one shard."""

    def work(segments: pa.Table) -> pa.Table:
        automaton, out = SuffixAutomaton(), []
        # Texts stay in Arrow until their turn comes.
        rows = sorted(zip(*(segments[c].to_pylist() for c in ("id", "digest", "start")), range(len(segments)), strict=True))
        texts = segments["words"]
        for _, own in groupby(rows, itemgetter(0)):
            fresh = []
            for id_, digest, start, i in own:
                words = texts[i].as_py().split()
                hits = automaton.matches(words, n)
                out += [(id_, digest, start + a, start + b) for a, b in spans(hits, n)]
                missing = np.ones(len(words) - n + 1, bool)
                missing[hits] = False
                fresh += [words[a:b] for a, b in spans(np.flatnonzero(missing).tolist(), n)]
            for words in fresh:
                automaton.add(words)
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = (segments.schema.field("id").type, pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["id", "digest", "start", "stop"])

    return work


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in slices(batches):
        out = []
        columns = (batch.column("id").to_pylist(), batch.column("digest").to_pylist(), batch.column("spans").to_pylist())
        for text, id_, digest, found in zip(text_bytes(batch.column("text")), *columns, strict=True):
            words = text.split()
            if _digest(b" ".join(words))[1] != digest:  # another row with this id
                continue
            keep = np.ones(len(words), bool)
            for span in found:
                keep[span["start"] : span["stop"]] = False
            left = b" ".join([words[i] for i in np.flatnonzero(keep)]).decode()
            out.append((id_, digest, int((~keep).sum()), left))
        if out:
            kinds = (batch.schema.field("id").type, pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["id", "digest", "n_removed", "kept"])


def deduplicate(docs: DataFrame, n: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(summary, changed): all documents with their figures, and the texts of those that lost words but not all of them.

    ``summary`` has id_col, n_words, n_removed and kept_sha256 of each row; ``changed`` has id_col, digest, n_removed and
    kept (the kept words joined by one space). A null text has no words. Rows that share an id are judged one by one
    and are no copies of each other; a row with a null id neither removes nor loses anything. An empty table gives empty ones.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    base = written(texts.mapInArrow(_scan(n), f"id {kind}, n_words long, sha string, digest long, anchors array<long>"), "anchors")

    known = base.where(F.col("id").isNotNull() & (F.col("n_words") >= n))
    copies = known.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    base = base.join(copies.select("sha", "first"), "sha", "left")
    is_copy = F.coalesce(F.col("first") < F.col("id"), F.lit(False))

    anchors = base.where(~is_copy & F.col("id").isNotNull()).select("id", "digest", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("first_of"), F.max("id").alias("last"), F.count("*").alias("n"))
    load = F.sum(F.when(F.col("n") <= JOINT, F.col("n"))).over(Window.partitionBy("first_of"))
    part = F.pmod("anchor", F.ceil(F.coalesce(load, F.lit(1)) / WORK))
    own, joint = F.xxhash64(F.lit("anchor"), "anchor"), F.xxhash64(F.lit("document"), "first_of", part)
    shard = F.when(F.col("n") <= HOT, F.when(F.col("n") <= JOINT, joint).otherwise(own))
    shared = shared.where("first_of < last").select("anchor", shard.alias("shard"))
    routes = anchors.join(shared, "anchor").groupBy("id", "digest").agg(F.collect_list(F.struct("anchor", "shard")).alias("shared"))
    segments = written(texts.join(routes, "id").mapInArrow(_cut(n), _SEGMENT.format(id=kind)), "segments")

    span = f"id {kind}, digest long, start int, stop int"
    streamed = segments.where("anchor is null").groupBy("shard").applyInArrow(_shard(n), span)
    streamed = streamed.select("id", "digest", F.array(F.struct("start", "stop")).alias("spans"))
    hashed = hot_spans(segments.where("anchor is not null").select("anchor", "piece", "id", "digest", "start", "windows"), n)
    found = streamed.unionByName(hashed).groupBy("id", "digest").agg(F.flatten(F.collect_set("spans")).alias("spans"))

    matched = texts.join(found, "id")
    changed = written(matched.mapInArrow(_keep, f"id {kind}, digest long, n_removed long, kept string"), "kept")
    figures = changed.select("id", "digest", "n_removed", F.sha2("kept", 256).alias("kept_sha")).dropDuplicates(["id", "digest"])
    out = base.select("id", "digest", "n_words", "sha", is_copy.alias("copy")).join(figures, ["id", "digest"], "left")
    summary = out.select(
        F.col("id").alias(id_col), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))
    return summary, changed.withColumnRenamed("id", id_col)

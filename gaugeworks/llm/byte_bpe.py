"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are split before they reach the library, at places where no match of the split pattern can
reach across: between a printable ASCII character and a space or line feed. No match holds a non-space
followed by white space, and none looks back, so the matches of the parts are those of the whole.

A match without such a place, say a million letters in a row, would cost the library time that grows with
the square of its length; beyond ``LONG_MATCH`` bytes the same merges are found with a heap.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import slices
from gaugeworks.session import ship_package

#: Characters that go to the library at once.
PART = 1 << 16
#: Bytes of one match from which on a heap finds the merges.
LONG_MATCH = 2000

_SAFE = re.compile(r"(?<=[!-~])(?=[ \n])")


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` cut at safe places, in parts of ``size`` characters or, where there is no such place, longer."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: always the lowest-ranked neighbouring pair first, the leftmost among equals."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the symbol that starts here; 0 once it is merged away
    before, heap = list(range(-1, n - 1)), []

    def offer(a: int) -> None:
        if 0 <= a and end[a] < n and (rank := ranks.get(piece[a : end[end[a]]])) is not None:
            heapq.heappush(heap, (rank, a, end[a], end[end[a]]))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, middle, stop = heapq.heappop(heap)
        if end[a] != middle or end[middle] != stop:
            continue
        end[a], end[middle] = stop, 0
        if stop < n:
            before[stop] = a
        offer(a)
        offer(before[a])
    out, a = [], 0
    while a < n:
        out.append(ranks[piece[a : end[a]]])
        a = end[a]
    return out


class Coder:
    """Encoder and decoder over a rank file; special tokens do not exist for it."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.solid = re.compile(rf"[^ \n]{{{LONG_MATCH // 4},}}|\s{{{LONG_MATCH // 4},}}")

    def _part(self, text: str) -> list[int]:
        if not self.solid.search(text):
            return self.library.encode_ordinary(text)
        out: list[int] = []
        for match in self.pattern.findall(text):
            piece = match.encode()
            out += merge_long(piece, self.ranks) if len(piece) > LONG_MATCH else self.library.encode_ordinary(match)
        return out

    def encode(self, text: str) -> list[int]:
        if len(text) <= PART:
            return self._part(text)
        return [i for part in parts(text) for i in self._part(part)]

    def decode(self, ids: list[int]) -> bytes:
        return self.library.decode_bytes(ids)


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of each row; a null or empty text has no ids. Other columns are left out.

    Works row by row: repeated rows give repeated results, a null id stays null, an empty table gives an empty one.
    """
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        for batch in slices(batches):
            ids = pa.array([use.encode(x or "") for x in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(work, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``data`` (binary): the bytes that the ids stand for. Null ids are no ids."""
    ship_package(encoded.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        for batch in batches:
            data = [use.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["id", "data"])

    source = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(work, f"id {kind}, data binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding again: id_col, n_tokens, ids_sha256, decoded_sha256.

    One pass, so that ids never leave the worker: equal to digests of :func:`encode` and :func:`decode`.
    """
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        names = list(map(str, range(max(use.ranks.values(), default=0) + 1)))
        for batch in slices(batches):
            counts, of_ids, of_text = [], [], []
            for text in batch.column("text").to_pylist():
                ids = use.encode(text or "")
                counts.append(len(ids))
                of_ids.append(sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                of_text.append(sha256(use.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(work, schema).withColumnRenamed("id", id_col)

"""Alignment of two tokenizers' tokens by byte offsets, with corpus-wide counts of the pairs of ids that end together.

Tokens of a text by A and by B cover the same bytes. Offsets at which tokens of both end cut them into groups, and the two tokens
that end at such an offset are linked. A pair's count is the number of links in the corpus that join its two ids; a link is a
best one if no pair with its B id has a higher count.

**Tokenizing.** A space between two ASCII characters or letters begins a token of both tokenizers, so a text is the row of its parts
between such spaces, each encoded on its own; a worker keeps parts that it has met. Parts end where groups end.

**Counting** is an external sort. A task works through blocks of documents. A block's records (pair, document, links) are sorted by
the side of B first, cut by radix of the B id, and each cut is one zstd run: its pairs with their numbers, and apart from
them the documents. Runs of one radix are dealt over as many tasks as their bytes ask for, so that a hot id is never in one
task; a k-way merge over a heap counts each pair, and a second one over the tasks' results gives the radix's table of pairs. As
that lists one B id after the other, maxima come out as it passes. Then the runs are read once more beside the table: every
record's share goes back to its block as sums by document, and blocks put these beside their documents.

What a task holds is bounded by the block (``RECORDS`` links or ``DOCUMENTS`` rows, but at least one document), by
``TASK_BYTES`` of runs and by the pairs of one radix, of which two vocabularies of 50,000 and 32,000 ids cannot have more than
50 million and prose has some ten thousand.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import slices
from gaugeworks.session import ship_package, written

#: Links, and documents, after which a block is closed; radixes; bytes of compressed runs that one task merges.
RECORDS, DOCUMENTS, RADIXES, TASK_BYTES = 1 << 21, 1 << 15, 16, 16 << 20
#: Parts of texts that a worker keeps at hand, and the longest of them.
KEPT, LONGEST = 1 << 18, 48
#: Pairs of a run that are merged at once.
STEP = 4096
_SHIFT = 32  # a pair is the B id, moved up by so much, and the A id

_SPACE = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")


# --- tokens --------------------------------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


def byte_level(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """Encoder of texts, and the bytes of each id, of a byte-level vocabulary for the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    letters, table = byte_letters(), [b""] * library.get_vocab_size(with_added_tokens=True)
    for name, i in library.get_vocab(with_added_tokens=True).items():
        table[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
    return lambda texts: [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)], table


def pieces(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """The same of a sentencepiece model, which puts a space before each text itself."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    table = [bytes([int(x[1:-1], 16)]) if library.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    return lambda texts: library.encode(texts, num_threads=1), table


def spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the items of ragged rows that begin at ``at`` and hold ``size`` items each, one row after another."""
    ends = np.cumsum(size)
    return np.repeat(at - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Aligner:
    """Tokens, groups and links of texts. Known parts have a place each: a text of their groups, numbers, and a run of links."""

    def __init__(self, a_path: str, b_path: str):
        (self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b) = byte_level(a_path), pieces(b_path)
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # An id with what follows it: a comma, or what ends its side of the group.
        self.names = [f"{i}{mark}" for table, end in ((self.bytes_a, "|"), (self.bytes_b, ";")) for mark in (",", end) for i in range(len(table))]
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.texts: list[str] = []
        #: Tokens of A, of B, links, first link, and whether the bytes are those of the part.
        self.facts = np.empty((0, 5), np.int64)
        self.links = np.empty(0, np.int64)

    def _same(self, parts: list[bytes], ids: list[list[int]], table: list[bytes], sizes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For each part, whether its tokens' bytes are its own."""
        flat = [i for x in ids for i in x]
        ends = np.r_[0, np.cumsum(sizes[np.array(flat, np.int64)])][np.cumsum(n)]
        if b"".join([table[i] for i in flat]) == b"".join(parts) and (np.diff(ends, prepend=0) == [len(x) for x in parts]).all():
            return np.ones(len(parts), bool)
        return np.array([b"".join([table[i] for i in x]) == part for part, x in zip(parts, ids, strict=True)], bool)

    def _learn(self, parts: list[str]) -> None:
        if not parts:
            return
        whole = [(" " + x).encode() for x in parts]
        coded = self.encode_a([" " + x for x in parts]), self.encode_b(parts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in coded)
        good = self._same(whole, coded[0], self.bytes_a, self.size_a, n_a) & self._same(whole, coded[1], self.bytes_b, self.size_b, n_b)
        some = np.flatnonzero(good).tolist()
        ids_a, ids_b = (np.array([i for k in some for i in ids[k]], np.int64) for ids in coded)
        # Offsets in the good parts laid end to end, where both sides cover the same bytes.
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        met = np.minimum(np.searchsorted(ends_b, ends_a), max(0, len(ends_b) - 1))
        cut_a = np.flatnonzero(ends_b[met] == ends_a) if len(ends_b) else np.empty(0, np.int64)
        cut_b = met[cut_a]
        links = ids_b[cut_b] << _SHIFT | ids_a[cut_a]
        n_a, n_b = n_a * good, n_b * good
        n_links = np.diff(np.searchsorted(cut_a, np.cumsum(n_a)), prepend=0)
        # Tokens in the order in which the groups name them: those of A, then those of B, group by group.
        group_a, group_b = np.searchsorted(cut_a, np.arange(len(ids_a))), np.searchsorted(cut_b, np.arange(len(ids_b)))
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[cut_a] = last_b[cut_b] = True
        code[np.arange(len(ids_a)) + np.r_[0, cut_b + 1][group_a]] = ids_a + last_a * len(self.bytes_a)
        code[np.arange(len(ids_b)) + np.r_[cut_a + 1, 0][group_b]] = 2 * len(self.bytes_a) + ids_b + last_b * len(self.bytes_b)
        names = [self.names[i] for i in code.tolist()]
        edge = [0, *np.cumsum(n_a + n_b).tolist()]
        self.place.update(zip(parts, range(len(self.texts), len(self.texts) + len(parts)), strict=True))
        self.texts += ["".join(names[x:y]) for x, y in zip(edge[:-1], edge[1:], strict=True)]
        first = len(self.links) + np.cumsum(n_links) - n_links
        self.facts = np.concatenate([self.facts, np.stack([n_a, n_b, n_links, first, good], 1)])
        self.links = np.concatenate([self.links, links])

    def __call__(self, texts: list[str | None]) -> tuple[list[tuple], list[np.ndarray]]:
        """(n_a, n_b, n_groups, groups_sha256), and the linked pairs, of each text."""
        if len(self.texts) > KEPT:
            self._forget()
        split = [_SPACE.split(x) if x else [] for x in texts]
        fresh = list(set().union(*split).difference(self.place))
        self._learn([x for x in fresh if len(x) <= LONGEST])
        known, links, long = len(self.texts), len(self.links), [x for x in fresh if len(x) > LONGEST]
        self._learn(long)
        place = self.place
        at = [[place[x] for x in parts] for parts in split]
        edge = np.cumsum([0, *map(len, at)])
        every = np.array([k for x in at for k in x], np.int64)
        facts = self.facts[every]
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(facts, axis=0)])[edge]
        n_a, n_b, n_links, _, good = np.diff(sums, axis=0).T
        good = (good == np.diff(edge)) & (np.diff(edge) > 0)
        flat = self.links[spread(facts[:, 3], facts[:, 2])]
        cut = sums[:, 2].tolist()
        out, found = [], []
        for i, (a, b, n, ok) in enumerate(zip(n_a.tolist(), n_b.tolist(), n_links.tolist(), good.tolist(), strict=True)):
            groups = "".join([self.texts[k] for k in at[i]])[:-1] if ok else ""
            out.append((a, b, n, sha256(groups.encode()).hexdigest()) if ok else (0, 0, 0, ""))
            found.append(flat[cut[i] : cut[i + 1] if ok else cut[i]])
        for x in long:  # these do not come again
            del place[x]
        del self.texts[known:]
        self.facts, self.links = self.facts[:known], self.links[:links]
        return out, found


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


# --- runs ----------------------------------------------------------------------------------------

def pack(*columns: np.ndarray) -> bytes:
    """Arrays as one zstd frame after another, each with its type and length in front."""
    packer, out = zstandard.ZstdCompressor(level=3), []
    for x in columns:
        data = packer.compress(np.ascontiguousarray(x).tobytes())
        out.append(x.dtype.str.encode() + len(data).to_bytes(5, "little") + data)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at, packer = [], 0, zstandard.ZstdDecompressor()
    while at < len(data):
        kind, size = data[at : at + 3].decode(), int.from_bytes(data[at + 3 : at + 8], "little")
        out.append(np.frombuffer(packer.decompress(data[at + 8 : at + 8 + size]), kind))
        at += 8 + size
    return out


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    """Differences of ascending integers, which pack well."""
    return np.diff(sorted_values, prepend=0)


def runs_of(links: list[np.ndarray], radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, documents) of a block whose documents have these linked pairs.

    ``pairs`` holds the ascending pairs, their links and their documents' number; ``documents`` holds, pair by pair, the
    documents by their place in the block, and how often each has the pair.
    """
    flat = np.concatenate([*links, np.empty(0, np.int64)])
    if not len(flat):
        return
    names, code = np.unique(flat, return_inverse=True)
    both, times = np.unique(code << 20 | np.repeat(np.arange(len(links)), [len(x) for x in links]), return_counts=True)
    pair, document = both >> 20, both & (1 << 20) - 1
    radix_of = (names >> _SHIFT) % radixes
    for radix in np.unique(radix_of).tolist():
        chosen = np.flatnonzero(radix_of == radix)
        low, high = np.searchsorted(pair, chosen), np.searchsorted(pair, chosen, side="right")
        count = high - low
        rows = spread(low, count)
        sums = np.add.reduceat(times[rows], np.cumsum(count) - count)
        yield radix, pack(_steps(names[chosen]), sums, count.astype("<u4")), pack(document[rows].astype("<u4"), times[rows].astype("<u4"))


def merged(runs: list[tuple[np.ndarray, np.ndarray]], step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending pairs of sorted (pairs, counts) runs, each pair once with the sum of its counts, a few thousand at a time.

    One heap has the pair that each run stands at, another one the end of each run's next step. Whatever lies up to the
    least of these ends is taken from all runs that begin before it.
    """
    runs = [x for x in runs if len(x[0])]
    at = [0] * len(runs)
    heads = [(int(pairs[0]), k) for k, (pairs, _) in enumerate(runs)]
    ends = [(int(pairs[min(step, len(pairs)) - 1]), k) for k, (pairs, _) in enumerate(runs)]
    heapq.heapify(heads)
    heapq.heapify(ends)
    while heads:
        bound, taken = ends[0][0], []
        while heads and heads[0][0] <= bound:
            _, k = heads[0]
            pairs, counts = runs[k]
            stop = at[k] + int(np.searchsorted(pairs[at[k] :], bound, side="right"))
            taken.append((pairs[at[k] : stop], counts[at[k] : stop]))
            at[k] = stop
            if stop < len(pairs):
                heapq.heapreplace(heads, (int(pairs[stop]), k))
            else:
                heapq.heappop(heads)
        while ends and ends[0][0] <= bound:
            _, k = ends[0]
            pairs = runs[k][0]
            if at[k] < len(pairs):
                heapq.heapreplace(ends, (int(pairs[min(at[k] + step, len(pairs)) - 1]), k))
            else:
                heapq.heappop(ends)
        pairs, place = np.unique(np.concatenate([x for x, _ in taken]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, np.concatenate([x for _, x in taken]))
        yield pairs, counts


def _table_of(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = list(merged([(np.cumsum(x[0]), x[1]) for x in map(unpack, blobs)]))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *(x for x, _ in parts)]), np.concatenate([none, *(x for _, x in parts)])


def highest(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id; pairs of one B id lie side by side."""
    if not len(pairs):
        return np.empty(0, bool)
    begins = np.flatnonzero(np.diff(pairs >> _SHIFT, prepend=-1))
    most = np.maximum.reduceat(counts, begins)
    return counts == np.repeat(most, np.diff(begins, append=len(pairs)))


# --- jobs ----------------------------------------------------------------------------------------

def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], schema)


def tokenized(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, radixes: int) -> DataFrame:
    """Documents and runs, stored: rows with a ``radix`` are runs, the others documents. ``block`` and ``row`` name a document."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = (f"block long, row int, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, radix int, pairs binary, documents binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, block = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        links: list[np.ndarray] = []
        held = 0

        def closed() -> pa.RecordBatch:
            rows = [(block, radix, pairs, documents) for radix, pairs, documents in runs_of(links, radixes)]
            n = len(rows)
            none = [pa.nulls(n, t) for t in (pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.string())]
            columns = [list(c) for c in zip(*rows, strict=True)] if n else [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *none, pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], names)

        names = ["block", "row", "id", "n_a", "n_b", "n_groups", "groups_sha256", "radix", "pairs", "documents"]
        for batch in slices(batches, most=1 << 20):
            id_type = batch.schema.field("id").type
            for start in range(0, len(batch), DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                if held and (held >= RECORDS or len(links) + len(part) > DOCUMENTS):
                    yield closed()
                    block, links, held = block + 1, [], 0
                facts, found = use(part.column("text").to_pylist())
                n = len(facts)
                columns = list(zip(*facts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), pa.array(range(len(links), len(links) + n), pa.int32()), part.column("id"),
                     *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names)
                links += found
                held += sum(map(len, found))
        if links:
            yield closed()

    return written(source.mapInArrow(work, schema), "tokenized")


def _salted(runs: DataFrame, size: str, task_bytes: int) -> DataFrame:
    """``runs`` with ``salt``: runs of one radix are dealt over as many salts as their bytes ask for, by block; and ``salts``."""
    many = runs.groupBy("radix").agg(F.ceil(F.sum(F.length(size)) / task_bytes).cast("int").alias("salts"))  # a row for each radix
    return runs.join(F.broadcast(many), "radix").withColumn("salt", F.pmod(F.xxhash64("block"), F.col("salts")).cast("int"))


def counted(runs: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(radix, pairs): the table of each radix, ascending pairs with their counts and whether they are best, stored."""
    arrow = pa.schema([("radix", pa.int32()), ("pairs", pa.binary())])

    def merge(best: bool):
        def work(table: pa.Table) -> pa.Table:
            names, counts = _table_of(table["pairs"].to_pylist())
            data = pack(_steps(names), counts, *([highest(names, counts)] if best else []))
            return pa.Table.from_batches([_rows(arrow, [(table["radix"][0].as_py(), data)])])
        return work

    some = _salted(runs.select("radix", "block", "pairs"), "pairs", task_bytes)
    parts = some.select("radix", "salt", "pairs").groupBy("radix", "salt").applyInArrow(merge(False), "radix int, pairs binary")
    return written(parts.groupBy("radix").applyInArrow(merge(True), "radix int, pairs binary"), "pair-tables")


def contributions(runs: DataFrame, tables: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(block, sums): for the documents of a block, counts summed over links and the number of best links, of one run."""
    arrow = pa.schema([("block", pa.int64()), ("sums", pa.binary())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        steps, counts, best = unpack(right["pairs"][0].as_py())
        names, rows = np.cumsum(steps), []
        for block, pairs, documents in zip(left["block"].to_pylist(), left["pairs"], left["documents"], strict=True):
            (own, _, number), (document, times) = unpack(pairs.as_py()), unpack(documents.as_py())
            place = np.repeat(np.searchsorted(names, np.cumsum(own)), number)
            # In whole numbers; a document's sum may be beyond what a double holds.
            which, to = np.unique(document, return_inverse=True)
            total, hits = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
            np.add.at(total, to, counts[place] * times)
            np.add.at(hits, to, best[place] * times.astype(np.int64))
            rows.append((block, pack(_steps(which.astype(np.int64)), total, hits)))
        return pa.Table.from_batches([_rows(arrow, rows)])

    salted = _salted(runs.select("radix", "block", "pairs", "documents"), "documents", task_bytes)
    many = salted.groupBy("radix").agg(F.first("salts").alias("salts"))
    dealt = tables.join(F.broadcast(many), "radix").select("radix", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "pairs")
    left, right = salted.select("radix", "salt", "block", "pairs", "documents"), dealt.select("radix", "salt", "pairs")
    return left.groupBy("radix", "salt").cogroup(right.groupBy("radix", "salt")).applyInArrow(work, "block long, sums binary")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", radixes: int = RADIXES,
          task_bytes: int = TASK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of texts encoded by the byte-level vocabulary ``a_path`` and the sentencepiece model ``b_path``.

    Documents: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row; pairs: a_id, b_id, links,
    best. A text that is null or empty, or that a tokenizer does not give back byte by byte after a space, has no tokens:
    zeros and an empty string. Repeated rows are documents of their own; an empty table gives empty ones.
    """
    stored = tokenized(docs, a_path, b_path, id_col, text_col, radixes)
    runs = stored.where("radix is not null").select("block", "radix", "pairs", "documents")
    tables = counted(runs, task_bytes)
    sums = contributions(runs, tables, task_bytes)
    each = stored.where("radix is null").select("block", "row", "id", "n_a", "n_b", "n_groups", "groups_sha256")
    kind = each.schema["id"].dataType.simpleString()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left["row"].to_numpy()
        total, hits = (np.zeros(int(rows.max()) + 1 if len(rows) else 0, np.int64) for _ in range(2))
        for data in right["sums"]:
            steps, some, best = unpack(data.as_py())
            which = np.cumsum(steps)
            total[which] += some
            hits[which] += best
        return pa.Table.from_arrays(
            [left["id"], left["n_a"], left["n_b"], left["n_groups"], left["n_groups"], pa.array(hits[rows]), pa.array(total[rows]), left["groups_sha256"]],
            ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    found = each.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(work, schema).withColumnRenamed("id", id_col)
    return found, pair_rows(tables)


def pair_rows(tables: DataFrame) -> DataFrame:
    """a_id, b_id, links and best of every linked pair of ids."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("pairs"):
                steps, counts, best = unpack(data.as_py())
                names = np.cumsum(steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names & (1 << _SHIFT) - 1), pa.array(names >> _SHIFT), pa.array(counts), pa.array(best)], ["a_id", "b_id", "links", "best"])

    return tables.select("pairs").mapInArrow(work, "a_id long, b_id long, links long, best boolean")

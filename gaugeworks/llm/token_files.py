"""Token ids as flat binary files that are read through memory maps.

Each partition of the documents, in ascending order of their id, becomes one shard of three files:

* ``.ids``: ids as unsigned little-endian integers, 16 bits wide if the vocabulary allows, else 32;
* ``.idx``: 64-bit unsigned offsets into it, one for each document and one for the end;
* ``.docs``: the documents' ids as an Arrow file.

The manifest has one row for each shard. A shard's base, the ids of all shards before it, is a prefix sum over
the manifest, so offsets within a shard plus its base are offsets within the whole corpus. Files are named by
the attempt that wrote them and only a committed attempt gets into the manifest; a task that runs again after
the loss of an executor cannot mix with what it left behind.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.batches import U, slices, text_bytes, words_in
from gaugeworks.session import ship_package, written

MANIFEST = "part int, path string, width int, n_docs long, n_ids long"
#: Words whose ids a worker keeps at hand, some 40 bytes each.
KEPT_WORDS = 1 << 22


@lru_cache(maxsize=1)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a place in the shared folder."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


#: ASCII punctuation but the apostrophe, which can belong to the letters after it.
_TAIL = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c != 39)


class Encoder:
    """Ids of texts by the tokenizers library, as little-endian integers of ``width`` bytes.

    If the vocabulary drops white space and case (``by_words``), no token, match or normalisation reaches across white
    space, so a text's ids are those of its words in order. Each distinct word goes to the library once and is kept, under
    its 64-bit hash, for the texts that follow; a new word that ends in ASCII punctuation after an ASCII letter is put
    together from both parts, as the library splits there, too. Texts with what may be a special token go to the library as
    they are.
    """

    def __init__(self, path: str, width: int, by_words: bool):
        self.library, self.kind, self.by_words = _library(path), f"<u{width}", by_words
        special = {i: x.content for i, x in self.library.get_added_tokens_decoder().items() if x.special and "<|" in x.content}
        self.mark = next(iter(special.items()), None)
        self._forget()

    def _forget(self) -> None:
        # Word ``names[k]`` (sorted) has the ids ``ids[at[k]:at[k] + size[k]]``; ``used`` of them are in use.
        self.names, self.at, self.size = np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, self.kind), 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words without a special token: joined by one, which parts the ids again, if the vocabulary has any."""
        if self.mark is None:
            return self._encode(words)
        number, content = self.mark
        ids = np.array(self.library.encode_batch_fast([content.join(words)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.r_[np.flatnonzero(ids == number), len(ids)]
        width = np.dtype(self.kind).itemsize
        data, ends = ids.astype(self.kind).tobytes(), (ends * width).tolist()
        return [data[a:b] for a, b in zip([0, *(x + width for x in ends[:-1])], ends, strict=True)]

    def _find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word is, and whether it is there."""
        if not len(self.names):
            return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return at, self.names[at] == names

    def _keep(self, names: np.ndarray, ids: list[bytes]) -> None:
        """Add words that are not there yet."""
        data = np.frombuffer(b"".join(ids), self.kind)
        size = np.array([len(x) for x in ids], np.int64) // data.itemsize
        if self.used + len(data) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(len(self.ids) + len(data), self.kind)])
        self.ids[self.used : self.used + len(data)] = data
        at = self.used + np.cumsum(size) - size
        self.used += len(data)
        order = np.argsort(names)
        place = np.searchsorted(self.names, names[order])
        self.names, self.at, self.size = (
            np.insert(old, place, new[order]) for old, new in ((self.names, names), (self.at, at), (self.size, size)))

    def _learn(self, words: list[bytes]) -> None:
        """Encode and keep words, none of them twice and none known."""
        ids: list[bytes] = []
        for start in range(0, len(words), 1 << 12):
            ids += self._encode_words([x.decode() for x in words[start : start + (1 << 12)]])
        self._keep(words_in(words).hashes, ids)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_words:
            return self._encode([x.decode() for x in texts])
        special = [i for i, x in enumerate(texts) if b"<|" in x]
        words = words_in([b"" if b"<|" in x else x for x in texts], lower=True)
        if len(self.names) > KEPT_WORDS:
            self._forget()
        names, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        fresh = first[~self._find(names)[1]]
        data = words.data.tobytes()
        new = [data[a:b] for a, b in zip(words.start[fresh].tolist(), words.stop[fresh].tolist(), strict=True)]
        cut = [len(w.rstrip(_TAIL)) if w[-1] in _TAIL and b"'" not in w else 0 for w in new]
        cut = [k if k and 97 <= w[k - 1] <= 122 else 0 for w, k in zip(new, cut, strict=True)]
        ends = [(w, k) for w, k in zip(new, cut, strict=True) if k]
        parts = list({w for w, k in zip(new, cut, strict=True) if not k}.union([w[:k] for w, k in ends], [w[k:] for w, k in ends]))
        known = self._find(words_in(parts).hashes)[1].tolist()
        self._learn([w for w, there in zip(parts, known, strict=True) if not there])
        if ends:
            halves = [self._find(words_in(x).hashes)[0] for x in ([w[:k] for w, k in ends], [w[k:] for w, k in ends])]
            whole = [b"".join(x) for x in zip(*([self.ids[a : a + n].tobytes() for a, n in zip(
                self.at[h].tolist(), self.size[h].tolist(), strict=True)] for h in halves), strict=True)]
            self._keep(words_in([w for w, _ in ends]).hashes, whole)
        at = self._find(names)[0][back]
        size = self.size[at]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(self.at[at] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)].tobytes()
        edge = (np.r_[0, stop][words.ptr] * np.dtype(self.kind).itemsize).tolist()
        out = [ids[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        for i, other in zip(special, self._encode([texts[i].decode() for i in special]), strict=True):
            out[i] = other
        return out


@lru_cache(maxsize=1)
def encoder(path: str, width: int, by_words: bool) -> Encoder:
    """The worker's encoder, with the words that earlier tasks have met."""
    return Encoder(path, width, by_words)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, by_words: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards to ``folder`` and return the manifest, with ``base``, as a stored table.

    ``by_words`` tells that the tokenizer drops white space and case. Rows with a null id come first, rows that share an id are
    all written, ordered by text; a null text has only its end id. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    ship_package(spark)
    highest = max(_library(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
    width = 2 if highest < 1 << 16 else 4
    tail = b"" if end_id is None else end_id.to_bytes(width, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(tokenizer, width, by_words)
        part = TaskContext.get().partitionId()
        files, place = file_system(folder)
        files.create_dir(place, recursive=True)
        name, streams, docs_file = f"shard-{part:06d}-{uuid.uuid4().hex}", None, None
        n_docs = n_ids = 0
        for batch in slices(batches):
            if streams is None:
                streams = [files.open_output_stream(f"{place}/{name}.{kind}") for kind in ("ids", "idx", "docs")]
                docs_file = pa.ipc.new_file(streams[2], pa.schema([pa.field("id", batch.schema.field("id").type)]))
                streams[1].write(np.zeros(1, "<u8").tobytes())
            rows = [x + tail for x in use(text_bytes(batch.column("text")))]
            sizes = np.array([len(x) // width for x in rows], np.int64)
            streams[0].write(b"".join(rows))
            streams[1].write((n_ids + np.cumsum(sizes)).astype("<u8").tobytes())
            docs_file.write_batch(batch.select(["id"]))
            n_docs, n_ids = n_docs + len(rows), n_ids + int(sizes.sum())
        if streams:
            docs_file.close()
            for stream in streams:
                stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([width], pa.int32()),
                 pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                ["part", "path", "width", "n_docs", "n_ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = source.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), "text")
    shards = written(dealt.mapInArrow(work, MANIFEST), "shards").orderBy("part").collect()  # a row for each file
    bases = accumulate([0, *(row.n_ids for row in shards)])
    table = spark.createDataFrame([(*row, base) for row, base in zip(shards, bases, strict=False)], f"{MANIFEST}, base long")
    return written(table, "manifest")


def _mapped(files: fs.FileSystem, path: str, spare: str) -> np.ndarray:
    """Bytes of a file as a memory map; one that is not local is copied to ``spare`` first."""
    if not isinstance(files, fs.LocalFileSystem):
        local = os.path.join(spare, os.path.basename(path))
        fs.copy_files(path, local, source_filesystem=files, destination_filesystem=fs.LocalFileSystem())
        path = local
    return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.empty(0, np.uint8)


def read_shards(spark: SparkSession, manifest: DataFrame, id_type: str = "bigint", id_col: str = "doc_id",
                at_once: int = 4096) -> DataFrame:
    """Documents as the files hold them: id_col, start (of the whole corpus), n_tokens, ids_crc32.

    The checksum is that of the ids as unsigned little-endian 32-bit integers.
    """
    ship_package(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                files, place = file_system(shard["path"])
                with tempfile.TemporaryDirectory() as spare:
                    ids = _mapped(files, f"{place}.ids", spare).view(f"<u{shard['width']}")
                    offsets = _mapped(files, f"{place}.idx", spare).view("<u8").astype(np.int64)
                    names = pa.ipc.open_file(pa.py_buffer(_mapped(files, f"{place}.docs", spare))).read_all()["id"]
                    for k in range(0, shard["n_docs"], at_once):
                        cut = offsets[k : k + at_once + 1]
                        sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [names.slice(k, len(sums)).combine_chunks(), pa.array(cut[:-1] + shard["base"]),
                             pa.array(np.diff(cut)), pa.array(sums, pa.int64())],
                            ["id", "start", "n_tokens", "ids_crc32"])

    schema = f"id {id_type}, start long, n_tokens long, ids_crc32 long"
    # A task for each shard; without the number, adaptive execution would put these few rows into one task.
    shards = manifest.repartitionByRange(max(1, manifest.count()), "part")
    return shards.mapInArrow(work, schema).withColumnRenamed("id", id_col)

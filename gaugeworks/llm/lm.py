"""A language model as a weighted backoff automaton, counted over a whole corpus and run over all of its texts.

The model is a bigram model with absolute discounting. A state stands for the last word; its arcs are the words that
followed it in training, weighted ``log10((n - D) / c + D * k / c * P0(word))``, where n is the count of the pair, c
that of the state, k the number of its arcs and ``P0`` the add-half unigram. Any other word takes the failure arc,
weighted ``log10(D * k / c)``, to the root, whose arcs are the unigrams. D is n1 / (n1 + 2 n2) over the counts of
counts of all pairs. A text starts in the state of its beginning, its last token is its end, and one traversal from left
to right adds up the weights.

The automaton grows with the corpus, so no machine holds it. Documents are worked on in blocks of ``BLOCK`` rows, or fewer
where their texts pass ``BLOCK_BYTES``; the shards grow in number with the rows. Each
block sends the states and arcs that its texts can meet, with its own training counts, as sorted arrays to shards of the
automaton (by ranges of the state's hash); a shard adds them up and answers each block in the order it asked; the block
then walks its texts over its part of the automaton. Words are 64-bit hashes; arcs of a state are told apart by 48 bits.
A state's arcs are sent once for each block at most, however often they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import U, blob, slices, words_of
from gaugeworks.session import ship_package, written

#: Rows of one block, and bytes of text after which its part of the automaton is closed.
BLOCK, BLOCK_BYTES = 2048, 32 << 20
#: Rows for which the automaton has one shard more.
SHARD_ROWS = 1 << 14
BEGIN, END = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
_LOW = U((1 << 48) - 1)

_REQUEST = ("shard int, file string, block long, first long, last long, states binary, state_n binary, arcs binary, "
            "arc binary, arc_n binary")
_REPLY = ("shard int, file string, block long, first long, last long, state_n binary, state_k binary, arc_n binary, "
          "words long, known long, docs long, n1 long, n2 long")


@dataclass
class Part:
    """The part of the automaton that some texts can meet, and their path through it.

    ``states`` are sorted; state i has ``arcs[i]`` arcs, whose words (low 48 bits of the hash) are sorted in ``arc``.
    Step j of the texts leaves state ``state[j]`` for the word ``word[j]`` of the states (-1: the end) and would take arc
    ``taken[j]``. Steps of text i are ``ptr[i]:ptr[i + 1]``.
    """

    states: np.ndarray
    arcs: np.ndarray
    arc: np.ndarray
    state: np.ndarray
    word: np.ndarray
    taken: np.ndarray
    ptr: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Part:
        found = words_of(texts, lower=True)
        rows = np.arange(len(found.ptr))
        last = np.insert(found.hashes, found.ptr[:-1], BEGIN)
        following = np.insert(found.hashes, found.ptr[1:], END)
        states, state = np.unique(last, return_inverse=True)
        low = following & _LOW
        order = np.lexsort((low, state))
        new = np.ones(len(order), bool)
        new[1:] = (state[order][1:] != state[order][:-1]) | (low[order][1:] != low[order][:-1])
        taken = np.empty(len(order), np.int64)
        taken[order] = np.cumsum(new) - 1
        word = np.searchsorted(states, following)
        word[following == END] = -1
        return cls(states, np.bincount(state[order[new]], minlength=len(states)), low[order[new]], state, word, taken,
                   found.ptr + rows)

    def counts(self, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the texts marked in ``training`` are in each state and take each arc."""
        use = np.repeat(training, np.diff(self.ptr)).astype(np.float64)
        return np.bincount(self.state, use, len(self.states)), np.bincount(self.taken, use, len(self.arc))


@dataclass
class Totals:
    """Sums over the whole training corpus; ``words`` and ``kinds`` count ends, too."""

    words: int
    kinds: int
    docs: int
    discount: float


def traverse(part: Part, totals: Totals, state_n: np.ndarray, state_k: np.ndarray, arc_n: np.ndarray):
    """(tokens, known tokens, unigram score, score) of each text, by the counts of its part of the automaton."""
    token_n = np.where(part.word >= 0, state_n[part.word], totals.docs)
    unigram = (token_n + 0.5) / (totals.words + 0.5 * (totals.kinds + 1))
    c, n = state_n[part.state], arc_n[part.taken]
    with np.errstate(divide="ignore", invalid="ignore"):
        failure = totals.discount * state_k[part.state] / c
        weight = np.where(n > 0, np.log10(np.maximum(n - totals.discount, 0) / c + failure * unigram),
                          np.where(c > 0, np.log10(failure), 0) + np.log10(unigram))
    begin = part.ptr[:-1]
    return (np.diff(part.ptr), np.add.reduceat((token_n > 0).astype(np.int64), begin),
            np.add.reduceat(np.log10(unigram), begin), np.add.reduceat(weight, begin))


def _pack48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _ask(shards: int):
    """Requests of each block: one row for each shard that it needs."""
    bounds = np.array([(i << 64) // shards for i in range(1, shards)], U)

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        part = Part.of(rows["text"].combine_chunks())
        state_n, arc_n = part.counts(rows["train"].to_numpy(zero_copy_only=False).astype(bool))
        cut = np.r_[0, np.searchsorted(part.states, bounds), len(part.states)]
        arc_cut = np.r_[0, np.cumsum(part.arcs)][cut]
        who = [rows["file"][0].as_py(), rows["block"][0].as_py(), rows["row"][0].as_py(), rows["row"][-1].as_py()]
        out = []
        for s in np.flatnonzero(np.diff(cut)):
            a, b, x, y = cut[s], cut[s + 1], arc_cut[s], arc_cut[s + 1]
            out.append([int(s), *who, blob(part.states[a:b]), blob(state_n[a:b].astype(np.uint32)),
                        blob(part.arcs[a:b].astype(np.uint32)), _pack48(part.arc[x:y]), blob(arc_n[x:y].astype(np.uint32))])
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 3, *[pa.binary()] * 5]
        names = [x.split()[0] for x in _REQUEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, size = [], None, 0
        for batch in slices(batches, most=BLOCK_BYTES):
            if not batch.num_rows:
                continue
            file, number = batch.column("file"), batch.column("block").to_numpy()
            other = pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((np.diff(number) != 0) | other) + 1
            for a, b in zip([0, *edge], [*edge, batch.num_rows], strict=True):
                now, some = (file[int(a)].as_py(), int(number[a])), batch.slice(int(a), int(b - a))
                length = pc.sum(pc.binary_length(some.column("text"))).as_py() or 0
                if held and (of != now or size + length > BLOCK_BYTES):
                    yield from block(pa.Table.from_batches(held))
                    held, size = [], 0
                of = now
                held.append(some)
                size += length
        if held:
            yield from block(pa.Table.from_batches(held))

    return work


def _answer(asked: pa.Table) -> pa.Table:
    """One shard: adds up what all blocks sent and answers each with the sums, in its own order."""
    columns = {c: asked[c].to_pylist() for c in ("states", "state_n", "arcs", "arc", "arc_n")}
    read = lambda c, kind: [np.frombuffer(x, kind) for x in columns[c]]
    states, arcs = read("states", U), read("arcs", np.uint32)
    kinds, at = np.unique(np.concatenate(states), return_inverse=True)
    state_n = np.bincount(at, np.concatenate(read("state_n", np.uint32))).astype(np.int64)
    owner = np.repeat(at, np.concatenate(arcs))
    arc = np.concatenate([_unpack48(x) for x in columns["arc"]])
    order = np.lexsort((arc, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (arc[order][1:] != arc[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    arc_n = np.bincount(place, np.concatenate(read("arc_n", np.uint32))).astype(np.int64)
    state_k = np.bincount(owner[order[new]], arc_n > 0, len(kinds)).astype(np.int64)
    ends, arc_ends = np.cumsum([len(x) for x in states]), np.cumsum([int(x.sum()) for x in arcs])
    out = {c: asked[c] for c in ("shard", "file", "block", "first", "last")}
    cuts = list(zip(np.r_[0, ends], ends, np.r_[0, arc_ends], arc_ends, strict=False))
    out["state_n"] = pa.array([blob(state_n[at[a:b]].astype(np.uint32)) for a, b, _, _ in cuts], pa.binary())
    out["state_k"] = pa.array([blob(state_k[at[a:b]].astype(np.uint32)) for a, b, _, _ in cuts], pa.binary())
    out["arc_n"] = pa.array([blob(arc_n[place[x:y]].astype(np.uint32)) for _, _, x, y in cuts], pa.binary())
    # The shard's own sums stand in its first row only.
    word = kinds != BEGIN
    sums = {"words": state_n[word].sum(), "known": (state_n[word] > 0).sum(), "docs": state_n[~word].sum(),
            "n1": (arc_n == 1).sum(), "n2": (arc_n == 2).sum()}
    for c, value in sums.items():
        out[c] = pa.array([int(value)] + [0] * (asked.num_rows - 1), pa.int64())
    return pa.table(out)


def _walk(totals: Totals):
    """Scores of the documents of a block, by the answers of all shards."""

    def work(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        docs, answers = docs.sort_by("row"), answers.sort_by([("first", "ascending"), ("shard", "ascending")])
        rows, firsts = docs["row"].to_numpy(), answers["first"].to_numpy()
        for first in np.unique(firsts):
            own = answers.slice(*_span(firsts, first))
            a, b = np.searchsorted(rows, first), np.searchsorted(rows, own["last"][0].as_py(), side="right")
            some = docs.slice(a, b - a)
            read = lambda c: np.frombuffer(b"".join(own[c].to_pylist()), np.uint32).astype(np.float64)  # noqa: B023, E731
            found = traverse(Part.of(some["text"].combine_chunks()), totals, read("state_n"), read("state_k"), read("arc_n"))
            out.append(pa.table({"id": some["id"], "train": some["train"], "n_tokens": found[0].astype(np.int64),
                                 "n_known": found[1], "base_score": found[2], "score": found[3]}))
        return pa.concat_tables(out)

    return work


def _span(values: np.ndarray, value) -> tuple[int, int]:
    a, b = np.searchsorted(values, [value, value], side="left")[0], np.searchsorted(values, value, side="right")
    return int(a), int(b - a)


def _placed(docs: DataFrame, id_col: str, text_col: str, training: Column) -> DataFrame:
    """id, text and train of each row, with its place: file, row within it, and block."""

    def of(df: DataFrame, id_: Column, text: Column, train: Column) -> DataFrame:
        row = F.col("_metadata.row_index")
        return df.select(id_.alias("id"), text.alias("text"), train.alias("train"), F.col("_metadata.file_path").alias("file"),
                         row.alias("row"), F.floor(row / BLOCK).cast("long").alias("block"))

    columns = F.col(id_col), F.col(text_col).cast("string"), F.coalesce(training, F.lit(False))
    try:
        return of(docs, *columns)
    except AnalysisException:  # not a plain scan of Parquet files: its copy is
        copy = written(docs.select(*(c.alias(n) for c, n in zip(columns, ("id", "text", "train"), strict=True))), "texts")
        return of(copy, F.col("id"), F.col("text"), F.col("train"))


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the model on the rows where ``training`` holds and score every row.

    Returns id_col, trained, n_tokens, n_known, train_tokens, base_score and score, both as log10. A null text is empty and
    has one token, its end. Every row counts, also repeated ones and those with a null id; a null ``training`` is false.
    Other columns are left out; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    placed = _placed(docs, id_col, text_col, training)
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), placed.count() // SHARD_ROWS)
    asked = placed.mapInArrow(_ask(shards), _REQUEST)
    answers = written(asked.groupBy("shard").applyInArrow(_answer, _REPLY), "automaton")
    sums = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "known", "docs", "n1", "n2"))).first()
    discount = min(0.95, max(0.05, sums.n1 / max(1, sums.n1 + 2 * sums.n2)))
    totals = Totals(sums.words + sums.docs, sums.known + (sums.docs > 0), sums.docs, discount)
    blocks = answers.select("file", "block", "shard", "first", "last", "state_n", "state_k", "arc_n")
    kind = placed.schema["id"].dataType.simpleString()
    scored = placed.groupBy("file", "block").cogroup(blocks.groupBy("file", "block")).applyInArrow(
        _walk(totals), f"id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), F.col("train").alias("trained"), "n_tokens", "n_known",
                         F.lit(totals.words).cast("long").alias("train_tokens"), "base_score", "score")

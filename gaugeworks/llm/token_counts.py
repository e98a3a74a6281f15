"""Token counts by rank-synchronous merging of ragged arrays, as sentencepiece counts for a BPE model.

White space stands as U+2581 and starts a pre-token; the model's pieces hold it nowhere else, so no merge
reaches from one pre-token into the next, and equal pre-tokens have equal counts. The distinct pre-tokens of a
batch lie in one flat array. In each round every pre-token applies its lowest-ranked neighbouring pair, the
leftmost among equals; those without any pair are done. What survives counts as one token each, but a
character that the model does not know counts as its bytes.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import slices
from gaugeworks.session import ship_package

MARK = "▁"
#: Symbols of one pre-token from which on a heap finds the same merges: rounds would cost the square of its length.
LONG = 256
#: Pre-tokens that are merged at once.
AT_ONCE = 1 << 16
_PRE_TOKENS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Model:
    """Merge table of a sentencepiece BPE model: (left, right) symbol ids to the merged symbol and its rank."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        pieces = [(library.id_to_piece(i), library.get_score(i)) for i in range(library.get_piece_size())
                  if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        if any(MARK in piece.lstrip(MARK) for piece, _ in pieces):
            raise ValueError("a piece holds white space after other characters")
        self.ids = {piece: i for i, (piece, _) in enumerate(pieces)}
        order = {score: rank for rank, score in enumerate(sorted({score for _, score in pieces}, reverse=True))}
        #: By symbol; symbols beyond the pieces are characters that no piece is.
        self.rank = [order[score] for _, score in pieces]
        self.tokens = [1] * len(pieces)
        self.fixed = len(pieces)
        pairs = {}
        for piece, to in list(self.ids.items()):
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = to
        self.pairs = pairs
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        put = np.argsort(keys)
        self.keys, self.merged = keys[put], np.array(list(pairs.values()), np.int64)[put]
        ranks = np.array(self.rank, np.int64)
        self.ranks = ranks[self.merged]

    def symbol(self, text: str) -> int | None:
        """Id of a piece, or of a character, known or not; None for a longer text that is no piece."""
        if (found := self.ids.get(text)) is None and len(text) == 1:
            found = self.ids[text] = len(self.tokens)
            self.tokens.append(len(text.encode()))
        return found

    def heap(self, symbols: list[int]) -> list[int]:
        """Surviving symbols of one long pre-token."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            if a >= 0 and after[a] < n and (to := self.pairs.get((symbols[a], symbols[after[a]]))) is not None:
                heapq.heappush(queue, (self.rank[to], a, symbols[a], symbols[after[a]]))

        for a in range(n):
            offer(a)
        while queue:
            _, a, left, right = heapq.heappop(queue)
            if symbols[a] != left or after[a] >= n or symbols[b := after[a]] != right:
                continue
            symbols[a], symbols[b], after[a] = self.pairs[left, right], -1, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            offer(before[a])
        return [x for x in symbols if x >= 0]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of neighbouring symbols; a rank beyond all others where they do not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], np.iinfo(np.int64).max), self.merged[at]

    def merge(self, sequences: list[list[int]]) -> np.ndarray:
        """Tokens of each sequence of symbols, all of them merged in step."""
        out = np.zeros(len(sequences), np.int64)
        tokens = np.array(self.tokens, np.int64)
        owner = np.repeat(np.arange(len(sequences)), [len(x) for x in sequences])
        flat = np.array([s for x in sequences for s in x], np.int64)
        never = np.iinfo(np.int64).max
        rank = np.full(len(flat), never, np.int64)  # of each symbol with its right neighbour
        to = np.zeros(len(flat), np.int64)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner], to[inner] = self._pair(flat[inner], flat[inner + 1])
        while len(flat):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[first, len(flat)])
            best = np.minimum.reduceat(rank, first)
            over = best == never
            if over.any():  # these sequences are done: count what is left of them, and go on with the others
                gone = np.repeat(over, length)
                np.add.at(out, owner[gone], tokens[flat[gone]])
                flat, owner, rank, to = flat[~gone], owner[~gone], rank[~gone], to[~gone]
                continue
            hits = np.flatnonzero(rank == np.repeat(best, length))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]  # the leftmost of each sequence
            flat[hits] = to[hits]
            stay = np.ones(len(flat), bool)
            stay[hits + 1] = False
            moved = np.cumsum(stay) - 1
            flat, owner, rank, to = flat[stay], owner[stay], rank[stay], to[stay]
            at = moved[hits]
            for left in (at, at[at > 0] - 1):  # pairs that the merged symbol now makes
                ends = (left + 1 >= len(flat)) | (owner[left] != owner[np.minimum(left + 1, len(flat) - 1)])
                rank[left[ends]] = never
                left = left[~ends]
                rank[left], to[left] = self._pair(flat[left], flat[left + 1])
        return out

    def counts(self, pre_tokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(pre_tokens), np.int64)
        symbol = self.symbol
        for start in range(0, len(pre_tokens), AT_ONCE):
            sequences, short = [], []
            for i in range(start, min(start + AT_ONCE, len(pre_tokens))):
                symbols = [symbol(c) for c in pre_tokens[i]]
                if len(symbols) > LONG:
                    out[i] = sum(self.tokens[s] for s in self.heap(symbols))
                else:
                    sequences.append(symbols)
                    short.append(i)
            if short:
                out[short] = self.merge(sequences)
        if len(self.tokens) > self.fixed + (1 << 20):  # characters seen so far take memory
            model.cache_clear()
        return out


@lru_cache(maxsize=1)
def model(path: str) -> Model:
    return Model(path)


def pre_tokens(text: str) -> list[str]:
    """A text as the model's pre-tokens: white space marked, one mark put in front of a text that is not empty."""
    return _PRE_TOKENS.findall(MARK + text.replace(" ", MARK)) if text else []


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row; a null text is empty.

    Works row by row: repeated rows give repeated results, a null id stays null, an empty table gives an empty one,
    other columns are left out.
    """
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}  # counts of earlier batches
        for batch in slices(batches):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            rows = [Counter(pre_tokens(x)) for x in texts]
            if len(known) > 1 << 18:
                known.clear()
            fresh = list({token for row in rows for token in row if token not in known})
            known.update(zip(fresh, model(path).counts(fresh).tolist(), strict=True))
            tokens = [sum(known[token] * n for token, n in row.items()) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return source.mapInArrow(work, schema).withColumnRenamed("id", id_col)

"""Cross-tokenizer alignment against the libraries on whole texts."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gaugeworks.llm import alignment
from gaugeworks.llm.catalogue import QUERIES
from tests.llm.brute import sha

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def library():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def tokens(text):
        """Ids and bytes of both sides, or none."""
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        same = text and b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()
        return (ids_a, bytes_a, ids_b, bytes_b) if same else None

    return tokens


def brute(docs, tokens):
    coded, links = [], Counter()
    for i, text in docs:
        found = tokens(text or "")
        if found is None:
            coded.append((i, 0, 0, [], ""))
            continue
        a, x, b, y = found
        ends_a = {int(e): k for k, e in enumerate(np.cumsum([len(t) for t in x]))}
        ends_b = {int(e): k for k, e in enumerate(np.cumsum([len(t) for t in y]))}
        cuts = sorted(ends_a.keys() & ends_b.keys())
        pairs = [(a[ends_a[c]], b[ends_b[c]]) for c in cuts]
        groups, i0, j0 = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, a[i0 : ends_a[c] + 1])) + "|" + ",".join(map(str, b[j0 : ends_b[c] + 1])))
            i0, j0 = ends_a[c] + 1, ends_b[c] + 1
        links.update(pairs)
        coded.append((i, len(a), len(b), pairs, sha(";".join(groups))))
    top = Counter()
    for (_, b), n in links.items():
        top[b] = max(top[b], n)
    rows = [(i, n_a, n_b, len(p), len(p), sum(links[q] == top[q[1]] for q in p), sum(links[q] for q in p), digest) for i, n_a, n_b, p, digest in coded]
    return sorted(rows, key=repr), {(a, b, n, n == top[b]) for (a, b), n in links.items()}


def check(docs, data, tokens, **how):
    want, links = brute(data, tokens)
    found, pairs = alignment.align(docs, A, B, **how)
    assert found.columns == FIELDS
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert {(r.a_id, r.b_id, r.links, r.best) for r in pairs.collect()} == links


def test_alignment_by_hand(make, hand_rows, library):
    data = [*hand_rows, *hand_rows[:2], (None, "null id"), (1, None), (2, ""), (3, " "), (4, "a ▁ b"), (5, "  two  spaces  "), (6, "x" * 3000),
            (7, "é" * 2000 + " end"), (8, "tab\tand\nline \n end"), (9, "  nbsp   em"), (10, "<s> </s> <unk> <0x41> <|endoftext|>")]
    check(make(data), data, library)


def test_alignment_over_many_blocks_radixes_and_salts(make, hand_rows, library, monkeypatch):
    for name, value in {"RECORDS": 50, "DOCUMENTS": 4, "KEPT": 20, "LONGEST": 5, "STEP": 3}.items():
        monkeypatch.setattr(alignment, name, value)
    alignment.aligner.cache_clear()
    data = [*hand_rows, *hand_rows, (None, "null id")]
    check(make(data), data, library, radixes=3, task_bytes=200)


def test_parts_are_encoded_as_whole_texts(library):
    random.seed(8)
    parts = list("abÉ  \n\t'sé漢Σσ字😀 ́ 0123!?ABCthe \x00\x1c▁_") + ["the ", "don't ", "a. ", " b", "<s>", "ﬁ ", "½ ", " ", "  "]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(1, 60))) for _ in range(1500)]
    use = alignment.Aligner(A, B)
    facts, links = use(texts)
    for text, fact, found in zip(texts, facts, links, strict=True):
        row, _ = brute([(0, text)], library)
        assert fact == (row[0][1], row[0][2], row[0][3], row[0][7]) and len(found) == fact[2], text


def test_merge_counts_each_pair_once():
    random.seed(5)
    runs = []
    for _ in range(17):
        pairs = np.unique([random.randint(0, 300) << 32 | random.randint(0, 9) for _ in range(random.choice([0, 1, 40, 400]))]).astype(np.int64)
        runs.append((pairs, np.array([random.randint(1, 9) for _ in pairs], np.int64)))
    want = Counter()
    for pairs, counts in runs:
        for p, n in zip(pairs.tolist(), counts.tolist(), strict=True):
            want[p] += n
    for step in (1, 7, 10_000):
        got = [(p, n) for pairs, counts in alignment.merged(runs, step) for p, n in zip(pairs.tolist(), counts.tolist(), strict=True)]
        assert got == sorted(want.items())
    pairs, counts = (np.array(x, np.int64) for x in zip(*sorted(want.items()), strict=True))
    top = Counter()
    for p, n in want.items():
        top[p >> 32] = max(top[p >> 32], n)
    assert alignment.highest(pairs, counts).tolist() == [n == top[p >> 32] for p, n in sorted(want.items())]


def test_alignment_of_an_empty_table(empty_docs):
    found, pairs = alignment.align(empty_docs, A, B)
    assert found.count() == 0 and pairs.count() == 0 and found.columns == FIELDS


def test_alignment_query(spark, sf, small, library):
    want, _ = brute(small, library)
    found = QUERIES["op13_token_alignment"](spark, sf)
    assert found.columns == FIELDS and sorted(map(tuple, found.collect()), key=repr) == want

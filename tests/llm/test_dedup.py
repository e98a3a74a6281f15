"""Near-duplicates, repeated passages, lines and vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import embedding_dups, graph, line_dedup, near_dups, substring_dedup
from gaugeworks.llm.catalogue import QUERIES
from tests.llm import brute


def by_id(df, key="doc_id"):
    return {r[key]: tuple(r)[1:] for r in df.collect()}


def test_near_duplicates_by_hand(hand_docs, hand_rows):
    found = near_dups.near_duplicates(hand_docs, words=4, percent=80)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert by_id(found) == brute.near_duplicates(hand_rows, 4, 80)


def test_near_duplicates_query(spark, sf, small):
    assert by_id(QUERIES["op1_minhash_dedup"](spark, sf)) == brute.near_duplicates(small, 4, 80)


def test_near_duplicates_of_a_large_group(make):
    """A chain: each text is near the next, the ends are far apart, and some members only meet others than the hub."""
    rng = np.random.default_rng(3)
    words = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words[int(rng.integers(0, 120))] = f"new{i}"
        rows.append((i, " ".join(words)))
    assert by_id(near_dups.near_duplicates(make(rows), 4, 80)) == brute.near_duplicates(rows, 4, 80)


def test_recall_of_near_duplicates_at_the_threshold(make):
    """Texts of distinct words whose last m differ: exactly four fifths of 9 to 297 shingles are shared."""
    rows, pairs = [], 0
    for n, m in ((12, 1), (30, 3), (93, 10), (300, 33)):
        for _ in range(100):
            words = [f"p{pairs}w{i}" for i in range(n)]
            rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(words[:-m] + [w + "x" for w in words[-m:]]))]
            pairs += 1
    gone = {r.doc_id: r.component_id for r in near_dups.near_duplicates(make(rows), words=4, percent=80).where("not kept").collect()}
    assert all(i == c + 1 and i % 2 for i, c in gone.items()) and len(gone) >= 0.99 * pairs


def test_near_duplicates_beyond_the_first_of_a_band(make, monkeypatch):
    """Copies of one text with few or many changes; which ones link does not follow from the least id."""
    rng = np.random.default_rng(11)
    base = [f"v{i}" for i in range(90)]
    rows = []
    for i in range(140):
        words = list(base)
        for k in rng.integers(0, 90, int(rng.integers(0, 9))):
            words[k] = f"w{rng.integers(0, 40)}"
        rows.append((int(i), " ".join(words[: int(rng.integers(80, 91))])))
    rows += [(200 + i, " ".join(base[45:] + [f"u{i}"] * int(rng.integers(1, 4)) + [f"z{k}" for k in range(i // 3, 40)])) for i in range(30)]
    want = brute.near_duplicates(rows, 4, 80)
    assert len({c for _, c, _ in want.values()}) > 5
    assert by_id(near_dups.near_duplicates(make(rows), 4, 80)) == want


def test_near_duplicates_odd_rows(make, empty_docs):
    assert near_dups.near_duplicates(empty_docs).count() == 0
    text = "some words that fill a text with more than five of them"
    found = near_dups.near_duplicates(make([(None, text), (None, text), (5, text), (5, text), (9, text), (7, None)]))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(None, 8, None, True)] * 2 + [(5, 8, 5, True)] * 2 + [(9, 8, 5, False), (7, 0, 7, True)], key=repr)


def test_estimate_is_corrected():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 30000).astype(np.uint64) * np.uint64(2))
    for share in (0.0, 0.5, 0.8, 1.0):
        n = 4000
        both = int(2 * n * share / (1 + share))
        a, b = np.sort(pool[:n]), np.sort(np.r_[pool[:both], pool[n : 2 * n - both]])
        ra, rb = near_dups.sketch(a)[None], near_dups.sketch(b)[None]
        got = near_dups.similarity_estimate(ra, rb, np.array([n]), np.array([n]))[0]
        assert abs(got - share) <= 5 * max(0.02, np.sqrt(share * (1 - share) / near_dups.BUCKETS))


def test_registers_hold_zeros_and_mantissa():
    rest = np.array([1, 3, 5, (1 << 56) + 12345, (1 << 57) - 1, 0], np.uint64)
    got = near_dups.sketch(np.sort(rest | (np.arange(6, dtype=np.uint64) << np.uint64(57))))[:6].astype(int)
    for value, register in zip(rest.tolist(), got, strict=True):
        bits = value.bit_length()
        top = (value << 10 >> max(0, bits - 1) if bits - 1 <= 10 else value >> (bits - 11)) & 1023 if value else 0
        assert register >> 10 == 57 - bits and (register & 1023) == top


@pytest.mark.parametrize(("joint", "hot"), [(200, 3000), (2, 3000), (1, 1)])
def test_substrings(spark, hand_docs, hand_rows, small, small_docs, monkeypatch, joint, hot):
    monkeypatch.setattr(substring_dedup, "JOINT", joint)
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "CHUNK", 3 if hot == 1 else 256)
    for docs, rows, n in ((hand_docs, hand_rows, 12), (small_docs, small, 50)):
        found = substring_dedup.deduplicate(docs, n)[0]
        assert sorted(map(tuple, found.collect()), key=repr) == brute.substrings(rows, n)


def test_substrings_odd_rows(make, empty_docs, hand_rows):
    assert substring_dedup.deduplicate(empty_docs, 5)[0].count() == 0
    rows = [*hand_rows, *hand_rows[:9], (None, hand_rows[0][1]), (None, None), (100, "another text " * 9), (3, hand_rows[0][1])]
    found = substring_dedup.deduplicate(make(rows), 8)[0]
    assert sorted(map(tuple, found.collect()), key=repr) == brute.substrings(rows, 8)


def test_changed_texts(hand_docs, hand_rows):
    want = {r[0]: r[3] for r in brute.substrings(hand_rows, 12)}
    changed = substring_dedup.deduplicate(hand_docs, 12)[1].collect()
    assert changed and all(brute.sha(r.kept) == want[r.doc_id] for r in changed)


def test_automaton_knows_all_substrings():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 3, int(rng.integers(1, 30))).tolist() for _ in range(30)]
    automaton = substring_dedup.SuffixAutomaton()
    for k, text in enumerate(texts):
        for n in (1, 3, 6):
            held = {tuple(t[i : i + n]) for t in texts[:k] for i in range(len(t) - n + 1)}
            assert automaton.matches(text, n) == [i for i in range(len(text) - n + 1) if tuple(text[i : i + n]) in held]
        automaton.add(text)


def test_lines_by_hand(spark, hand_docs, hand_rows):
    found = line_dedup.deduplicate(hand_docs)
    assert found.columns == [*hand_docs.columns, "n_lines", "n_removed"]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in found.collect()}
    assert got == brute.lines(hand_rows, brute.similar_lines(spark, hand_rows))


def test_lines_query(spark, sf, small):
    want = brute.lines(small, brute.similar_lines(spark, small))
    got = by_id(QUERIES["op10_line_dedup"](spark, sf))
    assert got == {i: (n, k, brute.sha(t or "")) for i, (n, k, t) in want.items()}


def test_similar_lines_keep_one(make):
    line = " ".join(f"word{i}" for i in range(150))
    rows = [(2, "top\n" + line), (1, line.replace("word70", "other") + "\nend"), (3, line.upper()), (4, line.replace("word9 ", "w ") + "\ntop")]
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(make(rows)).collect()}
    assert got[1].endswith("end") and got[2] == "top" and got[3] == "" and got[4] == ""


def test_lines_meet_and_are_verified_in_rounds(spark, sf, small, monkeypatch):
    labels, rounds, plain, verified = [], [], line_dedup.written, line_dedup._verified
    monkeypatch.setattr(line_dedup, "written", lambda df, label: (labels.append(label), plain(df, label))[1])
    monkeypatch.setattr(line_dedup, "ROUND_PAIRS", 4, raising=False)
    monkeypatch.setattr(line_dedup, "_verified", lambda *a: (rounds.append(1), verified(*a))[1])
    want = brute.lines(small, brute.similar_lines(spark, small))
    got = by_id(QUERIES["op10_line_dedup"](spark, sf))
    assert got == {i: (n, k, brute.sha(t or "")) for i, (n, k, t) in want.items()}
    assert labels.count("line-pairs") > line_dedup.ROUNDS and len(rounds) > 2


@pytest.mark.parametrize("n_chars", [990, 1010, 4000])
def test_long_similar_lines(make, n_chars):
    """Lines around the length at which equal beginnings and ends are taken off first, a word left out so that the words shift."""
    words = [f"w{i * 7919 % 10007}" for i in range(n_chars // 5)]
    line = " ".join(words)[:n_chars]
    near, far = line.replace(words[40] + " ", "", 1), " ".join(reversed(line.split(" ")))
    got = {r.doc_id: r.n_removed for r in line_dedup.deduplicate(make([(1, line), (2, near), (3, far)])).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_lines_against_edit_distance_alone(spark, sf, small):
    """Nine in ten of the lines that plain edit distance removes go, and no other ones."""
    every = brute.lines(small, brute.similar_lines(spark, small, candidates=False))
    ruled = brute.lines(small, brute.similar_lines(spark, small))
    copies = brute.lines(small, {x: i for i, x in enumerate(sorted({brute.normal_line(y) for _, t in small for y in (t or "").split("\n")} - {""}))})
    lost = sum(n for _, n, _ in every.values()) - sum(n for _, n, _ in ruled.values())
    assert 0 <= lost <= 0.1 * (sum(n for _, n, _ in every.values()) - sum(n for _, n, _ in copies.values()))


@pytest.mark.parametrize(("n_words", "least"), [(1, 1), (3, 1), (4, 1), (9, 0.97), (20, 0.97), (27, 0.97), (57, 0.97)])
def test_recall_of_similar_lines(make, n_words, least):
    """Pairs of lines with as many edits as a tenth allows: in one word, and (for short lines) anywhere."""
    rng = np.random.default_rng(n_words)
    word = lambda n: "".join(chr(97 + int(k)) for k in rng.integers(0, 26, n))
    rows, n = [], 100
    for i in range(n):
        words = [word(int(rng.integers(4, 10)) if n_words > 1 else 12) for _ in range(n_words)]
        line = " ".join(words)
        if len(line) < 40:
            other = list(line)
            for k in rng.choice(len(line), len(line) // 10, replace=False):
                other[k] = ["", "Q", other[k] + "z"][int(rng.integers(0, 3))]
            other = "".join(other).lower()
        else:
            k = int(rng.integers(0, n_words))
            words[k] = words[k][:1] + word(min(len(words[k]) - 1, len(line) // 10)) + words[k][1 + min(len(words[k]) - 1, len(line) // 10):]
            other = " ".join(words)
        line, other = brute.normal_line(line), brute.normal_line(other)
        if line != other and brute.edit_distance(line, other) <= max(len(line), len(other)) // 10:
            rows += [(2 * i, line), (2 * i + 1, other)]
    assert len(rows) > n
    gone = {r.doc_id for r in line_dedup.deduplicate(make(rows)).where("n_removed > 0").select("doc_id").collect()}
    assert all(i % 2 for i in gone) and len(gone) >= least * len(rows) / 2


def test_copies_of_line_dedup_go(spark, make, tmp_path, monkeypatch):
    """Of all that line dedup stores, only which lines go is left when it returns."""
    from gaugeworks import session

    monkeypatch.setattr(session, "scratch_folder", lambda spark: str(tmp_path))
    line = " ".join(f"word{i}" for i in range(60))
    found = line_dedup.deduplicate(make([(1, line), (2, line + " x")]))
    assert [p.name.split("-")[:2] for p in tmp_path.iterdir()] == [["line", "flags"]]
    assert {r.doc_id: r.n_removed for r in found.collect()} == {1: 0, 2: 1}


def test_lines_odd_rows(make, empty_docs):
    assert line_dedup.deduplicate(empty_docs).count() == 0
    rows = [(None, "a b\nc d"), (1, "a b\na b"), (1, "a b\na b"), (2, None), (3, "\n\n"), (None, "only here\nonly here")]
    got = line_dedup.deduplicate(make(rows)).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, "c d", 2, 1), (1, "a b", 2, 1), (1, "a b", 2, 1), (2, None, 0, 0), (3, "\n\n", 3, 0), (None, "only here", 2, 1)], key=repr)


VECTORS = [
    (9, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 1), (7, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (8, [1.0, 0.05, 0.0], 1),
    (2, [0.0, 0.0, 0.0], 1), (1, None, 1), (5, [1.0, None, 0.0], 1), (6, [float("nan"), 1.0, 0.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], None),
    (12, [float("inf"), 0.0, 1.0], 1), (13, [-1.0, 0.0, 0.0], 1), (14, [1.0, 0.0], 1), (15, [1e300, 1e300, 0.0], 1), (16, [1e-300, 1e-300, 0.0], 1),
]


def vector_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", *(F.lit("clash").alias(c) for c in ("id", "vector", "node", "weight", "keys", "key", "digest", "links", "root")))


def test_vectors_by_hand(spark):
    assert by_id(embedding_dups.near_duplicates(vector_table(spark, VECTORS)), "vec_id") == brute.vectors([v for v in VECTORS if v[0] < 15], 0.98) | {
        15: (1, 15, True), 16: (1, 15, False)}
    assert embedding_dups.near_duplicates(vector_table(spark, [])).count() == 0


@pytest.mark.parametrize("tile", [1024, 7])
def test_vectors_in_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dups, "TILE", tile)
    rng = np.random.default_rng(8)
    rows = []
    for centre in rng.normal(size=(6, 48)):
        for _ in range(30):
            rows.append((len(rows), (centre + rng.normal(size=48) * 0.11).tolist(), int(rng.integers(0, 2))))
    rows += [(len(rows) + k, rows[k][1], rows[k][2]) for k in range(0, 100, 9)]
    rows = [(i * 17 % 509, v, x) for i, v, x in rows]
    assert by_id(embedding_dups.near_duplicates(vector_table(spark, rows)), "vec_id") == brute.vectors(rows, 0.98)


def test_vectors_with_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (2, None, 1)]
    got = sorted(map(tuple, embedding_dups.near_duplicates(vector_table(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, True), (2, 2, 1, False), (2, 0, 2, True)], key=repr)


@pytest.mark.parametrize("size", [64, 300, 768])
def test_recall_of_vectors_at_the_threshold(spark, size):
    rng, pairs, cosine = np.random.default_rng(size), 400, 0.9801
    a, b = rng.normal(size=(2, pairs, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    near = cosine * a + (1 - cosine**2) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)
    rows = [(2 * i + k, v[i].tolist(), 1) for i in range(pairs) for k, v in enumerate((a, near))]
    found = embedding_dups.near_duplicates(vector_table(spark, rows)).where("n_links > 0").collect()
    assert all(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in found) and len(found) >= 0.99 * 2 * pairs


def test_vectors_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert by_id(QUERIES["op5_embedding_dedup"](spark, sf), "vec_id") == brute.vectors(rows, 0.98)


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(40)] + [(100 + int(a), 100 + int(b)) for a, b in rng.integers(0, 60, (35, 2))] + [(300, k) for k in range(301, 340)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.roots(400, links)
    assert found == {n: want[n] for n in {x for a, b in links if a != b for x in (a, b)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0

"""Language ID, the language model, decontamination and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm import decontaminate, language_id, lm
from gaugeworks.llm.catalogue import QUERIES, SQL, fold
from tests.llm import brute
from tools.check import connect, rows

ITEMS = [(1, "Which of these seven rivers carries the most water to the sea in a dry year?"), (2, "yes"), (3, ""), (4, None), (None, "one two three"),
         (5, "one two"), (6, " ".join(f"w{i}" for i in range(20, 45))), (7, "-- !!"), (8, "Überall liegt SCHNEE"), (2, "yes")]


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("item", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("window", F.lit(""))


def test_decontamination_by_hand(spark, make, hand_rows):
    rows = [*hand_rows, hand_rows[0], hand_rows[12], (None, "say yes"), (None, None), (100, "a yes, no")]
    found = decontaminate.contamination(make(rows), items_table(spark, ITEMS))
    assert sorted(map(tuple, found.collect()), key=repr) == brute.contamination(rows, ITEMS)


def test_decontamination_of_empty_tables(spark, hand_docs, empty_docs):
    found = decontaminate.contamination(hand_docs, items_table(spark, []))
    assert found.count() == hand_docs.count() and found.where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert decontaminate.contamination(empty_docs, items_table(spark, ITEMS)).count() == 0


def test_decontamination_query(spark, sf, small):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op4_decontaminate"](spark, sf).collect()), key=repr) == brute.contamination(small, items)


def test_native_operators_run_no_python(spark, hand_docs):
    for df in (decontaminate.contamination(hand_docs, items_table(spark, ITEMS)),):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize(("plain_scan", "most"), [(True, 1 << 20), (True, 5000), (False, 1 << 20), (False, 300)])
def test_language_model(spark, sf, small, small_docs, hand_docs, hand_rows, plain_scan, most, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 16)
    monkeypatch.setattr(lm, "BLOCK_BYTES", most)
    monkeypatch.setattr(lm, "SHARD_ROWS", 10)
    docs, rows = (small_docs, small) if plain_scan else (hand_docs, hand_rows)
    found = lm.score(docs, fold(F.col("doc_id"), 5) != 1).collect()
    rows = sorted(rows)
    whole, scores = brute.language_model(rows, lambda i: brute.fold(i, 5) != 1)
    found.sort(key=lambda r: r.doc_id)
    assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in found] == whole
    for r, (base, score) in zip(found, scores, strict=True):
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_language_model_query_beats_unigrams(spark, sf):
    rows = QUERIES["op6_lm_score"](spark, sf).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_odd_rows(make, empty_docs):
    assert lm.score(empty_docs, F.lit(True)).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "a"), (2, None), (3, "")]
    found = lm.score(make(rows), F.when(F.col("doc_id") != 2, True)).collect()
    assert sorted(r.n_tokens for r in found) == [1, 1, 2, 3, 3] and {r.train_tokens for r in found} == {3 + 3 + 1}
    untrained = lm.score(make(rows), F.lit(False)).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in untrained)


def test_blocks_are_closed_by_bytes(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(lm, "BLOCK_BYTES", 10)
    texts = ["aaaa", "bbbb", "cccc", None, "d" * 30, "e", "f", "gggg", "h"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "train": [True] * 9, "file": ["x"] * 9, "block": [0] * 7 + [1] * 2, "row": list(range(9))})
    asked = pa.Table.from_batches(lm._ask(1)(iter([batch.slice(0, 2), batch.slice(2)])))
    assert list(zip(asked["first"].to_pylist(), asked["last"].to_pylist())) == [(0, 1), (2, 3), (4, 4), (5, 6), (7, 8)]


def test_arcs_of_each_state_sum_to_one(spark, make):
    """The discounted arcs and the failure arc of a state leave no weight over."""
    texts = ["a b a c a b", "b a c"]
    import pyarrow as pa
    part = lm.Part.of(pa.array(texts))
    state_n, arc_n = part.counts(np.array([True, True]))
    state_k = np.bincount(np.repeat(np.arange(len(part.states)), part.arcs))
    for s in range(len(part.states)):
        arcs = arc_n[part.arcs[:s].sum() : part.arcs[: s + 1].sum()]
        assert math.isclose(((arcs - 0.7) / state_n[s]).sum() + 0.7 * state_k[s] / state_n[s], 1)


def test_language_id_of_six_languages_in_one_text(make):
    """Every language that the penalised likelihood takes is found, with its share."""
    vocabularies = {f"l{k}": ["".join(letters[(i * j + j) % 6] for j in range(3, 8)) + letters[i % 6] for i in range(30)]
                    for k, letters in enumerate(["abcdef", "ghijkl", "mnopqr", "stuvwx", "àáâãäå", "бвгджз"])}
    docs = make([(k, " ".join(w)) for k, w in enumerate(vocabularies.values())]).withColumn("lang", F.concat(F.lit("l"), "doc_id"))
    model = language_id.train(docs)
    parts = {"l0": 120, "l1": 90, "l2": 60, "l3": 60, "l4": 45, "l5": 25}
    text = " ".join(vocabularies[lang][i % 30] for lang, n in parts.items() for i in range(n))
    mono = " ".join(vocabularies["l3"])
    found = {r.doc_id: r for r in language_id.predict(make([(1, text), (2, mono)]), model).collect()}
    got = {x["lang"]: x["share"] for x in found[1].languages}
    assert got.keys() == parts.keys() and all(abs(got[k] - n / 400) < 0.02 for k, n in parts.items())
    assert found[1].lang_pred == "l0" and abs(found[1].score - 0.3) < 0.02
    assert [x["lang"] for x in found[2].languages] == ["l3"]


def test_language_id_on_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("d"), "lang")
    found = QUERIES["op2_language_id"](spark, sf).join(docs, F.col("doc_id") == F.col("d")).where("held_out").collect()
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)


def test_language_id_query_against_all_subsets(spark, sf):
    """Of all sets of languages, each fitted by plain EM, the query takes the one with the best penalised likelihood."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = [r for r in docs if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    langs = sorted({r.lang for r in learned if language_id.words(r.text)})
    table = brute.trigram_model([(r.text, r.lang) for r in learned], langs)
    found = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, sf).collect()}
    assert found.keys() == {r.doc_id for r in docs}
    for r in docs:
        got = found[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        seen = Counter(language_id.words(r.text or ""))
        if not seen:
            assert (got.lang_pred, got.score, got.languages) == ("und", 0.0, [])
            continue
        sets = brute.language_sets(seen, table, langs)
        fit, shares = sets[frozenset(x.lang for x in got.languages)]
        assert fit >= max(f for f, _ in sets.values()) - 0.01, (r.doc_id, got.languages)
        # The query's EM ends at its tolerance.
        assert all(abs(x.share - shares[x.lang]) < 0.01 for x in got.languages), (r.doc_id, got.languages, shares)
        assert got.lang_pred == got.languages[0].lang and got.score == got.languages[0].share


def test_language_mixtures_match_plain_em():
    rng = np.random.default_rng(6)
    ptr = np.array([0, 40, 90, 91, 150])
    log_ratio = -rng.exponential(3, (150, 3))
    log_ratio -= log_ratio.max(axis=1, keepdims=True)
    log_ratio[40:90] = [0, -4, -6]
    count = rng.integers(1, 5, 150)
    share = language_id.mixtures(log_ratio, count, ptr, rounds=500)
    assert np.allclose(share.sum(axis=1), 1)
    for i in range(4):
        q, c = np.exp(log_ratio[ptr[i] : ptr[i + 1]]), count[ptr[i] : ptr[i + 1]]
        fit = lambda p: (c * np.log(q @ p)).sum()  # noqa: B023, E731
        single = max(fit(np.eye(3)[k]) for k in range(3))
        kept = (share[i] > 0).sum()
        assert fit(share[i]) >= single - 1e-6
        p = np.where(share[i] > 0, 1 / kept, 0)
        for _ in range(2000):
            r = p * q
            p = (r / r.sum(axis=1, keepdims=True) * c[:, None]).sum(axis=0) / c.sum()
        assert fit(p) - fit(share[i]) < 0.05 * max(1, abs(fit(p)))
    assert (share[1] > 0).sum() == 1


def test_language_id_finds_a_mixture(spark, small_docs):
    model = language_id.train(small_docs)
    texts = {r.lang: r.text for r in small_docs.where("length(text) between 800 and 3000 and lang in ('en', 'de')").select("lang", "text").collect()}
    mixed = spark.createDataFrame([(1, texts["en"] + " " + texts["de"])], "doc_id long, text string")
    found = language_id.predict(mixed, model).first()
    assert {x.lang for x in found.languages} >= {"en", "de"} and abs(sum(x.share for x in found.languages) - 1) < 1e-6


def test_language_id_odd_rows(hand_docs, empty_docs, make):
    model = language_id.train(hand_docs)
    rows = [(1, None), (2, ""), (3, "12 34 -- !!"), (None, "the river bank"), (None, None), (4, "é" * 100000)]
    found = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in language_id.predict(make(rows), model).collect()}
    assert found == {(1, True, True), (2, True, True), (3, True, True), (None, False, False), (None, True, True), (4, False, False)}
    nothing = language_id.train(empty_docs)
    assert {r.lang_pred for r in language_id.predict(make(rows), nothing).collect()} == {"und"}
    assert language_id.predict(empty_docs, model).count() == 0 and language_id.annotate(empty_docs, model).count() == 0
    kept = language_id.annotate(make(rows), model)
    assert kept.columns == hand_docs.columns and kept.count() == len(rows)


def test_pipeline_stages_against_brute_force(spark, sf, small, small_docs):
    from pyspark.sql import DataFrame

    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs: DataFrame = small_docs
    texts = dict(small)
    stages = dict(corpus_pipeline.STAGES)

    docs = _stored(stages["language"](spark, docs, sf))
    texts = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    assert _texts(docs) == texts and docs.columns == small_docs.columns

    lines = brute.lines(list(texts.items()), brute.similar_lines(spark, list(texts.items())))
    docs = _stored(stages["line_dedup"](spark, docs, sf))
    texts = {i: t for i, (_, gone, t) in lines.items() if not gone or t.strip()}
    assert _texts(docs) == texts and docs.columns == small_docs.columns
    assert docs.where("n_chars <> length(text)").count() == 0

    near = brute.near_duplicates(list(texts.items()), 5, 80)
    docs = _stored(stages["near_dedup"](spark, docs, sf))
    texts = {i: t for i, t in texts.items() if near[i][2]}
    assert _texts(docs) == texts and docs.columns == small_docs.columns

    hit = {r[0] for r in brute.contamination(list(texts.items()), items) if r[-1]}
    docs = _stored(stages["decontamination"](spark, docs, sf))
    texts = {i: t for i, t in texts.items() if i not in hit}
    assert _texts(docs) == texts and docs.columns == small_docs.columns

    last = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.decoded_sha256 for r in last} == {i: brute.sha(t) for i, t in texts.items()}


def test_pipeline_stages_on_odd_rows(spark, sf, make, empty_docs, hand_rows):
    odd = make([*hand_rows, (None, "the river bank is wide"), (None, None), hand_rows[0]])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_docs, sf).count() == 0
        assert stage(spark, odd, sf).count() > 0, name


def _stored(df):
    from gaugeworks.session import written

    return written(df, "test-stage")


def _texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", ["op1_minhash_dedup", "op3_substring_dedup", "op4_decontaminate", "op5_embedding_dedup"])
def test_twins(spark, sf, name):
    df = QUERIES[name](spark, sf)
    cursor = connect(sf).execute(SQL[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in cursor.description], cursor.fetchall())

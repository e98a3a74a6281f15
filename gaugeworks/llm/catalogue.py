"""The operators of this subpackage as named queries over the test tables, with SQL twins where SQL can state them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    alignment,
    byte_bpe,
    decontaminate,
    embedding_dups,
    importance,
    language_id,
    line_dedup,
    lm,
    near_dups,
    substring_dedup,
    token_counts,
    token_files,
    warc,
)
from gaugeworks.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    found = language_id.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"), 50)[0]


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    found = lm.score(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from uuid import uuid4

    folder = f"{scratch_folder(spark)}/tokens-{uuid4().hex}"
    manifest = token_files.write_shards(table(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"),
                                        end_id=1, by_words=True)
    return token_files.read_shards(spark, manifest)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), 4096)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20,
                                n=1, buckets=10_000, seed=2024, keep=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from uuid import uuid4

    folder = f"{scratch_folder(spark)}/warc-{uuid4().hex}"
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder, least=1000)
    found = warc.read_archives(spark, manifest)
    return found.select(F.col("record_id").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").try_cast("long").alias("refers_to"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))[0]


QUERIES = {
    f.__name__: f
    for f in (op1_minhash_dedup, op2_language_id, op3_substring_dedup, op4_decontaminate, op5_embedding_dedup, op6_lm_score,
              op7_byte_bpe, op8_token_files, op9_token_counts, op10_line_dedup, op11_importance_resampling, op12_warc, op13_token_alignment)
}

# The table of crc32 by its polynomial, and the checksum of each distinct word by its bytes.
IMPORTANCE_SQL = """with tab as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) t),
raw as (
  select 'd' side, doc_id id, coalesce(text, '') as "text" from documents
  union all select 'b', item_id, coalesce(text, '') from benchmark),
listed as (
  select side, id, regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') words from raw),
used as (select side, id, w, count(*) n from (select side, id, unnest(words) w from listed) group by all),
coded as (
  select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(w)) * 2, 2),
      lambda i: strpos('0123456789ABCDEF', substr(hex(encode(w)), i, 1)) * 16 + strpos('0123456789ABCDEF', substr(hex(encode(w)), i + 1, 1)) - 17)),
    lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 bucket
  from (select distinct w from used), tab),
counts as (
  select bucket, sum(case when side = 'd' then n else 0 end) s, sum(case when side = 'b' then n else 0 end) t
  from used join coded using (w) group by 1),
totals as (select sum(s) all_s, sum(t) all_t from counts),
gains as (
  select bucket, floor(1000 * ln(cast((t + 1) * (all_s + 10000) as double) / cast((s + 1) * (all_t + 10000) as double))) gain
  from counts, totals),
heavy as (
  select id, cast(floor(sum(n * gain) / sum(n)) as bigint) weight from used join coded using (w) join gains using (bucket)
  where side = 'd' group by 1),
scored as (
  select id doc_id, len(words) n_features, coalesce(weight, 0) weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
      (list_reduce(list_transform(range(1, 9), lambda i: strpos('0123456789abcdef', substr(sha256('2024:' || id), i, 1)) - 1),
        lambda a, d: a * 16 + d) + 0.5::double) / 4294967296))) as bigint) score
  from listed left join heavy using (id) where side = 'd'),
placed as (
  select doc_id, row_number() over (order by score desc, doc_id) place, count(*) over () n from scored where n_features >= 20)
select doc_id, cast(n_features as bigint) n_features, weight, score,
  case when place <= 10 * n // 100 then place end as "rank"
from scored left join placed using (doc_id)"""

WARC_SQL = """with p as (select page_id, coalesce(html, '') payload from pages),
f as (select *, octet_length(encode(payload)) size, max(page_id) over (partition by payload) largest from p)
select page_id, cast(size as bigint) payload_bytes, sha1(payload) payload_digest,
  case when size >= 1000 and page_id <> largest then 'revisit' else 'response' end record_type,
  case when size >= 1000 and page_id <> largest then largest end refers_to
from f"""

DECONTAMINATION_SQL = """with d as (
  select doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
sized as (select item_id, w, least(10, len(w)) size from b where len(w) > 0),
item_windows as (
  select distinct item_id, size, array_to_string(w[p + 1 : p + size], ' ') win
  from (select *, unnest(range(0, len(w) - size + 1)) p from sized)),
doc_windows as (
  select doc_id, p, size, array_to_string(w[p + 1 : p + size], ' ') win
  from (select doc_id, w, size, unnest(range(0, len(w) - size + 1)) p from d, (select distinct size from item_windows) where len(w) >= size)),
met as (select doc_id, p, size, item_id from doc_windows join item_windows using (size, win)),
words as (select doc_id, count(distinct spot) n from (select doc_id, unnest(range(p, p + size)) spot from met) group by 1),
items as (
  select doc_id, count(*) n, string_agg(item_id, ',' order by item_id) ids
  from (select distinct doc_id, cast(item_id as varchar) item_id from met) group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(words.n, 0) as bigint) n_hit, cast(coalesce(items.n, 0) as bigint) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(words.n, 0) > 0 contaminated
from d left join words using (doc_id) left join items using (doc_id)"""

_LOWERED = "translate(coalesce(\"text\", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Components of the pairs (a, b) of a table called links.
_GROUPS = """both_ways as (select a, b from links union all select b, a from links),
reach as (select a, a b from both_ways union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
groups as (select a, min(b) component from reach group by 1)"""

NEAR_DUPLICATES_SQL = f"""with recursive d as (
  select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') w from documents),
s as (
  select distinct doc_id, array_to_string(w[p + 1 : p + 4], ' ') shingle
  from (select doc_id, w, unnest(range(0, greatest(len(w) - 3, 1))) p from d where len(w) > 0)),
sizes as (select doc_id, count(*) n from s group by 1),
met as (
  select x.doc_id a, y.doc_id b, count(*) n from s x join s y on x.shingle = y.shingle and x.doc_id < y.doc_id group by 1, 2),
links as (
  select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * met.n >= 80 * (x.n + y.n - met.n)),
{_GROUPS}
select d.doc_id, coalesce(n, 0) n_shingles, coalesce(component, d.doc_id) component_id, coalesce(component, d.doc_id) = d.doc_id kept
from d left join sizes using (doc_id) left join groups on a = d.doc_id"""

SUBSTRINGS_SQL = """with d as (select doc_id, regexp_extract_all(coalesce("text", ''), '[^\\x20\\x09-\\x0D]+') w from documents),
windows as (
  select doc_id, p, sha256(array_to_string(w[p + 1 : p + 50], ' ')) win
  from (select doc_id, w, unnest(range(0, len(w) - 49)) p from d where len(w) >= 50)),
firsts as (select win, min(doc_id) least from windows group by 1),
gone as (
  select distinct doc_id, unnest(range(p, p + 50)) spot from windows join firsts using (win) where least < doc_id),
words as (select doc_id, unnest(w) word, unnest(range(0, len(w))) spot from d),
kept as (
  select doc_id, count(*) n, string_agg(word, ' ' order by spot) words
  from words anti join gone using (doc_id, spot) group by 1)
select d.doc_id, len(w) n_words, len(w) - coalesce(n, 0) n_removed, sha256(coalesce(words, '')) kept_sha256
from d left join kept using (doc_id)"""

VECTORS_SQL = f"""with recursive v as (select vec_id, label, cast(embedding as double[]) e from embeddings),
used as materialized (
  select vec_id, label, e from v
  where label is not null and len(e) > 0 and list_count(e) = len(e) and len(list_filter(e, lambda x: not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select x.vec_id a, y.vec_id b from used x join used y on x.label = y.label and x.vec_id < y.vec_id and len(x.e) = len(y.e)
  where list_cosine_similarity(x.e, y.e) >= 0.98),
{_GROUPS},
counts as (select a, count(*) n from both_ways group by 1)
select vec_id, coalesce(n, 0) n_links, coalesce(component, vec_id) component_id, coalesce(component, vec_id) = vec_id kept
from v left join groups on groups.a = vec_id left join counts on counts.a = vec_id"""

#: Twins of the operators that SQL can state; tests hold the others against brute force.
SQL: dict[str, str] = {
    "op1_minhash_dedup": NEAR_DUPLICATES_SQL, "op3_substring_dedup": SUBSTRINGS_SQL, "op4_decontaminate": DECONTAMINATION_SQL,
    "op5_embedding_dedup": VECTORS_SQL, "op11_importance_resampling": IMPORTANCE_SQL, "op12_warc": WARC_SQL}

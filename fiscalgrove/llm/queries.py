"""The queries of this package, and the SQL that checks them where SQL can say what they do."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalgrove.llm import chat, decontaminate, hilbert, licenses, lm, mixing, negatives, periodic, pii, quality, simhash, substrings, tokencount
from fiscalgrove.llm.shared import let, table, words_of


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hostile = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_chats(rows, public_tokenizers.path("byte_bpe_50k.json")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, totals = mixing.mix(table(spark, sf_dir, "documents"))
    return totals.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.deduplicated(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return rows.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op11_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.assign(table(spark, sf_dir, "documents"), ("lang", "source", "size"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; in the documents that the checksum of the id chooses, the words from one on repeat. A null id chooses none."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w).cast("long")
        first = g % n
        period = 1 + F.floor((n - first) / (3 + g % 8))
        places = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < first, i).otherwise(first + (i - first) % period))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.element_at(w, (i + 1).cast("int"))), " ")).otherwise("")

    text = F.col("text").cast("string")
    return docs.select("doc_id", F.when(h % 10 == 0, let(words_of(text), repeated)).otherwise(text).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic.find_runs(with_repeats(table(spark, sf_dir, "documents"))))


def run_digests(found: DataFrame) -> DataFrame:
    """found: of periodic.find_runs. The longest run (of equal ones the first, then that of the least period) and digests."""
    first = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    longest = found.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, first).alias("first"), F.sha2(lines, 256).alias("runs_sha256"))
    return longest.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("first.start").alias("start"), (-F.col("first.l")).alias("length"), F.col("first.period").alias("period"),
                          F.floor(-1000 * F.col("first.l") / F.col("first.period")).alias("exponent_milli"), "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, "vec_id", "embedding", label=changed)


QUERIES = {q.__name__: q for q in (
    op1_chat_format, op2_license_scan, op3_simhash, op4_mix, op5_quality, op6_substrings, op7_decontaminate, op8_lm_scores, op9_token_counts, op10_personal_data,
    op11_hilbert, op12_periodic_runs, op13_hard_negatives)}

SQL: dict[str, str] = {
    "op1_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select *, regexp_replace(text, '([<\[])(\\*)((?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|s>|/s>|unk>|INST\]|/INST\]|SYS>>|/SYS>>))', '\1\\\2\3', 'g') as written,
    role as role_written from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(12 + length(role_written) + 1 + length(written) + 10 + 1) as bigint) as formatted_chars
from e group by conv_id""",
    "op7_decontaminate": r"""
with d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
p as (
  select distinct item_id, least(10, len(w)) as m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as pattern
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
pos as (
  select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as pattern
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, (select distinct m from p) where len(w) >= m)),
f as (select pos.doc_id, pos.i, pos.m, p.item_id from pos join p on pos.m = p.m and pos.pattern = p.pattern),
h as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i + m)) as x from f) group by doc_id),
n as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from f) group by doc_id)
select d.doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join h on d.doc_id = h.doc_id left join n on d.doc_id = n.doc_id""",
    "op11_hilbert": f"""
with crc as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as crc_steps),
d as (
  select doc_id, lang, source, strlen(coalesce(text, '')) + 1 as size,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: cast('0x' || x as bigint))),
      lambda c, x: xor(c >> 8, crc_steps[(xor(c, x) & 255) + 1]))) as crc
  from documents, crc),
cells as (
  select *, (rank() over (order by lang nulls first) - 1) * 256 // count(*) over () as c0, (rank() over (order by source nulls first) - 1) * 256 // count(*) over () as c1,
    (rank() over (order by size) - 1) * 256 // count(*) over () as c2 from d),
curve as (
  select *, list_reduce(list_prepend(0, list_transform(range(7, -1, -1), lambda i: ((c0 >> i) & 1) + 2 * ((c1 >> i) & 1) + 4 * ((c2 >> i) & 1))),
    lambda acc, digit: ((acc // 24) * 8 + {hilbert.curve_steps(3)[1]}[(acc % 24) * 8 + digit + 1] % 8) * 24 + {hilbert.curve_steps(3)[1]}[(acc % 24) * 8 + digit + 1] // 8) // 24 as place from cells),
runs as (
  select *, sum(size) over (order by place, crc, doc_id rows unbounded preceding) as until, row_number() over (order by place, crc, doc_id) as number, sum(size) over () as total from curve),
cut as (select *, least(15, (2 * until - size) * 16 // (2 * total)) as shard from runs)
select doc_id, cast(size as bigint) as size, cast(crc as bigint) as text_crc32, 'bytes' as law, cast(shard as integer) as shard,
  cast(number - min(number) over (partition by shard) as bigint) as slot, cast(null as integer) as grown_shard from cut""",
    "op13_hard_negatives": """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
  from e as a join e as b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, id, score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
  select p.anchor_id, p.id as positive_id, row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as rank, s.id as negative_id, p.score as positive_score, s.score as negative_score
  from p join s on p.anchor_id = s.anchor_id and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5""",
}

"""Registered queries of the operators: (spark, sf_dir) -> DataFrame, and the
DuckDB SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import bpe, collocations, exact_dedup, hard_negatives, html_extract, near_dedup, packing, pii, preference, quality, suffix_dedup, topk, toxicity
from pitwall.llm.shared import documents, held_out

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    digest, spans = F.sha2(_spans_text(base).cast("binary"), 256), _spans_text(F.col("spans"))
    return found.select("doc_id", *counts, digest.alias("base_sha256"), spans.alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, ["doc_id", "held_out"])


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = preference.format_pairs(preference.pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    ranges = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return made.select("pair_id", "prompt_turns", "prompt", "chosen", ranges("chosen_mask").alias("chosen_mask"), "rejected", ranges("rejected_mask").alias("rejected_mask"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "group_size", "kept")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), BYTE_BPE, digests=True)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, ["doc_id", "held_out"])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), digest=True)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(packing.pack(documents(spark, sf_dir), WORD_BPE))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id = F.col("vec_id")
    label = F.when(F.coalesce(vec_id % 7 == 0, F.lit(False)), (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), vec_id % 50 == 0, label)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pii, op2_topk, op3_exact_dedup, op4_toxicity, op5_preference, op6_near_dedup, op7_bpe, op8_quality, op9_suffix_dedup, op10_packing, op11_hard_negatives, op12_collocations, op13_html_extract)
}

ORACLE: dict[str, str] = {
    "op2_topk": """
with v as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
), s as (
  select q.rid, q.vec_id as query_id, r.vec_id,
    cast(coalesce(list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2])), 0) as bigint) as score
  from v q join v r on q.vec_id % 20 = 0 and q.rid <> r.rid
)
select query_id, cast(row_number() over (partition by rid order by score desc, vec_id nulls last) as integer) as rank, vec_id, score
from s qualify rank <= 20
""",
    "op3_exact_dedup": """
with t as (
  select doc_id, length(coalesce(text, '')) as points,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as text_sha256
  from documents
)
select doc_id, first_value(doc_id) over w as keep_id, cast(count(*) over (partition by text_sha256) as bigint) as group_size,
  row_number() over w = 1 as kept, text_sha256
from t window w as (partition by text_sha256 order by points desc, doc_id nulls last)
""",
    "op5_preference": """
with t as (
  select conv_id, coalesce(role, 'unknown') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, 'unknown'), coalesce(text, '')) as pos
  from conversations where conv_id is not null
), d as (
  select conv_id, pos, text, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as rendered from t
), l as (
  select conv_id, count(*) as n, max(pos) filter (role = 'assistant') as last from t group by conv_id
), reply as (
  select t.conv_id, t.text from t join l on t.conv_id = l.conv_id and t.pos = l.last
), p as (
  select l.conv_id, c.text as chosen_text, r.text as rejected_text,
    case when l.last is null then l.n when r.conv_id is not null and c.text = r.text then l.last else l.last - 1 end as k,
    l.last is not null and (r.conv_id is null or c.text <> r.text) as differ
  from l left join reply c on c.conv_id = l.conv_id left join reply r on r.conv_id = xor(l.conv_id, 1)
), m as (
  select p.conv_id, string_agg(rendered, '' order by pos) filter (pos <= k) as prompt, string_agg(rendered, '' order by pos) filter (pos > k) as chosen
  from p join d on d.conv_id = p.conv_id group by p.conv_id
)
select p.conv_id as pair_id, cast(k as integer) as prompt_turns, coalesce(prompt, '') as prompt, coalesce(chosen, '') as chosen,
  case when differ then '14:' || (length(chosen_text) + 22) else '' end as chosen_mask,
  case when differ and rejected_text is not null then '<|assistant|>' || chr(10) || rejected_text || '<|end|>' || chr(10) else '' end as rejected,
  case when differ and rejected_text is not null then '14:' || (length(rejected_text) + 22) else '' end as rejected_mask
from p join m on m.conv_id = p.conv_id
""",
    "op11_hard_negatives": """
with r as (
  select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
), s as (
  select a.rid, a.vec_id as anchor_id, a.label = c.label as same, c.vec_id,
    cast(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])), 0) as bigint) as score
  from r a join r c on a.vec_id % 50 = 0 and a.rid <> c.rid
), p as (
  select rid, anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by rid order by score desc, vec_id) as nth
  from s where same qualify nth <= 5
), n as (
  select p.rid, p.nth, anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.rid, p.nth order by s.score desc, s.vec_id) as rank
  from p join s using (rid, anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score qualify rank <= 3
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n
""",
    "op12_collocations": r"""
with p as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), w as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words from p
), s as (
  select lang, words, unnest(range(1, len(words) + 1)) as i from w
), g as (
  select lang, words[i:i + k - 1] as gram, k, count(*) as f from s, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(words) group by all having k = 1 or f >= 30
), n as (
  select lang, sum(f) as n from g where k = 1 group by lang
), c as (
  select g.lang, g.gram, g.f as a, g.k, unnest(range(1, g.k)) as cut from g where g.k > 1
), t as (
  select c.lang, c.gram, c.a, c.k, c.cut, x.f as l, y.f as r, cast((2000000 * cast(c.a as hugeint)) // (x.f + y.f) as bigint) as score
  from c join g x on x.lang = c.lang and x.gram = c.gram[1:c.cut] join g y on y.lang = c.lang and y.gram = c.gram[c.cut + 1:]
), b as (
  select * from t qualify row_number() over (partition by lang, gram order by score, cut) = 1
), o as (
  select distinct lang, sub, max(f) as longer from (
    select lang, f, unnest([gram[1:k - 1], gram[2:k]]) as sub from g where k > 2
  ) group by all
), v as (
  select b.lang, array_to_string(gram, ' ') as phrase, a, l, r, score from b left join o on o.lang = b.lang and o.sub = b.gram
  where longer is null or 100 * cast(longer as hugeint) < 80 * cast(a as hugeint)
)
select v.lang, cast(row_number() over (partition by v.lang order by score desc, a desc, phrase) as integer) as rank, phrase, a, l, r, cast(n as bigint) as n, score
from v join n on n.lang = v.lang qualify rank <= 2000
""",
}

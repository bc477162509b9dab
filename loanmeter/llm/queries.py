"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame``, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmeter.llm import (
    byte_bpe, context_mixing, html_layout, hyper_minhash, importance, line_runs, periodic_runs, prefix_forest, repetition, rule_ensemble,
    source_mixing, span_dedup, zstd_language,
)
from loanmeter.llm.shared_tables import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract_text(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = span_dedup.remaining_bytes(table(spark, sf_dir, "documents"))
    text = F.try_validate_utf8("kept") if hasattr(F, "try_validate_utf8") else F.decode("kept", "UTF-8")
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("kept_text"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = source_mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rule_ensemble.EnsembleRules()
    statistics = stored(rule_ensemble.text_statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").where(fold(4) != 2)
    model = rule_ensemble.fit(rule_ensemble.labelled_sample(statistics, labels, "quality", rules), rules)
    return statistics.select(
        "doc_id", (fold(4) == 2).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = context_mixing.text_scores(table(spark, sf_dir, "documents"), fold(10) != 0)
    return scores.select(
        "doc_id", (fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "bits_per_byte",
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_minhash.near_components(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe.read_ranks(RANKS))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = zstd_language.learn_dictionaries(docs.where(fold(3) != 1))
    found = zstd_language.identify(docs, dictionaries)
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_runs.without_lines(table(spark, sf_dir, "documents"))
    return left.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.word_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "top.start",
        (-F.col("top.less")).alias("length"),
        "top.period",
        F.expr("-1000 * top.less div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_quality_rules": op2_quality_rules,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_ann": op6_ann,
    "op7_lm_score": op7_lm_score,
    "op8_near_dedup": op8_near_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_language": op10_language,
    "op11_line_dedup": op11_line_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_importance": op13_importance,
}

ORACLE_SQL = {
    "op4_source_mixing": """
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) size,
    cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 13)) as bigint) k,
    cast(('0x' || substr(md5(coalesce(text, '')), 1, 13)) as bigint) content
  from documents),
totals as (select source, cast(sum(size) as bigint) source_size from sized group by source),
ranked as (
  select source, source_size, 3 * source_size most,
    (row_number() over (order by source nulls last) - 1) % 3 + 1 weight from totals),
levels as (
  select *, cast(sum(source_size) over () as bigint) all_words, cast(sum(weight) over () as bigint) all_weights,
    coalesce(cast(sum(most) over before as bigint), 0) most_before,
    coalesce(cast(sum(weight) over before as bigint), 0) weight_before
  from ranked window before as (order by cast(most as double) / weight, source nulls last
    rows between unbounded preceding and 1 preceding)),
capped as (
  select *, most * (all_weights - weight_before) <= weight * (all_words - most_before) is_full from levels),
targets as (
  select source, source_size, case when is_full then cast(most as double)
    else cast(weight * (all_words - cast(sum(case when is_full then most else 0 end) over () as bigint)) as double)
      / nullif(all_weights - cast(sum(case when is_full then weight else 0 end) over () as bigint), 0) end target
  from capped),
plans as (
  select *, cast(floor(target + 0.5) as bigint) budget,
    case when source_size > 0 then cast(floor(target + 0.5) as bigint) // source_size else 0 end epochs
  from targets),
placed as (
  select s.doc_id, s.size, p.source_size, p.target, p.epochs, p.budget - p.epochs * p.source_size rest,
    coalesce(cast(sum(s.size) over (partition by s.source order by s.k, s.doc_id, s.content
      rows between unbounded preceding and 1 preceding) as bigint), 0) start
  from sized s join plans p on s.source is not distinct from p.source)
select doc_id, size, source_size, target,
  cast(epochs * size + greatest(0, least(size, rest - start)) as bigint) taken from placed
""",
    "op11_line_dedup": """
with texts as (
  select row_number() over () r, doc_id, string_split(coalesce(text, ''), chr(10)) lines from documents),
numbered as (
  select r, doc_id, i, lines[i] as line,
    translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from (select r, doc_id, lines, unnest(range(1, len(lines) + 1)) i from texts)),
shared as (
  select line_key, max(doc_id) top from (select distinct r, doc_id, line_key from numbered where length(line_key) >= 40)
  group by line_key having count(*) >= 5),
marked as (
  select n.*, s.line_key is not null and n.doc_id is distinct from s.top gone
  from numbered n left join shared s on n.line_key = s.line_key)
select min(doc_id) doc_id, count(*) n_lines, cast(sum(cast(gone as int)) as bigint) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) kept_sha256
from marked group by r
""",
    "op3_suffix_dedup": """
with texts as (select row_number() over () r, doc_id, hex(encode(coalesce(text, ''))) h from documents),
starts as (
  select r, p, md5(substr(h, cast(2 * p + 1 as int), 800)) s
  from (select r, h, unnest(range(0, len(h) // 2 - 399)) p from texts)),
repeated as (select r, p from (select r, p, count(*) over (partition by s) n from starts) where n > 1),
begun as (select r, p, coalesce(p > lag(p) over w + 400, true) is_new from repeated window w as (partition by r order by p)),
runs as (
  select r, min(p) low, max(p) + 400 high
  from (select r, p, sum(cast(is_new as int)) over (partition by r order by p) nth from begun) group by r, nth),
pieces as (
  select r, low, high, coalesce(lag(high) over (partition by r order by low), 0) after from runs),
lefts as (
  select t.r, doc_id, h, count(p.r) n_spans, cast(coalesce(sum(high - low), 0) as bigint) n_removed,
    coalesce(string_agg(substr(h, cast(2 * after + 1 as int), cast(2 * (low - after) as int)), '' order by low), '')
      || substr(h, cast(2 * coalesce(max(high), 0) + 1 as int)) kept
  from texts t left join pieces p on p.r = t.r group by t.r, doc_id, h)
select doc_id, len(h) // 2 n_bytes, n_removed, n_spans, sha256(unhex(kept)) kept_sha256, try(decode(unhex(kept))) kept_text
from lefts
""",
    "op8_near_dedup": """
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') w from documents),
shingles as (
  select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else array_to_string(w[i:i+2], ' ') end sh
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) i from texts where len(w) > 0)),
sizes as (select doc_id, count(*) n from shingles group by 1),
pairs as (
  select a.doc_id a, b.doc_id b, count(*) n_both
  from shingles a join shingles b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs p join sizes s on s.doc_id = a join sizes t on t.doc_id = b
  where 100 * n_both >= 85 * (s.n + t.n - n_both)),
either as (select a, b from links union select b, a from links),
reach as (select a, b from either union select r.a, e.b from reach r join either e on r.b = e.a)
select t.doc_id, coalesce(any_value(s.n), 0) n_shingles, least(t.doc_id, coalesce(min(r.b), t.doc_id)) component_id,
  t.doc_id <= coalesce(min(r.b), t.doc_id) kept
from texts t left join sizes s on s.doc_id = t.doc_id left join reach r on r.a = t.doc_id group by t.doc_id
""",
    "op13_importance": """
with recursive crc as (
  select 0 i, range(256) t union all
  select i + 1, list_transform(t, lambda x: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) from crc where i < 8),
tab as (select t from crc where i = 8),
texts as (
  select 0 kind, row_number() over () r, doc_id, text from documents union all
  select 1, row_number() over (), null, text from benchmark),
words as (
  select kind, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from texts),
features as (
  select kind, r, unnest(w) f from words union all
  select kind, r, w[i] || ' ' || w[i + 1] from (select kind, r, w, unnest(range(1, len(w))) i from words)),
distinct_features as (select f, hex(encode(f)) h from (select distinct f from features)),
buckets as (
  select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: cast('0x' || substr(h, cast(2 * i + 1 as int), 2) as bigint))),
    lambda acc, x: xor(acc >> 8, t[xor(acc & 255, x) + 1])), 4294967295) % 10000 b from distinct_features, tab),
hashed as (select kind, r, b from features join buckets using (f)),
counts as (
  select b, count(*) filter (kind = 0) s, count(*) filter (kind = 1) t from hashed group by b),
totals as (select count(*) filter (kind = 0) s_all, count(*) filter (kind = 1) t_all from hashed),
gains as (
  select b, cast(floor(1000 * ln((t + 1) * cast(s_all + 10000 as double) / ((s + 1) * cast(t_all + 10000 as double)))) as bigint) g
  from counts, totals),
sums as (select r, sum(g) g, count(*) n from hashed join gains using (b) where kind = 0 group by r),
scored as (
  select w.r, doc_id, len(w) n_words, coalesce(n, 0) n_features,
    cast(case when n is null then 0 else (g - ((g % n) + n) % n) // n end as bigint) weight,
    cast('0x' || substr(sha256('7:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) h
  from words w left join sums s on s.r = w.r where kind = 0),
noisy as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) as bigint) score from scored),
ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls first) place,
    25 * count(*) filter (n_words >= 20) over () // 100 most from noisy)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= most then place end as rank from ranked
""",
}

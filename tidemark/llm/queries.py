"""The registered queries of the llm operators: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, tokenfiles, vectors
from tidemark.llm.filteraudit import filter_audit
from tidemark.llm.language import languages
from tidemark.llm.lexical import ranked_search
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.piecebpe import encode_pieces
from tidemark.llm.quality import quality_scores
from tidemark.llm.secrets import secret_spans
from tidemark.llm.store import fresh_folder
from tidemark.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    manifest = tokenfiles.write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, folder, added=True)
    return tokenfiles.with_crc(tokenfiles.read_token_files(manifest, folder))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(_table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "flat-token-files")
    written = tokenfiles.write_flat_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 50256, folder)
    found = tokenfiles.scan_separators(spark, folder, 50256)
    return found.join(written, ["shard", "ordinal"], "left").select("doc_id", "shard", "ordinal", "start", "n_tokens", "ended")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_table(spark, sf_dir, "documents"))
    first = F.array_min(F.transform("placements", lambda p: p["position"]))
    # ordered by the whole position: rounded ones would be shared by many documents of a large table
    ordered = planned.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position")).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
    return ordered.withColumn("first_position", F.round("first_position", 6))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_token_files": op5_token_files,
    "op6_language_id": op6_language_id,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_secret_scan": op12_secret_scan,
    "op13_ranked_search": op13_ranked_search,
}

SQL = {
    "op7_exact_top_k": """
with ok as (
    select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum([a[1] * a[2] for a in list_zip(q.v, c.v)]) as bigint) as score
    from (select distinct * from ok where vec_id % 50 = 0) q join ok c on q.vec_id != c.vec_id and len(q.v) = len(c.v)
), placed as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from placed where rank <= 5""",
    "op9_mixing": r"""
with docs as (
    select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
           md5('mix' || coalesce(cast(doc_id as varchar), '') || coalesce(md5(text), '')) as o
    from documents
), sizes as (
    select source, cast(sum(size) as bigint) as source_size from docs group by source
), weighed as (
    select *, 2.0 * source_size as cap, case place % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end as w
    from (select *, row_number() over (order by source is null, source) - 1 as place from sizes)
), filled as (
    select source, source_size, place, cast(cap as double) as cap, cast(w as double) as w,
           (cast(1.5 as double) * sum(source_size) over () - coalesce(sum(cast(cap as double)) over (order by cap / w, place rows between unbounded preceding and 1 preceding), 0))
           / sum(cast(w as double)) over (order by cap / w, place rows between current row and unbounded following) as level
    from weighed
), targets as (
    select source, source_size, place, least(cap, max(level) over () * w) as target
    from filled
), placed as (
    select doc_id, size, source_size, target, place, sum(size) over (partition by docs.source order by o, doc_id, size rows unbounded preceding) - size as start
    from docs join targets on docs.source is not distinct from targets.source
), counted as (
    select *, least(size, floor(target) - start) as first_words, least(size, floor(target) - start - source_size) as second_words,
           least(start / target, 1.0) as asked
    from placed
), timed as (
    select *, case place % 3
        when 0 then asked
        when 1 then case
            when asked * 1.05 < 0.45 then 2 * (asked * 1.05) / (0.5 + sqrt(0.25 + 2 * (0.5 / 0.6) * (asked * 1.05)))
            when asked * 1.05 < 1.05 then 0.6 + 2 * (asked * 1.05 - 0.45) / (1 + sqrt(1 + 2 * (1.0 / 0.4) * (asked * 1.05 - 0.45))) else 1 end
        else case
            when asked * 1.05 < 0.6 then 2 * (asked * 1.05) / (2 + sqrt(4 - 2 * (1.0 / 0.4) * (asked * 1.05)))
            when asked * 1.05 < 1.05 then 0.4 + 2 * (asked * 1.05 - 0.6) / (1 + sqrt(1 - 2 * (0.5 / 0.6) * (asked * 1.05 - 0.6))) else 1 end end as position
    from counted
)
select doc_id, size, source_size, target, cast(greatest(first_words, 0) + greatest(second_words, 0) as bigint) as taken,
       case when first_words > 0 then round(position, 6) end as first_position
from timed""",
    "op11_filter_audit": r"""
with docs as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents
), words as (
    select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as first from docs
), known as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id
), flags as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           case when len(w) < 200 then 1 else 0 end + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
           + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 4 else 0 end
           + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end + case when words.doc_id > first then 16 else 0 end as mask
    from words left join known on words.doc_id = known.doc_id
), cells as (
    select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from flags group by part, mask
), letters as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 4, 8, 16]) as bit
), orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a, letters b, letters c, letters d, letters e
    where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps as (
    select filter_order, cast(k as integer) as step, bits[k] as bit, coalesce(list_sum(bits[1 : k - 1]), 0)::integer as before from orders, range(1, 6) as t(k)
)
select part, filter_order, step,
       cast(sum(case when mask & (before | bit) = 0 then n else 0 end) as bigint) as kept,
       cast(sum(case when mask & bit != 0 and mask & before = 0 then n else 0 end) as bigint) as removed,
       cast(sum(case when mask & bit != 0 and mask & before != 0 then n else 0 end) as bigint) as redundant,
       cast(sum(case when mask = bit then n else 0 end) as bigint) as unique_fails,
       cast(sum(case when mask & bit != 0 and mask & before = 0 then good else 0 end) as bigint) as good_lost,
       cast(sum(case when mask & bit != 0 and mask & before = 0 then toxic else 0 end) as bigint) as toxic_lost,
       cast(sum(case when mask & bit != 0 then n * 120 // bit_count(mask) else 0 end) as bigint) as shapley
from cells, steps group by part, filter_order, step""",
    "op13_ranked_search": r"""
with terms as (
    select row, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select row_number() over () as row, doc_id, text from documents)
), sizes as (
    select row, doc_id, count(*) as n from terms group by row, doc_id
), everything as (
    select count(*) as docs, cast(sum(n) as bigint) as words from sizes
), counted as (
    select row, term, count(*) as tf from terms group by row, term
), weights as (
    select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
    from (select term, count(*) as df from counted group by term), everything
), lengths as (
    select row, doc_id, 100 - 50 + (50 * n * docs) // words as m from sizes, everything
), wanted as (
    select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), scored as (
    select item_id, row, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
    from wanted join counted using (term) join weights using (term) join lengths using (row) group by item_id, row, doc_id
), placed as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from scored where score > 0
)
select item_id, rank, doc_id, score from placed where rank <= 50""",
}

"""Measures of agreement: confusion, intervals, recall, overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scores, text
from tidemark.plans.registry import query, table

JUDGED = """judged as (select l.doc_id, l.quality, case when length(d.text) < 100 then null when contains(d.text, '!!') or contains(d.text, '###') then 0 else 1 end as said, d.lang
    from labels l join documents d using (doc_id))"""


def judged(spark, d):
    """Labels against a plain rule's verdict; null where the rule gives none."""
    docs = table(spark, d, "documents")
    said = F.when(F.length("text") < 100, F.lit(None)).when(F.col("text").contains("!!") | F.col("text").contains("###"), 0).otherwise(1)
    return table(spark, d, "labels").join(docs, "doc_id").select("doc_id", "quality", said.alias("said"), "lang")


@query("a33_confusion", f"""with {JUDGED} select count(*) filter (where quality = 1 and said = 1) as tp, count(*) filter (where quality = 0 and said = 1) as fp, count(*) filter (where quality = 0 and said = 0) as tn,
count(*) filter (where quality = 1 and said = 0) as fn, count(*) filter (where said is null) as refused, round(count(*) filter (where quality = said) / nullif(count(said), 0), 6) as match_rate from judged""")
def a33(spark, d):
    q, s = F.col("quality"), F.col("said")
    return judged(spark, d).agg(
        F.count_if((q == 1) & (s == 1)).alias("tp"), F.count_if((q == 0) & (s == 1)).alias("fp"), F.count_if((q == 0) & (s == 0)).alias("tn"), F.count_if((q == 1) & (s == 0)).alias("fn"),
        F.count_if(s.isNull()).alias("refused"), F.round(F.try_divide(F.count_if(q == s), F.count(s)), 6).alias("match_rate"),
    )


@query("a34_concordance", f"""with {JUDGED} select lang, round(count(*) filter (where quality = said) / nullif(count(said), 0), 6) as concordance, count(*) filter (where quality = 1 and said = 0) as false_negatives, count(*) filter (where quality = 0 and said = 1) as false_positives from judged group by 1""")
def a34(spark, d):
    q, s = F.col("quality"), F.col("said")
    return judged(spark, d).groupBy("lang").agg(F.round(F.try_divide(F.count_if(q == s), F.count(s)), 6).alias("concordance"), F.count_if((q == 1) & (s == 0)).alias("false_negatives"), F.count_if((q == 0) & (s == 1)).alias("false_positives"))


@query("a35_wilson", f"""with {JUDGED}, g as (select lang, cast(count(*) filter (where quality = said) as double) as k, cast(count(said) as double) as n from judged group by 1)
select lang, round(greatest(0, (k / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt((k / n) * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) as low,
       round(least(1, (k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt((k / n) * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) as high from g""")
def a35(spark, d):
    g = judged(spark, d).groupBy("lang").agg(F.count_if(F.col("quality") == F.col("said")).cast("double").alias("k"), F.count("said").cast("double").alias("n"))
    low, high = scores.wilson(F.col("k"), F.col("n"))
    return g.select("lang", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("a36_recall", """
select source, round(count(*) filter (where l.doc_id is not null) / count(*), 6) as recall, round(coalesce(sum(n_chars) filter (where l.doc_id is not null), 0) / sum(n_chars), 6) as weighted from documents d left join labels l using (doc_id) group by 1""")
def a36(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", F.lit(1).alias("found")), "doc_id", "left")
    hit = F.col("found").isNotNull()
    return docs.groupBy("source").agg(F.round(F.count_if(hit) / F.count("*"), 6).alias("recall"), F.round(F.coalesce(F.sum(F.when(hit, F.col("n_chars"))), F.lit(0)) / F.sum("n_chars"), 6).alias("weighted"))


@query("a37_jaccard", r"""
with w as (select conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{3,}')) as w from conversations)
select a.conv_id, a.turn, round(case when len(list_distinct(list_concat(a.w, b.w))) = 0 then 1.0::double else len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) end, 6) as jaccard, len(list_intersect(a.w, b.w)) = len(list_distinct(list_concat(a.w, b.w))) as equal
from w a join w b on b.conv_id = a.conv_id and b.turn = a.turn + 1""")
def a37(spark, d):
    w = table(spark, d, "conversations").select("conv_id", "turn", text.word_set(F.col("text")).alias("w"))
    after = w.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v"))
    j = scores.jaccard(F.col("w"), F.col("v"))
    return w.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(j, 6).alias("jaccard"), (j == 1).alias("equal"))

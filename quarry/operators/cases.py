"""Case records: normalisation, verdict label and content composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import clean_text, stable_id

# Labels of the case content format.
FACT_HEAD = "【案情事实】\n"
ACCUSATION_HEAD = "\n【指控罪名】"
ARTICLES_HEAD = "\n【相关法条】第"
ARTICLES_TAIL = "条"
VERDICT_HEAD = "\n【判决结果】"
DEATH = "死刑"
LIFE = "无期徒刑"
TERM = "有期徒刑{n}个月"
OTHER = "其他刑罚"
LIST_SEP = "、"
UNKNOWN = "未知"
CASE_SOURCE = "CAIL"

TERM_TYPE = "struct<imprisonment:int,death_penalty:boolean,life_imprisonment:boolean>"
META_TYPE = (f"struct<accusation:array<string>,relevant_articles:array<bigint>,term_of_imprisonment:{TERM_TYPE},"
             "punish_of_money:bigint>")
RAW_CASE_SCHEMA = (f"fact string, meta {META_TYPE}, accusation array<string>, law_articles array<bigint>, "
                   "prison_term int, fine bigint")


def normalise_cases(raw: DataFrame, min_fact: int = params.MIN_CASE_FACT_CHARS) -> DataFrame:
    """Two raw shapes -> one.  A flat record (accusation present, no or empty meta) becomes
    meta with a term struct (prison_term, no death, no life).  Facts shorter than
    ``min_fact`` (raw text) are dropped, the rest cleaned.  Output: case_index (if present),
    fact, accusation, articles (array<string>), term (struct or null), fine."""
    meta = F.col("meta")
    empty = meta.isNull() | (meta["accusation"].isNull() & meta["relevant_articles"].isNull()
                             & meta["term_of_imprisonment"].isNull() & meta["punish_of_money"].isNull())
    flat = empty & F.col("accusation").isNotNull()
    term_flat = F.struct(F.coalesce(F.col("prison_term"), F.lit(0)).alias("imprisonment"),
                         F.lit(False).alias("death_penalty"), F.lit(False).alias("life_imprisonment"))
    keep = [c for c in raw.columns if c == "case_index"]
    return raw.where(F.col("fact").isNotNull() & (F.length("fact") >= min_fact)).select(
        *keep,
        clean_text(F.col("fact")).alias("fact"),
        F.when(flat, F.col("accusation")).otherwise(F.col("meta.accusation")).alias("accusation"),
        F.transform(F.when(flat, F.col("law_articles")).otherwise(F.col("meta.relevant_articles")),
                    lambda a: a.cast("string")).alias("articles"),
        F.when(flat, term_flat).otherwise(F.col("meta.term_of_imprisonment")).alias("term"),
        F.when(flat, F.coalesce(F.col("fine"), F.lit(0))).otherwise(F.col("meta.punish_of_money")).alias("fine"))


def verdict(term) -> F.Column:
    """Death -> life -> months > 0 -> other; null when the term struct is absent or empty."""
    t = F.col(term) if isinstance(term, str) else term
    empty = t["death_penalty"].isNull() & t["life_imprisonment"].isNull() & t["imprisonment"].isNull()
    return (F.when(t.isNull() | empty, F.lit(None).cast("string"))
            .when(F.coalesce(t["death_penalty"], F.lit(False)), F.lit(DEATH))
            .when(F.coalesce(t["life_imprisonment"], F.lit(False)), F.lit(LIFE))
            .when(F.coalesce(t["imprisonment"], F.lit(0)) > 0,
                  F.format_string(TERM.replace("{n}", "%d"), t["imprisonment"]))
            .otherwise(F.lit(OTHER)))


def compose_cases(cases: DataFrame) -> DataFrame:
    """Case content (fact; accusations; articles; verdict — each only when present),
    csv metadata with default '未知', stable id and type 'case'."""
    acc, arts = F.col("accusation"), F.col("articles")
    has_acc = F.coalesce(F.size(acc), F.lit(0)) > 0
    has_art = F.coalesce(F.size(arts), F.lit(0)) > 0
    v = verdict("term")
    content = F.concat(
        F.lit(FACT_HEAD), F.col("fact"),
        F.when(has_acc, F.concat(F.lit(ACCUSATION_HEAD), F.array_join(acc, LIST_SEP))).otherwise(F.lit("")),
        F.when(has_art, F.concat(F.lit(ARTICLES_HEAD), F.array_join(arts, LIST_SEP), F.lit(ARTICLES_TAIL)))
        .otherwise(F.lit("")),
        F.when(v.isNotNull(), F.concat(F.lit(VERDICT_HEAD), v)).otherwise(F.lit("")))
    return cases.select(
        "*",
        content.alias("content"),
        F.lit("case").alias("type"),
        F.when(has_acc, F.array_join(acc, ",")).otherwise(F.lit(UNKNOWN)).alias("accusation_csv"),
        F.when(has_art, F.array_join(arts, ",")).otherwise(F.lit(UNKNOWN)).alias("articles_csv"),
        stable_id(F.substring("fact", 1, 100), F.lit(CASE_SOURCE)).alias("chunk_id"))


def qa_chunks(pairs: DataFrame, q_col: str = "question", a_col: str = "answer") -> DataFrame:
    """QA pairs kept when both cleaned sides are non-empty; content '【问题】q\\n【回答】a'."""
    q, a = clean_text(F.col(q_col)), clean_text(F.col(a_col))
    keep = [c for c in pairs.columns if c not in (q_col, a_col)]
    return pairs.select(*keep, q.alias("_q"), a.alias("_a")).where((F.col("_q") != "") & (F.col("_a") != "")).select(
        *keep, F.concat(F.lit("【问题】"), F.col("_q"), F.lit("\n【回答】"), F.col("_a")).alias("content"),
        F.lit("qa").alias("type"))

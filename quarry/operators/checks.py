"""Hallucination checks (H1-H4).  Per-answer array expressions: extracted references are
compared with set functions (``array_except``/``array_intersect``); no joins beyond the
per-question document list, which is bounded by top-k."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params
from quarry.functions import json_reply as J
from quarry.functions.text import ARTICLE_REF, col_, lit_array


@dataclass(frozen=True)
class CheckLexicon:
    """Patterns and words of the checks.  Defaults are the fixed values of the reference."""
    answer_article: str = r"第[0-9]+条"                       # H1 rule 1
    sentence_terms: str = r"\d+年|死刑|无期|有期"              # H1 rule 2
    hedging: str = r"(据说|可能|听说|大概|好像|似乎|假设|如果)"  # H1 rule 3
    article_ref: str = ARTICLE_REF                             # H4
    eval_refusals: tuple = ("无法回答", "无法准确", "未找到相关", "检索内容中未找到", "没有相关")
    claim_article: str = "法条 %s 可能不在检索结果中"
    claim_terms: str = "量刑标准可能与检索内容不一致"
    claim_long: str = "答案较长但检索文档较少，可能包含推断信息"
    warning: str = "\n⚠️  注意：该回答可能存在幻觉风险（%s），请谨慎参考。"
    warning_claims: str = "\n问题陈述：%s"


DEFAULT = CheckLexicon()


def context_text(docs: DataFrame, n_docs: int = params.CONTEXT_DOCS_LOCAL,
                 chars: int = params.CONTEXT_CHARS_LOCAL) -> DataFrame:
    """(qid, context, n_docs): first ``n_docs`` docs (by pos) cut to ``chars``, joined by a space."""
    items = F.array_sort(F.collect_list(F.struct("pos", F.substring("content", 1, chars).alias("t"))))
    return docs.groupBy("qid").agg(
        F.array_join(F.transform(F.slice(items, 1, n_docs), lambda s: s["t"]), " ").alias("context"),
        F.count("*").cast("bigint").alias("n_docs"))


def local_check(answer, context, n_docs, lex: CheckLexicon = DEFAULT) -> F.Column:
    """H1: struct(risk_level, claims array<string>, has_risk) from heuristic rules."""
    a, ctx = col_(answer), F.coalesce(col_(context), F.lit(""))
    arts = F.regexp_extract_all(a, F.lit(lex.answer_article), 0)
    missing = F.filter(arts, lambda x: (F.instr(ctx, x) == 0) & (F.length(ctx) > 100))
    c1 = F.transform(missing, lambda x: F.format_string(lex.claim_article, x))
    an = F.regexp_extract_all(a, F.lit(lex.sentence_terms), 0)
    cn = F.regexp_extract_all(ctx, F.lit(lex.sentence_terms), 0)
    disjoint = (F.size(an) > 0) & (F.size(cn) > 0) & (F.size(F.array_intersect(an, cn)) == 0)
    c2 = F.when(disjoint, F.array(F.lit(lex.claim_terms))).otherwise(F.array().cast("array<string>"))
    long_ = (F.length(a) > params.LONG_ANSWER_CHARS) & (F.coalesce(col_(n_docs), F.lit(0)) < 2)
    c4 = F.when(long_, F.array(F.lit(lex.claim_long))).otherwise(F.array().cast("array<string>"))
    medium = a.rlike(lex.hedging) | long_
    risk = F.when(medium, F.lit("medium")).otherwise(F.lit("low"))
    return F.struct(risk.alias("risk_level"), F.concat(c1, c2, c4).alias("claims"),
                    risk.isin("medium", "high").alias("has_risk"))


def verdict_check(reply, answer, context, n_docs, lex: CheckLexicon = DEFAULT) -> F.Column:
    """H2: parse a model verdict (risk_level default 'low', claims default []); a reply whose
    JSON span does not parse falls back to H1; a reply without a span is 'low'."""
    span = J.json_span(reply)
    v = J.parsed(reply)
    risk = F.coalesce(J.field(v, "$.risk_level", "string"), F.lit("low"))
    claims = F.coalesce(J.field(v, "$.problematic_claims", "array<string>"), F.array().cast("array<string>"))
    model = F.struct(risk.alias("risk_level"), claims.alias("claims"), risk.isin("medium", "high").alias("has_risk"))
    none = F.struct(F.lit("low").alias("risk_level"), F.array().cast("array<string>").alias("claims"),
                    F.lit(False).alias("has_risk"))
    return F.when(span == "", none).when(v.isNull(), local_check(answer, context, n_docs, lex)).otherwise(model)


def with_warning(answer, check, elapsed_s, timeout_s: float = params.HALLUCINATION_TIMEOUT_S,
                 lex: CheckLexicon = DEFAULT) -> F.Column:
    """H3: append the warning (and claim list) on medium/high risk unless the check took
    longer than ``timeout_s``."""
    c = col_(check)
    warn = F.concat(F.format_string(lex.warning, c["risk_level"]),
                    F.when(F.size(c["claims"]) > 0,
                           F.format_string(lex.warning_claims, F.array_join(c["claims"], ", "))).otherwise(F.lit("")))
    show = c["risk_level"].isin("medium", "high") & ~(F.coalesce(col_(elapsed_s), F.lit(0.0)) > timeout_s)
    return F.when(show, F.concat(F.trim(col_(answer)), warn)).otherwise(F.trim(col_(answer)))


def eval_hallucination(answer, doc_texts, truth, lex: CheckLexicon = DEFAULT) -> F.Column:
    """H4: refusal -> false; no docs and answer > 100 chars -> true; no docs -> false; no
    cited articles -> false; else true iff more than half of the distinct cited articles are
    absent from the docs and the ground truth."""
    a = F.coalesce(col_(answer), F.lit(""))
    docs = F.coalesce(col_(doc_texts), F.array().cast("array<string>"))
    refused = F.exists(lit_array(list(lex.eval_refusals)), lambda w: F.instr(a, w) > 0)
    cited = F.array_distinct(F.regexp_extract_all(a, F.lit(lex.article_ref), 0))
    found = F.array_union(
        F.flatten(F.transform(docs, lambda d: F.regexp_extract_all(d, F.lit(lex.article_ref), 0))),
        F.regexp_extract_all(F.coalesce(col_(truth), F.lit("")), F.lit(lex.article_ref), 0))
    missing = F.size(F.array_except(cited, found))
    return (F.when(refused, F.lit(False))
            .when((F.size(docs) == 0) & (F.length(a) > params.EVAL_REFUSAL_MIN_CHARS), F.lit(True))
            .when(F.size(docs) == 0, F.lit(False))
            .when(F.size(cited) == 0, F.lit(False))
            .otherwise(missing > F.size(cited) / 2.0))

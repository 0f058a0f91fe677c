"""Scope gate and query expansion.

All of these are column expressions over the question table.  The keywords of a
lexicon are found by one automaton in one pass over a question, however many they
are, so the gate costs one projection and no join or shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params
from quarry.functions import json_reply as J
from quarry.functions.keywords import any_of, contained
from quarry.functions.text import col_, lit_array

# Label used when the model verdict cannot be parsed.
UNKNOWN_DOMAIN = "未知"
SERVED_DOMAIN = "刑法"


def keyword_scope(text, groups) -> F.Column:
    """G1: label of the first group (declared order) with a keyword contained in ``text``; null if none."""
    groups = list(groups)
    found = contained(text, [w for _, kws in groups for w in kws])
    expr, end = F.lit(None).cast("string"), sum(len(kws) for _, kws in groups)
    for label, kws in reversed(groups):
        end -= len(kws)
        expr = F.when(any_of(found, end, len(kws)), F.lit(label)).otherwise(expr)
    return expr


def scope_gate(questions: DataFrame, groups, text_col: str = "question") -> DataFrame:
    """G1: adds ``out_of_scope`` (bool) and ``detected_domain`` ('' when in scope)."""
    lab = keyword_scope(F.col(text_col), groups)
    return questions.withColumn("detected_domain", F.coalesce(lab, F.lit(""))).withColumn(
        "out_of_scope", lab.isNotNull())


def scope_verdict(replies: DataFrame, reply_col: str = "reply", served=(SERVED_DOMAIN,),
                  default_domain: str = SERVED_DOMAIN) -> DataFrame:
    """Parse a model scope reply; in scope iff the domain is served.

    Unparseable replies give (in scope, 0.5, unknown domain).  A parsed reply
    with no ``domain`` field defaults to ``default_domain``; no ``confidence`` to 0.5.
    """
    v = J.parsed(F.col(reply_col))
    ok = v.isNotNull()
    domain = F.coalesce(J.field(v, "$.domain", "string"), F.lit(default_domain))
    conf = F.coalesce(J.field(v, "$.confidence", "double"), F.lit(0.5))
    return replies.select(
        "*",
        F.when(ok, domain.isin(*served)).otherwise(F.lit(True)).alias("is_in_scope"),
        F.when(ok, conf).otherwise(F.lit(0.5)).alias("verdict_confidence"),
        F.when(ok, domain).otherwise(F.lit(UNKNOWN_DOMAIN)).alias("verdict_domain"),
    )


def combine_scope(df: DataFrame, min_confidence: float = params.SCOPE_VERDICT_MIN_CONFIDENCE) -> DataFrame:
    """Keyword hit wins; else an out-of-scope verdict with confidence above the floor."""
    by_model = (~F.col("is_in_scope")) & (F.col("verdict_confidence") > min_confidence)
    return df.withColumn("detected_domain", F.when(F.col("out_of_scope"), F.col("detected_domain"))
                         .when(by_model, F.col("verdict_domain")).otherwise(F.lit(""))) \
             .withColumn("out_of_scope", F.col("out_of_scope") | by_model)


def expand_queries(questions: DataFrame, expansions, templates, text_col: str = "question",
                   max_expansions: int | None = None) -> DataFrame:
    """One row per (qid, ord, query_text): the original first, then every expansion
    of every keyword contained (declared order); no keyword hit -> the templates.
    ``max_expansions`` keeps the first n rows (parallel mode uses 3)."""
    q = F.col(text_col)
    hits = F.flatten(F.transform(contained(q, [kw for kw, _ in expansions]), lambda i: F.get(
        F.array(*[lit_array(ex) for _, ex in expansions]), i))) if expansions else F.array().cast("array<string>")
    tmpl = F.array(*[F.format_string(t.replace("{q}", "%s"), q) for t in templates])
    expanded = F.concat(F.array(q), F.when(F.size(hits) > 0, hits).otherwise(tmpl))
    out = questions.select("*", F.posexplode(expanded).alias("ord", "query_text"))
    out = out.withColumn("ord", F.col("ord").cast("bigint"))
    if max_expansions is not None:
        out = out.where(F.col("ord") < max_expansions)
    return out


def refusal(detected_domain, template: str) -> F.Column:
    """Fill the refusal template (``{domain}`` placeholder) with the detected domain."""
    return F.format_string(template.replace("{domain}", "%s"), col_(detected_domain))

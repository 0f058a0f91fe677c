"""Evaluation (E1-E10): per-sample scorers as array expressions, roll-ups as one
aggregation with grouping sets.  A result row is one evaluated sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numerals import numbers_before
from quarry.functions.text import col_, lit_array


@dataclass(frozen=True)
class EvalLexicon:
    """Words and patterns of the scorers.  Defaults are the fixed values of the reference."""
    scope_refusals: tuple = ("无法回答", "不在", "超出", "无法准确", "没有相关", "无法找到")
    refusals: tuple = ("无法回答", "无法准确", "无法找到")
    penalties: tuple = ("死刑", "无期徒刑", "有期徒刑", "拘役", "管制", "罚金", "没收")
    number_pattern: str = r"(\d+)年"
    numeral_marker: str = "年"
    article_marker: str = "条"
    concepts: tuple = ("定义", "规定", "是指", "处", "处罚", "刑事责任")
    source_keywords: tuple = (("statute", ("刑法", "statute", "法条", "条")), ("case", ("cail", "案例", "case", "司法")))
    stopwords: tuple = ("的", "是", "在", "了", "和", "与", "或", "等", "有", "对", "被", "为", "以", "及")
    token_pattern: str = r"[\p{L}\p{N}]+"
    out_of_scope: str = "out_of_scope"


DEFAULT = EvalLexicon()
BRACKETS = "（）【】()"


def correctness(pred, truth, category, lex: EvalLexicon = DEFAULT, numerals: bool = False) -> F.Column:
    """E1.  With ``numerals``, numbers of years in Chinese numerals count beside those in digits."""
    p, t = F.coalesce(col_(pred), F.lit("")), F.coalesce(col_(truth), F.lit(""))
    any_in = lambda words, s: F.exists(lit_array(list(words)), lambda w: F.instr(s, w) > 0)
    gt_pen = F.filter(lit_array(list(lex.penalties)), lambda w: F.instr(t, w) > 0)
    pr_pen = F.filter(lit_array(list(lex.penalties)), lambda w: F.instr(p, w) > 0)
    gt_num = F.regexp_extract_all(t, F.lit(lex.number_pattern), 1)
    pr_num = F.regexp_extract_all(p, F.lit(lex.number_pattern), 1)
    if numerals:
        gt_num, pr_num = (F.concat(found, numbers_before(text, lex.numeral_marker)) for found, text in ((gt_num, t), (pr_num, p)))
    pen_bad = (F.size(gt_pen) > 0) & (F.size(F.array_intersect(gt_pen, pr_pen)) / F.size(gt_pen) < 0.5)
    num_bad = (F.size(gt_num) > 0) & (F.size(F.array_intersect(gt_num, pr_num)) / F.size(gt_num) < 0.5)
    concept_bad = (F.instr(t, lex.article_marker) > 0) & any_in(lex.concepts, t) & ~any_in(lex.concepts, p)
    return (F.when(col_(category) == lex.out_of_scope, any_in(lex.scope_refusals, p))
            .when(t == "", F.lit(False))
            .when(any_in(lex.refusals, p), F.lit(False))
            .when(pen_bad | num_bad | concept_bad, F.lit(False))
            .otherwise(F.lit(True)))


def normalize_source(c) -> F.Column:
    """Lower, strip, brackets -> space."""
    from quarry.operators.segment import strip_ws
    return F.translate(strip_ws(F.lower(col_(c))), BRACKETS, " " * len(BRACKETS))


def citation_prf(pred_sources, expected_sources, lex: EvalLexicon = DEFAULT) -> F.Column:
    """struct(precision, recall, f1).

    Per expected source the predictions are scanned in order: each keyword-category match
    counts one, and the scan stops at the first direct (substring) match, which counts one.
    Empty expected: 1/1/1 with any prediction, else 0/0/0.  P and R are capped at 1."""
    preds = F.transform(F.coalesce(col_(pred_sources), F.array().cast("array<string>")), normalize_source)
    exps = F.transform(F.coalesce(col_(expected_sources), F.array().cast("array<string>")), normalize_source)
    cats = [lit_array(list(kws)) for _, kws in lex.source_keywords]

    def kw_match(e, p):
        out = F.lit(False)
        for kws in cats:
            out = out | (F.exists(kws, lambda k: F.instr(e, k) > 0) & F.exists(kws, lambda k: F.instr(p, k) > 0))
        return out

    def per_expected(e):
        direct = F.transform(preds, lambda p: (F.instr(p, e) > 0) | (F.instr(e, p) > 0))
        d = F.array_position(direct, True)
        idx = F.sequence(F.lit(1), F.greatest(F.size(preds), F.lit(1)))
        kws = F.size(F.filter(idx, lambda i: (i <= F.size(preds)) & ((d == 0) | (i < d))
                              & kw_match(e, F.element_at(preds, i))))
        return kws + F.when(d > 0, F.lit(1)).otherwise(F.lit(0))

    matches = F.aggregate(exps, F.lit(0), lambda acc, e: acc + per_expected(e))
    n_p, n_e = F.size(preds), F.size(exps)
    prec = F.least(matches / F.greatest(n_p, F.lit(1)), F.lit(1.0))
    rec = F.least(matches / F.greatest(n_e, F.lit(1)), F.lit(1.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    one, zero = F.lit(1.0), F.lit(0.0)
    return (F.when(n_e == 0, F.when(n_p > 0, F.struct(one.alias("precision"), one.alias("recall"), one.alias("f1")))
                   .otherwise(F.struct(zero.alias("precision"), zero.alias("recall"), zero.alias("f1"))))
            .when(n_p == 0, F.struct(zero.alias("precision"), zero.alias("recall"), zero.alias("f1")))
            .otherwise(F.struct(prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))))


HAN = r"[\p{IsHan}]+"


def tokens(c, lex: EvalLexicon = DEFAULT) -> F.Column:
    """E4 default tokenizer: distinct lower-cased word tokens and, of Chinese runs, the pairs of neighbouring characters;
    minus stopwords."""
    text = F.lower(F.coalesce(col_(c), F.lit("")))
    runs = F.regexp_extract_all(text, F.lit(HAN), 0)
    pairs = F.flatten(F.transform(runs, lambda r: F.when(F.length(r) == 1, F.array(r)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substr(r, i, F.lit(2))))))
    t = F.concat(F.regexp_extract_all(F.regexp_replace(text, HAN, " "), F.lit(lex.token_pattern), 0), pairs)
    return F.array_except(F.array_distinct(t), lit_array(list(lex.stopwords)))


def relevance(answer, question, truth, lex: EvalLexicon = DEFAULT, tokenize_fn=None) -> F.Column:
    """0.4 |q∩a|/max(|q|,1) + 0.6 (|g∩a|/max(|g|,1), or 0.5 without truth), capped at 1.

    ``tokenize_fn`` maps a text column to an array of distinct tokens (``tokens`` if None)."""
    a, q, g = (tokenize_fn(col_(c)) if tokenize_fn else tokens(c, lex) for c in (answer, question, truth))
    qo = F.size(F.array_intersect(q, a)) / F.greatest(F.size(q), F.lit(1))
    go = F.when(F.size(g) > 0, F.size(F.array_intersect(g, a)) / F.greatest(F.size(g), F.lit(1))).otherwise(F.lit(0.5))
    return F.least(0.4 * qo + 0.6 * go, F.lit(1.0))


METRICS = ["accuracy", "avg_confidence", "citation_precision", "citation_recall", "citation_f1",
           "hallucination_rate", "avg_relevance", "avg_latency"]


def _metric_aggs():
    return [
        F.avg(F.col("is_correct").cast("double")).alias("accuracy"),
        F.avg("confidence").alias("avg_confidence"),
        F.avg("citation_precision").alias("citation_precision"),
        F.avg("citation_recall").alias("citation_recall"),
        F.avg("citation_f1").alias("citation_f1"),
        F.avg(F.col("has_hallucination").cast("double")).alias("hallucination_rate"),
        F.avg("relevance_score").alias("avg_relevance"),
        F.avg("latency").alias("avg_latency"),
        F.count("*").cast("bigint").alias("n"),
    ]


def metrics(results: DataFrame) -> DataFrame:
    """E5: one row of overall metrics.  A right refusal has no sources and counts as a hallucination in ``hallucination_rate``;
    ``hallucination_rate_answered`` leaves refusals out: rows with ``answered`` false, or, without that column, those of the
    category out_of_scope (null if nothing is answered)."""
    answered = F.col("answered") if "answered" in results.columns else F.coalesce(F.col("category"), F.lit("")) != "out_of_scope"
    return results.agg(*_metric_aggs(), F.avg(F.when(answered, F.col("has_hallucination").cast("double"))).alias("hallucination_rate_answered"))


def metrics_by_category(results: DataFrame) -> DataFrame:
    """Per category and overall (category null, is_total 1) in one aggregation."""
    return results.rollup("category").agg(*_metric_aggs(), F.grouping("category").cast("int").alias("is_total"))


def coverage(samples: DataFrame, results: DataFrame, keys) -> DataFrame:
    """Failed samples (no result) are excluded from the metric denominators but counted
    in total_samples.  One row: total_samples, evaluated, failed."""
    j = samples.select(*keys).join(results.select(*keys).withColumn("_ok", F.lit(1)), list(keys), "left")
    return j.agg(F.count("*").cast("bigint").alias("total_samples"),
                 F.count("_ok").cast("bigint").alias("evaluated"),
                 (F.count("*") - F.count("_ok")).cast("bigint").alias("failed"))


def run_compare(results: DataFrame, run_col: str = "run", order_col: str = "run_order") -> DataFrame:
    """Metrics per run and the change against the previous run (by ``order_col``)."""
    from pyspark.sql import Window
    m = results.groupBy(run_col, order_col).agg(*_metric_aggs())
    w = Window.orderBy(order_col)
    for c in ["accuracy", "citation_f1", "hallucination_rate"]:
        m = m.withColumn(f"delta_{c}", F.col(c) - F.lag(c).over(w))
    return m


def report_lines(by_cat: DataFrame) -> DataFrame:
    """Printable percentages (2 decimals) of the category roll-up."""
    label = F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col("category"))
    return by_cat.select(
        label.alias("label"), "n",
        *[F.round(F.col(c) * 100, 2).alias(f"{c}_pct") for c in ["accuracy", "citation_f1", "hallucination_rate"]],
        F.round("avg_latency", 2).alias("avg_latency_s"))

"""Driver queries: hallucination checks (H1-H4) and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.numerals import numeral_text, numeral_value
from quarry.operators import checks as H
from quarry.operators import evaluate as E
from quarry.plans import adapters as ad
from quarry.plans import sql_fragments as S
from quarry.plans import q_answer as QA
from quarry.plans.catalog import register, round6
from quarry.plans.evaluation import evaluate_system, score

METRIC_COLS = ["accuracy", "avg_confidence", "citation_precision", "citation_recall", "citation_f1", "hallucination_rate", "avg_relevance", "avg_latency"]

# Latin-script lexicons for the driver data (the defaults are the reference's Chinese ones).
ELEX = E.EvalLexicon(
    scope_refusals=("nicht", "pas ", "no "), refusals=("nicht",),
    penalties=("tion", "ment", "keit", "ción", "the "), number_pattern=r"([a-z]+)tion", article_marker="the",
    concepts=("and", "with", "that"),
    source_keywords=(("statute", ("statute", "src1")), ("case", ("case", "cail"))),
    stopwords=("the", "and", "a", "of", "de", "la", "le", "der", "die", "und", "el", "y", "en", "que"))
CLEX = H.CheckLexicon(answer_article=r"[A-Z][a-z]{3,}", sentence_terms=r"[a-z]+tion|[a-z]+ment",
                      hedging=r"(ung|oir)", article_ref=r"[A-Z][a-z]{3,}", eval_refusals=("nicht",))

SAMPLES = """samples AS (
  SELECT conv_id, pair_no, "user" AS question,
         CASE WHEN conv_id % 4 = 3 THEN '' ELSE assistant END AS ground_truth,
         ['criminal_law', 'special_case', 'case_related', 'out_of_scope'][conv_id % 4 + 1] AS category,
         CASE WHEN conv_id % 4 = 3 THEN []::VARCHAR[]
              ELSE ['src' || CAST(conv_id % 20 AS VARCHAR), 'Case ' || CAST(pair_no % 3 AS VARCHAR)] END AS expected_sources
  FROM pairs)"""


def answers_sql(run: str = "next", name: str = "answers") -> str:
    pred = ("coalesce(lead(assistant) OVER (PARTITION BY conv_id ORDER BY pair_no), assistant)" if run == "next"
            else "assistant")
    return f"""{name} AS (
  SELECT conv_id, pair_no, predicted AS predicted_answer,
         CASE WHEN conv_id % 5 = 0 THEN []::VARCHAR[]
              ELSE ['[src' || CAST(conv_id % 13 AS VARCHAR) || '] statute', '【case】 ' || CAST(pair_no AS VARCHAR)] END AS citations,
         (pair_no % 10) / 10.0::DOUBLE AS confidence, length(assistant) / 1000.0::DOUBLE AS latency,
         CASE WHEN pair_no % 3 = 0 THEN []::VARCHAR[] ELSE ["user"] END AS doc_texts
  FROM (SELECT *, {pred} AS predicted FROM pairs) WHERE (conv_id + pair_no) % 9 <> 0)"""


def _pairs_sql():
    from quarry.plans.q_text import MSG_PAIRS
    return MSG_PAIRS


def _joined(spark, sf, run="next"):
    s = ad.eval_samples(spark, sf)
    a = ad.eval_answers(spark, sf, run)
    return s.join(a, ["conv_id", "pair_no"], "inner")


# ---- SQL twins of the scorers ---------------------------------------------------------------
def _any(words, s: str) -> str:
    return "(" + " OR ".join(f"contains({s}, {S.q(w)})" for w in words) + ")"


def correctness_sql(p="predicted_answer", t="ground_truth", c="category", lex=ELEX) -> str:
    gt_pen = f"list_filter({S.lst(lex.penalties)}, lambda w: contains({t}, w))"
    pr_pen = f"list_filter({S.lst(lex.penalties)}, lambda w: contains({p}, w))"
    gt_num = f"regexp_extract_all({t}, {S.q(lex.number_pattern)}, 1)"
    pr_num = f"regexp_extract_all({p}, {S.q(lex.number_pattern)}, 1)"
    return f"""(CASE WHEN {c} = {S.q(lex.out_of_scope)} THEN {_any(lex.scope_refusals, p)}
  WHEN {t} = '' THEN false
  WHEN {_any(lex.refusals, p)} THEN false
  WHEN (len({gt_pen}) > 0 AND len(list_intersect({gt_pen}, {pr_pen})) / len({gt_pen}) < 0.5)
    OR (len({gt_num}) > 0 AND len(list_intersect({gt_num}, {pr_num})) / len({gt_num}) < 0.5)
    OR (contains({t}, {S.q(lex.article_marker)}) AND {_any(lex.concepts, t)} AND NOT {_any(lex.concepts, p)})
  THEN false ELSE true END)"""


def _norm_src(x: str) -> str:
    return f"translate({S.strip_sql(f'lower({x})')}, '（）【】()', '      ')"


def prf_sql(preds="citations", exps="expected_sources", lex=ELEX) -> str:
    P = f"list_transform({preds}, lambda p: {_norm_src('p')})"
    X = f"list_transform({exps}, lambda e: {_norm_src('e')})"
    kw = " OR ".join(f"(({_anyl(kws, 'e')}) AND ({_anyl(kws, 'p')}))" for _, kws in lex.source_keywords)
    dpos = "coalesce(list_position(list_transform(pp, lambda p: contains(p, e) OR contains(e, p)), true), 0)"
    per = (f"len(list_filter(list_transform(pp, lambda p, i: {{'i': i, 'k': {kw}}}), "
           f"lambda s: s.k AND ({dpos} = 0 OR s.i < {dpos}))) + CASE WHEN {dpos} > 0 THEN 1 ELSE 0 END")
    return f"""(SELECT CASE WHEN len(xx) = 0 THEN (CASE WHEN len(pp) > 0 THEN {{'p': 1.0, 'r': 1.0, 'f': 1.0}}
                                                   ELSE {{'p': 0.0, 'r': 0.0, 'f': 0.0}} END)
          WHEN len(pp) = 0 THEN {{'p': 0.0, 'r': 0.0, 'f': 0.0}}
          ELSE {{'p': pr, 'r': rc, 'f': CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END}} END
   FROM (SELECT pp, xx, least(m / greatest(len(pp), 1), 1.0::DOUBLE) AS pr, least(m / greatest(len(xx), 1), 1.0::DOUBLE) AS rc
         FROM (SELECT pp, xx, coalesce(list_sum(list_transform(xx, lambda e: {per})), 0) AS m
               FROM (SELECT {P} AS pp, {X} AS xx))))"""


def _anyl(words, v: str) -> str:
    return " OR ".join(f"contains({v}, {S.q(w)})" for w in words)


def tokens_sql(x: str, lex=ELEX) -> str:
    t = f"list_distinct(regexp_extract_all(lower(coalesce({x}, '')), {S.q(lex.token_pattern)}))"
    return f"list_filter({t}, lambda w: NOT list_contains({S.lst(lex.stopwords)}, w))"


def relevance_sql(a="predicted_answer", q="question", g="ground_truth", lex=ELEX) -> str:
    A, Q, G = tokens_sql(a, lex), tokens_sql(q, lex), tokens_sql(g, lex)
    qo = f"(len(list_intersect({Q}, {A})) / greatest(len({Q}), 1))"
    go = f"(CASE WHEN len({G}) > 0 THEN len(list_intersect({G}, {A})) / greatest(len({G}), 1) ELSE 0.5 END)"
    return f"least(0.4::DOUBLE * {qo} + 0.6::DOUBLE * {go}, 1.0::DOUBLE)"


def halluc_eval_sql(a="predicted_answer", docs="doc_texts", t="ground_truth", lex=CLEX) -> str:
    pat = S.q(lex.article_ref)
    cited = f"list_distinct(regexp_extract_all({a}, {pat}))"
    found = (f"list_concat(flatten(list_transform({docs}, lambda d: regexp_extract_all(d, {pat}))), "
             f"regexp_extract_all(coalesce({t}, ''), {pat}))")
    missing = f"len(list_filter({cited}, lambda x: NOT list_contains({found}, x)))"
    return f"""(CASE WHEN {_any(lex.eval_refusals, a)} THEN false
  WHEN len({docs}) = 0 AND length({a}) > 100 THEN true
  WHEN len({docs}) = 0 THEN false
  WHEN len({cited}) = 0 THEN false
  ELSE {missing} > len({cited}) / 2.0 END)"""


def local_check_sql(a="predicted_answer", docs="doc_texts", lex=CLEX) -> str:
    ctx = f"array_to_string(list_transform({docs}[1:3], lambda d: substr(d, 1, 300)), ' ')"
    c1 = (f"list_transform(list_filter(regexp_extract_all({a}, {S.q(lex.answer_article)}), "
          f"lambda x: NOT contains({ctx}, x) AND length({ctx}) > 100), lambda x: '法条 ' || x || ' 可能不在检索结果中')")
    an = f"regexp_extract_all({a}, {S.q(lex.sentence_terms)})"
    cn = f"regexp_extract_all({ctx}, {S.q(lex.sentence_terms)})"
    c2 = (f"CASE WHEN len({an}) > 0 AND len({cn}) > 0 AND len(list_intersect({an}, {cn})) = 0 "
          f"THEN [{S.q(lex.claim_terms)}] ELSE []::VARCHAR[] END")
    long_ = f"(length({a}) > 1000 AND len({docs}) < 2)"
    c4 = f"CASE WHEN {long_} THEN [{S.q(lex.claim_long)}] ELSE []::VARCHAR[] END"
    risk = f"CASE WHEN regexp_matches({a}, {S.q(lex.hedging)}) OR {long_} THEN 'medium' ELSE 'low' END"
    return f"{{'risk_level': {risk}, 'claims': list_concat(list_concat({c1}, {c2}), {c4})}}"


_BASE = [_pairs_sql(), SAMPLES, answers_sql()]
_J = "j AS (SELECT s.*, a.predicted_answer, a.citations, a.confidence, a.latency, a.doc_texts FROM samples s JOIN answers a USING (conv_id, pair_no))"


@register("eval_correctness", S.with_(*_BASE, _J) +
          f"SELECT conv_id, pair_no, {correctness_sql()} AS is_correct FROM j")
def q_eval_correctness(spark, sf):
    j = _joined(spark, sf)
    return j.select("conv_id", "pair_no", E.correctness("predicted_answer", "ground_truth", "category", ELEX)
                    .alias("is_correct"))


@register("citation_f1", S.with_(*_BASE, _J) + f"""
SELECT conv_id, pair_no, round(v.p, 6) AS citation_precision, round(v.r, 6) AS citation_recall, round(v.f, 6) AS citation_f1
FROM (SELECT conv_id, pair_no, {prf_sql()} AS v FROM j)""")
def q_citation_f1(spark, sf):
    j = _joined(spark, sf).withColumn("v", E.citation_prf("citations", "expected_sources", ELEX))
    return j.select("conv_id", "pair_no", F.round("v.precision", 6).alias("citation_precision"),
                    F.round("v.recall", 6).alias("citation_recall"), F.round("v.f1", 6).alias("citation_f1"))


@register("eval_relevance", S.with_(*_BASE, _J) +
          f"SELECT conv_id, pair_no, round({relevance_sql()}, 6) AS relevance_score FROM j")
def q_eval_relevance(spark, sf):
    j = _joined(spark, sf)
    return j.select("conv_id", "pair_no", F.round(E.relevance("predicted_answer", "question", "ground_truth", ELEX), 6)
                    .alias("relevance_score"))


@register("halluc_eval", S.with_(*_BASE, _J) +
          f"SELECT conv_id, pair_no, {halluc_eval_sql()} AS has_hallucination FROM j")
def q_halluc_eval(spark, sf):
    j = _joined(spark, sf)
    return j.select("conv_id", "pair_no", H.eval_hallucination("predicted_answer", "doc_texts", "ground_truth", CLEX)
                    .alias("has_hallucination"))


@register("halluc_local", S.with_(*_BASE) + f"""
SELECT conv_id, pair_no, c.risk_level AS risk_level, array_to_string(c.claims, '|') AS claims,
       c.risk_level IN ('medium', 'high') AS has_risk
FROM (SELECT conv_id, pair_no, {local_check_sql()} AS c FROM answers)""")
def q_halluc_local(spark, sf):
    a = ad.eval_answers(spark, sf)
    c = H.local_check(F.col("predicted_answer"), F.array_join(F.transform(F.slice("doc_texts", 1, 3),
                                                                          lambda d: F.substring(d, 1, 300)), " "),
                      F.size("doc_texts"), CLEX)
    return a.select("conv_id", "pair_no", c.alias("c")).select(
        "conv_id", "pair_no", F.col("c.risk_level").alias("risk_level"),
        F.array_join("c.claims", "|").alias("claims"), F.col("c.has_risk").alias("has_risk"))


REPLIES = """hreplies AS (
  SELECT conv_id, pair_no, CASE (conv_id + pair_no) % 4
    WHEN 0 THEN 'Result: {"risk_level": "high", "problematic_claims": ["a", "b"], "reasoning": "x"}'
    WHEN 1 THEN '{"risk_level": "medium"}'
    WHEN 2 THEN '{"risk_level": '
    ELSE 'no json' END AS reply
  FROM answers)"""


def _hreplies(a):
    form = (F.col("conv_id") + F.col("pair_no")) % 4
    reply = (F.when(form == 0, F.lit('Result: {"risk_level": "high", "problematic_claims": ["a", "b"], '
                                     '"reasoning": "x"}'))
             .when(form == 1, F.lit('{"risk_level": "medium"}')).when(form == 2, F.lit('{"risk_level": '))
             .otherwise(F.lit("no json")))
    return a.withColumn("reply", reply)


_VERDICT = f"""(CASE WHEN {S.json_span_sql('r.reply')} = '' THEN {{'risk_level': 'low', 'claims': []::VARCHAR[]}}
  WHEN NOT {S.parsed_ok_sql('r.reply')} THEN {local_check_sql('a.predicted_answer', 'a.doc_texts')}
  ELSE {{'risk_level': coalesce(json_extract_string({S.json_span_sql('r.reply')}, '$.risk_level'), 'low'),
        'claims': coalesce(CAST(json_extract({S.json_span_sql('r.reply')}, '$.problematic_claims') AS VARCHAR[]), []::VARCHAR[])}} END)"""


@register("halluc_verdict", S.with_(*_BASE, REPLIES) + f"""
SELECT conv_id, pair_no, v.risk_level AS risk_level, array_to_string(v.claims, '|') AS claims,
       v.risk_level IN ('medium', 'high') AS has_risk
FROM (SELECT a.conv_id, a.pair_no, {_VERDICT} AS v FROM answers a JOIN hreplies r USING (conv_id, pair_no))""")
def q_halluc_verdict(spark, sf):
    a = _hreplies(ad.eval_answers(spark, sf))
    ctx = F.array_join(F.transform(F.slice("doc_texts", 1, 3), lambda d: F.substring(d, 1, 300)), " ")
    v = H.verdict_check(F.col("reply"), F.col("predicted_answer"), ctx, F.size("doc_texts"), CLEX)
    return a.select("conv_id", "pair_no", v.alias("v")).select(
        "conv_id", "pair_no", F.col("v.risk_level").alias("risk_level"), F.array_join("v.claims", "|").alias("claims"),
        F.col("v.has_risk").alias("has_risk"))


@register("halluc_warning", S.with_(*_BASE, REPLIES) + f"""
SELECT conv_id, pair_no,
  CASE WHEN v.risk_level IN ('medium', 'high') AND NOT (latency * 10 > 5.0)
       THEN trim(predicted_answer) || format('{H.DEFAULT.warning.replace("%s", "{}")}', v.risk_level)
            || CASE WHEN len(v.claims) > 0 THEN format('{H.DEFAULT.warning_claims.replace("%s", "{}")}', array_to_string(v.claims, ', ')) ELSE '' END
       ELSE trim(predicted_answer) END AS answer
FROM (SELECT a.*, {_VERDICT} AS v FROM answers a JOIN hreplies r USING (conv_id, pair_no))""")
def q_halluc_warning(spark, sf):
    """H3: warning appended on medium/high risk unless the check took > 5 s (latency x 10)."""
    a = _hreplies(ad.eval_answers(spark, sf))
    ctx = F.array_join(F.transform(F.slice("doc_texts", 1, 3), lambda d: F.substring(d, 1, 300)), " ")
    v = H.verdict_check(F.col("reply"), F.col("predicted_answer"), ctx, F.size("doc_texts"), CLEX)
    return a.select("conv_id", "pair_no", H.with_warning(F.col("predicted_answer"), v, F.col("latency") * 10)
                    .alias("answer"))


# ---- E7: the scored results, and the roll-ups over them --------------------------------------------
def scored(spark, sf, run="next"):
    return score(_joined(spark, sf, run), ELEX, CLEX).select(
        "conv_id", "pair_no", "category", "is_correct", "citation_precision", "citation_recall", "citation_f1",
        "has_hallucination", "relevance_score", "confidence", "latency")


def scored_sql(name: str = "scored", src: str = "j") -> str:
    return f"""{name} AS (
  SELECT conv_id, pair_no, category, {correctness_sql()} AS is_correct,
         v.p AS citation_precision, v.r AS citation_recall, v.f AS citation_f1,
         {halluc_eval_sql()} AS has_hallucination, {relevance_sql()} AS relevance_score, confidence, latency
  FROM (SELECT *, {prf_sql()} AS v FROM {src}))"""


_R6 = ", ".join(f"round({c}, 6) AS {c}" for c in ["citation_precision", "citation_recall", "citation_f1",
                                                  "relevance_score", "confidence", "latency"])


@register("eval_pipeline", S.with_(*_BASE, _J, scored_sql()) +
          f"SELECT conv_id, pair_no, category, is_correct, has_hallucination, {_R6} FROM scored")
def q_eval_pipeline(spark, sf):
    s = scored(spark, sf)
    return s.select("conv_id", "pair_no", "category", "is_correct", "has_hallucination",
                    *[F.round(c, 6).alias(c) for c in ["citation_precision", "citation_recall", "citation_f1",
                                                       "relevance_score", "confidence", "latency"]])


_AGG = """avg(CAST(is_correct AS DOUBLE)) AS accuracy, avg(confidence) AS avg_confidence,
  avg(citation_precision) AS citation_precision, avg(citation_recall) AS citation_recall,
  avg(citation_f1) AS citation_f1, avg(CAST(has_hallucination AS DOUBLE)) AS hallucination_rate,
  avg(relevance_score) AS avg_relevance, avg(latency) AS avg_latency, CAST(count(*) AS BIGINT) AS n"""


_ANSWERED = "avg(CASE WHEN coalesce(category, '') <> 'out_of_scope' THEN CAST(has_hallucination AS DOUBLE) END) AS hallucination_rate_answered"


@register("eval_metrics", S.round6(S.with_(*_BASE, _J, scored_sql()) + f"SELECT {_AGG}, {_ANSWERED} FROM scored",
                                   [*METRIC_COLS, "hallucination_rate_answered"]))
def q_eval_metrics(spark, sf):
    return round6(E.metrics(scored(spark, sf)), [*METRIC_COLS, "hallucination_rate_answered"])


@register("eval_by_category", S.round6(S.with_(*_BASE, _J, scored_sql()) +
          f"SELECT category, {_AGG}, CAST(grouping(category) AS INTEGER) AS is_total FROM scored GROUP BY ROLLUP (category)",
                                       METRIC_COLS))
def q_eval_by_category(spark, sf):
    return round6(E.metrics_by_category(scored(spark, sf)), METRIC_COLS)


@register("eval_coverage", S.with_(*_BASE) + """
SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count(a.conv_id) AS BIGINT) AS evaluated,
       CAST(count(*) - count(a.conv_id) AS BIGINT) AS failed
FROM samples s LEFT JOIN answers a ON s.conv_id = a.conv_id AND s.pair_no = a.pair_no""")
def q_eval_coverage(spark, sf):
    return E.coverage(ad.eval_samples(spark, sf), ad.eval_answers(spark, sf), ["conv_id", "pair_no"])


_RUN_SQL = S.with_(*_BASE, answers_sql("self", "answers2"), _J,
                                 _J.replace("j AS", "j2 AS").replace("answers a", "answers2 a"),
                                 scored_sql("s1", "j"), scored_sql("s2", "j2")) + f"""
SELECT run, CAST(run_order AS BIGINT) AS run_order, {_AGG},
       accuracy - lag(accuracy) OVER (ORDER BY run_order) AS delta_accuracy,
       citation_f1 - lag(citation_f1) OVER (ORDER BY run_order) AS delta_citation_f1,
       hallucination_rate - lag(hallucination_rate) OVER (ORDER BY run_order) AS delta_hallucination_rate
FROM (SELECT run, run_order, {_AGG} FROM (
        SELECT 'next' AS run, 1 AS run_order, * FROM s1 UNION ALL SELECT 'self', 2, * FROM s2)
      GROUP BY run, run_order)""".replace(f"SELECT run, CAST(run_order AS BIGINT) AS run_order, {_AGG},",
                                          "SELECT run, CAST(run_order AS BIGINT) AS run_order, accuracy, avg_confidence, "
                                          "citation_precision, citation_recall, citation_f1, hallucination_rate, "
                                          "avg_relevance, avg_latency, n,")


@register("run_compare", S.round6(_RUN_SQL, METRIC_COLS + ["delta_accuracy", "delta_citation_f1", "delta_hallucination_rate"]))
def q_run_compare(spark, sf):
    """Two runs (answers from the next turn / own turn) compared with deltas."""
    a = scored(spark, sf, "next").withColumn("run", F.lit("next")).withColumn("run_order", F.lit(1).cast("bigint"))
    b = scored(spark, sf, "self").withColumn("run", F.lit("self")).withColumn("run_order", F.lit(2).cast("bigint"))
    return round6(E.run_compare(a.unionByName(b)),
                  METRIC_COLS + ["delta_accuracy", "delta_citation_f1", "delta_hallucination_rate"])


@register("eval_report", S.with_(*_BASE, _J, scored_sql()) + f"""
SELECT CASE WHEN is_total = 1 THEN 'TOTAL' ELSE category END AS label, n,
       round(accuracy * 100, 2) AS accuracy_pct, round(citation_f1 * 100, 2) AS citation_f1_pct,
       round(hallucination_rate * 100, 2) AS hallucination_rate_pct, round(avg_latency, 2) AS avg_latency_s
FROM (SELECT category, {_AGG}, grouping(category) AS is_total FROM scored GROUP BY ROLLUP (category))""")
def q_eval_report(spark, sf):
    return E.report_lines(E.metrics_by_category(scored(spark, sf)))


# ---- E7 on the answer pipeline itself -----------------------------------------------------------------
_SYSTEM = S.with_(f"ans AS ({QA._ANSWER_SQL})", QA._FINAL_TEXTS, f"""samples AS (
  SELECT b.item_id AS conv_id, b.item_id AS pair_no, b.text AS question,
         CASE WHEN b.item_id % 4 = 3 THEN '' ELSE b.text END AS ground_truth,
         ['criminal_law', 'special_case', 'case_related', 'out_of_scope'][b.item_id % 4 + 1] AS category,
         CASE WHEN b.item_id % 4 = 3 THEN []::VARCHAR[] ELSE ['src' || CAST(b.item_id % 20 AS VARCHAR)] END AS expected_sources
  FROM benchmark b)""", """j AS (
  SELECT s.*, a.status, a.answer AS predicted_answer, a.confidence, 0.0::DOUBLE AS latency,
         CASE WHEN a.citations = '' THEN []::VARCHAR[] ELSE string_split(a.citations, ' | ') END AS citations,
         CASE WHEN a.status = 'answered' THEN coalesce(t.doc_texts, []::VARCHAR[]) ELSE []::VARCHAR[] END AS doc_texts
  FROM samples s JOIN ans a ON a.qid = s.conv_id LEFT JOIN texts t ON t.qid = a.qid)""", scored_sql())


@register("eval_system", _SYSTEM + """
SELECT conv_id AS qid, category, is_correct, has_hallucination, round(citation_precision, 6) AS citation_precision,
       round(citation_recall, 6) AS citation_recall, round(citation_f1, 6) AS citation_f1,
       round(relevance_score, 6) AS relevance_score, round(confidence, 6) AS confidence FROM scored""")
def q_eval_system(spark, sf):
    """Every benchmark question answered by the pipeline, and the answers scored."""
    out = F.col("qid") % 4 == 3
    samples = ad.questions(spark, sf).select(
        "qid", "question", "qvec", F.when(out, F.lit("")).otherwise(F.col("question")).alias("ground_truth"),
        F.element_at(F.array(*map(F.lit, ad.CATEGORIES)), (F.col("qid") % 4 + 1).cast("int")).alias("category"),
        F.when(out, F.array().cast("array<string>")).otherwise(
            F.array(F.concat(F.lit("src"), (F.col("qid") % 20).cast("string")))).alias("expected_sources"))
    s = evaluate_system(samples, ad.corpus(spark, sf), ad.judge_scores(spark, sf), lex=ELEX, check_lex=CLEX,
                        scope_groups=QA.GROUPS, rerank_words=QA.WORDS, min_relevance=QA.MIN_REL)
    return s.select("qid", "category", "is_correct", "has_hallucination", *[F.round(c, 6).alias(c) for c in (
        "citation_precision", "citation_recall", "citation_f1", "relevance_score", "confidence")])


@register("eval_numerals", """
SELECT doc_id, CASE WHEN n = 0 THEN '零' ELSE regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         substr('零一二三四五六七八九', CAST(n // 1000 + 1 AS INT), 1) || '千' || substr('零一二三四五六七八九', CAST(n // 100 % 10 + 1 AS INT), 1) || '百'
         || substr('零一二三四五六七八九', CAST(n // 10 % 10 + 1 AS INT), 1) || '十' || substr('零一二三四五六七八九', CAST(n % 10 + 1 AS INT), 1),
         '(零[千百十]?)+', '零', 'g'), '^零', ''), '零$', ''), '^一十', '十') END AS numeral,
       n AS years, doc_id % 3 <> 0 AS is_correct, true AS is_correct_digits_only
FROM (SELECT doc_id, CAST((n_chars * 7 + doc_id) % 10000 AS BIGINT) AS n FROM documents)""")
def q_eval_numerals(spark, sf):
    """E1 with Chinese numerals: a number of years per document, written out in the truth and in digits in the answer; every third
    answer is a year off, which digits alone can't show."""
    n = F.pmod(F.col("n_chars") * 7 + F.col("doc_id"), F.lit(10000)).cast("bigint")
    d = ad.table(spark, sf, "documents").select("doc_id", n.alias("n")).withColumn("numeral", numeral_text("n"))
    said = F.when(F.col("doc_id") % 3 == 0, F.col("n") + 1).otherwise(F.col("n")).cast("string")
    truth, pred = (F.concat(F.lit("处"), c, F.lit("年有期徒刑")) for c in (F.col("numeral"), said))
    category = F.lit("criminal_law")
    return d.select("doc_id", "numeral", numeral_value("numeral").alias("years"),
                    E.correctness(pred, truth, category, numerals=True).alias("is_correct"),
                    E.correctness(pred, truth, category).alias("is_correct_digits_only"))

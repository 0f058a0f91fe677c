"""The answer pipeline — scope gate -> hybrid retrieval -> judge rerank policy ->
relevance gate -> confidence -> citations -> answer, for a whole table of questions.

Control flow of the single-question reference (early returns) becomes a
``status`` column and qid-keyed semi/anti joins.  One kNN pass (the k=16 pool)
serves both the k=16 and the k=8 hybrid results.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import cut
from quarry.operators import answer as A
from quarry.operators import checks as H
from quarry.operators import fused
from quarry.operators import models as M
from quarry.operators import rank as K
from quarry.operators import retrieve as R
from quarry.operators.scope import combine_scope, expand_queries, refusal, scope_gate, scope_verdict
from quarry.streaming.session_history import generate_in_sessions

POOL_K = 16          # the reference retrieves 2 x RETRIEVAL_TOP_K before reranking
ANSWER_CHARS = 300   # extractive answer length


def retrieve_final(questions_in: DataFrame, corpus: DataFrame, judge: DataFrame | None, words,
                   qrows: DataFrame | None = None, final_k: int = params.RETRIEVAL_TOP_K,
                   with_count: bool = False, cached: list | None = None, stream_policy: bool = False):
    """Hybrid retrieval + rerank policy for in-scope questions: (qid, doc_id, type, domain, distance, pos).

    Persisted tables are appended to ``cached``, for the caller to release once the rows are written.

    One kNN pass builds the pool (persisted: the keyword bonuses and the final step both read
    it); everything after it is the fused per-question step (``operators.fused``), bounded by
    (questions x fetch x groups) rows."""
    if qrows is None:
        qrows = questions_in.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    n_rows = qrows.count()
    fetch = R.fetch_size(POOL_K)
    pool = R.pool(corpus, qrows, fetch).persist(StorageLevel.MEMORY_AND_DISK)
    if cached is not None:
        cached.append(pool)
    est = pool.count()      # the size that decides about broadcasts below
    sk, _ = R.quotas(POOL_K)
    statutes = pool.where((F.col("type") == "statute") & (F.col("rk") <= 2 * sk))
    bonus = R.keyword_bonus_table(statutes, questions_in, corpus, words, est_rows=est)
    policy = dict(redo=False, pool_size=params.RERANK_MAX_DOCS, top_k=final_k) if stream_policy else {}
    final = fused.final_docs(pool, bonus, judge, est_rows=est, pool_k=POOL_K, final_k=final_k, **policy)
    return (final, n_rows) if with_count else final


def answer_pipeline(questions: DataFrame, corpus: DataFrame, judge: DataFrame | None = None, *, scope_groups,
                    rerank_words, min_relevance: float = params.MIN_RELEVANCE,
                    confidence_threshold: float = params.CONFIDENCE_THRESHOLD,
                    refusal_template: str = A.REFUSAL_TEMPLATE, low_relevance_answer: str = A.LOW_RELEVANCE_ANSWER,
                    uncertain_answer: str = A.UNCERTAIN_ANSWER, qrows: DataFrame | None = None,
                    verdicts: DataFrame | None = None, check_lexicon: H.CheckLexicon = H.DEFAULT,
                    cached: list | None = None, scope_replies: DataFrame | None = None, expansions=None, templates=(),
                    embed_fn=None, generate_fn=None, prompt_template: str = A.PROMPT_TEMPLATE,
                    history: DataFrame | None = None, structured: bool = False, stream_policy: bool = False,
                    sessions: DataFrame | None = None, past: DataFrame | None = None) -> DataFrame:
    """One row per question: qid, status, detected_domain, n_docs, doc_ids, confidence,
    is_uncertain, answer, citations; with ``structured`` also citation_list, an array of
    (pos, source, doc_type, content, relevance_score).

    ``scope_replies`` (qid, reply) are a model's scope verdicts: a question without a keyword hit is out of scope if its
    verdict says so with enough confidence (G2/G3).  With ``expansions`` and ``embed_fn``, questions are searched with
    their first expanded queries too, embedded by that callable (G4/G5).  With ``generate_fn``, in-scope questions with
    documents are answered by it, from a prompt of context, question and ``history`` (qid, history_text) (A2-A4, M4); else the
    answer is the first excerpt.  ``stream_policy``: the judge sees all candidates up to its limit, the relevant ones of its
    best eight are kept, and retrieval is not redone when they are few (K3, stream variant).

    With ``sessions`` (qid, session, ord) the questions of a session are answered in order: a prompt holds the session's ``past``
    turns (session, batch_id, ord, qid, question, answer) and the answers given before it in this table, refusals included.  The rows
    then have a column said, the answer without warning, which is what later prompts hold (W3).

    Answered questions that the check policy (K9) marks as risky get a hallucination check:
    the model verdict from ``verdicts`` (qid, reply) when given, else the local heuristic
    check (what the reference falls back to without a model); medium/high risk appends the
    warning (H3)."""
    gated = scope_gate(questions, scope_groups)
    if scope_replies is not None:
        verdict = scope_verdict(scope_replies.select("qid", "reply")).select("qid", "is_in_scope", "verdict_confidence", "verdict_domain")
        gated = gated.join(verdict, "qid", "left").fillna({"is_in_scope": True, "verdict_confidence": 0.5})
        gated = combine_scope(gated).drop("is_in_scope", "verdict_confidence", "verdict_domain")
    inq = gated.where(~F.col("out_of_scope"))
    if qrows is None and expansions is not None and embed_fn is not None:
        asked = expand_queries(inq.select("qid", "question"), expansions, templates, max_expansions=params.MAX_EXPANSIONS)
        asked = M.embed(asked.select("qid", "ord", "query_text"), "query_text", embed_fn, out_col="qvec")
        qrows = asked.where(F.col("qvec").isNotNull()).select("qid", "ord", "qvec")
    final, n_rows = retrieve_final(inq, corpus, judge, rerank_words, qrows=qrows, with_count=True, cached=cached,
                                   stream_policy=stream_policy)
    final = final.persist(StorageLevel.MEMORY_AND_DISK)
    if cached is not None:
        cached.append(final)
    # at most RETRIEVAL_TOP_K rows per question row
    est = n_rows * params.RETRIEVAL_TOP_K
    docs = R.attach(final, corpus, ["content", "source", "article", "accusation"], est_rows=est)
    stats = K.doc_stats(final)
    cited = [F.array_sort(F.collect_list(A.citation_struct())).alias("citation_list")] if structured else []
    lists = docs.groupBy("qid").agg(
        *cited, F.array_sort(F.collect_list(F.struct(
            "pos", F.col("doc_id").cast("string").alias("id"),
            A.source_label("source", "type", "article", "accusation").alias("label"),
            cut("content", ANSWER_CHARS).alias("excerpt"),
            F.substring("content", 1, params.CONTEXT_CHARS_LOCAL).alias("ctx")))).alias("_l"))
    out = gated.select("qid", "out_of_scope", "detected_domain").join(stats, "qid", "left").join(lists, "qid", "left")
    oos, n = F.col("out_of_scope"), F.coalesce(F.col("n_docs"), F.lit(0))
    low = K.low_relevance(out, min_relevance)
    conf = K.confidence()
    status = F.when(oos, "out_of_scope").when(low, "low_relevance").otherwise("answered")
    answered = ~oos & ~low
    ids = F.coalesce(F.array_join(F.transform("_l", lambda s: s["id"]), ","), F.lit(""))
    # K9 -> H1/H2 -> H3 on answered questions
    excerpt = F.col("_l")[0]["excerpt"]
    def answer_of(text):
        return (F.when(oos, refusal("detected_domain", refusal_template)).when(low, F.lit(low_relevance_answer))
                .when(n == 0, F.lit(uncertain_answer)).otherwise(text))

    if generate_fn is not None:
        ask = out.where(answered & (n > 0)).select("qid").join(gated.select("qid", "question"), "qid").join(A.context_block(docs), "qid")
        if sessions is not None:
            turns = out.select("qid", answer_of(F.lit(None)).alias("answer")).join(gated.select("qid", "question"), "qid") \
                .join(ask.select("qid", "context"), "qid", "left").join(sessions.select("qid", "session", "ord"), "qid")
            generated = generate_in_sessions(turns, past, generate_fn, prompt_template).select("qid", F.col("answer").alias("_generated"))
        else:
            told = F.lit(A.NO_HISTORY)
            if history is not None:
                ask = ask.join(history.select("qid", "history_text"), "qid", "left")
                told = F.coalesce("history_text", told)
            ask = ask.select("qid", A.prompt("context", "question", told, prompt_template).alias("_prompt"))
            generated = M.generate(ask, "_prompt", generate_fn, out_col="_generated").select("qid", "_generated")
        out = out.join(generated, "qid", "left")
        excerpt = F.col("_generated")
    context = F.array_join(F.transform(F.slice("_l", 1, params.CONTEXT_DOCS_LOCAL), lambda s: s["ctx"]), " ")
    policy = K.check_policy(oos, n, low)
    if verdicts is not None:
        out = out.join(verdicts.select("qid", F.col("reply").alias("_reply")), "qid", "left")
        check = F.when(F.col("_reply").isNull(), H.local_check(excerpt, context, n, check_lexicon)).otherwise(
            H.verdict_check(F.col("_reply"), excerpt, context, n, check_lexicon))
    else:
        check = H.local_check(excerpt, context, n, check_lexicon)
    checked = F.when(policy["check"], H.with_warning(excerpt, check, F.lit(0.0), lex=check_lexicon)).otherwise(excerpt)
    return out.select(
        "qid",
        status.alias("status"),
        "detected_domain",
        F.when(oos, F.lit(0)).otherwise(n).cast("bigint").alias("n_docs"),
        F.when(oos, F.lit("")).otherwise(ids).alias("doc_ids"),
        F.when(oos, F.lit(params.OUT_OF_SCOPE_CONFIDENCE)).when(low, F.lit(params.LOW_RELEVANCE_CONFIDENCE))
        .otherwise(conf).alias("confidence"),
        F.when(oos | low, F.lit(True)).otherwise(K.is_uncertain(conf, n, confidence_threshold)).alias("is_uncertain"),
        answer_of(checked).alias("answer"),
        F.when(answered, F.array_join(F.transform("_l", lambda s: s["label"]), " | ")).otherwise(F.lit(""))
        .alias("citations"),
        *([F.when(answered, F.col("citation_list")).alias("citation_list")] if structured else []),
        *([answer_of(excerpt).alias("said")] if sessions is not None else []),
    )

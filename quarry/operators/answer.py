"""Answer assembly, citations and conversation history (A1-A10).

Per-question lists are built with ``collect_list(struct(pos, ...))`` only after
top-k, so a group never holds more than k rows; conversation windows are bounded
frames (``rowsBetween(-15, -1)``), never whole-conversation collections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import col_, cut

# Labels of the citation / context formats.
UNKNOWN_SOURCE = "未知来源"
STATUTE_TAG = "【法条】"
CASE_TAG = "【案例】"
CASE_NO_PREFIX = "(案号:"

# Our own wording of the answer templates (parameters of the pipeline).
REFUSAL_TEMPLATE = ("Sorry, your question concerns the {domain} domain, which this service does not cover. "
                    "Questions on criminal law are welcome.")
LOW_RELEVANCE_ANSWER = ("Sorry, no sufficiently relevant provisions were found for this question. "
                        "Please describe it with more specific legal terms.")
UNCERTAIN_ANSWER = "Sorry, this question cannot be answered reliably from the available sources."
PROMPT_TEMPLATE = "Sources:\n{context}\n\nConversation so far:\n{history}\n\nAnswer from the sources: {question}"
NO_HISTORY = "(no history)"
USER_LABEL = "User: "
ASSISTANT_LABEL = "Assistant: "


def source_label(source, type_, article, accusation, case_id=None) -> F.Column:
    """A1: source + '(article)' for statutes; + '【accusation】' and '(案号:id)' for cases."""
    src = F.coalesce(col_(source), F.lit(UNKNOWN_SOURCE))
    art = F.coalesce(col_(article), F.lit(""))
    acc = F.coalesce(col_(accusation), F.lit(""))
    cid = F.coalesce(col_(case_id), F.lit("")) if case_id is not None else F.lit("")
    st = F.concat(src, F.when(art != "", F.concat(F.lit("("), art, F.lit(")"))).otherwise(F.lit("")))
    cs = F.concat(src, F.when(acc != "", F.concat(F.lit("【"), acc, F.lit("】"))).otherwise(F.lit("")),
                  F.when(cid != "", F.concat(F.lit(CASE_NO_PREFIX), cid, F.lit(")"))).otherwise(F.lit("")))
    return F.when(col_(type_) == "statute", st).when(col_(type_) == "case", cs).otherwise(src)


def citation_struct(pos="pos") -> F.Column:
    """A1 per-doc citation: struct(pos, source, doc_type, content, relevance_score)."""
    return F.struct(
        col_(pos).alias("pos"),
        source_label("source", "type", "article", "accusation").alias("source"),
        F.coalesce(F.col("type"), F.lit("unknown")).alias("doc_type"),
        cut("content", params.CITATION_CHARS).alias("content"),
        F.coalesce(F.col("distance"), F.lit(params.DEFAULT_CITATION_SCORE)).alias("relevance_score"),
    )


def citations(docs: DataFrame) -> DataFrame:
    """A1: (qid, citations array<struct> in rank order)."""
    return docs.groupBy("qid").agg(F.array_sort(F.collect_list(citation_struct())).alias("citations"))


def context_entry(i, type_, source, article, accusation, content) -> F.Column:
    """A2: one context block entry."""
    src = F.coalesce(col_(source), F.lit(UNKNOWN_SOURCE))
    head = F.concat(F.lit("[来源"), col_(i).cast("string"), F.lit("] "))
    st = F.concat(head, F.lit(STATUTE_TAG), src, F.lit(" "), F.coalesce(col_(article), F.lit("")), F.lit("\n"),
                  col_(content))
    cs = F.concat(head, F.lit(CASE_TAG), src, F.lit("（"), F.coalesce(col_(accusation), F.lit("")), F.lit("）\n"),
                  col_(content))
    return F.when(col_(type_) == "statute", st).otherwise(cs)


def context_block(docs: DataFrame) -> DataFrame:
    """A2: (qid, context) entries joined by a blank line in rank order."""
    e = F.struct(F.col("pos"), context_entry("pos", "type", "source", "article", "accusation", "content").alias("t"))
    return docs.groupBy("qid").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(e)), lambda s: s["t"]), "\n\n").alias("context"))


def prompt(context, question, history_text, template: str) -> F.Column:
    """A3: fill ``{context}``, ``{question}``, ``{history}`` placeholders."""
    t = template.replace("%", "%%").replace("{context}", "%1$s").replace("{question}", "%2$s") \
        .replace("{history}", "%3$s")
    return F.format_string(t, col_(context), col_(question), col_(history_text))


def message_pairs(messages: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """A5: messages -> (user, assistant) pairs.  The latest user message is answered by the next
    assistant message; an assistant message without a pending user is skipped; other roles are
    ignored; a trailing unanswered user is dropped.  Output: conv, turn (of the answer), user,
    assistant, pair_no (1..)."""
    m = messages.where(F.col("role").isin("user", "assistant", "ai", "bot"))
    w = Window.partitionBy(conv).orderBy(order)
    m = m.withColumn("_prev_role", F.lag("role").over(w)).withColumn("_prev_text", F.lag("text").over(w))
    p = m.where(F.col("role").isin("assistant", "ai", "bot") & (F.col("_prev_role") == "user"))
    p = p.select(conv, order, F.col("_prev_text").alias("user"), F.col("text").alias("assistant"))
    return p.withColumn("pair_no", F.row_number().over(Window.partitionBy(conv).orderBy(order)).cast("bigint"))


def pairs_to_messages(pairs: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(user, assistant) pairs -> messages; pairs with a missing side are skipped."""
    ok = pairs.where(F.col("user").isNotNull() & F.col("assistant").isNotNull())
    ex = ok.select(conv, "pair_no", F.posexplode(F.array(
        F.struct(F.lit("user").alias("role"), F.col("user").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("assistant").alias("content")))).alias("k", "m"))
    return ex.select(conv, ((F.col("pair_no") - 1) * 2 + F.col("k")).cast("bigint").alias("msg_no"),
                     F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def history_window(pairs: DataFrame, conv: str = "conv_id", max_turns: int = params.MAX_HISTORY_TURNS,
                   text_turns: int = params.HISTORY_TEXT_TURNS) -> DataFrame:
    """A4: for every pair, the history preceding it (last ``max_turns`` pairs) as text: user cut
    to 200 + '...', assistant to 300 + '...', last ``2*text_turns`` lines; none -> fixed text.
    Adds n_history and history_text."""
    w = Window.partitionBy(conv).orderBy("pair_no").rowsBetween(-max_turns, -1)
    line = F.struct(F.col("pair_no"),
                    F.concat(F.lit(USER_LABEL), F.substring("user", 1, params.HISTORY_USER_CHARS), F.lit("...")).alias("u"),
                    F.concat(F.lit(ASSISTANT_LABEL), F.substring("assistant", 1, params.HISTORY_ASSISTANT_CHARS),
                             F.lit("...")).alias("a"))
    hist = F.collect_list(line).over(w)
    lines = F.flatten(F.transform(F.array_sort(hist), lambda s: F.array(s["u"], s["a"])))
    last = F.slice(lines, F.greatest(F.size(lines) - 2 * text_turns + 1, F.lit(1)), 2 * text_turns)
    return pairs.withColumn("n_history", F.size(hist).cast("bigint")).withColumn(
        "history_text", F.when(F.size(hist) == 0, F.lit(NO_HISTORY)).otherwise(F.array_join(last, "\n")))


def history_after_reset(messages: DataFrame, conv: str = "conv_id", order: str = "turn",
                        reset_role: str = "system") -> DataFrame:
    """A10: only the messages after the last reset event of each conversation remain."""
    last_reset = messages.where(F.col("role") == reset_role).groupBy(conv).agg(F.max(order).alias("_r"))
    return messages.join(last_reset, conv, "left").where(
        F.col("_r").isNull() | (F.col(order) > F.col("_r"))).drop("_r")


# The labels and icons of the two markdown formats below.
def citation_markdown(cites: DataFrame, preview: int = params.CITATION_PREVIEW_CHARS) -> DataFrame:
    """Citations as markdown; fields only when present; 150-char preview + '...'.
    Input rows: qid, pos, source(label), doc_type, accusation, articles, article, content."""
    def field(label, c, pre="", post=""):
        return F.when(F.coalesce(F.col(c), F.lit("")) != "",
                      F.concat(F.lit(label), F.lit(pre), F.col(c), F.lit(post), F.lit("\n"))).otherwise(F.lit(""))
    entry = F.concat(
        F.lit("**["), F.col("pos").cast("string"), F.lit("] "), F.col("source"), F.lit("**\n"),
        F.lit("- 类型: "), F.col("doc_type"), F.lit("\n"),
        field("- 罪名: ", "accusation"), field("- 相关法条: ", "articles", "第", "条"), field("- 条款: ", "article"),
        F.lit("- 内容摘要: "), F.substring("content", 1, preview), F.lit("...\n\n"))
    return cites.groupBy("qid").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", entry.alias("t")))), lambda s: s["t"]), "").alias("markdown"))


def search_markdown(docs: DataFrame) -> DataFrame:
    """Search results as markdown (count header, icon by source text, quoted content)."""
    icon = F.when(F.instr(F.coalesce(F.col("source"), F.lit("")), "法") > 0, F.lit("📜")).otherwise(F.lit("⚖️"))

    def field(label, c):
        return F.when(F.coalesce(F.col(c), F.lit("")) != "",
                      F.concat(F.lit(label), F.col(c), F.lit("\n"))).otherwise(F.lit(""))
    entry = F.concat(
        F.lit("#### "), icon, F.lit(" 文档 "), F.col("pos").cast("string"), F.lit("\n"),
        F.lit("- **来源**: "), F.coalesce(F.col("source"), F.lit("未知")), F.lit("\n"),
        field("- **罪名**: ", "accusation"), field("- **条款**: ", "article"),
        F.lit("\n> "), F.replace(F.col("content"), F.lit("\n"), F.lit("\n> ")), F.lit("\n\n---\n\n"))
    agg = docs.groupBy("qid").agg(F.count("*").alias("n"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", entry.alias("t")))), lambda s: s["t"]), "").alias("body"))
    return agg.select("qid", F.concat(F.lit("### 🔍 找到 "), F.col("n").cast("string"), F.lit(" 个相关文档\n\n"),
                                      F.col("body")).alias("markdown"))

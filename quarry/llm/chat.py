"""Chat formatting of reply trees (operator 1).

A node has a tree, an id, a parent, a role, a text and a score.  Iterative self-joins double the distance of ancestor
links until every root is reached; on the way they add up the scores from each node to its root.  The leaves of a tree
are ranked by the score of their path (ties: the longer path, then the smaller id), and for the best ``top_k`` the same
links, from the longest to the shortest, list every node of the path.  Each path is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for every turn.  Inside texts and roles a control string gets a
backslash behind its first character, or one more if it has some already, so ``parse`` restores every text exactly.
The loss mask is the list of spans of the assistants' texts in the formatted string, in code points.

Nulls: a null text or role is empty, a null score 0, null trees and null ids are values of their own.  A parent that
is not in the tree makes its child a root.  Rows with the same tree and id count once: the smallest by parent, role,
text, score.  Nodes on or below a cycle have no root and belong to no path.  An empty table gives no conversation.
Other columns, whatever their names, are not used.  A conversation is one row, so it has to fit into one.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# fixed values: control strings of common templates; all that starts with <| is reserved too
CONTROL_REST = r"\||/s>|s>|INST\]|/INST\]"
_ESCAPE = rf"([<\[])(\\*)(?={CONTROL_REST})"
_UNESCAPE = re.compile(rf"([<\[])(\\*)\\(?={CONTROL_REST})")
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1$2\\")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def escape_role(role: Column) -> Column:
    """A role stands on one line: per cent signs and line feeds are coded too."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    out = []
    for turn in formatted.split(OPEN)[1:]:
        role, _, rest = turn.partition("\n")
        out.append((unescape(role).replace("%0A", "\n").replace("%25", "%"), unescape(rest[:rest.index(CLOSE)])))
    return out


def masked(formatted: str, spans) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def format_trees(nodes: DataFrame, tree="tree", node="node", parent="parent", role="role", text="text", score="score",
                 top_k: int = 1) -> DataFrame:
    """(tree, branch, path_score, n_turns, formatted, loss_spans): the ``top_k`` best paths of every tree, branch 1 first."""
    stage = Stage(nodes.sparkSession, "chat")
    empty = F.lit("")
    body = nodes.select(
        _key(nodes[tree]).alias("t"), _key(nodes[node]).alias("n"), nodes[tree].alias("tree"),
        F.struct(F.when(nodes[parent].isNotNull(), _key(nodes[parent])).alias("p"), F.coalesce(nodes[role], empty).alias("role"),
                 F.coalesce(nodes[text], empty).alias("text"), F.coalesce(nodes[score], F.lit(0.0)).alias("score")).alias("v"))
    body = body.groupBy("t", "n").agg(F.min("tree").alias("tree"), F.min("v").alias("v")).select("t", "n", "tree", "v.*")
    body = stage.keep(body, "nodes")

    # ancestor links: after round k, up is the 2^k-th ancestor (null beyond the root), total and depth cover what is below it
    known = body.select("t", F.col("n").alias("p"))
    link = stage.keep(body.join(known.withColumn("there", F.lit(True)), ["t", "p"], "left")
                      .select("t", "n", F.when(F.col("there"), F.col("p")).alias("up"), F.col("score").alias("total"),
                              F.lit(1).cast("long").alias("depth")), "link0")
    links, closed, open_ = [], [link.filter("up IS NULL")], link.filter("up IS NOT NULL")
    left = open_.count()
    while left:
        links.append(open_.select("t", "n", "up"))
        every = reduce(DataFrame.unionByName, [*closed, open_])      # whoever has reached the root stays as it is
        further = every.select("t", F.col("n").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"),
                               F.col("depth").alias("depth2"))
        link = stage.keep(open_.join(further, ["t", "up"], "left").select(
            "t", "n", F.col("up2").alias("up"), (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")), f"link{len(links)}")
        closed.append(link.filter("up IS NULL"))
        open_, before = link.filter("up IS NOT NULL"), left
        left = open_.count()
        if left == before:
            break       # only nodes on and below cycles are left

    # leaves, ranked
    rooted = reduce(DataFrame.unionByName, closed)
    leaves = rooted.join(body.select("t", F.col("p").alias("n")).filter("n IS NOT NULL"), ["t", "n"], "left_anti")
    order = Window.partitionBy("t").orderBy(F.desc("total"), F.desc("depth"), "n")
    path = (leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= top_k)
            .select("t", "branch", "total", "n", F.lit(0).cast("long").alias("up_by")))
    for k in reversed(range(len(links))):
        hop = links[k].select("t", "n", F.col("up").alias("further"))
        path = path.join(hop, ["t", "n"], "left").select(
            "t", "branch", "total", F.explode(F.when(F.col("further").isNull(), F.array(F.struct("n", "up_by"))).otherwise(
                F.array(F.struct("n", "up_by"), F.struct(F.col("further").alias("n"),
                                                         (F.col("up_by") + (1 << k)).alias("up_by"))))).alias("x"),
        ).select("t", "branch", "total", "x.*")

    # one string a path, with the running offset of each turn
    turn = path.join(body.select("t", "n", "tree", "role", "text"), ["t", "n"])
    turn = turn.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))).withColumn("body", escape(F.col("text")))
    turn = turn.withColumn("piece", F.concat("head", "body", F.lit(CLOSE + "\n")))
    before = Window.partitionBy("t", "branch").orderBy(F.desc("up_by")).rowsBetween(Window.unboundedPreceding, -1)
    turn = turn.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    return turn.groupBy("t", "branch").agg(
        F.first("tree").alias("tree"), F.first("total").alias("path_score"), F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct((-F.col("up_by")).alias("at"), "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
    ).select("tree", "branch", "path_score", "n_turns", F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted"),
             "loss_spans")


def chains(rows: DataFrame, group: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as reply trees of one branch: every row answers the one before it."""
    by = Window.partitionBy(group).orderBy(F.col(order).asc_nulls_first(), role, text)
    return rows.select(F.col(group).alias("tree"), F.row_number().over(by).alias("node"), F.col(role).alias("role"),
                       F.col(text).alias("text")).select("tree", "node", F.expr("nullif(node - 1, 0)").alias("parent"), "role",
                                                         "text", F.lit(0.0).alias("score"))

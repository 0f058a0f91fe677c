"""URL filter: explicit rules first, gradient-boosted trees on lexical features for the rest (operator 3).

All of it is DataFrame expressions and pyspark.ml, inside the JVM.

* Host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path: from there up to '?', '#' or the
  end.  A null url or one without '://' has an empty host and path.
* A rule (verdict, 'host/path') fits its host and all subdomains if the url's path starts with the rule's path.
  The longest rule wins; of the same rule given twice, the blocking one.
* The trees learn from labelled urls (by default those that a rule decides): distinct ones, thinned by hash to about
  ``max_rows`` when there are more: each label by its own share, half of ``max_rows`` or what the other label leaves, and
  weighted back, so a rare label stays.  Suffix statistics (smoothed share blocked and log count of the host's last label
  and of the path's file suffix) come from all labelled urls.
* Without labelled urls of both kinds there is nothing to learn: then every verdict of the method is the one known
  kind, or 'allow' if there is none.

Repeated rows get equal verdicts; an empty table gives an empty result.  Columns of ``keep`` pass through; output
columns replace clashing names.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Stage

MAX_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
SMOOTHING = 10.0
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ALLOW, BLOCK = "allow", "block"
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy",
            "parameters", "query_length", "fragment", "hyphens", "escapes", "upper_ratio", "longest_label",
            "host_share", "host_count", "file_share", "file_count"]


def host_of(url: Column) -> Column:
    """The host; upper-case ASCII letters become lower-case, others stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) columns of the longest rule that fits, null where none does."""
    fits, verdicts = [], []
    for verdict, rule in sorted(set(rules), key=lambda r: (-len(r[1]), r[1], r[0] != BLOCK)):
        site, slash, rest = rule.partition("/")
        cond = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(slash + rest))
        fits.append(F.when(cond, F.lit(rule)))
        verdicts.append(F.when(cond, F.lit(verdict)))
    none = F.lit(None).cast("string")
    return F.coalesce(*fits, none), F.coalesce(*verdicts, none)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _suffixes(df: DataFrame) -> DataFrame:
    return (df.withColumn("_host_suffix", F.substring_index("host", ".", -1))
            .withColumn("_file_suffix", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1))))


def _lexical(df: DataFrame) -> DataFrame:
    """The features of a url alone; needs _url (not null), host and path."""
    url = F.col("_url")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda total, c: F.when(c == "", total).otherwise(
        total - ((F.length(url) - F.length(F.replace(url, c))) / n) * F.log2((F.length(url) - F.length(F.replace(url, c))) / n)))
    made = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": _count(F.col("path"), "/"), "labels": _count(F.col("host"), r"[^.]+"),
        "digit_ratio": _count(url, "[0-9]") / n,
        "host_digit_ratio": _count(F.col("host"), "[0-9]") / F.greatest(F.length("host"), F.lit(1)),
        "entropy": entropy, "parameters": F.when(query == "", 0.0).otherwise(_count(query, "[&;]") + 1),
        "query_length": F.length(query), "fragment": F.contains(url, F.lit("#")), "hyphens": _count(url, "[-_]"),
        "escapes": _count(url, "%[0-9A-Fa-f]{2}"), "upper_ratio": _count(url, "[A-Z]") / n,
        "longest_label": F.coalesce(F.array_max(F.transform(F.split("host", r"\."), lambda x: F.length(x))), F.lit(0)),
    }
    return df.select("*", *[c.cast("double").alias(k) for k, c in made.items()])


def _statistics(labelled: DataFrame, suffix: str, name: str) -> DataFrame:
    """One row per suffix; as many rows as there are suffixes, so it is joined by whatever way its size allows."""
    blocked = F.sum((F.col("label") == 0).cast("double"))
    return labelled.groupBy(suffix).agg(
        ((blocked + SMOOTHING / 2) / (F.count("*") + SMOOTHING)).alias(f"{name}_share"),
        F.log2(F.count("*") + 1.0).alias(f"{name}_count"))


def train(labelled: DataFrame, stage: Stage, max_rows: int = MAX_ROWS):
    """Trees from rows (_url, host, path, label 1 allow / 0 block), and a function that adds the suffix statistics.

    A suffix without labelled urls takes the statistics of all of them.  Returns (model or None, the verdict without a
    model, the function).
    """
    rows = stage.keep(_suffixes(labelled.groupBy("_url", "host", "path").agg(F.min("label").alias("label"))), "labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None, BLOCK if counts.get(0) else ALLOW, None
    total = sum(counts.values())
    host = stage.keep(_statistics(rows, "_host_suffix", "host"), "host")
    file = stage.keep(_statistics(rows, "_file_suffix", "file"), "file")
    share, size = (counts[0] + SMOOTHING / 2) / (total + SMOOTHING), math.log2(total + 1.0)

    def with_statistics(df: DataFrame) -> DataFrame:
        out = df.join(host, "_host_suffix", "left").join(file, "_file_suffix", "left")
        return out.fillna({"host_share": share, "host_count": size, "file_share": share, "file_count": size})

    shares = {k: min(1.0, max(max_rows / 2, max_rows - (total - n)) / n) for k, n in counts.items()}
    kept = F.when(F.col("label") == 0, shares[0]).otherwise(shares[1])
    sample = rows.filter(F.pmod(F.xxhash64("_url"), F.lit(1 << 30)) < kept * (1 << 30)).withColumn("weight", 1.0 / kept)
    sample = stage.keep(with_statistics(_lexical(sample)).select("label", "weight", *FEATURES), "sample")
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(data)
    stage.drop("sample", "labelled")
    return model, ALLOW, with_statistics


def judge(df: DataFrame, rules, url_col: str = "url", keep=("page_id",), label: Column | None = None,
          max_rows: int = MAX_ROWS) -> DataFrame:
    """The columns of ``keep``, host, path, rule and verdict of every row.

    ``label`` (1 allow, 0 block, null unlabelled) says what to learn from; by default the verdict of the rules.
    """
    made = ("host", "path", "rule", "verdict")
    keep = [c for c in keep if c not in made]
    lab = label.cast("double") if label is not None else F.lit(None).cast("double")
    rows = df.select(*[df[c].alias(f"_k{i}") for i, c in enumerate(keep)], lab.alias("_label"),
                     F.coalesce(df[url_col], F.lit("")).alias("_url"))
    rows = rows.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("_verdict", verdict)
    if label is None:
        rows = rows.withColumn("_label", F.when(F.col("_verdict") == ALLOW, 1.0).when(F.col("_verdict") == BLOCK, 0.0))
    stage = Stage(df.sparkSession, "urlfilter")
    model, constant, with_statistics = train(rows.filter("_label IS NOT NULL").withColumnRenamed("_label", "label"), stage, max_rows)
    if model is None:
        out = rows.withColumn("_method", F.lit(constant))
    else:
        data = with_statistics(_lexical(_suffixes(rows)))
        data = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data))
        out = data.withColumn("_method", F.when(F.col("prediction") == 1.0, ALLOW).otherwise(BLOCK))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", "rule",
                      F.coalesce("_verdict", "_method").alias("verdict"))

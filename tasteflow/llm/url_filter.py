"""URL filter: host rules first, then a naive Bayes score over segmented host and path tokens.

Rules name a host and a path prefix; a rule fits its host and all subdomains,
the longest fitting rule decides.  The URLs that rules decide also train the
model: host labels are split into words by a unigram Viterbi search, path
tokens are split at punctuation (runs of digits count as one token ``0``), and a
multinomial naive Bayes over these tokens judges the URLs without a rule.

The unigram counts come from the pages' own visible text.  Only words that
occur inside some host label are needed, so the label's substrings of lengths
that counted words have are joined to the counts: no dictionary is broadcast, and
a long label costs its length times the number of those lengths.  Everything works on distinct labels
and distinct (host, path) pairs, so a host that holds a third of all pages costs
one row; the verdicts are joined back to the pages.  Log-likelihoods are added
as whole micro-nats, so sums do not depend on their order.

Defined results: a null URL, or one without ``://``, has an empty host and path,
no rule, and the prior's verdict; unless both classes are taught the verdict is allow;
a score of exactly zero allows; repeated rows get the same verdict; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteflow.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MICRO = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``action`` is allow or block; ``path`` starts with a slash."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<rule, action> of the longest fitting rule, null fields without one."""
    found = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """Lower-case letter runs of the pages' visible text and how often they occur."""
    visible = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), "<[^>]*>", " ")
    found = F.regexp_extract_all(F.lower(visible), F.lit("\\p{L}+"), F.lit(0))
    return pages.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def best_split(label: str, known: dict[str, int], total: int) -> list[str]:
    """Most probable words of a label; an unknown word of k letters has probability 10 / (total 10^k).

    Log-probabilities are whole micro-nats.  Equal scores: the split with fewer words, then the
    one whose last word is longer.  An unknown word may start anywhere: its best start is kept
    as the search goes, and only starts within the longest known word are tried beside it.
    """
    log_total, letter = round(MICRO * math.log(max(total, 1))), round(MICRO * math.log(10))
    logs = {word: round(MICRO * math.log(n)) - log_total for word, n in known.items()}
    longest = max(map(len, logs), default=0)

    best: list[tuple[int, int, int]] = [(0, 0, 0)]  # score, -words, -start of the last word
    unknown = (0, -1, 0)  # the best start of an unknown word, its letters after the start not yet paid
    for end in range(1, len(label) + 1):
        options = [(unknown[0] - log_total - (end - 1) * letter, *unknown[1:])]
        for start in range(max(0, end - longest), end):
            log_prob = logs.get(label[start:end])
            if log_prob is not None:
                options.append((best[start][0] + log_prob, best[start][1] - 1, -start))
        best.append(max(options))
        unknown = max(unknown, (best[end][0] + end * letter, best[end][1] - 1, -end))
    out, end = [], len(label)
    while end:
        start = -best[end][2]
        out.append(label[start:end])
        end = start
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words): distinct host labels split by the unigram model in ``counts``, a stored table."""
    labels = labels.where(F.length("label") > 0)
    total = counts.agg(F.sum("n")).first()[0] or 0
    longest = labels.agg(F.max(F.length("label"))).first()[0] or 0
    # at most one length per letter of the longest label
    sizes = [r[0] for r in counts.select(F.length("word")).where(F.length("word") <= longest).distinct().collect()]
    starts = F.sequence(F.lit(1), F.length("label"))
    fitting = F.filter(F.lit(sorted(sizes)).cast("array<int>"), lambda n: n <= F.length("label") - F.col("start") + 1)
    pieces = labels.select("label", F.explode(starts).alias("start")).select(
        "label", F.explode(F.transform(fitting, lambda n: F.substring(F.col("label"), F.col("start"), n))).alias("word"))
    known = pieces.distinct().join(counts, "word").groupBy("label").agg(
        F.collect_list("word").alias("found"), F.collect_list("n").alias("ns"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(label: pd.Series, found: pd.Series, ns: pd.Series) -> pd.Series:
        return pd.Series([best_split(x, dict(zip(f, n)) if f is not None else {}, total)
                          for x, f, n in zip(label, found, ns)], dtype=object)

    return labels.join(known, "label", "left").select(
        "label", split("label", "found", "ns").alias("words"))


def path_tokens(path: Column) -> Column:
    plain = F.regexp_replace(F.translate(path, UPPER, LOWER), "[0-9]+", "0")
    return F.filter(F.split(plain, "[^\\p{L}0-9]+"), lambda t: t != "")


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", alpha: float = 1.0) -> DataFrame:
    """Per page: id, host, path, rule, verdict and the model's ``score`` in micro-nats (above zero: block)."""
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = parts.select("host", "path").distinct().withColumn(
        "_r", longest_rule(F.col("host"), F.col("path"), rules)).select("host", "path", "_r.rule", "_r.action")
    urls = written(urls, "urls")

    label = F.explode(F.split("host", "\\.")).alias("label")
    labels = urls.select(label).distinct()
    words = segmented(labels, written(word_counts(pages, html_col), "word-counts"))
    host_words = urls.select("host").distinct().select("host", label).join(words, "label").select(
        "host", F.explode("words").alias("token"))
    tokens = written(
        urls.join(host_words, "host").select("host", "path", "action", F.concat(F.lit("h:"), "token").alias("token"))
        .unionByName(urls.select("host", "path", "action", F.explode(path_tokens(F.col("path"))).alias("token"))
                     .withColumn("token", F.concat(F.lit("p:"), "token"))), "url-tokens")

    blocked = F.when(F.col("action") == "block", 1).otherwise(0)
    taught = tokens.where(F.col("action").isNotNull())
    per_token = taught.groupBy("token").agg(F.sum(blocked).alias("b"), F.sum(1 - blocked).alias("a"))
    sums = per_token.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    classes = urls.where(F.col("action").isNotNull()).agg(F.sum(blocked), F.sum(1 - blocked)).first()
    n_block, n_allow = classes[0] or 0, classes[1] or 0
    trained = bool(n_block and n_allow)
    prior = round(MICRO * math.log(n_block / n_allow)) if trained else 0
    total_b, total_a = (sums[0] or 0) + alpha * (sums[2] or 0), (sums[1] or 0) + alpha * (sums[2] or 0)
    weight = F.round(F.lit(float(MICRO)) * (F.ln(F.col("b") + alpha) - F.ln(F.col("a") + alpha) + F.lit(
        math.log(total_a / total_b) if trained else 0.0))).cast("bigint")
    model = per_token.select("token", (weight if trained else F.lit(0).cast("bigint")).alias("w"))

    scores = tokens.join(model, "token").groupBy("host", "path").agg(F.sum("w").alias("w"))
    verdicts = urls.join(scores, ["host", "path"], "left").select(
        "host", "path", "rule", "action", (F.coalesce("w", F.lit(0)) + F.lit(prior)).alias("score"))
    return parts.join(verdicts, ["host", "path"]).select(
        id_col, "host", "path", "rule",
        F.coalesce("action", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")

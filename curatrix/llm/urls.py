"""URL filter: rules by host and path, else logistic regression on hashed character n-grams.

Everything that touches rows is a DataFrame expression. The classifier is fitted by full
gradient steps: each step is one aggregation of a small labelled table, and the driver
holds the weights of a fixed number of buckets.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The rules, host suffix and start of the path, with their verdicts.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

BUCKETS = 2048
GRAMS = (3, 4, 5)
MAX_LABELLED = 2000
STEPS = 25
RATE = 4.0
MOMENTUM = 0.9


def _lower_ascii(text: F.Column) -> F.Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host in lower case and path of a url; both empty without `://` or for null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^[^?#]*", 0)
    return _lower_ascii(host), path


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> F.Column:
    """The longest rule that fits the host or one of its parents, and the start of the path."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, start = rule.split("/", 1)
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: F.Column, rules=RULES) -> F.Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def buckets(host: F.Column, path: F.Column, count: int = BUCKETS) -> F.Column:
    """Distinct buckets of the character n-grams of host and path, each with its marks."""
    def of(text: F.Column, mark: str) -> F.Column:
        marked = F.concat(F.lit(mark), text, F.lit(mark))

        def grams(n: int) -> F.Column:
            # A second parameter of the function would get the element's place.
            one = lambda i: F.pmod(F.xxhash64(F.substring(marked, i, F.lit(n))), F.lit(count)).cast("int")
            starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1)))
            return F.when(F.length(marked) >= n, F.transform(starts, one)).otherwise(F.array().cast("array<int>"))

        return F.concat(*map(grams, GRAMS))

    return F.array_distinct(F.concat(of(host, "^"), of(path, "|")))


def _literal(weights: list[float]) -> F.Column:
    """The weights as one constant array."""
    return F.from_json(F.lit(json.dumps(weights)), "array<double>")


def _logit(features: F.Column, weights: list[float], bias: float) -> F.Column:
    """Mean weight of the buckets, scaled by their root, and the constant."""
    table = _literal(weights)
    total = F.aggregate(features, F.lit(0.0), lambda s, b: s + F.element_at(table, b + 1))
    return total / F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double")) + F.lit(bias)


def fit(labelled: DataFrame, max_rows: int = MAX_LABELLED, steps: int = STEPS) -> tuple[list[float], float]:
    """Weights and constant from a small table of `url` and `blocked` (0 or 1), by gradient steps with momentum.

    At most `max_rows` different urls are used, picked by a digest of the url. Each step
    aggregates the gradient by bucket; at most `BUCKETS` sums reach the driver. Sums are
    rounded, so the order in which rows are added does not show.
    """
    host, path = host_and_path(F.col("url"))
    rows = (
        labelled.where("url is not null and blocked is not null")
        .groupBy("url")
        .agg(F.max("blocked").cast("double").alias("y"))
        .orderBy(F.xxhash64("url"), "url")
        .limit(max_rows)
        .select("y", buckets(host, path).alias("f"))
        .persist()
    )
    n, positive = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    weights, bias = [0.0] * BUCKETS, 0.0
    if not n or not 0 < positive < n:
        rows.unpersist()
        return weights, 20.0 if n and positive else -20.0
    bias = math.log(positive / (n - positive))
    moves, push = [0.0] * BUCKETS, 0.0
    for _ in range(steps):
        error = F.col("y") - 1 / (1 + F.exp(-_logit(F.col("f"), weights, bias)))
        scale = F.sqrt(F.greatest(F.size("f"), F.lit(1)).cast("double"))
        # The constant is bucket -1 of every url.
        share = rows.select(error.alias("e"), scale.alias("r"), F.explode(F.concat("f", F.array(F.lit(-1)))).alias("b"))
        part = F.when(F.col("b") < 0, F.col("e")).otherwise(F.col("e") / F.col("r"))
        sums = share.groupBy("b").agg(F.round(F.sum(part), 9).alias("g")).collect()
        gradient = {r["b"]: r["g"] for r in sums}
        moves = [MOMENTUM * m + RATE * gradient.get(b, 0.0) / n for b, m in enumerate(moves)]
        push = MOMENTUM * push + RATE * gradient.get(-1, 0.0) / n
        weights = [round(w + m, 9) for w, m in zip(weights, moves, strict=True)]
        bias = round(bias + push, 9)
    rows.unpersist()
    return weights, bias


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, **fit_options) -> DataFrame:
    """Verdict on every url: that of the longest rule, else that of the classifier.

    Returns `page_id`, `host`, `path`, `rule` (null if none fits), `verdict` (allow or
    block) and `score`, the classifier's probability of block. Without a labelled table
    the classifier learns from the urls that rules decide. A null url, or one without
    `://`, has an empty host and path. Repeated rows are judged each; a null id is kept;
    other columns are not read; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    if labelled is None:
        decided = pages.select("url", verdict_of(rule_of(host, path, rules), rules).alias("v"))
        labelled = decided.where("v is not null").select("url", (F.col("v") == "block").cast("int").alias("blocked"))
    weights, bias = fit(labelled, **fit_options)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    score = 1 / (1 + F.exp(-_logit(buckets(F.col("host"), F.col("path")), weights, bias)))
    rows = rows.withColumn("score", F.round(score, 6))
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(verdict_of(F.col("rule"), rules), own)
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")

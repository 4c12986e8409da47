"""Document quality: classifier evidence joined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, logistic, strings, written

FEATURES = ("size", "variety", "repeated", "upper", "marks", "bars", "digits", "word_length")


def text_features(text: str) -> tuple[float, ...]:
    """Shares and sizes that tell running text from junk; an empty text has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    size = len(text)
    upper = sum(map(str.isupper, words))
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return (
        float(np.log1p(n)),
        len(set(words)) / n,
        repeated / n,
        upper / n,
        min(1.0, (text.count("!") + text.count("?")) / n),
        min(1.0, text.count("|") / n),
        sum(map(text.count, "0123456789")) / size,
        min(4.0, size / n / 8),
    )


def _measured(rows: DataFrame, key: str, key_type: str) -> DataFrame:
    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray([text_features(t) for t in strings(batch.column(1))]).reshape(-1, len(FEATURES))
            columns = [pa.array(x[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *FEATURES])

    return rows.select(key, "text").mapInArrow(
        measure, f"{key} {key_type}, " + ", ".join(f"{f} double" for f in FEATURES)
    )


def _expand(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, x**2])


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from, so that scores can be judged on them."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 12_000) -> tuple[np.ndarray | None, float]:
    """Weights of a logistic regression and the base rate, from at most `max_docs` labelled texts."""
    picked = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # bounded by `max_docs`
    sample = _measured(rows, "quality", "int").collect()
    y = np.asarray([r["quality"] for r in sample], float)
    base = (y.sum() + 1) / (len(y) + 2)
    if not len(y) or y.min() == y.max():
        return None, float(base)
    x = np.asarray([[r[f] for f in FEATURES] for r in sample])
    return logistic(_expand(x), y, ridge=0.1), float(base)


def evidence(docs: DataFrame, weights: np.ndarray | None, base: float) -> DataFrame:
    """`doc_id`, `host`, `path` and `p_text`, the classifier's probability that a text is good."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    @giving_back
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if weights is None:
                p = np.full(batch.num_rows, base)
            else:
                x = np.asarray([text_features(t) for t in strings(batch.column(3))]).reshape(-1, len(FEATURES))
                z = np.column_stack([_expand(x), np.ones(len(x))]) @ weights
                p = 1 / (1 + np.exp(-np.clip(z, -12, 12)))
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(p)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", "path", "p_text"])

    schema = f"doc_id {kinds['doc_id']}, host {kinds['host']}, path {kinds['path']}, p_text double"
    return docs.select("doc_id", "host", "path", "text").mapInArrow(judge, schema)


def _strength(groups: DataFrame, mean: Column, prior: Column) -> float:
    """Weight of the prior, in documents, by the method of moments.

    The spread of group means around their priors, less what chance gives groups of their
    sizes, is the spread of true rates; a beta prior of weight `s` has the spread
    `m (1 - m) / (s + 1)`. Groups that differ no more than by chance get a strong prior.
    """
    chance = prior * (1 - prior) / F.col("n")
    row = groups.agg(
        F.sum(F.col("n") * (mean - prior) ** 2).alias("seen"),
        F.sum(F.col("n") * chance).alias("chance"),
        F.sum(F.col("n") * prior * (1 - prior)).alias("scale"),
    ).first()
    if not row["scale"]:
        return 1e6
    between = (row["seen"] - row["chance"]) / row["scale"]
    return float(np.clip(1 / between - 1, 1.0, 1e6)) if between > 1e-6 else 1e6


def site_sums(scored: DataFrame) -> DataFrame:
    """Documents and summed probabilities of each path, and of its host.

    Grouped sums only: a hot host is added up before it is shuffled.
    """
    paths = written(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p_text").alias("good")), "paths")
    hosts = paths.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    return written(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "sites")


def shrunk(good: Column, n: Column, prior: Column, strength: float) -> Column:
    """Posterior mean of a rate with a beta prior that weighs as much as `strength` documents."""
    return (good + strength * prior) / (n + strength)


def priors(sites: DataFrame) -> tuple[float, float, float]:
    """The rate of all documents, and the strengths of the priors of hosts and of paths."""
    whole = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = float(np.clip((whole["good"] or 0.0) / whole["n"], 1e-6, 1 - 1e-6)) if whole["n"] else 0.5
    hosts = sites.groupBy("host").agg(F.first("host_n").alias("n"), F.first("host_good").alias("good"))
    strong = _strength(hosts, F.col("good") / F.col("n"), F.lit(rate))
    of_host = shrunk(F.col("host_good"), F.col("host_n"), F.lit(rate), strong)
    near = _strength(sites, F.col("good") / F.col("n"), of_host)
    return rate, strong, near


def classify(
    docs: DataFrame, labels: DataFrame, host: str | Column, path: str | Column, threshold: float = 0.5, **fit_options
) -> DataFrame:
    """Quality of every document from its text and the site it comes from.

    Returns `doc_id`, `held_out`, `p_text` (classifier), `host_rate` and `path_rate` (posteriors
    of the site), `prior`, `score` (all together) and `keep` (score of at least `threshold`),
    one row per input row. The classifier's odds over the base rate are evidence; the prior
    is the posterior of the document's path from all its other documents, so its own
    evidence counts once. A path with few documents takes its host's rate, a host with few
    the overall one. Labels are learned only from rows that are not held out. Null texts
    count as empty; null hosts and paths are sites of their own; repeated rows count each;
    labels may repeat, be null or name unknown documents; without usable labels every text
    has the base rate. Empty tables give empty results.
    """
    bounded_batches(docs.sparkSession)
    sites = docs.select(
        "doc_id", (F.col(host) if isinstance(host, str) else host).cast("string").alias("host"),
        (F.col(path) if isinstance(path, str) else path).cast("string").alias("path"), "text",
    )
    weights, base = fit(docs, labels, **fit_options)
    scored = written(evidence(sites, weights, base), "evidence")
    sums = site_sums(scored)
    rate, strong, near = priors(sums)
    sums = sums.withColumnRenamed("host", "_host").withColumnRenamed("path", "_path")
    joined = scored.join(
        sums, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left"
    )

    def odds(p: Column) -> Column:
        inside = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
        return F.log(inside / (1 - inside))

    def posteriors(own: Column, one: int) -> tuple[Column, Column]:
        """Rates of host and path, without `one` document of probability `own`."""
        of_host = shrunk(F.col("host_good") - own, F.col("host_n") - one, F.lit(rate), strong)
        return of_host, shrunk(F.col("good") - own, F.col("n") - one, of_host, near)

    host_rate, path_rate = posteriors(F.lit(0.0), 0)
    _, prior = posteriors(F.col("p_text"), 1)
    score = 1 / (1 + F.exp(-(odds(F.col("p_text")) - odds(F.lit(base)) + odds(F.col("prior")))))
    rows = joined.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "p_text",
        host_rate.alias("host_rate"), path_rate.alias("path_rate"), prior.alias("prior"),
    )
    rows = rows.withColumn("score", score)
    return rows.withColumn("keep", F.col("score") >= threshold)

"""Yes / No / Unsure labels for texts, by rule or by a fitted model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import contains_term
from curatrix.session import broadcast_if_small, materialise, shared_dir, spread

# The labels a relevance job may give.
RELEVANCE = ("Yes", "No", "Unsure")


def term_hits(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur in the text, ignoring case."""
    lowered = F.lower(text)
    hits = F.lit(0)
    for term in terms:
        hits = hits + contains_term(lowered, F.lower(F.lit(term))).cast("int")
    return hits


def label_by_rule(text: Column, terms: Sequence[str], yes_from: int = 2, unsure_from: int = 1) -> Column:
    hits = term_hits(text, terms)
    return F.when(hits >= yes_from, "Yes").when(hits >= unsure_from, "Unsure").otherwise("No")


def fit_relevance(labelled: DataFrame, text: str, label: str, features: int = 1 << 14) -> PipelineModel:
    """Hashed TF-IDF and logistic regression; `label` holds 0 or 1.

    The model has one weight per hash bucket, so its size does not grow with the
    texts. Judge it on rows that were held out. The fitted model is stored and read back:
    as it comes from the fit it still holds the session that fitted it, which cannot
    travel to the tasks once that session has observed a write.
    """
    ready = spread(labelled).select(
        F.coalesce(text, F.lit("")).alias("_text"), F.col(label).cast("double").alias("_label")
    )
    fitted = Pipeline(
        stages=[
            Tokenizer(inputCol="_text", outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(
                featuresCol="_features",
                labelCol="_label",
                probabilityCol="_probability",
                rawPredictionCol="_raw",
                predictionCol="_prediction",
                maxIter=15,
                regParam=0.05,
            ),
        ]
    ).fit(ready)
    path = shared_dir(labelled.sparkSession, "relevance-model")
    fitted.write().save(path)
    return PipelineModel.load(path)


def label_by_model(
    df: DataFrame, text: str, model: PipelineModel, name: str = "relevance", no_below: float = 0.4,
    yes_from: float = 0.6,
) -> DataFrame:
    """Two probability cuts; in between is `Unsure`."""
    scored = model.transform(spread(df).withColumn("_text", F.coalesce(text, F.lit(""))))
    p = vector_to_array("_probability")[1]
    return scored.select(
        *df.columns, F.when(p >= yes_from, "Yes").when(p < no_below, "No").otherwise("Unsure").alias(name)
    )


def unexpected_labels(df: DataFrame, name: str = "relevance") -> DataFrame:
    """Rows whose label is none of the allowed ones; empty when the scorer behaves."""
    return df.filter(~F.coalesce(F.col(name).isin(*RELEVANCE), F.lit(False)))


# --- word odds, calibrated -------------------------------------------------------------

MICRO = 1_000_000
BINS = 100  # calibration bins on either side of even odds
_BIN_WIDTH = 20_000  # millionths of mean log odds of a word


@dataclass(frozen=True)
class Calibration:
    """Share of relevant texts, never falling, by bin of the score; in millionths."""

    bins: tuple[int, ...]
    shares: tuple[int, ...]

    def share(self, bin_: Column) -> Column:
        """The share of the nearest bin at or below, or of the first one; null without bins."""
        if not self.bins:
            return F.lit(None).cast("long")
        value = F.lit(self.shares[0])
        for at, share in zip(self.bins[1:], self.shares[1:], strict=True):
            value = F.when(bin_ >= at, share).otherwise(value)
        return F.when(bin_.isNotNull(), value).cast("long")


def pool_adjacent_violators(counts: Sequence[tuple[int, int]]) -> list[float]:
    """The shares that do not fall from bin to bin and are nearest to those of `(n, hits)`."""
    blocks: list[list[int]] = []  # rows, hits, bins
    for n, hits in counts:
        blocks.append([n, hits, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, hits, bins = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + hits, blocks[-1][2] + bins]
    return [hits / n for n, hits, bins in blocks for _ in range(bins)]


def word_odds(labelled: DataFrame, text: str, label: str) -> DataFrame:
    """`word` and `weight`: how much a text with the word is likelier to have label 1.

    Smoothed log odds in millionths, so that sums do not depend on their order. Words count
    once a text. Nothing comes to the driver but the numbers of texts.
    """
    known = labelled.filter(F.col(text).isNotNull() & F.col(label).isin(0, 1))
    ones, zeros = known.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    odds = F.ln((F.col("_ones") + 1) / F.lit(ones + 2)) - F.ln((F.col("_zeros") + 1) / F.lit(zeros + 2))
    return (
        known.select(label, F.explode(_distinct_words(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count_if(F.col(label) == 1).alias("_ones"), F.count_if(F.col(label) == 0).alias("_zeros"))
        .select("word", F.round(odds * MICRO).cast("long").alias("weight"))
    )


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"\s+"))


def odds_bins(texts: DataFrame, text: str, odds: DataFrame, name: str = "bin") -> DataFrame:
    """Add the bin of the mean weight of a text's different words that have one.

    Null for a text without such a word. Weights that are few travel to the texts; of more,
    words and weights meet in a shuffle. Rows are told apart by a number of their own.
    """
    numbered = materialise(spread(texts).withColumn("_row", F.monotonically_increasing_id()), "scored")
    odds = materialise(odds, "odds")
    held = broadcast_if_small(odds, max_rows=1_000_000, max_bytes=64 << 20)
    used = numbered.select("_row", F.explode(_distinct_words(F.col(text))).alias("word"))
    mean = F.floor(F.sum("weight") / (F.count(F.lit(1)) * _BIN_WIDTH)).cast("int")
    found = (
        used.join(held, "word")
        .groupBy(F.col("_row").alias("_of"))
        .agg(F.greatest(F.least(mean, F.lit(BINS)), F.lit(-BINS)).alias(name))
    )
    return numbered.join(found, F.col("_row") == F.col("_of"), "left").drop("_row", "_of")


def calibrate(binned: DataFrame, label: str, name: str = "bin") -> Calibration:
    """The share of label 1 by bin, from rows that the weights were not made from.

    The driver gets two numbers for each of at most `2 * BINS + 1` bins.
    """
    rows = (
        binned.filter(F.col(name).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("hits"))
        .collect()
    )
    rows = sorted(rows, key=lambda r: r[name])
    shares = pool_adjacent_violators([(r["n"], r["hits"]) for r in rows])
    return Calibration(tuple(r[name] for r in rows), tuple(round(s * MICRO) for s in shares))


def label_by_share(share: Column, error_rate: float) -> Column:
    """`Yes` or `No` where at most `error_rate` of such texts are labelled wrongly, else `Unsure`."""
    wrong = round(error_rate * MICRO)
    return F.when(share >= MICRO - wrong, "Yes").when(share <= wrong, "No").otherwise("Unsure")


@dataclass(frozen=True)
class OddsScorer:
    """Word odds, their calibration, and the stated share of wrong labels."""

    odds: DataFrame
    calibration: Calibration
    error_rate: float

    def label(self, texts: DataFrame, text: str, name: str = "relevance", share: str | None = None) -> DataFrame:
        """Add the label, and on request the calibrated share in millionths; order is not kept."""
        binned = odds_bins(texts, text, self.odds, "_bin").withColumn("_share", self.calibration.share(F.col("_bin")))
        binned = binned.withColumn(name, label_by_share(F.col("_share"), self.error_rate))
        if share is not None:
            binned = binned.withColumn(share, F.col("_share"))
        return binned.drop("_bin", "_share")


def fit_odds(labelled: DataFrame, text: str, label: str, error_rate: float = 0.1, calibrated: Column | None = None) -> OddsScorer:
    """Word odds from one part of the labelled texts, calibrated on the part `calibrated`.

    By default every other text by its digest, so that copies of a text stay in one part.
    A text without a label of 0 or 1 is not used.
    """
    if calibrated is None:
        calibrated = F.pmod(F.xxhash64(text), F.lit(2)) == 0
    odds = materialise(word_odds(labelled.filter(~calibrated), text, label), "odds")
    held_out = labelled.filter(calibrated).select(text, label)
    return OddsScorer(odds, calibrate(odds_bins(held_out, text, odds), label), error_rate)

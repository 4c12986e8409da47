"""Compression-distance classification with one zstandard dictionary per class."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, logistic, strings

_WORD = re.compile(r"\w+")
_REPEATS = 3  # a window below zstandard's smallest gain would not be compressed at all
_CACHED = 120_000  # words in each of the two halves of a worker's cache


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=14,
        hash_log=12,
        chain_log=12,
        search_log=5,
        min_match=4,
        target_length=64,
        strategy=zstandard.STRATEGY_BTOPT,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content)
    dictionary.precompute_compress(compression_params=_parameters())
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=_parameters())


def _train(words: list[str], size: int, rng: np.random.Generator, samples: int, more: list[str] = ()) -> bytes:
    """A dictionary trained on short texts drawn from the words of one class."""
    def drawn(source: list[str], count: int) -> list[bytes]:
        picks = rng.integers(0, len(source), (count, 4))
        return [f" {' '.join(source[i] for i in row)} ".encode() for row in picks]

    texts = drawn(words, samples) + (drawn(list(more), samples * 2 // 3) if len(more) > 4 else [])
    try:
        return zstandard.train_dictionary(size, texts, k=12, d=6).as_bytes()
    except zstandard.ZstdError:  # too few different samples: the words themselves
        return f" {' '.join(words)} ".encode()[-size:]


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the calibration of the features they give."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    base_rate: float
    key: str
    quiet_rate: float = 0.0  # share of toxic texts among those without a gain
    sizes: tuple[float, float] = (0.0, 0.0)  # log sizes between which the calibration was seen


class Gains:
    """Gains of the words seen last, for one model at a time.

    Words are entered in the newer half. When that is full it becomes the older one, whose
    words move on when they are met again, so frequent words stay. A worker serves many
    tasks and models; what it holds for another model is dropped.
    """

    def __init__(self) -> None:
        self.forget()

    def forget(self, key: str = "") -> None:
        self.key, self.newer, self.older = key, {}, {}

    def of(self, words: set[str], gain: Callable[[str], float]) -> list[float]:
        if len(self.newer) > _CACHED:
            self.newer, self.older = {}, self.newer
        newer, older, gains = self.newer, self.older, []
        for word in words:
            value = newer.get(word)
            if value is None:
                value = older.get(word)
                newer[word] = value = gain(word) if value is None else value
            gains.append(value)
        return gains


_GAINS = Gains()


class Windows:
    """Compression gain of the windows of a text: one window for each different word.

    The gain is the number of bytes that the toxic dictionary saves over the ordinary
    one, for ten bytes of the word.
    """

    def __init__(self, toxic: bytes, ordinary: bytes, key: str) -> None:
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.key = key

    def gain(self, word: str) -> float:
        window = (f" {word}" * _REPEATS + " ").encode()
        saved = len(self.ordinary.compress(window)) - len(self.toxic.compress(window))
        return 10.0 * saved / (len(window) // _REPEATS)

    def features(self, text: str) -> tuple[float, float, float]:
        words = set(_WORD.findall(text.lower()))
        if not words:
            return 0.0, 0.0, 0.0
        if _GAINS.key != self.key:
            _GAINS.forget(self.key)
        gains = sorted(_GAINS.of(words, self.gain), reverse=True)
        best = gains[:3]
        return best[0], sum(best), math.log1p(len(gains))


def held_out(doc_id: str) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int) -> DataFrame:
    """At most `max_docs` labelled texts outside the held-out part, picked by a digest of the id."""
    picked = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )
    # The number of rows is bounded by `max_docs`, and a row is two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def word_contexts(rows: DataFrame) -> DataFrame:
    """For each word, the number of different words before it in texts of either class.

    Copies of one text add nothing, so its rare words do not look typical of its class.
    """
    @giving_back
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[str, str, int]] = set()
            for text, toxic in zip(strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words = _WORD.findall(text.lower())
                found.update(zip(words, ["", *words], [toxic] * len(words), strict=False))
            rows_ = list(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows_], pa.string()),
                    pa.array([hash_of(r[1]) for r in rows_], pa.int64()),
                    pa.array([r[2] for r in rows_], pa.int32()),
                ],
                names=["word", "before", "toxic"],
            )

    seen = rows.select("text", "toxic").mapInArrow(pairs, "word string, before long, toxic int")
    return (
        seen.distinct()
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(F.lit(1) - F.col("toxic")).alias("ordinary"))
    )


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


def least_contexts(n_toxic: int) -> int:
    """Different words that must stand before a word in toxic texts to make it typical of them.

    Two for a handful of toxic texts, five from forty of them on, and a hundredth of
    their number where that is more. Rarer words are not learned; a text whose only toxic
    words are rarer scores by what else is in it.
    """
    return max(2, min(5, n_toxic // 8), math.ceil(0.01 * n_toxic))


def _expand(raw: np.ndarray, sizes: tuple[float, float]) -> np.ndarray:
    """Calibration features: steps of the best gain and of the sum of the three best.

    Sizes outside those the calibration has seen count as the nearest one it has.
    """
    best, three, size = raw[:, 0], raw[:, 1], np.clip(raw[:, 2], *sizes)
    steps = [np.clip(best, a, a + 1) - a for a in range(8)]
    steps += [np.clip(three, a, a + 3) - a for a in range(0, 24, 3)]
    return np.column_stack([*steps, size, size * np.clip(best, 0, 8)])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = 12_000,
    max_words: int = 30_000,
    rounds: int = 5,
    seed: int = 7,
) -> Model:
    """Train both dictionaries and calibrate on a bounded sample of labelled rows.

    At most `max_docs` labelled texts are read. Words typical of a class are those seen
    after many different words in its texts (see `least_contexts`; without such words
    every score is the base rate). The ordinary dictionary is trained again with the
    ordinary words that the toxic one compresses better. The driver gets at most
    `2 * max_words` words with two counts each, and four numbers for each text read.
    """
    rows = training_rows(docs, labels, max_docs).persist()
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    base = (n_toxic + 1) / (n_toxic + n_ordinary + 2)
    contexts = word_contexts(rows).persist()
    least = least_contexts(n_toxic)
    rate = (n_toxic + 1) / (n_ordinary + 1)
    typical = (
        contexts.where((F.col("toxic") >= least) & (F.col("toxic") > 10 * rate * (F.col("ordinary") + 0.5)))
        .orderBy(F.desc("toxic"), "word")
        .limit(max_words)
        .collect()
    )
    ordinary = [r["word"] for r in contexts.where("ordinary > 0").orderBy(F.desc("ordinary"), "word").limit(max_words).collect()]
    contexts.unpersist()
    toxic = [r["word"] for r in typical]
    if not toxic or not ordinary:
        rows.unpersist()
        return Model(b"", b"", (), base, "none")
    rng = np.random.default_rng(seed)
    common = ordinary[:4_000]
    toxic_dictionary = _train(toxic, 4_096, rng, 4_000)
    hard: list[str] = []
    own = set(toxic)
    for turn in range(rounds):
        ordinary_dictionary = _train(common, 32_768, rng, 9_000, hard)
        if hard:
            ordinary_dictionary += f" {' '.join(hard)} ".encode()
        if turn < rounds - 1:
            windows = Windows(toxic_dictionary, ordinary_dictionary, f"fit-{turn}")
            hard += [w for w in ordinary if w not in own and windows.gain(w) >= 2]
    _GAINS.forget()
    key = f"{hash_of(toxic_dictionary.hex())}-{hash_of(ordinary_dictionary.hex())}"
    model = Model(toxic_dictionary, ordinary_dictionary, (), base, key)
    sample = _features(rows.select("toxic", "text"), model, "toxic int").collect()
    rows.unpersist()
    raw = np.asarray([[r["best"], r["three"], r["size"]] for r in sample])
    y = np.asarray([r["toxic"] for r in sample], float)
    low, high = np.quantile(raw[:, 2], [0.05, 0.95]).tolist()
    weights = logistic(_expand(raw, (low, high)), y, ridge=1.0)
    quiet = raw[:, 0] < 1
    quiet_rate = min(base, (y[quiet].sum() + 1) / (quiet.sum() + 2))
    return Model(toxic_dictionary, ordinary_dictionary, tuple(weights.tolist()), base, key, quiet_rate, (low, high))


def _features(rows: DataFrame, model: Model, key_field: str) -> DataFrame:
    """Key (first column) and compression features of each text (second column)."""
    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(model.toxic, model.ordinary, model.key)
        for batch in batches:
            raw = np.asarray([windows.features(t) for t in strings(batch.column(1))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(raw[:, i]) for i in range(3))],
                names=[batch.schema.names[0], "best", "three", "size"],
            )

    return rows.mapInArrow(measure, f"{key_field}, best double, three double, size double")


def _probabilities(model: Model, windows: Windows | None, texts: pa.Array) -> np.ndarray:
    if windows is None:
        return np.full(len(texts), model.base_rate)
    raw = np.asarray([windows.features(t) for t in strings(texts)]).reshape(-1, 3)
    z = np.column_stack([_expand(raw, model.sizes), np.ones(len(raw))]) @ np.asarray(model.weights)
    # A text without a window is no evidence of anything.
    return np.where(raw[:, 2] > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), model.quiet_rate)


def _windows(model: Model) -> Windows | None:
    return Windows(model.toxic, model.ordinary, model.key) if model.weights else None


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """`doc_id`, `score` (0 to 1) and `predicted` (1 from `threshold`) of every whole text.

    Null and empty texts, and those without a word, have no window; their score is the
    share of toxic texts among the labelled ones without a gain, at most the base rate.
    Repeated rows are scored each; a null id is kept; other columns are not read.
    Nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    @giving_back
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(model)
        for batch in batches:
            p = _probabilities(model, windows, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {id_type}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit_options) -> DataFrame:
    """Fit on the labelled rows outside the held-out part and score all documents.

    Returns `doc_id`, `held_out`, `score` and `predicted`. Without usable labels every
    score is the base rate. Labels may name unknown documents, repeat or be null.
    """
    bounded_batches(docs.sparkSession)
    model = fit(docs, labels, **fit_options)
    scored = score(docs, model, threshold)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit_options) -> DataFrame:
    """The rows of `docs`, with all their columns, that score below `threshold`."""
    bounded_batches(docs.sparkSession)
    model = fit(docs, labels, **fit_options)

    @giving_back
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(model)
        for batch in batches:
            p = _probabilities(model, windows, batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(p < threshold))

    return docs.mapInArrow(keep, docs.schema)

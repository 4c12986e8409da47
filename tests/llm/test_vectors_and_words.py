"""Centroid clustering, document fingerprints and spelling variants against plain versions."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from curatrix.llm import centroids, fingerprints, variants  # noqa: E402

# Names that the operators use inside; a table may bring its own.
CLASHING = "id string, key string, slice int, turn int, v string, n int, word int, form int, apex int, cluster int, `order` int"
_EXTRA = ("x", "y", 1, 2, "v", 3, 4, 5, 6, 7, 8)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- centroid clustering --------------------------------------------------------------

CLUSTERED = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def vectors(n, groups, rng, spread=0.1):
    middles = rng.normal(size=(groups, 64))
    return [(i, [float(x) for x in middles[i % groups] + spread * rng.normal(size=64)]) for i in range(n)]


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, *_EXTRA) for r in rows], f"vec_id long, embedding array<double>, {CLASHING}").repartition(3)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = vectors(150, 5, rng) + vectors(90, 90, rng)  # ids repeat
    rows += [(900, None), (901, [0.5] * 63), (902, [float("nan")] * 64), (903, [None] + [0.5] * 63), (904, [float("-inf")] * 64), (905, [])]
    rows += [(906, [0.25] * 64)] * 40 + [(None, [0.25] * 64), (None, [-3.0] * 64)]
    assert rows_of(centroids.cluster(frame_of(spark, rows)), *CLUSTERED) == sorted(brute.clusters(rows), key=repr)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, [0.5] * 64)],
        [(i, [0.5] * 64) for i in range(20)],  # all alike: one centre has them all, the others none
        [(i, [i / 3 - 2] * 64) for i in range(12)],  # on a line: one pivot is enough
        [(i, [1.0 if j == i % 3 else -1.0 for j in range(64)]) for i in range(9)],  # ties
    ],
)
def test_clusters_of_few_and_flat_vectors(spark, rows):
    assert rows_of(centroids.cluster(frame_of(spark, rows)), *CLUSTERED) == sorted(brute.clusters(rows), key=repr)


def test_clusters_of_nothing_and_of_too_large_numbers(spark):
    none = frame_of(spark, [(1, None)])
    assert centroids.cluster(none).count() == 0
    assert centroids.cluster(none.limit(0)).columns == list(CLUSTERED)
    with pytest.raises(Exception, match="2\\^27"):
        centroids.cluster(frame_of(spark, [(1, [1e30] * 64)])).count()


@pytest.mark.parametrize("size", [1, 1000, 1 << 26])
def test_bounds_hold_and_leave_centres_out(size):
    rng = np.random.default_rng(1)
    middles = rng.integers(-size, size + 1, (32, 64))
    rows = np.concatenate([np.clip(m + rng.integers(-(size // 8) - 1, size // 8 + 2, (40, 64)), -size, size) for m in middles])
    simplex = centroids.Simplex(middles, 8)
    tops, apexes = simplex.project(middles), simplex.project(rows)
    exact = np.stack([centroids.squared(rows, m) for m in middles], axis=1)
    maybe = centroids.possible(apexes, tops)
    assert maybe[np.arange(len(rows)), exact.argmin(axis=1)].all()
    cluster, distance = centroids.assign(rows, apexes, middles, tops)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    if size > 1:
        assert maybe.mean() < 0.9


# -- fingerprints ---------------------------------------------------------------------


def test_edited_texts_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(" ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(30))) for _ in range(rng.randrange(8)))) for i in range(0, 900, 3)]
    rows += [(1, None), (2, ""), (4, "é"), (5, "漢字\n\n" * 9), (7, "a\n"), (8, "🙂" * 31), (10, "x\ny " * 40_000)]
    rows += [(None, "no id"), (None, None), (600, "another of this id"), (600, "another of this id"), (600, None), (-(2**63), "low"), (2**63 - 1, "high")]
    docs = spark.createDataFrame([(*r, *_EXTRA) for r in rows], f"doc_id long, text string, {CLASHING}").repartition(5)
    found = fingerprints.compare_edited(docs)
    want = brute.edited(rows)
    assert rows_of(found, "doc_id", "n_chars", "edited_sha256") == sorted((w[:3] for w in want), key=repr)
    expected = sorted(
        ((w[0], *(fingerprints.text_of(fingerprints.vector(t.encode())) for t in w[3:5])) for w in want), key=repr
    )
    assert rows_of(found, "doc_id", "fingerprint", "edited_fingerprint") == expected
    for row in found.collect():
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert row["near_edited"] == 1 or row["fingerprint"] != row["edited_fingerprint"]
    single = fingerprints.compare_edited(docs.where("doc_id = 10")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1
    assert fingerprints.compare_edited(docs.limit(0)).count() == 0


def plain_vector(text):
    """Paragraph by paragraph, window by window."""
    total = fingerprints.zero()
    for paragraph in text.encode().split(b"\n"):
        total = fingerprints.plus(total, fingerprints.vector(paragraph))
    return fingerprints.text_of(total)


@given(st.lists(st.text("ab\né ", max_size=40), min_size=1, max_size=6), st.randoms())
@settings(max_examples=200, deadline=None)
def test_vectors_add_up_in_any_order(parts, rng):
    text = "\n".join(parts)
    paragraphs = text.split("\n")
    rng.shuffle(paragraphs)
    whole = fingerprints.vector(text.encode())
    assert fingerprints.text_of(whole) == plain_vector("\n".join(paragraphs))
    rest = fingerprints.minus(whole, fingerprints.vector(paragraphs[0].encode()))
    assert fingerprints.text_of(rest) == (
        plain_vector("\n".join(paragraphs[1:])) if paragraphs[1:] else fingerprints.text_of(fingerprints.zero())
    )
    assert fingerprints.text_of(fingerprints.of_text(fingerprints.text_of(whole))) == fingerprints.text_of(whole)


def test_blocks_do_not_change_a_vector(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc \n") for _ in range(n)) for n in (0, 1, 7, 8, 9, 63, 64, 65, 500, 3000)] + ["a" * 700, "\n" * 200]
    whole = [fingerprints.text_of(fingerprints.vector(t.encode())) for t in texts]
    for size in (8, 64, 200):
        monkeypatch.setattr(fingerprints, "_BLOCK", size)
        assert [fingerprints.text_of(fingerprints.vector(t.encode())) for t in texts] == whole


def test_likeness_estimates_the_shared_part():
    rng = random.Random(3)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    lines = [line() for _ in range(100)]
    for shared in (0, 25, 50, 75, 100):
        other = lines[:shared] + [line() for _ in range(100 - shared)]
        found = fingerprints.likeness(*(fingerprints.vector("\n".join(x).encode()) for x in (lines, other)))
        assert abs(found - shared / 100) < 0.2
    assert fingerprints.likeness(fingerprints.zero(), fingerprints.vector(b"some text")) < 0.1


def test_changes_without_the_texts(spark):
    texts = {1: "one\ntwo\nthree", 2: "", 3: "same\nsame", 4: "left alone"}
    docs = spark.createDataFrame([*texts.items(), (None, "x")], "doc_id long, text string")
    changes = [(1, "two", -1), (1, "four", 1), (2, "", -1), (2, "a", 1), (2, None, 2), (3, "same", -1), (3, "same", 3)]
    changes += [(3, "hot", 1)] * 3000 + [(3, "hot", -1)] * 2999 + [(9, "unknown", 1), (None, "x", 1), (4, "y", None), (4, "z", 0)]
    log = spark.createDataFrame(changes, "doc_id long, paragraph string, times long").repartition(4)
    found = {r["doc_id"]: r["fingerprint"] for r in fingerprints.changed(fingerprints.fingerprints(docs), log).collect()}
    after = {1: "four\none\nthree", 2: "a\n\n", 3: "hot\nsame\nsame\nsame\nsame", 4: "left alone", None: "x"}
    assert found == {who: plain_vector(text) for who, text in after.items()}


# -- spelling variants ----------------------------------------------------------------

VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def test_word_counts_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    stock = ["".join(rng.choice("abÉé÷ßÄ") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    rows = [(i, "".join(rng.choice(stock) + rng.choice([" ", "\n", "1", "Ā", "漢", "\x00"]) for _ in range(rng.randrange(400)))) for i in range(60)]
    rows += [(None, rows[0][1]), (1, rows[1][1]), (2, None), (3, ""), (4, "ABCDE" * 300_000), (5, "Hello WORLD " * 200_000)]
    docs = spark.createDataFrame([(*r, *_EXTRA) for r in rows], f"doc_id long, text string, {CLASHING}").repartition(3)
    for every in (None, 97, 3):
        found = variants.word_counts(docs, slip_every=every)
        assert rows_of(found, "word", "n") == sorted(brute.word_counts(rows, every).items(), key=repr)
    assert variants.word_counts(docs.limit(0)).count() == 0


def test_variants_equal_brute_force(spark):
    rng = random.Random(1)
    counts = {}
    for _ in range(700):
        word = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
        counts[word] = rng.choice([1, 2, 3, 4, 8, 16, 50, 100])
    counts |= {"hello": 50, "helo": 3, "hellllo": 1, "helllo": 4, "🙂🙂a": 2, "🙂a": 9, "a" * 200: 1, "a" * 199: 5}
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, key string").repartition(5)
    found = variants.spelling_variants(words)
    assert rows_of(found, *VARIANT) == sorted(brute.variants(counts), key=repr)


def test_variants_of_chains_ties_and_odd_words(spark):
    chain = {"m" * 5 + "abcdefghij"[i] * (i + 1): 2**i for i in range(10)}
    step = {"kernel": 100, "kernal": 40, "kernat": 10, "kerat": 4, "keratt": 2, "karatt": 1}
    ties = {"green": 10, "greet": 10, "greem": 3, "gree": 10}
    counts = chain | step | ties
    rows = [*counts.items(), ("kernel", 0), (None, 5), ("", 7), ("a\x00b", 3), ("ab", 9)]
    found = {r["word"]: r for r in variants.spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert None not in found and found[""]["n_near"] == 0 and found["a\x00b"]["n_near"] == 0 and found["ab"]["n_near"] == 0
    want = {r[0]: r for r in brute.variants(counts)}
    assert {w: tuple(found[w][c] for c in VARIANT) for w in counts} == want
    assert found["karatt"]["root"] == "kernel" and found["greem"]["form"] == "gree"
    assert variants.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        variants.spelling_variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_a_pair_of_near_words_meets_once(spark):
    words = ["letter", "leter", "lettter", "better", "setter", "lette", "xletter", "lletter"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = {r["word"]: r["n_near"] for r in variants.nearest(df).collect()}
    assert found == {w: sum(brute.one_apart(w, v) for v in words) for w in words}


def test_queries_of_the_given_tables(spark):
    from curatrix.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op13_permuterm_variants"](spark, folder)
    assert rows_of(found, *VARIANT) == sorted(brute.variants(brute.word_counts(rows)), key=repr)
    found = QUERIES["op12_multiset_fingerprint"](spark, folder)
    assert rows_of(found, "doc_id", "n_chars", "edited_sha256") == sorted((w[:3] for w in brute.edited(rows)), key=repr)
    near = found.agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("double"))).first()[0]
    assert near > 0.95
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = QUERIES["op11_simplex_clustering"](spark, folder)
    assert rows_of(found, *CLUSTERED) == sorted(brute.clusters(rows), key=repr)

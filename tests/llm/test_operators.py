"""Operators of the llm subpackage against plain versions, and their edge cases."""

from __future__ import annotations

import random
import sys
import textwrap
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from curatrix.llm import (  # noqa: E402
    decontamination,
    jaccard,
    licences,
    packing,
    quality,
    repeats,
    shingles,
    suffixes,
    tokens,
    topk,
    toxicity,
    urls,
)
from curatrix.llm.graph import components  # noqa: E402

# Names that the operators use inside; a table may bring its own.
CLASHING = "id string, key string, n int, digest string, keys string, part int, score int, rank int, keeper int, unit int"
_EXTRA = ("x", "y", 1, "d", "k", 7, 3, 4, 5, 6)


def words(rng, n, pool=4000):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="module")
def messy(spark):
    """Near and exact copies, shared passages, hot lines, nulls, empty, long and repeated rows."""
    rng = random.Random(5)
    base = [words(rng, rng.randrange(5, 300)) for _ in range(60)]
    passage, line = words(rng, 60), "A line that very many documents have, word for word."
    rows = [(1, None), (2, ""), (3, "one two"), (4, "one two"), (5, "ONE\ttwo"), (6, "é" * 60), (7, "aé" + "é" * 59)]
    for i, text in enumerate(base):
        rows.append((10 + i, text))
        parts = text.split()
        if i % 3 == 0:
            rows.append((200 + i, text))
        if i % 4 == 0:
            for k in range(3):
                parts[rng.randrange(len(parts))] = f"edit{k}"
                rows.append((300 + 10 * i + k, " ".join(parts)))
        if i % 5 == 0:
            rows.append((1000 + i, f"{words(rng, 20)} {passage} {words(rng, 30)}"))
        if i % 2 == 0:
            rows.append((2000 + i, f"{words(rng, 40)}\n{line}\n{words(rng, 10)}"))
    long = words(rng, 60_000, 50_000)
    rows += [(5000, long), (5001, long[1000:]), (5002, "ab " * 20_000), (5003, "ab " * 9_000)]
    rows += [(None, base[0]), (None, None), (10, base[0]), (3, "one two"), (6000, base[1] + " " + base[2])]
    return rows


@pytest.fixture(scope="module")
def frames(spark, messy):
    docs = spark.createDataFrame([(*r, *_EXTRA) for r in messy], f"doc_id long, text string, {CLASHING}").repartition(3)
    return docs, docs.limit(0)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- token counts ---------------------------------------------------------------------


def test_token_counts_equal_the_library(frames, messy):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs, none = frames
    got = sorted_rows(tokens.token_counts(docs, path, max_chars=500), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for who, text in messy:
        n = len(model.encode(text or ""))
        want.append((who, len((text or "").encode()), n, n > 4096))
    assert got == sorted(want, key=repr)
    assert tokens.token_counts(none, path).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_safe_cuts_keep_the_count(name):
    lengths, keep = tokens._counter(public_tokenizers.path(name))
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab1 é\n\t .<|s>▁漢  ") for _ in range(rng.randrange(200)))
        parts = list(tokens.split_safely(text, 5, keep))
        assert sum(lengths(parts)) == lengths([text])[0], text


# -- repeats --------------------------------------------------------------------------


def test_repeats_equal_brute_force(frames, messy):
    docs, none = frames
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted_rows(repeats.remove_repeats(docs), *columns) == sorted(brute.repeats(messy), key=repr)
    assert repeats.remove_repeats(none).count() == 0


def test_repeats_of_keys_dealt_over_parts(spark, messy, monkeypatch):
    """First documents and keys that many share are dealt by key and by window."""
    rng = random.Random(12)
    line = "Printed on recycled paper 26"  # makes one bucket, with other text around it
    rows = messy + [(7000 + i, words(rng, 12) + line + words(rng, 12) + ("tail " * 9 if i % 3 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = sorted(brute.repeats(rows), key=repr)
    for together in (2, 40):
        monkeypatch.setattr(repeats, "_TOGETHER", together)
        assert sorted_rows(repeats.remove_repeats(docs), *columns) == want


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "a" * 525_000), (2, "b" + "a" * 60)],
        [(1, "chbhfhdfcbdcLicence: see the file COPYING.cchdcbcbgfbg"), (2, "dhfchhghbhhgLicence: see the file COPYING.fbdhdhccgfcb")],
        [(3, "u" + "0123456789" * 6 + "vw"), (45, "x" + "0123456789" * 6 + "yz")],  # dealt to one task by their ids
    ],
    ids=["one character over two shares", "thirty bytes", "settled in one batch"],
)
def test_parts_without_a_later_window(spark, rows):
    """Parts and shares of a part in which no window has to go."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted_rows(repeats.remove_repeats(docs), *columns) == sorted(brute.repeats(rows), key=repr)


def test_window_keys_depend_on_the_window_only():
    rng = np.random.default_rng(1)
    window = rng.integers(97, 101, 50, dtype=np.uint8)
    keys = set()
    for _ in range(20):
        before, after = (rng.integers(97, 101, rng.integers(0, 90), dtype=np.uint8) for _ in range(2))
        data = np.concatenate([before, window, after])
        for part in suffixes.stretches(data, np.asarray([0, len(data)])):
            place, nth, _ = part.windows(np.arange(len(part.key)))
            keys.add(int(part.key[nth[place == len(before)]][0]))
    assert len(keys) == 1


def test_every_window_is_in_one_stretch():
    sizes = [0, 49, 50, 51, 0, 300, 10, 120]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.random.default_rng(2).integers(97, 99, offsets[-1], dtype=np.uint8)
    places = [p.windows(np.arange(len(p.key)))[0] for p in suffixes.stretches(data, offsets)]
    want = [o + k for o, n in zip(offsets, sizes, strict=False) for k in range(max(0, n - 49))]
    assert sorted(np.concatenate(places).tolist()) == want


def test_cut_repeats_keeps_columns_and_whole_characters(spark):
    text = "é" * 40
    rows = [(1, "x" + text, "en", 41), (2, "yé" + text + "z", "en", 43), (3, None, "en", 0), (4, "x" + text, "de", 41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = {r["doc_id"]: r for r in repeats.cut_repeats(docs).collect()}
    assert set(out) == {1, 2, 3} and out[1]["text"] == rows[0][1] and out[3]["text"] is None
    assert out[2]["n_chars"] == len(out[2]["text"]) and out[2]["text"].endswith("z")


# -- near duplicates ------------------------------------------------------------------


def test_jaccard_components_equal_brute_force(frames, messy):
    docs, none = frames
    got = sorted_rows(jaccard.similar_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard(messy), key=repr)
    assert jaccard.similar_components(none).count() == 0


def test_small_sets_and_chains(spark):
    """Sets of every small size, each at the edge of the similarity."""
    rng = random.Random(9)
    rows, who = [], 0
    for n in range(1, 40):
        base = [f"t{n}x{k}" for k in range(n + 4)]
        for k in range(5):  # each differs a little from the one before
            rows.append((who, " ".join(base)))
            who += 1
            base[rng.randrange(len(base))] = f"e{n}x{k}"
        rows.append((who, " ".join([*base, "tail"])))
        who += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted_rows(jaccard.similar_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard(rows), key=repr)


def test_similar_sets_share_more_keys_than_they_skip(spark):
    rng = np.random.default_rng(4)
    skipped = 0
    for size in [4, 5, 7, 9, 12, 20, 45, 100, 400]:
        for _ in range(60):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            drop = rng.integers(0, size // 9 + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, 2 + size // 9), dtype=np.uint64)])
            common = size - drop
            if 100 * common < 80 * (size + len(b) - common):
                continue
            sets = [np.sort(a), np.sort(b)]
            sizes = np.asarray([len(s) for s in sets])
            owner, token = np.repeat([0, 1], sizes), np.concatenate(sets)
            keys = [set(), set()]
            for who, key in jaccard.signatures(owner, token, sizes):
                for w, k in zip(who, key, strict=True):
                    keys[w].add(int(k))
            shared = len(keys[0] & keys[1])
            band, own, next_ = jaccard.index_shape(owner, token, sizes)
            if band[0] == band[1]:
                assert shared > own.max() + next_.max() + 1
            else:
                low = int(band[1] < band[0])
                assert shared > max(next_[low], own[1 - low])
            skipped += int(own.max() > 1)
    assert skipped > 50


def test_bitmaps_keep_similar_pairs_and_stop_unlike_ones(spark):
    rng = np.random.default_rng(14)
    rows, wanted = [], []
    sketch_type = ", ".join(f"{c}_{e} {'array<long>' if c == 'wide' else 'long'}" for e in "xy" for c in jaccard._SKETCH)
    for size in (4, 9, 60, 250, 257, 300, 520, 900, 1500, 3000, 4000):
        for share in (1.0, 0.95, 0.81, 0.7, 0.5, 0.0):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            common = int(np.ceil(2 * size * share / (1 + share)))  # of two sets of one size
            b = np.concatenate([a[:common], rng.integers(0, 1 << 63, size - common, dtype=np.uint64)])
            sets = [np.sort(a), np.sort(b[rng.integers(0, 1 + size // 40) :])]
            sizes = np.asarray([len(s) for s in sets])
            both = len(np.intersect1d(*sets))
            folded, wide = jaccard.sketches(np.repeat([0, 1], sizes), np.concatenate(sets), sizes)
            assert [len(w) for w in wide] == [w if w > 16 else 0 for w in jaccard.sketch_words(sizes)]
            rows.append((*(v for k in (0, 1) for v in (*folded[k].tolist(), wide[k].tolist())), *sizes.tolist(), len(wanted)))
            wanted.append((share, 100 * both >= 80 * (sizes.sum() - both)))
    pairs = spark.createDataFrame(rows, f"{sketch_type}, n_x long, n_y long, pair int")
    found = {r["pair"] for r in pairs.where(jaccard.may_be_similar("x", "y")).collect()}
    assert found >= {k for k, (_, similar) in enumerate(wanted) if similar}
    assert not [k for k, (share, similar) in enumerate(wanted) if share <= 0.5 and k in found and rows[k][-3] > 20]


def test_shingles_equal_brute_force(messy):
    texts = [(t or "").encode() for _, t in messy]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    owner, _ = shingles.shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets)
    counts = np.bincount(owner, minlength=len(texts))
    assert counts.tolist() == [len(brute.shingles(t)) for _, t in messy]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_one_of_each(spark):
    text = words(random.Random(1), 50)
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (9, "other words here", "c"), (None, text, "d"), (8, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted_rows(jaccard.one_of_each(docs), "doc_id", "source") == sorted(
        [(3, "b"), (9, "c"), (None, "d"), (8, "e")], key=repr
    )


# -- decontamination ------------------------------------------------------------------


def test_matches_equal_brute_force():
    rng = random.Random(2)
    items = [(i, decontamination.normalise(words(rng, rng.randrange(6, 30), 60))) for i in range(12)]
    index = decontamination.build_index(items)
    texts = []
    for _ in range(60):
        item = bytearray(items[rng.randrange(len(items))][1])
        for _ in range(rng.randrange(0, len(item) // 9 + 1)):
            at, kind = rng.randrange(len(item)), rng.randrange(3)
            if kind == 0:
                item[at] = rng.choice(b"abcw019 ")
            elif kind == 1:
                del item[at]
            else:
                item.insert(at, rng.choice(b"abcw019 "))
        texts.append(words(rng, rng.randrange(0, 10), 60).encode() + bytes(item) + words(rng, rng.randrange(0, 10), 60).encode())
    got = {(t, i): e for t, i, e, _ in decontamination.matches(index, texts)}
    want = {}
    for t, text in enumerate(texts):
        for i, (_, item) in enumerate(zip(index.ids, index.texts, strict=True)):
            edits = brute.edit_distance_in(item, text)
            if edits <= index.edits[i]:
                want[t, i] = edits
    assert got == want and any(want.values())


def test_contaminations_and_their_edges(spark, frames):
    docs = spark.createDataFrame(
        [(1, "x What is  the CAPITAL of france? y"), (2, None), (3, ""), (None, "what is the capital of france?")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, "What is the capital of France?"), (8, None), (9, ""), (10, "short")], "item_id long, text string")
    assert sorted_rows(decontamination.contaminations(docs, items), "doc_id", "item_id", "n_edits") == [(1, 7, 0), (None, 7, 0)]
    tiny = spark.createDataFrame([(10, "x"), (11, "ance"), (12, "of  FRANCE?"), (12, "of  FRANCE?"), (13, "y")], "item_id long, text string")
    assert sorted_rows(decontamination.contaminations(docs, tiny), "doc_id", "item_id", "match_end") == [
        (1, 10, 1), (1, 12, 32), (1, 13, 34), (None, 12, 30),
    ]
    long = spark.createDataFrame([(1, "word " * 300_000 + "what is the capital of france?")], "doc_id long, text string")
    assert sorted_rows(decontamination.contaminations(long, items), "item_id", "n_edits") == [(7, 0)]
    assert sorted_rows(decontamination.without_contaminated(docs, items), "doc_id") == [(2,), (3,)]
    assert decontamination.contaminations(docs, items.limit(0)).count() == 0
    assert decontamination.without_contaminated(docs, items.limit(0)).count() == 4
    assert decontamination.contaminations(frames[1], items).count() == 0


def test_light_edits_of_the_given_items_are_found():
    """Exact, one long word replaced, one dropped, two short ones replaced; clean texts stay."""
    import pyarrow.parquet as pq

    rng = random.Random(7)
    table = pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pylist()
    items = [(r["item_id"], decontamination.normalise(r["text"])) for r in table]
    index = decontamination.build_index(items)
    filler = lambda: words(rng, 40).encode()

    def changed(text, kind):
        parts = text.split(b" ")
        by_size = sorted(range(len(parts)), key=lambda k: len(parts[k]))
        if kind == "replaced":
            parts[by_size[-1]] = b"qzxjkvwb"
        elif kind == "dropped":
            del parts[rng.randrange(len(parts))]
        elif kind == "two":
            for k in by_size[: 2]:
                parts[k] = b"zq"
        return b" ".join(parts)

    for kind in ("exact", "replaced", "dropped", "two"):
        texts = [b" ".join([filler(), changed(t, kind), filler()]) for _, t in items]
        found = {who for who, item, _, _ in decontamination.matches(index, texts) if who == item}
        assert len(found) >= 0.95 * len(items), (kind, len(found))
    shuffled = []
    for _, t in items:
        parts = t.split(b" ")
        rng.shuffle(parts)
        shuffled.append(b" ".join(parts))
    assert not list(decontamination.matches(index, shuffled))


# -- licences -------------------------------------------------------------------------


def test_licence_units(spark):
    rows = [
        (1, "text\nReleased under the MIT license\nmore"),
        (2, "LICENSED under CC BY-NC 4.0"),
        (3, None),
        (4, ""),
        (5, "under the sun"),
        (None, licences.TEMPLATES[2][1].replace(" ", "\n")),
        (1, "text\nReleased under the MIT license\nmore"),
    ]
    docs = spark.createDataFrame([(*r, *_EXTRA) for r in rows], f"doc_id long, text string, {CLASHING}")
    got = {(r["doc_id"], r["licence"]): (r["dice"], r["n_units"]) for r in licences.scan(docs).collect()}
    assert got[1, "MIT"] == (1.0, 2) and got[2, "CC-BY-NC-4.0"] == (1.0, 1) and got[None, "MIT"][0] == 1.0
    assert {who for who, _ in got} == {1, 2, None}
    assert licences.scan(docs.limit(0)).count() == 0


def test_licence_passages(spark):
    """A wrapped licence file, a header atop a source file and a notice inside a longer line."""
    mit = licences.TEMPLATES[2][1]
    rest = "THE SOFTWARE IS PROVIDED AS IS WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED " + words(random.Random(1), 100)
    gpl = next(text for name, text in licences.TEMPLATES if name == "GPL-3.0" and "any later" in text)
    code = "\n".join(f"def f{n}(x):\n    return x + {n}" for n in range(200))
    rows = [
        (1, f"MIT License\n\nCopyright (c) 2020 A. Person\n\n{textwrap.fill(mit, 76)}\n\n{textwrap.fill(rest, 76)}\n"),
        (2, "# Tool\n#\n" + textwrap.indent(textwrap.fill(gpl, 70), "# ") + "\n\n" + code),
        (3, f"{words(random.Random(2), 45)} Released under the MIT License. {words(random.Random(3), 300)}"),
        (4, f"the software to any person and of the license {words(random.Random(4), 300)}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["licence"]): (r["dice"], r["n_units"]) for r in licences.scan(docs).collect()}
    assert got[1, "MIT"] == got[2, "GPL-3.0"] == got[3, "MIT"] == (1.0, 1)
    assert {who for who, _ in got} == {1, 2, 3}


def test_markers_lose_no_match():
    chosen = set(licences.markers())
    for _, text in licences.TEMPLATES:
        bigrams = [b.split() for b in licences.template_bigrams(text)]
        free = sum(not chosen & set(b) for b in bigrams)
        assert free < licences.THRESHOLD / (2 - licences.THRESHOLD) * len(bigrams)


# -- toxicity -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    insults = ["grubblatz", "zonkworm", "snivelcrat"]
    docs, labels = [], []
    for i in range(900):
        body = words(rng, rng.randrange(20, 60), 300).split()
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            body.insert(rng.randrange(len(body)), rng.choice(insults))
        docs.append((i, " ".join(body)))
        labels.append((i, int(i % 5 > 0), int(toxic)))
    docs += [(2000, None), (2001, ""), (None, "grubblatz grubblatz zonkworm")]
    labels += [(1, None, None), (99_999, 1, 1), (2, 1, 0)]
    return (
        spark.createDataFrame([(*d, *_EXTRA) for d in docs], f"doc_id long, text string, {CLASHING}"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == 903 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 900 and r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    right = [r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2000]["predicted"] == by_id[2001]["predicted"] == 0 and not by_id[None]["held_out"]


def test_toxicity_without_evidence(spark):
    """On the given tables: texts without words, or with one plain word, are not toxic."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    plain = spark.createDataFrame([(1, None), (2, ""), (3, "!!! ... 12"), (4, "hello"), (5, "the of")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(plain, model).collect()}
    assert all(s < 0.3 for s in scores.values()), scores
    assert scores[1] == scores[2] <= model.base_rate
    kept = toxicity.without_toxic(docs.select("doc_id", "text").union(plain), labels)
    assert {r["doc_id"] for r in kept.where("doc_id <= 5").collect()} >= {1, 2, 3, 4, 5}


def test_toxicity_does_not_read_held_out_labels(labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted_rows(toxicity.classify(docs, labels), "doc_id", "score") == sorted_rows(
        toxicity.classify(docs, turned), "doc_id", "score"
    )


def test_toxicity_holds_few_words_of_one_model(monkeypatch):
    """Workers serve many tasks and models; what they hold does not add up."""
    monkeypatch.setattr(toxicity, "_CACHED", 40)
    rng = random.Random(3)
    texts = [f"common {words(rng, 8)} often" for _ in range(200)]
    for key in ("one", "two"):
        windows = toxicity.Windows(b"w1 w2 w3 w4 w5 common " * 3, f"{key} often w6 w7 w8 w9 ".encode() * 3, key)
        for text in texts:
            gains = sorted((windows.gain(w) for w in set(text.split())), reverse=True)
            assert windows.features(text)[:2] == (gains[0], sum(gains[:3]))
            held = toxicity._GAINS
            assert held.key == key and len(held.newer) + len(held.older) <= 2 * (40 + 10)
    assert "common" in held.newer or "common" in held.older
    held.forget()


def test_toxicity_without_labels_or_rows(labelled):
    docs, labels = labelled
    assert {r["score"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert toxicity.without_toxic(docs, labels.limit(0), threshold=0.6).count() == 903


# -- packing --------------------------------------------------------------------------


def test_packing_holds_every_document(frames, messy):
    from tokenizers import Tokenizer

    docs, none = frames
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(docs, path, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True).collect()
    model = Tokenizer.from_file(path)
    want = sorted([*model.encode(t or "", add_special_tokens=False).ids, 0] for _, t in messy)
    pieces: dict = {}
    for r in rows:
        assert len(r["ids"]) == r["length"] <= packing.CAPACITY
        assert zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in pieces.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    single = [r for r in rows if r["doc_id"] == 5000]
    assert [r["start"] for r in sorted(single, key=lambda r: r["piece"])] == np.cumsum(
        [0, *[r["length"] for r in sorted(single, key=lambda r: r["piece"])][:-1]]
    ).tolist()
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    assert len(pieces) <= 1.02 * sum(map(len, want)) / packing.CAPACITY + 1
    assert packing.pack(none, path).count() == 0


def test_text_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = packing.TextIds(path, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    model, rng = Tokenizer.from_file(path), random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice(["a", "B", " ", " ", "é", "<|endoftext|>", "\n", "\t", "漢", "’s", "12", "ﬁ"]) for _ in range(rng.randrange(30)))
        assert np.frombuffer(encode(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [1, 50, 3000])
def test_plans_fill_sequences(n):
    rng = np.random.default_rng(n)
    counts: dict[int, int] = {}
    for length in np.minimum(rng.lognormal(6, 1, n).astype(int) + 1, 2048):
        counts[int(length)] = counts.get(int(length), 0) + 1
    rows = packing.plan_sequences(counts)
    placed: dict[int, int] = {}
    filled: dict[int, int] = {}
    for length, first, repeats_, sequence, _ in rows:
        assert first == placed.get(length, 0)
        placed[length] = first + repeats_
        for s in range(sequence, sequence + repeats_):
            filled[s] = filled.get(s, 0) + length
    assert placed == counts and max(filled.values()) <= 2048
    assert len(filled) <= max(1, 1.02 * sum(k * v for k, v in counts.items()) / 2048 + 1)


@pytest.mark.parametrize("n", [800, 8_000, 200_000])
def test_fitted_patterns_place_most_pieces(n):
    rng = np.random.default_rng(n)
    counts = np.bincount(np.minimum(rng.lognormal(6, 1, n).astype(int) + 1, 2047), minlength=2049)
    found = packing.fitted_patterns(counts)
    used = np.zeros(2049, np.int64)
    for pattern, times in found:
        assert sum(pattern) == 2048 and len(pattern) <= packing.MOST_DOCUMENTS and times > 0
        np.add.at(used, list(pattern), times)
    assert (used <= counts).all() and used.sum() >= 0.9 * n
    plan = packing.plan_sequences({k: int(v) for k, v in enumerate(counts) if v})
    sequences = max(row[3] + row[2] for row in plan)
    assert sequences <= 1.002 * (counts * np.arange(2049)).sum() / 2048 + 1


# -- top-k ----------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(size=12)]) for i in range(300)]
    rows += [(400 + i, [0.5] * 12) for i in range(12)]  # ties
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 12), (503, [float("inf")]), (504, [2.0, 1.0]), (None, [1.0]), (450, rows[3][1])]
    rows += [(7, [3.0] * 12)] * 3 + [rows[50]] * 2 + [(100, [1.5] * 12)]  # repeated rows, and ids of several rows
    frame = spark.createDataFrame([(*r, *_EXTRA) for r in rows], f"vec_id long, embedding array<float>, {CLASHING}").repartition(4)
    table = topk.scaled(frame)
    got = sorted(tuple(r) for r in topk.top_k(table, table.where("id % 50 = 0")).collect())
    good = []
    for who, v in rows:
        if who is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((who, np.floor(256 * np.pad(np.asarray(v, np.float32).astype(float), (0, 12 - len(v)))).astype(int)))
    want = []
    for q in {who for who, _ in good if who % 50 == 0}:
        scores = sorted((-int(v @ w), c) for who, v in good if who == q for c, w in good if c != q)[:5]
        want += [(q, n, c, -s) for n, (s, c) in enumerate(scores, 1)]
    assert got == sorted(want)
    few = table.where("id < 3")
    assert topk.top_k(few, few.where("id = 0")).count() == 2
    assert topk.top_k(table.limit(0), table.limit(0)).count() == 0
    assert topk.top_k(table, table.limit(0)).count() == 0


# -- urls -----------------------------------------------------------------------------


def test_hosts_paths_and_rules(spark):
    cases = [
        ("https://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/En/1", "example.net", "/En/1", "net/", "block"),
        ("x://net", "net", "", None, None),
        ("x://net/", "net", "/", "net/", "block"),
        ("https://sub.example.com/de/", "sub.example.com", "/de/", "example.com/de/", "block"),
        ("https://badexample.com/de/", "badexample.com", "/de/", None, None),
        ("https://a.org/fr/q", "a.org", "/fr/q", "org/fr/", "allow"),
        ("no scheme/net/", "", "", None, None),
        (None, "", "", None, None),
        ("h://host#frag://b/c", "host", "", None, None),
        ("h://É.Net/a\nb?c", "É.net", "/a\nb", "net/", "block"),
    ]
    pages = spark.createDataFrame([(i, c[0], *_EXTRA) for i, c in enumerate(cases)], f"page_id long, url string, {CLASHING}")
    rows = {r["page_id"]: r for r in urls.judge(pages, steps=2).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule), cases[i]
        assert rows[i]["verdict"] in ("allow", "block") and verdict in (None, rows[i]["verdict"])
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_classifier_learns(spark):
    def url(i):
        return f"https://{'casino-win' if i % 2 else 'library'}{i}.test/{'bonus' if i % 2 else 'books'}/{i}"

    labelled = spark.createDataFrame([(url(i), i % 2) for i in range(200)] + [(None, 1), (url(1), 1)], "url string, blocked int")
    pages = spark.createDataFrame([(i, url(i)) for i in range(300, 400)], "page_id long, url string")
    rows = urls.judge(pages, labelled).collect()
    assert np.mean([(r["verdict"] == "block") == bool(r["page_id"] % 2) for r in rows]) > 0.97
    plan = urls.judge(pages, labelled, steps=1)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def plain_url_scores(urls_, labelled):
    """Gradient steps in plain numbers; bucket -1 is the constant."""
    import math

    import xxhash

    def buckets(url):
        at = url.find("://")
        rest = url[at + 3 :] if at >= 0 else ""
        host = rest.replace("?", "/").replace("#", "/").split("/")[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        out = set()
        for text in (f"^{host}^", f"|{path}|"):
            for n in urls.GRAMS:
                for i in range(len(text) - n + 1):
                    h = xxhash.xxh64(text[i : i + n].encode(), seed=42).intdigest()
                    out.add((h - (1 << 64) if h >> 63 else h) % urls.BUCKETS)
        return out

    def logit(f, w, b):
        return sum(w[k] for k in f) / max(1, len(f)) ** 0.5 + b

    rows = [(buckets(u), y) for u, y in labelled.items()]
    n, positive = len(rows), sum(y for _, y in rows)
    w, b = [0.0] * urls.BUCKETS, math.log(positive / (n - positive))
    moves, push = [0.0] * urls.BUCKETS, 0.0
    for _ in range(urls.STEPS):
        gradient, constant = [0.0] * urls.BUCKETS, 0.0
        for f, y in rows:
            error = y - 1 / (1 + math.exp(-logit(f, w, b)))
            constant += error
            for k in f:
                gradient[k] += error / max(1, len(f)) ** 0.5
        moves = [urls.MOMENTUM * m + urls.RATE * g / n for m, g in zip(moves, gradient, strict=True)]
        push = urls.MOMENTUM * push + urls.RATE * constant / n
        w, b = [x + m for x, m in zip(w, moves, strict=True)], b + push
    return [1 / (1 + math.exp(-logit(buckets(u), w, b))) for u in urls_]


def test_url_scores_equal_plain_steps(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").collect()
    long = "http://" + "sub." * 3000 + "example.org/" + "x/" * 20_000
    rows = [(r["page_id"], r["url"]) for r in pages] + [(-1, long), (-2, "://"), (-3, "HTTP://É.example.COM/fr?x")]
    rng = random.Random(4)
    labelled = {url: int("example.net" in url or rng.random() < 0.1) for _, url in rows[: len(rows) // 2]}
    frame = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame(list(labelled.items()), "url string, blocked int")
    found = {r["page_id"]: r for r in urls.judge(frame, table).collect()}
    for (who, _), score in zip(rows, plain_url_scores([u for _, u in rows], labelled), strict=True):
        assert abs(found[who]["score"] - score) < 1e-5
        if found[who]["rule"] is None:
            assert found[who]["verdict"] == ("block" if found[who]["score"] >= 0.5 else "allow")


# -- quality --------------------------------------------------------------------------


def test_quality_shrinks_sparse_sites(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        good = rng.random() < (0.9 if i % 3 else 0.2)  # host 0 is poor
        text = words(rng, 60) if good else ("BUY NOW!! " * 30 if i % 2 else "menu | home | " * 30)
        docs.append((i, text, f"h{int(i % 3 > 0)}", "a" if i % 7 else "b"))
        labels.append((i, int(good), 0))
    docs += [(1000, "BUY!!", "new", "x"), (1001, None, None, None), (1002, "", "h0", None), (None, words(rng, 20), "h1", "a")]
    labels += [(5, None, None), (77_777, 1, 1)]
    docs = spark.createDataFrame([(*d, *_EXTRA) for d in docs], f"doc_id long, text string, host string, path string, {CLASHING}")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels, "host", "path").collect()
    assert len(rows) == 604 and all(0 <= r["score"] <= 1 for r in rows)
    truth = {r["doc_id"]: r["quality"] for r in labels.where("quality is not null").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth and r["doc_id"] < 600]
    assert len(held) > 100 and np.mean([r["keep"] == bool(truth[r["doc_id"]]) for r in held]) > 0.97
    sites = {r["doc_id"]: (r["host"], r["path"]) for r in docs.collect()}
    plain = brute.site_posteriors([(*sites[r["doc_id"]], r["p_text"]) for r in rows])
    for r, (of_host, of_path, prior) in zip(rows, plain, strict=True):
        assert np.allclose([r["host_rate"], r["path_rate"], r["prior"]], [of_host, of_path, prior], rtol=1e-6)
        if r["host_rate"] not in (0, 1) and r["prior"] != r["path_rate"]:
            assert (r["prior"] < r["path_rate"]) == (r["p_text"] > r["path_rate"])  # its own evidence is left out
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["host_rate"] < 0.4 < 0.7 < by_id[1]["host_rate"]
    assert by_id[0]["host_rate"] < by_id[1000]["path_rate"] < by_id[1]["host_rate"]  # one document: near the overall rate
    assert quality.classify(docs.limit(0), labels, "host", "path").count() == 0
    assert {r["p_text"] for r in quality.classify(docs, labels.limit(0), "host", "path").collect()} == {0.5}


# -- shared keys ----------------------------------------------------------------------


def test_shared_keys_of_odd_ids(spark):
    from curatrix.llm import sharing

    rng = np.random.default_rng(1)
    ids = np.asarray([-(1 << 63), -5, 0, 7, 70_000, 1 << 40, (1 << 63) - 1])
    keys = [set(rng.choice(40, 12, replace=False).tolist()) for _ in ids]

    def gather(batches):
        import pyarrow as pa

        blocks = sharing.Blocks(8)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                own = np.asarray(sorted(keys[i]), np.uint64) << np.uint64(64 - sharing.KEY_BITS)
                yield from blocks.add(np.full(len(own), ids[i]), own)
        assert isinstance(pa.__version__, str)
        yield from blocks.flush()

    rows = spark.range(len(ids)).repartition(3).mapInArrow(gather, sharing.SCHEMA)
    got = {(r["id"], r["key"]) for r in sharing.shared_keys(rows, 4).collect()}
    want = {
        (int(ids[i]), k) for i in range(len(ids)) for k in keys[i] if any(k in keys[j] for j in range(len(ids)) if j != i)
    }
    assert got == want

"""The corpus pipeline stage by stage against plain versions, on a small corpus with odd rows."""

from __future__ import annotations

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from curatrix.llm import decontamination, toxicity  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, `order` int"


def words(rng, n, pool=3000):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with copies, shared passages, insults and benchmark items; nulls, empty and repeated rows."""
    rng = random.Random(31)
    insults = ["grubblatz", "zonkworm", "snivelcrat"]
    items = [(i, words(rng, 25)) for i in range(6)]
    passage = words(rng, 70)
    texts, labels = {}, []
    for i in range(500):
        body = words(rng, rng.randrange(30, 90)).split()
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            body.insert(rng.randrange(len(body)), rng.choice(insults))
        texts[i] = " ".join(body)
        labels.append((i, 1, int(toxic)))
    rows = list(texts.items())
    rows += [(1000 + i, texts[i]) for i in range(0, 60, 3)]  # exact copies
    rows += [(1100 + i, f"{texts[i]} and one more word") for i in range(1, 60, 3)]  # near copies
    rows += [(1200 + i, f"{words(rng, 20)} {passage} {words(rng, 25)}") for i in range(12)]
    rows += [(1300 + i, f"{words(rng, 30)} {text} {words(rng, 5)}") for i, text in items]
    rows += [(2000, None), (2001, ""), (2002, "!!! ..."), (2003, "one"), (None, texts[1]), (None, None), (7, texts[7])]
    rows += [(2100, words(rng, 20_000, 40_000)), (2101, "ab " * 9000)]
    folder = tmp_path_factory.mktemp("corpus")
    full = [(who, text, "en", "s", None if text is None else len(text), "k", 1) for who, text in rows]
    spark.createDataFrame(full, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*labels, (2, None, None), (99_999, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([*items, (90, None), (91, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def one_of_each(rows):
    """The rows without near duplicates; rows of one id and text count once, those without an id stay."""
    kept, seen = [], set()
    for (who, text), (_, _, component) in zip(rows, brute.jaccard(rows), strict=True):
        if who is None or (who == component and (who, text) not in seen):
            kept.append((who, text))
            seen.add((who, text))
    return sorted(kept, key=repr)


def without_repeats(rows):
    first: dict[bytes, int] = {}
    for who, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49 if who is not None else 0):
            first[data[k : k + 50]] = min(who, first.get(data[k : k + 50], who))
    out = []
    for who, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49 if who is not None else 0):
            if first[data[k : k + 50]] < who:
                gone[k : k + 50] = True
        left = data[:0].join(bytes([b]) for b, g in zip(data, gone, strict=True) if not g).decode("utf-8", "ignore")
        if not gone.any():
            out.append((who, text))
        elif left:
            out.append((who, left))
    return sorted(out, key=repr)


def test_every_stage_does_its_whole_work(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    schema, rows = docs.schema, rows_of(docs)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "benchmark_leaks", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        out = stages[name](spark, docs, corpus)
        path = f"{corpus}/{name}.parquet"
        out.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    kept = run("toxicity", docs)
    assert kept.schema.names == schema.names
    toxic = {who for who, text in rows if any(w in (text or "") for w in ("grubblatz", "zonkworm", "snivelcrat"))}
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 0").collect()
    assert sorted((r["doc_id"] for r in scored), key=repr) == [who for who, _ in sorted(rows_of(kept), key=repr)]
    left = {who for who, _ in rows_of(kept)}
    assert len(toxic - left) >= 0.97 * len(toxic) and {2000, 2001, 2002, 2003, None} <= left
    assert len(left - toxic) >= 0.99 * len({who for who, _ in rows} - toxic)

    before = rows_of(kept)
    kept = run("near_duplicates", kept)
    assert kept.schema.names == schema.names and rows_of(kept) == one_of_each(before)

    before = rows_of(kept)
    kept = run("repeated_passages", kept)
    assert kept.schema.names == schema.names and rows_of(kept) == without_repeats(before)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in kept.collect())

    before = rows_of(kept)
    kept = run("benchmark_leaks", kept)
    items = [r["text"] for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect() if r["text"]]
    leaks = [i for i in map(decontamination.normalise, items)]
    clean = [(who, text) for who, text in before if not any(i in decontamination.normalise(text) for i in leaks)]
    assert kept.schema.names == schema.names and rows_of(kept) == clean and len(clean) < len(before)

    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = run("packing", kept).collect()
    want = []
    for who, text in clean:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        extra = len(ids) % 2048
        cuts = sorted({0, *range(extra, len(ids), 2048)}) if extra else list(range(0, len(ids), 2048))
        for nth, start in enumerate(cuts):
            piece = ids[start : [*cuts, len(ids)][nth + 1]]
            want.append((who, len(piece), zlib.crc32(np.asarray(piece, "<u4").tobytes())))
    got = [(r["doc_id"], r["length"], r["ids_crc32"]) for r in packed]
    single = lambda pieces: sorted((p for p in pieces if p[0] not in (2100, 2101)), key=repr)
    assert single(got) == single(want)
    assert sum(p[1] for p in got) == sum(p[1] for p in want)
    filled: dict[int, list[tuple[int, int]]] = {}
    for r in packed:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_equals_its_stages_and_takes_empty_tables(spark, corpus, tmp_path):
    whole = corpus_pipeline.run(spark, corpus)
    assert whole.count() > 300 and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(whole.columns)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

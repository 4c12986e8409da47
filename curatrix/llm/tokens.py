"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curatrix.llm.common import bounded_batches, giving_back, strings, utf8

# A word end, one space and a word start, all ASCII: no token of either library spans it.
_SAFE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@lru_cache(maxsize=4)
def _counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """Lengths of a batch of texts, and whether the space at a cut is put back."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        # The model sets a space mark before every text, in the place of the space cut out.
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return (
        lambda texts: [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)],
        True,
    )


def split_safely(text: str, max_chars: int, keep_space: bool) -> Iterator[str]:
    """Parts of a long text whose token counts add up to the count of the whole.

    A part ends at the first safe boundary after `max_chars`; where there is none the
    rest stays whole.
    """
    start, size = 0, len(text)
    while size - start > max_chars:
        cut = _SAFE.search(text, start + max_chars)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start() if keep_space else cut.end()
    yield text[start:]


def _balanced(parts: Iterable[tuple[int, str]], max_bytes: int) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of parts of about `max_bytes` each."""
    owners, texts, held = [], [], 0
    for owner, text in parts:
        owners.append(owner)
        texts.append(text)
        held += len(text)
        if held >= max_bytes:
            yield owners, texts
            owners, texts, held = [], [], 0
    if texts:
        yield owners, texts


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    batch_bytes: int = 1 << 20,
    max_chars: int = 1 << 14,
) -> DataFrame:
    """Token count of every whole text.

    Returns `id_col`, `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens),
    one row per input row. A null text counts as empty (0 bytes, 0 tokens); a null id is
    kept; repeated rows stay repeated; other columns, whatever their names, are not read;
    an empty table gives an empty result.

    Texts are encoded in batches of about `batch_bytes`. A text over `max_chars` is cut
    where one space separates two ASCII letters or digits: tokens never span such a
    space, so the counts of the parts add up. Nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, keep_space = _counter(model_path)
        for batch in batches:
            column = batch.column(1)
            totals = np.zeros(batch.num_rows, np.int64)
            parts = (
                (row, part)
                for row, text in enumerate(strings(column))
                for part in split_safely(text, max_chars, keep_space)
            )
            for owners, texts in _balanced(parts, batch_bytes):
                np.add.at(totals, owners, lengths(texts))
            sizes = np.diff(utf8(column)[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals), pa.array(totals > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    out = docs.select(id_col, text_col).mapInArrow(
        count, f"id {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return out.withColumnRenamed("id", id_col)

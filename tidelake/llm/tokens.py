"""Token counts of whole texts (method: finite-state tokenizer compilation)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.arrow import replaced, slices, text_buffers
from tidelake.llm.transducers import transducers


def count_tokens(docs: DataFrame, vocab: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` without its text, plus n_bytes, n_tokens and over_limit (n_tokens > limit).

    Counts are those of the ``tokenizers`` library for the byte-level BPE file ``vocab``
    without added special tokens; special strings inside a text count as one token, as is
    the library's default. The file must exist under the same path on every worker.

    One narrow pass, one row out per row in, in any order and with repeated rows kept.
    NULL and empty text: 0 bytes, 0 tokens. A long text is walked in blocks of about 1 MB.
    Columns of ``docs`` named like the three new ones are replaced by them.
    """
    new = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    kept = [f for f in docs.schema if f.name != text and f.name not in new]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducers(vocab)
        for batch in slices(batches, text):
            data, offsets = text_buffers(batch.column(text))
            n = machine.counts(data, offsets)
            yield replaced(batch, [text], {
                "n_bytes": pa.array(np.diff(offsets)),
                "n_tokens": pa.array(n),
                "over_limit": pa.array(n > limit),
            })

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in new.items()]
    )
    return docs.select(*[f"`{f.name}`" for f in kept], f"`{text}`").mapInArrow(count, schema)

"""Token counts from distinct pre-tokens: a piece's number of ids is found once, joined to each text's pieces by place, and summed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import piece_table
from .words import text_slices, tidy


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row; ``tokenizer`` is the path of a tokenizers file that every executor has.

    Counts are those of the library on the whole text without added special tokens; its own special strings inside a text count as it
    counts them. A null text counts as empty. Repeated rows and null ids stay; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(tokenizer, keep_ids=False)
        for batch in batches:
            for part in text_slices(batch, "text"):
                size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                n = table.counts(part.column("text")).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), size, pa.array(n), pa.array(n > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "id long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)

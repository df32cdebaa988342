"""Packing: concatenate the ids of all documents and cut them at fixed windows.

Pass 1 tokenizes once, partition by partition, and stores each document's ids with the
number of ids before it in its partition. A prefix sum over the partition totals gives
every document its global offset. Pass 2 cuts ids at multiples of the window; documents
that cross a window leave a boundary record, a piece, in each window they touch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import partition_bases, staged
from rowloom.llm.tokens import word_tokenizer

WINDOW = 2048
_TOKENIZED = "doc_id long, part int, before long, n long, ids binary"


def binary_rows(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of little-endian 32-bit ids, without a copy for each row."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) * 4 >= 1 << 31:
        return pa.array([ids[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
    return pa.Array.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids)],
    )


def tokenized(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Ids of each document, its partition and the ids before it there."""

    def encode(batches):
        part, before = TaskContext.get().partitionId(), 0
        coder = word_tokenizer(tokenizer)
        for batch in batches:
            for row, ids, offsets in coder.encode(batch.column("text"), end_id):
                n = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(n)),
                        pa.array(np.full(len(n), part, np.int32)),
                        pa.array(before + offsets[:-1]),
                        pa.array(n),
                        binary_rows(ids, offsets),
                    ],
                    names=["doc_id", "part", "before", "n", "ids"],
                )
                before += int(offsets[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, _TOKENIZED)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 1) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids, gapless but for the last sequence.

    Returns doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset, one row per piece. A null text counts as empty and is one end
    id; a null doc_id is kept; repeated rows are packed as often as they occur; an empty
    table gives no rows; other columns are ignored. Order of documents is that of storage.
    """
    ids = staged(tokenized(docs, tokenizer, end_id), "packing")
    bases = partition_bases(ids.groupBy("part").agg(F.sum("n").alias("total")), "part", "total", "base")
    at = F.col("base") + F.col("before")
    placed = ids.where("n > 0").join(bases, "part").select("doc_id", "ids", "n", at.alias("at"))
    pieces = placed.select(
        "*",
        F.explode(F.expr(f"sequence(at div {window}, (at + n - 1) div {window})")).alias("sequence_id"),
    )
    start = F.greatest(F.col("sequence_id") * window - F.col("at"), F.lit(0))
    end = F.least((F.col("sequence_id") + 1) * window - F.col("at"), F.col("n"))
    cut = pieces.withColumns({"start": start, "length": end - start})
    return cut.select(
        "doc_id",
        "start",
        "length",
        F.expr("substring(ids, cast(start * 4 + 1 AS int), cast(length * 4 AS int))").alias("ids"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * window).alias("offset"),
    )


def piece_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )

"""Arrow batches of bounded size, and the words of a batch of texts as numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Bytes of rows that Spark sends to a Python worker at a time; one longer row is sent by itself.
BATCH_BYTES = 4 << 20
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Characters that a worker takes apart at a time; one longer text is taken by itself.
STEP_CHARS = 1_000_000


class Recent:
    """Values by key in two generations: the least recent go when both are full."""

    def __init__(self, size: int):
        self.values: dict = {}
        self._older: dict = {}
        self._size = size

    def missing(self, keys: Iterable) -> list:
        """The distinct keys without a value; the values of the others are at hand until the next call."""
        if len(self.values) > self._size:
            self.values, self._older = {}, self.values
        lacking = set(keys).difference(self.values)
        if self._older:
            again = lacking.intersection(self._older)
            self.values.update((key, self._older[key]) for key in again)
            lacking -= again
        return list(lacking)


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch; Spark's own bound is ten thousand rows, which is any number of bytes.

    The bound is a setting of the session; one that its user has chosen is left as it is.
    """
    chosen = spark.conf.get(_BYTES_SETTING, None)
    if chosen is None or not str(chosen).strip("-").isdigit() or not 0 < int(chosen) < (1 << 31) - 1:
        spark.conf.set(_BYTES_SETTING, str(BATCH_BYTES))


def map_batches(rows: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow with batches bounded by bytes as well as by rows."""
    bound_batches(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def strings(texts: pa.Array) -> list[str]:
    """Texts as Python strings, made at once rather than one by one."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def steps(texts: pa.Array, chars: int = STEP_CHARS) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive runs of texts of at most ``chars`` characters, or of one text, with their first row."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + chars, side="right")))
        yield row, texts.slice(row, stop - row)
        row = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, each word's number among them, and where each text's words start and end.

    Words are the runs between space, tab and the four line controls.
    """
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)))
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:  # white space at either end of a text leaves an empty piece
        held = codes != blank
        ends = np.append(0, np.cumsum(held))[ends]
        codes = codes[held]
    return coded.dictionary, codes, ends

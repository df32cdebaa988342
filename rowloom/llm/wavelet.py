"""Token ids in wavelet matrices: one compressed row of bit planes per shard of documents.

Plane k of a shard holds bit (levels - 1 - k) of every id, in the order left by a stable
partition on the planes before it: zeros first, then ones. With the number of zeros per
plane and sampled ranks, an id can be read, counted and located without unpacking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import partition_bases
from rowloom.llm.packing import binary_rows
from rowloom.llm.tokens import word_tokenizer
from rowloom.storage import scratch_path

LEVELS = 16
# Ids in a shard before it is closed; a shard is closed after a whole document.
SHARD_IDS = 1 << 19
# So many first characters of texts part the rows of one id into ranges.
TIE_CHARS = 64
# Bits between two stored ranks.
RANK_BITS = 512

SHARDS = (
    "part int, shard int, before long, n long, levels int, zeros array<long>, planes binary, ranks binary, "
    "doc_ids array<long>, doc_lengths array<long>"
)
DOCUMENTS = "doc_id long, part int, before long, n long, ids binary"


class WaveletMatrix:
    """Bit planes of one sequence of ids, with rank, access, counting and location."""

    def __init__(self, n: int, levels: int, zeros, planes: np.ndarray, ranks: np.ndarray):
        self.n, self.levels, self.zeros = n, levels, zeros
        self.planes, self.ranks = planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray, levels: int = LEVELS) -> WaveletMatrix:
        if len(ids) and int(ids.max()) >> levels:
            raise ValueError(f"ids need more than {levels} bits")
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        other = np.empty_like(now)
        n, step = len(now), RANK_BITS // 8
        planes = np.zeros((levels, -(-n // 8)), np.uint8)
        ranks = np.zeros((levels, n // RANK_BITS + 1), np.uint32)
        zeros = []
        for k in range(levels):
            ones = (now >> now.dtype.type(levels - 1 - k) & now.dtype.type(1)).astype(bool)
            planes[k] = np.packbits(ones)
            each = np.bitwise_count(planes[k])
            full = each[: n // RANK_BITS * step].reshape(-1, step).sum(axis=1, dtype=np.uint32)
            ranks[k, 1:] = np.cumsum(full)
            zeros.append(n - int(np.count_nonzero(ones)))
            np.take(now, np.flatnonzero(ones), out=other[zeros[-1] :], mode="clip")  # "raise" would copy the output
            np.take(now, np.flatnonzero(~ones), out=other[: zeros[-1]], mode="clip")
            now, other = other, now
        return cls(n, levels, zeros, planes, ranks)

    @classmethod
    def from_bytes(cls, n: int, levels: int, zeros, planes: bytes, ranks: bytes) -> WaveletMatrix:
        return cls(
            n,
            levels,
            zeros,
            np.frombuffer(planes, np.uint8).reshape(levels, -(-n // 8)),
            np.frombuffer(ranks, "<u4").reshape(levels, n // RANK_BITS + 1),
        )

    def _rank1(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane."""
        block = at // RANK_BITS
        rest = self.planes[level, block * RANK_BITS // 8 : -(-at // 8)]
        bits = np.unpackbits(rest)[: at - block * RANK_BITS]
        return int(self.ranks[level, block]) + int(bits.sum())

    def _select(self, level: int, bit: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) bit of a kind in a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > nth:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for k in range(self.levels):
            bit = self.planes[k, at // 8] >> (7 - at % 8) & 1
            ones = self._rank1(k, at)
            at = self.zeros[k] + ones if bit else at - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        start = 0
        for k in range(self.levels):
            a, b = self._rank1(k, start), self._rank1(k, end)
            if value >> (self.levels - 1 - k) & 1:
                start, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id among the first ``end`` ids."""
        if value < 0 or value >> self.levels:
            return 0
        start, stop = self._range(value, self.n if end is None else end)
        return stop - start

    def locate(self, value: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) occurrence of an id."""
        if not 0 <= nth < self.count(value):
            raise IndexError(nth)
        at = self._range(value, self.n)[0] + nth
        for k in range(self.levels - 1, -1, -1):
            bit = value >> (self.levels - 1 - k) & 1
            at = self._select(k, bit, at - self.zeros[k] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids, undoing the partitions from the last plane to the first."""
        now = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for k in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.planes[k], count=self.n).view(bool)
            back = np.empty_like(now)
            back[np.flatnonzero(~ones)] = now[: self.zeros[k]]
            back[np.flatnonzero(ones)] = now[self.zeros[k] :] | now.dtype.type(1 << (self.levels - 1 - k))
            now = back
        return now


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, levels: int = LEVELS) -> None:
    """Tokenize documents in ascending doc_id order (null ids last) and write their shards.

    One file per range of ids, one row per shard. A null text counts as empty. Rows of
    one doc_id, or of none, are ordered by text; where they are many, their ranges part by the
    texts' first characters. Other columns are ignored.
    """

    def encode(batches):
        part = TaskContext.get().partitionId()
        coder = word_tokenizer(tokenizer)
        shard, before = 0, 0
        held, names, lengths, size = [], [], [], 0

        def close():
            nonlocal shard, before, held, names, lengths, size
            matrix = WaveletMatrix.build(np.concatenate(held), levels)
            row = {
                "part": part,
                "shard": shard,
                "before": before,
                "n": matrix.n,
                "levels": levels,
                "zeros": matrix.zeros,
                "planes": matrix.planes.tobytes(),
                "ranks": matrix.ranks.astype("<u4").tobytes(),
                "doc_ids": names,
                "doc_lengths": lengths,
            }
            shard, before = shard + 1, before + size
            held, names, lengths, size = [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for row, ids, offsets in coder.encode(batch.column("text"), end_id):
                keys = batch.column("doc_id").slice(row, len(offsets) - 1).to_pylist()
                first = 0
                while first < len(keys):
                    room = offsets[first] + max(1, SHARD_IDS - size)
                    last = max(first + 1, min(len(keys), int(np.searchsorted(offsets, room, side="left"))))
                    held.append(ids[offsets[first] : offsets[last]])
                    names += keys[first:last]
                    lengths += np.diff(offsets[first : last + 1]).tolist()
                    size += int(offsets[last] - offsets[first])
                    first = last
                    if size >= SHARD_IDS:
                        yield close()
        if names:
            yield close()

    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("shard", pa.int32()),
            ("before", pa.int64()),
            ("n", pa.int64()),
            ("levels", pa.int32()),
            ("zeros", pa.list_(pa.int64())),
            ("planes", pa.binary()),
            ("ranks", pa.binary()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_lengths", pa.list_(pa.int64())),
        ]
    )
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.asc_nulls_last("doc_id"), F.substring("text", 1, TIE_CHARS))
        .sortWithinPartitions(F.asc_nulls_last("doc_id"), "text")
    )
    ordered.mapInArrow(encode, SHARDS).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a file as written, one row each."""
    return spark.read.schema(SHARDS).parquet(path)


def decode_shards(shards: DataFrame) -> DataFrame:
    """Documents of shards: doc_id, ids (binary), n and start, the ids of all documents before."""

    def decode(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                matrix = WaveletMatrix.from_bytes(one["n"], one["levels"], one["zeros"], one["planes"], one["ranks"])
                offsets = np.append(0, np.cumsum(one["doc_lengths"])).astype(np.int64)
                count = len(one["doc_ids"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["doc_ids"], pa.int64()),
                        pa.array(np.full(count, one["part"], np.int32)),
                        pa.array(one["before"] + offsets[:-1]),
                        pa.array(np.diff(offsets)),
                        binary_rows(matrix.decode(), offsets),
                    ],
                    names=["doc_id", "part", "before", "n", "ids"],
                )

    bases = partition_bases(shards.groupBy("part").agg(F.sum("n").alias("total")), "part", "total", "base")
    return (
        shards.mapInArrow(decode, DOCUMENTS)
        .join(bases, "part")
        .select("doc_id", (F.col("base") + F.col("before")).alias("start"), F.col("n").alias("n_tokens"), "ids")
    )


def token_store(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write documents as shards under the shared folder and return what the files give back."""
    path = scratch_path(docs.sparkSession, "wavelet")
    write_shards(docs, path, tokenizer, end_id)
    return decode_shards(read_shards(docs.sparkSession, path))


def document_digest(documents: DataFrame) -> DataFrame:
    """Documents with a checksum in place of their ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

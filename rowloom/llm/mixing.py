"""Mixing sources to target weights by a splitting tree of exact block quotas.

The words of each source, its documents in a random order, form a line that is cut into
blocks. The target fixes how many blocks of each source the mix draws. A binary tree over
output shards splits these quotas by multivariate hypergeometric draws: each node's draw
depends on the seed and the node alone, so any task can find the shard of any block by
walking down from the root, and nothing but the root quotas is shared. A keyed permutation
of block numbers makes the draw random and disjoint; a second pass over a source, if its
target needs one, uses another permutation. Within a shard, pieces are in random order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.batches import map_batches
from rowloom.llm.common import quoted, shuffle_partitions, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
# Blocks per source: more make targets finer, fewer cut fewer documents.
BLOCKS_PER_SOURCE = 1024
BLOCK_WORDS = 16384
# A hypergeometric draw takes fewer than 10^9 blocks in all.
TREE_BLOCKS = 500_000_000
SHARD_WORDS = 1 << 22

# Characters of pieces sent back from a Python worker at a time; the pieces of one text go together.
CUT_CHARS = 1 << 20
_PIECE = "array<struct<shard:long,position:long,pass:int,start:long,length:long>>"


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP):
    """Words wanted of each source.

    Weights repeat over the sources in code point order, null last. No target is above
    ``cap`` times its source's size; the excess is shared again by weight.
    """
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    limit = {n: cap * sizes[n] for n in names}
    out: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), list(names)
    while open_:
        whole = sum(weight[n] for n in open_)
        over = [n for n in open_ if left * weight[n] / whole > limit[n]]
        if not over:
            out |= {n: left * weight[n] / whole for n in open_}
            break
        for n in over:
            out[n] = limit[n]
            left -= limit[n]
        open_ = [n for n in open_ if n not in out]
    return out


@dataclass(frozen=True)
class Quota:
    """Blocks of one source: their words, their number, and how many the mix draws."""

    code: int
    size: int
    target: float
    block: int
    blocks: int
    drawn: int


def quotas(sizes: dict, wanted: dict, blocks_per_source: int, block_words: int) -> dict:
    least = max(1, -(-int(sum(wanted.values())) // TREE_BLOCKS))
    out = {}
    for code, name in enumerate(sorted(sizes, key=lambda n: (n is None, n or ""))):
        size = sizes[name]
        block = max(least, min(block_words, size // blocks_per_source), 1)
        blocks = -(-size // block)
        passes, rest = divmod(wanted[name], size) if size else (0, 0.0)
        drawn = min(int(passes) * blocks + round(rest / block), 2 * blocks) if size else 0
        out[name] = Quota(code, size, wanted[name], block, blocks, drawn)
    return out


class SplitTree:
    """Exact quotas of every output shard, found by walking from the root."""

    def __init__(self, drawn: Sequence[int], shards: int, seed: int):
        self.shards, self.seed = shards, seed
        self._root = np.array(drawn, np.int64)
        self._lefts: dict[tuple[int, int], np.ndarray] = {}

    def _left(self, low: int, high: int, have: np.ndarray) -> np.ndarray:
        """Blocks of each source that the left half of shards [low, high) gets."""
        if (low, high) not in self._lefts:
            if len(self._lefts) > 1 << 16:
                self._lefts.clear()
            total, middle = int(have.sum()), (low + high) // 2
            draw = np.random.Generator(np.random.Philox(key=[self.seed, low << 32 | high]))
            take = total * (middle - low) // (high - low)
            self._lefts[low, high] = draw.multivariate_hypergeometric(have, take, method="marginals")
        return self._lefts[low, high]

    def shard_of(self, code: int, number: np.ndarray) -> np.ndarray:
        """The shard of each drawn block number of a source."""
        out = np.zeros(len(number), np.int64)
        todo = [(0, self.shards, self._root, 0, np.arange(len(number)))]
        while todo:
            low, high, have, start, at = todo.pop()
            if not len(at):
                continue
            if high - low == 1:
                out[at] = low
                continue
            left = self._left(low, high, have)
            goes = number[at] - start < left[code]
            middle = (low + high) // 2
            todo.append((low, middle, left, start, at[goes]))
            todo.append((middle, high, have - left, start + int(left[code]), at[~goes]))
        return out

    def quota(self, shard: int) -> np.ndarray:
        """Blocks of each source in one shard."""
        low, high, have = 0, self.shards, self._root
        while high - low > 1:
            left, middle = self._left(low, high, have), (low + high) // 2
            low, high, have = (low, middle, left) if shard < middle else (middle, high, have - left)
        return have


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mixing function."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(key & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(number: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds, walked until the result is in range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = number.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for turn in range(4):
            left, right = right, left ^ (_mixed(right, key * 4 + turn) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _located(
    docs: DataFrame,
    columns: list[str],
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = 11,
    blocks_per_source: int = BLOCKS_PER_SOURCE,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
):
    """Documents with their places in the lines of their sources, and the function that takes pieces of a batch of them."""
    spark = docs.sparkSession
    buckets = 2 * shuffle_partitions(spark)
    text_hash = F.xxhash64(F.lit(seed), "doc_id", "text")
    sized = docs.select(
        *columns, word_count(F.col("text")).alias("__size"), text_hash.alias("__order")
    ).withColumn("__bucket", F.expr(f"int(shiftrightunsigned(__order, 33) % {buckets})"))
    by_bucket = sized.groupBy("source", "__bucket").agg(F.sum("__size").alias("__total"))
    totals = by_bucket.groupBy("source").agg(F.sum("__total").alias("total"))
    sizes = {r["source"]: r["total"] for r in totals.collect()}
    plan = quotas(sizes, targets(sizes, weights, share, cap), blocks_per_source, block_words)
    drawn = [q.drawn for q in plan.values()]
    words = sum(q.target for q in plan.values())
    shards = max(1, min(-(-int(words) // shard_words), sum(drawn) or 1))

    before = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.select(
        F.col("source").alias("__source"),
        F.col("__bucket").alias("__at"),
        F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"),
    )
    inside = (
        Window.partitionBy("source", "__bucket")
        .orderBy("__order", "doc_id", "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
        .join(
            starts.hint("broadcast") if len(sizes) * buckets < 100_000 else starts,
            F.col("source").eqNullSafe(F.col("__source")) & (F.col("__bucket") == F.col("__at")),
        )
        .select(*columns, "__size", (F.col("__base") + F.col("__before")).alias("__start"), "__order")
    )

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = SplitTree(drawn, shards, seed)
        for batch in batches:
            yield _pieces(batch, plan, tree, seed)

    return placed, take


def mix(docs: DataFrame, carry: Sequence[str] = (), **options) -> DataFrame:
    """Which words of each document the mix takes, and where they go.

    Returns every document once: doc_id, source, the ``carry`` columns, size, source_size,
    target, taken and pieces (shard, position in it, pass, first word, words). Options are
    weights, share and cap of the targets, seed, blocks_per_source, block_words and
    shard_words. Null texts have no words; null is a source of its own; null and repeated
    ids are rows like others; an empty table gives no rows. Two sizes of the state are worth
    knowing: the driver reads one number per source, and a window holds one source's share
    of one bucket of documents.
    """
    columns = list(dict.fromkeys(["doc_id", "source", *carry]))
    placed, take = _located(docs, columns, **options)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    schema += f", size long, source_size long, target double, taken long, pieces {_PIECE}"
    return map_batches(placed, take, schema)


def _pieces(batch: pa.RecordBatch, plan: dict[str | None, Quota], tree: SplitTree, seed: int) -> pa.RecordBatch:
    """The pieces of a batch of documents, source by source, block by block."""
    names = batch.column("source").dictionary_encode()
    coded = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    size = batch.column("__size").to_numpy(zero_copy_only=False).astype(np.int64)
    start = batch.column("__start").to_numpy(zero_copy_only=False).astype(np.int64)
    order = batch.column("__order").to_numpy(zero_copy_only=False).view(np.uint64)
    rows = [np.zeros(0, np.int64)] * 6
    parts: list[list[np.ndarray]] = [[] for _ in rows]
    source_size, target = np.zeros(len(size), np.int64), np.zeros(len(size))
    for c in np.unique(coded):
        quota = plan[names.dictionary[int(c)].as_py() if c >= 0 else None]
        mine = np.flatnonzero(coded == c)
        source_size[mine], target[mine] = quota.size, quota.target
        mine = mine[size[mine] > 0]
        if not len(mine) or not quota.drawn:
            continue
        first = start[mine] // quota.block
        count = (start[mine] + size[mine] - 1) // quota.block - first + 1
        row = np.repeat(mine, count)
        block = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        low = np.maximum(block * quota.block, start[row])
        high = np.minimum((block + 1) * quota.block, start[row] + size[row])
        for turn in range(-(-quota.drawn // quota.blocks)):
            number = permuted(block, quota.blocks, seed << 20 ^ quota.code << 4 ^ turn) + turn * quota.blocks
            kept = number < quota.drawn
            shard = tree.shard_of(quota.code, number[kept])
            place = _mixed(order[row[kept]] ^ number[kept].astype(np.uint64), seed + turn) >> np.uint64(1)
            for part, value in zip(
                parts,
                (row[kept], shard, place.astype(np.int64), np.full(len(shard), turn), (low - start[row])[kept], (high - low)[kept]),
                strict=True,
            ):
                part.append(value.astype(np.int64))
    row, shard, place, turn, begin, length = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
    by = np.lexsort((begin, turn, row))
    row, shard, place, turn, begin, length = (x[by] for x in (row, shard, place, turn, begin, length))
    offsets = np.searchsorted(row, np.arange(len(size) + 1)).astype(np.int32)
    taken = np.bincount(row, weights=length, minlength=len(size)).astype(np.int64)
    pieces = pa.StructArray.from_arrays(
        [pa.array(shard), pa.array(place), pa.array(turn.astype(np.int32)), pa.array(begin), pa.array(length)],
        names=["shard", "position", "pass", "start", "length"],
    )
    kept = [n for n in batch.schema.names if not n.startswith("__")]
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(n) for n in kept),
            pa.array(size),
            pa.array(source_size),
            pa.array(target),
            pa.array(taken),
            pa.ListArray.from_arrays(pa.array(offsets), pieces),
        ],
        names=[*kept, "size", "source_size", "target", "taken", "pieces"],
    )


def piece_texts(text: str, pieces: list[tuple[int, int]], words: int) -> list[str]:
    """The words of each (first word, words) of a text, with the white space between them.

    A piece of all words is the text as it is. Words are found once for all pieces.
    """
    if all(count == words for _, count in pieces):
        return [text] * len(pieces)
    raw = text.encode()
    letters = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], (letters != 32) & ((letters < 9) | (letters > 13)), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    whole = [(0, len(raw)) if n == words else (starts[a], ends[a + n - 1]) for a, n in pieces]
    return [raw[a:b].decode() for a, b in whole]


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece, with its words in place of the whole text; some texts at a time."""
    for batch in batches:
        ends = batch.column("pieces").offsets.to_numpy()
        shard, position, first, count = (
            batch.column("pieces").values.field(f).to_numpy() for f in ("shard", "position", "start", "length")
        )
        low, cut, sizes, held = 0, [], [], 0
        for row, text in enumerate(batch.column("text")):
            a, b = ends[row], ends[row + 1]
            if b > a:
                spans = list(zip(first[a:b].tolist(), count[a:b].tolist(), strict=True))
                cut += piece_texts(text.as_py(), spans, batch.column("size")[row].as_py())
                held += sum(map(len, cut[len(cut) - len(spans) :]))
            sizes.append(b - a)
            if row == batch.num_rows - 1 or held > CUT_CHARS:
                rows = np.repeat(np.arange(low, row + 1), sizes)
                these = slice(ends[low], ends[row + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("carried").take(pa.array(rows)),
                        pa.array(shard[these]),
                        pa.array(position[these]),
                        pa.array(cut, pa.string()),
                    ],
                    names=["row", "shard", "position", "text"],
                )
                low, cut, sizes, held = row + 1, [], [], 0


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per piece, with its words, by shard and in random order within.

    Columns are those of ``docs``, whatever their names; ``text`` holds the words of the
    piece as they stand in the document, white space between them included, and n_chars, if
    present, its length. A document that the mix takes twice gives two rows, one that it
    doesn't take none, such as one with a null text or one without words.
    """
    others = [c for c in docs.columns if c != "text"]
    # The other columns travel as one, so that no name of theirs meets one of the mix's own.
    held = F.struct(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)))
    rows = docs.select("doc_id", "source", F.col("text").cast("string").alias("text"), held.alias("carried"))
    placed, take = _located(rows, ["doc_id", "source", "text", "carried"], **options)
    kind = rows.schema["carried"].dataType.simpleString()
    pieces = map_batches(
        placed, lambda batches: _cut_pieces(take(batches)), f"row {kind}, shard long, position long, text string"
    )
    kinds = dict(docs.dtypes)
    columns = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(kinds["n_chars"])
    ordered = pieces.repartition("shard").sortWithinPartitions("shard", "position")
    return ordered.select(*(columns[c].alias(c) for c in docs.columns))

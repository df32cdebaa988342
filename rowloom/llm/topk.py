"""Exact top-k search by the three-phase uniform threshold.

Vectors are cut into slices of dimensions; each slice is a list of local scores, shifted by
the least one so that none is negative. Phase 1 gathers the best local scores of every list
and the totals of what they name; the k-th best total is a safe cutoff. Phase 2 sends
a uniform share of the cutoff (cutoff / lists) to every list, which returns all entries at
or above it; a candidate in no list cannot reach the cutoff. Sums of what came back, with
the share in place of what did not, leave few candidates. Phase 3 scores these exactly.

Work is dealt in blocks: query blocks meet blocks of vectors, never rows meet rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import staged

LISTS = 2
BLOCK_ROWS = 2048
QUERY_ROWS = 256
# Groups that blocks are dealt to, at least, and the blocks of a group where there are more.
GROUPS = 64
GROUP_BLOCKS = 32
# Salts over which copies of one vector are counted before they meet.
SALTS = 32


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and floor(scale * x) of each component; vectors with a null or non-finite one are left out."""
    x = F.col("embedding")
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)) & F.col("vec_id").isNotNull()
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with the ``keep`` smallest ids of each; no result needs a larger id.

    Ids are limited per task and salt first, so a vector that fills the table stays cheap.
    """
    salted = rows.select("*", F.xxhash64("v").alias("h"), F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("s"))
    first = Window.partitionBy("h", "v", "s").orderBy("vec_id")
    few = salted.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep)
    lists = few.groupBy("h", "v", "s").agg(F.collect_list("vec_id").alias("ids"))
    whole = lists.groupBy("h", "v").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    ids = F.slice(F.array_sort("ids"), 1, keep)
    return whole.select(F.array_min("ids").alias("cand"), ids.alias("ids"), "v")


def _blocks(rows: DataFrame, key: str, size: int, lists: int, name: str) -> DataFrame:
    """Rows packed into blocks: one row per block and list with ids and a matrix of the list's dimensions."""

    def pack(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size)
                vectors = part.column("v")
                widths = np.diff(vectors.offsets.to_numpy())
                flat = vectors.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(widths)
                ids = part.column(key).to_numpy(zero_copy_only=False)
                for width in np.unique(widths):
                    at = np.flatnonzero(widths == width)
                    matrix = np.stack([flat[ends[i] - width : ends[i]] for i in at])
                    cuts = np.linspace(0, width, lists + 1).astype(int)
                    yield pa.RecordBatch.from_pylist(
                        [
                            {"width": int(width), "list": j, "ids": ids[at].tobytes(), "m": matrix[:, a:b].tobytes()}
                            for j, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                        ],
                        schema=pa.schema([("width", pa.int32()), ("list", pa.int32()), ("ids", pa.binary()), ("m", pa.binary())]),
                    )

    packed = rows.select(key, "v").mapInArrow(pack, "width int, list int, ids binary, m binary")
    return staged(packed.withColumn("block", F.monotonically_increasing_id()), name)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: by floats where no sum can pass 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _matrix(ids: bytes, m: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    return names, np.frombuffer(m, np.int64).reshape(len(names), -1)


def _groups(blocks: DataFrame) -> int:
    """How many groups staged blocks are dealt to, so that none grows with the table."""
    return max(GROUPS, -(-blocks.count() // GROUP_BLOCKS))


def _block_pairs(queries: DataFrame, blocks: DataFrame, groups: int) -> DataFrame:
    """Every query block beside every block of vectors of the same width and list."""
    dealt = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    asked = queries.select(
        *(F.col(c).alias(f"q_{c}" if c in ("ids", "m", "block") else c) for c in queries.columns),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    return dealt.join(asked, ["width", "list", "group"])


def _local_best(k: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                names, m = _matrix(one["ids"], one["m"])
                asked, q = _matrix(one["q_ids"], one["q_m"])
                scores = product(q, m)
                take = min(k, len(names))
                top = np.argpartition(-scores, take - 1, axis=1)[:, :take]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked),
                        pa.array(np.full(len(asked), one["width"], np.int32)),
                        pa.array(np.full(len(asked), one["list"], np.int32)),
                        pa.array(scores.min(axis=1)),
                        pa.array(list(names[top]), pa.list_(pa.int64())),
                        pa.array(list(np.take_along_axis(scores, top, 1)), pa.list_(pa.int64())),
                    ],
                    names=["query", "width", "list", "low", "cands", "scores"],
                )

    return run


def _entries(batches: Iterator[pa.RecordBatch]):
    """All entries of a list at or above its share of the cutoff."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1).to_pylist()[0]
            names, m = _matrix(one["ids"], one["m"])
            asked, q = _matrix(one["q_ids"], one["q_m"])
            shares = {query: (low, share) for query, low, share in zip(one["asked"], one["lows"], one["shares"], strict=True)}
            bound = np.array([shares.get(i, (0, None)) for i in asked.tolist()], dtype=object)
            known = np.array([b is not None for b in bound[:, 1]])
            low = bound[:, 0].astype(np.int64)
            share = np.where(known, bound[:, 1], 0).astype(np.int64)
            shifted = product(q, m) - low[:, None]
            hit = (shifted >= share[:, None]) & known[:, None]
            who, which = np.nonzero(hit)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(asked[who]),
                    pa.array(np.full(len(who), one["list"], np.int32)),
                    pa.array(names[which]),
                    pa.array(shifted[who, which]),
                ],
                names=["query", "list", "cand", "score"],
            )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, lists: int = LISTS) -> DataFrame:
    """The k vectors of highest integer inner product for each query, but for the query's own.

    Both tables have vec_id and v (array of long), as ``integer_vectors`` makes them. Returns
    query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; with fewer vectors
    than k all are returned. Vectors of another width than the query's take no part. An empty
    table gives no rows. Repeated ids are rows of their own: each different vector of a query's
    id asks by itself, and every row but one with its id and vector, its own, may be found.
    Equal query rows ask once.
    """
    keep = k + 1  # the query's own may be among the best
    reps = staged(distinct_vectors(vectors, keep), "topk-vectors")
    # A number per query, since ids may repeat; staged, so that it stays what it is.
    numbered = queries.select(F.col("vec_id").alias("query_id"), "v").distinct()
    asked = staged(numbered.withColumn("query", F.monotonically_increasing_id()), "topk-numbered")
    blocks = _blocks(reps, "cand", BLOCK_ROWS, lists, "topk-blocks")
    query_blocks = _blocks(asked, "query", QUERY_ROWS, lists, "topk-queries")
    groups = _groups(blocks)
    pairs = _block_pairs(query_blocks, blocks, groups)

    # Phase 1: the best local scores of every list, and the least score, by which lists shift.
    local = staged(
        pairs.mapInArrow(
            _local_best(keep), "query long, width int, list int, low long, cands array<long>, scores array<long>"
        ),
        "topk-local",
    )
    lows = local.groupBy("query", "width", "list").agg(F.min("low").alias("low"))
    every = local.select("query", "list", F.explode(F.arrays_zip("cands", "scores")).alias("e")).select(
        "query", "list", F.col("e.cands").alias("cand"), F.col("e.scores").alias("score")
    )
    best = Window.partitionBy("query", "list").orderBy(F.desc("score"), "cand")
    gathered = every.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep)
    # Exact totals of what was gathered are the tightest bounds that it can give.
    total = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    floors = lows.groupBy("query").agg(F.sum("low").alias("floor"))
    partial = (
        gathered.select("query", "cand")
        .distinct()
        .join(reps.select("cand", "v"), "cand")
        .join(asked.select("query", F.col("v").alias("qv")), "query")
        .join(floors, "query")
        .select("query", "cand", (total - F.col("floor")).alias("bound"))
    )
    by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "cand")
    kth = partial.withColumn("n", F.row_number().over(by_bound)).where(F.col("n") <= keep)
    cutoff = kth.groupBy("query").agg(F.count("*").alias("found"), F.min("bound").alias("cutoff"))
    share = F.when(F.col("found") >= keep, F.expr(f"cutoff div {lists}")).otherwise(F.lit(0))
    shares = staged(lows.join(cutoff.select("query", share.alias("share")), "query"), "topk-cutoffs")

    # Phase 2: the shares travel with the query blocks.
    holds = (
        _query_places(query_blocks)
        .join(shares, ["query", "list"])
        .groupBy("block", "list")
        .agg(
            F.collect_list("query").alias("asked"),
            F.collect_list("low").alias("lows"),
            F.collect_list("share").alias("shares"),
        )
    )
    told = staged(query_blocks.join(holds, ["block", "list"]), "topk-asked")
    entries = _block_pairs(told, blocks, groups).mapInArrow(_entries, "query long, list int, cand long, score long")
    seen = staged(
        entries.groupBy("query", "cand").agg(F.sum("score").alias("bound"), F.count("*").alias("lists")), "topk-seen"
    )
    second = seen.withColumn("n", F.row_number().over(by_bound)).where(F.col("n") <= keep)
    cutoff2 = second.groupBy("query").agg(F.count("*").alias("found"), F.min("bound").alias("cutoff"))
    rests = shares.groupBy("query").agg(F.max("share").alias("share")).join(cutoff2, "query")
    may = F.col("bound") + (lists - F.col("lists")) * F.col("share")
    left = seen.join(rests, "query").where((F.col("found") < keep) | (may >= F.col("cutoff"))).select("query", "cand")

    # Phase 3: exact totals of the candidates left.
    scored = (
        left.join(reps, "cand")
        .join(asked.select("query", "query_id", F.col("v").alias("qv")), "query")
        .select("query", "query_id", "ids", total.alias("score"), (F.col("v") == F.col("qv")).alias("same"))
    )
    # Distinct vectors first: at most k + 1 of them, with at most k + 1 ids each.
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    few = scored.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= keep)
    own = F.when(F.col("same"), F.array_position("ids", F.col("query_id")) - 1).otherwise(-1)
    rows = (
        few.select("query", "query_id", "score", own.alias("own"), F.posexplode("ids").alias("at", "vec_id"))
        .where(F.col("at") != F.col("own"))
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _query_places(query_blocks: DataFrame) -> DataFrame:
    """The block and list in which each query stands."""

    def names(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[row].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.array(np.full(len(ids), batch.column("list")[row].as_py(), np.int32)),
                        pa.array(np.full(len(ids), batch.column("block")[row].as_py(), np.int64)),
                    ],
                    names=["query", "list", "block"],
                )

    return query_blocks.select("ids", "list", "block").mapInArrow(names, "query long, list int, block long")

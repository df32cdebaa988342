"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word runs. Each distinct text gets a fixed number of sampled
tokens (minima of its set under as many hash functions), so that two texts share a token
with the probability of their similarity. A run sends every text down a path: at the root by
one sampled token, at each further node by two tokens that the node's path picks, so that
texts meet in a bucket only if they share all tokens on the way. Buckets that are small are
compared by brute force; larger ones split again, but for those that a split leaves more
than half whole: their texts are alike and form one group. Runs with other root tokens repeat until
a pair at the threshold is missed with less than the target probability.

What meets in buckets is grouped by estimated similarity, well below the threshold, and each
group is then compared exactly, block by block on whole sets, so that every link between
different texts of a group counts once, in how many buckets its ends may have met. Copies of
one text stand together as one representative throughout. Tokens and texts are shuffled only
for rows that a bitmap of the wanted hashes lets pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import map_batches
from rowloom.llm.common import SPACES, order_key, possible, quoted, staged
from rowloom.llm.components import components

WORDS = 5
THRESHOLD = (4, 5)
TOKENS = 64
# Texts that one brute-force comparison takes from a bucket side.
BUCKET = 128
DEPTH = 12
# Tokens that a split of each depth may pick, none of which a root or another depth uses.
FRESH = 5
# Texts and bytes of sets that one exact comparison takes from each side.
EXACT_BLOCK = 2048
EXACT_BYTES = 4 << 20
# Texts of a side that are compared at a time.
EXACT_ROWS = 128
# Elements that more than this share of a side's texts hold are multiplied, rarer ones paired.
COMMON = 16
PAIRS = 1 << 18
RECALL = 0.99999
# Estimated similarity from which texts of a bucket are compared exactly; the estimate's
# deviation at the threshold is 0.05, so a link falls below with a chance of about 2e-4.
ESTIMATE = 0.625
STEP_CHARS = 4_000_000


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold shares a root token with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold)))


def shingle_hashes(texts: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the hashes of its word runs, repeats included; a shorter text is one run."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + STEP_CHARS, side="right")))
        split = pc.ascii_split_whitespace(texts.slice(row, stop - row))
        coded = split.flatten().dictionary_encode()
        one = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
        index = coded.indices.to_numpy(zero_copy_only=False)
        counts = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)))
        blank = empty[index] if len(index) else np.zeros(0, bool)
        for a, b in zip(counts[:-1], counts[1:], strict=True):
            words = one[index[a:b][~blank[a:b]]]
            n = max(len(words) - size + 1, min(len(words), 1))
            out = np.zeros(n, np.uint64)
            for j in range(min(size, len(words))):
                out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
            yield (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        row = stop


def _functions(tokens: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(97)
    return draw.integers(1 << 32, size=tokens, dtype=np.uint32), draw.integers(1 << 32, size=tokens, dtype=np.uint32) | 1


def minima(hashes: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of a set under each hash function."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(flips), (1 << 32) - 1, np.uint32)
    for low in range(0, len(short), 2048):
        each = (short[low : low + 2048, None] ^ flips) * factors
        best = np.minimum(best, (each ^ (each >> np.uint32(15))).min(axis=0))
    return best.view(np.int32)


def signed(docs: DataFrame) -> DataFrame:
    """key, two hashes of the text, number of distinct shingles and sampled tokens of each row."""

    def run(batches: Iterator[pa.RecordBatch]):
        flips, factors = _functions(TOKENS)
        for batch in batches:
            sizes, tokens = [], []
            for hashes in shingle_hashes(batch.column("text")):
                sizes.append(len(hashes))
                tokens.append(minima(hashes, flips, factors))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            offsets = np.arange(0, len(flat) + 1, TOKENS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("k1"),
                    batch.column("k2"),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["key", "k1", "k2", "n", "tokens"],
            )

    return map_batches(keyed(docs), run, "key long, k1 long, k2 long, n int, tokens array<int>")


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        order_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(1), text).alias("k2"),
        text.alias("text"),
    )


def _blocks(rows: DataFrame, many: Column) -> DataFrame:
    """Deal the members of a group into ``many`` blocks and every block to each pair it is in."""
    dealt = rows.withColumn("own", F.pmod(F.xxhash64(F.lit(7), "rid"), many).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
    return dealt.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})


def bucket_links(reps: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) that group texts that met in a bucket and look similar."""
    runs = runs_for(recall, THRESHOLD[0] / THRESHOLD[1])
    if runs > TOKENS:
        raise ValueError("more runs than sampled tokens")
    order = [int(c) for c in np.random.default_rng(13).permutation(TOKENS)]
    roots, fresh = order[:runs], order[runs:] + order
    tokens = reps.where("n > 0").select("rid", "tokens")
    paths = F.array(*(F.xxhash64(F.lit(c), F.get("tokens", F.lit(c))) for c in roots))
    nodes = staged(tokens.select("rid", F.explode(paths).alias("path"), F.lit(None).cast("long").alias("above")), "paths")
    leaves, stars, splitting = [], [], None
    for depth in range(1, DEPTH + 1):
        sizes = staged(
            nodes.groupBy("path")
            .agg(F.count("*").alias("size"), F.min("above").alias("above"), F.min("rid").alias("head"))
            .where("size > 1"),
            "sizes",
        )
        # The sizes are read anew, so that the join can split the rows of a path that many share.
        members = staged(nodes.select("rid", "path").join(sizes, "path"), "buckets")
        # A bucket that its last split left whole holds texts alike: one group for the exact stage.
        whole = (F.col("size") > BUCKET) & F.coalesce(F.col("size") * 2 > F.col("above"), F.lit(False))
        stars.append(members.where(whole).select(F.col("rid").alias("a"), F.col("head").alias("b")))
        small = F.lit(True) if depth == DEPTH else F.col("size") <= BUCKET
        leaves.append(members.where(small & ~whole).select("rid", "path", "size"))
        large = members.where((F.col("size") > BUCKET) & ~whole).select("rid", "path", "size")
        if depth == DEPTH or not large.limit(1).count():
            break
        if splitting is None:  # texts of large buckets are among those of the large buckets before
            wanted = possible(large.select(F.xxhash64("rid")).distinct())
            splitting = staged(tokens.where(wanted(F.xxhash64("rid"))), "splitting")
        # Two tokens that no split on the way has used, so that only texts alike stay together.
        given = F.array(*map(F.lit, fresh[(depth - 1) * FRESH : depth * FRESH]))
        first = F.pmod(F.xxhash64("path", F.lit(0)), F.lit(FRESH)).cast("int")
        second = F.pmod(first + 1 + F.pmod(F.xxhash64("path", F.lit(1)), F.lit(FRESH - 1)).cast("int"), F.lit(FRESH))
        picks = [F.get(given, place) for place in (first, second)]
        children = F.array(*(F.xxhash64("path", p, F.get("tokens", p)) for p in picks))
        split = large.join(splitting, "rid")
        nodes = staged(split.select("rid", F.explode(children).alias("path"), F.col("size").alias("above")), "paths")
    leaves = reduce(DataFrame.unionByName, leaves)
    wanted = possible(leaves.select(F.xxhash64("rid")).distinct())
    met = _blocks(
        leaves.join(tokens.where(wanted(F.xxhash64("rid"))), "rid"), F.ceil(F.col("size") / BUCKET).cast("int")
    )
    buckets = met.groupBy("path", "one", "two").agg(
        F.collect_list(F.struct("rid", "tokens")).alias("members")  # two blocks at most
    )

    def compare(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ends: list[np.ndarray] = []
            lists = batch.column("members")
            flat, offsets = lists.flatten(), lists.offsets.to_numpy()
            rids = flat.field("rid").to_numpy(zero_copy_only=False)
            values = flat.field("tokens").flatten().to_numpy(zero_copy_only=False).reshape(-1, TOKENS)
            offsets = offsets - offsets[0]
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                if b - a > 1:
                    ends.append(_forest(rids[a:b], _agreement(values[a:b]) >= ESTIMATE * TOKENS))
            edges = np.concatenate(ends) if ends else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    compared = map_batches(buckets.select("members"), compare, "a long, b long")
    return reduce(DataFrame.unionByName, stars, compared).where("a <> b").distinct()


def _agreement(values: np.ndarray) -> np.ndarray:
    """Equal tokens of each pair of rows."""
    out = np.zeros((len(values), len(values)), np.int16)
    for column in values.T:
        out += column[:, None] == column[None, :]
    return out


def _forest(rids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Edges from each member to the first of its component in a matrix of links."""
    np.fill_diagonal(linked, True)
    label = np.arange(len(rids))
    while True:
        least = np.where(linked, label[None, :], len(rids)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    at = np.flatnonzero(label != np.arange(len(rids)))
    return np.stack([rids[at], rids[label[at]]], axis=1).reshape(-1, 2)


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give what pairs of rows connect the least of their labels; a label is a row that has itself as label."""
    while (label[a] != label[b]).any():
        np.minimum.at(label, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
        while (label[label] != label).any():
            label[:] = label[label]


def _paired(out: np.ndarray, row: np.ndarray, column: np.ndarray, starts: np.ndarray, others: np.ndarray) -> None:
    """Add one to each pair of a row and the rows of the other side that share its element."""
    many = np.diff(starts)[column]
    ends = np.cumsum(many)
    low = 0
    while low < len(row):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        n = many[low:high]
        shift = starts[column[low:high]] - (ends[low:high] - n - done)
        np.add.at(out, (np.repeat(row[low:high], n), others[np.arange(n.sum()) + np.repeat(shift, n)]), 1)
        low = high


def set_links(
    values: np.ndarray, n: np.ndarray, copies: np.ndarray, other: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each of some sets the copies of sets at the threshold, and the first set that links lead to.

    ``values`` has the elements of all sets, ``n`` says how many each has. Sets that are not ``other``
    are compared with those that are, or without ``other`` all with each other. Only sets of sizes that allow the threshold
    meet. Elements that many sets share are multiplied in bits of a matrix, the rest is counted
    from pairs of sets that share one.
    """
    size = len(n)
    links, label = np.zeros(size, np.int64), np.arange(size)
    code, count = np.unique(values, return_inverse=True, return_counts=True)[1:]
    shared = count > 1
    row, column = np.repeat(np.arange(size), n)[shared[code]], (np.cumsum(shared) - 1)[code[shared[code]]]
    by_size = np.argsort(n, kind="stable")
    sides = [by_size, by_size] if other is None else [by_size[~other[by_size]], by_size[other[by_size]]]
    width = int(shared.sum())
    kind = np.float64 if n.max(initial=0) >= 1 << 24 else np.float32
    out = np.zeros((len(sides[0]), len(sides[1])), kind)
    at, held = [], []  # of each side: elements and places of their sets, in order of elements
    for side in sides:
        place = np.full(size, -1)
        place[side] = np.arange(len(side))
        own = place[row] >= 0
        order = np.argsort(column[own], kind="stable")
        at.append(column[own][order])
        held.append(place[row[own]][order])
    many = [np.bincount(a, minlength=width) for a in at]
    both = (many[0] > 0) & (many[1] > 0)
    common = both & (many[0] * many[1] * COMMON**2 > out.size)
    few = both & ~common
    first, second = n[sides[0]], n[sides[1]]
    # Rows of the first side at a time, with the rows of the second whose sizes allow a link.
    spans = []
    for low in range(0, len(first), EXACT_ROWS):
        part = first[low : low + EXACT_ROWS]
        span = np.searchsorted(second * THRESHOLD[1], part[0] * THRESHOLD[0], side="left")
        stop = np.searchsorted(second * THRESHOLD[0], part[-1] * THRESHOLD[1], side="right")
        spans.append((slice(low, low + len(part)), slice(int(span), int(stop))))
    number = np.cumsum(common) - 1
    most = int(common.sum())
    step = max(64, min(most, (1 << 20) // max(1, *out.shape)))
    chosen = [common[a] for a in at]
    for low in range(0, most, step):
        bits = []
        for a, h, c in zip(at, held, chosen, strict=True):
            i, j = h[c], number[a[c]]
            i, j = (x[slice(*np.searchsorted(j, [low, low + step]))] for x in (i, j))
            bits.append(np.zeros((out.shape[len(bits)], step), np.float32))
            bits[-1][i, j - low] = 1
        for one, two in spans:
            out[one, two] += bits[0][one] @ bits[1][two].T
    chosen = few[at[0]]
    _paired(out, held[0][chosen], at[0][chosen], np.append(0, np.cumsum(many[1])), held[1])
    for one, two in spans:
        a, b = sides[0][one], sides[1][two]
        linked = (THRESHOLD[0] + THRESHOLD[1]) * out[one, two].astype(np.float64) >= THRESHOLD[0] * (
            n[a][:, None] + n[b][None, :]
        )
        linked &= a[:, None] != b[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        if not len(some):
            continue
        a, linked = a[some], linked[some]
        links[a] += (linked.astype(np.float64) @ copies[b]).astype(np.int64)
        if other is not None:
            links[b] += (copies[a] @ linked.astype(np.float64)).astype(np.int64)
        while True:
            apart = linked & (label[a][:, None] != label[b][None, :])
            best = apart.argmax(axis=1)
            found = np.flatnonzero(apart[np.arange(len(a)), best])
            if not len(found):
                break
            _merged(label, a[found], b[best[found]])
    return links, label


def exact_links(docs: DataFrame, reps: DataFrame, groups: DataFrame) -> DataFrame:
    """For members of groups: rid, links to rows of other texts, and a linked root or null.

    A row for each pair of blocks that a member is in; the links of all add up.
    """
    active = staged(
        groups.withColumnRenamed("node", "rid").join(reps.select("rid", "key", "k1", "k2", "copies"), "rid"), "active"
    )
    row = ["key", "k1", "k2"]
    wanted = possible(active.select(F.xxhash64(*row)))
    # A row that is repeated in the table brings its text as often: once is enough.
    once = keyed(docs).where(wanted(F.xxhash64(*row))).groupBy(*row).agg(F.any_value("text").alias("text"))
    texts = once.join(active, row).select("rid", "component", "copies", "text")

    def sets(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            packed = [np.unique(h).tobytes() for h in shingle_hashes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("component"), batch.column("copies"), pa.array(packed, pa.binary())],
                names=["rid", "component", "copies", "items"],
            )

    known = staged(map_batches(texts, sets, "rid long, component long, copies long, items binary"), "sets")
    sizes = known.groupBy("component").agg(F.count("*").alias("size"), F.sum(F.octet_length("items")).alias("bytes"))
    many = F.greatest(F.ceil(F.col("size") / EXACT_BLOCK), F.ceil(F.col("bytes") / EXACT_BYTES)).cast("int")
    pairs = _blocks(known.join(staged(sizes, "sizes"), "component"), many)
    # Dealt anew: a join that is no broadcast leaves all blocks of a group in one task.
    pairs = pairs.repartition("component", "one", "two")
    other = (F.col("own") != F.col("one")).alias("other")
    members = pairs.groupBy("component", "one", "two").agg(
        F.collect_list(F.struct("rid", "copies", "items", other)).alias("members")  # two blocks at most
    )

    def compare(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column("members")
            flat, ends = lists.flatten(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            rids, copies, other = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rid", "copies", "other"))
            items = flat.field("items").cast(pa.binary())
            between = pc.not_equal(batch.column("one"), batch.column("two")).to_pylist()
            places = np.frombuffer(items.buffers()[1], np.int32)[items.offset : items.offset + len(items) + 1] // 8
            values = np.frombuffer(items.buffers()[2], np.uint64) if len(items) else np.zeros(0, np.uint64)
            n = np.diff(places).astype(np.int64)
            links, roots = np.zeros(len(rids), np.int64), np.arange(len(rids))
            for a, b, cross in zip(ends[:-1], ends[1:], between, strict=True):
                if b - a > 1:
                    part = values[places[a] : places[b]]
                    links[a:b], label = set_links(part, n[a:b], copies[a:b], other[a:b] if cross else None)
                    roots[a:b] = a + label
            alone = roots == np.arange(len(rids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids), pa.array(links), pa.array(rids[roots], pa.int64(), mask=alone)],
                names=["rid", "links", "root"],
            )

    return map_batches(members.select("one", "two", "members"), compare, "rid long, links long, root long")


def similar_texts(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row per distinct text: k1, k2 (its hashes), key, copies, class_id and links.

    class_id is the least document key of all texts that chains of links connect; links
    counts the rows of other texts at a similarity of 0.8 or more. Texts without words have
    no shingles, link to nothing and get no class here.
    """
    rows = signed(docs)
    reps = staged(
        rows.groupBy("k1", "k2")
        .agg(
            F.min("key").alias("key"),
            F.count("*").alias("copies"),
            F.max("n").alias("n"),
            F.any_value("tokens").alias("tokens"),
        )
        .withColumn("rid", F.monotonically_increasing_id()),
        "texts",
    )
    groups = components(bucket_links(reps, recall))
    exact = staged(exact_links(docs, reps, groups), "links")
    classes = components(exact.where("root IS NOT NULL").select(F.col("rid").alias("a"), F.col("root").alias("b")))
    links = exact.groupBy("rid").agg(F.sum("links").alias("links"))
    found = reps.where("n > 0").select("rid", "k1", "k2", "key", "copies")
    member = staged(found.join(classes.withColumnRenamed("node", "rid"), "rid", "left").join(links, "rid", "left"), "members")
    least = staged(
        member.where("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("class_id")), "classes"
    )
    return staged(
        member.join(least, "component", "left").select(
            "k1",
            "k2",
            "key",
            "copies",
            F.coalesce("class_id", "key").alias("class_id"),
            F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        ),
        "similar",
    )


def link_classes(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id and n_links of every row of documents.

    class_id is the least doc_id among documents that chains of links connect, copies
    included (a null id counts as a large number made of its text's hash); n_links counts
    all other rows at a similarity of 0.8 or more, copies included. Null and empty texts
    link to nothing, one class each. Texts of fewer than five words are one shingle.
    Repeated rows are rows of their own; an empty table gives no rows.
    """
    similar = similar_texts(docs, recall).select("k1", "k2", "copies", "class_id", "links")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        order_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(1), text).alias("k2"),
    )
    return rows.join(similar, ["k1", "k2"], "left").select(
        "doc_id",
        F.coalesce("class_id", "key").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Documents without near duplicates: of each class the row with the least doc_id stays.

    Columns are unchanged. Texts without words are no duplicates of each other and stay;
    of rows repeated with id and text, one stays.
    """
    similar = similar_texts(docs, recall)
    # Rows of a text that has no others and is in no other's class stay where they are.
    contested = similar.where("copies > 1 OR key <> class_id")
    wanted = possible(contested.select(F.xxhash64("k1", "k2")))
    stays = similar.where("key = class_id").where(wanted(F.xxhash64("k1", "k2")))
    stays = stays.select(F.col("key").alias("__key"), F.col("k1").alias("__h1"), F.col("k2").alias("__h2"))
    text = F.coalesce("text", F.lit(""))
    row = ["__key", "__h1", "__h2"]
    rows = docs.withColumns(
        {
            "__key": order_key(F.col("doc_id"), F.col("text")),
            "__h1": F.xxhash64(text),
            "__h2": F.xxhash64(F.lit(1), text),
        }
    ).withColumn("__met", (F.btrim(text, F.lit(SPACES)) != "") & wanted(F.xxhash64("__h1", "__h2")))
    kept = rows.where("__met").dropDuplicates(row).join(stays, row, "left_semi")
    names = [quoted(c) for c in docs.columns]
    return rows.where("NOT __met").select(*names).unionByName(kept.select(*names))

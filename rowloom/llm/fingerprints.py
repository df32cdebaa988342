"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every run of five words is hashed once; the hash's upper half picks a bin, the bin keeps the
least hash. Empty bins are filled by optimal densification: each probes other bins in an
order of its own, equal for all documents, until it finds one with a value. Of each bin only
the low-order bits are stored; the likeness of two fingerprints is the share of equal bins,
corrected for bins that agree by chance.
"""

from __future__ import annotations

import struct

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import shuffle_partitions

BINS = 128
BITS = 4
WORDS = 5
# A hash's upper bits are its bin, the rest its value there.
BIN_SHIFT = 64 - (BINS.bit_length() - 1)
# Probes written out per bin before the search over all bins takes over.
PROBES = 12


def words_of(text: Column) -> Column:
    """The words of a text, parted by ASCII white space; an empty text gives one empty word."""
    return F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")


def run_hashes(words: Column, length: int = WORDS) -> Column:
    """A hash of each run of ``length`` words; a shorter text is one run, an empty one has none.

    ``words`` must be a column of the table, not an expression: every run looks words up in it.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - length, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(length))))
    return F.when(F.get(words, F.lit(0)) != "", hashes).otherwise(F.array().cast("array<long>"))


def _hash(*numbers: int) -> int:
    """The signed value of ``xxhash64`` of integers."""
    seed = 42
    for number in numbers:
        seed = xxhash.xxh64_intdigest(struct.pack("<i", number), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _probes(attempts: int) -> list[list[int]]:
    """The bins that each bin looks at when empty: a start and an odd step drawn per bin meet every bin."""
    draws = [(_hash(i, 1) % BINS, _hash(i, 2) % (BINS // 2) * 2 + 1) for i in range(BINS)]
    return [[(start + step * k) % BINS for k in range(attempts)] for start, step in draws]


def densified(bins: Column) -> Column:
    """Fill nulls of an array of BINS values; an array of nulls stays one.

    ``bins`` must be a column of the table, not an expression: every probe looks a bin up in it.
    """
    # Literal arrays, one lookup for each probe; the probes beyond the first few are hardly ever made.
    near = F.expr(f"array({', '.join(str(p) for of_bin in _probes(PROBES) for p in of_bin)})")
    every = F.expr(f"array({', '.join(f'array({str(of_bin)[1:-1]})' for of_bin in _probes(BINS))})")
    filled = F.transform(
        bins,
        lambda value, i: F.coalesce(
            value,
            *(F.get(bins, F.get(near, i * PROBES + k)) for k in range(PROBES)),
            F.get(F.filter(F.transform(F.get(every, i), lambda p: F.get(bins, p)), lambda x: x.isNotNull()), F.lit(0)),
        ),
    )
    return F.when(F.exists(bins, lambda x: x.isNull()), filled).otherwise(bins)


def packed(bins: Column) -> Column:
    """Low-order bits of each bin as one hexadecimal digit; no shingles give an empty string."""
    digits = F.transform(bins, lambda x: F.substring(F.lit("0123456789abcdef"), x.bitwiseAND(15).cast("int") + 1, F.lit(1)))
    return F.when(F.get(bins, F.lit(0)).isNull(), F.lit("")).otherwise(F.array_join(digits, ""))


def likeness(one: Column, two: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints: 1 for equal ones, 0 if one alone is empty."""
    same = F.size(
        F.filter(F.arrays_zip(F.split(one, "").alias("a"), F.split(two, "").alias("b")), lambda p: p["a"] == p["b"])
    )
    chance = 2.0**-BITS
    corrected = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when(one == two, F.lit(1.0))
        .when((F.length(one) == 0) | (F.length(two) == 0), F.lit(0.0))
        .otherwise(F.greatest(F.least(corrected, F.lit(1.0)), F.lit(0.0)))
    )


def bin_minima(ordered: Column) -> Column:
    """The least hash of each bin, null where a bin is empty, from hashes that ``in_bins`` put in order."""
    low = F.lit((1 << BIN_SHIFT) - 1)
    heads = F.filter(
        ordered,
        lambda h, i: (i == 0) | (F.shiftrightunsigned(h, BIN_SHIFT) != F.shiftrightunsigned(F.get(ordered, i - 1), BIN_SHIFT)),
    )
    least = F.transform(heads, lambda h: F.when(h.bitwiseAND(low) != low, h))
    # Signed order puts the upper half of the bins first.
    return F.concat(F.slice(least, BINS // 2 + 1, BINS // 2), F.slice(least, 1, BINS // 2))


def in_bins(hashes: Column) -> Column:
    """Hashes in order, with the greatest value of each bin as its end, so that every bin has a first value."""
    ends = [((b << BIN_SHIFT) | ((1 << BIN_SHIFT) - 1)) for b in range(BINS)]
    signed = F.array(*(F.lit(e - (1 << 64) if e >> 63 else e).cast("long") for e in ends))
    return F.sort_array(F.concat(hashes, signed))


def with_fingerprints(texts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Replace each text column by the fingerprint column that ``columns`` names for it.

    All steps are array functions within a row, one projection after another: no run of words
    becomes a row, and nothing is shuffled.
    """
    rest = [c for c in texts.columns if c not in columns]
    steps = [words_of, run_hashes, in_bins, bin_minima, densified, packed]
    names = list(columns)
    for step in steps:
        texts = texts.select(*rest, *(step(F.col(name)).alias(name) for name in names))
    return texts.select(*rest, *(F.col(name).alias(columns[name]) for name in names))


def with_next(docs: DataFrame) -> DataFrame:
    """Each document with the text of the next one by descending id, the last with the first's.

    One shuffle of the texts, by ranges of ids. The first document of each range is also
    dealt to the range before it, as a ghost, so that no range needs another's rows. Range
    bounds and first ids number twice the shuffle partitions at most.
    """
    spark = docs.sparkSession
    ranges = 2 * shuffle_partitions(spark)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shares = [k / ranges for k in range(1, ranges)]
    bounds = ids.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    # Descending ids: range 0 holds the largest; null ids come last.
    wide = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k : k + wide] for k in range(0, len(bounds), wide)]
    below = F.lit(0)
    if bounds:
        heads = F.array(*(F.lit(g[0]) for g in groups))
        group = F.size(F.filter(heads, lambda b: b < F.col("doc_id")))
        table = F.array(*(F.array(*(F.lit(b) for b in g)) for g in groups))
        inside = F.size(F.filter(F.get(table, F.greatest(group - 1, F.lit(0))), lambda b: b < F.col("doc_id")))
        below = F.greatest(group - 1, F.lit(0)) * wide + inside
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(F.lit(len(bounds)) - below)
    firsts = ids.groupBy(part.cast("int").alias("part")).agg(F.max("doc_id").alias("first"))
    order = [r for r in firsts.orderBy("part").collect()]
    before = {r["part"]: order[k - 1]["part"] for k, r in enumerate(order)}
    # Not a ghost where the id is null: such a range has its first row found by its number.
    first_of = F.lit(None).cast("int")
    for_ids = [(r["first"], before[r["part"]]) for r in order if r["first"] is not None]
    if for_ids:
        lookup = F.create_map(*(F.lit(x) for pair in for_ids for x in pair))
        first_of = F.try_element_at(lookup, F.col("doc_id"))
    if order and order[-1]["first"] is None:
        first_of = F.when(F.col("doc_id").isNull(), F.lit(before[order[-1]["part"]])).otherwise(first_of)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = F.struct(part.cast("int").alias("part"), F.lit(0).alias("ghost"))
    ghost = F.struct(first_of.alias("part"), F.lit(1).alias("ghost"))
    dealt = texts.select(
        "*", F.explode(F.when(first_of.isNotNull(), F.array(own, ghost)).otherwise(F.array(own))).alias("at")
    ).select("at.part", "at.ghost", "doc_id", "text")
    line = Window.partitionBy("part").orderBy("ghost", F.desc_nulls_last("doc_id"), "text")
    return dealt.select(
        "*", F.row_number().over(line).alias("line"), F.lead("text").over(line).alias("next_text")
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    The edited text has the last half of the document's characters replaced by as many
    first characters of the next document by descending id. Null texts count as empty; null
    ids come last; repeated ids and rows are rows of their own, ordered by text; an empty
    table gives no rows; other columns are ignored. Texts without words have the empty
    fingerprint, which is like itself only.
    """
    chained = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    )
    edited = F.when(F.col("ghost") == 0, edited).otherwise(F.lit(""))
    texts = chained.select("part", "ghost", "line", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    kinds = texts.withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    rows = with_fingerprints(kinds, {"text": "fingerprint", "edited": "edited_fingerprint"})
    line = Window.partitionBy("part").orderBy("line")
    following = rows.withColumn("next_print", F.lead("fingerprint").over(line)).where("ghost = 0")
    return following.select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next_print", F.lit(""))).alias("near_next"),
    )

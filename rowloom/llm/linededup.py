"""Line deduplication by overlapping windows of three lines.

Three consecutive lines that are not blank form a window, hashed to 128 bits. Windows that
occur more than once in the collection are found by one aggregation; every occurrence but
the first, in order of doc_id and place, is removed. Windows overlap, so the lines that
removed windows cover are merged before the text is put together from the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import order_key, quoted, staged

LINES = 3


def _numbered(lines: Column) -> Column:
    """Numbers of the lines that are not blank, from 0."""
    flagged = F.transform(lines, lambda line, i: F.when(F.btrim(line, F.lit(" \t\r\x0b\x0c")) != "", i))
    return F.array_compact(flagged)


def windows(docs: DataFrame, size: int = LINES) -> DataFrame:
    """One row per window: the document's key and hash, the window's number there, two hashes."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(
        F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\r\x0b\x0c"))), lambda line: line != ""
    )
    parts = [
        F.slice(lines, F.lit(j + 1), F.greatest(F.size(lines) - size + 1, F.lit(0))).alias(f"l{j}") for j in range(size)
    ]
    return docs.select(
        order_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.xxhash64(text).alias("body"),
        F.posexplode(F.arrays_zip(*parts)).alias("at", "w"),
    ).select("key", "body", "at", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), F.col("w")).alias("h2"))


def removed_windows(docs: DataFrame, size: int = LINES) -> DataFrame:
    """Windows that are later occurrences: key, body and number of the window."""
    found = staged(windows(docs, size), "line-windows")
    repeated = staged(
        found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1"),
        "line-repeats",
    )
    met = found.join(repeated, ["h1", "h2"])
    # Later in another document at once; within the first document all but the first there.
    later = met.where("key > first").select("key", "body", "at")
    own = met.where("key = first").select("key", "body", "h1", "h2", "at")
    heads = own.groupBy("key", "body", "h1", "h2").agg(F.min("at").alias("head"))
    inside = own.join(heads, ["key", "body", "h1", "h2"]).where("at > head").select("key", "body", "at")
    return later.unionByName(inside)


def _firsts_and_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows but for those that repeat an id and its text, or a text without an id; and these."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumns({"__key": order_key(F.col("doc_id"), F.col("text")), "__body": F.xxhash64(text)})
    pair = ["__key", "__body"]
    again = staged(keyed.groupBy(pair).count().where("count > 1").select(pair), "line-copies")
    if again.isEmpty():
        return docs, None
    # Numbers of rows are written with them, so they stay what they are.
    many = staged(
        keyed.join(again, pair, "left_semi").withColumn("__row", F.monotonically_increasing_id()), "line-rows"
    )
    told = many.join(many.groupBy(pair).agg(F.min("__row").alias("__head")), pair)
    names = [quoted(c) for c in docs.columns]
    single = keyed.join(again, pair, "left_anti").select(names)
    return single.unionByName(told.where("__row = __head").select(names)), told.where("__row > __head").select(names)


def _blank_lines(docs: DataFrame, size: int) -> DataFrame:
    """Copies: every line of a window goes."""
    lines = F.split("text", "\n")
    blank = F.filter(lines, lambda line: F.btrim(line, F.lit(" \t\r\x0b\x0c")) == "")
    cut = F.size(lines) - F.size(blank) >= size
    text = F.when(cut, F.array_join(blank, "\n")).otherwise(F.col("text"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        docs = docs.withColumn("n_chars", F.when(cut, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    return docs.withColumn("text", text)


def deduplicate_lines(docs: DataFrame, size: int = LINES) -> DataFrame:
    """Documents without the lines that later occurrences of repeated windows cover.

    Every row is kept, with all its columns; ``text`` loses the covered lines, other lines
    and blank ones stay; ``n_chars``, if present, is counted anew where lines went. Texts
    of fewer than ``size`` lines that are not blank have no window. Rows with a null id are
    ordered after all others by a hash of their text. Of rows that repeat an id with its text,
    or a text without an id, one stays whole and the others lose all lines of their windows.
    Rows with one doc_id and different texts count as one document, so that they share their
    first occurrences. Null and empty texts stay. Extra columns may have any name but those
    beginning with two underscores.
    """
    firsts, copies = _firsts_and_copies(docs)
    out = _without_later_windows(firsts, size)
    return out if copies is None else out.unionByName(_blank_lines(copies, size))


def _without_later_windows(docs: DataFrame, size: int) -> DataFrame:
    covered = (
        removed_windows(docs, size)
        .groupBy("key", "body")
        .agg(F.collect_set("at").alias("__ats"))  # at most one entry per line of the document
        .select(F.col("key").alias("__k"), F.col("body").alias("__b"), "__ats")
    )
    key, body = order_key(F.col("doc_id"), F.col("text")), F.xxhash64(F.coalesce("text", F.lit("")))
    joined = docs.withColumns({"__key": key, "__body": body}).join(
        covered, (F.col("__key") == F.col("__k")) & (F.col("__body") == F.col("__b")), "left"
    )
    lines = F.split("text", "\n")
    # Window k covers the k-th line that is not blank and the next ones.
    spans = F.array_distinct(
        F.flatten(F.transform("__ats", lambda a: F.sequence(a, a + (size - 1))))
    )
    cut = joined.withColumns({"__lines": lines, "__numbers": _numbered(lines), "__spans": spans})
    cut = cut.withColumn("__gone", F.transform("__spans", lambda k: F.get(F.col("__numbers"), k)))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    shorter = F.array_join(F.transform(stays, lambda i: F.get(F.col("__lines"), i)), "\n")
    changed = {"text": F.when(F.col("__ats").isNull(), F.col("text")).otherwise(shorter)}
    out = cut.withColumns(changed)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn(
            "n_chars", F.when(F.col("__ats").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        )
    return out.select(*map(quoted, docs.columns))

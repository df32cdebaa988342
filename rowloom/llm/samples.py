"""Bounded samples of labelled documents, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, where: Column | None = None):
    """Up to ``max_rows`` labelled documents, at most half of them of one label while both last.

    Rows are drawn in hash order of doc_id, so the sample does not depend on storage. Labels
    other than 0 and 1, null ids and conflicting labels of one id are left out; of documents
    that repeat an id the one of least text hash is taken, so ids are unique in the sample.
    Returns doc_id, label as int and text.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("__label"))
        .where(F.col("doc_id").isNotNull() & F.col("__label").isin(0, 1))
        .where(F.lit(True) if where is None else where)
        .groupBy("doc_id")
        .agg(F.min("__label").alias("__label"), F.max("__label").alias("__other"))
        .where("__label = __other")
        .drop("__other")
    )
    drawn = [
        row
        for value in (0, 1)
        for row in known.where(F.col("__label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).collect()
    ]
    zeros = [r for r in drawn if r["__label"] == 0]
    ones = [r for r in drawn if r["__label"] == 1]
    half = max_rows // 2
    zeros, ones = zeros[: max(half, max_rows - len(ones))], ones[: max(half, max_rows - len(zeros))]
    spark = docs.sparkSession
    chosen = spark.createDataFrame([tuple(r) for r in zeros + ones], "doc_id long, label int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The chosen ids are at most max_rows numbers. Tasks cut the rows of an id down to its least
    # hash and then to one text before they are shuffled, so a repeated id fills no task.
    held = texts.join(F.broadcast(chosen), "doc_id").withColumn("__hash", F.xxhash64("text"))
    least = held.groupBy("doc_id").agg(F.min("__hash").alias("__hash"))
    one = held.join(F.broadcast(least), ["doc_id", "__hash"])
    return one.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

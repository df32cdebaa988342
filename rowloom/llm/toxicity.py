"""Toxicity: a cumulative-link ordinal regression on sparse word features.

Labels say toxic or not; how severe a toxic text is follows from how many strongly toxic
words it holds (grades 1 to 3; grade 0 is not toxic). One weight per word is shared by all
grades; ordered thresholds part them: P(grade > k) = sigmoid(w . x - threshold_k). A text's
severity is its expected grade, the sum of these probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import bound_batches
from rowloom.llm.common import quoted, unused
from rowloom.llm.samples import labelled_sample

GRADES = 3
# Toxic words from which a toxic text has grade 2 and grade 3.
GRADE_STEPS = (3, 6)
MAX_ROWS = 12_000
MAX_WORDS = 4096
MIN_DOCS = 3
REJECT = 0.5
# Letters and the marks that combine with them.
WORD = regex.compile(r"[\p{L}\p{M}]+")
_SCORES = "struct<severity: double, grade: int, p1: double, p2: double, p3: double>"
# Texts whose words are counted at a time, so that a batch isn't held as Python strings.
SLICE_ROWS = 64


def text_words(text: str | None) -> Counter:
    """Counts of lower-case words; null has none."""
    return Counter(WORD.findall((text or "").lower()))


def features(counts: Counter, index: dict[str, int]) -> tuple[list[int], list[float]]:
    """Numbers and values of the known words of a text: 1 + ln(occurrences)."""
    at = [w for w in counts if w in index]
    return [index[w] for w in at], [1.0 + float(np.log(counts[w])) for w in at]


@dataclass(frozen=True)
class Severity:
    """A fitted model: weights per word and ordered thresholds."""

    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, text: str | None) -> np.ndarray:
        """P(grade > k) for k = 0 .. GRADES - 1."""
        at, values = features(text_words(text), self.index)
        z = float(np.dot(self.weights[at], values)) if at else 0.0
        return 1.0 / (1.0 + np.exp(-np.clip(z - self.thresholds, -500, 500)))


def select_words(sample: DataFrame, max_words: int = MAX_WORDS, min_docs: int = MIN_DOCS):
    """Words whose share of toxic and of other texts differs most, with their log odds.

    Counts are sums over the sample by Spark; at most ``max_words`` rows reach the driver.
    """
    totals = sample.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in totals}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return {}
    counts = (
        sample.mapInArrow(_distinct_words, "label int, word string")
        .groupBy("word")
        .agg(F.sum("label").alias("d1"), F.count("*").alias("d"))
        .where(F.col("d") >= min_docs)
    )
    d1, d0 = F.col("d1"), F.col("d") - F.col("d1")
    odds = F.log((d1 + 0.5) / (n1 - d1 + 0.5)) - F.log((d0 + 0.5) / (n0 - d0 + 0.5))
    spread = F.sqrt(1 / (d1 + 0.5) + 1 / (n1 - d1 + 0.5) + 1 / (d0 + 0.5) + 1 / (n0 - d0 + 0.5))
    ranked = counts.select("word", odds.alias("odds"), (odds / spread).alias("z"))
    best = ranked.where("abs(z) > 2").orderBy(F.abs("z").desc(), "word").limit(max_words).collect()
    return {r["word"]: (r["odds"], r["z"]) for r in best}


def _distinct_words(batches):
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text"), strict=True):
            words = list(text_words(text.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(words), pa.int32()), pa.array(words, pa.string())], names=["label", "word"]
            )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = 300, seed: int = 5) -> Severity:
    """Fit on at most ``max_rows`` labelled texts; only their known words reach the driver.

    Without labels of both kinds the model has no words and finds nothing toxic.
    """
    sample = labelled_sample(docs, labels, "toxic", max_rows).persist()
    try:
        chosen = select_words(sample)
        index = {w: i for i, w in enumerate(chosen)}
        toxic = {w for w, (odds, z) in chosen.items() if odds > 3 and z > 4}
        rows = sample.mapInArrow(lambda batches: _vectors(batches, index, toxic), "label int, hits int, at array<int>, x array<double>").collect()
    finally:
        sample.unpersist()
    if not index:
        return Severity({}, np.zeros(0), np.array([10.0, 20.0, 30.0]))
    grade = np.array([r["label"] * (1 + sum(r["hits"] >= s for s in GRADE_STEPS)) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows])
    at = np.array([i for r in rows for i in r["at"]], np.int64)
    x = np.array([v for r in rows for v in r["x"]])
    weights, thresholds = _descend(grade, row, at, x, len(index), epochs)
    return Severity(index, weights, thresholds)


def _vectors(batches, index, toxic):
    for batch in batches:
        rows = []
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts = text_words(text)
            at, x = features(counts, index)
            rows.append({"label": label, "hits": sum(counts[w] for w in toxic if w in counts), "at": at, "x": x})
        yield pa.RecordBatch.from_pylist(
            rows,
            schema=pa.schema(
                [("label", pa.int32()), ("hits", pa.int32()), ("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))]
            ),
        )


def _descend(grade, row, at, x, words: int, epochs: int, penalty: float = 2e-4, rate: float = 0.05):
    """Adam on the mean cumulative logistic loss, classes weighted evenly; thresholds stay ordered."""
    n = len(grade)
    goal = (grade[:, None] > np.arange(GRADES)).astype(float)
    share = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    # thresholds are the first one plus positive steps
    theta = np.concatenate([np.zeros(words), [1.0], np.zeros(GRADES - 1)])
    first = second = np.zeros_like(theta)
    for step in range(1, epochs + 1):
        steps = np.exp(theta[words + 1 :])
        bounds = theta[words] + np.append(0.0, np.cumsum(steps))
        z = np.bincount(row, weights=x * theta[at], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - bounds, -50, 50)))
        error = (p - goal) * share[:, None]
        slope = np.bincount(at, weights=x * error.sum(axis=1)[row], minlength=words)
        bound = -error.sum(axis=0)
        tail = np.cumsum(bound[::-1])[::-1]
        gradient = np.concatenate([slope + penalty * theta[:words], [tail[0]], tail[1:] * steps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:words], theta[words] + np.append(0.0, np.cumsum(np.exp(theta[words + 1 :])))


def _scores(docs: DataFrame, model: Severity) -> Column:
    """A struct of scores of the column ``text``, which alone is sent to Python."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_WORDS words

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            above = np.zeros((len(texts), GRADES))
            for low in range(0, len(texts), SLICE_ROWS):
                for row, text in enumerate(texts.slice(low, SLICE_ROWS)):
                    above[low + row] = shared.value.above(text.as_py())
            mass = np.hstack([np.ones((len(above), 1)), above]) - np.hstack([above, np.zeros((len(above), 1))])
            values = [above.sum(axis=1), mass.argmax(axis=1).astype(np.int32), *above.T]
            yield pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(v)) for v in values], names=["severity", "grade", "p1", "p2", "p3"]
            )

    return F.arrow_udf(run, _SCORES)(F.col("text").cast("string"))


def score(docs: DataFrame, model: Severity) -> DataFrame:
    """Documents with severity (0 to 3), the likeliest grade and P(grade >= 1, 2, 3).

    Whole texts are read. Null and empty texts hold no words and score as such. All columns
    are kept but those whose names the scores take: severity, grade, p1, p2 and p3.
    """
    kept = docs.drop("severity", "grade", "p1", "p2", "p3")
    found = unused(kept, "scores")
    return kept.withColumn(found, _scores(kept, model)).select(*map(quoted, kept.columns), f"`{found}`.*")


def reject(docs: DataFrame, labels: DataFrame, above: float = REJECT, **options) -> DataFrame:
    """Documents whose expected severity stays below ``above``.

    Their columns are unchanged, those named like scores too; null and empty texts, null ids
    and repeated rows are judged by their words like others; an empty table gives no rows.
    """
    found = unused(docs, "scores")
    scored = docs.withColumn(found, _scores(docs, fit(docs, labels, **options)))
    return scored.where(F.col(quoted(found))["severity"] < above).select(*map(quoted, docs.columns))

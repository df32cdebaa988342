"""Periodic runs of words: a suffix automaton whose link tree is accessed word by word.

The states on the way from a prefix's state to the root, along suffix links, stand for the
suffixes of that prefix. Each appended word gives that whole way the colour of its own
position. The colours it replaces lie on it in segments: a segment of colour j whose deepest
state has length L says that the last L words recur with their latest end at j. If the
distance p = i - j is at most L, the text holds a square of period p there; L + p words that
end at i have period p, and no more to the left. The same start and period at the following
ends extend it to a run. Link-cut access keeps segments in splay trees, so an appended word
costs a logarithmic number of steps on average.

The automaton is asked only where a run can lie: a run of r periods repeats every gram of
its later periods at the distance of one period, without a gap. Stretches of consecutive
repeated grams that are too short for their least distance hold no run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import map_batches, split_words, steps

LEAST_WORDS = 24
LEAST_PERIODS = 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class SuffixAutomaton:
    """States of all substrings of a sequence: suffix links, lengths, and the state of each prefix."""

    def __init__(self, words: list[int]):
        follow: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        self.prefix: list[int] = []
        last = 0
        for word in words:
            new = len(link)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and word not in follow[at]:
                follow[at][word] = new
                at = link[at]
            if at >= 0:
                to = follow[at][word]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    copy = len(link)
                    follow.append(follow[to].copy())
                    length.append(length[at] + 1)
                    link.append(link[to])
                    while at >= 0 and follow[at].get(word) == to:
                        follow[at][word] = copy
                        at = link[at]
                    link[to] = link[new] = copy
            last = new
            self.prefix.append(last)
        self.link, self.length = link, length


class LastOccurrences:
    """Colours of the link tree by link-cut access: the latest end of each state's substrings.

    A preferred path has one colour, kept at the root of its splay tree, which orders states
    by depth. State 0, the empty word, stands for no node.
    """

    def __init__(self, automaton: SuffixAutomaton):
        size = len(automaton.link)
        self.length = automaton.length
        self.up = [max(k, 0) for k in automaton.link]
        self.left, self.right, self.colour = [0] * size, [0] * size, [-1] * size

    def _rotate(self, node: int) -> None:
        up, left, right = self.up, self.left, self.right
        mid = up[node]
        top = up[mid]
        if left[top] == mid and top:
            left[top] = node
        elif right[top] == mid and top:
            right[top] = node
        up[node] = top
        if left[mid] == node:
            inner = right[node]
            left[mid], right[node] = inner, mid
        else:
            inner = left[node]
            right[mid], left[node] = inner, mid
        if inner:
            up[inner] = mid
        up[mid] = node

    def _splay(self, node: int) -> int:
        """Bring a state to the root of its splay tree; returns the path's colour."""
        up, left, right, rotate = self.up, self.left, self.right, self._rotate
        root = node
        while (top := up[root]) and (left[top] == root or right[top] == root):
            root = top
        colour = self.colour[root]
        while (mid := up[node]) and (left[mid] == node or right[mid] == node):
            top = up[mid]
            if top and left[top] == mid:
                rotate(mid if left[mid] == node else node)
            elif top and right[top] == mid:
                rotate(mid if right[mid] == node else node)
            rotate(node)
        return colour

    def append(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolour the way from a state to the root; returns (latest end, length) of its old segments."""
        up, right, colour, length = self.up, self.right, self.colour, self.length
        found = []
        below = 0
        while state:
            old = self._splay(state)
            if old >= 0:
                found.append((old, length[state]))
            if right[state]:
                colour[right[state]] = old
            right[state] = below
            below = state
            state = up[state]
        if below:
            colour[below] = end
        return found


def runs_of(words: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """start, length and smallest period of the maximal runs, by start and period."""
    automaton = SuffixAutomaton(words)
    occurrences = LastOccurrences(automaton)
    ends: dict[tuple[int, int], int] = {}
    for end, state in enumerate(automaton.prefix):
        for before, length in occurrences.append(state, end):
            period = end - before
            if length >= (periods - 1) * period:
                ends[end - length - period + 1, period] = end
    runs = ((start, end - start + 1, period) for (start, period), end in ends.items())
    return sorted((s, n, p) for s, n, p in runs if n >= max(least, periods * p))


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """64-bit hashes of numbers; sums of products wrap around."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` words (a power of two) from each place on; the last places have none."""
    found, factor, width = _mixed(codes), 0x2545F4914F6CDD1D, 1
    while width < gram and len(found) > width:
        found = found[:-width] * np.uint64(factor) + found[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    return found if width == gram else found[:0]


def _latest_before(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash stands at an earlier place, and the distance to the latest one."""
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = np.zeros(1 << 20, bool)
    marked[twice >> np.uint64(44)] = True
    maybe = np.flatnonzero(marked[hashes >> np.uint64(44)])
    order = maybe[np.argsort(hashes[maybe], kind="stable")]
    same = hashes[order[1:]] == hashes[order[:-1]]
    places, before = order[1:][same], order[:-1][same]
    rank = np.argsort(places)
    return places[rank], (places - before)[rank]


def _breaks(places: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a place is the first of a stretch of consecutive places of one text."""
    return np.append(True, (np.diff(places) != 1) | (np.diff(text[places]) != 0))


def windows(codes: np.ndarray, ends: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS):
    """Disjoint (text, start, end) in word places that hold every run of every text."""
    gram = 1 << ((least - least // periods).bit_length() - 1)
    hashes = _gram_hashes(codes, gram)
    if not len(hashes):
        return []
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    whole = text[: len(hashes)] == text[gram - 1 : gram - 1 + len(hashes)]
    at = np.flatnonzero(whole)
    # Equal grams of different texts are told apart; a place outside a text has no gram.
    picked, distance = _latest_before(hashes[at] ^ _mixed(text[at] + len(codes)))
    places = at[picked]
    distance = places - at[picked - distance]
    while len(places):
        number = np.cumsum(_breaks(places, text)) - 1
        most = (np.bincount(number)[number] + gram - 1) // (periods - 1)
        stays = distance <= most
        if stays.all():
            break
        places, distance = places[stays], distance[stays]
    if not len(places):
        return []
    first = np.flatnonzero(_breaks(places, text))
    last = np.append(first[1:], len(places)) - 1
    spans = []
    for a, b in zip(places[first].tolist(), places[last].tolist(), strict=True):
        mine = int(text[a])
        spans.append((mine, max(int(ends[mine]), a - (b - a + gram) // (periods - 1)), b + gram))
    return _merged(spans)


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap joined; a long stretch's span may reach back over several before it."""
    out: list[tuple[int, int, int]] = []
    for mine, low, high in spans:
        while out and out[-1][0] == mine and low <= out[-1][2]:
            _, before, after = out.pop()
            low, high = min(low, before), max(high, after)
        out.append((mine, low, high))
    return out


def _collapse(batches, least: int, periods: int):
    for batch in batches:
        ids = batch.column("doc_id")
        for row, texts in steps(batch.column("text")):
            distinct, codes, ends = split_words(texts)
            runs: list[list[dict]] = [[] for _ in range(len(texts))]
            kept = np.ones(len(codes), bool)
            for mine, low, high in windows(codes, ends, least, periods):
                for start, length, period in runs_of(codes[low:high].tolist(), least, periods):
                    kept[low + start + period : low + start + length] = False
                    runs[mine].append({"start": low + start - int(ends[mine]), "length": length, "period": period})
            left = np.append(0, np.cumsum(kept))[ends]
            words = distinct.take(pa.array(codes[kept]))
            lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, len(texts)), pa.array(runs, pa.list_(_RUN)), pc.binary_join(lists, " ")],
                names=["doc_id", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """The periodic runs of each text, and the text without the repetitions.

    A run is a stretch of consecutive words with smallest period q, of at least ``periods``
    periods and ``least`` words, that no neighbouring word extends. Returns doc_id, runs (an
    array of start, length and period in words, by start and period) and collapsed: the words
    that no run covers after its first period, joined by one space. A null or empty text has
    no runs and collapses to the empty text. Each row is judged by itself, repeated ids and
    null ids too; other columns are ignored; an empty table gives no rows.
    """
    if periods < 2 or least < periods:
        raise ValueError("a run has two periods at least, and a word in each")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, lambda batches: _collapse(batches, least, periods), _SCHEMA)


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the text of each tenth id by hash repeats a stretch of its words to its end.

    With h the crc32 of the decimal id and g = h div 10, texts with h % 10 = 0 repeat from word
    a = g % n on with period 1 + (n - a) div (3 + g % 8). Other texts, and those of null ids, stay.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    held = part.withColumns({"__h": crc, "__words": F.when(F.coalesce(crc % 10 == 0, F.lit(False)), words)})
    n, g = F.size("__words"), F.expr("__h div 10")
    start = g % n
    period = 1 + F.expr("div(size(__words) - __h div 10 % size(__words), 3 + __h div 10 % 8)")
    held = held.withColumns({"__a": F.when(n > 0, start), "__p": F.when(n > 0, period)})

    def word(one: Column, at: Column) -> Column:
        back = (F.col("__a") + (at - F.col("__a")) % F.col("__p")).cast("int")
        return F.when(at < F.col("__a"), one).otherwise(F.get("__words", back))

    text = F.when(F.col("__p").isNotNull(), F.array_join(F.transform("__words", word), " ")).otherwise(F.col("text"))
    return held.select("doc_id", text.alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run of greatest exact length / period, and hashes of all runs and of the collapsed text."""

    def better(best: Column, one: Column) -> Column:
        over = one["length"] * best["period"] - best["length"] * one["period"]
        first = (one["start"] < best["start"]) | ((one["start"] == best["start"]) & (one["period"] < best["period"]))
        return F.when(best.isNull() | (over > 0) | ((over == 0) & first), one).otherwise(best)

    nothing = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", nothing, better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("__best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("__best.start").alias("start"),
        F.col("__best.length").alias("length"),
        F.col("__best.period").alias("period"),
        F.expr("(1000 * __best.length) div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

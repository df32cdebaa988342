"""Byte-level BPE by tree reduction: halves are encoded alone and joined at their boundary.

A sequence of tokens is the encoding of its bytes if and only if each two neighbours are the
encoding of theirs. So a join re-encodes a window around the boundary, and is done when the
window's outer tokens agree with the tokens next to them: nothing outside can change. Until
then the window grows on the side that disagrees. Decoding concatenates pairwise up the tree.

A text is cut into matches of the tokenizer's pattern first, which never merge. Each worker
keeps the encodings of the matches that it met lately.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import Recent, map_batches, steps, strings

# Bytes that are merged at once at the bottom of the tree.
LEAF_BYTES = 16
# Tokens concatenated at once when decoding.
LEAF_TOKENS = 2048
# Merges of longer byte strings use a heap.
SCAN_BYTES = 32
# Matches kept by a worker in each of two generations.
CACHED = 150_000
# Characters encoded in one step.
STEP_CHARS = 2_000_000
# White space other than single spaces and one or two line breaks between words.
_IRREGULAR = (
    r"  | \n|\n |\n\n\n|^[ \n]|[ \n]\z|[\t\x0B-\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# A run of letters with or without a space before and ASCII marks after: two matches at most.
_LETTERS_AND_MARKS = r"^(?P<letters> ?\p{L}+)(?P<marks>[!-/:-@\[-`{-~]*)$"
# Above every rank.
_NEVER = 1 << 60


class BytePairs:
    """Encodes byte strings by merge ranks, which are the token ids; decodes ids."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF_BYTES):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a rank")
        self._ranks, self._leaf = ranks, max(1, leaf)
        self._bytes = {rank: token for token, rank in ranks.items()}
        # Every pair of tokens that makes a token, in order, and what it makes.
        pairs = [
            (self._ranks[token[:cut]] << 32 | self._ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        keys, makes = np.array(pairs, np.int64).reshape(-1, 2).T
        bits = max(4, (4 * len(keys)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._keys, self._makes = np.full(1 << bits, -1), np.full(1 << bits, _NEVER)
        slot = self._slot(keys)
        while len(keys):  # the first key of a slot takes it if it is free, others try the next one
            one = np.unique(slot, return_index=True)[1]
            free = one[self._keys[slot[one]] < 0]
            self._keys[slot[free]], self._makes[slot[free]] = keys[free], makes[free]
            left = np.ones(len(keys), bool)
            left[free] = False
            keys, makes, slot = keys[left], makes[left], (slot[left] + 1) % len(self._keys)
        self._single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    @classmethod
    def from_file(cls, path: str) -> BytePairs:
        """Ranks of a file of lines with a token in base 64 and its rank."""
        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in lines})

    def _merge(self, data: bytes) -> list[int]:
        """Merge the pair of least rank, the leftmost first, until no pair has one."""
        if len(data) > SCAN_BYTES:
            return self._merge_long(data)
        rank_of = self._ranks.get
        cuts = list(range(len(data) + 1))
        ranks = [rank_of(data[at : at + 2], _NEVER) for at in range(len(data) - 1)]
        while ranks and (least := min(ranks)) != _NEVER:
            at = ranks.index(least)
            del cuts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(data[cuts[at] : cuts[at + 2]], _NEVER)
            if at:
                ranks[at - 1] = rank_of(data[cuts[at - 1] : cuts[at + 1]], _NEVER)
        return [self._ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with the pairs in a heap."""
        ranks, n = self._ranks, len(data)
        ends = list(range(1, n + 1))  # of the token that starts at a place
        before = list(range(-1, n - 1))
        alive = [True] * n
        pairs = [(rank, at, at + 2) for at in range(n - 1) if (rank := ranks.get(data[at : at + 2])) is not None]
        heapify(pairs)
        while pairs:
            _, at, end = heappop(pairs)
            mid = ends[at]
            if not alive[at] or mid >= n or ends[mid] != end or mid == end:
                continue
            alive[mid] = False
            ends[at] = end
            if end < n:
                before[end] = at
                if (rank := ranks.get(data[at : ends[end]])) is not None:
                    heappush(pairs, (rank, at, ends[end]))
            if (prior := before[at]) >= 0 and (rank := ranks.get(data[prior:end])) is not None:
                heappush(pairs, (rank, prior, end))
        return [ranks[data[at : ends[at]]] for at in range(n) if alive[at]]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _made(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """What each pair of tokens makes; a high number for nothing."""
        key = (first << 32 | second).ravel()
        slot = self._slot(key)
        held = self._keys[slot]
        made = np.where(held == key, self._makes[slot], _NEVER)
        rest = np.flatnonzero((held != key) & (held >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) % len(self._keys)
            held = self._keys[slot[rest]]
            hit = held == key[rest]
            made[rest[hit]] = self._makes[slot[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        return made.reshape(first.shape)

    def merge_leaves(self, leaves: list[bytes]) -> list[bytes]:
        """Encodings of many short byte strings, merged side by side, as 32-bit numbers."""
        size = np.array([len(leaf) for leaf in leaves])
        wide = int(size.max(initial=0))
        if not wide:
            return [b""] * len(leaves)
        data = b"".join(leaf.ljust(wide, b"\0") for leaf in leaves)
        tokens = np.zeros((len(leaves), wide + 1), np.int64)
        tokens[:, :wide] = self._single[np.frombuffer(data, np.uint8)].reshape(-1, wide)
        place = np.arange(wide + 1)
        alive = place < size[:, None]
        after = np.broadcast_to(place + 1, tokens.shape).copy()
        before = np.broadcast_to(place - 1, tokens.shape).copy()
        ranks = np.full(tokens.shape, _NEVER)
        ranks[:, :wide] = self._made(tokens[:, :wide], tokens[:, 1:])
        ranks[place + 1 >= size[:, None]] = _NEVER
        rows = np.arange(len(leaves))
        while len(rows):
            at = ranks[rows].argmin(axis=1)
            made = ranks[rows, at]
            go = made < _NEVER
            rows, at, made = rows[go], at[go], made[go]
            gone = after[rows, at]
            end = after[rows, gone]
            tokens[rows, at], after[rows, at], alive[rows, gone] = made, end, False
            ranks[rows, gone] = _NEVER
            more = end < size[rows]
            before[rows[more], end[more]] = at[more]
            end = np.minimum(end, wide)
            ranks[rows, at] = np.where(more, self._made(made, tokens[rows, end]), _NEVER)
            prior = before[rows, at]
            held = prior >= 0
            r, p = rows[held], prior[held]
            ranks[r, p] = self._made(tokens[r, p], made[held])
        flat = tokens[alive].astype("<i4").tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """``encode`` of many pieces, with all their leaves merged side by side."""
        whole = [self._ranks.get(piece) for piece in pieces]
        parts = [[] if rank is not None else self._leaves(piece) for piece, rank in zip(pieces, whole, strict=True)]
        leaves = list({leaf for part in parts for leaf in part})
        coded = dict(zip(leaves, self.merge_leaves(leaves), strict=True)) if leaves else {}
        out = []
        for piece, rank, part in zip(pieces, whole, parts, strict=True):
            if rank is not None:
                out.append(array("i", [rank]).tobytes())
            elif len(part) <= 1:
                out.append(coded[piece])
            else:
                out.append(array("i", self.tree(piece, coded)).tobytes())
        return out

    def _leaves(self, data: bytes) -> list[bytes]:
        """The byte strings at the bottom of the tree, in order."""
        if len(data) <= self._leaf:
            return [data]
        mid = len(data) // 2
        return self._leaves(data[:mid]) + self._leaves(data[mid:])

    def _agree(self, one: int, two: int) -> bool:
        """Whether two tokens in a row are the encoding of their bytes."""
        return self._merge(self._bytes[one] + self._bytes[two]) == [one, two]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings in a row."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            window = self._merge(self.decode(left[len(left) - i :] + right[:j]))
            fits_left = i == len(left) or self._agree(left[-i - 1], window[0])
            fits_right = j == len(right) or self._agree(window[-1], right[j])
            if fits_left and fits_right:
                return left[: len(left) - i] + window + right[j:]
            if not fits_left:
                i = min(2 * i, len(left))
            if not fits_right:
                j = min(2 * j, len(right))

    def tree(self, data: bytes, leaves: dict[bytes, bytes] | None = None) -> list[int]:
        """Encode halves and join them; leaves are merged at once, or looked up."""
        if len(data) <= self._leaf:
            return np.frombuffer(leaves[data], "<i4").tolist() if leaves else self._merge(data)
        mid = len(data) // 2
        return self.join(self.tree(data[:mid], leaves), self.tree(data[mid:], leaves))

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; one that is a token itself is that token."""
        whole = self._ranks.get(piece)
        return self.tree(piece) if whole is None else [whole]

    def decode(self, ids) -> bytes:
        """Bytes of ids, concatenated up a tree of halves."""
        if len(ids) <= LEAF_TOKENS:
            return b"".join(map(self._bytes.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """One coder per Python worker and file."""
    return BytePairs.from_file(path)


class TextCoder:
    """Ids of whole texts by the matches of a pattern.

    Where all white space of a text is single spaces and one or two line breaks between words,
    matches start at each space and are each line break: such texts are cut into words, each
    with the space before it, and only distinct words are matched.
    """

    def __init__(self, pairs: BytePairs, pattern: str):
        self._pairs, self._matches = pairs, regex.compile(pattern).findall
        self._known = Recent(CACHED)
        found = [self._matches(sample) for sample in ("a\nb", "a\n\nb", "a b", "a, b")]
        self._regular = found == [["a", "\n", "b"], ["a", "\n", "\n", "b"], ["a", " b"], ["a", ",", " b"]]
        self._simple = self._regular and self._matches(" ab,;'") == [" ab", ",;'"]

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """Words or matches of each text."""
        mark = next(c for c in map(chr, range(0xE000, 0xF8FF)) if not pc.any(pc.match_substring(texts, c)).as_py())
        odd = pc.match_substring_regex(texts, _IRREGULAR)
        spaced = pc.replace_substring(texts, " ", mark + " ")
        lined = pc.replace_substring(pc.replace_substring(spaced, "\n", f"{mark}\n{mark}"), mark * 2, mark)
        rows = np.arange(len(texts)) if not self._regular else np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(rows):
            joined = [mark.join(self._matches(text)) for text in strings(texts.take(pa.array(rows)))]
            where = np.zeros(len(texts), bool)
            where[rows] = True
            lined = pc.replace_with_mask(lined, pa.array(where), pa.array(joined, lined.type))
        return pc.split_pattern(lined, mark)

    def _lookup(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are one match each."""
        fresh = self._known.missing(pieces)
        self._known.values.update(zip(fresh, self._pairs.encode_many([p.encode() for p in fresh]), strict=True))
        return list(map(self._known.values.__getitem__, pieces))

    def _word_ids(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of pieces, and the two pieces whose ids are those of each word."""
        parts = pc.extract_regex(words, _LETTERS_AND_MARKS)
        plain = parts.is_valid().to_numpy(zero_copy_only=False) & self._simple
        at, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        taken = parts.take(pa.array(at))
        pair = np.zeros((len(words), 2), np.int64)
        pieces: list[str] = [""]
        for side in range(2):
            coded = taken.field(side).dictionary_encode()
            pair[at, side] = coded.indices.to_numpy(zero_copy_only=False) + len(pieces)
            pieces += strings(coded.dictionary)
        split = [self._matches(word) for word in strings(words.take(pa.array(other)))]
        ids = self._lookup(pieces + [piece for part in split for piece in part])
        done, base = ids[: len(pieces)], len(pieces)
        for row, part in zip(other.tolist(), split, strict=True):
            pair[row, 0] = len(done)
            done.append(b"".join(ids[base : base + len(part)]))
            base += len(part)
        return done, pair

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start and end."""
        cut = self._cut(texts)
        coded = cut.flatten().dictionary_encode()
        pieces, pair = self._word_ids(coded.dictionary)
        table = np.frombuffer(b"".join(pieces), "<i4")
        lengths = np.fromiter((len(p) // 4 for p in pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths) - lengths
        used = pair[coded.indices.to_numpy(zero_copy_only=False)].ravel()
        take = lengths[used]
        before = np.append(0, np.cumsum(take))
        ids = table[np.repeat(starts[used] - before[:-1], take) + np.arange(before[-1])]
        words = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False)))
        return ids, before[2 * words]


@lru_cache(maxsize=2)
def text_coder(path: str, pattern: str) -> TextCoder:
    """One coder per Python worker, file and pattern."""
    return TextCoder(byte_pairs(path), pattern)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of each whole text.

    ``ranks`` is a file of merge ranks on every machine, ``pattern`` cuts a text into pieces
    that are encoded apart; text between matches has no ids. A null or empty text has none;
    repeated and null ids are rows of their own; other columns are ignored; an empty table
    gives no rows.
    """

    def run(batches):
        coder = text_coder(ranks, pattern)
        for batch in batches:
            for row, texts in steps(batch.column("text"), STEP_CHARS):
                ids, ends = coder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                names = batch.column("doc_id").slice(row, len(texts))
                yield pa.RecordBatch.from_arrays([names, lists], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and the bytes they stand for (decoded); null ids stand for none."""

    def run(batches):
        coder = byte_pairs(ranks)
        for batch in batches:
            lists = batch.column("ids")
            ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()))
            flat = lists.flatten().to_numpy().tolist()
            texts = [coder.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            arrays = [batch.column("doc_id"), lists, pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "decoded"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded binary")


def token_digest(decoded: DataFrame) -> DataFrame:
    """Number of ids, and hashes of the decimal ids joined by commas and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

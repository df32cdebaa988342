"""Token ids of whole texts by a public tokenizer file, fast enough for a corpus.

The tokenizer drops white space before it merges, so a text's ids are those of its
space-separated words in a row. Each task splits texts into distinct words and these into
stems and marks, asks the tokenizers library once per piece it has not met, and gathers the
ids by word number.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowloom.llm.batches import Recent, strings

# Stems and other words of one generation per Python worker: beyond, a new one starts and takes over
# from the one before what is met again, so that memory stays bounded.
CACHED_WORDS = 300_000
# Characters split at a time, to bound the memory of one step. Longer single texts form a step.
STEP_CHARS = 4_000_000
# A run of letters that needs no normalizing, and marks that never join one in the tokenizer's pattern.
_STEM_AND_MARKS = r"^(?P<stem>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+)(?P<marks>[.,!?;:]*)$"
# Fixed value: the tokenizer's pattern for text in lower-case ASCII.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+").findall


def _byte_letters() -> str:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(rest)) for b in range(256))


class WordTokenizer:
    """Ids of whole texts; holds the ids of stems and other words met lately, in two generations."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self._known = Recent(CACHED_WORDS)
        self._parts: dict[str, bytes] = {}

    def _merged(self, stems: Iterable[str]) -> Iterator[bytes]:
        """Ids of lower-case runs of Latin letters, which need no normalizing and no splitting."""
        tokenize, letters = self._model.tokenize, self._letters
        for stem in stems:
            if not stem.isascii():
                stem = charmap_decode(stem.encode(), "strict", letters)[0]
            yield array("I", [token.id for token in tokenize(stem)]).tobytes()

    def _word_ids(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of stems, marks and other words, and which two of them are the ids of each word.

        A run of Latin letters and the marks after it are apart in the tokenizer's pattern.
        """
        parts = pc.extract_regex(words, _STEM_AND_MARKS)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        at, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        taken = parts.take(pa.array(at))
        stems, marks = pc.utf8_lower(taken.field(0)).dictionary_encode(), taken.field(1).dictionary_encode()
        low = strings(stems.dictionary)
        rest = strings(marks.dictionary) + strings(words.take(pa.array(other)))
        fresh = self._known.missing(low)
        self._known.values.update(zip(fresh, self._merged(fresh), strict=True))
        pieces = list(map(self._known.values.__getitem__, low))
        fresh = self._known.missing(rest)
        self._known.values.update(zip(fresh, self._learn(fresh), strict=True))
        pieces += map(self._known.values.__getitem__, rest)
        pieces.append(b"")
        pair = np.full((len(words), 2), len(pieces) - 1)
        pair[at, 0] = stems.indices.to_numpy(zero_copy_only=False)
        pair[at, 1] = marks.indices.to_numpy(zero_copy_only=False) + len(low)
        pair[other, 0] = np.arange(len(rest) - len(other), len(rest)) + len(low)
        return pieces, pair

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words of other kinds: ASCII ones are cut by the tokenizer's pattern, and their parts looked up."""
        cut = [_PARTS(word.lower()) if word.isascii() and "<|" not in word else None for word in words]
        whole = [word for word, parts in zip(words, cut, strict=True) if parts is None]
        if len(self._parts) > CACHED_WORDS // 4:
            self._parts = {}
        fresh = list({part for parts in cut if parts for part in parts}.difference(self._parts))
        letters = [part for part in fresh if part.isalpha()]
        self._parts.update(zip(letters, self._merged(letters), strict=True))
        others = [part for part in fresh if not part.isalpha()]
        self._parts.update(zip(others, self._plain(others), strict=True))
        known, rest = self._parts.__getitem__, iter(self._plain(whole))
        return [next(rest) if parts is None else b"".join(map(known, parts)) for parts in cut]

    def _plain(self, words: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in encoded]

    def encode(self, texts: pa.Array, end_id: int | None = None):
        """Yield (first row, ids, offsets of rows in ids) for consecutive runs of rows."""
        texts = pc.fill_null(texts, "")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        row = 0
        while row < len(texts):
            done = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, done + STEP_CHARS, side="right")))
            yield (row, *self._step(texts.slice(row, stop - row), end_id))
            row = stop

    def _step(self, texts: pa.Array, end_id: int | None):
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        pieces, pair = self._word_ids(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False)
        counts = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)))
        if end_id is not None:  # a word of its own at each end of a text
            pieces.append(np.array([end_id], "<u4").tobytes())
            index = np.insert(index, counts[1:], len(pair))
            pair = np.append(pair, [[len(pieces) - 1, len(pieces) - 2]], axis=0)
            counts = counts + np.arange(len(counts))
        # Ids of distinct words in a row, then those of all words.
        table, ends = _gathered(np.frombuffer(b"".join(pieces), dtype="<u4"), _spans(pieces), pair.ravel())
        ends = ends[::2]
        ids, before = _gathered(table, ends, index)
        return ids, before[counts]


def _spans(pieces: list[bytes]) -> np.ndarray:
    """Where 32-bit numbers of each piece begin and end."""
    return np.append(0, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4))


def _gathered(table: np.ndarray, ends: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of a table that an index names, in a row, and where each begins and ends."""
    starts = ends[:-1][index]
    take = ends[1:][index] - starts
    before = np.append(0, np.cumsum(take))
    # Half as wide numbers where they hold all positions: most of the time goes into moving them.
    kind = np.int32 if max(before[-1], len(table)) < 1 << 31 else np.int64
    at = np.repeat((starts - before[:-1]).astype(kind), take)
    at += np.arange(before[-1], dtype=kind)
    return table[at], before


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker and file."""
    return WordTokenizer(path)

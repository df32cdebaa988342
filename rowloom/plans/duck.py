"""SQL text of the draw formula and the word dictionary, for the oracles."""

from __future__ import annotations

from rowloom.functions.draws import MASK, MULTIPLIER, NARROW_RANGE, constant
from rowloom.functions.keys import ROUNDS, round_key


def _mix(word: str) -> str:
    for _ in range(2):
        word = f"((xor({word} >> 16, {word}) * {MULTIPLIER}) & {MASK})"
    return f"xor({word} >> 16, {word})"


def with_draws(rows: str, key: str, seed: int) -> str:
    """A query that adds the draw state to the rows of another."""
    halves = f"SELECT *, {key} & {MASK} AS low, ({key} >> 32) & {MASK} AS high FROM ({rows})"
    mixed = ", ".join(f"{_mix(f'xor(low, {constant(seed, part)})')} AS mixed_{part}" for part in "ab")
    state = ", ".join(f"{_mix(f'xor(mixed_{part}, high)')} AS draw_{part}" for part in "ab")
    return f"SELECT *, {state} FROM (SELECT *, {mixed} FROM ({halves}))"


def _draw(label: str, index: object) -> str:
    return f"(({_mix(f'xor(draw_a, {constant(label, index)})')} + draw_b) & {MASK})"


def _wide(label: str, index: object) -> str:
    extra = _draw(label, f"{index}+")
    return f"({_draw(label, index)} * {NARROW_RANGE} + ({extra} & {NARROW_RANGE - 1}))"


def below(size: int, label: str, index: object = 0) -> str:
    """A draw in [0, size)."""
    return f"({(_wide if size > NARROW_RANGE else _draw)(label, index)} % {size})"


def with_keys(rows: str, key: str, domains: dict[str, int], seed: int) -> str:
    """A query that adds a permuted key, named by its label, for each number of bits."""
    names = [(f"{label}_high", f"{label}_low", bits - bits // 2, bits // 2) for label, bits in domains.items()]
    halves = ", ".join(f"{key} >> {low} AS {a}, {key} & {(1 << low) - 1} AS {b}" for a, b, _, low in names)
    query = f"SELECT *, {halves} FROM ({rows})"
    for turn in range(ROUNDS):
        changed = []
        for label, (high_name, low_name, high, low) in zip(domains, names):
            own, other, bits = (low_name, high_name, low) if turn % 2 else (high_name, low_name, high)
            word = _mix(f"xor({other}, {round_key(label, seed, turn)})")
            changed.append(f"xor({own}, ({word}) & {(1 << bits) - 1}) AS {own}")
        query = f"SELECT * REPLACE ({', '.join(changed)}) FROM ({query})"
    joined = ", ".join(f"({a} << {low}) | {b} AS {label}" for label, (a, b, _, low) in zip(domains, names))
    return f"SELECT *, {joined} FROM ({query})"


def key_text(label: str, length: int) -> str:
    return f"lower(to_base({label}, 32, {length}))"


def weighted(label: str, choices: dict[str, int], cutoffs: list[int], others: list[int]) -> str:
    """One of the texts of a map, by the places, cutoffs and other places of an alias table."""
    place, side = below(len(choices), label, "place"), below(sum(choices.values()), label, "side")
    listed = ", ".join(f"'{text}'" for text in choices)
    return f"[{listed}][CASE WHEN {side} < {cutoffs}[{place} + 1] THEN {place} ELSE {others}[{place} + 1] END + 1]"


# The words of the documents by position, with their number: a one-row table.
WORDS = """
    SELECT list(word ORDER BY digest) AS words, list(right(digest, 14) ORDER BY digest) AS hash_ids,
           count(*) AS n
    FROM (SELECT word, sha256(word) AS digest
          FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '\\P{L}+')) AS word FROM documents)
          WHERE length(word) >= 1)
"""


def entry(label: str, index: object = 0, field: str = "words") -> str:
    """A random entry of the dictionary; the query must join WORDS."""
    size = f"CASE WHEN n > {NARROW_RANGE} THEN {_wide(label, index)} ELSE {_draw(label, index)} END"
    return f"{field}[({size}) % n + 1]"


def sentence(label: str) -> str:
    return "concat_ws(' ', " + ", ".join(entry(label, n) for n in range(10)) + ")"


def person(label: str, given: tuple[str, ...], family: tuple[str, ...]) -> str:
    def pick(names: tuple[str, ...], index: str) -> str:
        listed = ", ".join(f"'{name}'" for name in names)
        return f"([{listed}])[{below(len(names), label, index)} + 1]"

    return f"{pick(given, 'given')} || ' ' || {pick(family, 'family')}"


def recent_date(label: str) -> str:
    return f"DATE '2014-01-01' + CAST({below(3653, label)} AS INTEGER)"


def recent_datetime(label: str) -> str:
    return f"make_timestamp((1388534400 + {below(315532801, label)}) * 1000000)"

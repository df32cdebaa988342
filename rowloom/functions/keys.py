"""Unique keys by a keyed permutation of the row number, in Column arithmetic.

A permutation gives every row number of its domain another number of the same domain, so
keys are unique without a shuffle, a check afterwards, or any state that tasks share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.draws import constant, mixed

# Key texts are numbers in base 32, five bits a character; twelve hold the largest domain.
CHARACTER_BITS = 5
KEY_BITS = 60
ROUNDS = 6


def bits_within(size: int) -> int:
    """The bits of the largest domain that ``size`` values can hold."""
    if size < 2:
        raise ValueError(f"a key needs two values or more, not {size}")
    return min(KEY_BITS, size.bit_length() - 1)


def round_key(label: str, seed: int, turn: int) -> int:
    return constant("key", seed, label, turn)


def with_keys(rows: DataFrame, domains: Sequence[tuple[str, int]], key: str = "row_id", seed: int = 0) -> DataFrame:
    """Add a permuted ``key`` for each entry of ``domains``, a label and the bits of its domain.

    The number is cut into two halves, and each in turn is changed by what the other mixes to:
    every such step can be undone, so two rows never meet. A row number outside a domain, which
    could only repeat a key, fails the job. Steps are projections of their own, for the same
    reason as those of draws, and end in a generator: a filter on a key would otherwise be
    moved below all of them, and grow to hundreds of thousands of terms.
    """
    numbered = [(n, label, bits - bits // 2, bits // 2) for n, (label, bits) in enumerate(domains)]
    start = []
    for n, _, high, low in numbered:
        message = f"a row number lies outside the {high + low} bits of a column of unique keys"
        start.append(
            f"CASE WHEN `{key}` BETWEEN 0 AND {(1 << (high + low)) - 1}L THEN `{key}` "
            f"ELSE CAST(raise_error('{message}') AS BIGINT) END AS __whole_{n}"
        )
    rows = rows.selectExpr("*", *start)
    halves = [(f"shiftright(__whole_{n}, {low}) AS __half_{n}_0", f"__whole_{n} & {(1 << low) - 1}L AS __half_{n}_1")
              for n, _, _, low in numbered]
    rows = rows.selectExpr("*", *(half for pair in halves for half in pair))
    for turn in range(ROUNDS):
        side, other = turn % 2, 1 - turn % 2
        changed = {}
        for n, label, *widths in numbered:
            word = mixed(f"(__half_{n}_{other} ^ {round_key(label, seed, turn)}L)")
            changed[f"__half_{n}_{side}"] = F.expr(f"__half_{n}_{side} ^ ({word} & {(1 << widths[side]) - 1}L)")
        rows = rows.withColumns(changed)
    whole = ", ".join(f"shiftleft(__half_{n}_0, {low}) | __half_{n}_1 AS __key_{n}" for n, _, _, low in numbered)
    return rows.selectExpr("*", f"inline(array(struct({whole})))").drop(
        *(name for n, *_ in numbered for name in (f"__whole_{n}", f"__half_{n}_0", f"__half_{n}_1"))
    )


def key_number(n: int) -> Column:
    """The permuted number of the ``n``-th domain of ``with_keys``, from 0."""
    return F.col(f"__key_{n}")


def key_text(n: int, length: int) -> Column:
    """The same as a text of a fixed length in base 32."""
    digits = F.lower(F.conv(key_number(n).cast("string"), 10, 1 << CHARACTER_BITS))
    return F.lpad(digits, length, "0")


def key_length(length: int | None) -> int:
    """How many characters a key text takes in a column of a declared length."""
    most = KEY_BITS // CHARACTER_BITS
    return most if length is None else min(length, most)

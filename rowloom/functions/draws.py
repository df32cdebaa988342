"""Deterministic pseudo-random draws built from integer arithmetic alone.

A draw is a function of (seed, row key, label, index). Repartitioning, retries and
lost executors therefore never change a generated value, which ``rand()`` cannot
promise, and the same formula can be written in any SQL dialect. The arithmetic
stays inside whole-stage code generation; hashing text for each draw measured
about fifty times slower.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF
# An odd 27-bit multiplier: its product with a 32-bit word fits a signed 64-bit integer.
MULTIPLIER = 0x45D9F3B
# Above this range one 32-bit draw would be visibly uneven, so two are combined.
NARROW_RANGE = 1 << 20
# Largest range: two draws give 52 bits, ten more than it needs.
WIDE_RANGE = 1 << 42


def constant(*parts: object) -> int:
    """A fixed 32-bit number for a label, computed once while the plan is built."""
    text = "|".join(str(part) for part in parts)
    return int(hashlib.sha256(text.encode("utf-8")).hexdigest()[:8], 16)


def mixed(word: str) -> str:
    """Scramble a 32-bit word held in a bigint: two xor-shift-multiply rounds and a final xor-shift.

    The expression is text, which Spark parses at once; built from Column objects, a draw
    takes some twenty calls into the JVM and a wide table seconds to plan.
    """
    for _ in range(2):
        word = f"(((shiftright({word}, 16) ^ {word}) * {MULTIPLIER}L) & {MASK}L)"
    return f"(shiftright({word}, 16) ^ {word})"


def with_draws(rows: DataFrame, key: str = "row_id", seed: int = 0) -> DataFrame:
    """Add the two 32-bit state words of each row's 64-bit ``key``.

    The steps are separate projections so that each word is computed once per row,
    whatever the number of draws that read it.
    """
    halves = (f"`{key}` & {MASK}L AS __low", f"shiftright(`{key}`, 32) & {MASK}L AS __high")
    states = [f"{mixed(f'(__low ^ {constant(seed, part)}L)')} AS __mixed_{part}" for part in "ab"]
    state = [f"{mixed(f'(__mixed_{part} ^ __high)')} AS __draw_{part}" for part in "ab"]
    return (
        rows.selectExpr("*", *halves).selectExpr("*", *states).selectExpr("*", *state)
        .drop("__low", "__high", "__mixed_a", "__mixed_b")
    )


def below_numbered(size: int, first: str, second: str) -> Column:
    """A uniform bigint in ``[0, size)`` from the SQL texts of a pair of label numbers."""
    if not 1 <= size <= WIDE_RANGE:
        raise ValueError(f"a draw has between 1 and {WIDE_RANGE} values, not {size}")

    def draw(number: str) -> str:
        return f"(({mixed(f'(__draw_a ^ {number})')} + __draw_b) & {MASK}L)"

    value = draw(first)
    if size > NARROW_RANGE:
        value = f"({value} * {NARROW_RANGE}L + ({draw(second)} & {NARROW_RANGE - 1}L))"
    return F.expr(f"{value} % {size}L")


def label_numbers(label: str, index: object = 0) -> tuple[int, int]:
    """The two fixed numbers that keep the draws of a label and index apart from others."""
    return constant(label, index), constant(label, f"{index}+")


def below(size: int, label: str, index: object = 0) -> Column:
    """A uniform bigint in ``[0, size)``, independent across labels and indexes."""
    first, second = label_numbers(label, index)
    return below_numbered(size, f"{first}L", f"{second}L")

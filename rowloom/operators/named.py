"""The generator that a column spec names, settled while the plan is built.

A spec's ``generator`` is a name, alone or followed by its arguments as JSON:
``weighted {"en": 5, "de": 2}``. The default name leaves the choice to the rules.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from types import MappingProxyType

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.draws import WIDE_RANGE, below
from rowloom.functions.values import uniform_int
from rowloom.sources.specs import DEFAULT_GENERATOR

# A generator takes a column's label and its arguments, and reads the draws of the row.
Generator = Callable[[str, object], Column]


def alias_table(weights: list[int]) -> tuple[list[int], list[int]]:
    """Per place, the cutoff below which a draw under the sum of weights stays, and where it goes above.

    Whole numbers throughout, so a place is drawn exactly as often as its weight says.
    """
    total, places = sum(weights), len(weights)
    shares = [weight * places for weight in weights]
    poor = [n for n, share in enumerate(shares) if share < total]
    rich = [n for n, share in enumerate(shares) if share >= total]
    cutoffs, others = [total] * places, list(range(places))
    while poor and rich:
        taker, giver = poor.pop(), rich[-1]
        cutoffs[taker], others[taker] = shares[taker], giver
        shares[giver] -= total - shares[taker]
        if shares[giver] < total:
            poor.append(rich.pop())
    return cutoffs, others


def weighted(label: str, choices: object) -> Column:
    """One of the texts of a map, each as often as its whole weight says: two draws, no search."""
    if not isinstance(choices, dict) or not choices:
        raise ValueError("weighted takes a map of texts to weights")
    weights = list(choices.values())
    if any(not isinstance(weight, int) or isinstance(weight, bool) or weight < 0 for weight in weights):
        raise ValueError("weights are whole numbers, not below zero")
    if not 0 < sum(weights) <= WIDE_RANGE:
        raise ValueError(f"weights add up to between 1 and {WIDE_RANGE}")
    cutoffs, others = alias_table(weights)
    place = below(len(weights), label, "place").cast("int")
    stays = below(sum(weights), label, "side") < F.get(_constants(cutoffs, "bigint"), place)
    chosen = F.when(stays, place).otherwise(F.get(_constants(others, "int"), place))
    return F.get(_constants(list(choices), "string"), chosen)


def _constants(items: list[object], item_type: str) -> Column:
    return F.array(*[F.lit(item) for item in items]).cast(f"array<{item_type}>")


def between(label: str, ends: object) -> Column:
    """A uniform whole number between two, both included."""
    if not isinstance(ends, list) or len(ends) != 2 or any(type(end) is not int for end in ends) or ends[0] > ends[1]:
        raise ValueError("between takes two whole numbers, the smaller first")
    return uniform_int(label, *ends)


def fixed(label: str, value: object) -> Column:
    """The same value in each row."""
    if isinstance(value, (dict, list)):
        raise ValueError("fixed takes one value")
    return F.lit(value)


GENERATORS: Mapping[str, Generator] = MappingProxyType({"weighted": weighted, "between": between, "fixed": fixed})


def named_generator(text: str | None, label: str, generators: Mapping[str, Generator] = GENERATORS) -> Column | None:
    """The column that a spec's generator names; none where the rules decide."""
    name, _, arguments = (text or DEFAULT_GENERATOR).strip().partition(" ")
    if name == DEFAULT_GENERATOR:
        return None
    if name not in generators:
        raise ValueError(f"no generator {name!r}; there are {', '.join([DEFAULT_GENERATOR, *generators])}")
    return generators[name](label, json.loads(arguments) if arguments.strip() else None)

"""Synthetic rows from column specs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions import values
from rowloom.functions.draws import with_draws
from rowloom.functions.keys import CHARACTER_BITS, KEY_BITS, bits_within, key_length, key_number, key_text, with_keys
from rowloom.functions.people import COMMON_PEOPLE, People
from rowloom.operators.dictionary import BROADCAST_BYTES, Dictionary, Pick
from rowloom.operators.named import GENERATORS, Generator, named_generator
from rowloom.operators.rules import Profile, generator_of, spark_type
from rowloom.sources.specs import ColumnSpec

_WORDS_NEEDED = {"hash_id": 1, "word": 1, "sentence": values.SENTENCE_WORDS}
# The kinds that a column's type decides; the others are texts.
_TYPED = ("integer", "boolean", "date", "datetime")
# Integers of the narrow type keep room for the lowest value of a profile.
_NARROW_BITS = 30


def _key_bits(spec: ColumnSpec, kind: str, profile: Profile, moment: datetime) -> int:
    """The bits of the largest domain of unique keys that a column can hold."""
    if kind == "integer":
        return KEY_BITS if isinstance(profile.integer_type, T.LongType) else _NARROW_BITS
    if kind == "boolean":
        return 1
    if kind == "date":
        return bits_within(values.date_span(moment)[1])
    if kind == "datetime":
        return bits_within(values.second_span(moment)[1])
    return bits_within(1 << (CHARACTER_BITS * key_length(spec.length)))


def _key_value(n: int, spec: ColumnSpec, kind: str, profile: Profile, moment: datetime) -> Column:
    """The ``n``-th key as a value of its column."""
    if kind == "integer":
        return (key_number(n) + F.lit(profile.integer_low)).cast(profile.integer_type)
    if kind == "boolean":
        return key_number(n) == 0
    if kind == "date":
        return F.date_add(F.lit(values.date_span(moment)[0]), key_number(n).cast("int"))
    if kind == "datetime":
        return F.timestamp_seconds(key_number(n) + F.lit(values.second_span(moment)[0]).cast("long"))
    return key_text(n, key_length(spec.length))


def _keyed(specs: Sequence[ColumnSpec], bits: Mapping[int, int], named: Sequence[Column | None]) -> list[int]:
    """The positions that get keys: each unique column, and the widest of a primary key without one."""
    keyed = [n for n, spec in enumerate(specs) if spec.unique]
    primary = [n for n, spec in enumerate(specs) if spec.primary_key]
    if primary and not set(primary) & set(keyed):
        free = [n for n in primary if named[n] is None] or primary
        keyed.append(max(free, key=lambda n: bits[n]))
    for n in keyed:
        if named[n] is not None:
            raise ValueError(f"column {specs[n].name!r} must be unique, which its named generator does not promise")
    return sorted(keyed)


def generate(
    spine: DataFrame,
    specs: Sequence[ColumnSpec],
    profile: Profile,
    dictionary: Dictionary | None = None,
    seed: int = 0,
    as_of: datetime | None = None,
    people: People = COMMON_PEOPLE,
    sequence: str = "record_num",
    carry: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    keep_specs: bool = False,
    generators: Mapping[str, Generator] = GENERATORS,
) -> DataFrame:
    """Generate one column per spec for each row of a spine, named by the specs.

    ``sequence`` is the spine column a sequence text takes: ``record_num`` restarts in
    each group, ``row_id`` is unique over all rows. ``carry`` names spine columns to
    keep in front. Without word picks there is no join and no shuffle; with them, only
    those of the dictionary.

    A spec's ``generator`` may name one of ``generators``, whose values are cast to the
    column's type; by default the rules of the profile decide.

    With ``keep_specs`` the rows keep the declared lengths and keys, so that ``audit`` finds
    no break: texts are cut at their length; a unique column, and the widest column of a
    primary key without a unique one, holds a keyed permutation of ``row_id`` in place of
    random values. More rows than such a column has keys (two for a boolean, 32 to the power of
    its length for a text) fail the job. No value is null in either mode.
    """
    moment = as_of or datetime.now(timezone.utc)
    kinds = [generator_of(spec.name, spec.data_type, profile) for spec in specs]
    named = [named_generator(spec.generator, spec.name, generators) for spec in specs]
    keyed: list[int] = []
    if keep_specs:
        wanted = [n for n, spec in enumerate(specs) if spec.unique or spec.primary_key]
        bits = {n: _key_bits(specs[n], kinds[n], profile, moment) for n in wanted}
        keyed = _keyed(specs, bits, named)
    ruled = [n for n in range(len(specs)) if named[n] is None and n not in keyed]
    picks = {
        position: [
            Pick(f"__pick_{position}_{n}", spec.name, n, "hash_id" if kind == "hash_id" else "word")
            for n in range(_WORDS_NEEDED.get(kind, 0))
        ]
        for position, (spec, kind) in enumerate(zip(specs, kinds))
        if position in ruled
    }
    rows = with_draws(spine, seed=seed)
    if keyed:
        rows = with_keys(rows, [(specs[n].name, bits[n]) for n in keyed], seed=seed)
    all_picks = [pick for group in picks.values() for pick in group]
    if all_picks:
        if dictionary is None:
            raise ValueError("these specs need a word dictionary")
        rows = dictionary.attach(rows, all_picks, broadcast_bytes)

    def value(position: int, spec: ColumnSpec, kind: str) -> Column:
        if kind == "integer":
            number = values.uniform_int(spec.name, profile.integer_low, profile.integer_high)
            return number.cast(profile.integer_type)
        if kind == "boolean":
            return values.fair_bool(spec.name)
        if kind == "date":
            return values.recent_date(spec.name, moment)
        if kind == "datetime":
            return values.recent_datetime(spec.name, moment)
        if kind == "sequence":
            return values.sequence_text(F.col(sequence))
        if kind == "person":
            return values.person(spec.name, people)
        return F.concat_ws(" ", *[F.col(pick.output) for pick in picks[position]])

    def kept(position: int, spec: ColumnSpec, kind: str) -> Column:
        if position in keyed:
            return _key_value(keyed.index(position), spec, kind, profile, moment)
        if named[position] is None:
            found, is_text = value(position, spec, kind), kind not in _TYPED
        else:
            column_type = spark_type(spec.data_type, profile)
            found, is_text = named[position].cast(column_type), isinstance(column_type, T.StringType)
        return F.left(found, F.lit(spec.length)) if keep_specs and is_text and spec.length is not None else found

    columns = [kept(n, spec, kind).alias(spec.name) for n, (spec, kind) in enumerate(zip(specs, kinds))]
    return rows.select(*carry, *columns)

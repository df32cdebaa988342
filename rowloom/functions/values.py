"""Generated values, one Column builder per rule.

Every builder but ``hash_id`` and ``sequence_text`` reads the draw state that
``draws.with_draws`` adds to a row, and takes the label that keeps its draws apart
from those of other columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.draws import below
from rowloom.functions.people import COMMON_PEOPLE, People

HASH_ID_LENGTH = 14
SENTENCE_WORDS = 10
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def utc(moment: datetime) -> datetime:
    """Read a naive datetime as UTC and cut it to whole seconds."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return aware.astimezone(timezone.utc).replace(microsecond=0)


def years_before(moment: datetime, years: int) -> datetime:
    """The same day ``years`` earlier; 29 February falls back to the 28th."""
    try:
        return moment.replace(year=moment.year - years)
    except ValueError:
        return moment.replace(year=moment.year - years, day=28)


def constant_array(items: Sequence[object], item_type: str = "string") -> Column:
    """A constant array; the optimizer folds the split, and the plan holds one literal."""
    return F.split(F.lit("\n".join(str(item) for item in items)), "\n").cast(f"array<{item_type}>")


def uniform_int(label: str, low: int, high: int) -> Column:
    """A uniform bigint, both ends included."""
    return below(high - low + 1, label) + F.lit(low).cast("long")


def fair_bool(label: str) -> Column:
    return below(2, label) == 0


def date_span(as_of: datetime, years: int = 10) -> tuple[date, int]:
    """The first of the dates of the last ``years`` years, and their number."""
    last = utc(as_of)
    first = years_before(last, years)
    return first.date(), (last.date() - first.date()).days + 1


def second_span(as_of: datetime, years: int = 10) -> tuple[int, int]:
    """The first second of the last ``years`` years, counted from 1970, and their number."""
    last = utc(as_of)
    first = years_before(last, years)
    return int((first - EPOCH).total_seconds()), int((last - first).total_seconds()) + 1


def recent_date(label: str, as_of: datetime, years: int = 10) -> Column:
    """A date of the last ``years`` years, both ends included."""
    first, days = date_span(as_of, years)
    return F.date_add(F.lit(first), below(days, label).cast("int"))


def recent_datetime(label: str, as_of: datetime, years: int = 10) -> Column:
    """A timestamp of the last ``years`` years, in whole seconds, both ends included."""
    start, seconds = second_span(as_of, years)
    return F.timestamp_seconds(below(seconds, label) + F.lit(start).cast("long"))


def midnight_since(label: str, as_of: datetime, start_year: int = 2013) -> Column:
    """A UTC midnight between 1 January of ``start_year`` and ``as_of``, both ends included."""
    first = datetime(start_year, 1, 1, tzinfo=timezone.utc)
    days = (utc(as_of) - first) // timedelta(days=1)
    start = (first.date() - date(1970, 1, 1)).days
    return F.timestamp_seconds((below(days + 1, label) + F.lit(start).cast("long")) * F.lit(86400))


def hash_id(word: Column) -> Column:
    """The last fourteen hex digits of a word's SHA-256."""
    return F.right(F.sha2(word, 256), F.lit(HASH_ID_LENGTH))


def sequence_text(record_num: Column) -> Column:
    return record_num.cast("string")


def person(label: str, people: People = COMMON_PEOPLE) -> Column:
    """A given name and a family name, drawn independently."""

    def pick(names: tuple[str, ...], index: str) -> Column:
        return F.get(constant_array(names), below(len(names), label, index).cast("int"))

    return F.concat_ws(" ", pick(people.given, "given"), pick(people.family, "family"))

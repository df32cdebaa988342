"""Each generated value: type, range, ends and shape."""

from __future__ import annotations

import hashlib
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowloom.functions import values
from rowloom.functions.draws import with_draws
from rowloom.functions.people import COMMON_PEOPLE, People

AS_OF = datetime(2024, 2, 29, 12, 30, 15)


@pytest.fixture(scope="module")
def rows(spark):
    return with_draws(spark.range(100_000).withColumnRenamed("id", "row_id"))


def collected(rows, column):
    return [row[0] for row in rows.select(column).collect()]


@pytest.mark.parametrize("low, high", [(1, 100), (100, 1000), (0, 0), (-5, 5)])
def test_integer_reaches_both_ends(rows, low, high):
    assert set(collected(rows, values.uniform_int("n", low, high))) == set(range(low, high + 1))


def test_boolean_is_fair(rows):
    drawn = collected(rows, values.fair_bool("b"))
    assert set(drawn) == {True, False}
    assert 0.49 < sum(drawn) / len(drawn) < 0.51


def test_date_covers_ten_years(rows):
    drawn = collected(rows, values.recent_date("d", AS_OF))
    assert min(drawn) == date(2014, 2, 28) and max(drawn) == date(2024, 2, 29)
    assert len(set(drawn)) == (max(drawn) - min(drawn)).days + 1


def test_datetime_covers_ten_years(rows):
    drawn = collected(rows, values.recent_datetime("t", AS_OF))
    assert datetime(2014, 2, 28, 12, 30, 15) <= min(drawn) < datetime(2014, 3, 2)
    assert datetime(2024, 2, 27) < max(drawn) <= AS_OF
    assert all(moment.microsecond == 0 for moment in drawn)


def test_midnights_since_start_year(rows):
    drawn = collected(rows, values.midnight_since("m", AS_OF, 2020))
    assert min(drawn) == datetime(2020, 1, 1) and max(drawn) == datetime(2024, 2, 29)
    assert all(moment == datetime.combine(moment.date(), datetime.min.time()) for moment in drawn)


def test_midnights_are_utc_in_any_session_zone(spark, rows):
    seconds = values.midnight_since("m", AS_OF, 2020).cast("long") % 86400
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert set(collected(rows, seconds)) == {0}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hash_id_is_the_tail_of_sha256(spark):
    words = ["", "a", "Straße", "日本"]
    df = spark.createDataFrame([(word,) for word in words], "word string")
    expected = [hashlib.sha256(word.encode()).hexdigest()[50:] for word in words]
    assert collected(df, values.hash_id(F.col("word"))) == expected


def test_person_uses_all_names(rows):
    given, family = zip(*(name.split(" ") for name in collected(rows, values.person("p"))))
    assert set(given) == set(COMMON_PEOPLE.given) and set(family) == set(COMMON_PEOPLE.family)


def test_person_of_another_locale(rows):
    people = People(("Åsa", "Jean-Luc"), ("O'Neil", "van Dyk"))
    assert set(collected(rows, values.person("p", people))) == {
        f"{given} {family}" for given in people.given for family in people.family
    }


def test_sequence_text(spark):
    assert collected(spark.range(3), values.sequence_text(F.col("id"))) == ["0", "1", "2"]


def test_naive_and_aware_moments_agree():
    aware = AS_OF.astimezone() - timedelta(0)
    assert values.utc(AS_OF) == AS_OF.replace(tzinfo=values.EPOCH.tzinfo)
    assert values.utc(aware).tzinfo is not None

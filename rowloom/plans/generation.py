"""Generated values and tables, with existing keys as row numbers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom import jobs
from rowloom.functions import values
from rowloom.functions.draws import with_draws
from rowloom.functions.people import COMMON_PEOPLE
from rowloom.operators.audit import audit
from rowloom.operators.bind import bind_positional, named_schema, positional_schema
from rowloom.operators.dictionary import Dictionary, Pick, index_words, read_words, words_of
from rowloom.operators.generate import generate
from rowloom.operators.named import alias_table
from rowloom.operators.rules import PROFILE_A, PROFILE_B, Profile
from rowloom.operators.spines import batch_spine, chunk_spine, group_size, key_spine
from rowloom.plans import duck
from rowloom.plans.inputs import AS_OF, SEED, document_dictionary, document_words, spread_table, table
from rowloom.sources.files import read_parquet, write_parquet
from rowloom.sources.specs import EVENT_SPECS, ColumnSpec
from rowloom.storage import scratch_path

CHUNK_RECORDS = 1000
CHUNKS = 100
SLICES = 16
BATCH_RECORDS = 40
PLAIN_NAMES = ("property_name", "sob", "is_logged_in", "page_views", "utc_date")
PLAIN_SPECS = tuple(spec for spec in EVENT_SPECS if spec.name in PLAIN_NAMES)
TIMED_SPECS = (*EVENT_SPECS, ColumnSpec("updated_at", "DATETIME"))

# A table with short texts, unique columns, a key of two columns, and generators of its own.
COUNTRIES = {"de": 17, "en": 120, "es": 42, "fr": 33, "zh": 88}
KEYED_SPECS = (
    ColumnSpec("account", "CHARACTER VARYING", 10, 10, not_null=True, unique=True),
    ColumnSpec("ticket", "BIGINT", unique=True),
    ColumnSpec("sob", "CHARACTER VARYING", 9, 9, not_null=True, primary_key=True),
    ColumnSpec("family", "CHARACTER VARYING", 5, 5, not_null=True, primary_key=True),
    ColumnSpec("note", "CHARACTER VARYING", 12, 12),
    ColumnSpec("country", "CHARACTER VARYING", 2, 2, generator=f"weighted {json.dumps(COUNTRIES)}"),
    ColumnSpec("age", "BIGINT", generator="between [18, 99]"),
    ColumnSpec("origin", "TEXT", generator='fixed "synthetic"'),
)


def _order_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_spine(spread_table(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey", CHUNK_RECORDS)


def _event_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_spine(spread_table(spark, sf_dir, "events", "event_id"), "event_id", BATCH_RECORDS, "batch")


def _value_query(value: Callable[[], Column]) -> Callable[[SparkSession, str], DataFrame]:
    """One generated value for each order."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = with_draws(_order_spine(spark, sf_dir), seed=SEED)
        return rows.select("row_id", value().alias("value"))

    return query


def _pick_query(field: str, count: int, **options) -> Callable[[SparkSession, str], DataFrame]:
    """``count`` dictionary entries for each order, as one text."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = with_draws(_order_spine(spark, sf_dir), seed=SEED)
        picks = [Pick(f"word_{n}", "value", n, field) for n in range(count)]
        found = document_dictionary(spark, sf_dir).attach(rows, picks, **options)
        return found.select("row_id", F.concat_ws(" ", *[pick.output for pick in picks]).alias("value"))

    return query


def hash_id_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", values.hash_id(F.col("text")).alias("hash_id"))


def dictionary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the words of the documents as a word list, read it back and index it."""
    path = scratch_path(spark, "words")
    document_words(spark, sf_dir).write.text(path)
    return index_words(read_words(spark, path))


def _grown_dictionary(spark: SparkSession, sf_dir: str) -> Dictionary:
    """The words of the English documents, saved, and opened with those of the others merged in."""
    documents = spread_table(spark, sf_dir, "documents", "text", "lang")
    first, second = scratch_path(spark, "dictionary-first"), scratch_path(spark, "dictionary-second")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    Dictionary.build(words_of(documents.where(english), "text")).save(first)
    return Dictionary.extend(spark, first, words_of(documents.where(~english), "text"), second)


def dictionary_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown_dictionary(spark, sf_dir).entries


def gen_word_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word of the extended dictionary for each order."""
    rows = with_draws(_order_spine(spark, sf_dir), seed=SEED)
    found = _grown_dictionary(spark, sf_dir).attach(rows, [Pick("value", "value", 0, "word")])
    return found.select("row_id", "value")


def gen_profile_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generate(
        _order_spine(spark, sf_dir), EVENT_SPECS, PROFILE_A, document_dictionary(spark, sf_dir), SEED, AS_OF
    )
    return bind_positional(rows, positional_schema(EVENT_SPECS, PROFILE_A))


def gen_profile_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate(
        _event_spine(spark, sf_dir), TIMED_SPECS, PROFILE_B, document_dictionary(spark, sf_dir), SEED, AS_OF
    )


def gen_profile_b_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile B with every word looked up by the shuffled join, as for a large dictionary."""
    return generate(
        _event_spine(spark, sf_dir), TIMED_SPECS, PROFILE_B, document_dictionary(spark, sf_dir), SEED, AS_OF,
        broadcast_bytes=0,
    )


def _plain_rows(spine: DataFrame, profile: Profile, carry: str) -> DataFrame:
    """The sample columns that need no dictionary."""
    return generate(spine, PLAIN_SPECS, profile, None, SEED, AS_OF, carry=["row_id", carry])


def gen_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each order that keeps the lengths and keys of its specs, with named generators."""
    return generate(
        _order_spine(spark, sf_dir), KEYED_SPECS, PROFILE_B, document_dictionary(spark, sf_dir), SEED, AS_OF,
        keep_specs=True,
    )


def keyed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of such rows, written and read back."""
    path = scratch_path(spark, "keyed")
    write_parquet(gen_keyed(spark, sf_dir), path)
    return audit(read_parquet(spark, path), KEYED_SPECS)


def gen_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each country is drawn for the events."""
    specs = [spec for spec in KEYED_SPECS if spec.name == "country"]
    rows = generate(_event_spine(spark, sf_dir), specs, PROFILE_A, None, SEED, AS_OF)
    return rows.groupBy("country").agg(F.count("*").alias("rows"))


def _share(spark: SparkSession, sf_dir: str, name: str, groups: int) -> int:
    """A table's number of rows over a number of groups, rounded up."""
    return -(-table(spark, sf_dir, name).count() // groups)


def gen_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred chunks of records, as many records in all as there are orders, rounded up."""
    records = _share(spark, sf_dir, "orders", CHUNKS)
    return _plain_rows(chunk_spine(spark, CHUNKS, records), PROFILE_A, "chunk")


def gen_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of as many records as there are events."""
    return _plain_rows(batch_spine(spark, table(spark, sf_dir, "events").count()), PROFILE_B, "batch")


def chunked_write_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generate a record per order, write them by chunk, read them back and sum up each chunk.

    The number of chunks, and so of folders, is fixed; their size grows with the table.
    """
    records = group_size(table(spark, sf_dir, "orders"), "o_orderkey", CHUNKS)
    spine = key_spine(spread_table(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey", records)
    rows = generate(
        spine, EVENT_SPECS, PROFILE_A, document_dictionary(spark, sf_dir), SEED, AS_OF,
        carry=["chunk"],
    )
    path = scratch_path(spark, "chunks")
    write_parquet(rows, path, partition_by="chunk")
    return read_parquet(spark, path, rows.schema).groupBy("chunk").agg(
        F.count("*").alias("records"),
        F.sum("page_views").alias("page_views"),
        F.count_if("is_logged_in").alias("logged_in"),
        F.min("utc_date").alias("first_date"),
        F.sum(F.length("property_name")).alias("name_letters"),
        F.sum(F.ascii("property_id")).alias("id_codes"),
    )


def batch_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generate batches of records for the events, append them by record number and read them back."""
    dictionary = document_dictionary(spark, sf_dir)
    rows = generate(
        _event_spine(spark, sf_dir), EVENT_SPECS, PROFILE_B, dictionary, SEED, AS_OF, carry=["batch"]
    )
    path = scratch_path(spark, "batches")
    write_parquet(rows, path, partition_by="sob")
    return read_parquet(spark, path, rows.schema).groupBy("sob").agg(
        F.count("*").alias("records"),
        F.count_distinct("batch").alias("batches"),
        F.sum("page_views").alias("page_views"),
        F.sum(F.length("core_action")).alias("action_letters"),
    )


def chunk_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk job, for as many records as there are orders, rounded up; its files read back."""
    path, records = scratch_path(spark, "chunk-job"), _share(spark, sf_dir, "orders", CHUNKS)
    words = document_dictionary(spark, sf_dir)
    jobs.write_chunks(spark, EVENT_SPECS, path, words, CHUNKS, records, "Col4", seed=SEED, as_of=AS_OF)
    return read_parquet(spark, path, positional_schema(EVENT_SPECS, PROFILE_A, required=()))


def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job, in a folder per record number, for as many records as there are events, rounded up."""
    path, batches = scratch_path(spark, "batch-job"), _share(spark, sf_dir, "events", BATCH_RECORDS)
    words = document_dictionary(spark, sf_dir)
    jobs.write_batches(spark, TIMED_SPECS, path, words, batches, BATCH_RECORDS, seed=SEED, as_of=AS_OF)
    return read_parquet(spark, path, named_schema(TIMED_SPECS, PROFILE_B))


def slice_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice job whose folder lacks a slice, holds half of another and a third twice, resumed."""
    whole, path = scratch_path(spark, "slice-whole"), scratch_path(spark, "slice-resume")
    words, size = document_dictionary(spark, sf_dir), _share(spark, sf_dir, "orders", SLICES)
    jobs.write_slices(spark, EVENT_SPECS, whole, 1, SLICES, words, size, seed=SEED, as_of=AS_OF)
    rows = read_parquet(spark, whole, named_schema(EVENT_SPECS, PROFILE_A).add("slice", "string"))
    half = (F.col("slice") == "slice-012") & (F.col("sob").cast("long") >= size // 2)
    write_parquet(rows.where((F.col("slice") != "slice-005") & ~half), path, partition_by="slice")
    write_parquet(rows.where(F.col("slice") == "slice-009"), path, partition_by="slice")
    jobs.resume_slices(spark, EVENT_SPECS, path, 1, SLICES, words, size, seed=SEED, as_of=AS_OF)
    return read_parquet(spark, path, rows.schema)


def slice_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice job with every word looked up by the shuffled join, for as many rows as there are orders, rounded up."""
    path, rows = scratch_path(spark, "slice-job"), _share(spark, sf_dir, "orders", SLICES)
    words = document_dictionary(spark, sf_dir)
    jobs.write_slices(
        spark, EVENT_SPECS, path, 1, SLICES, words, rows, seed=SEED, as_of=AS_OF, broadcast_bytes=0
    )
    schema = named_schema(EVENT_SPECS, PROFILE_A).add("slice", "string")
    return read_parquet(spark, path, schema)


QUERIES = {
    "gen_int": _value_query(lambda: values.uniform_int("value", 1, 100).cast("int")),
    "gen_int_wide": _value_query(lambda: values.uniform_int("value", 100, 1000)),
    "gen_bool": _value_query(lambda: values.fair_bool("value")),
    "gen_date": _value_query(lambda: values.recent_date("value", AS_OF)),
    "gen_datetime": _value_query(lambda: values.recent_datetime("value", AS_OF)),
    "gen_since_year": _value_query(lambda: values.midnight_since("value", AS_OF)),
    "gen_sequence": _value_query(lambda: values.sequence_text(F.col("record_num"))),
    "gen_name": _value_query(lambda: values.person("value")),
    "gen_hash_id": _pick_query("hash_id", 1),
    "gen_word": _pick_query("word", 1),
    "gen_sentence": _pick_query("word", values.SENTENCE_WORDS),
    "gen_word_shuffled": _pick_query("word", 1, broadcast_bytes=0),
    "gen_sentence_shuffled": _pick_query("word", values.SENTENCE_WORDS, broadcast_bytes=0),
    "hash_id_documents": hash_id_documents,
    "dictionary_scan": dictionary_scan,
    "dictionary_grown": dictionary_grown,
    "gen_word_grown": gen_word_grown,
    "gen_chunks": gen_chunks,
    "gen_batch": gen_batch,
    "gen_keyed": gen_keyed,
    "keyed_audit": keyed_audit,
    "gen_weighted": gen_weighted,
    "gen_profile_a": gen_profile_a,
    "gen_profile_b": gen_profile_b,
    "gen_profile_b_shuffled": gen_profile_b_shuffled,
    "chunked_write_summary": chunked_write_summary,
    "batch_append": batch_append,
    "chunk_job": chunk_job,
    "batch_job": batch_job,
    "slice_job": slice_job,
    "slice_resume": slice_resume,
}

_ORDERS = duck.with_draws(
    f"""SELECT o_orderkey AS row_id, o_orderkey // {CHUNK_RECORDS} AS chunk,
               o_orderkey % {CHUNK_RECORDS} AS record_num FROM orders""",
    "row_id", SEED,
)
_ORDERS_IN_CHUNKS = duck.with_draws(
    f"""SELECT o_orderkey AS row_id, o_orderkey // size AS chunk, o_orderkey % size AS record_num
        FROM orders, (SELECT (max(o_orderkey) + {CHUNKS}) // {CHUNKS} AS size FROM orders)""",
    "row_id", SEED,
)
_EVENTS = duck.with_draws(
    f"""SELECT event_id AS row_id, event_id // {BATCH_RECORDS} AS batch,
               event_id % {BATCH_RECORDS} AS record_num FROM events""",
    "row_id", SEED,
)
_CHUNK_ROWS = duck.with_draws(
    f"""SELECT row_id, row_id // size AS chunk, row_id % size AS record_num
        FROM (SELECT unnest(range(size * {CHUNKS})) AS row_id, size
              FROM (SELECT (count(*) + {CHUNKS - 1}) // {CHUNKS} AS size FROM orders))""",
    "row_id", SEED,
)
_JOB_BATCH_ROWS = duck.with_draws(
    f"""SELECT row_id, row_id // {BATCH_RECORDS} AS batch, row_id % {BATCH_RECORDS} AS record_num
        FROM (SELECT unnest(range((count(*) + {BATCH_RECORDS - 1}) // {BATCH_RECORDS} * {BATCH_RECORDS})) AS row_id
              FROM events)""",
    "row_id", SEED,
)
_JOB_SLICE_ROWS = duck.with_draws(
    f"""SELECT row_id, row_id // size + 1 AS slice_num, row_id % size AS record_num
        FROM (SELECT unnest(range(size * {SLICES})) AS row_id, size
              FROM (SELECT (count(*) + {SLICES - 1}) // {SLICES} AS size FROM orders))""",
    "row_id", SEED,
)
_BATCH_ROWS = duck.with_draws(
    """SELECT row_id, 0 AS batch, row_id AS record_num
       FROM (SELECT unnest(range(n)) AS row_id FROM (SELECT count(*) AS n FROM events))""",
    "row_id", SEED,
)


def _value_sql(expression: str) -> str:
    return f"SELECT row_id, {expression} AS value FROM ({_ORDERS})"


def _pick_sql(expression: str) -> str:
    return f"SELECT row_id, {expression} AS value FROM ({_ORDERS}), ({duck.WORDS})"


def _person_sql(label: str) -> str:
    return duck.person(label, COMMON_PEOPLE.given, COMMON_PEOPLE.family)


# The sample table's columns under both profiles, in order.
_PROFILE_A = {
    "property_id": duck.entry("property_id", field="hash_ids"),
    "property_name": _person_sql("property_name"),
    "sob": "CAST(record_num AS VARCHAR)",
    "is_logged_in": f"{duck.below(2, 'is_logged_in')} = 0",
    "mobile_device_locale": duck.entry("mobile_device_locale"),
    "page_views": f"CAST(1 + {duck.below(100, 'page_views')} AS INTEGER)",
    "property_family": _person_sql("property_family"),
    "utc_date": duck.recent_date("utc_date"),
    "core_action": duck.entry("core_action"),
}
_PROFILE_B = _PROFILE_A | {
    "mobile_device_locale": duck.sentence("mobile_device_locale"),
    "page_views": f"100 + {duck.below(901, 'page_views')}",
    "core_action": duck.sentence("core_action"),
}
_POSITIONAL_A = {f"Col{n}": expression for n, expression in enumerate(_PROFILE_A.values(), start=1)}
_TIMED_B = _PROFILE_B | {"updated_at": duck.recent_datetime("updated_at")}


def _table_sql(columns: dict[str, str], rows: str, carry: str = "") -> str:
    listed = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {carry}{listed} FROM ({rows}), ({duck.WORDS})"


def _plain_sql(columns: dict[str, str], carry: str, rows: str) -> str:
    listed = ", ".join(f"{columns[name]} AS {name}" for name in PLAIN_NAMES)
    return f"SELECT row_id, {carry}, {listed} FROM ({rows})"


_KEYED_ROWS = duck.with_keys(_ORDERS, "row_id", {"account": 50, "ticket": 60, "sob": 45}, SEED)
_KEYED = _table_sql(
    {
        "account": duck.key_text("account", 10),
        "ticket": "100 + ticket",
        "sob": duck.key_text("sob", 9),
        "family": f"left({_person_sql('family')}, 5)",
        "note": f"left({duck.sentence('note')}, 12)",
        "country": duck.weighted("country", COUNTRIES, *alias_table(list(COUNTRIES.values()))),
        "age": f"18 + {duck.below(82, 'age')}",
        "origin": "'synthetic'",
    },
    _KEYED_ROWS,
)


def _audit_sql(pos: int, spec: ColumnSpec, key: str | None) -> str:
    nulls = f"count(*) - count({spec.name})" if spec.not_null else "0 * count(*)"
    longer = f"count(*) FILTER (length({spec.name}) > {spec.length})" if spec.length else "0"
    repeats = f"count(*) - count(DISTINCT {key})" if key else "0"
    return (
        f"SELECT {pos} AS pos, '{spec.name}' AS name, {nulls} AS null_count, {longer} AS overlength_count, "
        f"{repeats} AS duplicate_count FROM keyed"
    )


_KEYS = {"account": "account", "ticket": "ticket", "sob": "(sob, family)", "family": "(sob, family)"}
_DICTIONARY = f"""
    SELECT idx - 1 AS idx, words[idx] AS word, hash_ids[idx] AS hash_id
    FROM (SELECT unnest(range(1, n + 1)) AS idx, words, hash_ids FROM ({duck.WORDS}))
"""
ORACLES = {
    "gen_int": _value_sql(f"CAST(1 + {duck.below(100, 'value')} AS INTEGER)"),
    "gen_int_wide": _value_sql(f"100 + {duck.below(901, 'value')}"),
    "gen_bool": _value_sql(f"{duck.below(2, 'value')} = 0"),
    "gen_date": _value_sql(duck.recent_date("value")),
    "gen_datetime": _value_sql(duck.recent_datetime("value")),
    "gen_since_year": _value_sql(
        f"CAST(DATE '2013-01-01' + CAST({duck.below(4018, 'value')} AS INTEGER) AS TIMESTAMP)"
    ),
    "gen_sequence": _value_sql("CAST(record_num AS VARCHAR)"),
    "gen_name": _value_sql(_person_sql("value")),
    "gen_hash_id": _pick_sql(duck.entry("value", field="hash_ids")),
    "gen_word": _pick_sql(duck.entry("value")),
    "gen_sentence": _pick_sql(duck.sentence("value")),
    "gen_word_shuffled": _pick_sql(duck.entry("value")),
    "gen_sentence_shuffled": _pick_sql(duck.sentence("value")),
    "hash_id_documents": "SELECT doc_id, right(sha256(text), 14) AS hash_id FROM documents",
    "dictionary_scan": _DICTIONARY,
    "dictionary_grown": _DICTIONARY,
    "gen_word_grown": _pick_sql(duck.entry("value")),
    "gen_chunks": _plain_sql(_PROFILE_A, "chunk", _CHUNK_ROWS),
    "gen_batch": _plain_sql(_PROFILE_B, "batch", _BATCH_ROWS),
    "gen_keyed": _KEYED,
    "keyed_audit": f"WITH keyed AS ({_KEYED}) " + " UNION ALL ".join(
        _audit_sql(pos, spec, _KEYS.get(spec.name)) for pos, spec in enumerate(KEYED_SPECS, start=1)
    ),
    "gen_weighted": f"""
        SELECT {duck.weighted("country", COUNTRIES, *alias_table(list(COUNTRIES.values())))} AS country,
               count(*) AS rows FROM ({_EVENTS}) GROUP BY 1
    """,
    "gen_profile_a": _table_sql(_POSITIONAL_A, _ORDERS),
    "gen_profile_b": _table_sql(_TIMED_B, _EVENTS),
    "gen_profile_b_shuffled": _table_sql(_TIMED_B, _EVENTS),
    "chunk_job": _table_sql(_POSITIONAL_A, _CHUNK_ROWS),
    "batch_job": _table_sql(_TIMED_B, _JOB_BATCH_ROWS),
    "slice_job": _table_sql(_PROFILE_A, _JOB_SLICE_ROWS, "printf('slice-%03d', slice_num) AS slice, "),
    "slice_resume": _table_sql(_PROFILE_A, _JOB_SLICE_ROWS, "printf('slice-%03d', slice_num) AS slice, "),
    "chunked_write_summary": f"""
        SELECT chunk, count(*) AS records, CAST(sum(page_views) AS BIGINT) AS page_views,
               count(*) FILTER (is_logged_in) AS logged_in, min(utc_date) AS first_date,
               CAST(sum(length(property_name)) AS BIGINT) AS name_letters,
               CAST(sum(ascii(property_id)) AS BIGINT) AS id_codes
        FROM ({_table_sql(_PROFILE_A, _ORDERS_IN_CHUNKS, "chunk, ")}) GROUP BY chunk
    """,
    "batch_append": f"""
        SELECT sob, count(*) AS records, count(DISTINCT batch) AS batches,
               CAST(sum(page_views) AS BIGINT) AS page_views,
               CAST(sum(length(core_action)) AS BIGINT) AS action_letters
        FROM ({_table_sql(_PROFILE_B, _EVENTS, "batch, ")}) GROUP BY sob
    """,
}

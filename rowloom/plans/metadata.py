"""Column specs: dispatched, typed, extracted from DDL, stored and audited."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.values import constant_array
from rowloom.operators.audit import audit, audit_by_hash
from rowloom.operators.rules import PROFILE_A, PROFILE_B, Profile, generator_column, type_column
from rowloom.plans.inputs import spread_table, table
from rowloom.sources import ddl, specs
from rowloom.sources.specs import ColumnSpec
from rowloom.storage import scratch_path

# Suffixes and types that the parts give their column specs, so that every rule is met.
SUFFIXES = ("_id", "_ID", "_Id", "_sob", "_SOB", "_name", "_Family", "_family", "_x")
TYPES = ("BIGINT", "BOOLEAN", "DATE", "DATETIME", "bigint", "CHARACTER VARYING", "VARCHAR", "TEXT")

DOCUMENT_SPECS = (
    ColumnSpec("doc_id", "BIGINT", not_null=True, primary_key=True),
    ColumnSpec("text", "CHARACTER VARYING", 2000, 2000, not_null=True, unique=True),
    ColumnSpec("lang", "CHARACTER VARYING", 2, 2, not_null=True),
    ColumnSpec("source", "CHARACTER VARYING", 3, 3),
    ColumnSpec("n_chars", "BIGINT", unique=True),
)


def _part_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column spec for each part."""
    key = F.col("p_partkey")
    suffix = F.get(constant_array(SUFFIXES), (key % len(SUFFIXES)).cast("int"))
    data_type = F.get(constant_array(TYPES), (F.col("p_size") % len(TYPES)).cast("int"))
    length = F.when(data_type == "CHARACTER VARYING", F.col("p_size"))
    return table(spark, sf_dir, "part").select(
        key.cast("int").alias("pos"),
        F.concat(F.translate("p_name", " ", "_"), suffix).alias("name"),
        data_type.alias("data_type"),
        length.alias("length"),
        length.alias("precision"),
        (F.col("p_size") % 2 == 0).alias("not_null"),
        (key % 5 == 0).alias("primary_key"),
        (key % 7 == 0).alias("unique"),
        F.lit(specs.DEFAULT_GENERATOR).alias("generator"),
    )


def _dispatch(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    kind = generator_column(F.col("name"), F.col("data_type"), profile)
    return _part_specs(spark, sf_dir).select("pos", "name", "data_type", kind.alias("generated_by"))


def rule_dispatch_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dispatch(spark, sf_dir, PROFILE_A)


def rule_dispatch_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dispatch(spark, sf_dir, PROFILE_B)


def spec_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = [type_column(F.col("data_type"), profile) for profile in (PROFILE_A, PROFILE_B)]
    return _part_specs(spark, sf_dir).select("pos", typed[0].alias("type_a"), typed[1].alias("type_b"))


def spec_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return specs.type_projection(_part_specs(spark, sf_dir))


def spec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "specs")
    specs.write_specs(_part_specs(spark, sf_dir), path)
    return specs.read_specs(spark, path)


def _ddl_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CREATE TABLE statements for each part, with comments, quoted names and texts, nested defaults and index clauses."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    text = F.concat(
        F.lit("-- create table old (a int)\nCREATE TABLE item_"), key, F.lit("\n(\n code_"), key,
        F.lit(" character varying("), size,
        F.lit(")  encode lzo  PRIMARY KEY ,\n Brand CHARACTER  VARYING("), size + 10,
        F.lit(") default 'x,)' encode bytedict not null,\n price numeric("), size + 20,
        F.lit(", 2) default (coalesce(f(1), 0)) encode lzo , -- not null, unique\n is_"),
        F.lower(F.translate("p_type", " ", "_")),
        F.lit(" boolean encode runlength ,\n stocked date "),
        F.when(size % 2 == 0, "unique").otherwise(""),
        F.lit(",\n)\nDISTSTYLE KEY\nDISTKEY(code_"), key, F.lit(")\nSORTKEY(stocked);\n"),
        F.lit('create table if not exists "store"."kept in" ("part, no '), key, F.lit('" bigint, note varchar ('), size,
        F.lit(") comment 'not null', deep int default "), F.repeat(F.lit("("), size + 1), F.lit("1, 2"),
        F.repeat(F.lit(")"), size + 1), F.lit(" unique, owner char("), size,
        F.lit(r") default E'it\'s, (' not null, code text default $in$ '), not null, ( $in$ comment 'a\\', raw boolean default $$)$$, "),
        F.lit('key idx (note), primary key ("part, no '), key, F.lit('"));'),
    )
    parts = spread_table(spark, sf_dir, "part", "p_partkey", "p_size", "p_type")
    return parts.select(F.col("p_partkey").alias("ddl_id"), text.alias("ddl_text"))


def ddl_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ddl.extract_specs(_ddl_corpus(spark, sf_dir))


def ddl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The specs of each statement, written to a text document and read back from it."""
    documents = specs.spec_documents(ddl_extract(spark, sf_dir), "ddl_id", "statement")
    return specs.parse_documents(documents, "document")


def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), DOCUMENT_SPECS)


def constraint_audit_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same audit, with repeats looked for among hashes first."""
    return audit_by_hash(table(spark, sf_dir, "documents"), DOCUMENT_SPECS)


QUERIES = {
    "rule_dispatch_a": rule_dispatch_a,
    "rule_dispatch_b": rule_dispatch_b,
    "spec_types": spec_types,
    "spec_projection": spec_projection,
    "spec_roundtrip": spec_roundtrip,
    "ddl_extract": ddl_extract,
    "ddl_documents": ddl_documents,
    "constraint_audit": constraint_audit,
    "constraint_audit_hashed": constraint_audit_hashed,
}


def _listed(texts: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{text}'" for text in texts) + "]"


_PART_SPECS = f"""
    SELECT *, CASE WHEN data_type = 'CHARACTER VARYING' THEN p_size END AS length,
           CASE WHEN data_type = 'CHARACTER VARYING' THEN p_size END AS "precision",
           p_size % 2 = 0 AS not_null, p_partkey % 5 = 0 AS primary_key, p_partkey % 7 = 0 AS "unique",
           'randomize' AS generator
    FROM (SELECT *, CAST(p_partkey AS INTEGER) AS pos,
                 replace(p_name, ' ', '_') || ({_listed(SUFFIXES)})[p_partkey % {len(SUFFIXES)} + 1] AS name,
                 ({_listed(TYPES)})[p_size % {len(TYPES)} + 1] AS data_type
          FROM part)
"""
_SPEC_FIELDS = 'name, data_type, length, "precision", not_null, primary_key, "unique", generator'
_BY_TYPE = """
    WHEN data_type = 'BIGINT' THEN 'integer' WHEN data_type = 'BOOLEAN' THEN 'boolean'
    WHEN data_type = 'DATE' THEN 'date' WHEN data_type = 'DATETIME' THEN 'datetime'
"""
_TYPE_NAMES = """
    CASE data_type WHEN 'BIGINT' THEN '{}' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date'
                   WHEN 'DATETIME' THEN 'timestamp' ELSE 'string' END
"""
_DDL_COLUMNS = """
    SELECT p_partkey AS ddl_id, 1 AS statement, 1 AS pos, 'code_' || p_partkey AS name, 'CHARACTER VARYING' AS data_type,
           p_size AS length, p_size AS "precision", true AS not_null, true AS primary_key, false AS "unique",
           'randomize' AS generator FROM part
    UNION ALL SELECT p_partkey, 1, 2, 'Brand', 'CHARACTER VARYING', p_size + 10, p_size + 10,
           true, false, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 1, 3, 'price', 'NUMERIC', p_size + 20, p_size + 20,
           false, false, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 1, 4, 'is_' || lower(replace(p_type, ' ', '_')), 'BOOLEAN', NULL, NULL,
           false, false, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 1, 5, 'stocked', 'DATE', NULL, NULL,
           false, false, p_size % 2 = 0, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 2, 1, 'part, no ' || p_partkey, 'BIGINT', NULL, NULL,
           true, true, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 2, 2, 'note', 'VARCHAR', p_size, p_size,
           false, false, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 2, 3, 'deep', 'INT', NULL, NULL,
           false, false, true, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 2, 4, 'owner', 'CHAR', p_size, p_size,
           true, false, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 2, 5, 'code', 'TEXT', NULL, NULL,
           false, false, false, 'randomize' FROM part
    UNION ALL SELECT p_partkey, 2, 6, 'raw', 'BOOLEAN', NULL, NULL,
           false, false, false, 'randomize' FROM part
"""
_AUDIT = """
    SELECT 1 AS pos, 'doc_id' AS name, count(*) - count(doc_id) AS null_count,
           CAST(0 AS BIGINT) AS overlength_count,
           count(doc_id) - count(DISTINCT doc_id) AS duplicate_count FROM documents
    UNION ALL SELECT 2, 'text', count(*) - count(text), count(*) FILTER (length(text) > 2000),
           count(text) - count(DISTINCT text) FROM documents
    UNION ALL SELECT 3, 'lang', count(*) - count(lang), count(*) FILTER (length(lang) > 2), 0 FROM documents
    UNION ALL SELECT 4, 'source', 0, count(*) FILTER (length(source) > 3), 0 FROM documents
    UNION ALL SELECT 5, 'n_chars', 0, 0, count(n_chars) - count(DISTINCT n_chars) FROM documents
"""

ORACLES = {
    "rule_dispatch_a": f"""
        SELECT pos, name, data_type,
               CASE {_BY_TYPE} WHEN contains(lower(name), 'id') THEN 'hash_id'
                    WHEN contains(lower(name), 'sob') THEN 'sequence'
                    WHEN contains(lower(name), 'name') OR contains(lower(name), 'family') THEN 'person'
                    ELSE 'word' END AS generated_by
        FROM ({_PART_SPECS})
    """,
    "rule_dispatch_b": f"""
        SELECT pos, name, data_type,
               CASE {_BY_TYPE} WHEN regexp_matches(name, '(id|ID)') THEN 'hash_id'
                    WHEN regexp_matches(name, 'sob') THEN 'sequence'
                    WHEN regexp_matches(name, '(name|family)') THEN 'person'
                    ELSE 'sentence' END AS generated_by
        FROM ({_PART_SPECS})
    """,
    "spec_types": f"""
        SELECT pos, {_TYPE_NAMES.format("int")} AS type_a, {_TYPE_NAMES.format("bigint")} AS type_b
        FROM ({_PART_SPECS})
    """,
    "spec_projection": f"SELECT name, data_type, length FROM ({_PART_SPECS})",
    "spec_roundtrip": f"SELECT pos, {_SPEC_FIELDS} FROM ({_PART_SPECS})",
    "ddl_extract": _DDL_COLUMNS,
    "ddl_documents": _DDL_COLUMNS,
    "constraint_audit": _AUDIT,
    "constraint_audit_hashed": _AUDIT,
}

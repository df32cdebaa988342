"""Column specs: the description of a table's columns, itself kept as a table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The spec fields, and their order in a spec document.
SPEC_SCHEMA = (
    "pos int, name string, data_type string, length int, precision int, "
    "not_null boolean, primary_key boolean, unique boolean, generator string"
)
DOCUMENT_FIELDS = (
    "data_type", "generator", "length", "name", "not_null", "precision", "primary_key", "unique",
)
DEFAULT_GENERATOR = "randomize"
# The most columns that one table may have where its specs are held on the driver.
MAX_COLUMNS = 100_000


class ColumnSpec(NamedTuple):
    """One column of a table to generate or audit."""

    name: str
    data_type: str
    length: int | None = None
    precision: int | None = None
    not_null: bool = False
    primary_key: bool = False
    unique: bool = False
    generator: str = DEFAULT_GENERATOR


# The nine columns of the sample event table.
EVENT_SPECS = (
    ColumnSpec("property_id", "CHARACTER VARYING", 10, 10),
    ColumnSpec("property_name", "CHARACTER VARYING", 100, 100),
    ColumnSpec("sob", "CHARACTER VARYING", 40, 40, not_null=True, primary_key=True),
    ColumnSpec("is_logged_in", "BOOLEAN"),
    ColumnSpec("mobile_device_locale", "CHARACTER VARYING", 20, 20),
    ColumnSpec("page_views", "BIGINT"),
    ColumnSpec("property_family", "CHARACTER VARYING", 20, 20),
    ColumnSpec("utc_date", "DATE"),
    ColumnSpec("core_action", "CHARACTER VARYING", 20, 20),
)


def specs_table(spark: SparkSession, specs: tuple[ColumnSpec, ...] | list[ColumnSpec]) -> DataFrame:
    """Column specs as a table, numbered by position."""
    return spark.createDataFrame([(n, *spec) for n, spec in enumerate(specs, start=1)], SPEC_SCHEMA)


def collect_specs(table: DataFrame) -> list[ColumnSpec]:
    """The specs of one table in their order: metadata, one row per column.

    Positions that repeat, as those of several tables do, or more than ``MAX_COLUMNS`` rows are refused.
    """
    fields = [F.col(f"`{name}`") for name in ("pos", *ColumnSpec._fields)]
    rows = table.orderBy("pos").select(*fields).limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} column specs")
    if len({row["pos"] for row in rows}) < len(rows):
        raise ValueError("column specs of several tables: their positions repeat")
    return [ColumnSpec(*row[1:]) for row in rows]


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """Read a column-spec table kept as JSON lines."""
    return spark.read.schema(SPEC_SCHEMA).json(path)


def write_specs(specs: DataFrame, path: str) -> None:
    """Write a column-spec table as JSON lines."""
    specs.write.mode("overwrite").json(path)


def type_projection(specs: DataFrame) -> DataFrame:
    """The part of a spec that generation needs."""
    return specs.select("name", "data_type", "length")


# What a double-quoted scalar writes for a character; the backslash comes first.
ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _scalar(text: Column) -> Column:
    """A document scalar: quoted if it would read as something else, escaped if it holds control characters."""
    plain = text.rlike(r"^[A-Za-z_]([A-Za-z0-9_ $.-]*[A-Za-z0-9_$.-])?$") & ~text.rlike(r"[\r\n]")
    reserved = text.rlike(r"(?i)^(null|true|false|yes|no|on|off|y|n)$")
    single = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    escaped = text
    for character, written in ESCAPES:
        escaped = F.replace(escaped, F.lit(character), F.lit(written))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(plain & ~reserved, text).when(text.rlike(r"[\r\n\t]"), double).otherwise(single)


def _unquoted(value: Column) -> Column:
    """The text of a scalar in single quotes, double quotes or none."""
    inner = value.substr(F.lit(2), F.length(value) - 2)
    # Escaped backslashes stand aside while the other escapes are undone.
    double = F.replace(inner, F.lit("\\\\"), F.lit("\x01"))
    for character, written in ESCAPES[1:]:
        double = F.replace(double, F.lit(written), F.lit(character))
    double = F.replace(double, F.lit("\x01"), F.lit("\\"))
    single = F.replace(inner, F.lit("''"), F.lit("'"))
    return F.when(value.startswith("'"), single).when(value.startswith('"'), double).otherwise(value)


def spec_documents(specs: DataFrame, *keys: str) -> DataFrame:
    """One text document per table, from the specs of many tables.

    A group is the columns of one table, which its width bounds.
    """
    lines = []
    for name in DOCUMENT_FIELDS:
        field = F.col(name)
        text = _scalar(field) if name in ("data_type", "generator", "name") else field.cast("string")
        lines.append(F.concat(F.lit(f"{name}: "), F.coalesce(text, F.lit("null"))))
    item = F.concat(F.lit("- "), F.concat_ws("\n  ", *lines))
    ordered = F.sort_array(F.collect_list(F.struct("pos", item.alias("item"))))["item"]
    return specs.groupBy(*keys).agg(F.concat(F.lit("data:\n"), F.concat_ws("\n", ordered)).alias("document"))


def write_spec_document(specs: DataFrame, path: str) -> None:
    """Write the specs of one table as a text document; those of several tables are refused."""
    one = specs_table(specs.sparkSession, collect_specs(specs))
    spec_documents(one).write.mode("overwrite").text(path)


def parse_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Column specs from text documents: a ``data`` list of field maps, one field per line.

    Keeps the other columns of ``documents`` in front. Comment lines, a ``---`` line, both
    kinds of quotes and an empty list are read; items without a name are left out and do not
    count. A document of another form fails; it is no general reader of the format.
    """
    others = [name for name in documents.columns if name != column]
    lines = F.regexp_replace(F.col(column), r"(?m)^(?:[ \t]*#.*|---[ \t]*)(?:\r?\n|\z)|\r$", "")
    listed = F.regexp_replace(lines, r"\A\s*data:\s*\n\s*- ", "")
    unlike = F.raise_error(F.concat(F.lit("no list of column specs: "), F.substring(column, 1, 200)))
    items = (
        F.when(lines.rlike(r"\A\s*(?:data:\s*(?:\[\s*\]|null|~)?)?\s*\z"), F.array().cast("array<string>"))
        .when(lines.rlike(r"\A\s*data:\s*\n\s*- "), F.split(listed, r"\n\s*- "))
        .when(lines.isNotNull(), unlike)
    )
    named = F.filter(items, lambda item: item.rlike(r"(?m)^\s*name:"))
    pairs = F.str_to_map(F.regexp_replace(F.trim(F.col("item")), r"\n\s+", "\n"), F.lit("\n"), F.lit(": "))
    raw = {name: F.trim(F.element_at("pairs", F.lit(name))) for name in DOCUMENT_FIELDS}
    fields = (
        documents.select(*others, F.posexplode(named).alias("at", "item"))
        .select(*others, "at", pairs.alias("pairs"))
        .select(*others, "at", *[text.alias(f"raw_{name}") for name, text in raw.items()])
    )

    def text(name: str) -> Column:
        value = F.col(f"raw_{name}")
        return F.when(value != "null", _unquoted(value))

    def flag(name: str) -> Column:
        return F.coalesce(text(name).cast("boolean"), F.lit(False)).alias(name)

    return fields.select(
        *others,
        (F.col("at") + 1).cast("int").alias("pos"),
        text("name").alias("name"),
        text("data_type").alias("data_type"),
        text("length").cast("int").alias("length"),
        text("precision").cast("int").alias("precision"),
        *[flag(name) for name in ("not_null", "primary_key", "unique")],
        F.coalesce(text("generator"), F.lit(DEFAULT_GENERATOR)).alias("generator"),
    )


def read_spec_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read column specs from text documents, one document per file."""
    return parse_documents(spark.read.text(path, wholetext=True))

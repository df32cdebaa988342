"""CSV, tab-separated and Parquet files on any path Spark can open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructField, StructType

# The accepted write modes.
WRITE_MODES = ("append", "overwrite")


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read CSV with a header row.

    Types are inferred, which reads the files twice; give a ``schema`` for large data.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read Parquet files or a partitioned directory.

    Spark guesses the type of a partition column from its directory names. Give the
    ``schema`` to keep the type it was written with.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread_scan(scan: DataFrame) -> DataFrame:
    """Deal the rows of a small file scan out to all cores, before costly work on each row.

    A scan with at least a split per core is returned as it is, so large data is never
    moved. ``scan`` must hold no shuffle: asking for its partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def write_parquet(
    df: DataFrame, path: str, mode: str = "append", partition_by: str | None = None, regroup: bool = True
) -> None:
    """Append to or replace Parquet files, optionally in one directory per value of a column.

    A partitioned write from many tasks leaves a file per task and value. Rows are
    therefore regrouped by the column first. The rebalance hint lets adaptive execution
    split the shuffle partition of a frequent value and merge those of rare ones, so one
    value with most of the rows is still written by many tasks. Turn ``regroup`` off for
    rows that already lie in the order of the column, as a slice spine does.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {', '.join(WRITE_MODES)}, not {mode!r}")
    if partition_by is None:
        df.write.mode(mode).parquet(path)
        return
    rows = df.hint("rebalance", partition_by) if regroup else df
    rows.write.mode(mode).partitionBy(partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Write a folder per value of a column in place of those of the same values; other folders stay.

    ``df`` must not read what it replaces: a retried task would meet the new files.
    """
    rows = df.hint("rebalance", partition_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def split_lines(
    lines: DataFrame, schema: StructType | str, sep: str = ",", column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Separated lines as rows of a schema, and the lines that are none as ``line`` and ``reason``.

    A reason names the columns whose type can't hold their field, or says that the fields
    are not as many as the columns. Lines of spaces only, and null lines, are in neither
    result; any other line is in just one. Every field of a line decides, whichever columns
    are read afterwards, which a pruned CSV scan doesn't promise. No field holds a line break.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = [field.name for field in schema.fields]
    options = {"sep": sep, "columnNameOfCorruptRecord": "__unreadable"}

    def parsed(types: list[str]) -> Column:
        listed = ", ".join(f"__{n} {data_type}" for n, data_type in enumerate(types))
        return F.from_csv("__line", f"{listed}, __unreadable string", options)

    kept = lines.select(F.col(f"`{column}`").alias("__line")).where(F.trim("__line") != "")
    # A filter can't move below a generator, so each line is parsed once.
    read = kept.select("__line", F.inline(F.array(parsed([field.dataType.simpleString() for field in schema.fields]))))
    good = read.where(F.col("__unreadable").isNull())
    bad = read.where(F.col("__unreadable").isNotNull()).withColumn("texts", parsed(["string"] * len(names)))
    unheld = [
        F.when(F.col(f"__{n}").isNull() & F.col(f"texts.__{n}").isNotNull(), F.lit(name)) for n, name in enumerate(names)
    ]
    reason = (
        F.when(F.col("texts.__unreadable").isNotNull(), F.lit(f"not {len(names)} fields"))
        .otherwise(F.concat(F.lit("not of its type: "), F.concat_ws(", ", *unheld)))
    )
    return (
        good.select(*[F.col(f"__{n}").alias(name) for n, name in enumerate(names)]),
        bad.select(F.col("__line").alias("line"), reason.alias("reason")),
    )


def _tsv_options(multi_line: bool) -> dict[str, object]:
    options: dict[str, object] = {"sep": "\t"}
    if multi_line:
        options |= {"lineSep": "\n", "escape": '"', "emptyValue": '""', "nullValue": ""}
        options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return options


# What stands for a null field and for the characters that would end a field or a line.
NULL_FIELD = "\\N"
ESCAPES = {"\t": "\\t", "\n": "\\n", "\r": "\\r"}


def _escaped(field: StructField) -> Column:
    """A value as text without tabs and line breaks: a backslash and a letter stand for them."""
    if isinstance(field.dataType, (ArrayType, MapType, StructType, BinaryType)):
        raise ValueError(f"column {field.name!r} of type {field.dataType.simpleString()} has no text form")
    text = F.replace(F.col(f"`{field.name}`").cast("string"), F.lit("\\"), F.lit("\\\\"))
    for plain, code in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.coalesce(text, F.lit(NULL_FIELD))


def _unescaped(text: Column) -> Column:
    """The text that a field stands for; double backslashes part it first, so no code is read across them."""

    def decode(part: Column) -> Column:
        for plain, code in ESCAPES.items():
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), decode), "\\")
    return F.when(text != NULL_FIELD, F.when(text.contains("\\"), whole).otherwise(text))


def write_tsv(df: DataFrame, path: str, multi_line: bool = False, escaped: bool = False) -> None:
    """Append tab-separated text without a header.

    Two forms keep every text as it was, with its outer white space, line breaks, quotes and
    backslashes, and empty apart from null; ``read_tsv`` needs the same choice. ``escaped``
    writes tabs and line breaks as a backslash and a letter, so that a line is a row and many
    tasks can read one file. ``multi_line`` leaves them in quotes, for readers that know these.
    """
    if not escaped:
        df.write.mode("append").options(**_tsv_options(multi_line)).csv(path)
        return
    line = F.concat_ws("\t", *(_escaped(field) for field in df.schema.fields))
    df.select(line.alias("value")).write.mode("append").option("lineSep", "\n").text(path)


def read_tsv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False, escaped: bool = False
) -> DataFrame:
    """Read tab-separated text without a header.

    With ``multi_line`` a quoted text may hold line breaks; a file is then read by one task.
    With ``escaped`` files are split among tasks; a line with fewer fields than columns ends in
    nulls, and a field that its column's type can't hold fails the job in ANSI mode.
    """
    if escaped:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        lines = spark.read.option("lineSep", "\n").text(path).select(F.split("value", "\t").alias("fields"))
        return lines.select(
            *(
                _unescaped(F.get("fields", F.lit(at))).cast(field.dataType).alias(field.name)
                for at, field in enumerate(schema.fields)
            )
        )
    # A field without quotes is read as the null value, and what equals it is null: so no text may.
    options = _tsv_options(multi_line) | ({"emptyValue": "", "nullValue": "\0"} if multi_line else {})
    return spark.read.schema(schema).options(multiLine=multi_line, **options).csv(path)

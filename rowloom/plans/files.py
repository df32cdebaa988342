"""Round trips through files and catalog tables, and first looks."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.inspection import describe_schema, preview
from rowloom.plans.inputs import table
from rowloom.sources import catalog, files
from rowloom.storage import scratch_path


def _customers_as_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "customer").write.csv(path, header=True)
    return files.read_csv(spark, path)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers_as_csv(spark, sf_dir)


def schema_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema that a scan of the whole CSV data infers."""
    return describe_schema(_customers_as_csv(spark, sf_dir))


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "from-csv")
    files.write_parquet(_customers_as_csv(spark, sf_dir), path)
    return files.read_parquet(spark, path)


def parquet_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "append")
    files.write_parquet(orders, path)
    files.write_parquet(orders, path)
    return files.read_parquet(spark, path)


def parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    files.write_parquet(table(spark, sf_dir, "events"), path)
    files.write_parquet(table(spark, sf_dir, "orders"), path, "overwrite")
    return files.read_parquet(spark, path)


def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "partitioned")
    files.write_parquet(orders, path, partition_by="o_orderstatus")
    files.write_parquet(orders, path, partition_by="o_orderstatus")
    return files.read_parquet(spark, path, orders.schema)


def tsv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, path = table(spark, sf_dir, "customer"), scratch_path(spark, "tsv")
    files.write_tsv(customers, path)
    files.write_tsv(customers, path)
    return files.read_tsv(spark, path, customers.schema)


def tsv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and all, appended to text twice and read back."""
    documents, path = table(spark, sf_dir, "documents"), scratch_path(spark, "tsv-documents")
    files.write_tsv(documents, path, escaped=True)
    files.write_tsv(documents, path, escaped=True)
    return files.read_tsv(spark, path, documents.schema, escaped=True)


def tsv_quoted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with line breaks left in quotes, for readers that know these."""
    documents, path = table(spark, sf_dir, "documents"), scratch_path(spark, "tsv-quoted")
    files.write_tsv(documents, path, multi_line=True)
    files.write_tsv(documents, path, multi_line=True)
    return files.read_tsv(spark, path, documents.schema, multi_line=True)


def _order_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The orders as lines, some of them cut, lengthened or with a word in place of a number, read again."""
    key = F.col("o_orderkey")
    line = F.concat_ws(
        "|", key.cast("string"), F.when(key % 11 == 3, "none").otherwise(F.col("o_custkey").cast("string")),
        F.when(key % 13 == 5, F.lit("")).otherwise(F.col("o_orderstatus")),
        F.when(key % 22 == 3, "1,5").otherwise(F.lit("7")), F.col("o_orderpriority"),
    )
    damaged = (
        F.when(key % 17 == 4, F.substring_index(line, "|", 3))
        .when(key % 19 == 6, F.concat(line, F.lit("|more")))
        .when(key % 23 == 7, F.lit(" "))
        .otherwise(line)
    )
    path = scratch_path(spark, "order-lines")
    table(spark, sf_dir, "orders").select(damaged).write.text(path)
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, n int, o_orderpriority string"
    return files.split_lines(spark.read.text(path), schema, "|")


def lines_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir)[0]


def lines_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir)[1]


def lines_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines each reason rejects, and how many are rows, without reading a field of these."""
    good, bad = _order_lines(spark, sf_dir)
    rows = good.select(F.lit("accepted").alias("outcome"))
    return rows.unionAll(bad.select("reason")).groupBy("outcome").agg(F.count("*").alias("lines"))


def catalog_clone_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clone the customers' columns into an empty table, load their text twice and read the table.

    The table is external: dropping its name leaves the files, which the result reads.
    """
    customers, path = table(spark, sf_dir, "customer"), scratch_path(spark, "load")
    customers.write.csv(path, sep=catalog.FIELD_SEPARATOR)
    source, name = (f"rowloom_{part}_{uuid4().hex}" for part in ("source", "clone"))
    customers.createTempView(source)
    catalog.create_table(spark, name, like=source, path=scratch_path(spark, "table"))
    spark.catalog.dropTempView(source)
    catalog.load_data(spark, name, path)
    catalog.load_data(spark, name, path)
    rows = catalog.query_table(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def order_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), "o_orderkey")


QUERIES = {
    "csv_scan": csv_scan,
    "schema_describe": schema_describe,
    "csv_to_parquet": csv_to_parquet,
    "parquet_append": parquet_append,
    "parquet_overwrite": parquet_overwrite,
    "partitioned_append": partitioned_append,
    "tsv_append": tsv_append,
    "tsv_documents": tsv_documents,
    "tsv_quoted_documents": tsv_quoted_documents,
    "lines_accepted": lines_accepted,
    "lines_rejected": lines_rejected,
    "lines_counted": lines_counted,
    "catalog_clone_load": catalog_clone_load,
    "preview": order_preview,
}

_CUSTOMERS_FROM_TEXT = """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
"""
_LINES = """
    SELECT *, CASE WHEN o_orderkey % 17 = 4 THEN array_to_string(string_split(line, '|')[:3], '|')
                   WHEN o_orderkey % 19 = 6 THEN line || '|more'
                   WHEN o_orderkey % 23 = 7 THEN ' ' ELSE line END AS written,
           CASE WHEN o_orderkey % 17 = 4 OR o_orderkey % 19 = 6 THEN 'not 5 fields'
                WHEN o_orderkey % 23 = 7 THEN 'empty'
                WHEN o_orderkey % 22 = 3 THEN 'not of its type: o_custkey, n'
                WHEN o_orderkey % 11 = 3 THEN 'not of its type: o_custkey' ELSE 'accepted' END AS reason
    FROM (SELECT *, concat_ws('|', o_orderkey, CASE WHEN o_orderkey % 11 = 3 THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END,
                              CASE WHEN o_orderkey % 13 = 5 THEN '' ELSE o_orderstatus END,
                              CASE WHEN o_orderkey % 22 = 3 THEN '1,5' ELSE '7' END, o_orderpriority) AS line
          FROM orders)
"""
ORACLES = {
    "csv_scan": _CUSTOMERS_FROM_TEXT,
    "schema_describe": """
        SELECT * FROM (VALUES (1, 'c_custkey', 'int', true), (2, 'c_name', 'string', true),
            (3, 'c_nationkey', 'int', true), (4, 'c_acctbal', 'double', true),
            (5, 'c_mktsegment', 'string', true)) AS columns(pos, name, type, nullable)
    """,
    "csv_to_parquet": _CUSTOMERS_FROM_TEXT,
    "parquet_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "parquet_overwrite": "SELECT * FROM orders",
    "partitioned_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "tsv_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "tsv_documents": "SELECT * FROM documents UNION ALL SELECT * FROM documents",
    "tsv_quoted_documents": "SELECT * FROM documents UNION ALL SELECT * FROM documents",
    "lines_accepted": f"""
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 <> 5 THEN o_orderstatus END AS o_orderstatus,
               CAST(7 AS INTEGER) AS n, o_orderpriority
        FROM ({_LINES}) WHERE reason = 'accepted'
    """,
    "lines_rejected": f"""
        SELECT written AS line, reason FROM ({_LINES}) WHERE reason NOT IN ('accepted', 'empty')
    """,
    "lines_counted": f"SELECT reason AS outcome, count(*) AS lines FROM ({_LINES}) WHERE reason <> 'empty' GROUP BY 1",
    "catalog_clone_load": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
}

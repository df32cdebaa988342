"""Files, catalog tables, object-store settings, inspection and the scratch folder."""

from __future__ import annotations

from datetime import datetime
import pytest
from pyspark.sql import functions as F

from rowloom import storage
from rowloom.operators.inspection import describe_schema, preview
from rowloom.sources import catalog, files, s3a
from tests.conftest import plan_of


def test_csv_infers_types_and_takes_a_schema(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,score,day\n1,"a, b",2.5,2024-01-02\n2,,3,2024-01-03\n')
    df = files.read_csv(spark, str(path))
    assert df.dtypes == [("id", "int"), ("name", "string"), ("score", "double"), ("day", "date")]
    assert df.first().name == "a, b"
    given = files.read_csv(spark, str(path), "id long, name string, score string, day string")
    assert given.dtypes[0] == ("id", "bigint") and given.count() == 2


def test_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,text\n1,"two\nlines"\n')
    assert files.read_csv(spark, str(path), multi_line=True).first().text == "two\nlines"


def test_append_doubles_and_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    for expected, mode in [(20, "append"), (40, "append"), (20, "overwrite")]:
        files.write_parquet(spark.range(20), path, mode)
        assert files.read_parquet(spark, path).count() == expected


@pytest.mark.parametrize("mode", ["ignore", "error", ""])
def test_other_modes_are_refused(spark, tmp_path, mode):
    with pytest.raises(ValueError):
        files.write_parquet(spark.range(1), str(tmp_path / "out"), mode)
    assert not (tmp_path / "out").exists()


def test_partitioned_append(spark, tmp_path):
    df = spark.range(20).select("id", (F.col("id") % 4).cast("string").alias("part"))
    for _ in range(2):
        files.write_parquet(df, str(tmp_path / "out"), partition_by="part")
    assert {entry.name for entry in (tmp_path / "out").iterdir() if entry.is_dir()} == {f"part={n}" for n in range(4)}
    assert dict(files.read_parquet(spark, str(tmp_path / "out")).dtypes)["part"] == "int"
    back = files.read_parquet(spark, str(tmp_path / "out"), df.schema)
    assert dict(back.dtypes)["part"] == "string" and back.count() == 40
    assert "PartitionFilters: [isnotnull(part" in plan_of(back.where("part = '3'"))


def test_frequent_partition_value_is_split(spark, tmp_path):
    """One value with most of the rows is written by several tasks."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64KB")
    try:
        part = F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("part")
        df = spark.range(0, 400_000, 1, 8).select("id", part)
        files.write_parquet(df, str(tmp_path / "out"), partition_by="part")
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "out" / "part=hot").glob("*.parquet"))) > 3
    assert files.read_parquet(spark, str(tmp_path / "out")).count() == 400_000


def test_only_small_scans_are_spread(spark, tmp_path):
    for parts in (1, 64):
        spark.range(0, 6400, 1, parts).write.parquet(str(tmp_path / str(parts)))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(32 << 20))
    try:
        small, large = (spark.read.parquet(str(tmp_path / name)) for name in ("1", "64"))
        assert "RoundRobin" in plan_of(files.spread_scan(small)) and files.spread_scan(small).count() == 6400
        assert "Exchange" not in plan_of(files.spread_scan(large))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_tsv_has_tabs_and_no_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "x\ty")], "n int, t string")
    for _ in range(2):
        files.write_tsv(df.coalesce(1), str(tmp_path / "out"))
    lines = [line for part in (tmp_path / "out").glob("*.csv") for line in part.read_text().splitlines()]
    assert sorted(lines)[:2] == ["1\ta", "1\ta"] and len(lines) == 6
    assert sorted(files.read_tsv(spark, str(tmp_path / "out"), df.schema).collect()) == sorted(df.collect() * 2)


def test_catalog_table_life(spark, tmp_path):
    source = spark.createDataFrame([(1, "a")], "key int, value string")
    source.createOrReplaceTempView("kv_source")
    catalog.create_table(spark, "kv_clone", like="kv_source")
    catalog.create_table(spark, "kv_schema", schema=source.schema)
    try:
        for name in ("kv_clone", "kv_schema"):
            assert catalog.query_table(spark, name).count() == 0
            assert catalog.query_table(spark, name).dtypes == source.dtypes
        (tmp_path / "kv.txt").write_text("238\x01val_238\n86\x01val_86\n")
        for expected in (2, 4):
            catalog.load_data(spark, "kv_clone", str(tmp_path / "kv.txt"))
            assert catalog.query_table(spark, "kv_clone").count() == expected
        catalog.create_table(spark, "kv_clone", like="kv_source")
        assert catalog.query_table(spark, "kv_clone").count() == 4
        assert sorted(map(tuple, catalog.query_table(spark, "kv_clone").distinct().collect())) == [
            (86, "val_86"), (238, "val_238")]
    finally:
        spark.sql("DROP TABLE kv_clone")
        spark.sql("DROP TABLE kv_schema")


def test_loaded_text_is_taken_literally(spark, tmp_path):
    catalog.create_table(spark, "kv_text", schema=spark.range(0).selectExpr("1 AS k", "'' AS v", "1.5D AS d").schema)
    (tmp_path / "kv.txt").write_text('1|"q|2.5|extra\n2||x\n\\N|\\N|\\N\nz|a\n')
    try:
        catalog.load_data(spark, "kv_text", str(tmp_path / "kv.txt"), "|")
        found = [tuple(row) for row in catalog.query_table(spark, "kv_text").collect()]
    finally:
        spark.sql("DROP TABLE kv_text")
    assert sorted(found, key=repr) == sorted(
        [(1, '"q', 2.5), (2, "", None), (None, None, None), (None, "a", None)], key=repr)


def test_table_needs_one_model(spark):
    with pytest.raises(ValueError):
        catalog.create_table(spark, "nothing")


def test_no_rows_scans_nothing(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    plan = plan_of(catalog.no_rows(spark.read.parquet(str(tmp_path / "t"))))
    assert "FileScan" not in plan


def test_s3a_settings():
    settings = s3a.s3a_settings(*s3a.credentials({"ACCESS_KEY": "a", "SECRET_KEY": "s"}), endpoint="store.example")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "store.example"
    assert settings["spark.hadoop.fs.s3a.access.key"] == "a" and settings["spark.hadoop.fs.s3a.secret.key"] == "s"
    assert settings["spark.hadoop.fs.s3a.impl"].endswith("S3AFileSystem")


@pytest.mark.parametrize("environment", [{}, {"ACCESS_KEY": "a"}, {"ACCESS_KEY": "a", "SECRET_KEY": ""}])
def test_missing_credentials(environment):
    with pytest.raises(ValueError):
        s3a.credentials(environment)
    assert len(s3a.credentials(environment, required=False)) == 2



def test_scratch_paths_are_fresh_and_shared(spark):
    first, second = storage.scratch_path(spark, "x"), storage.scratch_path(spark, "x")
    assert first != second and first.startswith(storage.shared_dir(spark))


class _Session:
    """Just enough of a session to ask where its shared folder is."""

    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_configured_folder_wins_and_clusters_must_have_one():
    assert storage.shared_dir(_Session("hdfs://shared/dir/", "yarn")) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError):
        storage.shared_dir(_Session(None, "yarn"))


def test_tab_separated_texts_come_back_as_written(spark, tmp_path):
    texts = ["a\nb", " lead", "trail ", 'say "x"', "back\\slash", '\\"', "tab\there", "", None, "cr\r\nlf", "\n", '"', "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    files.write_tsv(df, str(tmp_path / "out"), multi_line=True)
    back = files.read_tsv(spark, str(tmp_path / "out"), df.schema, multi_line=True)
    assert dict(back.collect()) == dict(enumerate(texts))


TEXTS = ["a\nb", " lead", "trail ", 'say "x"', "back\\slash", "\\n", "\\\\n", "\\\n", "\\", "\\N", "\\\\N", "tab\there", "", None, "cr\r\nlf", "\n", "\x85\u2028"]


def test_escaped_text_comes_back_as_written(spark, tmp_path):
    rows = [(n, t, None if n % 3 else n / 7, n % 2 == 0, datetime(2024, 1, 1, 1, 2, 3, n), t) for n, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "n int, text string, `a.b` double, flag boolean, at timestamp, last string")
    path = str(tmp_path / "out")
    files.write_tsv(df, path, escaped=True)
    files.write_tsv(df, path, escaped=True)
    for schema in (df.schema, "n int, text string, `a.b` double, flag boolean, at timestamp, last string"):
        back = files.read_tsv(spark, path, schema, escaped=True)
        assert back.dtypes == df.dtypes
        assert sorted(map(repr, back.collect())) == sorted(map(repr, [*df.collect(), *df.collect()]))
    one = spark.createDataFrame([("",), (None,), ("\n",)], "text string")
    files.write_tsv(one, str(tmp_path / "one"), escaped=True)
    assert sorted(files.read_tsv(spark, str(tmp_path / "one"), "text string", escaped=True).collect(), key=repr) == sorted(one.collect(), key=repr)
    files.write_tsv(one.limit(0), str(tmp_path / "none"), escaped=True)
    assert files.read_tsv(spark, str(tmp_path / "none"), "text string", escaped=True).count() == 0


def test_many_tasks_read_one_escaped_file(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "concat('line', id, '\\n', repeat('x', 100), '\\nend') AS text").coalesce(1)
    files.write_tsv(df, str(tmp_path / "out"), escaped=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = files.read_tsv(spark, str(tmp_path / "out"), df.schema, escaped=True)
        assert len(list((tmp_path / "out").glob("part-*"))) == 1 and back.rdd.getNumPartitions() >= 8
        assert sorted(back.collect()) == sorted(df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_values_without_a_text_form_are_refused(spark, tmp_path):
    for kind in ("array<int>", "binary", "struct<a: int>"):
        with pytest.raises(ValueError, match="text form"):
            files.write_tsv(spark.createDataFrame([], f"v {kind}"), str(tmp_path / "out"), escaped=True)


def test_lines_that_are_short_end_in_nulls(spark, tmp_path):
    (tmp_path / "t").write_text("1\ta\n2\n")
    assert files.read_tsv(spark, str(tmp_path / "t"), "n int, text string", escaped=True).collect() == [(1, "a"), (2, None)]


LINES = [
    ("1|a|2020-01-01", None), ("x|b|2020-01-01", "not of its type: n"), ("1|b", "not 3 fields"),
    ("1|b|2020-01-01|zz", "not 3 fields"), ("", ""), ("   ", ""), (None, ""), ("||", None),
    ('2|"q|uo"|2020-13-01', "not of its type: value"), ('3|"q|uo"|2020-12-01', None), ("y||z", "not of its type: n, value"),
    ('3|"open|2020-01-01', "not 3 fields"), ("9999999999|a|2020-01-01", "not of its type: n"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lines_are_rows_or_rejected_with_a_reason(spark, ansi):
    lines = spark.createDataFrame([(line, 1) for line, _ in LINES], "value string, extra int")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good, bad = files.split_lines(lines, "n int, line string, value date", "|")
        assert [tuple(row) for row in bad.collect()] == [(line, reason) for line, reason in LINES if reason]
        assert [(row.n, row.line, str(row.value)) for row in good.collect()] == [
            (1, "a", "2020-01-01"), (None, None, "None"), (3, "q|uo", "2020-12-01"),
        ]
        # Counts, and reads of one column, see the same lines.
        assert (good.count(), bad.count(), good.select("line").count()) == (3, 7, 3)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_no_lines_give_no_rows(spark):
    good, bad = files.split_lines(spark.createDataFrame([], "text string"), "a int", column="text")
    assert (good.columns, bad.columns, good.count(), bad.count()) == (["a"], ["line", "reason"], 0, 0)


def test_lines_are_parsed_once(spark):
    good, _ = files.split_lines(spark.createDataFrame([("1,2",)], "value string"), "a int, b int")
    assert plan_of(good).count("from_csv") == 1


def test_replaced_partitions_leave_others(spark, tmp_path):
    path = str(tmp_path / "kept")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "part string, n int")
    files.write_parquet(rows, path, partition_by="part")
    files.replace_partitions(spark.createDataFrame([("a", 9), ("c", 4)], "part string, n int"), path, "part")
    assert sorted((row.part, row.n) for row in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3), ("c", 4)]

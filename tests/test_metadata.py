"""Column specs: DDL extraction, documents, tables and audits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowloom.operators import audit as audits
from rowloom.operators.audit import audit, audit_by_hash
from rowloom.sources import ddl, specs
from rowloom.sources.specs import EVENT_SPECS, ColumnSpec

# A statement that declares the columns of the sample event table, with its habits:
# storage hints, a key after a hint, a trailing comma and clauses after the body.
CODECS = ("lzo", "runlength", "bytedict")


def _declared(number: int, spec: ColumnSpec) -> str:
    kind = spec.data_type.lower() + (f"({spec.length})" if spec.length else "")
    codec = "" if spec.data_type == "DATE" else f" encode {CODECS[number % len(CODECS)]}"
    return f"\t{spec.name} {kind}{codec}{' primary key' if spec.primary_key else ''}"


EVENT_DDL = (
    "create table visits (\n"
    + ",\n".join(_declared(n, spec) for n, spec in enumerate(EVENT_SPECS))
    + ",\n) diststyle key distkey(sob) sortkey(utc_date);"
)

# Fixed value: the layout of a spec document.
TWO_COLUMNS = """data:
- data_type: CHARACTER VARYING
  generator: randomize
  length: 40
  name: sob
  not_null: true
  precision: 40
  primary_key: true
  unique: false
- data_type: BIGINT
  generator: randomize
  length: null
  name: page_views
  not_null: false
  precision: null
  primary_key: false
  unique: false
"""


def extract(spark, text):
    return ddl.extract_specs(spark.createDataFrame([(1, text)], "ddl_id int, ddl_text string"))


def test_sample_statement(spark):
    assert specs.collect_specs(extract(spark, EVENT_DDL)) == list(EVENT_SPECS)


def test_other_statements(spark):
    text = """CREATE TEMPORARY TABLE IF NOT EXISTS "app"."t" (
        "Key" int not null unique, b numeric(10, 2) default f(3), `c` double precision,
        d timestamp without time zone, e varchar ( 7 ), f int default g(9),
        constraint pk primary key ("Key", `c`), unique (E), foreign key (b) references o(x))"""
    assert specs.collect_specs(extract(spark, text)) == [
        ColumnSpec("Key", "INT", None, None, True, True, True),
        ColumnSpec("b", "NUMERIC", 10, 10),
        ColumnSpec("c", "DOUBLE PRECISION", None, None, True, True),
        ColumnSpec("d", "TIMESTAMP WITHOUT TIME ZONE"),
        ColumnSpec("e", "VARCHAR", 7, 7, unique=True),
        ColumnSpec("f", "INT"),
    ]


def found(spark, text):
    return [(r.statement, r.pos, r.name, r.data_type) for r in extract(spark, text).collect()]


def test_text_without_a_table_has_no_columns(spark):
    for text in ("DROP TABLE t", "", None, "create table t as select f(a) from x", "-- create table t (a int)"):
        assert extract(spark, text).count() == 0


def test_nested_defaults_and_quoted_marks(spark):
    text = "create table t (a int default (nextval('s')), b varchar(3) default 'x,y', c text default ')', d int)"
    assert found(spark, text) == [(1, 1, "a", "INT"), (1, 2, "b", "VARCHAR"), (1, 3, "c", "TEXT"), (1, 4, "d", "INT")]


def test_several_statements(spark):
    text = "create table t (a int);\nCREATE  TABLE\nx.u (b date, c int);"
    assert found(spark, text) == [(1, 1, "a", "INT"), (2, 1, "b", "DATE"), (2, 2, "c", "INT")]


def test_comments(spark):
    text = "create table t (a int, -- first, not null\n b int /* unique, ( */, c int)"
    rows = extract(spark, text).collect()
    assert [(r.name, r.not_null, r.unique) for r in rows] == [(n, False, False) for n in "abc"]


def test_keywords_count_outside_of_texts_and_parentheses(spark):
    text = "create table t (a text default 'not null', b text comment 'unique value', c int check (c is not null))"
    assert not [r for r in extract(spark, text).collect() if r.not_null or r.unique]


def test_index_clauses_and_names_like_them(spark):
    text = "create table t (a int, key idx (a), index i2 (a), unique key u (a), key varchar(5), fulltext key f (a))"
    rows = extract(spark, text).collect()
    assert [(r.name, r.data_type, r.length, r.unique) for r in rows] == [
        ("a", "INT", None, True), ("key", "VARCHAR", 5, False)
    ]


def test_quoted_names(spark):
    text = """create table "my t" ("my col" varchar(5), `a,b` int, [c d] int, "e""(f" int, primary key ("my col", [c d]))"""
    rows = extract(spark, text).collect()
    assert [(r.name, r.data_type, r.primary_key) for r in rows] == [
        ("my col", "VARCHAR", True), ("a,b", "INT", False), ("c d", "INT", True), ('e"(f', "INT", False)
    ]


def test_an_unread_column_list_fails(spark):
    for text in ("create table t (a int", "create table t (a int default (1)", "create table t (a int, create table u (b int)"):
        with pytest.raises(Exception, match="column list without an end"):
            extract(spark, text).count()


@pytest.mark.parametrize("depth", [1, 8, 9, 50, 400])
def test_parentheses_nest_to_any_depth(spark, depth):
    deep = "f(1, " * depth + "x" + ", y)" * depth
    text = f"create table t (a int default {deep} not null, b varchar(7) check ({deep}), primary key (a, b(3))); {deep}"
    rows = {r.name: r for r in extract(spark, f"{text} create table u (c numeric(9, 2))").collect()}
    assert list(rows) == ["a", "b", "c"] and rows["c"].statement == 2 and rows["c"].length == 9
    assert rows["a"].not_null and rows["a"].primary_key and rows["a"].length is None
    assert rows["b"].length == 7 and rows["b"].primary_key and not rows["b"].unique


def test_backslashes_and_dollar_quotes(spark):
    text = r"""create table t (a int default 'it\'s, (' not null, b text default E'\\', c text default $q$ '), $$ ( $q$ unique,
        d text default $$not null, ($$, e$1 int, f text default 'two''s, (')"""
    rows = {r.name: r for r in extract(spark, text).collect()}
    assert list(rows) == ["a", "b", "c", "d", "e$1", "f"]
    assert [n for n, r in rows.items() if r.not_null] == ["a"] and [n for n, r in rows.items() if r.unique] == ["c"]
    corpus = spark.createDataFrame([(1, r"create table t (a text default 'c:\', b text default e'\', (', c int)")], "ddl_id int, ddl_text string")
    assert [r.name for r in ddl.extract_specs(corpus, backslash=False).collect()] == ["a", "b", "c"]


def test_control_characters_play_no_part(spark):
    marks = "\u0001\u0002\u0003\u0004\u0005"
    assert found(spark, f"create table t (a{marks} int, b varchar(3{marks}))") == [(1, 1, "a", "INT"), (1, 2, "b", "VARCHAR")]


def test_wide_table(spark):
    text = "create table w (" + ", ".join(f"c{n} varchar({n + 1})" for n in range(2000)) + ")"
    found = extract(spark, text)
    assert found.count() == 2000
    assert found.where("length <> pos").count() == 0


def test_document_text(spark):
    table = specs.specs_table(spark, [EVENT_SPECS[2], EVENT_SPECS[5]])
    assert specs.spec_documents(table).first().document + "\n" == TWO_COLUMNS


def test_documents_are_read_back(spark, tmp_path):
    awkward = [ColumnSpec("no", "TEXT"), ColumnSpec("it's: odd", "TEXT"), ColumnSpec("null", "TEXT", unique=True)]
    awkward += [ColumnSpec(name, "TEXT") for name in ("two\nlines", 'a "b"', "back\\slash\n", "tab\t\\n", "- x", "# y")]
    for number, columns in enumerate((EVENT_SPECS, awkward)):
        path = str(tmp_path / str(number))
        specs.write_spec_document(specs.specs_table(spark, columns), path)
        assert specs.collect_specs(specs.read_spec_documents(spark, path)) == list(columns)


def parsed(spark, text):
    return specs.parse_documents(spark.createDataFrame([(text,)], "value string"))


def test_hand_written_documents(spark):
    assert parsed(spark, "data: []").count() == 0
    assert parsed(spark, "# nothing yet\ndata:\n").count() == 0
    text = '---\n# columns\ndata:\n- name: "a"\n  # kind\n  data_type: \'BIGINT\'\n- length: 3\n- name: b\n'
    assert specs.collect_specs(parsed(spark, text)) == [ColumnSpec("a", "BIGINT"), ColumnSpec("b", None)]
    with pytest.raises(Exception, match="no list of column specs"):
        parsed(spark, "columns:\n- name: a").count()


def test_specs_of_several_tables_are_refused(spark, tmp_path):
    both = extract(spark, "create table t (a int); create table u (b int)")
    with pytest.raises(ValueError, match="several tables"):
        specs.collect_specs(both)
    with pytest.raises(ValueError, match="several tables"):
        specs.write_spec_document(both, str(tmp_path / "both"))


def test_documents_are_valid_for_other_readers(spark):
    yaml = pytest.importorskip("yaml")
    columns = [*EVENT_SPECS, ColumnSpec("no", "TEXT"), ColumnSpec("it's: odd", "TEXT")]
    data = yaml.safe_load(specs.spec_documents(specs.specs_table(spark, columns)).first().document)["data"]
    assert [ColumnSpec(**item) for item in data] == columns


def test_spec_table_keeps_nulls(spark, tmp_path):
    table = specs.specs_table(spark, EVENT_SPECS)
    specs.write_specs(table, str(tmp_path / "specs"))
    back = specs.read_specs(spark, str(tmp_path / "specs"))
    assert specs.collect_specs(back) == list(EVENT_SPECS)
    assert specs.type_projection(back).columns == ["name", "data_type", "length"]


def test_audit(spark):
    rows = [(1, "a", "x" * 3, 1), (1, "b", None, 1), (2, None, "y" * 5, None), (2, "a", "zz", 2), (1, "a", "z", 3)]
    df = spark.createDataFrame(rows, "k int, sub string, text string, n int")
    columns = [
        ColumnSpec("k", "BIGINT", not_null=True, primary_key=True),
        ColumnSpec("sub", "TEXT", 10, 10, not_null=True, primary_key=True),
        ColumnSpec("text", "TEXT", 2, 2),
        ColumnSpec("n", "BIGINT", unique=True),
    ]
    found = {row["name"]: tuple(row)[2:] for row in audit(df, columns).collect()}
    # The key (1, a) occurs twice; the null of sub leaves its row out of the key count.
    assert found == {"k": (0, 0, 1), "sub": (1, 0, 1), "text": (0, 2, 0), "n": (0, 0, 1)}


def test_audit_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k int")
    found = audit(df, [ColumnSpec("k", "BIGINT", not_null=True, primary_key=True, unique=True)]).collect()
    assert [tuple(row) for row in found] == [(1, "k", 0, 0, 0)]


WIDE = [
    ColumnSpec("a", "BIGINT", primary_key=True),
    ColumnSpec("b", "CHARACTER VARYING", 200, 200, not_null=True, primary_key=True),
    ColumnSpec("__hash", "CHARACTER VARYING", 5, 5, unique=True),
    ColumnSpec("key", "DOUBLE PRECISION", unique=True),
    ColumnSpec("count", "BIGINT", unique=True),
]


def _wide_rows():
    """Nulls, signed zeros, a key on a third of all rows, and one column without a repeat."""
    rows = [(k % 50, f"t{k % 7}" if k % 11 else None, f"u{k % 290}", (-0.0, 0.0, None)[k % 3], k) for k in range(300)]
    return rows + [(None, None, None, None, None)] * 2 + [(1, "hot", "hot", 1.5, None)] * 150


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
@pytest.mark.parametrize("meeting", [False, True])
def test_audits_by_hash_count_as_others(spark, monkeypatch, broadcast_rows, meeting):
    if meeting:  # hashes that meet by the dozen
        hashed = audits._hash
        monkeypatch.setattr(audits, "_hash", lambda df, covered: F.pmod(hashed(df, covered), F.lit(9)))
    df = spark.createDataFrame(_wide_rows(), "a long, b string, `__hash` string, key double, count long")
    want = {tuple(row) for row in audit(df, WIDE).collect()}
    assert {tuple(row) for row in audit_by_hash(df, WIDE, broadcast_rows).collect()} == want
    keys = [(r[0], r[1]) for r in _wide_rows() if None not in r[:2]]
    counts = {row[1]: row[4] for row in want}
    assert counts["a"] == counts["b"] == len(keys) - len(set(keys)) and counts["count"] == 0


def test_audits_by_hash_of_few_rows_and_no_keys(spark):
    df = spark.createDataFrame([], "a long, b string, `__hash` string, key double, count long")
    assert {tuple(row)[2:] for row in audit_by_hash(df, WIDE).collect()} == {(0, 0, 0)}
    one = spark.createDataFrame([("abc",)], "t string")
    found = audit_by_hash(one, [ColumnSpec("t", "CHARACTER VARYING", 2, 2)]).collect()
    assert [tuple(row) for row in found] == [(1, "t", 0, 1, 0)]

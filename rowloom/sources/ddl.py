"""Column specs from a corpus of CREATE TABLE statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.sources.specs import DEFAULT_GENERATOR

# Control characters that stand for others while a statement is taken apart: around the number of
# a quoted name, for parentheses and commas below the first level of a column's own, and for
# commas on that level.
MARK, OPEN, CLOSE, INNER_COMMA, COMMA = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005"
# More than any text's parentheses: a list that never closes.
_NEVER = 1 << 30

_QUOTED = r"\"(?:[^\"]|\"\")*+\"|`[^`]*+`|\[[A-Za-z_][^\]]*+\]"
_DOLLARS = r"(?<![\w$])\$(?<tag>(?:[A-Za-z_]\w*+)?)\$(?s:.*?)\$\k<tag>\$"
_ESCAPED = r"'(?:[^'\\]|''|\\(?s:.))*+'"
_LITERAL = r"\b[eE]" + _ESCAPED + r"|'(?:[^']|'')*+'"
_COMMENT = r"--[^\n]*+|/\*(?s:.*?)\*/"
_HEAD = r"(?i:\bcreate (?:\w+ )*?table (?:if not exists )?[^ (]+(?: ?\. ?[^ (]+)* ?\()"
_TOKEN = rf"{_HEAD}|[(),]|(?:[^(),cC]|(?!{_HEAD})[cC])++"
_INNER = r"\([^()]*\)"
_CONSTRAINT = r"(?i)^(?:constraint \S+ )?"
# A key clause lists columns, where a column of such a name has a length or values in its parentheses.
_TABLE_RULE = (
    rf"{_CONSTRAINT}(?:(?:primary key|unique|foreign key|check|exclude)\b[^(]*\(|like \S"
    rf"|(?:(?:fulltext|spatial) )?(?:key|index)\b ?(?:[^ (]+ ?)?(?:using \w+ ?)?\( ?+(?![\d{COMMA})]))"
)
_NAME = rf"^([^ ({OPEN}]+)"
_TYPE = (
    r"(?i)^[^ (]+ (character varying|double precision|bit varying"
    r"|(?:timestamp|time) with(?:out)? time zone|\w+)"
)
_LENGTH = _TYPE + r" ?\( ?(\d+)"


def _column_lists(text: Column) -> Column:
    """The column lists of a text's statements, by one pass over its tokens that counts parentheses.

    A list's own commas and a column's own parentheses stay what they are; everything
    deeper is marked, so that what follows needs no nesting. One that doesn't close fails.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("body"), F.array().cast("array<string>").alias("bodies"))

    def step(state: Column, token: Column) -> Column:
        depth, body, bodies = state["depth"], state["body"], state["bodies"]
        head = (F.length(token) > 1) & token.endswith("(")
        ends = (token == ")") & (depth == 1)
        after = (
            F.when(head, F.when(depth == 0, 1).otherwise(_NEVER))
            .when(depth == 0, 0)
            .when(token == "(", depth + 1)
            .when(token == ")", depth - 1)
            .otherwise(depth)
        )
        shown = (
            F.when((token == "(") & (depth > 1), F.lit(OPEN))
            .when((token == ")") & (depth > 2), F.lit(CLOSE))
            .when((token == ",") & (depth > 1), F.when(depth == 2, F.lit(COMMA)).otherwise(F.lit(INNER_COMMA)))
            .otherwise(token)
        )
        return F.struct(
            after.alias("depth"),
            F.when((depth == 0) | ends, F.lit("")).otherwise(F.concat(body, shown)).alias("body"),
            F.when(ends, F.concat(bodies, F.array(body))).otherwise(bodies).alias("bodies"),
        )

    def finish(state: Column) -> Column:
        message = F.concat(F.lit("column list without an end: "), F.substring(text, 1, 200))
        return F.when(state["depth"] > 0, F.raise_error(message)).otherwise(state["bodies"])

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step, finish)


def _plain_name(name: Column, quoted: Column) -> Column:
    """A name as it was written, out of the numbered quoted ones where it stands for one."""
    text = F.get(quoted, F.nullif(F.regexp_extract(name, rf"{MARK}(\d+){MARK}", 1), F.lit("")).cast("int"))
    inner = text.substr(F.lit(2), F.length(text) - 2)
    return F.coalesce(F.when(text.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(inner), name)


def _key_columns(words: str) -> Column:
    """The lower-case names of the columns that table-level keys of one kind list."""
    rules = F.filter("items", lambda item: item.rlike(rf"{_CONSTRAINT}{words}\b[^(]*\("))
    lists = F.transform(rules, lambda rule: F.split(F.regexp_extract(rule, r"\(([^()]*)\)", 1), COMMA))
    return F.transform(
        F.flatten(lists),
        lambda name: F.lower(_plain_name(F.regexp_extract(F.trim(name), _NAME, 1), F.col("quoted"))),
    )


def extract_specs(corpus: DataFrame, ddl: str = "ddl_text", backslash: bool = True) -> DataFrame:
    """One row per column of each statement, after the corpus's other columns.

    ``statement`` numbers the CREATE TABLE statements of a text that list columns. A text is
    taken apart within its row, so a corpus needs no shuffle. Comments and quoted texts, those
    between dollar signs too, play no part; parentheses may lie in each other to any depth. A
    backslash in a quoted text takes the next character with it, unless ``backslash`` is off:
    then it does so only after an E. A column of a primary key is not null. Precision repeats
    the length. A text without such a statement, or null, has no rows; one whose column list
    does not close fails the job.
    """
    others = [name for name in corpus.columns if name != ddl]
    # Quoted names are kept; quoted texts and comments give way to a space.
    literal = _ESCAPED if backslash else _LITERAL
    opaque = rf"({_QUOTED})|{_DOLLARS}|{literal}|{_COMMENT}|[{MARK}-{COMMA}]"
    plain = corpus.select(*others, F.regexp_replace(ddl, opaque, "$1 ").alias("plain"))
    pieces = F.split("plain", _QUOTED)
    numbered = F.transform(
        pieces, lambda piece, at: F.when(at == 0, piece).otherwise(F.concat(F.lit(MARK), at - 1, F.lit(MARK), piece))
    )
    marked = plain.select(
        *others,
        F.regexp_extract_all("plain", F.lit(_QUOTED), F.lit(0)).alias("quoted"),
        F.regexp_replace(F.array_join(numbered, ""), r"\s+", " ").alias("marked"),
    )
    statements = marked.select(
        *others, "quoted", F.posexplode(_column_lists(F.col("marked"))).alias("nth", "body")
    )
    trimmed = F.transform(F.split("body", ","), lambda item: F.trim(item))
    items = statements.select(
        *others, "quoted", "nth", F.filter(trimmed, lambda item: item != "").alias("items")
    ).select(
        *others,
        "quoted",
        "nth",
        F.filter("items", lambda item: ~item.rlike(_TABLE_RULE)).alias("columns"),
        _key_columns("primary key").alias("primary_names"),
        _key_columns("unique").alias("unique_names"),
    )
    found = items.select(
        *others, "quoted", "nth", "primary_names", "unique_names", F.posexplode("columns").alias("at", "item")
    )
    # Keywords count after the type only, and outside of parentheses.
    after = F.regexp_replace(F.regexp_replace("item", _TYPE, ""), _INNER, " ")
    named = found.withColumns(
        {"name": _plain_name(F.regexp_extract("item", _NAME, 1), F.col("quoted")), "after": after}
    )

    def has(words: str) -> Column:
        return F.col("after").rlike(rf"(?i)\b{words}\b")

    length = F.nullif(F.regexp_extract("item", _LENGTH, 2), F.lit("")).cast("int")
    primary = has("primary key") | F.array_contains("primary_names", F.lower("name"))
    return named.select(
        *others,
        (F.col("nth") + 1).cast("int").alias("statement"),
        (F.col("at") + 1).cast("int").alias("pos"),
        "name",
        F.upper(F.regexp_extract("item", _TYPE, 1)).alias("data_type"),
        length.alias("length"),
        length.alias("precision"),
        (has("not null") | primary).alias("not_null"),
        primary.alias("primary_key"),
        (has("unique") | F.array_contains("unique_names", F.lower("name"))).alias("unique"),
        F.lit(DEFAULT_GENERATOR).alias("generator"),
    )

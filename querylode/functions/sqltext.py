"""Column expressions over SQL text: masking, extraction, classification.

Patterns carry the inline flags ``(?U)`` (Unicode classes) and ``(?d)`` (only ``\\n`` ends a line) where
the semantics need them.  ``strict=True`` variants repair known quirks of the default rules.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Literal masking.
PLACEHOLDER = ":placeholder"
#: A literal with doubled quotes, an open one up to the last quote that could end it. Possessive: without a stack frame per quote.
STRING_LITERAL = r"(?:'[^']*+(?:''[^']*+)*+'|'[^']*+(?:''(?=[^']*+')[^']*+)*+')"
NUMBER_LITERAL = r"(?U)(?<![a-zA-Z_:])(\d+\.?\d*)(?![a-zA-Z_\d])"
NUMBER_LITERAL_STRICT = r"(?U)(?<![\w:.$#])(\d+(?:\.\d+)?)(?![\w$#])"

# Names and clauses.
TABLE_NAME = r"([a-zA-Z_][a-zA-Z0-9_]*(?:\.[a-zA-Z_][a-zA-Z0-9_]*)?)"
WHERE_CLAUSE = r"(?isUd)\bWHERE\s+(.*?)(?:\bORDER\b|\bGROUP\b|\bHAVING\b|\bLIMIT\b|$)"
WHERE_COLUMN = (r"(?iUd)(?:^|AND|OR)\s*([a-zA-Z_][a-zA-Z0-9_]*(?:\.[a-zA-Z_][a-zA-Z0-9_]*)?)"
                r"\s*(?:=|!=|<>|<|>|<=|>=|IN|LIKE|BETWEEN|IS)")
SELECT_LIST = r"(?isU)\bSELECT\s+(.*?)\s+FROM\b"

# Statement classes.
DDL = r"(?iU)^\s*(CREATE|ALTER|DROP)\s+"
DML = r"(?iU)^\s*(INSERT|UPDATE|DELETE)\s+"
SYSTEM_OBJECT = r"(?iU)\b(SYS\.\w+|DBA_\w+|ALL_\w+|USER_\w+|V\$\w+|GV\$\w+)\b"
AGGREGATE_CALL = r"(?iU)\b(COUNT|SUM|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\("
WINDOW_CALL = r"(?iU)\b(ROW_NUMBER|RANK|DENSE_RANK|NTILE|LAG|LEAD|FIRST_VALUE|LAST_VALUE)\s*\("
OPERATIONS = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "ALTER", "DROP")
CATALOG_VIEW = (r"(?iU)\b(SYS\.\w+|DBA_(?:TABLES|TAB_\w+|VIEWS|USERS|OBJECTS|INDEXES|SEGMENTS)"
                r"|ALL_(?:TABLES|TAB_\w+|COL_\w+|VIEWS|USERS|OBJECTS|INDEXES)"
                r"|USER_(?:TABLES|TAB_\w+|COL_\w+|VIEWS|OBJECTS|INDEXES)|V\$\w+|GV\$\w+)\b")

# Words that are never identifiers of a schema.
SQL_WORDS = (
    "SELECT", "FROM", "WHERE", "AND", "OR", "JOIN", "LEFT", "RIGHT", "INNER", "OUTER", "ON", "AS", "IN", "NOT",
    "NULL", "IS", "BETWEEN", "GROUP", "BY", "ORDER", "ASC", "DESC", "HAVING", "LIMIT", "COUNT", "SUM", "AVG",
    "MAX", "MIN", "DISTINCT", "CASE", "WHEN", "THEN", "ELSE", "END", "INSERT", "INTO", "VALUES", "UPDATE", "SET",
    "DELETE", "CREATE", "TABLE", "DROP", "ALTER", "INDEX", "TO_DATE", "SYSDATE", "TRUNC", "ROUND", "NVL",
    "DECODE", "LIKE", "OVER", "PARTITION",
)

# Rule descriptions, tried in this order on the masked text.
RULE_DESCRIPTIONS = (
    (("COUNT", "SUM"), "이 쿼리는 집계 함수를 사용하여 데이터를 요약합니다."),
    (("JOIN",), "이 쿼리는 여러 테이블을 조인하여 관련 데이터를 조회합니다."),
    (("WHERE",), "이 쿼리는 조건에 맞는 데이터를 필터링하여 조회합니다."),
)
DEFAULT_DESCRIPTION = "이 쿼리는 데이터베이스에서 데이터를 조회합니다."

# Table kinds by name fragment, tried in this order.
TABLE_KINDS = (("MST", "master"), ("HIS", "history"), ("INF", "information"), ("TRK", "tracking"))

# Statements forbidden for generated queries.
FORBIDDEN = ("DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "CREATE", "TRUNCATE", "GRANT", "REVOKE", "EXEC")


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_word(c: Column) -> Column:
    """First white-space separated word, null when there is none."""
    word = F.regexp_extract(c, r"(?U)(\S+)", 1)
    return F.when(word != "", word)


def last_part(c: Column) -> Column:
    """Text after the last dot."""
    return F.element_at(F.split(c, r"\."), -1)


# --- masking and hashing ---------------------------------------------------------------------------

def mask_literals(sql: Column, strict: bool = False) -> Column:
    """Replace string and number literals.  By default only the first digit after a letter is protected
    (``M10`` -> ``M1:placeholder``); ``strict`` protects whole identifiers and binds."""
    masked = F.regexp_replace(sql, STRING_LITERAL, PLACEHOLDER)
    return F.regexp_replace(masked, NUMBER_LITERAL_STRICT if strict else NUMBER_LITERAL, PLACEHOLDER)


def template_id(masked: Column) -> Column:
    return F.md5(masked)


def canonical(sql: Column) -> Column:
    """Case- and space-folded text with masked literals, for comparing statements."""
    text = F.regexp_replace(F.upper(sql), r"(?U)\s+", " ")
    text = F.regexp_replace(text, r"'[^']*'", "'?'")
    return strip(F.regexp_replace(text, r"(?U)\b\d+\b", "?"))


def canonical_hash(sql: Column) -> Column:
    return F.sha2(canonical(sql), 256)


# --- extraction --------------------------------------------------------------------------------------

def _all(sql: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(sql, F.lit(pattern), F.lit(group))


def tables(sql: Column) -> Column:
    """Names after FROM, then names after JOIN; case and duplicates kept."""
    return F.concat(_all(sql, r"(?iU)\bFROM\s+" + TABLE_NAME), _all(sql, r"(?iU)\bJOIN\s+" + TABLE_NAME))


def bare_tables(sql: Column) -> Column:
    """Distinct names after FROM / JOIN without a schema part or word boundary, sorted."""
    return F.array_sort(F.array_distinct(F.concat(
        _all(sql, r"(?i)FROM\s+([A-Za-z0-9_]+)"), _all(sql, r"(?i)JOIN\s+([A-Za-z0-9_]+)"))))


def referenced_tables(sql: Column) -> Column:
    """Distinct names after FROM / JOIN / INTO / UPDATE."""
    return F.array_distinct(F.concat(*[
        _all(sql, rf"(?i){word}\s+([A-Za-z0-9_]+)") for word in ("FROM", "JOIN", "INTO", "UPDATE")]))


def select_items(sql: Column, strict: bool = False) -> Column:
    """Raw items of the first select list: split at every comma, or at parenthesis depth 0 if strict."""
    if strict:
        return _outer_items(sql)
    return F.split(F.regexp_extract(sql, SELECT_LIST, 1), ",")


def select_columns(sql: Column) -> Column:
    """``struct(columns, error)``: names of the first select list, error on a blank item."""

    def name(item: Column) -> Column:
        item = strip(item)
        return (F.when(item == "*", "*")
                .when(item.contains("."), first_word(last_part(item)))
                .otherwise(first_word(item)))

    names = F.when(sql.rlike(SELECT_LIST), F.transform(select_items(sql), name)).otherwise(
        F.array().cast("array<string>"))
    bad = F.exists(names, lambda n: n.isNull())
    return F.struct(F.when(~bad, names).alias("columns"),
                    F.when(bad, F.lit("blank select item")).alias("error"))


def where_columns(sql: Column) -> Column:
    """Identifiers before an operator in the first WHERE clause, last part of dotted names."""
    return F.transform(_all(F.regexp_extract(sql, WHERE_CLAUSE, 1), WHERE_COLUMN), last_part)


# One flat pass cuts the text; no part of it nests, so neither length nor depth of a statement matters to the regex engine.
# A literal with doubled quotes comes as several adjacent ones, which a repeated group would need a stack frame each for.
_TOKEN = r"(?s)'[^']*'|--[^\n]*|/\*.*?\*/|\"[^\"]*\"|[(),]|[\w.$#]+|\s+|."
_NOWHERE = 1 << 30


def _outer_items(sql: Column) -> Column:
    """Items of the first select list at the lowest depth any select list has, so that CTE bodies don't count: a fold over the tokens
    with the current depth, the depth of the list being read, the item so far, the items, and whether its FROM was seen."""
    text, number = F.lit("").cast("string"), F.lit(0)
    start = F.struct(number.alias("depth"), F.lit(_NOWHERE).alias("at"), text.alias("item"),
                     F.array().cast("array<string>").alias("items"), F.lit(False).alias("open"), F.lit(False).alias("done"))

    def state(depth: Column, at: Column, item: Column, items: Column, opened: Column, done: Column) -> Column:
        return F.struct(depth.alias("depth"), at.alias("at"), item.alias("item"), items.alias("items"), opened.alias("open"), done.alias("done"))

    def step(s: Column, token: Column) -> Column:
        word = F.upper(token)
        depth = s["depth"] + F.when(token == "(", 1).when(token == ")", -1).otherwise(0)
        here = s["open"] & (s["depth"] == s["at"])
        none = F.array().cast("array<string>")
        closed = F.concat(s["items"], F.array(s["item"]))
        blank = F.size(s["items"]) + F.length(F.trim(s["item"])) == 0
        shown = F.when(token.rlike(r"^(--|/\*)"), F.lit(" ")).otherwise(token)
        return (
            F.when((word == "SELECT") & (s["depth"] < s["at"]), state(depth, s["depth"], F.lit(""), none, F.lit(True), F.lit(False)))
            .when(here & (token == ")"), state(depth, F.lit(_NOWHERE), F.lit(""), none, F.lit(False), F.lit(False)))
            .when(here & (token == ","), state(depth, s["at"], F.lit(""), closed, F.lit(True), F.lit(False)))
            .when(here & (word == "FROM"), state(depth, s["at"], F.lit(""), closed, F.lit(False), F.lit(True)))
            .when(here & (word == "DISTINCT") & blank, state(depth, s["at"], F.lit(""), s["items"], F.lit(True), F.lit(False)))
            .when(s["open"], state(depth, s["at"], F.concat(s["item"], shown), s["items"], F.lit(True), F.lit(False)))
            .otherwise(state(depth, s["at"], s["item"], s["items"], s["open"], s["done"]))
        )

    def items(tokens: Column) -> Column:
        words = F.filter(tokens, lambda t: ~t.rlike(r"^(--|/\*|[\s(])"))
        query = F.upper(F.get(words, F.lit(0))).isin("SELECT", "WITH")
        return F.when(query, F.aggregate(tokens, start, step))

    none = F.array().cast("array<string>")
    found = F.transform(F.array(_all(sql, _TOKEN, 0)), items)  # a one-element array binds the tokens once
    return F.transform(found, lambda f: F.when(f["done"], f["items"]).otherwise(none))[0]


_ALIAS = r"(?iU)\sAS\s+([A-Za-z_][A-Za-z0-9_]*)\s*$"


def select_outputs(sql: Column) -> Column:
    """Output names of the outer select list: alias, else last part of a column, else the expression."""

    def name(item: Column) -> Column:
        item = strip(item)
        alias = F.regexp_extract(item, _ALIAS, 1)
        plain = item.rlike(r"(?U)^[A-Za-z_][\w.]*$")
        return F.when(alias != "", alias).when(plain, last_part(item)).otherwise(item)

    return F.transform(select_items(sql, strict=True), name)


_OPERAND = rf"({STRING_LITERAL}|-?\d+(?:\.\d+)?|:\w+|[A-Za-z_][\w.]*)"
#: The left side is a column or one call of columns and literals.
PREDICATE = rf"(?U)([A-Za-z_][\w.]*(?:\([^()']*\))?)\s*(<>|!=|>=|<=|=|<|>)\s*{_OPERAND}"
_CONDITION_TEXT = r"(?isUd)\bWHERE\s+(.*?)(?:\bORDER\s+BY\b|\bGROUP\s+BY\b|\bHAVING\b|\bLIMIT\b|\bUNION\b|$)"
_CASE_TEXT = r"(?isU)\bWHEN\s+(.*?)\s+THEN\b"


def _predicates_of(text: Column) -> Column:
    parts = [_all(text, PREDICATE, g) for g in (1, 2, 3)]
    return F.arrays_zip(parts[0].alias("column"), parts[1].alias("op"), parts[2].alias("value"))


def where_predicates(sql: Column) -> Column:
    """Comparison predicates of all WHERE clauses as ``array<struct<column, op, value>>``."""
    return _predicates_of(F.array_join(_all(sql, _CONDITION_TEXT), " AND "))


def case_predicates(sql: Column) -> Column:
    """Comparison predicates of all CASE branches."""
    return _predicates_of(F.array_join(_all(sql, _CASE_TEXT), " AND "))


_JOIN = (r"(?isUd)\b(?:(LEFT|RIGHT|FULL|CROSS|INNER)\s+(?:OUTER\s+)?)?JOIN\s+([A-Za-z_][\w.]*)"
         r"(?:\s+(?:AS\s+)?(?!ON\b)([A-Za-z_]\w*))?\s+ON\s+(.*?)"
         r"(?=\s+(?:NATURAL|LEFT|RIGHT|FULL|CROSS|INNER|JOIN|WHERE|GROUP|ORDER|HAVING|LIMIT|UNION|FETCH)\b|\)|$)")


def joins(sql: Column) -> Column:
    """Joins as ``array<struct<side, table, alias, condition>>``; side defaults to INNER."""
    side, table, alias, condition = (_all(sql, _JOIN, g) for g in (1, 2, 3, 4))
    side = F.transform(side, lambda s: F.when(s == "", "INNER").otherwise(F.upper(s)))
    return F.arrays_zip(side.alias("side"), table.alias("table"), alias.alias("alias"), condition.alias("condition"))


_SOURCE = (r"(?iU)\b(?:FROM|JOIN)\s+([A-Za-z_][\w.]*)"
           r"(?:\s+(?:AS\s+)?(?!(?:ON|WHERE|LEFT|RIGHT|FULL|CROSS|INNER|JOIN|GROUP|ORDER|HAVING|LIMIT|UNION|FETCH|SET)\b)"
           r"([A-Za-z_]\w*))?")


def alias_map(sql: Column) -> Column:
    """``map<alias, table>`` of the statement; a table is also its own alias."""
    names, aliases = _all(sql, _SOURCE, 1), _all(sql, _SOURCE, 2)
    entries = F.concat(
        F.arrays_zip(names.alias("key"), names.alias("value")),
        F.filter(F.arrays_zip(aliases.alias("key"), names.alias("value")), lambda e: e["key"] != ""))
    return F.aggregate(
        entries, F.create_map().cast("map<string,string>"),
        lambda m, e: F.when(F.map_contains_key(m, e["key"]), m).otherwise(
            F.map_concat(m, F.create_map(e["key"], e["value"]))))


def main_table(sql: Column) -> Column:
    """First FROM table, null when there is none."""
    name = F.regexp_extract(sql, r"(?iU)\bFROM\s+" + TABLE_NAME, 1)
    return F.when(name != "", name)


def owner_table(column: Column, aliases: Column, main: Column) -> Column:
    """Table a possibly qualified column belongs to: its qualifier's table, else the first FROM table."""
    qualifier = F.regexp_extract(column, r"^(.*)\.[^.]*$", 1)
    return F.when(qualifier == "", main).otherwise(F.coalesce(F.element_at(aliases, qualifier), qualifier))


def group_by_columns(sql: Column) -> Column:
    """Columns of the first GROUP BY list."""
    text = F.regexp_extract(sql, r"(?isUd)\bGROUP\s+BY\s+(.*?)(?:\bHAVING\b|\bORDER\b|\bLIMIT\b|\)|$)", 1)
    return _all(text, r"(?U)\b([A-Za-z_][\w.]*)(?!\s*\(|\w|\.)")


def aggregate_columns(sql: Column) -> Column:
    """Plain columns passed to an aggregate call."""
    return _all(sql, r"(?iU)\b(?:COUNT|SUM|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\(\s*(?:DISTINCT\s+)?([A-Za-z_][\w.]*)\s*\)")


def plain_select_columns(sql: Column) -> Column:
    """Qualified names of select items that are plain columns, with or without an alias."""
    item = r"(?iU)^\s*([A-Za-z_][\w.]*)(?:\s+(?:AS\s+)?[A-Za-z_]\w*)?\s*$"
    names = F.transform(select_items(sql, strict=True), lambda i: F.regexp_extract(i, item, 1))
    return F.filter(names, lambda n: n != "")


def join_equalities(sql: Column) -> Column:
    """Equalities of two qualified columns in ON conditions: ``array<struct<left, right>>``."""
    text = F.array_join(F.transform(joins(sql), lambda j: j["condition"]), " AND ")
    pair = r"(?U)([A-Za-z_]\w*\.\w+)\s*=\s*([A-Za-z_]\w*\.\w+)"
    return F.arrays_zip(_all(text, pair, 1).alias("left"), _all(text, pair, 2).alias("right"))


# Plant and site-process suffixes of table names.
FAMILY = r"(?i)^(.+)_((?:M\d+|R\d+|WLP\d*|C\d+)|(?:IC|CJ|WX)[A-Z]+)$"


def family_stem(table: Column) -> Column:
    stem = F.regexp_extract(table, FAMILY, 1)
    return F.when(stem != "", stem)


def family_suffix(table: Column) -> Column:
    suffix = F.regexp_extract(table, FAMILY, 2)
    return F.when(suffix != "", suffix)


def identifier_words(sql: Column) -> Column:
    """All identifier-like words that are no SQL keyword; order and duplicates kept."""
    return F.filter(_all(sql, r"([A-Za-z_][A-Za-z0-9_]*)"), lambda w: ~F.upper(w).isin(*SQL_WORDS))


# --- classification ----------------------------------------------------------------------------------

def is_ddl(sql: Column) -> Column:
    return sql.rlike(DDL)


def is_dml(sql: Column) -> Column:
    return sql.rlike(DML)


def is_system(sql: Column, strict: bool = False) -> Column:
    """Mentions a system object.  The default also matches names such as ``user_id``; ``strict`` only
    catalogue views."""
    return sql.rlike(CATALOG_VIEW if strict else SYSTEM_OBJECT)


def has_analytics(sql: Column) -> Column:
    return sql.rlike(AGGREGATE_CALL) | sql.rlike(WINDOW_CALL)


def operation(sql: Column) -> Column:
    """Statement class by its first word, null when it is none of the known ones."""
    word = F.upper(first_word(sql))
    return F.when(word.isin(*OPERATIONS), word)


def table_kind(name: Column) -> Column:
    upper = F.upper(name)
    kind = F.lit("data")
    for fragment, label in reversed(TABLE_KINDS):
        kind = F.when(upper.contains(fragment), label).otherwise(kind)
    return kind


def rule_description(masked: Column) -> Column:
    """Deterministic description of a statement by the words it contains (case-sensitive)."""
    out = F.lit(DEFAULT_DESCRIPTION)
    for words, text in reversed(RULE_DESCRIPTIONS):
        hit = F.lit(False)
        for w in words:
            hit = hit | masked.contains(w)
        out = F.when(hit, text).otherwise(out)
    return out


def insufficient_comment(comment: Column, min_length: int = 5) -> Column:
    """Missing, too short, or a short all-capitals abbreviation."""
    shout = (F.upper(comment) == comment) & (F.lower(comment) != comment)
    return comment.isNull() | (F.length(strip(comment)) < min_length) | (shout & (F.length(comment) <= 10))


def safety_reasons(sql: Column) -> Column:
    """Why a statement may not run: several statements, not a SELECT, forbidden words outside literals."""
    bare = F.regexp_replace(F.regexp_replace(sql, STRING_LITERAL, "''"), r"(?s)--[^\n]*|/\*.*?\*/", " ")
    parts = F.filter(F.split(bare, ";"), lambda p: strip(p) != "")
    words = _all(F.upper(bare), r"(?U)(\w+)", 1)
    bad = F.array_sort(F.array_intersect(words, F.array(*map(F.lit, FORBIDDEN))))
    return F.concat(
        F.when(F.size(parts) != 1, F.array(F.lit("not one statement"))).otherwise(F.array().cast("array<string>")),
        F.when(~bare.rlike(r"(?iU)^\s*(SELECT|WITH)\b"), F.array(F.lit("not a SELECT")))
        .otherwise(F.array().cast("array<string>")),
        F.transform(bad, lambda w: F.concat(F.lit("forbidden "), w)))

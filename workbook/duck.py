"""DuckDB renderings shared by the checking SQL."""

from __future__ import annotations

from querylode.functions import sqltext as S
from querylode.functions import tokens as K
from querylode.sources import catalog, derived

_PARTS = """(SELECT *, CAST(event_id AS STRING) AS e, CAST(user_id AS STRING) AS u,
  CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS v, regexp_extract(props, '([0-9]+)', 1) AS k FROM events) src"""

LOGS = f"sql_logs AS (SELECT {', '.join(derived.LOG_COLUMNS)} FROM {_PARTS})"
PROFILED = (f"sql_logs AS (SELECT {', '.join(derived.LOG_COLUMNS)}, CAST(round(value * 100) AS BIGINT) AS exec_time, "
            f"CAST(k AS BIGINT) AS result_rows FROM {_PARTS})")
QUESTIONS = f"questions AS (SELECT {', '.join(derived.QUESTION_COLUMNS[:2])} FROM {_PARTS})"
TRUTH = (f"truth AS (SELECT question_id, unnest(string_split(truth, ',')) AS table_name FROM "
         f"(SELECT {derived.QUESTION_COLUMNS[0]}, {derived.QUESTION_COLUMNS[2]} FROM {_PARTS}))")
GLOSSARY = f"glossary AS (SELECT {', '.join(derived.GLOSSARY_COLUMNS)} FROM part)"

STRING_LITERAL = r"''(?:[^'']|'''')*''"
SYSTEM = r"\b(SYS\.\w+|DBA_\w+|ALL_\w+|USER_\w+|V\$\w+|GV\$\w+)\b"


def is_ddl(x: str) -> str:
    return rf"regexp_matches({x}, '^\s*(CREATE|ALTER|DROP)\s+', 'i')"


def is_dml(x: str) -> str:
    return rf"regexp_matches({x}, '^\s*(INSERT|UPDATE|DELETE)\s+', 'i')"


def is_system(x: str) -> str:
    return f"regexp_matches({x}, '{SYSTEM}', 'i')"


def analytics(x: str) -> str:
    return (rf"(regexp_matches({x}, '\b(COUNT|SUM|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\(', 'i') OR regexp_matches({x}, "
            rf"'\b(ROW_NUMBER|RANK|DENSE_RANK|NTILE|LAG|LEAD|FIRST_VALUE|LAST_VALUE)\s*\(', 'i'))")


VALID = (f"(error_count = 0 AND NOT {is_ddl('sql_text')} AND NOT {is_dml('sql_text')} "
         f"AND NOT {is_system('sql_text')})")


def mask(x: str) -> str:
    """RE2 has no look-around: protect the first digit after a letter, mask, restore."""
    out = f"regexp_replace({x}, '{STRING_LITERAL}', ':placeholder', 'g')"
    for d in range(10):
        out = rf"regexp_replace({out}, '([a-zA-Z_:]){d}', '\1' || chr({0xE000 + d}), 'g')"
    out = rf"regexp_replace({out}, '([0-9]+\.?[0-9]*)([^a-zA-Z_0-9]|$)', ':placeholder\2', 'g')"
    for d in range(10):
        out = f"replace({out}, chr({0xE000 + d}), '{d}')"
    return out


def canonical(x: str) -> str:
    out = rf"regexp_replace(upper({x}), '\s+', ' ', 'g')"
    out = rf"regexp_replace({out}, '''[^'']*''', '''?''', 'g')"
    return rf"trim(regexp_replace({out}, '\b\d+\b', '?', 'g'))"


NAME = r"([a-zA-Z_][a-zA-Z0-9_]*(?:\.[a-zA-Z_][a-zA-Z0-9_]*)?)"


def tables(x: str) -> str:
    return (rf"(regexp_extract_all({x}, '\bFROM\s+{NAME}', 1, 'i') || "
            rf"regexp_extract_all({x}, '\bJOIN\s+{NAME}', 1, 'i'))")


def bare_tables(x: str) -> str:
    return (rf"list_sort(list_distinct(regexp_extract_all({x}, 'FROM\s+([A-Za-z0-9_]+)', 1, 'i') || "
            rf"regexp_extract_all({x}, 'JOIN\s+([A-Za-z0-9_]+)', 1, 'i')))")


def columns(x: str) -> str:
    items = rf"string_split(regexp_extract({x}, '\bSELECT\s+(.*?)\s+FROM\b', 1, 'is'), ',')"
    word = r"regexp_extract({}, '(\S+)', 1)"
    pick = (f"CASE WHEN trim(i) = '*' THEN '*' WHEN contains(i, '.') THEN {word.format(chr(123) + chr(125))} "
            f"ELSE {word.format('i')} END").replace("{}", r"regexp_extract(i, '([^.]*)$', 1)")
    return (rf"CASE WHEN regexp_matches({x}, '\bSELECT\s+(.*?)\s+FROM\b', 'is') "
            f"THEN list_transform({items}, lambda i: {pick}) ELSE [] END")


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '{K.WORD}', 1)"


STOPWORDS = "[" + ", ".join(f"'{w}'" for w in K.STOPWORDS) + "]"


def keywords(x: str) -> str:
    return f"list_filter({words(x)}, lambda w: length(w) > 1 AND NOT list_contains({STOPWORDS}, w))"


def tokens(x: str) -> str:
    return words(f"lower({x})")


def values(name: str, columns: str, rows: list[tuple]) -> str:
    def cell(v) -> str:
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


CATALOG = values("cat_tables", "table_name, description, purpose, pos",
                 [(n, d, p, i) for i, (n, d, p) in enumerate(catalog.TABLE_NOTES, 1)]) + ", " + values(
    "cat_columns", "table_name, column_name, stem, description, is_pk, is_fk, pos",
    [(t, c, c if t == "events" else c.split("_", 1)[1], text, key == "P", key == "F", i)
     for t, _, _ in catalog.TABLE_NOTES for i, (c, text, key) in enumerate(catalog.COLUMN_NOTES[t], 1)])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

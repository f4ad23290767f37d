"""Clauses of nested statements: select items, joins and comparisons of every SELECT, from one pass over flat tokens.

Regular expressions cannot follow nesting, and a fold in column expressions copies its state once per token, so a small scanner works
on Arrow batches: a stack of scopes (the statement, brackets and CASE) that hold the clause they are in and where its current part and
operand began. It reads each token once; texts are sliced at the end of a part. Callers hand it distinct statements.

Words inside literals, quoted names and comments are no words; comments count as a space.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

from querylode.functions.sqltext import strip

# Flat tokens; a literal with doubled quotes comes as several adjacent ones.
_TOKEN = re.compile(r"'[^']*'|--[^\n]*|/\*.*?\*/|\"[^\"]*\"|`[^`]*`|->>?|=>|<=>|<>|!=|>=|<=|[=<>(),;]|[\w.$#:@]+|\s+|.", re.S)
_COMMENT = re.compile(r"('[^']*'|\"[^\"]*\"|`[^`]*`)|--[^\n]*|/\*.*?\*/", re.S)

# Words that end an operand, begin a clause, part whole queries, and stand before JOIN.
_BOUNDS = {"AND", "OR", "NOT", "WHEN", "THEN", "ELSE", "BETWEEN", "IN", "LIKE", "ILIKE", "IS", "EXISTS"}
_COMPARISONS = {"=", "<>", "!=", ">=", "<=", "<", ">", "<=>"}
_CLAUSES = {"GROUP", "HAVING", "ORDER", "LIMIT", "FETCH", "OFFSET", "WINDOW", "QUALIFY", "CONNECT", "START"}
_PARTS = {"UNION", "INTERSECT", "EXCEPT", "MINUS", ";"}
_JOINING = {"NATURAL", "LEFT", "RIGHT", "FULL", "INNER", "CROSS", "OUTER"}
_SOURCES = ("from", "join", "on", "using")

_RECORD = pa.struct([("what", pa.string()), ("query", pa.int32()), ("depth", pa.int32()), ("context", pa.string()), ("lead", pa.string()),
                     ("left", pa.string()), ("op", pa.string()), ("right", pa.string())])
_TYPE = "array<struct<what string, query int, depth int, context string, lead string, left string, op string, right string>>"


class _Scope:
    """A bracket, a CASE or the statement; places are offsets in the text."""

    def __init__(self, kind: str | None, query: int, context: str, at: int) -> None:
        self.kind, self.query, self.context = kind, query, context
        self.begin = self.operand = at  # of the current part, of the operand being read
        self.op = self.lead = self.source = None  # spans of a waiting operator, of the words before a source, of a source


def _records(sql: str) -> list[dict]:
    text = _COMMENT.sub(lambda m: m[1] or " ", sql)
    out, stack, queries, run = [], [_Scope(None, 0, "none", 0)], 0, None

    def add(what: str, lead: str | None, left: str, op: str | None, right: str | None, context: str) -> None:
        left = left.strip()
        if left and (what != "predicate" or right):
            out.append({"what": what, "query": stack[-1].query, "depth": len(stack), "context": context, "lead": lead, "left": left, "op": op, "right": right})

    def compared(stop: int) -> None:
        top = stack[-1]
        if top.op:
            a, b = top.op
            add("predicate", None, text[top.operand : a], text[a:b], text[b:stop].strip(), top.context)
        top.op = None

    def closed(stop: int) -> None:
        top = stack[-1]
        compared(stop)
        if top.kind in ("select", "from"):
            add("item" if top.kind == "select" else "from", None, text[top.begin : stop], None, None, top.kind)
        elif top.kind in ("join", "on", "using"):
            a, b = top.source if top.source else (top.begin, stop)
            tied = top.kind != "join"
            add("join", " ".join(top.lead.upper().split()), text[a:b], top.kind if tied else None, text[top.begin : stop].strip() if tied else None, "from")

    def turned(kind: str | None, context: str, at: int) -> None:
        top = stack[-1]
        top.kind, top.context, top.begin, top.operand, top.op = kind, context, at, at, None

    for token in _TOKEN.finditer(text):
        a, b = token.span()
        word, top = token[0].upper(), stack[-1]
        if word.isspace():
            continue
        before, run = run, None
        in_sources = top.kind in _SOURCES
        if word == "(":
            stack.append(_Scope(None, top.query, top.context, b))
        elif word == "CASE":
            stack.append(_Scope("case", top.query, top.context, b))
        elif word == ")" and len(stack) > 1 or word == "END" and top.kind == "case":
            closed(a)
            stack.pop()
        elif word in _COMPARISONS:
            start = top.op[1] if top.op else top.operand
            compared(a)
            top.op, top.operand = (a, b), start
        elif word in _BOUNDS:
            compared(a)
            top.operand = b
        elif word == "SELECT":
            closed(a)
            queries += 1
            turned("select", "select", b)
            top.query = queries
        elif word in ("DISTINCT", "ALL") and top.kind == "select" and not text[top.begin : a].strip():
            top.begin = top.operand = b
        elif word == "FROM" and top.kind == "select":
            closed(a)
            turned("from", "from", b)
        elif word == "WHERE" or word == "SET" and top.kind is None:
            closed(a)
            turned(word.lower(), word.lower(), b)
        elif word in _CLAUSES and (in_sources or top.kind in ("where", "clause")):
            closed(a)
            turned("clause", word.lower(), b)
        elif word in _PARTS:
            closed(a)
            turned(None, "none", b)
        elif word in _JOINING and (in_sources or top.kind is None):
            run = a if before is None else before
        elif word == "JOIN" and (in_sources or top.kind is None):
            first = a if before is None else before
            closed(first)
            turned("join", "from", b)
            top.lead, top.source = text[first:b], None
        elif word in ("ON", "USING") and top.kind == "join":
            top.source = (top.begin, a)
            turned(word.lower(), "on", b)
        elif word == "," and (top.kind == "select" or in_sources):
            closed(a)
            if in_sources:
                top.lead, top.source = ",", None
            turned("select" if top.kind == "select" else "join", top.context if top.kind == "select" else "from", b)
        elif word == ",":
            compared(a)
            top.operand = b
    while stack:  # what the text leaves open
        closed(len(text))
        stack.pop()
    return out


def _scan(sql: pa.Array) -> pa.Array:
    return pa.array([None if s is None else _records(s) for s in sql.to_pylist()], pa.list_(_RECORD))


def clauses(sql: Column) -> Column:
    """``array<struct<what, query, depth, context, lead, left, op, right>>`` of a statement, in the order in which parts end; null for null.

    ``what`` is item (``left``), from (``left`` the first source), join (``lead`` the words before the source, ``left`` the source, ``op`` on or using, ``right`` its
    condition) or predicate (``left op right``, ``context`` the clause it stands in). ``query`` numbers the SELECTs by their place, from 1;
    0 is what stands outside any. Project it once and derive from it: ``outputs``, ``all_joins`` and ``comparisons`` take this column.
    """
    return F.arrow_udf(_scan, _TYPE)(sql)


def _some(found: Column, what: str) -> Column:
    return F.filter(found, lambda r: r["what"] == what)


_ALIAS = r"(?iU)\sAS\s+([A-Za-z_]\w*|\"[^\"]+\"|`[^`]+`)\s*$"
_NAME = r"(?U)^[A-Za-z_][\w$#]*(?:\.[A-Za-z_][\w$#]*)*$"
#: A name behind an expression without AS: after a bracket, END, a literal, a number or a name.
_BARE_ALIAS = r"(?iUs)^(?:.*[)'\d]|.*\bEND|[A-Za-z_][\w.$#]*)\s+(?!END\b)([A-Za-z_]\w*)$"


def output_name(item: Column) -> Column:
    """``*``, the alias, the last part of a column, else the expression."""
    alias, bare = F.regexp_extract(item, _ALIAS, 1), F.regexp_extract(item, _BARE_ALIAS, 1)
    return (F.when(item.rlike(r"^(\w+\.)*\*$"), "*").when(alias != "", F.regexp_replace(alias, "[\"`]", ""))
            .when(bare != "", bare).when(item.rlike(_NAME), F.element_at(F.split(item, r"\."), -1)).otherwise(strip(item)))


def outputs(found: Column) -> Column:
    """Output names of every SELECT: ``array<struct<query, place, name>>``, places from 1 in the order in which items end."""
    items = F.transform(_some(found, "item"), lambda r, i: F.struct(r["query"].alias("query"), i.alias("place"), output_name(r["left"]).alias("name")))
    return F.array_sort(items)


_SOURCE = r"(?isU)^((?:[A-Za-z_][\w$#]*\.)*)([A-Za-z_][\w$#]*)(?:\s+(?:AS\s+)?([A-Za-z_]\w*))?$"


def sources(found: Column) -> Column:
    """Tables that a SELECT reads by name: ``array<struct<query, alias, table>>``; without an alias a table goes by its own name."""
    named = F.filter(found, lambda r: r["what"].isin("from", "join") & r["left"].rlike(_SOURCE))

    def one(r: Column) -> Column:
        table, alias = F.regexp_extract(r["left"], _SOURCE, 2), F.regexp_extract(r["left"], _SOURCE, 3)
        return F.struct(r["query"].alias("query"), F.when(alias != "", alias).otherwise(table).alias("alias"), table.alias("table"))

    return F.transform(named, one)


def column_uses(found: Column) -> Column:
    """Plain columns by clause: ``array<struct<query, context, column>>`` with context select, where or join, each once per SELECT."""
    items = F.transform(_some(found, "item"), lambda r: F.struct(r["query"].alias("query"), F.lit("select").alias("context"), F.regexp_extract(
        r["left"], r"(?isU)^([A-Za-z_][\w$#]*(?:\.[A-Za-z_][\w$#]*)*)(?:\s+(?:AS\s+)?[A-Za-z_]\w*)?$", 1).alias("column")))
    compared = F.flatten(F.transform(comparisons(found, "where", "on"), lambda p: F.transform(F.array(p["left"], p["right"]), lambda side: F.struct(
        p["query"].alias("query"), F.when(p["context"] == "on", "join").otherwise("where").alias("context"), side.alias("column")))))
    return F.array_distinct(F.filter(F.concat(items, compared), lambda u: u["column"].rlike(_NAME)))


def all_joins(found: Column) -> Column:
    """Every join: ``array<struct<query, side, how, table, alias, condition, shared>>``.

    ``side`` is LEFT, RIGHT, FULL, else INNER; ``how`` NATURAL, CROSS, COMMA, ON, USING or null; ``table`` the name without its schema, of a
    derived table its text with its alias; ``condition`` that of ON; ``shared`` the columns of USING.
    """
    def join(r: Column) -> Column:
        side = F.regexp_extract(r["lead"], r"\b(LEFT|RIGHT|FULL)\b", 1)
        name, alias = F.regexp_extract(r["left"], _SOURCE, 2), F.regexp_extract(r["left"], _SOURCE, 3)
        of_any = F.when(name != "", alias).otherwise(F.regexp_extract(r["left"], r"(?isU)\)\s*(?:AS\s+)?([A-Za-z_]\w*)$", 1))
        how = (F.when(r["lead"].contains("NATURAL"), "NATURAL").when(r["lead"].contains("CROSS"), "CROSS").when(r["lead"] == ",", "COMMA")
               .otherwise(F.upper(r["op"])))
        return F.struct(
            r["query"].alias("query"), F.when(side == "", "INNER").otherwise(side).alias("side"), how.alias("how"),
            F.when(name != "", name).otherwise(r["left"]).alias("table"), F.when(of_any != "", of_any).alias("alias"),
            F.when(r["op"] == "on", r["right"]).alias("condition"),
            F.when(r["op"] == "using", F.regexp_extract_all(r["right"], F.lit(r"(?U)([A-Za-z_]\w*)"), F.lit(1))).alias("shared"))

    return F.transform(_some(found, "join"), join)


def comparisons(found: Column, *contexts: str) -> Column:
    """Comparisons in clauses of ``contexts`` (where by default): ``array<struct<query, context, left, op, right>>``, as written. Each counts
    once, in the clause of its own SELECT."""
    wanted = contexts or ("where",)
    return F.transform(F.filter(found, lambda r: (r["what"] == "predicate") & r["context"].isin(*wanted)), lambda r: F.struct(
        *[r[n].alias(n) for n in ("query", "context", "left", "op", "right")]))


_LITERAL = r"(?s)^(?:'.*'|[-+]?\d[\w.]*|:\w+)$"
_FLIPPED = {"<": ">", ">": "<", "<=": ">=", ">=": "<="}


def column_first(p: Column) -> Column:
    """A comparison as ``struct<column, op, value>`` with a literal on the right: ``5 < w`` is ``w > 5``."""
    turned = p["left"].rlike(_LITERAL) & ~p["right"].rlike(_LITERAL)
    op = p["op"]
    for a, b in _FLIPPED.items():
        op = F.when(p["op"] == a, b).otherwise(op)
    return F.struct(F.when(turned, p["right"]).otherwise(p["left"]).alias("column"), F.when(turned, op).otherwise(p["op"]).alias("op"),
                    F.when(turned, p["left"]).otherwise(p["right"]).alias("value"))

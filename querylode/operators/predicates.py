"""Predicates, joins, tables and literal values mined from log text, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from querylode.functions import clauses as C
from querylode.functions import sqltext as S
from querylode.functions import tokens as K
from querylode.lineage import stored

def _sql():
    return F.col("sql_text")


def where_predicates(logs: DataFrame) -> DataFrame:
    """``(.., column_name, op, value)`` per comparison in a WHERE clause."""
    rows = logs.withColumn("_p", F.explode(S.where_predicates(_sql())))
    return rows.select(*logs.columns, F.col("_p.column").alias("column_name"), "_p.op", "_p.value")


def joins(logs: DataFrame) -> DataFrame:
    """``(.., side, table_name, alias, condition)`` per join."""
    rows = logs.withColumn("_j", F.explode(S.joins(_sql())))
    return rows.select(*logs.columns, "_j.side", F.col("_j.table").alias("table_name"), "_j.alias", "_j.condition")


def known_tables(logs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Tables a statement refers to that exist in the catalogue (compared without case)."""
    named = logs.withColumn("table_name", F.explode(S.referenced_tables(_sql())))
    known = catalogue.select(F.upper("table_name").alias("_known")).distinct()
    return named.join(known, F.upper(named["table_name"]) == F.col("_known"), "left_semi")


def _is_literal(value: Column) -> Column:
    return value.rlike("^['0-9-]")


def literal_values(logs: DataFrame) -> DataFrame:
    """Literals compared per table and column in WHERE clauses and CASE branches, counted, before masking."""
    sql = _sql()
    found = logs.select(S.alias_map(sql).alias("aliases"), S.main_table(sql).alias("main"),
                        F.explode(F.concat(S.where_predicates(sql), S.case_predicates(sql))).alias("p"))
    rows = found.filter(_is_literal(F.col("p.value"))).select(
        S.owner_table(F.col("p.column"), F.col("aliases"), F.col("main")).alias("table_name"),
        S.last_part(F.col("p.column")).alias("column_name"), F.col("p.value").alias("value"))
    return rows.groupBy("table_name", "column_name", "value").agg(F.count("*").alias("n"))


# --- nested statements ---------------------------------------------------------------------------------

def scanned(logs: DataFrame) -> DataFrame:
    """``statement, n, clauses`` of each distinct statement that was logged ``n`` times; what follows reads a text once."""
    shapes = logs.groupBy(_sql().alias("statement")).agg(F.count("*").alias("n"))
    return stored(shapes.withColumn("clauses", C.clauses(F.col("statement"))), "clauses")


def _of_logs(logs: DataFrame, rows: DataFrame) -> DataFrame:
    return logs.withColumnRenamed("sql_text", "statement").join(rows, "statement").withColumnRenamed("statement", "sql_text")


def nested_outputs(logs: DataFrame) -> DataFrame:
    """``(.., query, place, name)`` per select item of every SELECT of a statement."""
    return _of_logs(logs, scanned(logs).select("statement", F.inline(C.outputs(F.col("clauses")))))


def nested_joins(logs: DataFrame) -> DataFrame:
    """``(.., query, side, how, table, alias, condition, shared)`` per join, those of derived tables included."""
    return _of_logs(logs, scanned(logs).select("statement", F.inline(C.all_joins(F.col("clauses")))))


def nested_predicates(logs: DataFrame, *contexts: str) -> DataFrame:
    """``(.., query, context, left, op, right)`` per comparison, expressions on either side included."""
    return _of_logs(logs, scanned(logs).select("statement", F.inline(C.comparisons(F.col("clauses"), *contexts))))


def _owner(use: Column, column: Column, named: Column) -> Column:
    """The table that ``column``, which a SELECT (``use.query``) of a statement names, belongs to; ``named`` are the statement's sources.

    A qualifier is an alias of the column's own SELECT, else of the nearest earlier one that has it (correlated columns, CTEs); a column
    without one belongs to the only table its SELECT reads by name. Others (of derived tables, of several tables) have none: null.
    """
    alias = F.regexp_extract(column, r"([^.]*)\.[^.]*$", 1)
    above = F.filter(named, lambda s: (s["alias"] == alias) & (s["query"] <= use["query"]))
    nearest = F.array_max(F.transform(above, lambda s: F.struct(s["query"].alias("query"), s["table"].alias("table"))))["table"]
    own = F.filter(named, lambda s: s["query"] == use["query"])
    return F.when(alias != "", nearest).when(F.size(own) == 1, F.get(own, F.lit(0))["table"])


def nested_column_uses(logs: DataFrame) -> DataFrame:
    """``table_name, column_name, context, n``: logs that use a table's column in a SELECT list, WHERE or join condition at any depth.

    A statement's sources and uses meet inside its row, so that statements are not joined to each other's parts by their text.
    """
    read = scanned(logs).select("n", C.sources(F.col("clauses")).alias("named"), C.column_uses(F.col("clauses")).alias("uses"))
    owned = F.transform("uses", lambda u: F.struct(
        _owner(u, u["column"], F.col("named")).alias("table_name"), S.last_part(u["column"]).alias("column_name"), u["context"].alias("context")))
    once = read.select("n", F.array_distinct(F.filter(owned, lambda u: u["table_name"].isNotNull())).alias("once"))
    return K.unnest(once, "once", "u").select("n", "u.*").groupBy("table_name", "column_name", "context").agg(F.sum("n").alias("n"))


def nested_join_patterns(logs: DataFrame) -> DataFrame:
    """``table_name, target_table, join_column, join_count``, seen from both sides: equalities of two qualified columns in join conditions
    or in WHERE (of comma joins and correlated queries), and the shared columns of USING."""
    found = F.col("clauses")
    firsts = F.transform(F.filter(found, lambda r: r["what"] == "from"), lambda r: F.struct(
        r["query"].alias("query"), F.regexp_extract(r["left"], r"(?U)^(?:\w+\.)*([A-Za-z_]\w*)", 1).alias("main")))
    read = scanned(logs).select(
        "n", C.sources(found).alias("named"), C.comparisons(found, "on", "where").alias("compared"), firsts.alias("firsts"), C.all_joins(found).alias("joins"))
    qualified = r"^\w+\.\w+$"
    equal = F.filter("compared", lambda p: (p["op"] == "=") & p["left"].rlike(qualified) & p["right"].rlike(qualified))
    ends = F.transform(equal, lambda p: F.struct(
        _owner(p, p["left"], F.col("named")).alias("a"), S.last_part(p["left"]).alias("a_column"),
        _owner(p, p["right"], F.col("named")).alias("b"), S.last_part(p["right"]).alias("b_column")))
    met = K.unnest(read.select("n", ends.alias("ends")), "ends", "e").where("e.a is not null and e.b is not null").select(
        "n", F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.col("e.a_column").alias("a_column"), F.col("e.b_column").alias("b_column"))
    tied = K.unnest(read.select("n", "firsts", F.filter("joins", lambda j: j["how"] == "USING").alias("tied")), "tied", "j")
    tied = tied.select("n", "j", F.explode("firsts").alias("f")).where("f.query = j.query and f.main <> ''")
    shared = tied.select("n", F.col("f.main").alias("a"), F.col("j.table").alias("b"), F.explode("j.shared").alias("a_column")).withColumn("b_column", F.col("a_column"))
    seen = F.array(*[F.struct(F.col(x).alias("table_name"), F.col(y).alias("target_table"), F.col(f"{x}_column").alias("join_column")) for x, y in (("a", "b"), ("b", "a"))])
    both = met.unionByName(shared).select("n", F.inline(seen))
    return both.groupBy("table_name", "target_table", "join_column").agg(F.sum("n").alias("join_count"))

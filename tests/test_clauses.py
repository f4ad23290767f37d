"""Nested statements: select items, joins and comparisons."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querylode.functions import clauses as C
from querylode.functions import sqltext as S


@pytest.fixture(scope="module")
def read(spark):
    def scan(sql, of, fields):
        found = spark.createDataFrame([(sql,)], "s string").select(C.clauses(F.col("s")).alias("c")).select(of(F.col("c")).alias("x")).first().x
        return None if found is None else [tuple(r[f] for f in fields) for r in found]

    return scan


DEEP = ("WITH q AS (SELECT id, max(v) AS m FROM s.base WHERE v >= 1.5 GROUP BY id) SELECT DISTINCT q.id, (SELECT count(*) FROM z WHERE z.id = q.id) cnt "
        "FROM q JOIN (SELECT k FROM u, w x WHERE u.k = x.k) AS dd ON q.id = dd.k LEFT OUTER JOIN r USING (id, day) NATURAL JOIN n CROSS JOIN c, e f "
        "WHERE q.m IN (1,2) OR (dd.k <> 'O''x, FROM' AND EXISTS (SELECT 1 FROM h WHERE h.q = 7)) ORDER BY 1")


@pytest.mark.parametrize("sql, names", [
    ("SELECT a, b.c AS d, COUNT(DISTINCT x, y) n FROM t", [(1, "a"), (1, "d"), (1, "n")]),
    (DEEP, [(1, "id"), (1, "m"), (2, "id"), (2, "cnt"), (3, "count(*)"), (4, "k"), (5, "1")]),
    ("SELECT a FROM x UNION ALL SELECT b FROM y", [(1, "a"), (2, "b")]),
    ("SELECT EXTRACT(YEAR FROM d) AS y, /* FROM z */ \"FROM\", -- ,x\n 'a,b' FROM t", [(1, "y"), (1, '"FROM"'), (1, "'a,b'")]),
    ("SELECT ROW_NUMBER() OVER (PARTITION BY a ORDER BY b) AS rn, t.*, * FROM t", [(1, "rn"), (1, "*"), (1, "*")]),
    ("SELECT CASE WHEN a = 1 THEN 'x' END kind, trim(both ' ' from b) FROM t", [(1, "kind"), (1, "trim(both ' ' from b)")]),
    ("SELECT 1", [(1, "1")]), ("UPDATE t SET a = 1", []), ("", []), (None, None), ("((SELECT a FROM (t", [(1, "a")]), (")) SELECT a FROM t", [(1, "a")]),
])
def test_outputs_of_every_select(read, sql, names):
    assert read(sql, C.outputs, ("query", "name")) == names


def test_every_kind_of_join(read):
    fields = ("query", "side", "how", "table", "alias", "condition", "shared")
    assert read(DEEP, C.all_joins, fields) == [
        (4, "INNER", "COMMA", "w", "x", None, None),
        (2, "INNER", "ON", "(SELECT k FROM u, w x WHERE u.k = x.k) AS dd", "dd", "q.id = dd.k", None),
        (2, "LEFT", "USING", "r", None, None, ["id", "day"]), (2, "INNER", "NATURAL", "n", None, None, None),
        (2, "INNER", "CROSS", "c", None, None, None), (2, "INNER", "COMMA", "e", "f", None, None)]
    assert read("SELECT 1 FROM s.a x FULL JOIN s.b ON LEFT(x.k, 2) = b.k AND 1 < 2 RIGHT OUTER\nJOIN (c JOIN d ON c.i = d.i) ON true", C.all_joins, fields[1:6]) == [
        ("FULL", "ON", "b", None, "LEFT(x.k, 2) = b.k AND 1 < 2"), ("INNER", "ON", "d", None, "c.i = d.i"),
        ("RIGHT", "ON", "(c JOIN d ON c.i = d.i)", None, "true")]


@pytest.mark.parametrize("condition, found", [
    ("y+1 > 3 AND 5 < w AND nvl(max(a),1) = 2", [("y+1", ">", "3"), ("5", "<", "w"), ("nvl(max(a),1)", "=", "2")]),
    ("CASE WHEN p = 1 THEN 2 ELSE 3 END = 2", [("p", "=", "1"), ("CASE WHEN p = 1 THEN 2 ELSE 3 END", "=", "2")]),
    ("a BETWEEN 1 AND 3 AND (b = 'x' OR NOT c <> 'O''y') AND d LIKE 'q = 1'", [("b", "=", "'x'"), ("c", "<>", "'O''y'")]),
    ("a = (SELECT max(b) FROM u WHERE u.c = t.c)", [("u.c", "=", "t.c"), ("a", "=", "(SELECT max(b) FROM u WHERE u.c = t.c)")]),
    ("a >= 1 ORDER BY b = 2", [("a", ">=", "1")]), ("a", []), ("a =", []),
])
def test_comparisons(read, condition, found):
    assert read(f"SELECT 1 FROM t WHERE {condition}", C.comparisons, ("left", "op", "right")) == found


def test_literals_go_to_the_right(spark):
    rows = spark.createDataFrame([("5", "<", "w"), ("a", "=", "'x'"), ("1", "=", "2")], "left string, op string, right string")
    found = rows.select(C.column_first(F.struct("left", "op", "right")).alias("p")).collect()
    assert [tuple(r.p) for r in found] == [("w", ">", "5"), ("a", "=", "'x'"), ("1", "=", "2")]


def test_long_and_deep_statements(read):
    wide = "SELECT " + ", ".join(f"c{i} + 1 AS d{i}" for i in range(20_000)) + " FROM t WHERE " + " AND ".join(f"x{i} = {i}" for i in range(5_000))
    assert len(read(wide, C.outputs, ("name",))) == 20_000 and len(read(wide, C.comparisons, ("left",))) == 5_000
    deep = "SELECT 1 FROM (" * 5_000 + "t" + ")" * 5_000
    assert len(read(deep, C.outputs, ("name",))) == 5_000


@pytest.mark.parametrize("closed", [True, False])
def test_literals_of_many_doubled_quotes(spark, closed):
    text = "'" + "''" * 400_000 + ("'" if closed else "x")
    rows = spark.createDataFrame([(f"SELECT a FROM t WHERE b = {text}",)], "s string")
    got = rows.select(S.mask_literals(F.col("s")).alias("m"), S.where_predicates(F.col("s")).alias("p"), S.safety_reasons(F.col("s")).alias("r")).first()
    assert got.m == "SELECT a FROM t WHERE b = :placeholder" + ("" if closed else "'x")
    assert got.r == [] and (not closed or [p.column for p in got.p] == ["b"])


def test_literal_pattern_equals_the_plain_one(spark):
    """All short texts of quotes and letters against the pattern as first stated."""
    import re
    from itertools import product

    plain = re.compile(r"'[^']*(?:''[^']*)*'")
    texts = ["".join(t) for n in range(10) for t in product("'a", repeat=n)]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", F.regexp_replace("s", S.STRING_LITERAL, "L").alias("m")).collect()
    assert all(plain.sub("L", r.s) == r.m for r in rows)

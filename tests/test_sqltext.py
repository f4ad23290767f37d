from pyspark.sql import functions as F
import pytest

from querylode.functions import sqltext as S
from querylode.functions import tokens as K


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "s string").select(expr(F.col("s")).alias("x")).first().x


@pytest.mark.parametrize("text, masked", [
    ("col1, col2 FROM table1 id = 5", "col1, col2 FROM table1 id = :placeholder"),
    ("MES_PRD_YIELD_M10 x", "MES_PRD_YIELD_M1:placeholder x"),
    (":1 AND :2", ":1 AND :2"), (":12", ":1:placeholder"),
    ("3.14x", ":placeholder.14x"), ("12abc", "12abc"), ("1.", ":placeholder"),
    ("a1b22 3.5.6", "a1b2:placeholder :placeholder.:placeholder"),
    ("name = 'O''Brien' AND x = 'a'", "name = :placeholder AND x = :placeholder"),
    ("x = -7", "x = -:placeholder"), ("v = 'open", "v = 'open"),
])
def test_masking(spark, text, masked):
    assert one(spark, text, S.mask_literals) == masked


def test_strict_masking_keeps_identifiers(spark):
    assert one(spark, "SELECT a FROM T_M10 WHERE b = 12 AND c = :12", lambda c: S.mask_literals(c, True)) == \
        "SELECT a FROM T_M10 WHERE b = :placeholder AND c = :12"


def test_tables_keep_order_and_duplicates(spark):
    sql = "SELECT 1 FROM a JOIN x.b ON 1=1 WHERE k IN (SELECT k FROM a) UNION SELECT 1 from C join d ON 1=1"
    assert one(spark, sql, S.tables) == ["a", "a", "C", "x.b", "d"]


@pytest.mark.parametrize("sql, columns, error", [
    ("SELECT a, t.b AS x, COUNT(*) n FROM t", ["a", "b", "COUNT(*)"], None),
    ("SELECT DISTINCT a FROM t", ["DISTINCT"], None), ("SELECT * FROM t", ["*"], None),
    ("SELECT ROUND(a, 2) r FROM t", ["ROUND(a", "2)"], None),
    ("UPDATE t SET a = 1", [], None), ("SELECT a,, b FROM t", None, "blank select item"),
])
def test_select_columns(spark, sql, columns, error):
    got = one(spark, sql, S.select_columns)
    assert (got.columns, got.error) == (columns, error)


def test_select_outputs_respect_parentheses(spark):
    sql = "SELECT a, ROUND(COUNT(*) * 1.0 / SUM(COUNT(*)) OVER (), 2) AS pct, (SELECT MAX(x) FROM u) AS m, t.c FROM t"
    assert one(spark, sql, S.select_outputs) == ["a", "pct", "m", "c"]


def test_where_columns_and_predicates(spark):
    sql = "SELECT 1 FROM t x WHERE x.a = 'p = q' AND b >= 3 OR c LIKE 'z' ORDER BY a"
    assert one(spark, sql, S.where_columns) == ["a", "b", "c"]
    got = [tuple(p) for p in one(spark, sql, S.where_predicates)]
    assert got == [("x.a", "=", "'p = q'"), ("b", ">=", "3")]


def test_joins(spark):
    sql = "SELECT 1 FROM a LEFT OUTER JOIN b y ON a.k = y.k INNER JOIN c ON c.j = a.j WHERE 1 = 1"
    got = [tuple(j) for j in one(spark, sql, S.joins)]
    assert got == [("LEFT", "b", "y", "a.k = y.k"), ("INNER", "c", "", "c.j = a.j")]


@pytest.mark.parametrize("sql, ddl, dml, system", [
    (" create table t (a int)", True, False, False), ("DELETE FROM t", False, True, False),
    ("SELECT * FROM SYS.X", False, False, True), ("SELECT user_id FROM t", False, False, True),
    ("SELECT users FROM t", False, False, False), ("CREATED", False, False, False),
    ("WITH a AS (SELECT 1) SELECT * FROM a", False, False, False),
])
def test_classes(spark, sql, ddl, dml, system):
    row = spark.createDataFrame([(sql,)], "s string").select(
        S.is_ddl(F.col("s")), S.is_dml(F.col("s")), S.is_system(F.col("s"))).first()
    assert tuple(row) == (ddl, dml, system)


def test_strict_system_filter_keeps_business_columns(spark):
    assert not one(spark, "SELECT user_id, all_flag FROM t", lambda c: S.is_system(c, True))
    assert one(spark, "SELECT * FROM dba_tables", lambda c: S.is_system(c, True))


@pytest.mark.parametrize("comment, bad", [
    (None, True), ("abc", True), ("  abc  ", True), ("LOT 마스터", True), ("STATUS", True), ("Lot master table", False),
    ("VERY LONG CAPITALS", False), ("로트 마스터 정보", False),
])
def test_comment_quality(spark, comment, bad):
    assert one(spark, comment, S.insufficient_comment) is bad


def test_safety(spark):
    assert one(spark, "SELECT 'drop; table' FROM t", S.safety_reasons) == []
    assert one(spark, "SELECT 1; DROP TABLE t", S.safety_reasons) == ["not one statement", "forbidden DROP"]


def test_tokens(spark):
    assert one(spark, "M10 팹의 수율 데이터를 보여줘 a", K.keywords) == ["M10", "팹의", "수율", "데이터를"]
    assert one(spark, "Show M11 Yield", lambda c: K.topics(c)) == ["yield"]
    assert one(spark, "abcd", lambda c: K.char_shingles(c, 3)) == ["abc", "bcd"]
    assert one(spark, "ab", lambda c: K.char_shingles(c, 3)) == []


def test_select_outputs_of_long_deep_and_compound_statements(spark):
    cases = [
        ("SELECT " + ", ".join(f"c{i}" for i in range(1000)) + " FROM t", [f"c{i}" for i in range(1000)]),
        ("SELECT " + "(" * 12 + "a" + ")" * 12 + " AS z, b FROM t", ["z", "b"]),
        ("WITH a AS (SELECT x, y FROM t) SELECT a.x AS p, f(a.y, 2) AS q FROM a", ["p", "q"]),
        ("-- c, d\nSELECT a /* x, y */, b FROM t", ["a", "b"]), ("(SELECT a FROM t) UNION (SELECT b FROM u)", ["a"]),
        ("SELECT EXTRACT(YEAR FROM d) AS y, 'a, FROM b' AS s FROM t", ["y", "s"]), ("SELECT a FROM (SELECT b, c FROM u) x", ["a"]),
        ("SELECT CASE WHEN a = 1 THEN 'x' ELSE y END AS k, t.m FROM t", ["k", "m"]), ("SELECT 1", []), ("CREATE TABLE t AS SELECT a FROM u", []),
        ("SELECT DISTINCT a, b FROM t", ["a", "b"]), ("SELECT '" + "''" * 2000 + "' AS q FROM t", ["q"]), (None, []), ("", []),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "i int, s string")
    got = {r.i: r.o for r in df.select("i", S.select_outputs(F.col("s")).alias("o")).collect()}
    for i, (sql, want) in enumerate(cases):
        assert got[i] == want, (sql or "")[:80]


def test_predicates_of_calls(spark):
    df = spark.createDataFrame([("SELECT 1 FROM t WHERE UPPER(c) = 'X' AND d > 3",)], "s string")
    assert [tuple(p) for p in df.select(S.where_predicates(F.col("s"))).first()[0]] == [("UPPER(c)", "=", "'X'"), ("d", ">", "3")]

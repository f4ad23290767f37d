"""Logs, questions and a glossary derived from the star-schema tables.

The star schema carries no query log, so statements are rendered from ``events``: each event becomes one
logged statement (or one labelled question) whose literals come from the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PARTS = ("*", "CAST(event_id AS STRING) AS e", "CAST(user_id AS STRING) AS u",
          "CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS v", "regexp_extract(props, '([0-9]+)', 1) AS k")

LOG_COLUMNS = (
    "concat('EV', lpad(CAST(event_id AS STRING), 9, '0')) AS sql_id",
    """CASE event_id % 12
    WHEN 0 THEN concat('SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = ', u, ' AND o_totalprice > ', v)
    WHEN 1 THEN concat('SELECT c.c_name, o.o_totalprice FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_orderpriority = ''', event_type, '''')
    WHEN 2 THEN concat('SELECT l_returnflag, SUM(l_quantity) AS qty FROM lineitem WHERE l_quantity > ', k, '.5 GROUP BY l_returnflag')
    WHEN 3 THEN concat('SELECT p_name, p_size FROM part WHERE p_size IN (', k, ', ', u, ', 7)')
    WHEN 4 THEN concat('SELECT ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS rn, s_name FROM supplier WHERE s_acctbal > ', v)
    WHEN 5 THEN concat('INSERT INTO orders (o_orderkey, o_custkey) VALUES (', e, ', ', u, ')')
    WHEN 6 THEN concat('UPDATE part SET p_size = ', k, ' WHERE p_partkey = ', e)
    WHEN 7 THEN concat('SELECT user_id, value FROM events WHERE event_type = ''', event_type, '''')
    WHEN 8 THEN concat('SELECT n.n_name, r.r_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = ''O', chr(39), chr(39), event_type, '''')
    WHEN 9 THEN concat('select o_orderkey,  o_totalprice from orders where o_custkey = ', u, ' and o_totalprice > ', v)
    WHEN 10 THEN concat('CREATE TABLE tmp_', e, ' AS SELECT * FROM lineitem WHERE l_orderkey = ', v)
    ELSE concat('SELECT amount FROM sales_m', CAST(10 + event_id % 5 AS STRING), ' WHERE lot = ''L', v, '''')
  END AS sql_text""",
    "CAST(k AS BIGINT) + 1 AS exec_count",
    "CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS error_count",
    "ts AS collected_at",
    "CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'TPCH' END AS schema_name",
)

#: Statements with nested SELECTs, every kind of join and operands that are expressions.
NESTED_TEXT = """CASE event_id % 6
    WHEN 0 THEN concat('WITH big AS (SELECT o_custkey, SUM(o_totalprice) AS total FROM orders WHERE o_totalprice > ', v, ' GROUP BY o_custkey) ',
      'SELECT c.c_name, b.total FROM customer c JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = ', k, ') n ',
      'ON c.c_nationkey = n.n_nationkey LEFT JOIN big b USING (o_custkey) WHERE b.total + 1 > ', u)
    WHEN 1 THEN concat('SELECT s_name FROM supplier WHERE ', k, ' < s_acctbal UNION ALL SELECT p_name AS s_name FROM part WHERE p_size + ', k, ' >= ', u)
    WHEN 2 THEN concat('SELECT o.o_orderkey FROM orders o, lineitem l WHERE o.o_orderkey = l.l_orderkey ',
      'AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.o_custkey AND c_acctbal <> ', v, ')')
    WHEN 3 THEN concat('SELECT * FROM nation NATURAL JOIN region CROSS JOIN supplier WHERE n_regionkey IN ',
      '(SELECT r_regionkey FROM region WHERE r_name = ''O', chr(39), chr(39), event_type, ''')')
    WHEN 4 THEN concat('SELECT COUNT(DISTINCT user_id) AS users, MAX(value) FROM events e WHERE nvl(max(value), 1) = ', k,
      ' AND CASE WHEN e.user_id > ', u, ' THEN 1 ELSE 0 END = 1')
    ELSE concat('INSERT INTO part SELECT p.p_partkey, p_name FROM part p FULL OUTER JOIN lineitem ON p.p_partkey = lineitem.l_partkey ',
      'AND lineitem.l_quantity > ', k)
  END AS sql_text"""

QUESTION_COLUMNS = (
    "event_id AS question_id",
    """CASE event_id % 8
    WHEN 0 THEN concat('Show orders and total price of customer ', u)
    WHEN 1 THEN concat('Which supplier in nation ', k, ' has the best account balance')
    WHEN 2 THEN concat('List lineitem quantity and discount for part ', e)
    WHEN 3 THEN concat('customer market segment ', event_type)
    WHEN 4 THEN concat('name of every nation per region, top ', k)
    WHEN 5 THEN concat('retail price and brand of part with size ', k)
    WHEN 6 THEN concat('ship date and return flag history of order ', e)
    ELSE concat('who sells ', event_type, ' goods')
  END AS question""",
    """CASE event_id % 8
    WHEN 0 THEN 'orders,customer' WHEN 1 THEN 'supplier,nation' WHEN 2 THEN 'lineitem,part' WHEN 3 THEN 'customer'
    WHEN 4 THEN 'nation,region' WHEN 5 THEN 'part' WHEN 6 THEN 'lineitem,orders' ELSE 'supplier' END AS truth""",
)


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*PARTS)


def sql_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged statement per event."""
    return _rendered(spark, sf_dir).selectExpr(*LOG_COLUMNS)


def nested_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged statement with nested queries per event: ``sql_id, sql_text``."""
    return _rendered(spark, sf_dir).selectExpr(LOG_COLUMNS[0], NESTED_TEXT)


def profiled_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged statements with an execution time (the event value) and a result size (its counter)."""
    return _rendered(spark, sf_dir).selectExpr(
        *LOG_COLUMNS, "CAST(round(value * 100) AS BIGINT) AS exec_time", "CAST(k AS BIGINT) AS result_rows")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per event: ``question_id, question``."""
    return _rendered(spark, sf_dir).selectExpr(*QUESTION_COLUMNS[:2])


def question_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that answer each question: ``question_id, table_name``."""
    rows = _rendered(spark, sf_dir).selectExpr(QUESTION_COLUMNS[0], QUESTION_COLUMNS[2])
    return rows.select("question_id", F.explode(F.split("truth", ",")).alias("table_name"))


GLOSSARY_COLUMNS = (
    "p_name AS term", "p_brand AS korean_name", "concat(lower(p_type), ' part of ', p_brand) AS description",
    "CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS category", "p_partkey AS pos",
)


def glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glossary with one entry per part; ``pos`` is the file order."""
    return table(spark, sf_dir, "part").selectExpr(*GLOSSARY_COLUMNS)

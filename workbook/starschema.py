"""The query shapes of the log corpus, run on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.plans import shapes
from querylode.sources import derived
from workbook import query

SHAPES = {
    "w1_point_and_range": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 370
  AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'""",
    "w2_left_join_not_null": """SELECT o.o_orderkey, o.o_orderpriority, c.c_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderpriority IS NOT NULL AND o.o_orderdate >= TIMESTAMP '1996-01-01'""",
    "w3_daily_buckets": """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n, round(avg(l_discount), 6) AS avg_discount,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1""",
    "w4_throughput": """SELECT n_nationkey, n_name, CAST(count(o_orderkey) AS BIGINT) AS throughput, round(avg(o_totalprice), 4) AS avg_price
  FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
    "w5_union_all": """SELECT 'O' AS part, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1996-01-01' UNION ALL
  SELECT 'F', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01' UNION ALL
  SELECT 'P', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1996-01-01'""",
    "w6_share_of_total": """SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM events GROUP BY 1""",
    "w7_row_number": """SELECT s_nationkey, s_suppkey, s_acctbal, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS BIGINT) AS rn
  FROM supplier WHERE s_acctbal IS NOT NULL""",
    "w8_in_list_join": """SELECT l_orderkey, l_linenumber, l_returnflag, p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'R') AND p_size IN (1, 7)""",
    "w9_conditional_sums": """SELECT c_custkey, c_name, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END), 0) AS DOUBLE) AS failed_total,
  CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS failed_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
    "w10_distinct": "SELECT DISTINCT p_brand, p_type FROM part",
    "w11_scalar_subquery": """SELECT o_orderkey, o_custkey, (SELECT round(avg(l_discount), 6) FROM lineitem WHERE l_orderkey = o_orderkey) AS avg_discount
  FROM orders WHERE o_orderstatus = 'P'""",
    "w12_derived_aggregate": """SELECT p_partkey, p_name, lines, avg_discount FROM part JOIN (SELECT l_partkey, CAST(count(*) AS BIGINT) AS lines, round(avg(l_discount), 6) AS avg_discount
  FROM lineitem GROUP BY 1) t ON t.l_partkey = p_partkey WHERE avg_discount > 0.05""",
    "w13_weighted_rank": """SELECT l_suppkey, weighted, CAST(rank() OVER (ORDER BY weighted DESC) AS BIGINT) AS rank FROM (SELECT l_suppkey,
  round(CAST(sum(CAST(l_discount AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 4) AS weighted FROM lineitem GROUP BY 1)""",
    "w14_top_100": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "w15_ratio_having": """SELECT l_partkey, round(CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) * 100 / CAST(sum(CAST(l_tax AS DECIMAL(18,2))) + sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE), 2) AS utilization
  FROM lineitem GROUP BY 1 HAVING sum(CAST(l_tax AS DECIMAL(18,2))) + sum(CAST(l_discount AS DECIMAL(18,2))) > 0""",
    "w16_lag_per_key": "SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events",
    "w17_hours_between": """SELECT o_orderkey, l_linenumber, round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3600000000.0, 2)::DOUBLE AS hours
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate >= TIMESTAMP '2000-01-01'""",
    "w18_spread_having": """SELECT c_mktsegment, n_name, round(avg(c_acctbal), 4) AS avg_balance, round(stddev_samp(c_acctbal), 4) AS spread, min(c_acctbal) AS low, max(c_acctbal) AS high
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 HAVING count(*) >= 10""",
}


def _register(name: str, sql: str) -> None:
    build = getattr(shapes, name.split("_", 1)[1])

    def run(spark, d):
        tables = {t: derived.table(spark, d, t) for t in derived.TABLES[:8]}
        return build(tables)

    query(name, sql)(run)


for _name, _sql in SHAPES.items():
    _register(_name, _sql)

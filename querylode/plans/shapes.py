"""The relational shapes found in the log corpus, on the star schema.

Money is summed as decimals: the result then does not depend on the order of addition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from querylode.operators import ordering

Tables = dict[str, DataFrame]


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def point_and_range(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t["orders"].filter((F.col("o_custkey") == 370) & (day >= _at("1996-01-01")) & (day < _at("2000-01-01"))).select(
        "o_orderkey", "o_totalprice")


def left_join_not_null(t: Tables) -> DataFrame:
    orders = t["orders"].filter(F.col("o_orderpriority").isNotNull() & (F.col("o_orderdate") >= _at("1996-01-01")))
    rows = orders.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.select("o_orderkey", "o_orderpriority", "c_name").orderBy("o_orderkey")


def daily_buckets(t: Tables) -> DataFrame:
    return t["lineitem"].groupBy(F.date_format(F.date_trunc("day", "l_shipdate"), "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.sum(_exact("l_quantity")).cast("double").alias("quantity"))


def throughput(t: Tables) -> DataFrame:
    # Orders are counted per customer before they meet the nations.
    per = t["orders"].groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"), F.sum(_exact("o_totalprice")).alias("total"))
    rows = per.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_nationkey", "n_name").agg(
        F.sum("n").alias("throughput"), F.round(F.sum("total").cast("double") / F.sum("n"), 4).alias("avg_price"))


def union_all(t: Tables) -> DataFrame:
    rows = t["orders"].filter(F.col("o_orderdate") >= _at("1996-01-01"))
    parts = [rows.filter(F.col("o_orderstatus") == s).select(F.lit(s).alias("part"), "o_orderkey", "o_totalprice") for s in "OFP"]
    return reduce(DataFrame.unionByName, parts)


def share_of_total(t: Tables) -> DataFrame:
    counts = t["events"].groupBy("event_type").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 4))


def row_number(t: Tables) -> DataFrame:
    rows = t["supplier"].filter("s_acctbal IS NOT NULL").select("s_nationkey", "s_suppkey", "s_acctbal")
    return ordering.running_total(rows, ["s_nationkey"], "s_acctbal", F.lit(1).cast("long"), "rn", tie="s_suppkey", descending=True)


def in_list_join(t: Tables) -> DataFrame:
    lines = t["lineitem"].filter(F.col("l_returnflag").isin("A", "R"))
    parts = t["part"].filter(F.col("p_size").isin(1, 7))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_returnflag", "p_name")


def conditional_sums(t: Tables) -> DataFrame:
    failed = F.col("o_orderstatus") == "F"
    per = t["orders"].groupBy("o_custkey").agg(
        F.sum(F.when(failed, _exact("o_totalprice")).otherwise(0)).alias("failed_total"), F.count_if(failed).alias("failed_count"))
    rows = t["customer"].join(per, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.select("c_custkey", "c_name", F.coalesce(F.col("failed_total").cast("double"), F.lit(0.0)).alias("failed_total"),
                       F.coalesce("failed_count", F.lit(0)).alias("failed_count"))


def distinct(t: Tables) -> DataFrame:
    return t["part"].select("p_brand", "p_type").distinct().orderBy("p_brand", "p_type")


def scalar_subquery(t: Tables) -> DataFrame:
    means = t["lineitem"].groupBy("l_orderkey").agg(F.round(F.avg("l_discount"), 6).alias("avg_discount"))
    orders = t["orders"].filter("o_orderstatus = 'P'")
    return orders.join(means, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_custkey", "avg_discount")


def derived_aggregate(t: Tables) -> DataFrame:
    per = t["lineitem"].groupBy("l_partkey").agg(F.count("*").alias("lines"), F.round(F.avg("l_discount"), 6).alias("avg_discount"))
    rows = t["part"].join(per.filter("avg_discount > 0.05"), F.col("p_partkey") == F.col("l_partkey"))
    return rows.select("p_partkey", "p_name", "lines", "avg_discount")


def weighted_rank(t: Tables) -> DataFrame:
    share = F.sum(_exact("l_discount") * _exact("l_quantity")).cast("double") / F.sum(_exact("l_quantity")).cast("double")
    per = t["lineitem"].groupBy("l_suppkey").agg(F.round(share, 4).alias("weighted"))
    return ordering.competition_rank(per, [], "weighted").select("l_suppkey", "weighted", "rank")


def top_100(t: Tables) -> DataFrame:
    rows = t["orders"].filter("o_totalprice > 0").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


def ratio_having(t: Tables) -> DataFrame:
    per = t["lineitem"].groupBy("l_partkey").agg(F.sum(_exact("l_tax")).alias("tax"), F.sum(_exact("l_discount")).alias("discount"))
    both = F.col("tax") + F.col("discount")
    return per.filter(both > 0).select("l_partkey", F.round(F.col("tax").cast("double") * 100 / both.cast("double"), 2).alias("utilization"))


def lag_per_key(t: Tables) -> DataFrame:
    rows = t["events"].select("event_id", "user_id", "ts", "value")
    return ordering.lag_in_key(rows, "user_id", "ts", "event_id", "value", "previous", F.to_date("ts")).drop("ts")


def hours_between(t: Tables) -> DataFrame:
    lines = t["lineitem"].filter(F.col("l_shipdate") >= _at("2000-01-01")).select("l_orderkey", "l_linenumber", "l_shipdate")
    rows = lines.join(t["orders"].select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    return rows.select("o_orderkey", "l_linenumber", F.round(micros / 3600000000, 2).alias("hours"))


def spread_having(t: Tables) -> DataFrame:
    rows = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    per = rows.groupBy("c_mktsegment", "n_name").agg(
        F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("avg_balance"), F.round(F.stddev_samp("c_acctbal"), 4).alias("spread"),
        F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))
    return per.filter("n >= 10").drop("n")

"""Log filters, their audit, and log ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from querylode.functions import sqltext as S

def failed() -> Column:
    return F.col("error_count") > 0


def valid(sql: str = "sql_text", strict: bool = False) -> Column:
    """Not failed, no DDL, no DML, no system object.  Other statement kinds pass."""
    c = F.col(sql)
    return ~failed() & ~S.is_ddl(c) & ~S.is_dml(c) & ~S.is_system(c, strict)


def keep_valid(logs: DataFrame, strict: bool = False) -> DataFrame:
    return logs.filter(valid(strict=strict))


def rank_logs(logs: DataFrame, top_n: int | None = None) -> DataFrame:
    """Most executed first, analytic statements first among equals; None is all rows, 0 is none."""
    ranked = (logs.withColumn("has_analytics", S.has_analytics(F.col("sql_text")))
              .orderBy(F.desc("exec_count"), F.desc("has_analytics"), "sql_id"))
    return ranked if top_n is None else ranked.limit(top_n)


def rejection_reasons() -> Column:
    """All reasons for which the validity filter drops a log."""
    c = F.col("sql_text")
    return F.array_compact(F.array(
        F.when(failed(), "error"), F.when(S.is_dml(c), "DML"), F.when(S.is_ddl(c), "DDL"),
        F.when(S.is_system(c), "system")))


def audit(logs: DataFrame) -> DataFrame:
    """One row per rejected log with its reasons."""
    return logs.withColumn("reasons", rejection_reasons()).filter(F.size("reasons") > 0)


def audit_counts(logs: DataFrame) -> DataFrame:
    return audit(logs).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def comment_quality(commented: DataFrame, comment: str, min_length: int = 5) -> DataFrame:
    """Counts of distinct comments with their verdict."""
    return (commented.groupBy(comment).agg(F.count("*").alias("n"))
            .withColumn("insufficient", S.insufficient_comment(F.col(comment), min_length)))

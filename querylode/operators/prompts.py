"""Prompt and search-document rendering from registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from querylode.operators.ordering import top_k

# Default prompt and context labels.
DEFAULT_PROMPT = "다음 SQL 쿼리를 한국어로 간단히 설명해주세요:\n\n"
CONTEXT_TITLE = "### 테이블 정보"

# Headers of the metadata prompts by language.
HEADERS = {
    "ko": "당신은 데이터베이스 전문가입니다. 제공된 정보만으로 설명을 한국어 JSON으로 작성하세요.",
    "en": "You are a database expert. Describe the object from the given facts only, as JSON in English.",
}
INPUT_TITLE = "### 입력 데이터"


def sql_prompt(masked: Column, prefix: str = DEFAULT_PROMPT) -> Column:
    return F.concat(F.lit(prefix), masked)


def table_context(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """``table_name, context``: one text block per table with its columns in order."""
    lines = columns.groupBy("table_name").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.concat(F.lit("  - "), "column_name", F.lit(": "), F.coalesce("description", F.lit(""))).alias("line")
    ))).alias("l"))
    block = F.concat(F.lit("\n테이블: "), "table_name", F.lit(" ("), F.coalesce("description", F.lit("")), F.lit(")\n컬럼:"))
    return (tables.select("table_name", block.alias("head")).join(lines, "table_name", "left")
            .select("table_name", F.concat_ws("\n", "head", F.col("l.line")).alias("context")))


def prompts_with_context(templates: DataFrame, contexts: DataFrame) -> DataFrame:
    """Prompt per template with the blocks of its tables in order of use; unknown tables are left out."""
    used = templates.select("template_id", F.posexplode(F.array_distinct("tables")).alias("at", "table_name"))
    blocks = (used.join(contexts, "table_name").groupBy("template_id")
              .agg(F.array_sort(F.collect_list(F.struct("at", "context"))).alias("b")))
    text = F.concat(F.concat_ws("\n", F.lit(CONTEXT_TITLE), F.col("b.context")), F.lit("\n\n" + DEFAULT_PROMPT),
                    F.col("template_text"))
    return templates.join(blocks, "template_id", "left").select("template_id", text.alias("prompt"))


def search_documents(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """``table_name, pos, document``: name, description, purpose, then name, description and samples per column."""
    cell = F.concat_ws(" ", "column_name", F.coalesce("description", F.lit("")),
                       F.coalesce("sample_values", F.array().cast("array<string>")))
    cells = columns.groupBy("table_name").agg(F.array_sort(F.collect_list(F.struct("pos", cell.alias("t")))).alias("c"))
    return tables.join(cells, "table_name", "left").select(
        "table_name", "pos", F.concat_ws(" ", "table_name", "description", "purpose", F.col("c.t")).alias("document"))


def _ordered(df: DataFrame, keys: list[str], order: str, item: Column, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, item.alias("item")))).alias("_l")).select(
        *keys, F.col("_l.item").alias(out))


def _json(*fields: Column | str) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _prompt(payload: Column, language: str) -> Column:
    return F.concat(F.lit(f"{HEADERS[language]}\n\n{INPUT_TITLE}\n```json\n"), payload, F.lit("\n```"))


def table_payloads(tables: DataFrame, columns: DataFrame, sqls: DataFrame, joins: DataFrame, wheres: DataFrame,
                   rows: DataFrame, language: str = "ko") -> DataFrame:
    """``table_name, payload, prompt`` for the description of a table.

    Inputs hold ``table_name`` and an order: columns (``pos, column_name, data_type, system_comment, sample_values,
    statistics``), sqls (``pos, sql_text``), joins (``pos, target_table, join_column``), wheres (``pos, condition,
    count``), rows (``pos, row`` as JSON text).  5 samples, 5 statements and 10 rows at most.
    """
    empty = F.array().cast("array<string>")
    column = F.struct(F.col("column_name").alias("name"), F.col("data_type").alias("type"), "system_comment",
                      F.slice(F.coalesce("sample_values", empty), 1, 5).alias("sample_values"), "statistics")
    parts = [
        _ordered(columns, ["table_name"], "pos", column, "columns"),
        _ordered(top_k(sqls, ["table_name"], [F.asc("pos")], 5), ["table_name"], "pos", F.col("sql_text"), "sample_sqls"),
        _ordered(joins, ["table_name"], "pos", F.concat("target_table", F.lit(" ("), "join_column", F.lit(")")),
                 "join_patterns"),
        _ordered(wheres, ["table_name"], "pos", F.struct("condition", F.col("count").alias("frequency")), "where_patterns"),
        _ordered(top_k(rows, ["table_name"], [F.asc("pos")], 10), ["table_name"], "pos", F.col("row"), "sample_data"),
    ]
    out = tables
    for part in parts:
        out = out.join(part, "table_name", "left")
    listed = [F.coalesce(c, empty).alias(c) for c in ("sample_sqls", "join_patterns")]
    payload = _json(F.lit("테이블 설명 생성").alias("task"), "table_name", "schema_name", "system_comment", "sql_count",
                    "columns", *listed, "where_patterns", F.coalesce("sample_data", empty).alias("sample_data"))
    return out.select("table_name", payload.alias("payload")).withColumn("prompt", _prompt(F.col("payload"), language))


def column_payloads(columns: DataFrame, sqls: DataFrame, language: str = "ko") -> DataFrame:
    """``table_name, column_name, payload, prompt``: at most 10 samples and 5 statements of the table whose upper
    text contains the column name."""
    named = columns.select("table_name", "column_name").join(sqls, "table_name")
    named = named.filter(F.upper("sql_text").contains(F.col("column_name")))
    keys = ["table_name", "column_name"]
    used = _ordered(top_k(named, keys, [F.asc("pos")], 5), keys, "pos", F.col("sql_text"), "sample_sqls")
    empty = F.array().cast("array<string>")
    payload = _json(F.lit("컬럼 설명 생성").alias("task"), "table_name", "column_name", "data_type", "system_comment",
                    F.slice(F.coalesce("sample_values", empty), 1, 10).alias("sample_values"), "statistics",
                    "usage_context", F.coalesce("sample_sqls", empty).alias("sample_sqls"))
    out = columns.join(used, keys, "left").select(*keys, payload.alias("payload"))
    return out.withColumn("prompt", _prompt(F.col("payload"), language))

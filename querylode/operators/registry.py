"""Table and column registries kept from the log, and the jobs around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from querylode.functions import sqltext as S
from querylode.lineage import cut
from querylode.operators import filters
from querylode.operators.ordering import competition_rank, first_per_key

CONTEXTS = ("select", "where", "join", "group_by", "aggregate")


def statement_groups(logs: DataFrame) -> DataFrame:
    """Logs grouped by masked statement, identifiers intact: ``statement, schema_name, n, exec_count, first_seen_at,
    last_seen_at``.  What follows parses each statement shape once instead of every log."""
    masked = S.mask_literals(F.col("sql_text"), strict=True).alias("statement")
    return logs.groupBy(masked, "schema_name").agg(
        F.count("*").alias("n"), F.sum("exec_count").alias("exec_count"),
        F.min("collected_at").alias("first_seen_at"), F.max("collected_at").alias("last_seen_at"))


def table_registry(logs: DataFrame) -> DataFrame:
    """Tables seen in the log: ``table_name, schema_name, first_seen_at, last_seen_at, sql_count, meta_status``."""
    used = statement_groups(logs).withColumn("table_name", F.explode(F.array_distinct(S.tables(F.col("statement")))))
    return used.groupBy("table_name").agg(
        F.min("schema_name").alias("schema_name"), F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"), F.sum("n").alias("sql_count"),
    ).withColumn("meta_status", F.lit("pending"))


def merge_table_registry(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert a batch: known tables keep their status and first sighting, new ones start as pending."""
    both = existing.unionByName(batch)
    merged = both.groupBy("table_name").agg(
        F.min("schema_name").alias("schema_name"), F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"), F.sum("sql_count").alias("sql_count"))
    status = existing.select("table_name", "meta_status")
    return merged.join(status, "table_name", "left").withColumn("meta_status", F.coalesce("meta_status", F.lit("pending")))


def _uses(sql: Column) -> Column:
    equal = S.join_equalities(sql)
    found = {
        "select": S.plain_select_columns(sql), "where": F.regexp_extract_all(
            F.regexp_extract(sql, S.WHERE_CLAUSE, 1), F.lit(S.WHERE_COLUMN), F.lit(1)),
        "join": F.concat(F.transform(equal, lambda e: e["left"]), F.transform(equal, lambda e: e["right"])),
        "group_by": S.group_by_columns(sql), "aggregate": S.aggregate_columns(sql),
    }

    def labelled(context: str) -> Column:
        return F.transform(F.array_distinct(found[context]),
                           lambda x: F.struct(F.lit(context).alias("context"), x.alias("column")))

    return F.concat(*map(labelled, CONTEXTS))


def column_uses(logs: DataFrame) -> DataFrame:
    """``table_name, column_name, context, n, first_seen_at, last_seen_at`` per statement shape."""
    sql = F.col("statement")
    rows = statement_groups(logs).select(
        "n", "first_seen_at", "last_seen_at", S.alias_map(sql).alias("aliases"), S.main_table(sql).alias("main"),
        F.explode(_uses(sql)).alias("u"))
    return rows.select(S.owner_table(F.col("u.column"), F.col("aliases"), F.col("main")).alias("table_name"),
                       S.last_part(F.col("u.column")).alias("column_name"), "u.context", "n", "first_seen_at", "last_seen_at")


def column_registry(logs: DataFrame) -> DataFrame:
    """Columns seen in the log with their use per clause, as counts of logs."""
    counts = [F.sum(F.when(F.col("context") == c, F.col("n")).otherwise(0)).alias(f"{c}_count") for c in CONTEXTS]
    return column_uses(logs).groupBy("table_name", "column_name").agg(
        F.sum("n").alias("usage_count"), *counts, F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"))


def usage_context() -> Column:
    """The non-zero clause counts as a map."""
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"{c}_count").alias("value")) for c in CONTEXTS])
    return F.map_filter(F.map_from_entries(entries), lambda _, n: n > 0)


def join_patterns(logs: DataFrame) -> DataFrame:
    """``table_name, target_table, join_column, join_count``, seen from both sides of each equality."""
    sql = F.col("statement")
    rows = statement_groups(logs).select("n", S.alias_map(sql).alias("aliases"), S.main_table(sql).alias("main"),
                                         F.explode(S.join_equalities(sql)).alias("e"))

    def owner(side: str) -> Column:
        return S.owner_table(F.col(f"e.{side}"), F.col("aliases"), F.col("main"))

    sides = F.array(
        F.struct(owner("left").alias("table_name"), owner("right").alias("target_table"),
                 S.last_part(F.col("e.left")).alias("join_column")),
        F.struct(owner("right").alias("table_name"), owner("left").alias("target_table"),
                 S.last_part(F.col("e.right")).alias("join_column")))
    return (rows.select("n", F.inline(sides)).groupBy("table_name", "target_table", "join_column")
            .agg(F.sum("n").alias("join_count")))


def where_patterns(logs: DataFrame) -> DataFrame:
    """``table_name, condition, count`` with the literals as logged."""
    sql = F.col("sql_text")
    rows = logs.select(S.alias_map(sql).alias("aliases"), S.main_table(sql).alias("main"),
                       F.explode(S.where_predicates(sql)).alias("p"))
    condition = F.concat_ws(" ", S.last_part(F.col("p.column")), "p.op", "p.value").alias("condition")
    rows = rows.select(S.owner_table(F.col("p.column"), F.col("aliases"), F.col("main")).alias("table_name"), condition)
    return rows.groupBy("table_name", "condition").agg(F.count("*").alias("count"))


def enrichment_priority(tables: DataFrame, joins: DataFrame, columns: DataFrame, comments: DataFrame,
                        top_share: float = 0.2, hub_degree: int = 2) -> DataFrame:
    """Priority 1 to 5 per used column: busy table, missing comment, join hub, busy column, the rest.

    The registries are read several times, so they are materialised first instead of mining the log again.
    """
    tables, joins, columns = cut(tables), cut(joins), cut(columns)

    def in_top(df: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
        ranked = competition_rank(df.select(*keys, value), [], value)
        size = ranked.agg(F.count("*").alias("n")).scalar()
        share = F.when(size > 1, (F.col("rank") - 1) / (size - 1)).otherwise(F.lit(0.0))
        return ranked.select(*keys, (share <= top_share).alias(out))

    degree = joins.groupBy("table_name").agg(F.count_distinct("target_table").alias("degree"))
    rows = (columns.select("table_name", "column_name", "usage_count")
            .join(in_top(tables, "sql_count", ["table_name"], "busy_table"), "table_name", "left")
            .join(in_top(columns, "usage_count", ["table_name", "column_name"], "busy_column"), ["table_name", "column_name"])
            .join(comments, ["table_name", "column_name"], "left").join(degree, "table_name", "left"))
    return rows.withColumn("priority", F.when(F.col("busy_table"), 1)
                           .when(S.insufficient_comment(F.col("comment")), 2)
                           .when(F.col("degree") >= hub_degree, 3).when(F.col("busy_column"), 4).otherwise(5)
                           ).select("table_name", "column_name", "usage_count", "priority")


def unknown_columns(uses: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Referenced (table, column) pairs that the catalogue does not have, with their use."""
    named = uses.groupBy("table_name", "column_name").agg(F.sum("n").alias("n"))
    known = catalogue.select("table_name", "column_name")
    known_tables = catalogue.select("table_name").distinct().withColumn("table_known", F.lit(True))
    return (named.join(known, ["table_name", "column_name"], "left_anti").join(known_tables, "table_name", "left")
            .withColumn("problem", F.when(F.col("table_known"), "unknown column").otherwise("unknown table"))
            .drop("table_known"))


def description_checks(rows: DataFrame, description: str, name: str, min_length: int = 10) -> DataFrame:
    """Problems of generated descriptions: too short, or never naming the object they describe."""
    text = F.coalesce(F.col(description), F.lit(""))
    problems = F.array_compact(F.array(
        F.when(F.length(S.strip(text)) < min_length, "too short"),
        F.when(~F.lower(text).contains(F.lower(F.col(name))), "name missing")))
    return rows.withColumn("problems", problems).filter(F.size("problems") > 0)


def deactivate(registry: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Registry with tables unused for more than ``days`` marked inactive."""
    idle = F.datediff(as_of, F.col("last_seen_at"))
    return registry.withColumn("idle_days", idle).withColumn(
        "meta_status", F.when(idle > days, "inactive").otherwise(F.col("meta_status")))


def apply_edits(meta: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(meta, history)``: the latest approved edit per field replaces its value.

    ``meta`` is ``template_id, field_name, value``; ``edits`` is ``edit_id, template_id, field_name, new_value,
    editor_id, edited_at, status``.  History holds every edit with the value it replaced: the previous approved
    one, or the original.
    """
    keys = ["template_id", "field_name"]
    approved = edits.filter(F.col("status") == "approved")
    latest = first_per_key(approved, keys, F.struct("edited_at", "edit_id"), last=True)
    merged = (meta.join(latest.select(*keys, "new_value", "editor_id"), keys, "left")
              .select(*keys, F.coalesce("new_value", "value").alias("value"), F.col("editor_id").alias("reviewed_by"),
                      F.when(F.col("new_value").isNotNull(), "modified").otherwise("auto").alias("review_status")))
    w = W.partitionBy(*keys).orderBy("edited_at", "edit_id").rowsBetween(W.unboundedPreceding, -1)
    before = F.last(F.when(F.col("status") == "approved", F.col("new_value")), ignorenulls=True).over(w)
    history = (edits.withColumn("_before", before).join(meta, keys)
               .select("edit_id", *keys, F.coalesce("_before", "value").alias("old_value"), "new_value", "editor_id",
                       "edited_at", "status"))
    return merged, history


def monitoring(logs: DataFrame, batch: Column) -> DataFrame:
    """Per batch: logs, valid logs, distinct and new templates, dedup ratio, new tables, description calls."""
    sql = F.col("sql_text")
    rows = logs.withColumn("batch", batch).withColumn("ok", filters.valid())
    sizes = rows.groupBy("batch").agg(F.count("*").alias("logs"), F.count_if("ok").alias("valid_logs"))
    valid = rows.filter("ok")
    shapes = valid.groupBy("batch", S.template_id(S.mask_literals(sql)).alias("template_id")).agg(F.lit(1).alias("one"))
    first = shapes.groupBy("template_id").agg(F.min("batch").alias("batch"))
    statements = valid.groupBy("batch", S.mask_literals(sql, strict=True).alias("statement")).agg(F.lit(1).alias("one"))
    tables = (statements.select("batch", F.explode(S.tables(F.col("statement"))).alias("table_name"))
              .groupBy("table_name").agg(F.min("batch").alias("batch")))
    out = (sizes.join(shapes.groupBy("batch").agg(F.count("*").alias("templates")), "batch", "left")
           .join(first.groupBy("batch").agg(F.count("*").alias("new_templates")), "batch", "left")
           .join(tables.groupBy("batch").agg(F.count("*").alias("new_tables")), "batch", "left")
           .fillna(0, ["templates", "new_templates", "new_tables"]))
    ratio = F.when(F.col("valid_logs") > 0, 1 - F.col("templates") / F.col("valid_logs"))
    # A description is generated once per new template; enrichment is the share of templates served from before.
    reused = F.when(F.col("templates") > 0, 1 - F.col("new_templates") / F.col("templates"))
    return out.withColumn("dedup_ratio", ratio).withColumn("reuse_rate", reused).withColumn(
        "description_calls", F.col("new_templates"))


def families(tables: DataFrame) -> DataFrame:
    """Table families by name stem: ``stem, members, sql_count`` for stems with at least one suffixed table."""
    rows = tables.withColumn("stem", S.family_stem(F.col("table_name"))).filter("stem IS NOT NULL")
    return rows.groupBy("stem").agg(F.count("*").alias("members"), F.sum("sql_count").alias("sql_count"),
                                    F.array_sort(F.collect_set(F.upper(S.family_suffix(F.col("table_name"))))).alias("suffixes"))


def union_family(members: dict[str, DataFrame], label: str = "fab_id") -> DataFrame:
    """UNION ALL of same-shaped tables with their suffix as a column."""
    shapes = {tuple(sorted(df.dtypes)) for df in members.values()}
    if len(shapes) != 1:
        raise ValueError("family members differ in their columns")
    out = None
    for suffix, df in members.items():
        part = df.withColumn(label, F.lit(suffix))
        out = part if out is None else out.unionByName(part)
    return out

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from querylode.operators import filters, registry, usage
from querylode.plans import templates
from querylode.sources import catalog, glossary, logs as sources, registry_json
from querylode.streaming import incremental

ROWS = [
    ("Q1", "SELECT a FROM t WHERE a = 1", 50, 0, "2024-01-01T10:00:00", "S"),
    ("Q2", "SELECT COUNT(a) FROM t WHERE a = 2", 50, 0, "2024-01-02T00:00:00", None),
    ("Q3", "INSERT INTO t VALUES (1)", 90, 0, "2024-01-02T09:00:00", "S"),
    ("Q4", "SELECT a FROM t WHERE a = 3", 70, 2, "2024-01-03T00:00:00", "S"),
    ("Q5", "SELECT a FROM t WHERE a = 9", 10, 0, "2024-01-03T12:00:00", "S"),
    ("Q6", "SELECT a,, b FROM t", 5, 0, "2024-01-03T12:00:00", "S"),
    ("Q7", "DROP TABLE t", 5, 1, "2024-01-04T12:00:00", "S"),
]
NAMES = ["sql_id", "sql_text", "exec_count", "error_count", "collected_at", "schema_name"]


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("logs") / "logs.json"
    path.write_text(json.dumps([{k: v for k, v in zip(NAMES, r) if v is not None} for r in ROWS]))
    return sources.read_json_logs(spark, str(path))


def ids(df):
    return [r.sql_id for r in df.collect()]


def test_json_source(logs):
    start, end = datetime(2024, 1, 1, 10), datetime(2024, 1, 3)
    assert ids(sources.collect_json_logs(logs, start, end)) == ["Q3", "Q4", "Q1", "Q2"]
    assert len(ids(sources.collect_json_logs(logs, limit=0))) == 7
    assert ids(sources.collect_json_logs(logs, limit=1, default_limit=3)) == ["Q3"]


def test_table_source_cuts_bounds_to_days(logs):
    got = sources.collect_table_logs(logs, datetime(2024, 1, 1, 23), datetime(2024, 1, 3, 23))
    assert ids(got) == ["Q3", "Q4", "Q1", "Q2"]


def test_missing_key_fails(spark):
    lines = spark.createDataFrame([('{"sql_id": "x"}',)], "value string")
    with pytest.raises(Exception, match="log row without"):
        sources.parse_json_logs(lines).collect()


def test_filter_and_ranking(logs):
    kept = filters.keep_valid(logs)
    assert ids(filters.rank_logs(kept)) == ["Q2", "Q1", "Q5", "Q6"]
    assert ids(filters.rank_logs(kept, 0)) == []
    assert ids(filters.rank_logs(kept, 2)) == ["Q2", "Q1"]
    reasons = {r.sql_id: r.reasons for r in filters.audit(logs).collect()}
    assert reasons == {"Q3": ["DML"], "Q4": ["error"], "Q7": ["error", "DDL"]}


def test_templates_and_report(logs):
    rows = {r.sql_id: r for r in templates.log_templates(logs).collect()}
    assert set(rows) == {"Q1", "Q2", "Q5"} and rows["Q1"].template_id == rows["Q5"].template_id
    assert {r.sql_id for r in templates.distinct_templates(logs).collect()} == {"Q1", "Q2"}
    assert [tuple(r) for r in templates.errors(logs).collect()] == [("Q6", "processing", "blank select item")]
    report = templates.run_report(logs).first().asDict()
    assert report == {"collected_count": 7, "filtered_count": 4, "normalized_count": 3, "indexed_count": 3,
                      "error_count": 1, "success": False}
    assert "에러 수: 1건" in templates.report_text(report)
    linked = {r.sql_id: r.template_id for r in templates.link_back(logs, templates.template_load(logs)).collect()}
    assert linked["Q3"] is None and linked["Q1"] == rows["Q1"].template_id


def test_usage_and_registry(logs):
    assert [tuple(r) for r in usage.table_usage(logs).collect()] == [("t", 185)]
    first = registry.table_registry(logs.filter("sql_id <= 'Q2'")).withColumn("meta_status", F.lit("reviewed"))
    merged = registry.merge_table_registry(first, registry.table_registry(logs.filter("sql_id > 'Q2'")))
    row = merged.first()
    assert (row.sql_count, row.meta_status, row.first_seen_at) == (5, "reviewed", datetime(2024, 1, 1, 10))
    uses = {(r.column_name): r for r in registry.column_registry(logs).collect()}
    assert uses["a"].where_count == 4 and uses["a"].aggregate_count == 1


def test_monitoring_days(logs):
    rows = {r.batch: r for r in registry.monitoring(logs, F.to_date("collected_at").cast("string")).collect()}
    assert rows["2024-01-01"].new_templates == 1 and rows["2024-01-03"].new_templates == 1
    assert rows["2024-01-04"].valid_logs == 0 and rows["2024-01-04"].dedup_ratio is None


def test_day_and_change_extraction(logs):
    assert ids(incremental.of_day(logs, "2024-01-02")) == ["Q2", "Q3"]
    since = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    assert ids(incremental.changed_since(logs, "collected_at", since)) == ["Q5", "Q6", "Q7"]


def test_stream_counts_every_file_once(spark, logs, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    logs.filter("sql_id <= 'Q3'").write.parquet(source)
    stream = lambda: spark.readStream.schema(logs.schema).parquet(source)
    incremental.write_batches(stream(), out, mark)
    logs.filter("sql_id > 'Q3'").write.mode("append").parquet(source)
    incremental.write_batches(stream(), out, mark)
    incremental.write_batches(stream(), out, mark)
    got = {r.template_id: (r.log_count, r.exec_count) for r in incremental.merged_counts(spark, out).collect()}
    want = {r.template_id: (r.log_count, r.exec_count) for r in templates.template_load(logs).collect()}
    assert got == want


def test_glossary_and_registry_files(spark, tmp_path):
    (tmp_path / "g.csv").write_text('term,korean_name,description\nlot,로트,"a, b"\n,x,y\n')
    terms, rejects = glossary.split_terms(glossary.read_glossary(spark, str(tmp_path / "g.csv")))
    assert [tuple(r) for r in terms.collect()] == [("lot", "로트", "a, b", None)]
    assert rejects.first().missing == ["term"]
    files = {
        "table_registry_samples.json": [{"table_name": "T", "schema_name": "S", "sql_count": 3}],
        "column_registry_samples.json": {"T": [{"column_name": "A", "data_type": "NUMBER", "usage_context": {"where": 2}}]},
        "sample_sqls_for_tables.json": {"T": {"sample_sqls": ["SELECT A FROM T"], "join_patterns": [
            {"target_table": "U", "join_column": "A", "join_count": 1}], "where_patterns": [{"condition": "A = 1", "count": 2}]}},
        "sample_table_data.json": {"T": [{"A": 1}, {"A": 2, "B": "x"}]},
    }
    for name, doc in files.items():
        (tmp_path / name).write_text(json.dumps(doc))
    got = registry_json.read_registry(spark, str(tmp_path))
    assert got["tables"].first().meta_status == "pending"
    column = got["columns"].first()
    assert column.sample_values == [] and column.usage_context == {"where": 2}
    assert got["join_patterns"].first().target_table == "U" and got["sample_rows"].count() == 2


def test_catalog_metadata(spark):
    columns = spark.createDataFrame([("T", "A", "Y", 1), ("T", "B", "N", 2)], "table_name string, column_name string, nullable string, column_id int")
    notes = spark.createDataFrame([("T", "A", "note")], "table_name string, column_name string, comments string")
    got = {r.column_name: (r.nullable, r.comments) for r in catalog.column_metadata(columns, notes).collect()}
    assert got == {"A": (True, "note"), "B": (False, None)}

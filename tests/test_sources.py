"""Files, tables, layers and the access log."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from orderloom.operators import audit, quality
from orderloom.plans.build import build_layers, build_marts
from orderloom.plans.shop import Shop
from orderloom.session import fresh_path
from orderloom.sources import files, schemas, tables
from orderloom.streaming import audit_live

from conftest import values


def unique(name):
    return f"{name}_{uuid.uuid4().hex[:8]}"


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        '"review_id","order_id","review_score","review_comment_title",'
        '"review_comment_message","review_creation_date","review_answer_timestamp"\n'
        'r1,o1,5,,"good, ""very""\nreally",2018-01-02 00:00:00,2018-01-03 10:00:00\n'
        "r2,o2,bad,,,not a date,2018-01-03 10:00:00\n")
    name = unique("raw_reviews")
    n = files.ingest_csv(
        spark, str(tmp_path), "reviews.csv", schemas.ORDER_REVIEWS, name,
        files.bronze_shape("order_reviews"), fresh_path(spark, "bronze"), multi_line=True)
    rows = {r.review_id: r for r in spark.table(name).collect()}
    assert n == len(rows) == 2
    assert rows["r1"].review_comment_message == 'good, "very"\nreally'
    assert rows["r1"].review_created_at == dt.datetime(2018, 1, 2)
    assert rows["r2"].review_score is None and rows["r2"].review_created_at is None
    assert rows["r1"]._source_file == "reviews.csv" and rows["r1"]._ingested_at is not None


def test_write_replaces_rows_and_layout(spark):
    name = unique("replaced")
    assert tables.write_table(spark.range(5).toDF("a"), name) == 5
    assert tables.write_table(spark.range(3).selectExpr("id AS b", "id AS c"), name) == 3
    assert spark.table(name).columns == ["b", "c"]


def test_tables_are_listed_with_their_columns(spark):
    schema = unique("listing")
    tables.create_schema(spark, schema)
    tables.create_schema(spark, schema)
    tables.write_table(spark.range(1).selectExpr("id AS z", "id AS a"), f"{schema}.t")
    listed = {r.table_name: r.columns for r in tables.list_tables(spark, schema).collect()}
    assert listed["t"] == "z, a"


def test_bronze_columns_get_their_raw_names_back(spark):
    for source, ddl in schemas.SOURCES.items():
        raw = spark.createDataFrame([], schemas.as_text(ddl))
        shaped = files.with_lineage(files.bronze_shape(source)(raw), "f.csv")
        view = tables.renamed_view(shaped, files.restored_names(source), unique("v"))
        assert view.columns == raw.columns


LINES = [
    {"timestamp": "2024-01-01T10:00:00", "level": "INFO", "session": "a", "event": "data_access",
     "function": "run_sql", "params": {"q": "x"}, "row_count": 10, "duration_ms": 4.0,
     "status": "success"},
    {"timestamp": "2024-01-01T10:30:00", "level": "ERROR", "session": "b", "event": "data_access",
     "function": "run_sql", "params": {"q": "UNION"}, "row_count": 0, "duration_ms": 2.0,
     "status": "error", "error": "boom"},
    {"timestamp": "2024-01-01T11:00:00", "level": "DEBUG", "event": "debug_params"},
]


def test_log_reader_skips_broken_lines_and_other_events(spark, tmp_path):
    text = "\n".join([json.dumps(LINES[0]), "{not json", json.dumps(LINES[1]),
                      json.dumps(LINES[2]), ""])
    (tmp_path / "audit.log").write_text(text)
    log = files.read_audit_log(spark, str(tmp_path))
    assert log.count() == 2
    assert audit.summary(log).first().asDict() == {
        "total_queries": 2, "avg_duration_ms": 3.0, "errors": 1, "unique_sessions": 2}
    assert audit.suspicious(log).count() == 1 and audit.of_session(log, "a").count() == 1
    assert [r.timestamp for r in audit.history(log).collect()] == [
        "2024-01-01 10:30:00", "2024-01-01 10:00:00"]


def test_audit_records(spark):
    calls = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "s", "f", {"email": "a@b", "limit": "5"}, n, 1.239,
          " SELECT\n1 ", status, error)
         for n, status, error in ((10, "success", None), (1001, "success", ""), (0, "error", "x"))],
        "timestamp timestamp_ntz, session string, function string, params map<string,string>, "
        "row_count bigint, duration_ms double, sql string, status string, error string")
    rows = audit.events(calls).collect()
    assert [r.level for r in rows] == ["INFO", "WARNING", "ERROR"]
    assert rows[0].params == {"email": "<redacted>", "limit": "5"}
    assert rows[0].sql_preview == "SELECT 1" and rows[0].duration_ms == 1.24
    assert rows[1].warning == "large_result_set:1001_rows"
    assert [r.error for r in rows] == [None, None, "x"]


def test_followed_log_equals_the_batch_rollup(spark, small_folder):
    log = Shop.over_fixtures(spark, small_folder).audit_log
    path, out, state = (fresh_path(spark, p) for p in ("log", "out", "state"))
    for part in (F.col("timestamp") < "2024-01-10", F.col("timestamp") >= "2024-01-10"):
        files.append_audit(log.where(part), path)
        audit_live.follow(
            audit_live.read_log_stream(spark, path, 1), out, state).awaitTermination()
    streamed = sorted(values(audit_live.current(spark, out)))
    assert streamed and streamed == sorted(values(audit_live.rollup(files.read_audit_log(spark, path))))


def test_checks_report_every_kind_of_failure(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), (None, "y"), ("b", "x")], "k string, v string")
    checks = [quality.Checks("t", unique=("k",), not_null=("k", "v"), accepted={"v": ("x",)})]
    got = {(r.column_name, r.test): r.failures for r in quality.report({"t": df}, checks).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 1, ("v", "not_null"): 1,
                   ("v", "accepted_values"): 1}
    with pytest.raises(quality.DataQualityError, match="t.k unique: 1"):
        quality.require({"t": df}, checks)
    assert sum(len(c) for c in quality.ALL_CHECKS) == 57
    clean = quality.report({"t": df.limit(0)}, checks).collect()
    assert all(r.passed for r in clean) and len(clean) == 4


def test_marts_are_stored_and_checked(spark, small_folder):
    shop = Shop.over_fixtures(spark, small_folder)
    schema = unique("marts")
    stored = build_marts(spark, shop, schema, names={"kpi_monthly": "summary"}, fact_buckets=4)
    assert stored["fct_orders"] == shop.src["orders"].count()
    assert spark.table(f"{schema}.summary").count() == stored["kpi_monthly"]
    plan = spark.table(f"{schema}.fct_orders").groupBy("order_id").count()
    assert "Exchange" not in plan._jdf.queryExecution().sparkPlan().toString()


def test_bad_source_stops_the_build(spark, small_folder):
    shop = Shop.over_fixtures(spark, small_folder)
    broken = dict(shop.src)
    broken["orders"] = broken["orders"].unionAll(broken["orders"].limit(1))
    schema = unique("marts")
    with pytest.raises(quality.DataQualityError, match="src_orders.order_id unique"):
        build_marts(spark, Shop(broken), schema)
    assert not spark.catalog.tableExists(f"{schema}.fct_orders")


def test_layers_from_csv_equal_the_direct_models(spark, small_folder, tmp_path):
    shop = Shop.over_fixtures(spark, small_folder)
    names = {source: f"{source}.csv" for source in schemas.SOURCES}
    for source, file_name in names.items():
        files.write_csv(shop.src[source], f"{tmp_path}/{file_name}")
    layers = {layer: unique(layer) for layer in ("bronze", "silver", "gold")}
    counts = build_layers(spark, str(tmp_path), names, layers)
    assert len(counts) == 15 and counts["raw_orders"] == shop.src["orders"].count()
    stored = spark.table(f"{layers['gold']}.gold_monthly_kpis").drop("_updated_at")
    assert sorted(values(stored)) == sorted(values(shop.gold_monthly_kpis))
    people = spark.table(f"{layers['gold']}.gold_customer_segments").drop("_updated_at")
    assert sorted(values(people), key=repr) == sorted(
        values(shop.gold_customer_segments), key=repr)
    direct = Shop.over_csv(spark, str(tmp_path), names)
    assert direct.int_orders.count() == counts["raw_orders"]


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from orderloom import session
    monkeypatch.setattr(session, "_one_machine", lambda master: False)
    if spark.conf.get(session.CHECKPOINTS, None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(spark)


def test_handed_over_rows_are_released(spark):
    from orderloom import session
    kept = session.handed_over(spark.range(5))
    assert kept.count() == 5 and "parquet" in kept._jdf.queryExecution().toString().lower()
    session.release(kept)
    with pytest.raises(Exception):
        spark.read.parquet(kept._handed_path)
    with pytest.raises(ValueError):
        session.remove(spark, "/tmp")


def test_a_view_of_the_same_name_is_not_listed_in_a_schema(spark):
    schema, name = unique("listing"), unique("twice")
    tables.create_schema(spark, schema)
    tables.write_table(spark.range(1).selectExpr("id AS z", "id AS a"), f"{schema}.{name}")
    spark.range(1).selectExpr("id AS other").createOrReplaceTempView(name)
    listed = [tuple(r) for r in tables.list_tables(spark, schema).collect()]
    spark.catalog.dropTempView(name)
    assert listed == [(name, "z, a")]

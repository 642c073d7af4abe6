"""Whole jobs over files, and the guards around them."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tenderline.catalog import CONFIGURED_PROJECTIONS, RATE_PAYLOAD_SCHEMA, USER_SUPPORT_COPIES
from tenderline.plans.checks import CHECKS
from tenderline.plans.jobs import JOBS, copy_user_support
from tenderline.plans.runner import prepare, run, run_sql, shared_folder, sql_file
from tenderline.plans.spec import JobSpec, TableSource, jobs_from_config, parse_config
from tenderline.plans.views import AS_OF, REGION, VIEW_NAMES, view
from tenderline.sinks import tables as sinks
from tenderline.sources.stores import FileStore, count_rows
from tests.compare import connect, of_duckdb, of_spark

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    """Every job input, landed as a file table."""
    store = FileStore(shared_folder(spark))
    for name in VIEW_NAMES:
        store.replace(view(spark, FOLDER, name), name)
    store.replace(
        view(spark, FOLDER, "pricebook_info"),
        "contract_dashboard_pricebook_and_pricebook_product_info",
    )
    payloads = (
        view(spark, FOLDER, "rate_responses")
        .select(F.from_json("value", RATE_PAYLOAD_SCHEMA).alias("p"))
        .select("p.*")
    )
    store.replace(payloads.where("success"), "payloads")
    store.replace(payloads, "mixed_payloads")
    return store


@pytest.fixture
def target(spark):
    return FileStore(shared_folder(spark))


JOB_CHECKS = [
    ("sales_threshold", "filter_threshold", {}),
    ("contract_info", "contract_info", {}),
    ("request_info", "request_info", {}),
    ("request_products", "request_products", {}),
    ("pricebook_info", "attribute_pivot", {}),
    ("pricebook_staging", "pricebook_staged", {}),
    ("negotiation_history", "negotiation_history", {"as_of": AS_OF}),
    ("negotiation_history", "negotiation_history_dedup", {"as_of": AS_OF, "fan_out": False}),
    ("historical_demand", "demand_summary", {"as_of": AS_OF, "region": REGION}),
    ("user_info", "user_dimension", {}),
    ("user_support", "user_support_requests", {}),
    ("po_history", "po_history", {}),
    ("benchmark_history", "benchmark_history", {}),
    ("currency_rates", "rates_filter_symbols", {}),
    ("configured_contracts", "contract_info", {}),
]


@pytest.mark.parametrize("job,check,args", JOB_CHECKS, ids=[c for _, c, _ in JOB_CHECKS])
def test_job_result(spark, inputs, target, job, check, args):
    report = run(spark, JOBS[job], inputs, target, args)
    written = target.read(spark, report.target)
    rows = of_spark(written)
    assert rows == of_duckdb(connect(FOLDER), CHECKS[check])
    assert report.rows == sum(rows[1].values())


def test_sources_can_be_landed_first(spark, inputs, target):
    landing = FileStore(shared_folder(spark))
    run(spark, JOBS["user_info"], inputs, target, landing=landing)
    assert of_spark(target.read(spark, "contract_dashboard_user_info")) == of_duckdb(
        connect(FOLDER), CHECKS["user_dimension"]
    )
    run(spark, JOBS["negotiation_history"], inputs, target, {"as_of": AS_OF}, landing=landing)
    assert landing.columns(spark, "requests_historicalrequest") == ["id", "history_date"]
    assert of_spark(target.read(spark, JOBS["negotiation_history"].target)) == of_duckdb(
        connect(FOLDER), CHECKS["negotiation_history"]
    )


def test_job_with_text_from_the_caller(spark, inputs, target):
    report = run(
        spark, JOBS["bid_evaluation"], inputs, target, {"owner": "F"},
        sql="SELECT id FROM contracts_contract WHERE procurement_contract_owner = :owner;",
    )
    assert report.rows == count_rows(target, spark, "bid_evaluation_file_upload") > 0
    with pytest.raises(ValueError, match="SQL text"):
        run(spark, JOBS["bid_evaluation"], inputs, target)


def test_caller_names_tables_and_mode(spark, inputs, target):
    job = JOBS["configured_requests"]
    with pytest.raises(ValueError, match="have to be given"):
        prepare(job, None, None, None, None)
    sinks.overwrite(
        inputs.read(spark, "requests").withColumn("created_by", F.col("sender_id")), target, "asked"
    )
    for expected in (1, 2):
        run(spark, job, target, target, source_table="asked", target_table="copied", mode="append")
        assert count_rows(target, spark, "copied") == expected * count_rows(target, spark, "asked")


def test_appending_and_overwriting_twice(spark, inputs, target):
    rows = count_rows(inputs, spark, "requests")
    for n in (1, 2):
        run(spark, JOBS["user_support"], inputs, target)
        run(spark, JOBS["contract_info"], inputs, target)
        assert count_rows(target, spark, "user_support_requests_request") == n * rows
        assert count_rows(target, spark, "contract_dashboard_contract_info") == rows


def test_a_job_does_not_write_onto_its_source(spark, inputs):
    before = count_rows(inputs, spark, "benchmark_report_historical_data")
    with pytest.raises(ValueError, match="also a source"):
        run(spark, JOBS["po_history"], inputs, inputs)
    assert count_rows(inputs, spark, "benchmark_report_historical_data") == before


def test_missing_columns_are_found_before_anything_runs(spark, inputs, target):
    sinks.overwrite(inputs.read(spark, "requests").drop("status"), target, "requests")
    other = FileStore(shared_folder(spark))
    with pytest.raises(ValueError, match="lacks the columns .*status"):
        run(spark, JOBS["request_info"], target, other)
    assert other.columns(spark, "contract_dashboard_request_info") is None


def test_a_failed_response_fails_the_rates_job(spark, inputs, target):
    with pytest.raises(Exception, match="quota"):
        run(spark, JOBS["currency_rates"], inputs, target, source_table="mixed_payloads")


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError, match="write mode"):
        JobSpec("j", (TableSource("a"),), "b", None, "merge")
    with pytest.raises(ValueError, match="used twice"):
        JobSpec("j", (TableSource("a"), TableSource("x", view_name="a")), "b")


def test_views_under_both_names(spark, inputs, target):
    job = JobSpec(
        "both", (TableSource("requests", "requests", "r"),), "out",
        "SELECT r.id FROM r JOIN requests USING (id)",
    )
    assert run(spark, job, inputs, target).rows == count_rows(inputs, spark, "requests")
    assert not spark.catalog.tableExists("r")


def test_sql_does_not_replace_the_callers_views(spark):
    spark.range(1).createOrReplaceTempView("taken")
    with pytest.raises(AnalysisException, match="taken"):
        run_sql(spark, "SELECT * FROM taken", {"taken": spark.range(2)})
    assert spark.table("taken").count() == 1
    spark.catalog.dropTempView("taken")


def test_sql_files(tmp_path):
    text = tmp_path / "q.sql"
    text.write_text("SELECT 1")
    assert sql_file(str(text)) == "SELECT 1"
    with pytest.raises(FileNotFoundError):
        sql_file(str(tmp_path / "absent.sql"))


YAML = """
contracts:
  source_table: public.contracts_contract
  target_table: t
  columns: [id, valid_to]
joined:
  source_tables:
  - name: a
    alias: first
    view_name: f
  - name: b
  target_table: u
  write_mode: append
open_job:
  source_table:
  target_table:
  columns: [id]
"""


def test_configuration():
    jobs = jobs_from_config(YAML)
    assert jobs["contracts"].mode == "overwrite"
    assert jobs["contracts"].sources[0].columns == ("id", "valid_to")
    assert jobs["joined"].mode == "append"
    assert jobs["joined"].sources[0].views == ("f", "first")
    assert jobs["open_job"].sources == () and jobs["open_job"].target is None
    with pytest.raises(ValueError, match="given twice"):
        parse_config("a: {x: 1}\na: {x: 2}")
    with pytest.raises(ValueError, match="given twice"):
        parse_config('{"a": 1, "a": 2}')
    with pytest.raises(ValueError, match="neither"):
        jobs_from_config("a: {target_table: t}")


def test_configured_projections_are_jobs():
    for name, (source, target, columns) in CONFIGURED_PROJECTIONS.items():
        job = JOBS[f"configured_{name}"]
        assert job.target == target
        assert [s.name for s in job.sources] == ([source] if source else [])
        assert all(list(s.columns) == columns for s in job.sources)


def test_staged_insert_checks_columns(spark, inputs, target):
    two = spark.createDataFrame([(1, "a")], "id long, name string")
    with pytest.raises(ValueError, match="does not exist"):
        sinks.insert_by_name(two, target, "staged")
    sinks.truncate_reload(two, target, "staged", "name string, id int")
    assert sinks.insert_by_name(two.select("name", F.col("id").cast("int")), target, "staged") == 1
    for wrong in (two.select("id"), two.withColumn("extra", F.lit(1))):
        with pytest.raises(ValueError, match="differ"):
            sinks.insert_by_name(wrong, target, "staged")
    assert target.read(spark, "staged").dtypes == [("name", "string"), ("id", "int")]
    assert count_rows(target, spark, "staged") == 2


def test_publishing_is_checked(spark, target):
    frame = spark.createDataFrame([(1,), (None,)], "id long")
    sinks.overwrite(frame, target, "bad")
    sinks.overwrite(frame.where("id > 5"), target, "empty")
    for name in ("bad", "empty"):
        with pytest.raises(ValueError, match="not publishable"):
            sinks.publish(spark, target, name, target, "final", "id")
    assert target.columns(spark, "final") is None
    with pytest.raises(ValueError, match="itself"):
        sinks.publish(spark, target, "bad", target, "bad", "id")


def test_one_failing_copy_does_not_stop_the_others(spark, target):
    source = FileStore(shared_folder(spark))
    for name, (_, columns) in USER_SUPPORT_COPIES.items():
        if name != "contract_service_pricebooks":
            sinks.overwrite(spark.range(3).select(*[F.lit("x").alias(c) for c in columns]), source, name)
    with pytest.raises(sinks.CopyError, match="contract_service_pricebooks") as caught:
        sinks.copy_tables(spark, USER_SUPPORT_COPIES, source, target)
    assert [r.rows for r in caught.value.results] == [3, None, 3, 3]
    for name, (table, _) in USER_SUPPORT_COPIES.items():
        if name != "contract_service_pricebooks":
            assert count_rows(target, spark, table) == 3


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != shared_folder(spark)


@pytest.mark.parametrize("name, check, args", JOB_CHECKS)
def test_landing_changes_nothing(spark, inputs, target, name, check, args):
    job, landing = JOBS[name], FileStore(shared_folder(spark))
    run(spark, job, inputs, target, args)
    plain = of_spark(target.read(spark, job.target))
    other = FileStore(shared_folder(spark))
    run(spark, job, inputs, other, args, landing=landing)
    assert of_spark(other.read(spark, job.target)) == plain


def test_landing_onto_source_or_target_is_refused(spark, inputs, target):
    before = count_rows(inputs, spark, "benchmark_report_historical_data")
    for landing in (inputs, target):
        with pytest.raises(ValueError, match="landing"):
            run(spark, JOBS["po_history"], inputs, target, landing=landing)
    assert count_rows(inputs, spark, "benchmark_report_historical_data") == before
    assert target.columns(spark, "benchmark_report_historical_data") is None


def test_failed_write_leaves_the_table(spark, target):
    target.replace(spark.range(5), "numbers")
    with pytest.raises(Exception, match="broken"):
        target.replace(spark.range(9).selectExpr("if(id = 7, raise_error('broken'), id) AS id"), "numbers")
    assert count_rows(target, spark, "numbers") == 5


def test_user_support_copies(spark, target):
    source = FileStore(shared_folder(spark))
    for name, (_, columns) in USER_SUPPORT_COPIES.items():
        source.replace(spark.range(3).selectExpr(*[f"id AS `{c}`" for c in columns], "id AS other"), name)
    for done in copy_user_support(spark, source, target):
        assert done.rows == 3 and target.columns(spark, done.target) == USER_SUPPORT_COPIES[done.source][1]

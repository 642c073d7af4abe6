"""Work that goes on where it stopped: landed files, pages, slices, signed changes, filters by configuration."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tenderline.functions.json_fields import latest_price, latest_price_in
from tenderline.operators.benchmark import STORED, benchmark_history, history_of_documents, with_documents
from tenderline.operators.demand import demand_partials, merged_partials, yearly_demand, yearly_from
from tenderline.plans.runner import run, shared_folder
from tenderline.plans.spec import jobs_from_config
from tenderline.sinks.paged import restart, transfer_in_pages
from tenderline.sources.landing import FAILED, MALFORMED, RATES, ingest_rates
from tenderline.sources.snapshots import SnapshotStore
from tenderline.sources.stores import FileStore, JdbcStore, QuantileSlices, quantile_slices, sliced
from tests.compare import of_spark


class Lost(RuntimeError):
    pass


def response(day, ok=True, **rates):
    return json.dumps({"success": ok, "base": "EUR", "date": day, "rates": rates, **({} if ok else {"message": "quota"})})


def land(spark, folder, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)


def test_landed_files_are_taken_in_once(spark):
    folder, store = shared_folder(spark), SnapshotStore(shared_folder(spark))
    land(spark, folder, response("2001-01-01", USD=1.5, XXX=3.0), response("2001-01-01", False), "not json {")
    assert len(ingest_rates(spark, folder, store)) == 1 and ingest_rates(spark, folder, store) == []
    land(spark, folder, response("2001-01-02", USD=1.6))
    land(spark, folder, response("2001-01-03", USD=1.7))
    assert len(ingest_rates(spark, folder, store, files_per_batch=1)) == 2
    rates = {(r["date"], r["target_currency"], r["rate"]) for r in store.read(spark, RATES).collect()}
    assert rates == {("2001-01-01", "USD", 1.5), ("2001-01-02", "USD", 1.6), ("2001-01-03", "USD", 1.7)}
    assert [r["message"] for r in store.read(spark, FAILED).collect()] == ["quota"]
    assert [r["malformed"] for r in store.read(spark, MALFORMED).collect()] == ["not json {"]


def test_a_batch_that_is_lost_before_its_checkpoint_is_there_once(spark):
    folder, store = shared_folder(spark), SnapshotStore(shared_folder(spark))
    land(spark, folder, response("2001-01-01", USD=1.5))

    class Stops(SnapshotStore):
        def append(self, df, table, page=None, load=None):
            super().append(df, table, page, load)
            if table == FAILED:
                raise Lost

    with pytest.raises(Exception, match="Lost"):
        ingest_rates(spark, folder, Stops(store.root))
    assert store.count(spark, RATES) == 1
    land(spark, folder, response("2001-01-02", USD=1.6))
    ingest_rates(spark, folder, store)
    assert sorted(r["rate"] for r in store.read(spark, RATES).collect()) == [1.5, 1.6]


@pytest.mark.parametrize("page", [0, 2, 4])
@pytest.mark.parametrize("before", [True, False])
def test_pages_go_on_at_the_first_open_one(spark, page, before):
    source, target = FileStore(shared_folder(spark)), SnapshotStore(shared_folder(spark))
    rows = spark.range(1000).select((F.col("id") * F.col("id")).alias("k"), "id").unionByName(spark.range(50).select(F.lit(None).cast("long").alias("k"), "id"))
    source.replace(rows, "t")
    target.replace(spark.range(3), "copy")

    class Stops(SnapshotStore):
        def append(self, df, table, page_=None, load=None):
            if before and load == f"page-{page}":
                raise Lost
            super().append(df, table, page_, load)
            if load == f"page-{page}":
                raise Lost

    text = "SELECT * FROM {t}"
    with pytest.raises(Lost):
        transfer_in_pages(spark, text, source, Stops(target.root), "copy", "k", 210)
    assert target.count(spark, "copy") == 3
    done = transfer_in_pages(spark, text, source, target, "copy", "k", 210)
    assert (done.pages, done.done_before, done.rows) == (5, page + (not before), 1050)
    assert of_spark(target.read(spark, "copy")) == of_spark(rows)
    # The next transfer is a new one.
    source.replace(rows.limit(10), "t")
    assert transfer_in_pages(spark, text, source, target, "copy", "k", 210).done_before == 0
    assert target.count(spark, "copy") == 10
    source.replace(rows.limit(0), "t")
    transfer_in_pages(spark, text, source, target, "copy", "k", 210)
    restart(spark, target, "copy")
    assert target.count(spark, "copy") == 0


def test_slices_are_even_where_values_are_not(spark):
    rows = spark.range(20_000).select(F.exp(F.col("id") / 1500).alias("x"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") * F.col("id")).alias("k"))
    for column in ("x", "k"):
        sizes = [s.count() for s in sliced(rows, quantile_slices(rows, column, 10))]
        assert sum(sizes) == 20_000 and len(sizes) == 10
        least = min(sizes[1:])
        assert max(sizes[1:]) <= 1.2 * least
    assert quantile_slices(rows.limit(0), "x", 10).predicates() == quantile_slices(rows, "x", 1).predicates() == ["1 = 1"]
    same = spark.range(100).select(F.lit(7).alias("x"))
    assert sorted(s.count() for s in sliced(same, quantile_slices(same, "x", 4))) == [0, 100]


def test_slices_of_a_database_table():
    cut = QuantileSlices("day", (date(2001, 1, 2), datetime(2001, 2, 3, 4, 5, 6)))
    assert cut.predicates() == [
        "(day < DATE '2001-01-02' OR day IS NULL)",
        "day >= DATE '2001-01-02' AND day < TIMESTAMP '2001-02-03 04:05:06'",
        "day >= TIMESTAMP '2001-02-03 04:05:06'",
    ]
    store = JdbcStore("jdbc:x", slices={"orders": QuantileSlices("id", (5, 9))})
    assert store.cut("public.orders").predicates() == ["(id < 5 OR id IS NULL)", "id >= 5 AND id < 9", "id >= 9"]


MATERIALS = (
    "manufacturer_name string, manufacturer_part_no string, customer_long_description string, description string, "
    "po_item_quantity decimal(18,2), po_item_first_release_date date"
)


@pytest.mark.parametrize("corrected", [True, False])
def test_demand_after_signed_changes_is_that_of_what_is_left(spark, corrected):
    def rows(*items):
        return spark.createDataFrame([(m, "1", b, a, None if q is None else __import__("decimal").Decimal(q), None if y is None else date(y, 5, 1)) for m, a, b, q, y in items], MATERIALS)

    first = [("m", "a", "a", 5, 2000), ("m", "a", "a", None, 2000), ("m", "a", "b", 7, 2001), ("m", "b", "a", 1, None), (None, "a", "a", 9, 2000), ("n", "x", "x", 3, 2000), ("n", None, "x", 3, 2000)]
    gone, more = [("m", "a", "a", 5, 2000), ("n", "x", "x", 3, 2000)], [("m", "b", "b", 4, 2002), ("m", "a", "a", 5, 2000), ("m", "a", "a", 5, 2000)]
    left = list(first)
    for item in gone:
        left.remove(item)
    changes = rows(*gone).withColumn("sign", F.lit(-1)).unionByName(rows(*more).withColumn("sign", F.lit(1)))
    partials = demand_partials(rows(*first)).unionByName(demand_partials(changes, "sign"))
    assert of_spark(yearly_from(merged_partials(partials), corrected)) == of_spark(yearly_demand(rows(*left, *more), corrected))
    # All that had a quantity is taken away again, a row without one stays.
    nothing = demand_partials(rows(*first)).unionByName(demand_partials(rows(first[0], *first[2:]).withColumn("sign", F.lit(-1)), "sign"))
    assert of_spark(yearly_from(merged_partials(nothing), corrected)) == of_spark(yearly_demand(rows(first[1]), corrected))


def test_parsed_documents_give_the_same_history(spark):
    texts = ['{"manufacturer_part_number": "p1", "vendors": [{"proposed_price": "12.50"}, {}]}', '{"vendors": []}', "{}", None, '{"manufacturer_part_number": null}']
    tables = ['[{"id": 9, "unit_price": "1.5"}, {"id": "10", "unit_price": 2}]', "[]", None, '[{"unit_price": "7"}, {"id": 3, "unit_price": 8}]', '[{"id": 1}]']
    runs = spark.createDataFrame([(i, a, '{"recommendation_message": "buy"}' if i % 2 else None, t) for i, (a, t) in enumerate(zip(texts, tables, strict=True))], "id long, input_data string, plots_data string, table_data string")
    runs = runs.select(*[c if c in runs.columns else F.lit(None).cast("string").alias(c) for c in STORED])
    assert of_spark(history_of_documents(with_documents(runs))) == of_spark(benchmark_history(runs))
    odd = spark.createDataFrame([("{",), ('{"id": 1}',), ("[1, 2]",)], "t string").selectExpr("t", "try_parse_json(t) AS d")
    assert [r[0] for r in odd.select(latest_price_in("d", True)).collect()] == [r[0] for r in odd.select(latest_price("t", True)).collect()] == [None] * 3
    with pytest.raises(Exception, match="not an array"):
        odd.where("t LIKE '{%id%'").select(latest_price_in("d")).collect()


CONFIG = {
    "parts_job": {
        "source_tables": [{"name": "pricebook", "alias": "pb", "view_name": "book"}, {"name": "vals", "schema": "shop"}],
        "target_table": "joined", "join_tables": ["vals"], "filter_column": "shop.vals.updated_at",
    },
    "single": {"source_table": "pricebook", "target_table": "t", "columns": ["id"], "filter_column": "updated_at"},
}


def test_filters_and_joins_of_a_configuration_are_applied(spark):
    jobs = jobs_from_config(json.dumps(CONFIG))
    assert jobs["parts_job"].changed_by == ("vals", "updated_at") and jobs["single"].changed_by == ("pricebook", "updated_at")
    source, target = FileStore(shared_folder(spark)), FileStore(shared_folder(spark))
    days = spark.range(10).select("id", F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT))").alias("updated_at"))
    source.replace(days, "pricebook")
    source.replace(days, "shop.vals")
    sql = "SELECT book.id FROM book JOIN vals ON vals.id = book.id"
    assert run(spark, jobs["parts_job"], source, target, sql=sql, since="2001-01-06").rows == 4
    assert run(spark, jobs["parts_job"], source, target, sql=sql).rows == 10
    assert run(spark, jobs["single"], source, target, since="2001-01-06").rows == 4


@pytest.mark.parametrize("change", [{"join_tables": ["other"]}, {"filter_column": "other.updated_at"}, {"filter_column": "updated_at"}, {"colums": ["id"]}])
def test_a_configuration_that_says_something_else_is_refused(change):
    with pytest.raises(ValueError):
        jobs_from_config(json.dumps({"parts_job": {**CONFIG["parts_job"], **change}}))


def test_since_needs_a_column(spark):
    job = jobs_from_config(json.dumps({"j": {"source_table": "pricebook", "target_table": "t", "columns": ["id"]}}))["j"]
    store = FileStore(shared_folder(spark))
    store.replace(spark.range(3), "pricebook")
    with pytest.raises(ValueError):
        run(spark, job, store, FileStore(shared_folder(spark)), since="2001-01-06")


def test_prices_of_documents_do_not_need_the_schema_of_each(spark):
    from tenderline.functions.json_fields import document, latest_price, latest_price_in

    texts = [None, "[]", "[null, {\"id\": 3, \"unit_price\": \"1.00\"}]", '[{"id": "7", "unit_price": 2}, {"id": 12, "unit_price": "1.50"}]',
             '[{"unit_price": "3.00"}, {"id": 99, "unit_price": "4.00"}]', '[{"id": 1, "unit_price": null}]', '[{"id": 1, "unit_price": "5"}, {"id": 1, "unit_price": "6"}]']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("d", document("t"))
    found = rows.select("t", latest_price_in("d").alias("a"), latest_price("t").alias("b"), latest_price_in("d", lenient=True).alias("c"))
    assert "schema_of_variant" not in found._jdf.queryExecution().analyzed().toString().lower()
    for r in found.collect():
        assert r["a"] == r["b"] == r["c"], r
    odd = spark.sql("SELECT parse_json(t) AS d FROM VALUES ('null') AS odd(t)")
    with pytest.raises(Exception, match="d is not an array: null"):
        odd.select(latest_price_in("d")).collect()

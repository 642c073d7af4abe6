"""Every operator as a query over the test tables: name -> (spark, folder) -> frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tenderline import catalog as names
from tenderline.functions.json_fields import explode_elements, number_at, text_at
from tenderline.functions.scalar import empty_column, epoch_seconds, year_of
from tenderline.operators import benchmark, demand, filters, negotiation, pivot, users
from tenderline.operators.balance import lookup_join
from tenderline.operators.timeline import sort_rows
from tenderline.plans.jobs import JOBS, refresh_pricebook
from tenderline.plans.refresh import add_demand, compact_demand, refresh_by_changes, yearly_demand_of
from tenderline.plans.runner import read_sources, run, run_sql, run_staged, shared_folder
from tenderline.plans.spec import TableSource, jobs_from_config
from tenderline.plans.views import AS_OF, AS_OF_YEAR, REGION, view
from tenderline.sinks import tables as sinks
from tenderline.sinks.paged import transfer_in_pages
from tenderline.sources import landing, rates
from tenderline.sources.snapshots import SnapshotStore
from tenderline.sources.stores import FileStore, quantile_slices, sliced

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CONTRACT_TEXT = """
SELECT customer_id, count(*) AS contracts, max(contract_approved_value) AS highest
FROM contracts
WHERE contract_approved_value > :floor AND valid_from >= :since
GROUP BY customer_id
"""
CONTRACT_CONFIG = """
contracts_job:
  source_table: contracts_contract
  target_table: contract_dashboard_contract_info
  columns: [id, external_id, supplier_id, valid_to, contract_approved_value]
"""
SAMPLE_RATES = [
    {"target_currency": c, "rate": 1.0 + i / 4, "base": names.BASE_CURRENCY, "date": "2001-06-30"}
    for i, c in enumerate(names.TARGET_CURRENCIES)
]
LOADED_UNTIL = "2001-01-26 00:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _staging(spark: SparkSession) -> FileStore:
    return FileStore(shared_folder(spark))


def _snapshots(spark: SparkSession) -> SnapshotStore:
    return SnapshotStore(shared_folder(spark))


def _given(folder: str) -> FileStore:
    return FileStore(folder, ".parquet")


# Sources


@query
def scan_table(spark, folder):
    return _given(folder).read(spark, "orders")


@query
def scan_query(spark, folder):
    return _given(folder).query(
        spark, "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'F'"
    )


@query
def scan_balanced_slices(spark, folder):
    """A table in slices of about equal size, by measured bounds of a skewed column; with the number of slices off by more than a fifth."""
    orders = _given(folder).read(spark, "orders").select("o_orderkey", (F.col("o_orderkey") * F.col("o_orderkey")).alias("skewed"), "o_totalprice")
    cut = quantile_slices(orders, "skewed", 8)
    parts = [part.withColumn("slice", F.lit(k)) for k, part in enumerate(sliced(orders, cut))]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    sizes = rows.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    mean = orders.count() / len(parts)
    off = sizes.agg(F.count_if((F.col("n") < 0.8 * mean) | (F.col("n") > 1.2 * mean)).alias("uneven")).first()["uneven"]
    return rows.select("o_orderkey", "o_totalprice", F.lit(off).cast("int").alias("uneven_slices"))


@query
def scan_multi_source(spark, folder):
    frames = read_sources(
        spark,
        (
            TableSource("orders", "bought", columns=("o_orderkey", "o_totalprice")),
            TableSource("supplier", columns=("s_suppkey",)),
            TableSource("customer", columns=("c_custkey",)),
        ),
        _given(folder),
    )
    keys = [
        frames[alias].select(F.lit(alias).alias("source_alias"), F.col(key).alias("key"))
        for alias, key in (("bought", "o_orderkey"), ("supplier", "s_suppkey"), ("customer", "c_custkey"))
    ]
    return keys[0].unionByName(keys[1]).unionByName(keys[2])


@query
def sql_text_transform(spark, folder):
    frames = {"contracts": view(spark, folder, "contracts_contract")}
    return run_sql(
        spark, CONTRACT_TEXT, frames, {"floor": 100000, "since": "1996-01-01"}
    )


def _landed(spark, folder, name):
    place = shared_folder(spark)
    view(spark, folder, name).write.text(place)
    return place


def _responses(spark, folder):
    return rates.read_payloads(spark, _landed(spark, folder, "rate_responses"))


@query
def rates_from_rows(spark, folder):
    pricebooks = view(spark, folder, "pricebooks_pricebook").select(
        F.col("id").alias("pricebook_id"), F.col("currency").alias("target_currency")
    )
    return lookup_join(
        pricebooks, rates.rates_from_rows(spark, SAMPLE_RATES), ["target_currency"], "left"
    )


@query
def rates_from_json(spark, folder):
    return rates.to_rates(rates.accepted(_responses(spark, folder)))


@query
def rates_filter_symbols(spark, folder):
    return rates.of_currencies(rates.to_rates(rates.accepted(_responses(spark, folder))))


@query
def rates_reject_failed(spark, folder):
    return rates.rejected(_responses(spark, folder))


@query
def rates_ingested(spark, folder):
    """Responses that land in two steps, taken in by three calls: the second reads new files only, the third none."""
    place, store = shared_folder(spark), _snapshots(spark)
    responses = view(spark, folder, "rate_responses")
    late = F.xxhash64("value") % 2 == 0
    made = []
    for rows in (responses.where(~late), responses.where(late), None):
        if rows is not None:
            rows.write.mode("append").text(place)
        made.append(landing.ingest_rates(spark, place, store, currencies=None))
    if [len(m) > 0 for m in made] != [True, True, False] or set(made[0]) & set(made[1]):
        raise RuntimeError(f"responses were not taken in once: {made}")
    return store.read(spark, landing.RATES)


@query
def currency_symbols(spark, folder):
    return rates.read_symbols(spark, _landed(spark, folder, "symbol_responses"), whole_files=False)


# Projections


def _columns_of(name: str, columns: list[str]) -> Query:
    return lambda spark, folder: filters.project(view(spark, folder, name), columns)


QUERIES["contract_info"] = _columns_of("contracts_contract", names.CONTRACT_INFO)
QUERIES["request_info"] = _columns_of("requests", names.REQUEST_INFO)
QUERIES["request_products"] = _columns_of(
    "contract_service_request_products", names.REQUEST_PRODUCTS
)
QUERIES["user_support_requests"] = _columns_of("requests", names.USER_SUPPORT_REQUESTS)
QUERIES["po_history"] = _columns_of("benchmark_report_historical_data", names.PO_HISTORY)


@query
def config_projection(spark, folder):
    job = jobs_from_config(CONTRACT_CONFIG)["contracts_job"]
    (source,) = job.sources
    return job.transform({source.key: view(spark, folder, source.name)}, {})


@query
def qualified_star(spark, folder):
    contracts = view(spark, folder, "contracts_contract").alias("c")
    customers = view(spark, folder, "users_user").alias("u")
    return contracts.join(customers, F.col("c.customer_id") == F.col("u.id")).select("c.*")


@query
def typed_null_column(spark, folder):
    return view(spark, folder, "contracts_contract").select(
        "id", "external_id", empty_column("date").alias("last_download_date")
    )


# Filters


@query
def filter_threshold(spark, folder):
    return filters.above_threshold(view(spark, folder, "sales"))


@query
def filter_equals(spark, folder):
    requested = view(spark, folder, "requests_historicalrequestproduct")
    return requested.where(F.col("type") == names.COMMERCIAL)


@query
def filter_conjunction(spark, folder):
    return demand.materials_in_scope(view(spark, folder, "materials_table"), REGION)


@query
def filter_as_of(spark, folder):
    return filters.known_by(
        view(spark, folder, "requests_historicalrequestvalue"), "history_date", AS_OF
    )


@query
def incremental_filter(spark, folder):
    products = view(spark, folder, "pricebooks_pricebookproduct")
    loaded = filters.known_by(products, "updated_at", LOADED_UNTIL)
    mark = filters.high_water_mark(loaded, "updated_at", AS_OF)
    return filters.changed_since(products, "updated_at", mark)


# Joins


def _pricebook_inputs(spark, folder):
    return [
        view(spark, folder, name)
        for name in (
            "pricebooks_pricebookproduct", "pricebooks_pricebookvalues", "pb_required_field",
            "pricebooks_pricebook",
        )
    ]


@query
def join_inner(spark, folder):
    products, values, _, _ = _pricebook_inputs(spark, folder)
    return products.join(values, products["product_id"] == values["pb_product_id"]).select(
        products["id"].alias("product_row"), "pb_product_id", "pb_required_field_id", "field_value"
    )


@query
def join_broadcast_dim(spark, folder):
    _, values, fields, _ = _pricebook_inputs(spark, folder)
    return pivot.named_values(values, fields).select("pb_product_id", "field_name", "field_value")


@query
def attribute_pivot(spark, folder):
    return pivot.attribute_pivot(*_pricebook_inputs(spark, folder))


@query
def join_left(spark, folder):
    return users.with_company(
        view(spark, folder, "users_user"), view(spark, folder, "companies_customercompany")
    )


@query
def user_dimension(spark, folder):
    return users.user_dimension(
        *[
            view(spark, folder, name)
            for name in (
                "users_user", "companies_customercompany", "users_user_roles", "roles_role",
            )
        ]
    )


@query
def join_cross_singleton(spark, folder):
    materials = view(spark, folder, "materials_table")
    return materials.select(
        "manufacturer_name", "po_item_first_release_date",
        F.lit(AS_OF_YEAR).alias("current_year"),
        (F.lit(AS_OF_YEAR) - year_of("po_item_first_release_date")).alias("years_ago"),
    )


@query
def join_semi_lookup(spark, folder):
    return negotiation.of_field(
        view(spark, folder, "request_values"), view(spark, folder, "pb_required_field")
    ).select("id", "request_product_id", "pricebook_value_id")


@query
def join_left_range(spark, folder):
    return negotiation.resend_matches(
        view(spark, folder, "requests_historicalrequestvalue"),
        view(spark, folder, "requests_historicalrequest"),
    )


@query
def compare_ge_all(spark, folder):
    return negotiation.compare_with_all(view(spark, folder, "requests_historicalrequestvalue"))


# Demand


def _scope(spark, folder):
    return demand.materials_in_scope(view(spark, folder, "materials_table"), REGION)


@query
def demand_yearly(spark, folder):
    return demand.yearly_demand(_scope(spark, folder))


@query
def demand_yearly_corrected(spark, folder):
    return demand.yearly_demand(_scope(spark, folder), corrected=True)


def _demand_state(spark, folder):
    """Demand after a load with rows that are wrong or missing, and a load of signed changes that mends it."""
    store, rows = _snapshots(spark), _scope(spark, folder)
    wrong = F.xxhash64("description", "po_item_quantity") % 5 == 0
    mistaken = rows.where(wrong).withColumn("po_item_quantity", F.col("po_item_quantity") + 3)
    add_demand(rows.where(~wrong).unionByName(mistaken.withColumn("po_item_quantity", F.col("po_item_quantity").cast(rows.schema["po_item_quantity"].dataType))), store, "first", None)
    changes = mistaken.withColumn("po_item_quantity", F.col("po_item_quantity").cast(rows.schema["po_item_quantity"].dataType)).withColumn("change", F.lit(-1))
    changes = changes.unionByName(rows.where(wrong).withColumn("change", F.lit(1)))
    for _ in range(2):
        add_demand(changes, store, "second")
    return store


@query
def demand_state_yearly(spark, folder):
    return yearly_demand_of(spark, _demand_state(spark, folder))


@query
def demand_state_yearly_corrected(spark, folder):
    store = _demand_state(spark, folder)
    compact_demand(spark, store)
    return yearly_demand_of(spark, store, corrected=True)


@query
def demand_summary(spark, folder):
    return demand.demand_summary(
        view(spark, folder, "pricebook_info"),
        demand.yearly_demand(_scope(spark, folder)),
        AS_OF_YEAR,
    )


@query
def agg_filter_clause(spark, folder):
    return demand.recent_average(view(spark, folder, "materials_table"), AS_OF_YEAR)


@query
def agg_by_year(spark, folder):
    return demand.quantity_by_year(view(spark, folder, "materials_table"))


@query
def agg_count(spark, folder):
    return _given(folder).read(spark, "lineitem").groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count")
    )


# Histories


def _negotiation_inputs(spark, folder):
    return [
        view(spark, folder, name)
        for name in (
            "requests_historicalrequestproduct", "request_values",
            "requests_historicalrequestvalue", "requests_historicalrequest", "pb_required_field",
        )
    ]


@query
def window_lead_status(spark, folder):
    return negotiation.next_status(view(spark, folder, "requests_historicalrequest"))


@query
def window_row_number_label(spark, folder):
    return negotiation.numbered_history(view(spark, folder, "requests_historicalrequestvalue"))


@query
def negotiation_history(spark, folder):
    return negotiation.negotiation_history(*_negotiation_inputs(spark, folder), AS_OF)


@query
def negotiation_history_dedup(spark, folder):
    return negotiation.negotiation_history(
        *_negotiation_inputs(spark, folder), AS_OF, fan_out=False
    )


@query
def negotiation_runs(spark, folder):
    return negotiation.negotiation_runs(*_negotiation_inputs(spark, folder), AS_OF)


@query
def negotiation_history_expanded(spark, folder):
    """The job stores runs; the history is a view over what it stored."""
    source, target = _staging(spark), _staging(spark)
    job = JOBS["negotiation_history"]
    for s, frame in zip(job.sources, _negotiation_inputs(spark, folder), strict=True):
        source.replace(frame.select(*s.columns), s.name)
    run(spark, job, source, target, {"as_of": AS_OF, "as_runs": True})
    return negotiation.expand_runs(target.read(spark, job.target))


@query
def sort_history(spark, folder):
    ordered = sort_rows(
        view(spark, folder, "requests_historicalrequestvalue"),
        ["request_product_id", *negotiation.HISTORY_ORDER],
    )
    # The place of a row: the rows of the parts before its own, and those before it.
    store = _staging(spark)
    store.replace(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    rows = store.read(spark, "ordered").withColumn("part", F.shiftright("at", 33))
    parts = rows.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    place = F.col("ahead") + F.col("at") - F.shiftleft("part", 33) + 1
    return rows.join(parts, "part").withColumn("place", place).drop("part", "at", "ahead")


# Scalars and JSON


@query
def scalar_epoch(spark, folder):
    return _given(folder).read(spark, "events").select(
        "event_id", epoch_seconds("ts").alias("history_epoch")
    )


@query
def json_text_field(spark, folder):
    runs = view(spark, folder, "history_materialbenchmarkhistory")
    return runs.select(
        "id",
        text_at("input_data", benchmark.MATERIAL_PATH).alias("material_n"),
        text_at("plots_data", benchmark.RESULT_PATH).alias("dmp_result"),
    )


@query
def json_path_numeric(spark, folder):
    events = _given(folder).read(spark, "events")
    return events.select(
        "event_id", number_at("props", "$.k", "int").alias("k"),
        number_at("props", "$.k", "decimal(18,2)").alias("k_money"),
    )


@query
def json_array_explode(spark, folder):
    runs = view(spark, folder, "history_materialbenchmarkhistory")
    return explode_elements(runs, "table_data", ["id"])


@query
def json_array_latest(spark, folder):
    runs = view(spark, folder, "history_materialbenchmarkhistory")
    return benchmark.benchmark_history(runs).select("id", "price_proposed_old_input")


@query
def benchmark_history(spark, folder):
    return benchmark.benchmark_history(view(spark, folder, "history_materialbenchmarkhistory"))


@query
def benchmark_of_documents(spark, folder):
    """Documents are parsed once, when they land; the history reads the landing table."""
    store = _staging(spark)
    store.replace(benchmark.with_documents(view(spark, folder, "history_materialbenchmarkhistory")), "runs")
    return benchmark.history_of_documents(store.read(spark, "runs"))


# Sinks: each writes staged tables and gives back what can be read there.


@query
def sink_overwrite(spark, folder):
    store, suppliers = _staging(spark), _given(folder).read(spark, "supplier")
    for _ in range(2):
        sinks.overwrite(suppliers, store, "supplier_copy")
    return store.read(spark, "supplier_copy")


@query
def sink_append(spark, folder):
    store, suppliers = _staging(spark), _given(folder).read(spark, "supplier")
    for _ in range(2):
        sinks.append(suppliers, store, "supplier_copy")
    return store.read(spark, "supplier_copy")


@query
def sink_truncate_reload(spark, folder):
    store, suppliers = _staging(spark), _given(folder).read(spark, "supplier")
    ddl = "s_name string, s_suppkey bigint, s_acctbal decimal(18,2), s_nationkey int"
    for _ in range(2):
        sinks.truncate_reload(suppliers, store, "supplier_copy", ddl)
    return store.read(spark, "supplier_copy")


@query
def stage_insert_by_name(spark, folder):
    store, customers = _staging(spark), _given(folder).read(spark, "customer")
    ddl = "c_mktsegment string, c_name string, c_custkey bigint, c_nationkey int, c_acctbal double"
    sinks.truncate_reload(customers.where("c_custkey % 2 = 0"), store, "staged", ddl)
    sinks.insert_by_name(customers.where("c_custkey % 2 <> 0"), store, "staged")
    return store.read(spark, "staged")


@query
def transfer_filtered(spark, folder):
    store = _staging(spark)
    sinks.transfer(
        spark,
        "SELECT event_id, user_id, event_type, value AS amount FROM {events} WHERE value > 100",
        _given(folder), store, "sales_transformed",
    )
    return store.read(spark, "sales_transformed")


@query
def transfer_paged(spark, folder):
    """The same in pages of keys, lost after the third page and taken up again."""
    store, given = _snapshots(spark), _given(folder)
    text = "SELECT event_id, user_id, event_type, value AS amount FROM {events} WHERE value > 100"
    rows = given.query(spark, text).count()

    class Lost(RuntimeError):
        pass

    class Stops(SnapshotStore):
        def append(self, df, table, page=None, load=None):
            if load == "page-3":
                raise Lost
            super().append(df, table, page, load)

    try:
        transfer_in_pages(spark, text, given, Stops(store.root), "sales_transformed", "event_id", -(-rows // 8))
    except Lost:
        done = transfer_in_pages(spark, text, given, store, "sales_transformed", "event_id", -(-rows // 8))
        if done.done_before != 3:
            raise RuntimeError(f"pages were transferred twice: {done}") from None
    return store.read(spark, "sales_transformed")


@query
def copy_tables(spark, folder):
    store = _staging(spark)
    copies = {
        "orders": ("order_owners", ["o_orderkey", "o_custkey", "o_orderstatus"]),
        "customer": ("customer_names", ["c_custkey", "c_name"]),
        "part": ("part_prices", ["p_partkey", "p_retailprice"]),
        "lineitem": ("line_dates", ["l_orderkey", "l_linenumber", "l_shipdate"]),
    }
    texts = {"part_prices": ["p_partkey", F.col("p_retailprice").cast("decimal(18,4)")],
             "line_dates": ["l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date")]}
    copied = None
    for done in sinks.copy_tables(spark, copies, _given(folder), store):
        rows = store.read(spark, done.target)
        text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in texts.get(done.target, rows.columns)])
        named = rows.select(F.lit(done.target).alias("target"), text.alias("row_text"))
        copied = named if copied is None else copied.unionByName(named)
    return copied


@query
def incremental_pricebook(spark, folder):
    """A full load, then changes, then a refresh of what changed: equal to a fresh full load."""
    source, target, staging = _staging(spark), _staging(spark), _staging(spark)
    names_read = [s.name for s in JOBS["pricebook_info"].sources]
    for name in names_read:
        rows = view(spark, folder, name)
        old = F.col("updated_at") > F.lit(LOADED_UNTIL).cast("timestamp_ntz")
        if name == "pricebooks_pricebookproduct":
            rows = rows.withColumn("status", F.when(old, F.lit("OLD")).otherwise(F.col("status")))
        source.replace(rows, name)
    run(spark, JOBS["pricebook_info"], source, target)
    for name in names_read:
        source.replace(view(spark, folder, name), name)
    refresh_pricebook(spark, source, staging, target, LOADED_UNTIL)
    return target.read(spark, JOBS["pricebook_info"].target)


@query
def pricebook_change_refresh(spark, folder):
    """A load of inputs that differ everywhere, then a refresh: equal to a full load."""
    source, target = _staging(spark), _snapshots(spark)
    products, values, fields, headers = (s.name for s in JOBS["pricebook_info"].sources)
    truth = {n: view(spark, folder, n) for n in (products, values, fields, headers)}
    few = F.col("product_id") % 11 == 0
    removed = truth[products].where("product_id % 13 = 0").withColumn("id", F.col("id") + 10_000_000)
    before = {
        products: truth[products].where("product_id % 17 <> 0").withColumn("status", F.when(few, "OLD").otherwise(F.col("status"))).unionByName(removed),
        values: truth[values].where("pb_product_id % 19 <> 0").withColumn("field_value", F.when(F.col("pb_product_id") % 23 == 0, "old").otherwise(F.col("field_value"))),
        fields: truth[fields].withColumn("field_name", F.when(F.col("field_name") == "sap_id", "another").otherwise(F.col("field_name"))),
        headers: truth[headers].withColumn("currency", F.when(F.col("id") % 5 == 0, "XXX").otherwise(F.col("currency"))),
    }
    for frames in (before, truth):
        for name, rows in frames.items():
            source.replace(rows, name)
        refresh_by_changes(spark, source, target, buckets=8)
    return target.read(spark, JOBS["pricebook_info"].target)


@query
def snapshot_overwrite(spark, folder):
    """The second version replaces the first at its commit; a reader of the first goes on reading it."""
    store, suppliers = _snapshots(spark), _given(folder).read(spark, "supplier")
    sinks.overwrite(suppliers.where("s_suppkey % 2 = 0"), store, "supplier_copy")
    earlier = store.read(spark, "supplier_copy")
    sinks.overwrite(suppliers, store, "supplier_copy")
    both = [f.select(F.lit(v).alias("version"), "*") for v, f in ((1, earlier), (2, store.read(spark, "supplier_copy")))]
    return both[0].unionByName(both[1])


@query
def append_by_load(spark, folder):
    """Loads that are repeated, one of them with other rows at first: each is there once."""
    store, customers = _snapshots(spark), _given(folder).read(spark, "customer")
    parts = [customers.where(f"c_custkey % 3 = {k}") for k in range(3)]
    for load, rows in (("a", parts[0].limit(5)), ("b", parts[1]), ("a", parts[0]), ("c", parts[2]), ("b", parts[1])):
        sinks.append(rows, store, "customers", load)
    return store.read(spark, "customers")


@query
def publish_snapshot(spark, folder):
    """Checked and published within one store: by one commit, without copying a row."""
    store = _snapshots(spark)
    sinks.overwrite(attribute_pivot(spark, folder), store, "staged")
    sinks.publish(spark, store, "staged", store, "published", "id")
    store.drop(spark, "staged")
    return store.read(spark, "published")


@query
def publish_staged(spark, folder):
    store = _staging(spark)
    sinks.overwrite(attribute_pivot(spark, folder), store, "staged")
    sinks.publish(spark, store, "staged", store, "published", "id")
    return store.read(spark, "published")


@query
def pricebook_staged(spark, folder):
    inputs, store = _staging(spark), _staging(spark)
    job = JOBS["pricebook_staging"]
    for source, frame in zip(job.sources, _pricebook_inputs(spark, folder)):
        sinks.overwrite(frame, inputs, source.name)
    target = JOBS["pricebook_info"].target
    run_staged(spark, job, inputs, store, store, target, "id")
    return store.read(spark, target)


@query
def preview_top5(spark, folder):
    return sinks.preview(view(spark, folder, "contracts_contract"), ["id"])

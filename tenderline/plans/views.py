"""The job inputs as views over the test tables.

Single-table views are lists of expressions that Spark and the checking database
both understand; ``{ts}`` stands for the zone-less timestamp type of either, ``{suppliers}``
for a number above all supplier keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderline.catalog import ATTRIBUTES, TARGET_CURRENCIES

MONEY = "DECIMAL(18,2)"
AS_OF = "2001-06-30 00:00:00"
AS_OF_YEAR = 2001
REGION = "ASIA"
HIDDEN_FIELD = "internal_note"
FIELD_NAMES = [*ATTRIBUTES, HIDDEN_FIELD]


def _currency(number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(TARGET_CURRENCIES))
    return f"CASE {number} % {len(TARGET_CURRENCIES)} {cases} END"


def _money(expression: str) -> str:
    return f"CAST({expression} AS {MONEY})"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


PRICE_TEXT = _text(_money("l_extendedprice"))

# JSON documents, composed per row.
INPUT_DATA = (
    "'{\"manufacturer_part_number\": ' || CASE WHEN l_partkey % 17 = 0 THEN 'null' "
    f"ELSE '\"PN-' || {_text('l_partkey')} || '\"' END || "
    "', \"vendors\": [' || CASE WHEN l_partkey % 13 = 0 THEN '' ELSE "
    f"'{{\"proposed_price\": \"' || {PRICE_TEXT} || '\"}}, {{\"proposed_price\": \"1.00\"}}' END || ']}}'"
)
PLOTS_DATA = (
    "CASE WHEN l_suppkey % 5 = 0 THEN '{}' "
    "ELSE '{\"recommendation_message\": \"keep ' || l_returnflag || '\"}' END"
)


def _element(identifier: str, price: str) -> str:
    return f"'{{' || {identifier} || '\"unit_price\": \"' || {price} || '\"}}'"


# Ids with one and two digits, as number and as text, and now and then without id.
ELEMENT_IDS = [
    "l_linenumber + 6",
    "l_suppkey % 13",
    "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_linenumber * 3 END",
]
ELEMENT_PRICES = [_money("l_extendedprice"), _money("l_quantity"), _money("l_extendedprice - 1")]
TABLE_DATA = (
    "CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN '[]' ELSE '[' || "
    + _element("'\"id\": ' || " + _text(ELEMENT_IDS[0]) + " || ', '", _text(ELEMENT_PRICES[0]))
    + " || ', ' || "
    + _element("'\"id\": \"' || " + _text(ELEMENT_IDS[1]) + " || '\", '", _text(ELEMENT_PRICES[1]))
    + " || ', ' || "
    + _element(
        f"CASE WHEN l_partkey % 9 = 0 THEN '' ELSE '\"id\": ' || {_text('l_linenumber * 3')} || ', ' END",
        _text(ELEMENT_PRICES[2]),
    )
    + " || ']' END"
)


def _rate_cents(step: int) -> str:
    return _text(_money("o_totalprice") + f" + {step}")


RATES_DATA = (
    "'{\"success\": ' || CASE WHEN o_orderkey % 10 = 0 THEN 'false, \"message\": \"quota\"' ELSE 'true' END"
    " || ', \"base\": \"EUR\", \"date\": \"' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '\", \"rates\": {' || "
    + " || ', ' || ".join(
        f"'\"{c}\": ' || {_rate_cents(i)}" for i, c in enumerate([*TARGET_CURRENCIES, "GBP"])
    )
    + " || '}}'"
)
SYMBOLS_DATA = (
    "'{\"success\": true, \"symbols\": {\"' || p_brand || '\": \"' || p_type || "
    "'\", \"P' || " + _text("p_partkey") + " || '\": \"' || p_name || '\"}}'"
)

# view -> (table, condition, columns)
VIEWS: dict[str, tuple[str, str, dict[str, str]]] = {
    "contracts_contract": ("orders", "TRUE", {
        "id": "o_orderkey",
        "external_id": f"'C-' || {_text('o_orderkey')}",
        "description": "o_orderpriority",
        "customer_id": "o_custkey",
        "supplier_id": "o_orderkey % 10",
        "cam_id": "o_custkey % 7",
        "procurement_contract_owner": "o_orderstatus",
        "valid_from": "CAST(o_orderdate AS DATE)",
        "valid_to": "CAST(CAST(o_orderdate AS DATE) + INTERVAL '365' DAY AS DATE)",
        "contract_approved_value": _money("o_totalprice"),
    }),
    "pricebooks_pricebook": ("supplier", "TRUE", {
        "id": "s_suppkey",
        "contract_id": "s_suppkey * 3",
        "description": "s_name",
        "currency": _currency("s_nationkey"),
        "customer_reference_number": f"'REF-' || {_text('s_suppkey')}",
    }),
    "pricebooks_pricebookproduct": ("part", "TRUE", {
        "id": "p_partkey + 100000",
        "pricebook_id": "p_partkey % {suppliers}",
        "status": "p_type",
        "is_new": "p_size > 25",
        "cam_approved": "p_size % 2 = 0",
        "disable_reason": "CASE WHEN p_size > 45 THEN 'EXPIRED' END",
        "updated_at": "CAST(DATE '2001-01-01' + p_size AS {ts})",
        "product_id": "p_partkey",
        "is_new_for_contract_owner": "p_size < 10",
    }),
    "pricebook_info": ("part", "TRUE", {
        "id": "p_partkey + 100000",
        "manufacturer_name": "CASE WHEN p_partkey % 29 <> 0 THEN p_brand END",
        "manufacturer_part_no": "CASE WHEN p_partkey % 31 = 0 THEN 'unknown' ELSE p_name END",
        "customer_long_description": "p_type",
    }),
    "requests": ("orders", "TRUE", {
        "id": "o_orderkey",
        "status": "o_orderstatus",
        "request_to": "o_orderpriority",
        "pricebook_id": "o_orderkey % 10",
        "workflow_id": "o_orderkey % 3",
        "sender_id": "o_custkey",
        "receiver_id": "o_custkey",
        "created_at": "o_orderdate",
        "updated_at": "o_orderdate + INTERVAL '5' DAY",
    }),
    "contract_service_request_products": ("lineitem", "TRUE", {
        "request_product_id": "l_orderkey * 10 + l_linenumber",
        "pricebook_product_id": "l_partkey",
        "request_id": "l_orderkey",
        "status": "l_linestatus",
        "status_customer": "l_returnflag",
    }),
    "requests_historicalrequestproduct": ("orders", "TRUE", {
        "id": "o_orderkey",
        "request_id": "o_orderkey",
        "pricebook_product_id": "o_custkey",
        "type": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'COMMERCIAL' ELSE 'TECHNICAL' END",
        "status": "CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING' ELSE 'REJECTED' END",
        "history_date": "o_orderdate + INTERVAL '60' DAY",
    }),
    "request_values": ("orders", "TRUE", {
        "id": "o_orderkey",
        "request_product_id": "o_orderkey",
        "pricebook_value_id": "CASE WHEN o_orderkey % 2 = 1 THEN 4 ELSE 3 END",
    }),
    "requests_historicalrequestvalue": ("lineitem", "TRUE", {
        "id": "l_orderkey",
        "request_product_id": "l_orderkey",
        "draft_value": "l_extendedprice",
        "history_user_id": "l_suppkey",
        "history_date": "CASE WHEN l_partkey % 101 <> 0 THEN l_shipdate END",
    }),
    "requests_historicalrequest": ("lineitem", "TRUE", {
        "id": "l_orderkey",
        "status": "l_linestatus",
        "history_date": "l_shipdate",
    }),
    "users_user": ("customer", "TRUE", {
        "id": "c_custkey",
        "first_name": "c_name",
        "last_name": "c_mktsegment",
        "company_id": "CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END",
    }),
    "companies_customercompany": ("nation", "TRUE", {
        "id": "n_nationkey + 1",
        "name": "n_name",
    }),
    "roles_role": ("region", "TRUE", {
        "id": "r_regionkey",
        "name": "r_name",
    }),
    "history_materialbenchmarkhistory": ("lineitem", "TRUE", {
        "id": "l_orderkey * 10 + l_linenumber",
        "user_id": "l_suppkey",
        "timestamp": "l_shipdate",
        "input_data": INPUT_DATA,
        "plots_data": PLOTS_DATA,
        "table_data": TABLE_DATA,
        "corrected_price": _money("l_extendedprice"),
        "corrected_currency": _currency("l_suppkey"),
        "company_id": "l_linenumber",
    }),
    "sales": ("events", "TRUE", {
        "event_id": "event_id",
        "user_id": "user_id",
        "event_type": "event_type",
        "amount": "value",
    }),
    "rate_responses": ("orders", "TRUE", {"value": RATES_DATA}),
    "symbol_responses": ("part", "TRUE", {"value": SYMBOLS_DATA}),
}

MATERIALS = {
    "manufacturer_name": "p_brand",
    "manufacturer_part_no": "p_name",
    "customer_long_description": "CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_type END",
    "description": "p_type",
    "po_item_quantity": _money("l_quantity"),
    "po_item_first_release_date": "CAST(l_shipdate AS DATE)",
    "region": "r_name",
    "company_id": "l_linenumber",
}

ORDERS_PLACED = {
    "id": "l_orderkey * 10 + l_linenumber",
    "po_no": _text("l_orderkey"),
    "po_item_no": "l_linenumber",
    "region": "r_name",
    "po_item_creation_date": "CAST(o_orderdate AS DATE)",
    "po_item_first_release_date": "CAST(l_shipdate AS DATE)",
    "po_item_quantity": _money("l_quantity"),
    "po_item_quantity_unit": "'EA'",
    "po_item_value_gc": _money("l_extendedprice"),
    "po_item_value_gc_unit": "'EUR'",
    "po_status_name": "o_orderstatus",
    "po_item_deletion_flag": "l_returnflag = 'R'",
    "po_type": "o_orderpriority",
    "po_item_description": "p_name",
    "long_description": "p_type",
    "incoterm_key": "l_linestatus",
    "buyer_name": f"'Buyer ' || {_text('o_custkey')}",
    "vendor_name": "s_name",
    "manufacturer_name": "p_brand",
    "material_service_no": _text("l_partkey"),
    "manufacturer_part_no": "p_name",
    "product_category_id": "p_size",
    "product_category_description": "p_type",
    "created_at_system": "o_orderdate",
    "company_id": "n_nationkey",
    "pricebook_external_id": "CAST(NULL AS STRING)",
}

SUPPLY = (
    ("supplier", "l_suppkey = s_suppkey"),
    ("nation", "s_nationkey = n_nationkey"),
    ("region", "n_regionkey = r_regionkey"),
)

# Field values: which parts carry which fields, and their text.
VALUE_CONDITION = (
    "p_partkey % 11 <> 0 AND (p_partkey + f) % 5 <> 0 AND (p_partkey % 17 <> 0 OR f = 16)"
)
VALUE_TEXT = (
    f"CASE f WHEN 4 THEN {_text(_money('p_retailprice'))} WHEN 13 THEN p_brand WHEN 14 THEN p_name "
    f"WHEN 15 THEN p_type ELSE 'v' || {_text('f')} || '-' || {_text('p_partkey % 13')} END"
)
# A second, higher price whose text may sort lower.
SECOND_CONDITION = "p_partkey % 3 = 0 AND p_partkey % 11 <> 0 AND p_partkey % 17 <> 0"
SECOND_TEXT = _text(_money("p_retailprice * 10"))


# Declared, so that opening a table does not start a job to look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _spark_columns(columns: dict[str, str], suppliers: str = "") -> list[str]:
    kinds = {"{ts}": "TIMESTAMP_NTZ", "{suppliers}": suppliers}
    for mark, text in kinds.items():
        columns = {c: e.replace(mark, text) for c, e in columns.items()}
    return [f"{e} AS `{c}`" for c, e in columns.items()]


def _joined(spark: SparkSession, folder: str, extra: tuple) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    for name, condition in (("part", "l_partkey = p_partkey"), *SUPPLY, *extra):
        rows = rows.join(table(spark, folder, name), F.expr(condition))
    return rows


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A job input by its table name."""
    if name in VIEWS:
        source, condition, columns = VIEWS[name]
        rows = table(spark, folder, source).where(condition)
        if not any("{suppliers}" in e for e in columns.values()):
            return rows.selectExpr(*_spark_columns(columns))
        # The greatest key and one more, so that all suppliers are met whatever their number.
        greatest = table(spark, folder, "supplier").agg(F.max("s_suppkey")).first()[0]
        return rows.selectExpr(*_spark_columns(columns, str(greatest + 1)))
    return _COMPOSED[name](spark, folder)


def _fields(spark: SparkSession, _: str) -> DataFrame:
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(FIELD_NAMES, 1))
    return spark.sql(f"SELECT id, field_name FROM VALUES {rows} AS field(id, field_name)")


def _values(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    cells = parts.withColumn("f", F.explode(F.sequence(F.lit(1), F.lit(len(FIELD_NAMES)))))
    first = cells.where(VALUE_CONDITION).selectExpr(
        "p_partkey * 100 + f AS id", "p_partkey AS pb_product_id",
        "f AS pb_required_field_id", f"{VALUE_TEXT} AS field_value",
    )
    second = parts.where(SECOND_CONDITION).selectExpr(
        "p_partkey * 100 + 50 AS id", "p_partkey AS pb_product_id",
        "4 AS pb_required_field_id", f"{SECOND_TEXT} AS field_value",
    )
    return first.unionByName(second)


def _memberships(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "customer")
    first = users.where("c_custkey % 4 <> 0").selectExpr(
        "c_custkey AS user_id", "c_custkey % 5 AS role_id"
    )
    second = users.where("c_custkey % 3 = 0").selectExpr(
        "c_custkey AS user_id", "(c_custkey + 1) % 5 AS role_id"
    )
    return first.unionByName(second)


def _materials(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(spark, folder, ()).selectExpr(*_spark_columns(MATERIALS))


def _orders_placed(spark: SparkSession, folder: str) -> DataFrame:
    extra = (("orders", "l_orderkey = o_orderkey"),)
    return _joined(spark, folder, extra).selectExpr(*_spark_columns(ORDERS_PLACED))


_COMPOSED = {
    "pb_required_field": _fields,
    "pricebooks_pricebookvalues": _values,
    "users_user_roles": _memberships,
    "materials_table": _materials,
    "benchmark_report_historical_data": _orders_placed,
}
VIEW_NAMES = [*VIEWS, *_COMPOSED]

"""The same results in plain SQL for DuckDB, written independently of the jobs."""

from __future__ import annotations

from tenderline import catalog as names
from tenderline.plans import views as v
from tenderline.plans.queries import LOADED_UNTIL, SAMPLE_RATES


SUPPLIERS = "(SELECT max(s_suppkey) + 1 FROM supplier)"


def _select(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(
        f'{e.replace("{ts}", "TIMESTAMP").replace("{suppliers}", SUPPLIERS)} AS "{c}"'
        for c, e in columns.items()
    )
    return f"SELECT {listed} FROM {source}"


def _joined(extra: str = "") -> str:
    return (
        "lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey "
        "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey" + extra
    )


VIEW_SQL = {
    name: _select(columns, f"{table} WHERE {condition}")
    for name, (table, condition, columns) in v.VIEWS.items()
}
VIEW_SQL["pb_required_field"] = "SELECT * FROM (VALUES {}) AS t(id, field_name)".format(
    ", ".join(f"({i}, '{n}')" for i, n in enumerate(v.FIELD_NAMES, 1))
)
VIEW_SQL["pricebooks_pricebookvalues"] = f"""
    SELECT p_partkey * 100 + f AS id, p_partkey AS pb_product_id, CAST(f AS INTEGER) AS pb_required_field_id,
           {v.VALUE_TEXT} AS field_value
    FROM part CROSS JOIN range(1, 17) AS r(f) WHERE {v.VALUE_CONDITION}
    UNION ALL
    SELECT p_partkey * 100 + 50, p_partkey, 4, {v.SECOND_TEXT} FROM part WHERE {v.SECOND_CONDITION}
"""
VIEW_SQL["users_user_roles"] = """
    SELECT c_custkey AS user_id, c_custkey % 5 AS role_id FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL
    SELECT c_custkey, (c_custkey + 1) % 5 FROM customer WHERE c_custkey % 3 = 0
"""
VIEW_SQL["materials_table"] = _select(v.MATERIALS, _joined())
VIEW_SQL["benchmark_report_historical_data"] = _select(
    v.ORDERS_PLACED, _joined(" JOIN orders ON l_orderkey = o_orderkey")
)


def _with(text: str, *views: str) -> str:
    defined = ", ".join(f"{n} AS ({VIEW_SQL[n]})" for n in views)
    return f"WITH {defined} {text}"


def _columns(view: str, columns: list[str]) -> str:
    return _with(f"SELECT {', '.join(columns)} FROM {view}", view)


PRICEBOOK_VIEWS = (
    "pricebooks_pricebookproduct", "pricebooks_pricebookvalues", "pb_required_field",
    "pricebooks_pricebook",
)
NEGOTIATION_VIEWS = (
    "requests_historicalrequestproduct", "request_values", "requests_historicalrequestvalue",
    "requests_historicalrequest", "pb_required_field",
)

# Join first, then group everything: the order opposite to the job's.
_PIVOT_BODY = """
    SELECT {product}, {cells}, {header} {more}
    FROM pricebooks_pricebookproduct p, pricebooks_pricebookvalues x, pb_required_field f,
         pricebooks_pricebook b
    WHERE p.product_id = x.pb_product_id AND f.id = x.pb_required_field_id
      AND p.pricebook_id = b.id
    GROUP BY ALL
"""


def _pivot(more: str = "") -> str:
    body = _PIVOT_BODY.format(
        product=", ".join(f"p.{c}" for c in names.PRICEBOOK_PRODUCT),
        cells=", ".join(
            f"MAX(x.field_value) FILTER (f.field_name = '{n}') AS {c}"
            for n, c in names.ATTRIBUTES.items()
        ),
        header=", ".join(f"b.{c} AS {a}" for c, a in names.PRICEBOOK_HEADER.items()),
        more=more,
    )
    return _with(body, *PRICEBOOK_VIEWS)


_SCOPE = f"region = '{v.REGION}' AND company_id = 1"
_YEARLY = f"""
    SELECT a.manufacturer_name, a.manufacturer_part_no, a.description,
           CAST(year(a.po_item_first_release_date) AS INTEGER) AS order_year,
           CAST(SUM(a.po_item_quantity) AS DECIMAL(38,2)) AS total_quantity
    FROM (SELECT * FROM materials_table WHERE {_SCOPE}) a
    JOIN (SELECT * FROM materials_table WHERE {_SCOPE}) b
      ON a.manufacturer_name = b.manufacturer_name
     AND a.manufacturer_part_no = b.manufacturer_part_no
     AND a.description = b.customer_long_description
    GROUP BY 1, 2, 3, 4
"""
_YEARLY_PLAIN = f"""
    SELECT manufacturer_name, manufacturer_part_no, description,
           CAST(year(po_item_first_release_date) AS INTEGER) AS order_year,
           CAST(SUM(po_item_quantity) AS DECIMAL(38,2)) AS total_quantity
    FROM materials_table a
    WHERE {_SCOPE} AND EXISTS (
        SELECT 1 FROM materials_table b
        WHERE {_SCOPE} AND a.manufacturer_name = b.manufacturer_name
          AND a.manufacturer_part_no = b.manufacturer_part_no
          AND a.description = b.customer_long_description)
    GROUP BY 1, 2, 3, 4
"""
_RECENT = f"BETWEEN {v.AS_OF_YEAR - 3} AND {v.AS_OF_YEAR - 1}"

# An offer is the newest if no other one is dated later or not at all.
_OFFERS = f"""
    SELECT q.pricebook_product_id AS product_id, q.request_id, q.status,
           h.draft_value AS unit_price, h.history_user_id, h.history_date,
           q.history_date AS asked, q.id AS asked_id, row_number() OVER numbering AS place,
           NOT EXISTS (
               FROM requests_historicalrequestvalue o WHERE o.request_product_id = q.id
               AND (o.history_date > h.history_date OR o.history_date IS NULL)) AS newest
    FROM requests_historicalrequestvalue h
    JOIN (FROM request_values SEMI JOIN (FROM pb_required_field WHERE field_name = 'unit_price') f
          ON f.id = pricebook_value_id) v ON v.id = h.id
    JOIN requests_historicalrequestproduct q ON q.id = v.request_product_id
    {{resends}}
    WHERE q.type = 'COMMERCIAL' AND h.history_date <= TIMESTAMP '{v.AS_OF}'
    WINDOW numbering AS (PARTITION BY q.id ORDER BY h.history_date, h.draft_value,
                         h.history_user_id, q.pricebook_product_id, q.request_id, q.status)
"""


def _negotiation(resends: str) -> str:
    return _with(
        f"""
        SELECT * EXCLUDE (asked, asked_id, place, newest),
               if(history_date <= asked, 'previous_approved',
                  if(coalesce(status, '') = 'APPROVED' AND newest, 'approved',
                     concat('PENDING_', place))) AS status_label
        FROM ({_OFFERS.format(resends=resends)})
        """,
        *NEGOTIATION_VIEWS,
    )


_RESENDS = (
    "LEFT JOIN requests_historicalrequest e ON q.id = e.id AND e.history_date > h.history_date"
)

_RUNS_OF_ROWS = _with(
    f"""
    SELECT * EXCLUDE (asked, asked_id, newest, place),
           CASE WHEN history_date <= asked THEN 'previous_approved'
                WHEN status = 'APPROVED' AND newest THEN 'approved' END AS fixed_label,
           min(place) AS first_number, count(*) AS copies
    FROM ({_OFFERS.format(resends=_RESENDS)})
    GROUP BY asked_id, asked, newest, product_id, request_id, status, unit_price, history_user_id,
             history_date
    """,
    *NEGOTIATION_VIEWS,
)

_ELEMENTS = " UNION ALL ".join(
    f"SELECT l_orderkey * 10 + l_linenumber AS id, row_id, CAST({e} AS INTEGER) AS element_id, "
    f"CAST({p} AS DECIMAL(18,2)) AS unit_price FROM runs "
    "WHERE l_partkey % 23 <> 0 AND l_partkey % 19 <> 0"
    for e, p in zip(v.ELEMENT_IDS, v.ELEMENT_PRICES)
)
_RUNS = "runs AS (SELECT *, row_number() OVER () AS row_id FROM lineitem)"
_LATEST = f"""
    WITH {_RUNS}, elements AS ({_ELEMENTS}), latest AS (
        SELECT row_id, unit_price FROM elements
        QUALIFY row_number() OVER (
            PARTITION BY row_id ORDER BY element_id DESC NULLS FIRST, unit_price DESC) = 1)
"""
_CASES = {
    "material_n": "CASE WHEN l_partkey % 17 <> 0 THEN 'PN-' || l_partkey END",
    "price_proposed": "CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END",
    "dmp_result": "CASE WHEN l_suppkey % 5 <> 0 THEN 'keep ' || l_returnflag END",
}

_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS target_currency, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + {i} AS DOUBLE) AS rate, "
    "'EUR' AS base, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders WHERE o_orderkey % 10 <> 0"
    for i, c in enumerate([*names.TARGET_CURRENCIES, "GBP"])
)
_SAMPLE = ", ".join(
    f"('{r['target_currency']}', CAST({r['rate']} AS DOUBLE), '{r['base']}', '{r['date']}')"
    for r in SAMPLE_RATES
)

_BENCHMARKS = _LATEST + ", " + _with("", "history_materialbenchmarkhistory")[5:].replace(
    "FROM lineitem", ", row_id, l_partkey, l_suppkey, l_returnflag, l_extendedprice FROM runs"
    ) + f"""
    SELECT id, user_id, "timestamp", input_data, plots_data, table_data, corrected_price,
           corrected_currency, company_id, {_CASES['material_n']} AS material_n,
           {_CASES['price_proposed']} AS price_proposed, {_CASES['dmp_result']} AS dmp_result,
           unit_price AS price_proposed_old_input
    FROM history_materialbenchmarkhistory LEFT JOIN latest USING (row_id)
"""

CHECKS = {
    "scan_table": "SELECT * FROM orders",
    "scan_query": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "scan_multi_source": """
        SELECT 'bought' AS source_alias, o_orderkey AS key FROM orders
        UNION ALL SELECT 'supplier', s_suppkey FROM supplier
        UNION ALL SELECT 'customer', c_custkey FROM customer
    """,
    "sql_text_transform": _with(
        """
        SELECT customer_id, count(*) AS contracts, max(contract_approved_value) AS highest
        FROM contracts_contract
        WHERE contract_approved_value > 100000 AND valid_from >= DATE '1996-01-01'
        GROUP BY customer_id
        """,
        "contracts_contract",
    ),
    "rates_from_rows": _with(
        f"""
        SELECT p.currency AS target_currency, p.id AS pricebook_id, r.rate, r.base, r.date
        FROM pricebooks_pricebook p
        LEFT JOIN (VALUES {_SAMPLE}) AS r(code, rate, base, date) ON r.code = p.currency
        """,
        "pricebooks_pricebook",
    ),
    "rates_from_json": _RATES,
    "rates_ingested": _RATES,
    "scan_balanced_slices": "SELECT o_orderkey, o_totalprice, CAST(0 AS INTEGER) AS uneven_slices FROM orders",
    "rates_filter_symbols": f"SELECT * FROM ({_RATES}) WHERE target_currency <> 'GBP'",
    "rates_reject_failed": """
        SELECT 'quota' AS message, 'EUR' AS base, strftime(o_orderdate, '%Y-%m-%d') AS date
        FROM orders WHERE o_orderkey % 10 = 0
    """,
    "currency_symbols": """
        SELECT p_brand AS code, p_type AS name FROM part
        UNION SELECT 'P' || p_partkey, p_name FROM part
    """,
    "contract_info": _columns("contracts_contract", names.CONTRACT_INFO),
    "request_info": _columns("requests", names.REQUEST_INFO),
    "request_products": _columns("contract_service_request_products", names.REQUEST_PRODUCTS),
    "user_support_requests": _columns("requests", names.USER_SUPPORT_REQUESTS),
    "po_history": _columns("benchmark_report_historical_data", names.PO_HISTORY),
    "config_projection": _columns(
        "contracts_contract",
        ["id", "external_id", "supplier_id", "valid_to", "contract_approved_value"],
    ),
    "qualified_star": _with(
        "SELECT c.* FROM contracts_contract c WHERE customer_id IN (SELECT c_custkey FROM customer)",
        "contracts_contract",
    ),
    "typed_null_column": _with(
        "SELECT id, external_id, CAST(NULL AS DATE) AS last_download_date FROM contracts_contract",
        "contracts_contract",
    ),
    "filter_threshold": _with("SELECT * FROM sales WHERE amount > 100", "sales"),
    "filter_equals": _with(
        "SELECT * FROM requests_historicalrequestproduct WHERE type = 'COMMERCIAL'",
        "requests_historicalrequestproduct",
    ),
    "filter_conjunction": _with(
        f"SELECT * FROM materials_table WHERE {_SCOPE}", "materials_table"
    ),
    "filter_as_of": _with(
        "SELECT * FROM requests_historicalrequestvalue "
        f"WHERE history_date <= TIMESTAMP '{v.AS_OF}'",
        "requests_historicalrequestvalue",
    ),
    "incremental_filter": _with(
        f"""
        SELECT * FROM pricebooks_pricebookproduct WHERE updated_at > (
            SELECT max(updated_at) FROM pricebooks_pricebookproduct
            WHERE updated_at <= TIMESTAMP '{LOADED_UNTIL}')
        """,
        "pricebooks_pricebookproduct",
    ),
    "join_inner": _with(
        """
        SELECT p.id AS product_row, x.pb_product_id, x.pb_required_field_id, x.field_value
        FROM pricebooks_pricebookproduct p JOIN pricebooks_pricebookvalues x
          ON p.product_id = x.pb_product_id
        """,
        "pricebooks_pricebookproduct", "pricebooks_pricebookvalues",
    ),
    "join_broadcast_dim": _with(
        """
        SELECT x.pb_product_id, f.field_name, x.field_value
        FROM pricebooks_pricebookvalues x JOIN pb_required_field f ON f.id = x.pb_required_field_id
        """,
        "pricebooks_pricebookvalues", "pb_required_field",
    ),
    "attribute_pivot": _pivot(),
    "join_left": _with(
        """
        SELECT u.id, u.first_name, u.last_name, c.id AS company_id, c.name AS company_name
        FROM users_user u LEFT JOIN companies_customercompany c ON u.company_id = c.id
        """,
        "users_user", "companies_customercompany",
    ),
    "user_dimension": _with(
        """
        SELECT u.id, u.first_name, u.last_name, c.id AS company_id, c.name AS company_name,
               r.name AS user_type
        FROM roles_role r RIGHT JOIN users_user_roles m ON r.id = m.role_id
        RIGHT JOIN users_user u ON u.id = m.user_id
        LEFT JOIN companies_customercompany c ON c.id = u.company_id
        """,
        "users_user", "companies_customercompany", "users_user_roles", "roles_role",
    ),
    "join_cross_singleton": _with(
        f"""
        SELECT manufacturer_name, po_item_first_release_date, y.current_year,
               CAST(y.current_year - year(po_item_first_release_date) AS INTEGER) AS years_ago
        FROM materials_table CROSS JOIN (SELECT CAST({v.AS_OF_YEAR} AS INTEGER) AS current_year) y
        """,
        "materials_table",
    ),
    "join_semi_lookup": _with(
        """
        SELECT v.id, v.request_product_id, v.pricebook_value_id
        FROM request_values v JOIN pb_required_field f ON f.id = v.pricebook_value_id
        WHERE f.field_name = 'unit_price'
        """,
        "request_values", "pb_required_field",
    ),
    "join_left_range": _with(
        """
        SELECT h.request_product_id, h.draft_value, h.history_user_id, h.history_date,
               count(e.history_date) AS matched_rows, count(*) AS joined_rows
        FROM requests_historicalrequestvalue h
        LEFT JOIN requests_historicalrequest e
          ON e.id = h.request_product_id AND h.history_date < e.history_date
        GROUP BY 1, 2, 3, 4
        """,
        "requests_historicalrequestvalue", "requests_historicalrequest",
    ),
    "compare_ge_all": _with(
        """
        SELECT h.request_product_id, h.draft_value, h.history_user_id, h.history_date,
               coalesce(h.history_date >= ALL (
                   SELECT o.history_date FROM requests_historicalrequestvalue o
                   WHERE o.request_product_id = h.request_product_id), FALSE) AS is_latest
        FROM requests_historicalrequestvalue h
        """,
        "requests_historicalrequestvalue",
    ),
    "demand_yearly": _with(_YEARLY, "materials_table"),
    "demand_state_yearly": _with(_YEARLY, "materials_table"),
    "demand_state_yearly_corrected": _with(_YEARLY_PLAIN, "materials_table"),
    "demand_yearly_corrected": _with(_YEARLY_PLAIN, "materials_table"),
    "demand_summary": _with(
        f"""
        SELECT p.id AS contract_product_id,
               max(y.total_quantity) FILTER (y.order_year = {v.AS_OF_YEAR - 1}) AS last_year_demand,
               CAST(sum(y.total_quantity) FILTER (y.order_year {_RECENT})
                    / count(y.total_quantity) FILTER (y.order_year {_RECENT}) AS DECIMAL(38,6))
                   AS average_demand
        FROM ({_YEARLY}) y RIGHT JOIN pricebook_info p
          ON (y.manufacturer_name, y.manufacturer_part_no, y.description)
           = (p.manufacturer_name, p.manufacturer_part_no, p.customer_long_description)
        GROUP BY p.id
        """,
        "pricebook_info", "materials_table",
    ),
    "agg_filter_clause": _with(
        f"""
        SELECT manufacturer_name, manufacturer_part_no, description,
               CAST(AVG(po_item_quantity) FILTER (year(po_item_first_release_date) {_RECENT})
                   AS DECIMAL(38,6)) AS average_quantity
        FROM materials_table GROUP BY 1, 2, 3
        """,
        "materials_table",
    ),
    "agg_by_year": _with(
        """
        SELECT CAST(extract(year FROM po_item_first_release_date) AS INTEGER) AS order_year,
               CAST(SUM(po_item_quantity) AS DECIMAL(38,2)) AS total_quantity
        FROM materials_table GROUP BY 1
        """,
        "materials_table",
    ),
    "agg_count": "SELECT l_linestatus, count(*) AS row_count FROM lineitem GROUP BY 1",
    "window_lead_status": _with(
        """
        SELECT id, status, history_date,
               LEAD(status) OVER (PARTITION BY id ORDER BY history_date, status) AS next_status
        FROM requests_historicalrequest
        """,
        "requests_historicalrequest",
    ),
    "window_row_number_label": _with(
        """
        SELECT request_product_id, draft_value, history_user_id, history_date,
               'PENDING_' || CAST(ROW_NUMBER() OVER (
                   PARTITION BY request_product_id
                   ORDER BY history_date NULLS LAST, draft_value, history_user_id) AS STRING)
                   AS sequence_label
        FROM requests_historicalrequestvalue
        """,
        "requests_historicalrequestvalue",
    ),
    "negotiation_history": _negotiation(_RESENDS),
    "negotiation_history_dedup": _negotiation(""),
    "negotiation_runs": _RUNS_OF_ROWS,
    "negotiation_history_expanded": _negotiation(_RESENDS),
    "sort_history": _with(
        """
        SELECT *, rank() OVER (ORDER BY request_product_id NULLS LAST, history_date NULLS LAST,
                               draft_value NULLS LAST, history_user_id NULLS LAST) AS place
        FROM requests_historicalrequestvalue
        """,
        "requests_historicalrequestvalue",
    ),
    "scalar_epoch": """
        SELECT event_id, CAST(CAST(epoch_us(ts) AS DECIMAL(26,6)) / 1000000 AS DECIMAL(20,6))
                   AS history_epoch
        FROM events
    """,
    "json_text_field": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, {_CASES['material_n']} AS material_n,
               {_CASES['dmp_result']} AS dmp_result
        FROM lineitem
    """,
    "json_path_numeric": """
        SELECT event_id, CAST(props::JSON ->> '$.k' AS INTEGER) AS k,
               CAST(props::JSON ->> '$.k' AS DECIMAL(18,2)) AS k_money
        FROM events
    """,
    "json_array_explode": f"WITH {_RUNS} SELECT id, element_id, unit_price FROM ({_ELEMENTS})",
    "json_array_latest": _LATEST + """
        SELECT l_orderkey * 10 + l_linenumber AS id, unit_price AS price_proposed_old_input
        FROM runs LEFT JOIN latest USING (row_id)
    """,
    "benchmark_history": _BENCHMARKS,
    "benchmark_of_documents": _BENCHMARKS,
    "sink_overwrite": "SELECT * FROM supplier",
    "sink_append": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
    "sink_truncate_reload": """
        SELECT s_name, s_suppkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal, s_nationkey
        FROM supplier
    """,
    "stage_insert_by_name": "SELECT c_mktsegment, c_name, c_custkey, c_nationkey, c_acctbal FROM customer",
    "transfer_filtered": """
        SELECT event_id, user_id, event_type, value AS amount FROM events WHERE value > 100
    """,
    "transfer_paged": """
        SELECT event_id, user_id, event_type, value AS amount FROM events WHERE value > 100
    """,
    "copy_tables": """
        SELECT 'order_owners' AS target, concat_ws('|', o_orderkey, o_custkey, o_orderstatus) AS row_text FROM orders
        UNION ALL SELECT 'customer_names', concat_ws('|', c_custkey, c_name) FROM customer
        UNION ALL SELECT 'part_prices', concat_ws('|', p_partkey, CAST(p_retailprice AS DECIMAL(18,4))) FROM part
        UNION ALL SELECT 'line_dates', concat_ws('|', l_orderkey, l_linenumber, CAST(l_shipdate AS DATE)) FROM lineitem
    """,
    "publish_staged": _pivot(),
    "incremental_pricebook": _pivot(),
    "pricebook_change_refresh": _pivot(),
    "publish_snapshot": _pivot(),
    "snapshot_overwrite": """
        SELECT 1 AS version, * FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 2, * FROM supplier
    """,
    "append_by_load": "SELECT * FROM customer",
    "pricebook_staged": _pivot(", CAST(NULL AS DATE) AS last_download_date"),
    "preview_top5": _with(
        "SELECT * FROM contracts_contract ORDER BY id LIMIT 5", "contracts_contract"
    ),
}

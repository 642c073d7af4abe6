"""Names and lists that the dashboards, source tables and rate files agree on."""

# The published column lists, table names, field names, labels and
# currencies. They must stay exactly as they are for results to be comparable.

CONTRACT_INFO = [
    "id", "external_id", "description", "customer_id", "supplier_id", "cam_id",
    "procurement_contract_owner", "valid_from", "valid_to", "contract_approved_value",
]

REQUEST_INFO = [
    "id", "status", "request_to", "pricebook_id", "workflow_id", "receiver_id",
    "created_at", "updated_at",
]

REQUEST_PRODUCTS = [
    "request_product_id", "pricebook_product_id", "request_id", "status", "status_customer",
]

USER_SUPPORT_REQUESTS = [
    "id", "request_to", "pricebook_id", "created_at", "status", "receiver_id",
]

PO_HISTORY = [
    "id", "po_no", "po_item_no", "region", "po_item_creation_date",
    "po_item_first_release_date", "po_item_quantity", "po_item_quantity_unit",
    "po_item_value_gc", "po_item_value_gc_unit", "po_status_name",
    "po_item_deletion_flag", "po_type", "po_item_description", "long_description",
    "incoterm_key", "buyer_name", "vendor_name", "manufacturer_name",
    "material_service_no", "manufacturer_part_no", "product_category_id",
    "product_category_description", "created_at_system", "company_id",
    "pricebook_external_id",
]

PRICEBOOK_PRODUCT = [
    "id", "pricebook_id", "status", "is_new", "cam_approved", "disable_reason",
    "updated_at", "product_id", "is_new_for_contract_owner",
]

# Field name -> column of the wide table.
ATTRIBUTES = {
    "supplier_uom": "supplier_uom",
    "supplier_description": "supplier_description",
    "supplier_part_no": "supplier_part_no",
    "unit_price": "unit_price",
    "price_valid_from": "price_valid_from",
    "price_valid_to": "price_valid_to",
    "sla_lead_time": "sla_lead_time",
    "incoterm_key": "incoterm_key",
    "minimum_order_quantity": "minimum_order_quantity",
    "maximum_order_quantity": "maximum_order_quantity",
    "customer_short_description": "customer_short_description",
    "sap_id": "customer_unique_id",
    "manufacturer_name": "manufacturer_name",
    "manufacturer_part_no": "manufacturer_part_no",
    "manufacturer_description": "manufacturer_description",
}

# Pricebook column -> column of the wide table.
PRICEBOOK_HEADER = {
    "contract_id": "contract_id",
    "description": "pricebook_description",
    "currency": "pricebook_currency",
    "customer_reference_number": "pricebook_customer_reference_number",
}

USER_INFO = ["id", "first_name", "last_name", "company_id", "company_name", "user_type"]

NEGOTIATION_HISTORY = [
    "product_id", "request_id", "status", "unit_price", "history_user_id",
    "history_date", "status_label",
]

# Column subsets of the user-support copies: source table -> (target table, columns).
USER_SUPPORT_COPIES = {
    "contract_service_contracts": (
        "user_support_contract_info",
        ["id", "description", "cam_id", "procurement_contract_owner", "valid_to"],
    ),
    "contract_service_pricebooks": (
        "user_support_pricebook_product",
        ["id", "supplier_description", "price_valid_to"],
    ),
    "contract_service_requests_technicalrequest": (
        "user_support_requests_technical_request",
        ["id", "type", "status", "request_id"],
    ),
    "contract_service_requests": (
        "user_support_requests_request",
        USER_SUPPORT_REQUESTS,
    ),
}

# Projections that users of the configuration file declare: name -> (source, target, columns).
CONFIGURED_PROJECTIONS = {
    "contracts": ("contracts_contract", "contract_dashboard_contract_info", CONTRACT_INFO),
    "requests": (None, None, [
        "id", "status", "request_to", "pricebook_id", "created_by", "receiver_id",
        "created_at", "updated_at",
    ]),
    "request_products": (None, None, ["id", "pricebook_product_id", "request_id", "status"]),
    "historical_demand": (
        "contract_service_pricebook_product_demand",
        "contract_dashboard_historical_demand_for_pricebook_products",
        ["contract_product_id", "last_year_demand", "average_demand"],
    ),
    "pricebook_info": (
        "contract_service_pricebooks_and_products",
        "contract_dashboard_pricebook_and_pricebook_product_info",
        [
            "id", "pricebook_id", "pricebook_description", "pricebook_currency",
            "contract_id", "pricebook_customer_reference_number", "supplier_uom",
            "supplier_description", "customer_short_description",
            "customer_long_description", "supplier_part_no", "unit_price",
            "price_valid_from", "price_valid_to", "sla_lead_time", "incoterm_key",
            "minimum_order_quantity", "maximum_order_quantity", "export_control_status",
            "export_declaration_cost", "certificate_cost", "packaging_cost", "status",
            "is_new", "cam_approved", "disable_reason", "updated_at", "product_id",
            "is_new_for_contract_owner", "customer_unique_id", "last_download_date",
            "manufacturer_name", "manufacturer_part_no", "manufacturer_description",
        ],
    ),
    "request_info": (
        "contract_service_requests",
        "contract_dashboard_request_info",
        [
            "id", "status", "request_to", "pricebook_id", "sender_id", "receiver_id",
            "created_at", "updated_at", "parent_request_id",
        ],
    ),
    "request_product_info": (
        "contract_service_request_products",
        "contract_dashboard_request_product_info",
        REQUEST_PRODUCTS,
    ),
    "user_info": ("contract_service_users", "contract_dashboard_user_info", USER_INFO),
    "currency_rate": (
        "contract_service_currency_rates", "currency_rate", ["currency_name", "rate"],
    ),
    "negotiation_history": (
        "contract_service_negotiation_history",
        "contract_dashboard_negotiation_history_combined",
        [
            "product_id", "request_id", "unit_price", "status", "history_date",
            "history_user_id", "history_id", "history_type", "is_new",
            "is_new_for_contract_owner", "cam_approved", "source", "status_label",
        ],
    ),
}

UNIT_PRICE_FIELD = "unit_price"
COMMERCIAL = "COMMERCIAL"
APPROVED = "APPROVED"
LABEL_PREVIOUS = "previous_approved"
LABEL_APPROVED = "approved"
LABEL_PENDING = "PENDING_"

DEMAND_REGION = "AGT"
DEMAND_COMPANY = 1
SALES_THRESHOLD = 100
TRANSFER_PAGE = 1000

BASE_CURRENCY = "EUR"
TARGET_CURRENCIES = ["USD", "AUD", "CAD", "PLN", "MXN", "AZN", "TRY"]
RATE_SCHEMA = "target_currency string, rate double, base string, date string"
RATE_PAYLOAD_SCHEMA = (
    "success boolean, message string, base string, date string, rates map<string,double>"
)
SYMBOLS_PAYLOAD_SCHEMA = "success boolean, symbols map<string,string>"
# End of fixed values.

"""The jobs that fill the dashboard tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tenderline import catalog as names
from tenderline.functions.scalar import AsOf, as_of_year, empty_column
from tenderline.operators.benchmark import STORED, benchmark_history
from tenderline.operators.demand import demand_summary, materials_in_scope, yearly_demand
from tenderline.operators.filters import above_threshold, changed_since
from tenderline.operators.negotiation import negotiation_history, negotiation_runs
from tenderline.operators.pivot import attribute_pivot
from tenderline.operators.users import user_dimension
from tenderline.plans.runner import read_sources
from tenderline.plans.spec import JobSpec, TableSource, projection_job
from tenderline.sinks.tables import APPEND, CopyResult, copy_tables, overwrite, publish
from tenderline.sources.rates import all_accepted, of_currencies, to_rates
from tenderline.sources.stores import Store

Frames = dict[str, DataFrame]
Args = dict[str, Any]


def _sales(frames: Frames, args: Args) -> DataFrame:
    return above_threshold(frames["sales"], args["threshold"])


def _pricebook(frames: Frames, args: Args) -> DataFrame:
    return attribute_pivot(
        frames["pricebooks_pricebookproduct"],
        frames["pricebooks_pricebookvalues"],
        frames["pb_required_field"],
        frames["pricebooks_pricebook"],
        args["attributes"],
    )


def _pricebook_staged(frames: Frames, args: Args) -> DataFrame:
    return _pricebook(frames, args).withColumn("last_download_date", empty_column("date"))


def _negotiation(frames: Frames, args: Args) -> DataFrame:
    history = negotiation_runs if args["as_runs"] else negotiation_history
    return history(
        frames["requests_historicalrequestproduct"],
        frames["request_values"],
        frames["requests_historicalrequestvalue"],
        frames["requests_historicalrequest"],
        frames["pb_required_field"],
        args["as_of"],
        args["fan_out"],
        args["field_column"],
    )


def _demand(frames: Frames, args: Args) -> DataFrame:
    scope = materials_in_scope(frames["materials_table"], args["region"], args["company_id"])
    return demand_summary(
        frames["pricebook_info"],
        yearly_demand(scope, args["corrected"]),
        as_of_year(args["as_of"]),
    )


def _users(frames: Frames, _: Args) -> DataFrame:
    return user_dimension(
        frames["users_user"],
        frames["companies_customercompany"],
        frames["users_user_roles"],
        frames["roles_role"],
    )


def _benchmark(frames: Frames, args: Args) -> DataFrame:
    return benchmark_history(frames["history_materialbenchmarkhistory"], args["lenient"])


def _rates(frames: Frames, args: Args) -> DataFrame:
    return of_currencies(to_rates(all_accepted(frames["payloads"])), args["currencies"])


_PRICEBOOK_SOURCES = (
    TableSource("pricebooks_pricebookproduct", view_name="ppp", columns=tuple(names.PRICEBOOK_PRODUCT)),
    TableSource(
        "pricebooks_pricebookvalues", view_name="pbv",
        columns=("pb_product_id", "pb_required_field_id", "field_value"),
    ),
    TableSource("pb_required_field", view_name="prf", columns=("id", "field_name")),
    TableSource("pricebooks_pricebook", view_name="pb", columns=("id", *names.PRICEBOOK_HEADER)),
)

JOBS = {
    job.name: job
    for job in [
        JobSpec(
            "sales_threshold", (TableSource("sales", needed=("amount",)),), "sales_transformed",
            _sales, defaults={"threshold": names.SALES_THRESHOLD},
        ),
        projection_job(
            "contract_info", "contracts_contract", "contract_dashboard_contract_info",
            names.CONTRACT_INFO,
        ),
        projection_job(
            "request_info", "requests", "contract_dashboard_request_info", names.REQUEST_INFO
        ),
        projection_job(
            "request_products", "contract_service_request_products",
            "contract_service_request_products", names.REQUEST_PRODUCTS,
        ),
        JobSpec(
            "pricebook_info", _PRICEBOOK_SOURCES,
            "contract_dashboard_pricebook_and_pricebook_product_info",
            _pricebook, defaults={"attributes": names.ATTRIBUTES},
        ),
        JobSpec(
            "pricebook_staging", _PRICEBOOK_SOURCES, "pricebook_analytics_staging",
            _pricebook_staged, defaults={"attributes": names.ATTRIBUTES},
        ),
        JobSpec(
            "negotiation_history",
            (
                TableSource(
                    "requests_historicalrequestproduct",
                    columns=("id", "request_id", "pricebook_product_id", "type", "status", "history_date"),
                ),
                TableSource(
                    "request_values", columns=("id", "request_product_id", "pricebook_value_id")
                ),
                TableSource(
                    "requests_historicalrequestvalue",
                    columns=("id", "request_product_id", "draft_value", "history_user_id", "history_date"),
                ),
                TableSource("requests_historicalrequest", columns=("id", "history_date")),
                TableSource("pb_required_field", columns=("id", "field_name")),
            ),
            "contract_dashboard_negotiation_history_combined",
            _negotiation,
            defaults={"fan_out": True, "field_column": "pricebook_value_id", "as_runs": False},
        ),
        JobSpec(
            "historical_demand",
            (
                TableSource(
                    "materials_table",
                    columns=(
                        "manufacturer_name", "manufacturer_part_no", "customer_long_description",
                        "description", "po_item_quantity", "po_item_first_release_date",
                        "region", "company_id",
                    ),
                ),
                TableSource(
                    "contract_dashboard_pricebook_and_pricebook_product_info", "pricebook_info",
                    columns=(
                        "id", "manufacturer_name", "manufacturer_part_no", "customer_long_description",
                    ),
                ),
            ),
            "contract_dashboard_historical_demand_for_pricebook_products",
            _demand,
            defaults={
                "region": names.DEMAND_REGION, "company_id": names.DEMAND_COMPANY, "corrected": False,
            },
        ),
        JobSpec(
            "user_info",
            (
                TableSource("users_user", columns=("id", "first_name", "last_name", "company_id")),
                TableSource("companies_customercompany", columns=("id", "name")),
                TableSource("users_user_roles", columns=("user_id", "role_id")),
                TableSource("roles_role", columns=("id", "name")),
            ),
            "contract_dashboard_user_info",
            _users,
        ),
        projection_job(
            "user_support", "requests", "user_support_requests_request",
            names.USER_SUPPORT_REQUESTS, APPEND,
        ),
        projection_job(
            "po_history", "benchmark_report_historical_data", "benchmark_report_historical_data",
            names.PO_HISTORY,
        ),
        JobSpec(
            "benchmark_history",
            (TableSource("history_materialbenchmarkhistory", columns=tuple(STORED)),),
            "benchmark_report_material_benchmark_history",
            _benchmark, defaults={"lenient": False},
        ),
        JobSpec(
            "currency_rates",
            (TableSource("payloads", needed=("success", "message", "base", "date", "rates")),),
            "currency_rates",
            _rates, defaults={"currencies": names.TARGET_CURRENCIES},
        ),
        JobSpec(
            "bid_evaluation", (TableSource("contracts_contract"),), "bid_evaluation_file_upload"
        ),
        *[
            projection_job(f"configured_{name}", source, target, columns)
            for name, (source, target, columns) in names.CONFIGURED_PROJECTIONS.items()
        ],
    ]
}


def refresh_pricebook(
    spark: SparkSession, source: Store, staging: Store, target: Store, since: AsOf,
    column: str = "updated_at", attributes: list[str] | None = None,
) -> int:
    """Bring the pricebook table up to date with what changed after ``since``.

    Products that changed, or of which a value changed, are computed anew in full and
    replace their rows; all other rows stay. The table is put together in ``staging``,
    checked and published, so a failure leaves the old one. Removed products are not seen.
    """
    job = JOBS["pricebook_info"]
    frames = read_sources(spark, job.sources, source)
    products, values = frames["pricebooks_pricebookproduct"], frames["pricebooks_pricebookvalues"]
    changed = changed_since(products, column, since).select("product_id")
    if column in values.columns:
        later = changed_since(values, column, since).select(values.pb_product_id.alias("product_id"))
        changed = changed.unionByName(later)
    frames["pricebooks_pricebookproduct"] = products.join(changed.distinct(), "product_id", "left_semi").select(*products.columns)
    keys = frames["pricebooks_pricebookproduct"].select("id").distinct()
    fresh = _pricebook(frames, {"attributes": attributes or names.ATTRIBUTES})
    kept = target.read(spark, job.target).join(keys, "id", "left_anti")
    overwrite(kept.select(*fresh.columns).unionByName(fresh), staging, job.target)
    return publish(spark, staging, job.target, target, job.target, "id")


def copy_user_support(spark: SparkSession, source: Store, target: Store) -> list[CopyResult]:
    """The four user-support tables, each with the columns its dashboard reads."""
    return copy_tables(spark, names.USER_SUPPORT_COPIES, source, target)

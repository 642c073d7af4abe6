"""Price-benchmark runs: fields read out of their JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenderline.functions.json_fields import document, latest_price, latest_price_in, number_at, number_in, text_at, text_in

# Stored columns and the document paths behind the derived ones.
STORED = [
    "id", "user_id", "timestamp", "input_data", "plots_data", "table_data",
    "corrected_price", "corrected_currency", "company_id",
]
MATERIAL_PATH = "$.manufacturer_part_number"
PROPOSED_PATH = "$.vendors[0].proposed_price"
RESULT_PATH = "$.recommendation_message"
# End of fixed values.
DOCUMENTS = ["input_data", "plots_data", "table_data"]


def benchmark_history(runs: DataFrame, lenient: bool = False) -> DataFrame:
    """Stored columns plus material, proposed price, result and former price."""
    return runs.select(
        *STORED,
        text_at("input_data", MATERIAL_PATH).alias("material_n"),
        number_at("input_data", PROPOSED_PATH, lenient=lenient).alias("price_proposed"),
        text_at("plots_data", RESULT_PATH).alias("dmp_result"),
        latest_price("table_data", lenient).alias("price_proposed_old_input"),
    )


def with_documents(runs: DataFrame, lenient: bool = False) -> DataFrame:
    """Runs with their documents parsed, as a landing table keeps them: VARIANT columns ``<name>_doc`` beside the texts."""
    return runs.select(*STORED, *[document(c, lenient).alias(f"{c}_doc") for c in DOCUMENTS])


def history_of_documents(landed: DataFrame, lenient: bool = False) -> DataFrame:
    """The same history out of parsed documents: paths are looked up, no text is read again."""
    return landed.select(
        *STORED,
        text_in("input_data_doc", MATERIAL_PATH).alias("material_n"),
        number_in("input_data_doc", PROPOSED_PATH, lenient=lenient).alias("price_proposed"),
        text_in("plots_data_doc", RESULT_PATH).alias("dmp_result"),
        latest_price_in("table_data_doc", lenient).alias("price_proposed_old_input"),
    )

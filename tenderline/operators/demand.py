"""Yearly demand per material and its summary per pricebook product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tenderline.catalog import DEMAND_COMPANY, DEMAND_REGION
from tenderline.functions.scalar import year_of
from tenderline.operators.balance import join_to_unique

MATERIAL = ["manufacturer_name", "manufacturer_part_no", "description"]
QUANTITY = "decimal(38,2)"
AVERAGE = "decimal(38,6)"


def materials_in_scope(
    materials: DataFrame, region: str = DEMAND_REGION, company_id: int = DEMAND_COMPANY
) -> DataFrame:
    return materials.where((F.col("region") == region) & (F.col("company_id") == company_id))


#: What a partial is about: a material, a year of orders, and whether rows are counted as orders or as partners.
GROUP = [*MATERIAL, "order_year", "is_partner"]


def demand_partials(materials: DataFrame, sign: str | None = None) -> DataFrame:
    """Per material and year: ``quantity``, ``known`` (rows with a quantity) and ``rows``, as orders and as partners.

    Each row is counted under both of its texts in one pass. All three are plain sums, so partials of
    different rows can be added up (``merged_partials``). ``sign`` names a column that is negative for rows that are taken
    away again.
    """
    quantity = materials.schema["po_item_quantity"].dataType
    down = F.lit(False) if sign is None else F.col(sign) < 0
    as_order = F.struct(
        F.col("description").alias("description"),
        year_of("po_item_first_release_date").alias("order_year"),
        F.col("po_item_quantity").alias("quantity"),
        F.lit(False).alias("is_partner"),
    )
    as_partner = F.struct(
        F.col("customer_long_description").alias("description"),
        F.lit(None).cast("int").alias("order_year"),
        F.lit(None).cast(quantity).alias("quantity"),
        F.lit(True).alias("is_partner"),
    )
    rows = materials.where(
        F.col("manufacturer_name").isNotNull() & F.col("manufacturer_part_no").isNotNull()
    ).select(
        "manufacturer_name", "manufacturer_part_no", down.alias("down"), F.inline(F.array(as_order, as_partner))
    )
    one = F.when(F.col("down"), -1).otherwise(1)
    signed = F.when(F.col("down"), -F.col("quantity")).otherwise(F.col("quantity"))
    return (
        rows.where(F.col("description").isNotNull())
        .groupBy(*GROUP)
        .agg(
            F.sum(signed).cast(QUANTITY).alias("quantity"),
            F.sum(F.when(F.col("quantity").isNotNull(), one).otherwise(0)).alias("known"),
            F.sum(one).alias("rows"),
        )
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of several sets of rows as one of them all; groups without rows go."""
    sums = [F.sum(c).alias(c) for c in ("known", "rows")]
    merged = partials.groupBy(*GROUP).agg(F.sum("quantity").cast(QUANTITY).alias("quantity"), *sums)
    return merged.where(F.col("rows") != 0)


def yearly_from(partials: DataFrame, corrected: bool = False) -> DataFrame:
    """Ordered quantity per material and year, from one partial per group.

    The groups, a few per material, look up their number of partners.
    """
    partners = F.sum(F.when(F.col("is_partner"), F.col("rows"))).over(Window.partitionBy(*MATERIAL))
    quantity = F.when(F.col("known") != 0, F.col("quantity"))
    total = quantity if corrected else quantity * F.col("partners")
    return (
        partials.withColumn("partners", partners)
        .where(~F.col("is_partner") & F.col("partners").isNotNull())
        .select(*MATERIAL, "order_year", total.cast(QUANTITY).alias("total_quantity"))
    )


def yearly_demand(materials: DataFrame, corrected: bool = False) -> DataFrame:
    """Ordered quantity per material and year.

    As defined, every row counts once per row of the same material (description
    against long description), so a sum is multiplied by the number of such rows;
    ``corrected`` keeps the plain sum. Rows are reduced to partials in one pass instead of being joined
    with themselves.
    """
    return yearly_from(demand_partials(materials), corrected)


def demand_summary(products: DataFrame, yearly: DataFrame, year: int) -> DataFrame:
    """Demand of the year before ``year`` and the mean over the three years before.

    Years without orders do not enter the mean. The yearly rows are folded to one
    row per material first, so a product never meets more than one row. Quantities
    whose mean is taken are carried as sum and count until the end.
    """
    last = F.when(F.col("order_year") == year - 1, F.col("total_quantity"))
    recent = F.when(F.col("order_year").between(year - 3, year - 1), F.col("total_quantity"))
    folded = yearly.groupBy(*MATERIAL).agg(
        F.max(last).alias("last_year"),
        F.sum(recent).alias("recent_sum"),
        F.count(recent).alias("recent_years"),
    )
    asked = products.select(
        "id",
        "manufacturer_name",
        "manufacturer_part_no",
        F.col("customer_long_description").alias("description"),
    )
    met = join_to_unique(asked, folded, MATERIAL, "left")
    years = F.sum("recent_years")
    mean = F.when(years > 0, F.sum("recent_sum") / years)
    return met.groupBy(F.col("id").alias("contract_product_id")).agg(
        F.max("last_year").cast(QUANTITY).alias("last_year_demand"),
        mean.cast(AVERAGE).alias("average_demand"),
    )


def recent_average(materials: DataFrame, year: int) -> DataFrame:
    """Mean ordered quantity per material over the three years before ``year``."""
    recent = year_of("po_item_first_release_date").between(year - 3, year - 1)
    quantity = F.when(recent, F.col("po_item_quantity"))
    return materials.groupBy(*MATERIAL).agg(
        F.avg(quantity).cast(AVERAGE).alias("average_quantity")
    )


def quantity_by_year(materials: DataFrame) -> DataFrame:
    return materials.groupBy(
        year_of("po_item_first_release_date").alias("order_year")
    ).agg(F.sum("po_item_quantity").cast(QUANTITY).alias("total_quantity"))

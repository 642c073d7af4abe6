"""Field/value rows to one wide row per pricebook product."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline.catalog import ATTRIBUTES, PRICEBOOK_HEADER, PRICEBOOK_PRODUCT
from tenderline.operators.balance import by_shares, hot_codes, join_to_unique, lookup_join, placed


def named_values(values: DataFrame, fields: DataFrame) -> DataFrame:
    """Values with the name of their field; values of unknown fields drop out."""
    names = fields.select(F.col("id").alias("pb_required_field_id"), "field_name")
    return lookup_join(
        values.select("pb_product_id", "pb_required_field_id", "field_value"),
        names,
        ["pb_required_field_id"],
    )


def wide_values(
    values: DataFrame, fields: DataFrame, attributes: dict[str, str] = ATTRIBUTES, rows: int | None = None
) -> DataFrame:
    """One row per product: the greatest text per attribute.

    No filter on the attributes, so a product that only has other fields keeps a
    row of NULLs. Texts are reduced by sorting, so values are placed by product first:
    a task that reads a source unfolds any number of them. The values of a product
    with very many are dealt to several tasks and reduced there before they meet.
    ``rows`` is the number of values if known already.
    """
    cells = [
        F.max(F.when(F.col("field_name") == name, F.col("field_value"))).alias(column)
        for name, column in attributes.items()
    ]
    rows = values.count() if rows is None else rows
    codes = hot_codes(values, ["pb_product_id"], rows)
    named = named_values(values, fields)
    named = placed(named, "pb_product_id", ["field_name", "field_value"], rows, codes)
    return named.groupBy("pb_product_id").agg(*cells)


def attribute_pivot(
    products: DataFrame,
    values: DataFrame,
    fields: DataFrame,
    pricebooks: DataFrame,
    attributes: dict[str, str] = ATTRIBUTES,
) -> DataFrame:
    """Products with their attributes and pricebook header, one row per group.

    The values, by far the largest input, are reduced before they meet anything
    else; a maximum does not change when the rows of a product are multiplied.
    Products are placed by product once, as values are, for removing copies and for the join alike,
    unless a hot product id makes it better to remove copies in the map tasks.
    """
    codes = hot_codes(products, ["product_id"])
    rows = values.count()
    wide = wide_values(values, fields, attributes, rows).withColumnRenamed(
        "pb_product_id", "product_id"
    )
    header = pricebooks.select(
        F.col("id").alias("pricebook_id"),
        *[F.col(c).alias(a) for c, a in PRICEBOOK_HEADER.items()],
    )
    listed = products.select(*PRICEBOOK_PRODUCT)
    single = (listed if codes else by_shares(listed, rows, "product_id")).distinct()
    headed = lookup_join(single, header, ["pricebook_id"], distinct=True)
    joined = join_to_unique(headed, wide, ["product_id"], "inner", codes)
    return joined.select(
        *PRICEBOOK_PRODUCT, *attributes.values(), *PRICEBOOK_HEADER.values()
    )
